"""Exact positions in a global order without a window over all rows: rows are dealt out by range,
written once, numbered inside their part, and each part is moved by what lies before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.session import scratch_path, settle

#: Bits of a row's number inside its part, in Spark's increasing ids.
PART_BITS = 33


def ordered(rows: DataFrame, keys: list[Column], label: str, parts: int | None = None) -> DataFrame:
    """`rows` written in the order of `keys`, with `_row` (grows with the order, unique) and `_part`
    (the part of the order it lies in). Rows equal in all keys take any order among themselves.
    There are as many parts as the bytes need, or the given number."""
    dealt = rows.repartitionByRange(parts, *keys) if parts else rows.repartitionByRange(*keys)
    dealt = dealt.sortWithinPartitions(*keys)
    kept = settle(dealt.withColumn("_row", F.monotonically_increasing_id()), scratch_path(rows.sparkSession, label))
    return kept.withColumn("_part", F.shiftright("_row", PART_BITS))


def ranked(rows: DataFrame) -> DataFrame:
    """`ordered` rows with `_rank`, the gapless position from 0, and `_total`, the number of rows.
    The table of parts, joined to all rows, is as long as the shuffle has parts."""
    parts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("_part"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    inside = F.col("_row") - F.shiftleft(F.col("_part"), PART_BITS)
    return rows.join(F.broadcast(parts), "_part").withColumn("_rank", F.col("_before") + inside).drop("_before")
