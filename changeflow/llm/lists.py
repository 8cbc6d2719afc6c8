"""Bringing lists found per document back to the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from changeflow.session import scratch_path, settle

#: A table is sent to every executor only up to these measured sizes; beyond, both sides are shuffled.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20


def measured(rows: DataFrame, label: str, size: str = "16") -> tuple[DataFrame, int, int]:
    """`rows` written once, with their number and the sum of `size`, their bytes."""
    seen = Observation()
    totals = [F.count("*").alias("n"), F.sum(F.expr(size)).alias("bytes")]
    kept = settle(rows, scratch_path(rows.sparkSession, label), seen=seen, totals=totals)
    return kept, seen.get["n"], seen.get["bytes"] or 0


def joined(left: DataFrame, right: tuple[DataFrame, int, int], on: list[str], how: str) -> DataFrame:
    """A join with a measured table: broadcast while it is small, else a shuffle of both sides."""
    rows, n, size = right
    small = n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    return left.join(F.broadcast(rows) if small else rows, on, how)
