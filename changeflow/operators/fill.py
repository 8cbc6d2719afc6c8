"""Forward fill over arrival order without a single-task sort.

A global window over `seq` would run one session in one task. Rows are instead cut into
blocks of consecutive positions; each block is filled by itself, and the value that enters
a block is found over the much smaller table of block ends, which is filled the same way
one level up. Every window group is bounded by the block sizes, whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65536  # positions per block
FAN_IN = 4096  # blocks per upper block


def block_of(position: Column, size: int) -> Column:
    return F.call_function("div", position, F.lit(size))


def carry_in(
    ends: DataFrame, key: str, value: str, fan_in: int = FAN_IN, few: bool = False
) -> DataFrame:
    """`ends` has one row (key, block, value or NULL) per block. Returns (key, block, carry):
    the newest non-null value of an earlier block of the same key. `few` says that there are no
    more than `fan_in` blocks in all, which one window per key can take."""
    earlier = (Window.unboundedPreceding, -1)
    if few:
        whole = Window.partitionBy(key).orderBy("block").rowsBetween(*earlier)
        return ends.select(key, "block", F.last(value, ignorenulls=True).over(whole).alias("carry"))
    upper = block_of(F.col("block"), fan_in)
    inside = Window.partitionBy(key, "upper").orderBy("block").rowsBetween(*earlier)
    ends = ends.withColumn("upper", upper)
    local = ends.withColumn("local", F.last(value, ignorenulls=True).over(inside))
    tops = ends.groupBy(key, "upper").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col("block"))).alias("top")
    )
    across = Window.partitionBy(key).orderBy("upper").rowsBetween(*earlier)
    tops = tops.select(key, "upper", F.last("top", ignorenulls=True).over(across).alias("above"))
    return local.join(tops, [key, "upper"]).select(
        key, "block", F.coalesce("local", "above").alias("carry")
    )


def fill_forward(
    rows: DataFrame,
    ends: DataFrame,
    key: str,
    position: str,
    value: str,
    fan_in: int = FAN_IN,
    few: bool = False,
) -> DataFrame:
    """Replace NULLs of `value` by the newest earlier value of the same key.

    `rows` carries a `block` column; `ends` holds the last value of every block of `rows`.
    The join uses the partitioning the window has already made.
    """
    inside = Window.partitionBy(key, "block").orderBy(position).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = rows.withColumn(value, F.last(value, ignorenulls=True).over(inside))
    carried = carry_in(ends, key, value, fan_in, few)
    return (
        filled.join(carried, [key, "block"], "left")
        .withColumn(value, F.coalesce(value, "carry"))
        .drop("carry")
    )
