"""Shards along a Hilbert curve over several dimensions of metadata: neighbours on the curve are
neighbours in every dimension, so a file cut from it has narrow ranges in all of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.order import ordered, ranked

SHARDS = 24
BITS = 5
#: Columns that `hilbert_shards` adds.
ADDED = ("size", "text_crc32", "curve", "shard", "slot")


def text_prefix(name: str | Column) -> Column:
    """The first seven bytes of a string as a number in the same order; null stays null."""
    column = F.col(f"`{name}`") if isinstance(name, str) else name
    head = F.rpad(F.substring(F.encode(column, "UTF-8"), 1, 7), 7, F.lit(b"\0"))
    return F.conv(F.hex(head), 16, 10).cast("long")


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """The curve as a machine that reads one bit of each dimension at a time: for each state and
    reading, the digit of the index and the next state. A state is the corner where the curve
    enters a cell (Gray-coded) and the direction it runs."""
    size = 1 << dims
    turn = lambda x, k: (x << k % dims | x >> (dims - k % dims)) & (size - 1)
    gray = lambda x: x ^ x >> 1
    ones = lambda x: (~x & (x + 1)).bit_length() - 1
    digit_of = {gray(x): x for x in range(size)}
    digits, states = [], []
    for state in range(size * dims):
        entry, way = state // dims, state % dims
        for reading in range(size):
            digit = digit_of[turn(reading ^ entry, dims - (way + 1) % dims)]
            corner = gray(2 * ((digit - 1) // 2)) if digit else 0
            run = 0 if digit == 0 else ones(digit if digit % 2 else digit - 1) % dims
            digits.append(digit)
            states.append((entry ^ turn(corner, way + 1)) * dims + (way + run + 1) % dims)
    return digits, states


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Position on the curve of a point whose coordinates have `bits` bits each."""
    dims = len(cells)
    digits, states = (F.array(*map(F.lit, table)) for table in curve_steps(dims))

    def step(seen: Column, bit: Column) -> Column:
        reading = sum(
            (F.getbit(cell.cast("long"), bit).cast("int") * (1 << k) for k, cell in enumerate(cells)), F.lit(0)
        )
        at = seen["state"] * (1 << dims) + reading
        index = (seen["index"] * (1 << dims) + F.get(digits, at)).cast("long")
        return F.struct(index.alias("index"), F.get(states, at).cast("int").alias("state"))

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["index"]


def quantised(rows: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Coordinates of equal depth: how many of the 2^bits - 1 cut points a value reaches; null 0.
    The cut points are quantiles over all rows; only they come to the driver."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(d, shares, 10_000).alias(d) for d in dims]).first()
    return [
        sum((F.coalesce(F.col(d) >= c, F.lit(False)).cast("int") for c in cuts[d] or []), F.lit(0)) for d in dims
    ]


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, dims: Mapping[str, Column] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """Rows sorted along the curve over `dims` (name -> numeric column) and cut into runs whose row
    counts are at most one apart: the columns `keep`, and `size` (UTF-8 bytes of the text plus 8),
    `text_crc32`, `curve`, `shard` and `slot` (gapless from 0 in each shard).

    By default the dimensions are source, language, size and id. Null text counts as none (size 8,
    checksum 0); a null dimension lies in cell 0; equal points are cut by id, checksum and hash of the text,
    so a hot cell spans shards; repeated rows each take a slot; an empty table gives no rows. Columns
    beside those kept are not read; one of a clashing name can be kept, as all inputs are read
    before any column is made, but not under the names this adds.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    dims = dims or {
        "source": text_prefix("source"), "lang": text_prefix("lang"), "size": size, "doc_id": F.col("doc_id").cast("long"),
    }
    names = [f"_d{k}" for k in range(len(dims))]
    keep = keep or ["doc_id"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_kept"),
        F.col("doc_id").alias("_id"),
        size.alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
        *[c.alias(n) for n, c in zip(names, dims.values())],
    )
    rows = rows.withColumn("curve", hilbert_index(quantised(rows, names, bits), bits))
    order = [F.col(c) for c in ("curve", "_id", "text_crc32", "_text", "size")]
    placed = ranked(ordered(rows.drop(*names), order, "curve"))
    placed = placed.withColumn("shard", F.expr(f"cast(_rank * {shards} div _total as int)"))
    start = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return placed.select(
        *[F.col(f"_kept.`{c}`").alias(c) for c in keep], "size", "text_crc32", "curve", "shard",
        (F.col("_rank") - start).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of files per shard, each sorted along the curve."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
