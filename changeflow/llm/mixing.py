"""Mixing sources to target weights. The words of each source are packed, document after document,
into blocks of fixed length; a source's share of the mix is a number of slots; slots draw their
output shard (so that a shard's counts are multinomial) and are mapped to blocks through a
pseudorandom permutation of the source's block numbers. All of it is DataFrame code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.order import ordered
from changeflow.session import scratch_path, settle

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK = 128
SHARD_SLOTS = 4096
#: Rounds of the permutation, and slots made by one row.
ROUNDS = 24
CHUNK = 16_384


@dataclass
class Mix:
    """`rows`: the input in packing order with `_row`, source facts and `_first` word in the source.
    `slots`: `key`, `slot`, `shard`, `block`; a slot takes a whole block. `pieces`: the part
    of each block that a row holds, with `times`, how often the block is taken."""

    rows: DataFrame
    slots: DataFrame
    pieces: DataFrame


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """A permutation of 0..n-1 for any n. Each round pairs x with a key minus x modulo n, and swaps
    the pair or not by a bit that hangs on its larger member, so a round undoes itself."""

    def one(at: Column, k: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(seed, k, F.lit("key")), n) - at, n)
        swap = F.xxhash64(seed, k, F.greatest(at, other)).bitwiseAND(1) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), one)


def targets(sources: DataFrame) -> DataFrame:
    """`key`, `source`, `source_size` with `target`: weights in code point order, null last; 150% of
    all words are shared by weight, no source beyond twice its words. Sources that stop are
    those with the least words per weight, so they come first in that order."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sources.withColumn("_w", F.get(F.array(*map(F.lit, WEIGHTS)), F.pmod(turn, F.lit(len(WEIGHTS)))).cast("double"))
    most = (CAP * F.col("source_size")).cast("double")
    by_ratio = Window.orderBy(most / F.col("_w"), "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    share = SHARE * F.sum("source_size").over(every)
    left = share - F.coalesce(F.sum(most).over(before), F.lit(0.0))
    weight = F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", left / weight).withColumn("_most", most)
    # Of the levels that stay below their source's stop, the first in the order is the highest.
    open_ = F.max(F.when(F.col("_level") * F.col("_w") <= F.col("_most"), F.col("_level"))).over(every)
    rows = rows.withColumn("_open", open_)
    target = F.least("_most", F.coalesce(F.col("_open") * F.col("_w"), F.col("_most")))
    return rows.select("key", "source_size", target.alias("target"))


def mix(docs: DataFrame, block: int = BLOCK, seed: int = 7, keep: list[str] | None = None) -> Mix:
    """Plan of the mix over all rows of `docs` (`doc_id`, `text`, `source`, and what `keep` names).

    Null text has no words; null source is a source, the last one; a row without words is never
    taken; repeated rows are packed one after another; ties in id are ordered by a hash of the text;
    an empty table gives an empty mix. Other columns are not read, and kept ones lie in a struct.
    The last block of a source may be shorter. Only facts per source and part of the order are in
    windows: no window sees the rows of a whole source.
    """
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep or ["doc_id"]]).alias("_kept"),
        F.col("doc_id").alias("_id"), key.alias("key"), F.col("source").alias("source"),
        F.xxhash64("text").alias("_text"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = ordered(sized, [F.col(c) for c in ("key", "_id", "_text", "size")], "packed")
    parts = settle(
        rows.groupBy("_part", "key").agg(F.sum("size").alias("_n"), F.first("source").alias("source")),
        scratch_path(docs.sparkSession, "parts"),
    )
    sources = parts.groupBy("key").agg(F.sum("_n").alias("source_size"), F.first("source").alias("source"))
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.round((F.col("target") - F.col("_epochs") * F.col("source_size")) / block).cast("long")
    facts = targets(sources).withColumn("_blocks", blocks).withColumn("_epochs", epochs)
    facts = facts.withColumn("_slots", F.col("_epochs") * F.col("_blocks") + F.least(F.col("_blocks"), rest))
    facts = settle(facts, scratch_path(docs.sparkSession, "sources"))

    before = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(facts, "key")
    inside = Window.partitionBy("_part", "key").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    starts = starts.select("_part", "key", "_start", "source_size", "target")
    rows = rows.join(starts, ["_part", "key"]).withColumn("_first", first)

    slots = _slots(facts, seed)
    times = slots.groupBy("key", "block").agg(F.count("*").alias("times"))
    last = F.col("_first") + F.col("size") - 1
    spans = F.when(F.col("size") > 0, F.sequence(F.expr(f"_first div {block}"), F.expr(f"(_first + size - 1) div {block}")))
    pieces = rows.select("_row", "key", "_first", "size", F.explode(spans).alias("block"))
    from_ = F.greatest(F.col("block") * block - F.col("_first"), F.lit(0))
    upto = F.least((F.col("block") + 1) * block, last + 1) - F.col("_first")
    pieces = pieces.select("_row", "key", "block", from_.alias("from"), (upto - from_).alias("words"))
    # The planner takes the slots for as few as the rows they are made from, and would broadcast them.
    pieces = pieces.join(times.hint("merge"), ["key", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    return Mix(rows, slots, pieces)


def _slots(facts: DataFrame, seed: int) -> DataFrame:
    """All slots, made in chunks so that no row makes those of a whole source. A slot past the
    blocks of its source begins another round through them, in another order."""
    total = F.greatest(F.sum("_slots").over(Window.partitionBy()), F.lit(1))
    chunks = facts.withColumn("_shards", F.ceil(total / SHARD_SLOTS)).filter("_slots > 0")
    chunks = chunks.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_slots - 1) div {CHUNK}"))))
    end = F.least((F.col("_chunk") + 1) * CHUNK, F.col("_slots")) - 1
    # A given number of parts is kept as it is: the few small rows would else be made into slots by one task.
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = chunks.repartition(parts, "key", "_chunk").withColumn("slot", F.explode(F.sequence(F.col("_chunk") * CHUNK, end)))
    epoch = F.expr("slot div _blocks")
    source_seed = F.xxhash64(F.lit(seed), F.col("key"), epoch)
    return slots.select(
        "key", "slot",
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "key", "slot"), F.col("_shards")).alias("shard"),
        permuted(F.pmod("slot", "_blocks"), F.col("_blocks"), source_seed).alias("block"),
    )


def shard_counts(plan: Mix) -> DataFrame:
    """Slots that each output shard draws from each source."""
    return plan.slots.groupBy("shard", "key").agg(F.count("*").alias("slots"))


def taken(plan: Mix) -> DataFrame:
    """Per input row: kept columns, `size`, `source_size`, `target`, and `taken`, its words in the
    mix, repeats counted."""
    sums = plan.pieces.groupBy("_row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return plan.rows.join(sums, "_row", "left").select(
        "_kept.*", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(plan: Mix) -> DataFrame:
    """The mix as documents, in the kept columns: for each time a row's words are taken, a row with
    the words taken (the text itself if all are), in order. `text` must be kept."""
    held = plan.pieces.filter("times > 0").groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("from", "words", "times"))).alias("_taken")
    )
    rows = plan.rows.join(held, "_row")
    rows = rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.array_max("_taken.times"))))
    rows = rows.withColumn("_here", F.filter("_taken", lambda p: p["times"] >= F.col("_time")))
    words = F.aggregate("_here", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    split = F.regexp_extract_all("_kept.text", F.lit(f"({WORD})"), F.lit(1))
    rows = rows.withColumn("_whole", words == F.col("size")).withColumn("_words", F.when(~F.col("_whole"), split))
    slices = F.transform("_here", lambda p: F.slice(F.col("_words"), (p["from"] + 1).cast("int"), p["words"].cast("int")))
    cut = F.array_join(F.flatten(slices), " ")
    text = F.when(F.col("_whole"), F.col("_kept.text")).otherwise(cut)
    names = plan.rows.schema["_kept"].dataType.names
    made = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return rows.select(*[made[c].alias(c) if c in made else F.col(f"_kept.`{c}`").alias(c) for c in names])
