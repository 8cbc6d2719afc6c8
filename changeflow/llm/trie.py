"""The trie of all prefixes of conversations, without a trie: conversations are sorted as sequences of
turns, and what neighbours have in common (the LCP) tells the rest. A prefix is an interval of the sorted
rows; its ends are found by binary search in a sparse table of least LCPs, for each prefix by itself.

The sorted rows lie in blocks, one for each part of the sort. Each block is worked on alone: it knows what
its first row has in common with the row before and its last one with the row after. Prefixes that
reach over a block's end are told apart by the same search over the blocks' least LCPs, and what
the blocks found for them is added up; there are at most as many as blocks times shared turns."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.arrow import ship
from changeflow.llm.lists import joined, measured
from changeflow.llm.order import ordered
from changeflow.session import scratch_path, settle

#: Conversations of one hundred begin with turns of its first, fewer than this many.
GROUP, HEADS = 100, 6
#: Prefixes that are searched at a time.
AT_ONCE = 1 << 19

#: What a block tells of a prefix. `side`: null if the prefix lies within the block, "own" if it begins there
#: and goes on behind it, "in" if it began before it, "block" for the block's least LCP (as `depth`).
FOUND = (
    "part long, side string, depth long, conv_id long, n_convs long, n_children long, n_leaves long, total long, "
    "fresh long, before long, first_total long, ends_sha256 string, ends binary, parent_conv_id long, up string"
)

#: Of these the rows of the result are made.
_RESULT = [
    "conv_id", "n_convs", "n_children", "n_leaves", "total", "fresh", "before", "first_total", "parent_conv_id", "up", "ends_sha256",
]


def turns(conversations: DataFrame) -> DataFrame:
    """`conv_id`, and its `turns` in order: a key of role and text (128 bits), and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"), key.alias("key"), F.char_length(text).cast("long").alias("size")).alias("turn"),
    )
    rows = rows.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % GROUP)
    # Dealt out by the head, so that a conversation meets its head without a further shuffle.
    rows = rows.repartition("head_id").groupBy("head_id", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return rows.withColumn("turns", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `keys` and `sizes` of the turns of each conversation c, of which the first h are those of
    conversation c - c % 100 (all if it has fewer, none if it is absent), h = crc32(c) % 6."""
    own = turns(conversations)
    heads = own.filter("conv_id = head_id").select("head_id", F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")
    head = F.coalesce("head", F.slice("turns", 1, 0))
    rows = own.join(heads, "head_id", "left").select(
        "conv_id", F.concat(F.slice(head, F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns")
    )
    return rows.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes"))


def in_common(a: Column, b: Column) -> Column:
    """Number of leading elements that two arrays share; null if either is."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(other > 0, other - 1).when(other == 0, F.size(a).cast("long"))


class RangeLeast:
    """Sparse table: level k holds the least of each 2^k values in a row."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Of the values from `low` to `high`, both included."""
        out, level = np.empty(len(low), dtype=self.levels[0].dtype), np.frexp(high - low + 1)[1] - 1
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] + 1 - (1 << int(k))])
        return out

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Where the values behind `at` cease to reach `bound`: the last place before."""
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = at + 1 < len(level)
            on = fits & (level[np.where(fits, at + 1, 0)] >= bound)
            at = at + (on.astype(np.int64) << k)
        return at

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place from which on all values up to `at`, but not its own, reach `bound`; the value of a
        place tells what it shares with the place before."""
        for k in range(len(self.levels) - 1, -1, -1):
            low = at - (1 << k) + 1
            on = (low >= 1) & (self.levels[k][np.maximum(low, 0)] >= bound)
            at = at - (on.astype(np.int64) << k)
        return at


class Block:
    """Sorted rows of one part. `came` and `goes`: what its first row shares with the row before the block and
    its last with the one behind, -1 if there is none."""

    def __init__(self, part: int, ids: np.ndarray, lengths: np.ndarray, keys: np.ndarray, sizes: np.ndarray, came: int, goes: int):
        self.part, self.ids, self.lengths, self.came, self.goes = part, ids, lengths, came, goes
        self.n = len(ids)
        self.start = np.concatenate(([0], np.cumsum(lengths)))
        self.sums = np.concatenate(([0], np.cumsum(sizes)))
        self.lcp = np.concatenate(([came], self._shared(keys)))
        self.lcps, self.least_id = RangeLeast(self.lcp), RangeLeast(ids)
        self.total = self.sums[self.start[1:]] - self.sums[self.start[:-1]]
        fresh = self.sums[self.start[1:]] - self.sums[self.start[:-1] + np.maximum(self.lcp, 0)]
        ends = np.append(self.lcp[1:], goes) < lengths
        self.totals, self.freshes, self.leaves = (np.concatenate(([0], np.cumsum(x))) for x in (self.total, fresh, ends))
        # Rows by which a prefix of `lcp` turns gets a further child, sorted by that depth and place.
        branch = np.flatnonzero(self.lcp < lengths)
        self.branches = np.sort(self.lcp[branch] * (self.n + 1) + branch)
        repeats = (self.lcp == lengths) & np.concatenate(([False], lengths[1:] == lengths[:-1]))
        self.repeated = RangeLeast(repeats.astype(np.int64))

    def _shared(self, keys: np.ndarray) -> np.ndarray:
        """Leading turns that each row but the first shares with the row before."""
        most = np.minimum(self.lengths[:-1], self.lengths[1:])
        ends = np.cumsum(most)
        begins = ends - most
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(begins, most)
        a, b = np.repeat(self.start[:-2], most) + inside, np.repeat(self.start[1:-1], most) + inside
        other = np.append(np.flatnonzero((keys[a] != keys[b]).any(axis=1)), ends[-1] if len(ends) else 0)
        first = other[np.searchsorted(other, begins)]
        return np.minimum(first, ends) - begins

    def columns(self, first: np.ndarray, last: np.ndarray, depth: np.ndarray, entering: bool) -> dict:
        """What adds up over the blocks of a prefix, for the rows `first` to `last`. The first row of a prefix
        brings all its turns; one that began in an earlier block has its first row there."""
        low = first + (0 if entering else 1)
        key = depth * (self.n + 1)
        children = np.searchsorted(self.branches, key + last, "right") - np.searchsorted(self.branches, key + low, "left")
        if not entering:
            children = children + (self.lengths[first] > depth)
        return {
            "depth": depth,
            "conv_id": self.least_id.least(first, last),
            "n_convs": last - first + 1,
            "n_children": children,
            "n_leaves": self.leaves[last + 1] - self.leaves[first],
            "total": self.totals[last + 1] - self.totals[first],
            "fresh": self.freshes[last + 1] - self.freshes[low],
        }

    def members(self, first: np.ndarray, full: np.ndarray) -> list[bytes]:
        """Where `full`, the ids of the rows from `first` on that are equal to it, as text."""
        out = [b""] * len(first)
        at = np.flatnonzero(full)
        last = self.repeated.right(first[at], np.ones(len(at), dtype=np.int64))
        for k, low, high in zip(at.tolist(), first[at].tolist(), last.tolist()):
            out[k] = ",".join(map(str, self.ids[low : high + 1].tolist())).encode()
        return out

    def nodes(self) -> Iterator[dict]:
        """Prefixes that begin in the block: each row brings those longer than what it shares with the row before."""
        new = self.lengths - self.lcp
        ends = np.cumsum(new)
        for low in range(0, int(ends[-1]), AT_ONCE):
            at = np.arange(low, min(low + AT_ONCE, int(ends[-1])))
            row = np.searchsorted(ends, at, "right")
            depth = at - (ends[row] - new[row]) + self.lcp[row] + 1
            last = self.lcps.right(row, depth)
            out = self.columns(row, last, depth, entering=False)
            out["open"] = (last == self.n - 1) & (self.goes >= depth)
            out["before"] = np.where(depth > 0, self.sums[self.start[row] + np.maximum(depth - 1, 0)] - self.sums[self.start[row]], 0)
            out["first_total"] = self.total[row]
            above = np.maximum(depth - 1, 0)
            begin, end = self.lcps.left(row, above), self.lcps.right(row, above)
            entered = (begin == 0) & (self.came >= above)
            out["up"] = np.where(depth == 0, 0, np.where(entered, 2, np.where((end == self.n - 1) & (self.goes >= above), 1, 0)))
            out["parent"], out["root"] = self.least_id.least(begin, end), depth == 0
            out["ends"] = self.members(row, self.lengths[row] == depth)
            yield out

    def entering(self) -> dict | None:
        """Prefixes that reach into the block from before."""
        if self.came < 0:
            return None
        depth = np.arange(self.came + 1)
        zero = np.zeros(len(depth), dtype=np.int64)
        out = self.columns(zero, self.lcps.right(zero, depth), depth, entering=True)
        out["ends"] = self.members(zero, (depth == self.came) & (self.lengths[0] == self.came))
        return out


def _batch(block: Block, rows: dict, side: list | None) -> pa.RecordBatch:
    n = len(rows["depth"])
    whole = pa.array([None] * n, pa.int64())
    side = side or [None] * n
    open_ = [s is not None for s in side]
    digests = [None if o else sha256(e).hexdigest() for o, e in zip(open_, rows["ends"])]
    up = np.array([None, "own", "in"], dtype=object)[rows["up"]] if "up" in rows else [None] * n
    parent = whole
    if "parent" in rows:
        parent = pa.array(rows["parent"], pa.int64(), mask=(rows["up"] > 0) | rows["root"])
    number = lambda name: pa.array(rows[name], pa.int64()) if name in rows else whole
    columns = [
        pa.array(np.full(n, block.part), pa.int64()), pa.array(side, pa.string()), *map(number, [
            "depth", "conv_id", "n_convs", "n_children", "n_leaves", "total", "fresh", "before", "first_total"]),
        pa.array(digests, pa.string()), pa.array([e if o else None for o, e in zip(open_, rows["ends"])], pa.binary()),
        parent, pa.array(list(up), pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FOUND.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Rows come sorted by part and place."""
    held: list[pa.RecordBatch] = []

    def block() -> Block:
        rows = pa.Table.from_batches(held).combine_chunks()
        keys, sizes = rows["keys"].combine_chunks(), rows["sizes"].combine_chunks()
        flat = keys.flatten()
        offsets = np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
        data = np.frombuffer(flat.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(flat) else np.zeros(0, np.uint8)
        number = lambda name: rows[name].to_numpy()
        return Block(
            int(number("_part")[0]), number("conv_id").astype(np.int64), keys.value_lengths().to_numpy().astype(np.int64),
            data.copy().view(np.uint64).reshape(-1, 2), sizes.flatten().to_numpy(), int(number("came")[0]), int(number("goes")[0]),
        )

    for batch in batches:
        parts = batch.column(batch.schema.get_field_index("_part")).to_numpy()
        edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for low, high in zip(edges, edges[1:]):
            if held and low < high and held[-1].column(batch.schema.get_field_index("_part"))[0].as_py() != parts[low]:
                yield block()
                held.clear()
            if low < high:
                held.append(batch.slice(low, high - low))
    if held:
        yield block()


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        least = {"depth": np.array([block.lcp.min()]), "ends": [b""]}
        yield _batch(block, least, ["block"])
        entering = block.entering()
        if entering:
            yield _batch(block, entering, ["in"] * len(entering["depth"]))
        for rows in block.nodes():
            yield _batch(block, rows, ["own" if o else None for o in rows["open"].tolist()])


def _begun(spans: DataFrame, parts: list[int], least: list[int]) -> DataFrame:
    """The block in which a prefix began: the last one before whose least LCP is shorter than it."""

    def search(batches):
        table, at = RangeLeast(np.array(least, dtype=np.int64)), np.array(parts, dtype=np.int64)
        for batch in batches:
            part, depth, side = (batch.column(batch.schema.get_field_index(n)) for n in ("part", "depth", "side"))
            place = np.searchsorted(at, part.to_numpy())
            before = table.left(np.maximum(place - 1, 0), depth.to_numpy())
            start = np.where(np.array(side.to_pylist()) == "in", before, place)
            yield batch.append_column("start", pa.array(at[start], pa.int64()))

    return spans.mapInArrow(search, f"{FOUND}, start long")


def _end_digests(spans: DataFrame) -> DataFrame:
    """SHA-256 over the ids that the blocks of a prefix hold, in their order: a digest is one sequence by its
    nature, so the ids of one prefix pass through one task, as a stream of one row for each block."""

    def digest(batches):
        now, state, filled = None, None, False
        out: list[tuple] = []
        for batch in batches:
            for start, depth, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if (start, depth) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state, filled = (start, depth), sha256(), False
                if ends:
                    state.update(b"," + ends if filled else ends)
                    filled = True
        if now is not None:
            out.append((*now, state.hexdigest()))
        for low in range(0, len(out), AT_ONCE):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out[low : low + AT_ONCE])], ["start", "depth", "ends_sha256"])

    sorted_ = spans.repartition("start", "depth").sortWithinPartitions("start", "depth", "part")
    return sorted_.select("start", "depth", "ends").mapInArrow(digest, "start long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations (`rebuilt`), the empty one included:
    `conv_id` (the smallest of those that begin with it), `depth` (its turns), `parent_conv_id` (the
    prefix's without its last turn; null at the root), `n_convs`, `n_children`, `n_leaves` (prefixes below
    it or itself that none goes beyond), `saved_tokens` (over those below it and itself: members but one,
    times the code points of the last text) and `ends_sha256` (of the ids of those that end with it,
    comma-joined in order).

    Null role or text is empty; a null turn comes first; turns of one number follow by the MD5 of role and
    text, repeated ones stay; rows without conv_id belong to none and are left out; an empty table gives
    no rows; other columns are not read. Equal role and text are told by 128 bits of MD5. A conversation's
    turns are one row of 24 bytes a turn while it is sorted; however many share a prefix, they are split
    over the blocks of the sort.
    """
    spark = conversations.sparkSession
    ship(spark)
    rows = ordered(rebuilt(conversations), [F.col("keys"), F.col("conv_id")], "sequences")
    edges = rows.groupBy("_part").agg(F.min_by("keys", "_row").alias("first"), F.max_by("keys", "_row").alias("last"))
    by_part = Window.orderBy("_part")  # as many rows as the sort has parts
    edges = edges.select(
        "_part",
        F.coalesce(in_common(F.lag("last").over(by_part), F.col("first")), F.lit(-1)).alias("came"),
        F.coalesce(in_common(F.col("last"), F.lead("first").over(by_part)), F.lit(-1)).alias("goes"),
    )
    edges = settle(edges, scratch_path(spark, "edges"))
    blocks = rows.join(F.broadcast(edges), "_part").repartitionByRange("_part").sortWithinPartitions("_part", "_row")
    found = settle(blocks.select("_part", "conv_id", "keys", "sizes", "came", "goes").mapInArrow(_find, FOUND), scratch_path(spark, "prefixes"))
    least = found.filter("side = 'block'").select("part", "depth").orderBy("part").collect()
    spans = _begun(found.filter("side in ('own', 'in')"), [r.part for r in least], [r.depth for r in least])
    spans = settle(spans, scratch_path(spark, "spans"))
    whole = spans.groupBy("start", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "total", "fresh")],
        *[F.max(c).alias(c) for c in ("before", "first_total", "parent_conv_id", "up")],
    ).join(_end_digests(spans), ["start", "depth"])
    whole = settle(whole, scratch_path(spark, "spanning"))
    # Where a block's prefixes find a parent that reaches over its ends.
    ids = whole.select("start", "depth", F.col("conv_id").alias("_parent"))
    names = spans.select(F.col("part"), F.col("side").alias("up"), "depth", "start").join(ids, ["start", "depth"])
    names = measured(names.select("part", "up", (F.col("depth") + 1).alias("depth"), "_parent"), "parents", "32")
    inner = found.filter("side is null").select("part", "depth", *_RESULT)
    over = whole.withColumnRenamed("start", "part").select("part", "depth", *_RESULT)
    nodes = joined(inner.unionByName(over), names, ["part", "depth", "up"], "left")
    saved = (F.col("total") - F.col("n_convs") * F.col("before")) - (F.col("first_total") - F.col("before") + F.col("fresh"))
    return nodes.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", saved.alias("saved_tokens"), "ends_sha256",
    )

