"""Near copies by ProbMinHash: weighted shingles arrive as Poisson processes, the first arrival in
each component is the signature, and two signatures agree in a component with the probability
Jaccard similarity of the texts. Signatures are cut into bands, texts that agree in a band are
candidates, and candidates are verified by the exact similarity of their shingles.

Equal texts are one node. In a bucket nobody is paired with everybody: members are first held
against the member that meets most others, and what those links join is one component. Members of
a bucket that are still in different components are looked at through the shingles that no other of
them has: with shares a and b of shingles that the other lacks two texts are at most (1-a)(1-b)/(1-ab)
similar. The other shingles are counted and weighed by group of their hash: of a group that the other text
has nothing of all is lacking, else as many shingles as it has fewer. Most pairs are settled by these numbers,
also where shingles are repeated. What is left is held against the member with the fewest of its own, and
then compared pair by pair: no link between two components is lost, while edited copies of one text that are
not linked need not be compared.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.llm.components import components
from changeflow.llm.lists import joined, measured
from changeflow.session import scratch_path, settle

SHINGLE, THRESHOLD = 5, 0.8
COMPONENTS, BANDS = 80, 20
#: Groups by which shingles are counted and weighed.
GROUPS = 128
#: Weights from which on a group has a bit in each of the bit maps.
LEVELS = (1, 2, 4, 8, 16)
_STEP, _SLOT = np.uint64(0xD1B54A32D192ED03), np.uint64(0x2545F4914F6CDD1D)


def shingles(words: arrow.Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight): runs of n words with how often they occur; a shorter text is one run."""
    count = np.diff(words.first)
    doc = words.doc()
    whole = words.room() >= n
    docs, hashes = [doc[whole]], [words.runs(n)[whole]]
    for k in range(1, n):
        short = np.flatnonzero(count == k)
        docs.append(short)
        hashes.append(words.runs(k, 1)[words.first[short]] if len(short) else np.zeros(0, np.uint64))
    doc, hashed = np.concatenate(docs), np.concatenate(hashes)
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashed[at], np.diff(np.append(at, len(doc))).astype(np.float64)


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, size: int = COMPONENTS) -> np.ndarray:
    """A row of `size` elements for each text. Round by round each element's next arrival falls on a
    component; an element whose time has passed all first arrivals of its text is done."""
    first = np.full(texts * size, np.inf)
    out = np.zeros(texts * size, dtype=np.uint64)
    time, turn = np.zeros(len(doc)), 0
    with np.errstate(over="ignore"):
        while len(doc):
            turn += 1
            draw = arrow.mix(element + np.uint64(turn) * _STEP)
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53) / weight
            slot = doc * size + ((arrow.mix(draw * _SLOT) >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            out[slot[won]] = element[won]
            going = time < first.reshape(texts, size).max(axis=1)[doc]
            doc, element, weight, time = doc[going], element[going], weight[going], time[going]
    return out.reshape(texts, size)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted elements, weights): for each common
    element, one over the sum of the largest relative weights; the Jaccard index if all weights are one."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][i], b[1][j]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    # Elements with a larger ratio count by their weight in a, those with a smaller by that in b.
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    upper = only_a + np.cumsum(wa[::-1])[::-1]
    lower = only_b + np.cumsum(wb) - wb
    return float((1 / (upper / wa + lower / wb)).sum())


def node_of(text: str | Column) -> Column:
    """128 bits that stand for a text; null is empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def _buckets(rows: DataFrame, bands: int, size: int) -> DataFrame:
    """(bucket, node) for every band of every text with words."""

    def find(batches):
        for batch in batches:
            nodes = batch.column(0)
            data, offsets = arrow.texts(batch.column(1), lower=True)
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1], arrow.LETTERS)
                signed = signatures(*shingles(words), high - low, size)
                used = np.flatnonzero(np.diff(words.first))
                parts = signed[used].reshape(len(used), bands, size // bands)
                with np.errstate(over="ignore"):
                    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
                    for k in range(parts.shape[2]):
                        keys = arrow.mix(keys * _SLOT + parts[:, :, k])
                columns = [pa.array(arrow.signed(keys.ravel())), nodes.take(pa.array(np.repeat(low + used, bands)))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "node"])

    return rows.select("node", "text").mapInArrow(find, "bucket long, node binary").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (`a`, `b`) whose texts are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def sets(column, low, high, data, offsets):
        doc, element, weight = shingles(arrow.words(data, offsets[low : high + 1], arrow.LETTERS))
        first = np.searchsorted(doc, np.arange(high - low + 1))
        return [(element[x:y], weight[x:y]) for x, y in zip(first[:-1], first[1:])]

    def check(batches):
        for batch in batches:
            texts = [arrow.texts(batch.column(k), lower=True) for k in (2, 3)]
            for low, high in arrow.groups(texts[0][1] + texts[1][1]):
                a, b = (sets(None, low, high, *t) for t in texts)
                good = [low + i for i, (x, y) in enumerate(zip(a, b)) if similarity(x, y) >= threshold]
                at = pa.array(good, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    return both.mapInArrow(check, "a binary, b binary")


def near_copies(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, size: int = COMPONENTS,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `node` (stands for its text), `class_of` (a node that stands for its class),
    `class_id`, the least id of the class, `class_rows`, its rows, and `class_texts`, different texts in it.

    A class holds texts linked by a similarity of at least `threshold` over weighted runs of five
    words (letters and digits, case ignored), directly or through others; equal texts are always
    in one class. Null text is empty; texts without words are linked to equal ones only, shorter texts
    than a run are one run. Null ids give no class its id unless all are null; repeated rows each
    have their row; an empty table gives no rows; other columns are not read. A link at the threshold is
    missed with a chance of (1 - threshold^rows)^bands, 3 in 100,000 as set.
    """
    spark = docs.sparkSession
    arrow.ship(spark)
    named = arrow.renamed(docs, doc_id=doc_id, text=text).withColumn("node", node_of("text"))
    members = settle(_buckets(named, bands, size), scratch_path(spark, "buckets"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1")
    members = settle(members.join(sizes, "bucket"), scratch_path(spark, "members"))
    meets = members.groupBy("node").agg(F.sum("many").alias("meets"))
    members = settle(members.drop("many").join(meets, "node"), scratch_path(spark, "members"))
    nodes = measured(meets.select("node"), "nodes", "48")
    texts = joined(named.select("node", "text"), nodes, ["node"], "left_semi").dropDuplicates(["node"])
    texts = settle(texts, scratch_path(spark, "texts"))

    best = members.groupBy("bucket").agg(F.min(F.struct(-F.col("meets"), "node")).alias("head"))
    links, roots = _linked(_to_head(members, best), None, texts, threshold)
    for last in (False, True) if roots is not None else ():
        here = _open(members if not last else here.drop("root"), roots)
        if here.isEmpty():
            break
        if not last:
            own = texts.join(here.select("node").distinct(), "node", "left_semi")
            facts = settle(_facts(own), scratch_path(spark, "facts"))
            here = here.join(facts, "node").filter(F.col("own") <= 1 - threshold + 1e-9)
            here = _open(here.drop("root"), roots)
            best = here.groupBy("bucket").agg(F.min(F.struct("own", "node", "root", "weight", "has", "shared")).alias("head"))
            pairs = _to_head(here, best, threshold)
        else:
            pairs = _across(here, threshold)
        links, roots = _linked(pairs, links, texts, threshold)
    ids = named.select("doc_id", "node")
    reps = ids.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    if roots is None:
        reps = reps.withColumn("root", F.col("node"))
    else:
        reps = reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    reps = settle(reps, scratch_path(spark, "nodes"))
    classes = reps.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("rows").alias("class_rows"), F.count("*").alias("class_texts")
    )
    classes = reps.select("node", "root").join(classes, "root").withColumnRenamed("root", "class_of")
    return ids.join(classes, "node").select("doc_id", "node", "class_of", "class_id", "class_rows", "class_texts")


def _to_head(members: DataFrame, heads: DataFrame, threshold: float | None = None) -> DataFrame:
    """Each member of a bucket with its head; with a threshold only those it may be linked to."""
    rows = members.join(heads, "bucket").filter(F.col("node") != F.col("head.node"))
    if threshold is not None:
        rows = rows.filter((F.col("root") != F.col("head.root")) & _may_link("", "head.", threshold))
    return rows.select(F.col("node").alias("a"), F.col("head.node").alias("b"))


def _may_link(a: str, b: str, threshold: float) -> Column:
    """Whether the facts of two texts, under two prefixes of their columns, leave them room to be similar."""

    def room(x: Column, y: Column) -> Column:
        return (1 - x) * (1 - y) >= (threshold - 1e-9) * (1 - x * y)

    def lacking(x: Column, y: Column) -> Column:
        """The least weight of a group's shingles that the other text does not have."""
        fewer = x.bitwiseAND(0xFFFF) - y.bitwiseAND(0xFFFF)
        return F.when(y == 0, F.shiftright(x, 16)).otherwise(F.greatest(fewer, F.lit(0))).cast("long")

    def absent(a: str, b: str) -> Column:
        """The least weight, to a power of two, of the groups of which the other text has nothing."""
        steps, places = [1] + [x // 2 for x in LEVELS[1:]], range(GROUPS // 64)
        none = [F.bitwise_not(F.get(f"{b}has", k)) for k in places]
        bits = [F.bit_count(F.get(f"{a}has", n * len(places) + k).bitwiseAND(none[k])) * s for n, s in enumerate(steps) for k in places]
        return reduce(Column.__add__, bits)

    own_a, own_b = F.col(f"{a}own"), F.col(f"{b}own")
    by_bits = room(own_a + absent(a, b) / F.col(f"{a}weight"), own_b + absent(b, a) / F.col(f"{b}weight"))
    both = F.zip_with(f"{a}shared", f"{b}shared", lambda x, y: lacking(x, y) + F.shiftleft(lacking(y, x), 32))

    def enough(total: Column) -> Column:
        more_a = total.bitwiseAND((1 << 32) - 1) / F.col(f"{a}weight")
        return room(own_a + more_a, own_b + F.shiftright(total, 32) / F.col(f"{b}weight"))

    # The sum is there once: what a condition has twice is made ahead of it, for every pair.
    by_weight = F.aggregate(both, F.lit(0).cast("long"), lambda n, x: n + x, enough)
    return room(own_a, own_b) & by_bits & by_weight


def _linked(pairs: DataFrame, links: DataFrame | None, texts: DataFrame, threshold: float):
    """All links with those among the pairs, and the components they make."""
    spark = pairs.sparkSession
    pairs, n, _ = measured(pairs.distinct(), "pairs")
    if n:
        found = settle(_verified(pairs, texts, threshold), scratch_path(spark, "verified"))
        links = found if links is None else links.unionByName(found)
    return links, components(links) if links is not None else None


def _facts(texts: DataFrame) -> DataFrame:
    """Of each text: `own`, the share of its shingles, by weight, that no other of the texts has; `weight`, that
    of all; `shared`, by group, the weight (from bit 16 on) and number of those that others have too; `has`, bit maps of
    the groups that weigh as much as each of LEVELS."""

    def sets(batch):
        data, offsets = arrow.texts(batch.column(1), lower=True)
        for low, high in arrow.groups(offsets):
            yield low, high, *shingles(arrow.words(data, offsets[low : high + 1], arrow.LETTERS))

    def each(batches):
        for batch in batches:
            for low, _, doc, element, weight in sets(batch):
                columns = [batch.column(0).take(pa.array(low + doc)), pa.array(arrow.signed(element)), pa.array(weight.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "element", "weight"])

    def counted(batches):
        for batch in batches:
            for low, high, doc, element, weight in sets(batch):
                n = high - low
                place = doc * GROUPS + (element % np.uint64(GROUPS)).astype(np.int64)
                one, all_ = (np.bincount(place, w, minlength=n * GROUPS).astype(np.int64) for w in (None, weight))
                columns = [batch.column(0).slice(low, n), pa.array(np.bincount(doc, weight, minlength=n).astype(np.int64)),
                           arrow.as_lists(pa.array(one + (all_ << 32)), np.arange(0, n * GROUPS + 1, GROUPS))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "weight", "every"])

    rows = texts.select("node", "text")
    once = rows.mapInArrow(each, "node binary, element long, weight long").groupBy("element")
    once = once.agg(F.count("*").alias("n"), F.min(F.struct("node", "weight")).alias("of")).filter("n = 1")
    group = F.pmod("element", F.lit(GROUPS)).cast("int")
    own = once.groupBy("of.node", group.alias("g")).agg(F.sum("of.weight").alias("weight"), F.count("*").alias("n"))
    own = own.groupBy("node").agg(
        F.sum("weight").alias("own_weight"),
        F.map_from_entries(F.collect_list(F.struct("g", F.col("n") + F.shiftleft("weight", 32)))).alias("own_by_group"),
    )
    every = rows.mapInArrow(counted, "node binary, weight long, every array<long>")

    def shared(x: Column, g: Column) -> Column:
        left = x - F.coalesce(F.try_element_at("own_by_group", g), F.lit(0))
        weight, n = F.least(F.shiftright(left, 32), F.lit(0x7FFF)), F.least(left.bitwiseAND((1 << 32) - 1), F.lit(0xFFFF))
        return (F.shiftleft(weight, 16) + n).cast("int")

    own_share = F.coalesce(F.col("own_weight"), F.lit(0)) / F.col("weight")
    rows = every.join(own, "node", "left").select("node", own_share.alias("own"), "weight", F.transform("every", shared).alias("shared"))

    def has(level: int, k: int) -> Column:
        heavy = lambda x: F.when(F.shiftright(x, 16) >= level, F.lit(1)).otherwise(0).cast("long")
        # Bits move up by one for each further group.
        return F.aggregate(F.slice("shared", 64 * k + 1, 64), F.lit(0).cast("long"), lambda n, x: F.shiftleft(n, 1).bitwiseOR(heavy(x)))

    return rows.withColumn("has", F.array(*[has(level, k) for level in LEVELS for k in range(GROUPS // 64)]))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that lie in several components, with their `root`."""
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return settle(rows.join(several.select("bucket"), "bucket", "left_semi"), scratch_path(members.sparkSession, "open"))


def _across(members: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a bucket in different components that may be linked: of each bucket all but its largest
    component, against all of it. A pair is taken in the first bucket it shares."""
    sizes = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"))
    keys = members.groupBy("node").agg(F.collect_set("bucket").alias("keys"))
    members = members.join(keys, "node").join(largest, "bucket").withColumn("few", F.col("root") != F.col("most.root"))
    of = lambda s: members.select("bucket", "few", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "root", "keys", "own", "weight", "has", "shared")])
    one, two = of("a").filter("few").withColumnRenamed("few", "a_few"), of("b").withColumnRenamed("few", "b_few")
    # Of two members outside the largest component the pair would come twice.
    once = (~F.col("b_few")) | (F.col("a_node") < F.col("b_node"))
    first = F.array_min(F.array_intersect("a_keys", "b_keys")) == F.col("o.bucket")
    meet = (F.col("o.bucket") == F.col("t.bucket")) & (F.col("a_root") != F.col("b_root")) & once
    pairs = one.alias("o").join(two.alias("t"), meet & _may_link("a_", "b_", threshold) & first)
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, with all their columns as they are, one of each class of near copies: that of
    the least id (null ids last; among rows of one id, by the text's hash; of repeated rows any one).
    Options are those of `near_copies`."""
    found = near_copies(docs, **options)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    groups = found.groupBy("class_of", "doc_id", "node").agg(F.count("*").alias("rows"))
    keep = groups.groupBy("class_of").agg(F.min_by(F.struct("doc_id", "node", "rows"), rank).alias("k"))
    keep = measured(keep.select(_key("k.doc_id").alias("_key"), F.col("k.node").alias("_node"), F.col("k.rows").alias("_rows")), "kept", "64")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        _key(options.get("doc_id", "doc_id")).alias("_key"), node_of(options.get("text", "text")).alias("_node"),
    )
    rows = joined(rows, keep, ["_key", "_node"], "inner")
    several = rows.filter("_rows > 1").dropDuplicates(["_key", "_node"])
    return rows.filter("_rows = 1").unionByName(several).select("_row.*")


def _key(doc_id: str) -> Column:
    """An id as text; a null id is a key like others."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
