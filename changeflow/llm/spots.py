"""Fingerprints of spot signatures: each common word (an anchor) with the chain of content words that
follow it. The anchors are the most frequent words of the corpus. A fingerprint is the set of a
text's signatures; equal texts have equal fingerprints, and edits change only signatures nearby.

Fingerprints are compared by Jaccard similarity. To find similar ones, sets are partitioned by
length, within a partition only sets that share one of their rarest signatures meet, and a pair whose
lengths alone rule the similarity out is not compared.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.llm.frequent import frequent_words
from changeflow.llm.order import ordered

ANCHORS, CHAIN = 48, 2
#: Where so many words hold no anchor, each word is one.
QUIET = 8
LEAST = -(1 << 63)
#: Ranges of documents for each task that compares neighbours.
RANGES = 4
_STEP = np.uint64(0x9FB21C651E98DF25)


def signature_sets(texts: pa.Array, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets of 32-bit signatures of texts in a row: the signatures, sorted within each text, and
    where each text's begin. A text without a whole chain has one, of all of it."""
    data, offsets = arrow.texts(texts, lower=True)
    parts, counts = [], []
    for low, high in arrow.groups(offsets):
        words = arrow.words(data, offsets[low : high + 1], arrow.LETTERS)
        doc, n = words.doc(), high - low
        at = np.searchsorted(anchors, words.hashes).clip(max=max(len(anchors) - 1, 0))
        anchor = anchors[at] == words.hashes if len(anchors) else np.zeros(len(doc), bool)
        place = np.arange(len(doc))
        last = np.maximum.accumulate(np.where(anchor, place, -1))
        start = words.first[doc]
        quiet = place - np.maximum(last, start - 1) >= QUIET
        spot = np.flatnonzero(anchor | quiet)
        content = np.flatnonzero(~anchor)
        nth = np.searchsorted(content, spot, "right")
        chain = words.hashes[spot]
        whole = nth + CHAIN <= len(content)
        spot, nth, chain = spot[whole], nth[whole], chain[whole]
        same = doc[content[nth + CHAIN - 1]] == doc[spot] if len(spot) else np.zeros(0, bool)
        spot, nth, chain = spot[same], nth[same], chain[same]
        with np.errstate(over="ignore"):
            for k in range(CHAIN):
                chain = arrow.mix(chain * _STEP + words.hashes[content[nth + k]])
        key = doc[spot].astype(np.uint64) << np.uint64(32) | chain >> np.uint64(32)
        bare = np.flatnonzero(np.bincount(doc[spot], minlength=n) == 0)
        own = [int.from_bytes(hashlib.blake2b(data[offsets[low + i] : offsets[low + i + 1]].tobytes(), digest_size=4).digest()) for i in bare]
        key = np.unique(np.concatenate((key, bare.astype(np.uint64) << np.uint64(32) | np.array(own, dtype=np.uint64))))
        parts.append((key & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        counts.append(np.bincount((key >> np.uint64(32)).astype(np.int64), minlength=n))
    first = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), first


def _hex(sets: np.ndarray, first: np.ndarray) -> list[str]:
    text = sets.astype(">u4").tobytes().hex()
    return [text[8 * a : 8 * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Jaccard similarity of the sets of two lists, one by one."""
    sizes = [np.diff(x[1]) for x in (a, b)]
    keys = [np.repeat(np.arange(len(n)), n) << 32 | x[0].astype(np.int64) for x, n in zip((a, b), sizes)]
    both = np.bincount(np.intersect1d(*keys, assume_unique=True) >> 32, minlength=len(sizes[0]))
    return both / np.maximum(sizes[0] + sizes[1] - both, 1)


def fingerprints(docs: DataFrame, anchors: np.ndarray | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id` and `fingerprint`, the sorted signatures as eight hex digits each.

    Null text is empty; texts without a chain have one signature of the whole text, so they equal only
    equal texts (case ignored); null ids and repeated rows are rows like others; an empty table gives no
    rows; other columns are not read; a text of any length is read whole.
    """
    arrow.ship(docs.sparkSession)
    rows = arrow.renamed(docs, doc_id=doc_id, text=text)
    anchors = frequent_words(rows, ANCHORS) if anchors is None else anchors

    def find(batches):
        for batch in batches:
            found = _hex(*signature_sets(batch.column(1), anchors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(find, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string")


def signatures(fingerprint: str | Column) -> Column:
    """The signatures of a fingerprint as an array."""
    column = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    starts = F.sequence(F.lit(1), F.greatest(F.length(column) - 7, F.lit(1)), F.lit(8))
    return F.transform(starts, lambda i: F.substring(column, i, F.lit(8)))


def similar(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs `a` < `b` of different fingerprints (column `fingerprint`) with `likeness` of at least the
    threshold. Equal fingerprints are one: join the pairs with the documents that have them.

    Two sets that alike differ in length by a factor of at most 1 / threshold, so they lie in the same
    partition of a geometric series or in neighbouring ones, and they share one of the
    n - threshold * n + 1 rarest signatures of either.
    """
    sets = prints.select("fingerprint").filter("fingerprint is not null").distinct()
    sets = sets.withColumn("signs", signatures("fingerprint")).withColumn("n", F.size("signs"))
    signs = sets.select("fingerprint", "n", F.explode("signs").alias("sign"))
    common = signs.groupBy("sign").agg(F.count("*").alias("df"))
    by_rarity = F.sort_array(F.collect_list(F.struct("df", "sign")))
    ranked = signs.join(common, "sign").groupBy("fingerprint", "n").agg(by_rarity.alias("signs"))
    keep = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    part = F.floor(F.log(F.col("n").cast("double")) / -math.log(threshold) + 1e-9).cast("int")
    heads = ranked.select("fingerprint", "n", part.alias("part"), F.explode(F.slice("signs", F.lit(1), keep)).alias("head"))
    heads = heads.select("fingerprint", "n", "part", F.col("head.sign").alias("sign"))
    lower = heads.select(F.col("fingerprint").alias("a"), F.col("n").alias("na"), "part", "sign")
    upper = heads.select(F.col("fingerprint").alias("b"), F.col("n").alias("nb"), F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"), "sign", F.col("part").alias("own"))
    fits = (F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-9) & (F.col("a") != F.col("b"))
    # A pair of one partition is met from both sides: once is enough.
    fits = fits & ((F.col("own") != F.col("part")) | (F.col("a") < F.col("b")))
    pairs = lower.join(upper, ["part", "sign"]).filter(fits)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = F.size(F.array_intersect(signatures("a"), signatures("b")))
    union = F.size(signatures("a")) + F.size(signatures("b")) - both
    return pairs.withColumn("likeness", both / union).filter(F.col("likeness") >= threshold)


def against_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited` and
    `near_next`. The edited text has its last third of characters replaced by the first as many of the
    next document by falling id (after the last: the first).

    Null text is empty. Null ids come last, rows of one id by falling hash of the text; repeated rows
    follow each other; a single row is its own next. An empty table gives no rows; other columns are
    not read. Texts are shuffled once, into ranges of that order; the first row of each range is also
    sent to the range before it, so no task needs another's rows.
    """
    spark = docs.sparkSession
    arrow.ship(spark)
    rows = arrow.renamed(docs, doc_id=doc_id, text=text)
    kind = dict(rows.dtypes)["doc_id"]
    anchors = frequent_words(rows, ANCHORS)
    rows = rows.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))).withColumn("t", F.xxhash64("text"))
    by = [F.desc("key"), F.desc("t")]
    # Ranges are cut by the keys alone, but for the texts: several for each task that will read them.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = ordered(rows.select("key", "t"), by, "keys", RANGES * tasks)
    heads = small.groupBy("_part").agg(F.min_by(F.struct("key", "t"), "_row").alias("head")).collect()
    # Ranges begin at these keys; turned round, they rise.
    starts = sorted({(-1 - r["head"]["key"], -1 - r["head"]["t"]) for r in heads})

    def deal(batches):
        for batch in batches:
            keys, hashes = (batch.column(i).to_pylist() for i in (2, 3))
            own = [(-1 - k, -1 - t) for k, t in zip(keys, hashes)]
            part = [bisect_right(starts, k) - 1 for k in own]
            heads = [i for i, k in enumerate(own) if starts[part[i]] == k]
            at = pa.array([*range(len(own)), *heads])
            parts = part + [(part[i] - 1) % len(starts) for i in heads]
            ghost = [False] * len(own) + [True] * len(heads)
            columns = [batch.column(i).take(at) for i in range(4)] + [pa.array(parts, pa.int32()), pa.array(ghost)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "key", "t", "part", "ghost"])

    dealt = rows.select("doc_id", "text", "key", "t").mapInArrow(
        deal, f"doc_id {kind}, text string, key long, t long, part int, ghost boolean"
    )
    dealt = dealt.repartition(tasks, "part").sortWithinPartitions("part", "ghost", *by)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compare(batches):
        held = None
        for batch in batches:
            for low in range(0, len(batch), 1000):
                part = batch.slice(low, 1000)
                table = pa.Table.from_batches([part] if held is None else [held, part]).combine_chunks().to_batches()[0]
                yield from report(table)
                held = table.slice(len(table) - 1)

    def report(batch):
        """All rows but the last, each with the row after it."""
        parts, ghosts = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
        mine = np.flatnonzero((parts[:-1] == parts[1:]) & ~ghosts[:-1])
        if not len(mine):
            return
        column = batch.column(1).fill_null("")
        sets = signature_sets(column, anchors)
        texts = column.to_pylist()
        edited, chars, digests = [], [], []
        for i in mine.tolist():
            n = len(texts[i])
            chars.append(n)
            edited.append(texts[i][: n - n // 3] + texts[i + 1][: n // 3])
            digests.append(hashlib.sha256(edited[-1].encode()).hexdigest())
        other = signature_sets(pa.array(edited, pa.large_string()), anchors)
        own, after = _of(sets, mine), _of(sets, mine + 1)
        columns = [batch.column(0).take(pa.array(mine)), pa.array(chars, pa.int64()), pa.array(digests, pa.string()),
                   pa.array(_hex(*own), pa.string()), pa.array(_hex(*other), pa.string()),
                   pa.array(likeness(own, other)), pa.array(likeness(own, after))]
        yield pa.RecordBatch.from_arrays(columns, names)

    ddl = (f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
    return dealt.select("doc_id", "text", "part", "ghost").mapInArrow(compare, ddl)


def _of(sets: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some of the texts."""
    values, first = sets
    n = first[rows + 1] - first[rows]
    at = np.repeat(first[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return values[at], np.concatenate(([0], np.cumsum(n)))
