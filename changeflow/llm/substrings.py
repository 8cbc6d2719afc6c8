"""Removal of passages that stand earlier in the corpus: seed, extend, keep maximal repeats.

Seeds are winnowed anchors: of the word n-grams in each window of LENGTH words the one of least
hash, so that equal windows have the same anchor at the same place. Anchors that occur once end
there. The others are extended both ways over all windows they are the anchor of (their span):

- equal spans of an anchor are one class; all but the first of a class are repeats as a whole;
- an anchor with several classes has its first spans extended window by window, and a window is a
  repeat if its first occurrence is elsewhere.

Overlapping repeats are then merged into maximal ones. Classes are met by aggregation and a join with
their first member, so a passage in a third of all documents costs a row per occurrence, never a
row per pair.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.llm.lists import joined, measured
from changeflow.session import scratch_path, settle

LENGTH = 20
GRAM = 5
_P, _Q = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
LAST = (1 << 63) - 1


def anchors(words: arrow.Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor n-gram and first and last window of each span."""
    room = words.room()
    starts = np.flatnonzero(room >= length)
    if not len(starts):
        return starts, starts, starts
    least = words.runs(gram)
    place = np.arange(len(least))
    width, span = 1, length - gram + 1
    while width < span:
        step = min(width, span - width)
        other, at = np.roll(least, -step), np.roll(place, -step)
        less = other < least
        least, place = np.where(less, other, least), np.where(less, at, place)
        width += step
    place = place[starts]
    new = np.concatenate(([True], place[1:] != place[:-1]))
    return place[new], starts[new], starts[np.concatenate((new[1:], [True]))]


def _spans(words: arrow.Words, length: int, gram: int):
    place, low, high = anchors(words, length, gram)
    return words.runs(gram, 11)[place], low, high


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents under the keys `d`, the id in the order of removal, and `t`, which tells rows of one
    id apart: it is looked at only if there are such rows."""
    rows = arrow.renamed(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    twice = not rows.groupBy("d").count().filter("count > 1").isEmpty()
    return rows.withColumn("t", F.xxhash64("text") if twice else F.lit(0).cast("long"))


def _seeds(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(0))
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1])
                seeds = _spans(words, length, gram)[0]
                yield pa.RecordBatch.from_arrays([pa.array(arrow.signed(seeds))], ["a"])

    return docs.select("text").mapInArrow(find, "a long")


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["a", "s1", "s2", "d", "t", "low", "n"]

    def find(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(2))
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1])
                seeds, first, last = _spans(words, length, gram)
                doc = low + words.doc()[first] if len(first) else first
                # A span is shorter than two windows, so its first and last one hold all of it.
                with np.errstate(over="ignore"):
                    n = (last - first + 1).astype(np.uint64)
                    hashes = [arrow.mix(r[first] * _P + r[last] * _Q + n) if len(first) else n
                              for r in (words.runs(length, k) for k in (1, 2))]
                begin = first - words.first[doc - low] if len(first) else first
                columns = [arrow.signed(seeds), *map(arrow.signed, hashes), keys[0][doc], keys[1][doc],
                           begin.astype(np.int32), n.astype(np.int16)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.select("d", "t", "text").mapInArrow(find, "a long, s1 long, s2 long, d long, t long, low int, n short")


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """Each window of the spans in the column `spans` of the documents, by a hash of 128 bits."""
    names = ["w1", "w2", "d", "t", "low"]

    def find(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(2))
            keys = [batch.column(i).to_numpy() for i in (0, 1)]
            spans = batch.column(3)
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1])
                own = spans.slice(low, high - low)
                doc = np.repeat(np.arange(high - low), own.value_lengths().to_numpy())
                parts = own.flatten()
                begin, n = (parts.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                doc, at = np.repeat(doc, n), np.repeat(begin, n) + _counting(n)
                place = words.first[doc] + at
                columns = [arrow.signed(words.runs(length, k)[place]) for k in (1, 2)]
                columns += [keys[0][low + doc], keys[1][low + doc], at.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.select("d", "t", "text", "spans").mapInArrow(find, "w1 long, w2 long, d long, t long, low int")


def _counting(n: np.ndarray) -> np.ndarray:
    """0 to n[0] - 1, then 0 to n[1] - 1, and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _merged(lists: DataFrame) -> DataFrame:
    """Ranges of words of each document, sorted and without overlap."""

    def merge(batches):
        for batch in batches:
            parts = batch.column(2)
            doc = np.repeat(np.arange(len(parts)), parts.value_lengths().to_numpy())
            low, high = (parts.flatten().field(k).to_numpy().astype(np.int64) for k in (0, 1))
            order = np.lexsort((low, doc))
            doc, low, high = doc[order], low[order], high[order]
            # Ranges of one document lie apart from those of the next by more than any text is long.
            shift = doc << 40
            upto = np.maximum.accumulate(high + shift)
            new = np.concatenate(([True], (low + shift)[1:] > upto[:-1])) if len(low) else np.zeros(0, bool)
            end = np.concatenate((new[1:], [True])) if len(low) else new
            kept = pa.StructArray.from_arrays(
                [pa.array(low[new].astype(np.int32)), pa.array((upto - shift)[end].astype(np.int32))], ["low", "high"]
            )
            first = np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(parts)))))
            columns = [batch.column(0), batch.column(1), arrow.as_lists(kept, first)]
            yield pa.RecordBatch.from_arrays(columns, ["d", "t", "ranges"])

    return lists.mapInArrow(merge, "d long, t long, ranges array<struct<low:int,high:int>>")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Maximal repeats: `d`, `t`, `ranges` (first word, word after the last) of the documents made by
    `_documents` in which a window of `length` words starts earlier elsewhere."""
    shared = _seeds(docs, length, gram).groupBy("a").count().filter("count > 1").select("a")
    shared = measured(shared, "anchors")
    found = settle(joined(_occurrences(docs, length, gram), shared, ["a"], "left_semi"),
                   scratch_path(docs.sparkSession, "spans"))
    place = F.struct("d", "t", "low")
    classes = found.groupBy("a", "s1", "s2").agg(
        F.count("*").alias("many"), F.min(F.struct("d", "t", "low", "n")).alias("head")
    )
    classes = settle(classes, scratch_path(docs.sparkSession, "classes"))
    later = found.join(classes.filter("many > 1").select("a", "s1", "s2", "head"), ["a", "s1", "s2"])
    later = later.filter(place > F.struct("head.d", "head.t", "head.low"))
    whole = later.select("d", "t", "low", (F.col("low") + F.col("n") + length - 1).alias("high"))

    several = classes.groupBy("a").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("a")
    heads = classes.join(several, "a", "left_semi").groupBy("head.d", "head.t").agg(
        F.collect_list(F.struct("head.low", "head.n")).alias("spans")
    )
    heads = measured(heads, "heads", "32 + 8 * size(spans)")
    windows = _windows(joined(docs, heads, ["d", "t"], "inner"), length)
    windows = settle(windows, scratch_path(docs.sparkSession, "windows"))
    firsts = windows.groupBy("w1", "w2").agg(F.count("*").alias("many"), F.min(place).alias("head"))
    later = windows.join(firsts.filter("many > 1"), ["w1", "w2"]).filter(place > F.col("head"))
    single = later.select("d", "t", "low", (F.col("low") + length).alias("high"))
    lists = whole.unionByName(single).groupBy("d", "t").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    return _merged(lists)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text",
                    texts: bool = False) -> DataFrame:
    """Per row: `doc_id`, `n_words`, `n_removed`, `kept_sha256` of the kept words joined by one space,
    and with `texts` the kept words themselves as `kept` and the removed ranges as `repeats`.

    A word is removed if a window of `length` words over it starts earlier too. A null text has no
    words. Null ids come last in that order; rows of one id and other texts are different
    documents, ordered by a hash of the text; repeated rows of one id and text are judged alike.
    Texts shorter than a window stay whole. An empty table gives no rows. Other columns are not read.
    Only lists of ranges of a measured size are broadcast.
    """
    arrow.ship(docs.sparkSession)
    docs = _documents(docs, doc_id, text)
    found = measured(repeats(docs, length, gram), "repeats", "32 + 8 * size(ranges)")
    rows = joined(docs, found, ["d", "t"], "left").select("doc_id", "text", "ranges")
    kind = dict(docs.dtypes)["doc_id"]
    extra = ", kept string, repeats array<struct<low:int,high:int>>" if texts else ""

    def keep(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(1))
            ranges = batch.column(2)
            counts, removed, digests, kept = [], [], [], []
            for i, own in enumerate(ranges.to_pylist()):
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                counts.append(len(words))
                if own:
                    stay = np.ones(len(words), dtype=bool)
                    for r in own:
                        stay[r["low"] : r["high"]] = False
                    words = list(compress(words, stay.tolist()))
                removed.append(counts[-1] - len(words))
                left = b" ".join(words)
                digests.append(hashlib.sha256(left).hexdigest())
                if texts:
                    kept.append(left.decode())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns, names = [*columns, pa.array(kept, pa.string()), ranges], [*names, "kept", "repeats"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string{extra}")
