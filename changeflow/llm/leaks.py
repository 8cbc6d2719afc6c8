"""Benchmark decontamination: passages of the training texts that hold enough words of a test item are
aligned with it (Smith-Waterman), so that copies with words changed, put in or left out are found too.

An alignment that reaches the threshold matches `_least` of the item's words, in any order of the edits.
So a passage with fewer of them is never aligned, and none that reaches the threshold is lost. Of an
item only the words rarest in the training texts are looked up first: with the most frequent ones left
out, at least half as many must still be there. A bit map of fixed size lets tasks drop other words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.llm.lists import BROADCAST_BYTES, BROADCAST_ROWS, joined, measured
from changeflow.session import scratch_path, settle

#: Items of fewer words match nothing.
FEWEST = 3
#: Items are aligned in segments of so many words, against passages that hold every copy whole, also one
#: of twice the words, wherever it begins.
SEGMENT = 64
PASSAGE = 3 * SEGMENT
THRESHOLD = 0.5
MATCH, MISS, GAP = 2, -1, 1
#: Bits of the map: 64 for each seed, within these powers of two; the larger is 32 MB.
LEAST_BITS, MOST_BITS = 20, 28


def _words(data: np.ndarray, offsets: np.ndarray) -> arrow.Words:
    return arrow.words(data, offsets, arrow.LETTERS)


def _segments(items: DataFrame) -> DataFrame:
    """`item_id`, `segment` and its `words`; the last segment ends with the item."""

    def cut(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(1), lower=True)
            at, number, lists = [], [], []
            for low, high in arrow.groups(offsets):
                words = _words(data, offsets[low : high + 1])
                hashes = arrow.signed(words.hashes)
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    starts = [*range(a, max(a, b - SEGMENT), SEGMENT), max(a, b - SEGMENT)]
                    for k, s in enumerate(starts if b - a >= FEWEST else []):
                        at.append(low + i)
                        number.append(k)
                        lists.append(hashes[s : min(b, s + SEGMENT)])
            first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            values = pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), arrow.as_lists(values, first)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "segment", "words"])

    kind = dict(items.dtypes)["item_id"]
    return items.mapInArrow(cut, f"item_id {kind}, segment int, words array<long>")


def _least(size, threshold: float):
    """Words of a segment that any alignment with `threshold` of its score matches."""
    return F.greatest(F.ceil(size * threshold - 1e-9), F.lit(1)).cast("int")


def _bit_map(grams: DataFrame, n: int) -> np.ndarray:
    """One bit for each value of the leading bits of the n-grams; sent to the driver as words of 64."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * max(n, 1)).bit_length()))
    place = F.shiftrightunsigned("gram", 64 - bits)
    words = grams.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")
    ).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return out


def _marked(grams: np.ndarray, map_: np.ndarray) -> np.ndarray:
    place = grams >> np.uint64(64 - (len(map_).bit_length() + 5))
    return (map_[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _occurrences(docs: DataFrame, map_: np.ndarray) -> DataFrame:
    """How often words that the map lets pass occur in the texts."""
    sent = docs.sparkSession.sparkContext.broadcast(map_)

    def count(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(0), lower=True)
            for low, high in arrow.groups(offsets):
                hashes = _words(data, offsets[low : high + 1]).hashes
                gram, n = np.unique(hashes[_marked(hashes, sent.value)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(arrow.signed(gram)), pa.array(n)], ["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram long, n long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"))


def seeds(docs: DataFrame, segments: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`gram`, `item_id`, `segment`: words of each segment, `many` times in it; passages that hold fewer
    than `need` of a segment's words among these cannot reach `threshold`."""
    size = F.size("words")
    least = _least(size, threshold)
    need = F.greatest(F.floor(least / 2), F.lit(1)).cast("int")
    grams = segments.select("item_id", "segment", need.alias("need"), (size - least + need).alias("kept"), F.explode("words").alias("gram"))
    grams, _, _ = measured(grams, "grams")
    single, n, _ = measured(grams.select("gram").distinct(), "words")
    counts = _occurrences(docs, _bit_map(single, n))
    grams = grams.join(counts, "gram", "left")
    rank = F.row_number().over(Window.partitionBy("item_id", "segment").orderBy(F.coalesce("n", F.lit(0)), "gram"))
    grams = grams.withColumn("rank", rank).filter("rank <= kept")
    return grams.groupBy("gram", "item_id", "segment", "need").agg(F.count("*").cast("int").alias("many"))


def _parts(words: arrow.Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words `hit` the passages they lie in: text, number in the text, and word. A passage begins
    every SEGMENT words, until one reaches the end of the text."""
    doc = words.doc()[hit]
    part = (hit - words.first[doc]) // SEGMENT
    last = np.maximum(-(-(np.diff(words.first) - PASSAGE) // SEGMENT), 0)[doc]
    back = np.repeat(np.arange(PASSAGE // SEGMENT), len(hit))
    doc, part, hit, last = (np.tile(x, PASSAGE // SEGMENT) for x in (doc, part, hit, last))
    part = part - back
    good = (part >= 0) & (part <= last)
    return doc[good], part[good], hit[good]


@dataclass
class Index:
    """Segments of the items and their seeds, for tables small enough to be sent to every executor."""

    item_id: pa.Array
    segment: np.ndarray
    words: np.ndarray
    size: np.ndarray
    need: np.ndarray
    map: np.ndarray
    #: Sorted seeds, and where the postings of each begin; segment and number of each posting.
    gram: np.ndarray
    first: np.ndarray
    holder: np.ndarray
    many: np.ndarray

    def candidates(self, words: arrow.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, passage and segment where the passage has as many seeds as the segment needs."""
        none = np.zeros(0, np.int64)
        if not len(self.gram) or not len(words.start):
            return none, none, none
        hit = np.flatnonzero(_marked(words.hashes, self.map))
        at = np.searchsorted(self.gram, words.hashes[hit]).clip(max=len(self.gram) - 1)
        hit = hit[self.gram[at] == words.hashes[hit]]
        doc, part, hit = _parts(words, hit)
        at = np.searchsorted(self.gram, words.hashes[hit])
        base = np.concatenate(([0], np.cumsum(np.diff(words.first) // SEGMENT + 1)))
        key = np.unique((base[doc] + part) * len(self.gram) + at)
        passage, at = key // len(self.gram), key % len(self.gram)
        n = self.first[at + 1] - self.first[at]
        posting = np.repeat(self.first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        key = np.repeat(passage, n) * len(self.size) + self.holder[posting]
        key, where = np.unique(key, return_inverse=True)
        passage, holder = key // len(self.size), key % len(self.size)
        good = np.bincount(where, self.many[posting], minlength=len(key)) >= self.need[holder]
        passage, holder = passage[good], holder[good]
        doc = np.searchsorted(base, passage, "right") - 1
        return doc, passage - base[doc], holder


def _index(segments: DataFrame, chosen: DataFrame, map_: np.ndarray) -> Index:
    rows = segments.select("item_id", "segment", "words").withColumn("place", F.row_number().over(Window.orderBy("item_id", "segment")) - 1)
    same = [F.col("p.item_id").eqNullSafe(F.col("q.item_id")), F.col("p.segment") == F.col("q.segment")]
    rows = settle(rows, scratch_path(segments.sparkSession, "index"))
    found = chosen.alias("p").join(rows.alias("q"), same).select("gram", "many", "need", "place").toArrow()
    rows = rows.orderBy("place").toArrow().combine_chunks()
    column = lambda t, c: t.column(c).to_numpy()
    gram, place = column(found, "gram").view(np.uint64), column(found, "place")
    order = np.lexsort((place, gram))
    single, first = np.unique(gram[order], return_index=True)
    need = np.ones(len(rows), np.int64)
    need[place] = column(found, "need")
    lists = rows.column("words").combine_chunks() if len(rows) else pa.array([], pa.list_(pa.int64()))
    words, size = _padded(lists, SEGMENT, 0)
    ids = rows.column("item_id")
    ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
    return Index(ids, column(rows, "segment"), words, size, need, map_, single, np.append(first, len(gram)),
                 place[order].astype(np.int64), column(found, "many")[order])


def _in_place(docs: DataFrame, index: Index, threshold: float, kind: str) -> DataFrame:
    """Alignments that reach the threshold, found while the texts are read: nothing is shuffled for them."""
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches):
        index = sent.value
        for batch in batches:
            data, offsets = arrow.texts(batch.column(2), lower=True)
            for low, high in arrow.groups(offsets):
                words = _words(data, offsets[low : high + 1])
                hashes = np.append(arrow.signed(words.hashes), 1)
                every = index.candidates(words)
                for k in range(0, len(every[0]), 1024):
                    doc, part, holder = (x[k : k + 1024] for x in every)
                    start = words.first[doc] + part * SEGMENT
                    place = start[:, None] + np.arange(PASSAGE)
                    passage = hashes[np.where(place < words.first[doc + 1][:, None], place, len(hashes) - 1)]
                    good, share, end = _reaching(index.words[holder], passage, index.size[holder], threshold)
                    at = pa.array(low + doc[good])
                    columns = [batch.column(c).take(at) for c in (0, 1)]
                    columns += [index.item_id.take(pa.array(holder[good])), pa.array(index.segment[holder[good]].astype(np.int32))]
                    columns += [pa.array(share), pa.array(part[good] * SEGMENT + end)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "item_id", "segment", "score", "end_word"])

    return docs.select("doc_id", "t", "text").mapInArrow(find, kind)


def _passages(docs: DataFrame, map_: np.ndarray) -> DataFrame:
    """Overlapping passages with a marked word: `doc_id`, `t`, `begin`, `words`, and the marked ones as `grams`."""
    kind = dict(docs.dtypes)["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(map_)

    def find(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(2), lower=True)
            for low, high in arrow.groups(offsets):
                words = _words(data, offsets[low : high + 1])
                if not len(words.start):
                    continue
                doc, part, hit = _parts(words, np.flatnonzero(_marked(words.hashes, sent.value)))
                order = np.lexsort((hit, part, doc))
                doc, part, hit = doc[order], part[order], hit[order]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (part[1:] != part[:-1])
                at = np.flatnonzero(new)
                begin = part[at] * SEGMENT
                start = words.first[doc[at]] + begin
                size = np.minimum(start + PASSAGE, words.first[doc[at] + 1]) - start
                inside = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                rows = pa.array(low + doc[at])
                columns = [
                    batch.column(0).take(rows), batch.column(1).take(rows), pa.array(begin),
                    arrow.as_lists(pa.array(arrow.signed(words.hashes[inside])), np.concatenate(([0], np.cumsum(size)))),
                    arrow.as_lists(pa.array(arrow.signed(words.hashes[hit])), np.append(at, len(hit))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "begin", "words", "grams"])

    return docs.select("doc_id", "t", "text").mapInArrow(
        find, f"doc_id {kind}, t long, begin long, words array<long>, grams array<long>"
    )


def align(items: np.ndarray, passages: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each item with its passage, as a share of the item matched to itself, and
    the passage's word where it ends. Rows are padded: items by 0, passages by 1, which match nothing.
    A row of the table takes gaps along the passage by a running maximum."""
    n, width = passages.shape
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    slope = GAP * np.arange(1, width + 1, dtype=np.int32)
    for i in range(items.shape[1]):
        here = i < lengths
        equal = np.where(passages == items[:, i : i + 1], MATCH, MISS)
        row = np.maximum(np.maximum(above[:, :-1] + equal, above[:, 1:] - GAP), 0)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        row[~here] = 0
        top = row.argmax(axis=1)
        score = row[np.arange(n), top]
        better = score > best
        best, end = np.where(better, score, best), np.where(better, top, end)
        above[:, 1:] = row
    return best / (MATCH * np.maximum(lengths, 1)), end


def _most(inside: np.ndarray) -> np.ndarray:
    """The most that an alignment can score over the words of each row, of which those `inside` are known to
    the other side: a word between its ends that it does not match costs a miss or a gap."""
    total = np.cumsum(np.where(inside, MATCH, -min(-MISS, GAP)).astype(np.int32), axis=1)
    return (total - np.minimum(np.minimum.accumulate(total, axis=1), 0)).max(axis=1, initial=0)


def _reaching(items: np.ndarray, passages: np.ndarray, lengths: np.ndarray, threshold: float):
    """Rows whose alignment reaches the threshold, with share and end. Only rows are aligned in which, on
    either side, a run of words holds so many of the other side's that it can score as much."""
    held, met = np.zeros(items.shape, dtype=bool), np.zeros(passages.shape, dtype=bool)
    for i in range(int(lengths.max(initial=0))):
        equal = passages == items[:, i : i + 1]
        held[:, i] = equal.any(axis=1) & (i < lengths)
        met |= equal
    least = threshold * MATCH * lengths - 1e-9
    rows = np.flatnonzero((_most(held) >= least) & (_most(met) >= least))
    share, end = align(items[rows], passages[rows], lengths[rows])
    good = share >= threshold
    return rows[good], share[good], end[good]


def _padded(lists: pa.ListArray, width: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    size = lists.value_lengths().to_numpy()
    out = np.full((len(size), width), fill, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out, size


def _by_join(docs: DataFrame, segments: DataFrame, chosen: DataFrame, map_: np.ndarray, threshold: float, ddl: str) -> DataFrame:
    """The same alignments where the items are too many to be sent: passages and segments are shuffled."""
    passages = settle(_passages(docs, map_), scratch_path(docs.sparkSession, "passages"))
    passages = passages.dropDuplicates(["doc_id", "t", "begin"])
    found = passages.select("doc_id", "t", "begin", F.explode(F.array_distinct("grams")).alias("gram"))
    pairs = found.join(chosen, "gram").groupBy("doc_id", "t", "begin", "item_id", "segment", "need").agg(F.sum("many").alias("many"))
    pairs = pairs.filter("many >= need")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in ("doc_id", "t", "begin")]
    pairs = pairs.alias("p").join(passages.alias("q"), same).select("p.*", F.col("q.words").alias("passage"))
    same = [F.col("p.item_id").eqNullSafe(F.col("q.item_id")), F.col("p.segment") == F.col("q.segment")]
    pairs = pairs.alias("p").join(segments.alias("q"), same).select("p.*", F.col("q.words").alias("words"))

    def score(batches):
        for batch in batches:
            for low in range(0, len(batch), 1024):
                part = batch.slice(low, 1024)
                passage, _ = _padded(part.column(5), PASSAGE, 1)
                item, size = _padded(part.column(6), SEGMENT, 0)
                good, share, end = _reaching(item, passage, size, threshold)
                at = pa.array(good)
                columns = [part.column(k).take(at) for k in (0, 1, 3, 4)]
                columns += [pa.array(share), pa.array(part.column(2).to_numpy()[good] + end)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t", "item_id", "segment", "score", "end_word"])

    return pairs.select("doc_id", "t", "begin", "item_id", "segment", "passage", "words").mapInArrow(score, ddl)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and an item it holds: `doc_id`, `t` (hash of the text), `item_id`, `score` of
    the best alignment of a passage with a segment of the item (1 for a whole copy), `segment`, and
    `end_word`, the document's word where it ends.

    Words are runs of letters and digits, case ignored. Null and empty texts and items, and items
    of fewer than three words, match nothing; null ids are ids like others; rows of one id are told apart by
    their text, repeated rows give one pair; equal items are each reported; empty tables give no
    pairs; other columns are not read; the whole of every text is searched.
    """
    spark = docs.sparkSession
    arrow.ship(spark)
    docs = arrow.renamed(docs, doc_id=doc_id, text=text).withColumn("t", F.xxhash64("text"))
    items = arrow.renamed(items, item_id=item_id, text=item_text)
    segments = _segments(items).dropDuplicates(["item_id", "segment"])
    segments, _, size = measured(segments, "segments", "8 * size(words)")
    chosen, n, _ = measured(seeds(docs, segments, threshold), "seeds")
    map_ = _bit_map(chosen, n)
    ddl = (f"doc_id {dict(docs.dtypes)['doc_id']}, t long, item_id {dict(items.dtypes)['item_id']}, "
           "segment int, score double, end_word long")
    if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        rows = _in_place(docs, _index(segments, chosen, map_), threshold, ddl)
    else:
        rows = _by_join(docs, segments, chosen, map_, threshold, ddl)
    best = F.max(F.struct("score", (-F.col("end_word")).alias("end"), (-F.col("segment")).alias("segment"))).alias("b")
    return rows.groupBy("doc_id", "t", "item_id").agg(best).select(
        "doc_id", "t", "item_id", "b.score", (-F.col("b.segment")).alias("segment"), (-F.col("b.end")).alias("end_word")
    )


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns as they are, that hold none of the items."""
    found = leaks(docs, items, threshold).select(_key("doc_id").alias("_key"), F.col("t").alias("_t")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _key("doc_id").alias("_key"), F.xxhash64("text").alias("_t")
    )
    return joined(rows, measured(found, "leaks", "64"), ["_key", "_t"], "left_anti").select("_row.*")


def _key(doc_id: str):
    """An id as text; a null id is a key like others."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
