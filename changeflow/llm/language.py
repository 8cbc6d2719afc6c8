"""Cross-entropy difference: how much better a model of the target texts foretells a text, word by
word, than a model of all texts.

Both are bigram models over all words of the corpus. A word costs its share of what follows the word
before it, smoothed by its share of all words, which is smoothed by an even share. The models are
matched: same vocabulary, same smoothing, and the counts of all texts are scaled to as many words as the
target has, so that smoothing weighs alike in both. A text is never foretold from itself: its own counts
are taken out of a model that has them.

Texts are read once and written as chunks of about a million words, numbered by how often the chunk has them.
A chunk sends each distinct word and pair of words once, with its own counts, to the bucket of its hash;
the bucket adds up and answers with the counts in the same order, without the hashes. So what is written
and shuffled is about a hash of 64 bits, less the bits that follow from their order, for each distinct pair
of a chunk, and a few compressed bytes for each word. Words and pairs are known by 64 bits of hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.llm.frequent import frequent_words
from changeflow.llm.lists import BROADCAST_ROWS, joined, measured  # noqa: F401
from changeflow.session import scratch_path, settle

#: Words that `Models.frequent` names; words of a chunk and words whose pairs meet in a bucket, about.
FREQUENT, CHUNK, HELD = 1536, 1 << 20, 1 << 21
#: The even share of a word is one of as many words as there are, or of so many.
CLASSES = 2048
#: Words of the smoother model that are mixed into each count.
SMOOTH_PAIR, SMOOTH_CLASS = 20.0, 2048.0
_M = np.uint64(0x9E3779B97F4A7C15)


def _pair(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return arrow.mix(arrow.mix(before + _M) * _M + hashes)


def _occurrences(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each row's key, a number from 0 on, occurs in its text."""
    _, at, n = np.unique(doc * (int(key.max(initial=0)) + 1) + key, return_inverse=True, return_counts=True)
    return n[at]


def _loss(scale, has, after, total, length, n_word, own_word, n_before, own_before, n_pair, own_pair, types):
    """Negative log probability; `has` and `after` are 0 or 1."""
    p = (scale * (n_word - has * own_word) + SMOOTH_CLASS / types) / (scale * (total - has * length) + SMOOTH_CLASS)
    pairs, firsts = after * scale * (n_pair - has * own_pair), after * scale * (n_before - has * own_before)
    return -np.log((pairs + SMOOTH_PAIR * p) / (firsts + SMOOTH_PAIR))


def _pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on as planes of their bytes, the lowest first, as many as the largest needs, compressed."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T[:width].tobytes()
    return bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = pa.decompress(memoryview(data)[1:], decompressed_size=data[0] * n, codec="zstd") if n else b""
    out = np.zeros((n, 8), np.uint8)
    out[:, : data[0]] = np.frombuffer(planes, np.uint8).reshape(data[0], n).T
    return out.view("<u8").ravel()


@dataclass
class Chunk:
    """Some texts: whether each is in the target, its number of words, and its words as places in `vocab`,
    their hashes."""

    target: np.ndarray
    size: np.ndarray
    vocab: np.ndarray
    codes: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table | pa.RecordBatch, i: int) -> Chunk:
        target, size = (np.array(rows.column(c)[i].values, dtype=t) for c, t in (("target", bool), ("size", np.int64)))
        codes = _unpack(rows.column("codes")[i].as_py(), int(size.sum())).astype(np.int64)
        return cls(target, size, np.frombuffer(rows.column("vocab")[i].as_py(), "<u8"), codes)

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word its text, the word before (0 at the start of a text), and whether there is one."""
        doc = np.repeat(np.arange(len(self.size)), self.size)
        after = np.ones(len(doc), dtype=bool)
        after[(np.cumsum(self.size) - self.size)[self.size > 0]] = False
        return doc, np.where(after, np.concatenate((np.zeros(1, np.int64), self.codes))[: len(doc)], 0), after

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct pairs, the place in them of each word that has one before it, and their counts."""
        doc, before, after = self.places()
        key = _pair(self.vocab[before[after]], self.vocab[self.codes[after]])
        key, at, n = np.unique(key, return_inverse=True, return_counts=True)
        return key, at, np.stack((n, np.bincount(at, self.target[doc[after]], len(key)).astype(np.int64)))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted words, their places in `vocab`, and their counts: as words and as words before others."""
        (doc, before, after), n, order = self.places(), len(self.vocab), np.argsort(self.vocab)
        counts = [np.bincount(self.codes, minlength=n), np.bincount(self.codes, self.target[doc], n)]
        counts += [np.bincount(before[after], minlength=n), np.bincount(before[after], self.target[doc[after]], n)]
        return self.vocab[order], order, np.stack(counts).astype(np.int64)[:, order]


@dataclass
class Models:
    """Texts of the models with their target, the same as chunks; number of words in all texts and in the
    target, and of different ones; answers about the words of each chunk."""

    docs: DataFrame
    chosen: tuple[DataFrame, int, int]
    chunks: DataFrame
    totals: tuple[float, float]
    types: float
    words: DataFrame

    @property
    def frequent(self) -> np.ndarray:
        return frequent_words(self.docs, FREQUENT)

    def buckets(self, share: int = 1) -> int:
        return 1 + int(self.totals[0]) // (share * HELD)


def _chunks(docs: DataFrame, chosen: tuple[DataFrame, int, int]) -> tuple[DataFrame, tuple[float, float]]:
    """The texts as rows of a `Chunk` with the ids, written once; number of words in all and in the target."""
    kind = dict(docs.dtypes)["doc_id"]

    def find(batches):
        number, held, waiting = TaskContext.get().partitionId() << 33, [], 0

        def flush():
            ids, target, size, hashes = zip(*held)
            ids, target, size = pa.concat_arrays(ids), np.concatenate(target), np.concatenate(size)
            vocab, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            code = np.empty(len(order), np.int64)
            code[order] = np.arange(len(order))
            whole = np.array([0, len(ids)])
            columns = [pa.array([number]), arrow.as_lists(ids, whole), arrow.as_lists(pa.array(target), whole),
                       arrow.as_lists(pa.array(size.astype(np.int64)), whole), pa.array([vocab[order].astype("<u8").tobytes()]),
                       pa.array([_pack(code[at])]), pa.array([int(size.sum())]), pa.array([int(size[target].sum())])]
            return pa.RecordBatch.from_arrays(columns, ["chunk", "ids", "target", "size", "vocab", "codes", "n0", "n1"])

        for batch in batches:
            data, offsets = arrow.texts(batch.column(1), lower=True)
            target = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1], arrow.LETTERS)
                held.append((batch.column(0).slice(low, high - low), target[low:high], np.diff(words.first), words.hashes))
                waiting += len(words.hashes) + high - low
                if waiting >= CHUNK:
                    yield flush()
                    number, held, waiting = number + 1, [], 0
        if held:
            yield flush()

    ddl = f"chunk long, ids array<{kind}>, target array<boolean>, size array<long>, vocab binary, codes binary, n0 long, n1 long"
    seen, totals = Observation(), [F.sum(c).alias(c) for c in ("n0", "n1")]
    rows = _with_target(docs, chosen, doc_id="doc_id", text="text").select("doc_id", "text", "target").mapInArrow(find, ddl)
    rows = settle(rows, scratch_path(docs.sparkSession, "chunks"), seen=seen, totals=totals)
    return rows, tuple(float(seen.get[c] or 0) for c in ("n0", "n1"))


def _with_target(docs: DataFrame, chosen: tuple[DataFrame, int, int], **columns) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), *[F.col(f"`{c}`").alias(k) for k, c in columns.items()])
    return joined(rows, chosen, ["_id"], "left").withColumn("target", F.coalesce("_in", F.lit(False)))


def _sent(chunks: DataFrame, pairs: bool, buckets: int, asks: bool, tells: bool) -> DataFrame:
    """A row for each chunk and bucket of hashes, which are sent as differences: chunks that ask wait for an
    answer, those that tell add their counts."""

    def send(batches):
        for batch in batches:
            for i in range(len(batch)):
                chunk = Chunk.of(batch, i)
                key, _, counts = chunk.pairs() if pairs else chunk.words()
                edges = np.searchsorted((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)):
                    low, high = edges[b], edges[b + 1]
                    row = [int(b), batch.column("chunk")[i].as_py() if asks else None, int(high - low),
                           _pack(np.diff(key[low:high], prepend=np.uint64(0))), _pack(counts[:, low:high].ravel()) if tells else None]
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema)

    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("n", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    return chunks.select("chunk", "target", "size", "vocab", "codes").mapInArrow(send, "bucket int, chunk long, n int, keys binary, counts binary")


def _answers(asking: DataFrame, models: Models, pairs: bool) -> DataFrame:
    """For each chunk and bucket the counts in the models of what it asks, in the order of the hashes; `distinct`,
    in one row of a bucket, is how many the models have."""
    same, width = asking is models.chunks, 2 if pairs else 4
    buckets = models.buckets(1 if pairs else 8)
    rows = _sent(asking, pairs, buckets, True, same)
    rows = rows if same else rows.unionByName(_sent(models.chunks, pairs, buckets, False, True))

    def add(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "chunk", "n", "keys", "counts"))))
        keys = [np.cumsum(_unpack(k, n), dtype=np.uint64) for _, _, n, k, _ in rows]
        told = [(k, _unpack(c, width * n).reshape(width, n)) for k, (_, _, n, _, c) in zip(keys, rows) if c is not None]
        every, at = np.unique(np.concatenate([k for k, _ in told] or [np.zeros(0, np.uint64)]), return_inverse=True)
        sums = np.zeros((width, len(every) + 1), np.int64)  # the last is nowhere
        for k in range(width if told else 0):
            sums[k, :-1] = np.bincount(at, np.concatenate([c[k] for _, c in told]), len(every))
        out = []
        for key, (bucket, chunk, n, _, _) in zip(keys, rows):
            if chunk is not None:
                place = np.searchsorted(every, key)
                place = np.where(np.append(every, np.uint64(0))[place] == key, place, len(every))
                out.append((chunk, bucket, n, _pack(sums[:, place].ravel()), len(every) if not out else 0))
        columns = zip(*out) if out else [[]] * 5
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, schema.types)], schema=schema)

    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("counts", pa.binary()), ("distinct", pa.int64())])
    return rows.groupBy("bucket").applyInArrow(add, "chunk long, bucket int, n int, counts binary, distinct long")


def fit(docs: DataFrame, chosen: tuple[DataFrame, int, int]) -> Models:
    """Models of all of `docs` and of the rows among `chosen` (see `target_ids`). Every row, word and pair
    is counted by itself; the driver is sent three sums."""
    spark = docs.sparkSession
    arrow.ship(spark)
    chunks, totals = _chunks(docs, chosen)
    models, seen = Models(docs, chosen, chunks, totals, 0.0, chunks), Observation()
    words = _answers(chunks, models, False)
    models.words = settle(words, scratch_path(spark, "words"), seen=seen, totals=[F.sum("distinct").alias("types")])
    models.types = float(max(CLASSES, seen.get["types"] or 0))
    return models


def target_ids(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Ids of the target, from `doc_id`, ready for `fit` and `score`."""
    ids = rows.select(F.col("doc_id").cast("long").alias("_id")).filter("_id is not null").distinct()
    return measured(ids.withColumn("_in", F.lit(True)), "target")


def _losses(chunk: Chunk, words: np.ndarray, pairs: np.ndarray, totals: tuple[float, float], types: float) -> list[np.ndarray]:
    """Summed losses of each text under the background and the target, by counts of the chunk's sorted words
    and pairs."""
    (doc, before, after), length = chunk.places(), chunk.size
    own_word = _occurrences(doc, chunk.codes)
    own_before = _occurrences(doc, np.where(after, before + 1, 0))
    _, at, _ = chunk.pairs()
    own_pair, n_pair = np.zeros(len(doc)), np.zeros((2, len(doc)))
    own_pair[after], n_pair[:, after] = _occurrences(doc[after], at), pairs[:, at]
    counts = np.empty(words.shape)
    counts[:, chunk.words()[1]] = words
    out = []
    for m, scale in ((0, totals[1] / max(1.0, totals[0])), (1, 1.0)):
        has = 1 if m == 0 else chunk.target[doc].astype(np.int64)
        loss = _loss(scale, has, after.astype(np.int64), totals[m], length[doc], counts[m][chunk.codes], own_word,
                     counts[2 + m][before], own_before, n_pair[m], own_pair, types)
        out.append(np.bincount(doc, loss, len(length)))
    return out


def score(docs: DataFrame, models: Models, chosen: tuple[DataFrame, int, int]) -> DataFrame:
    """Per row: `doc_id`, `n_words`, `target_loss` and `background_loss` (nats a word) and `difference`,
    target less background: below zero the text is more like the target.

    Null and empty texts have no words: losses and difference are null. A null id is in no target;
    repeated rows are scored like any row; an empty table gives no rows; other columns are not read;
    a text of any length is scored whole. Without a target its model is even.
    """
    kind, totals, types = dict(docs.dtypes)["doc_id"], models.totals, models.types
    if chosen is models.chosen and docs.sameSemantics(models.docs):
        chunks, words = models.chunks, models.words
    else:
        chunks, _ = _chunks(docs, chosen)
        words = _answers(chunks, models, False)
    marked = [rows.withColumn("pairs", F.lit(p)) for rows, p in ((words, False), (_answers(chunks, models, True), True))]

    def told(answers: pa.Table, pairs: bool) -> np.ndarray:
        width = 2 if pairs else 4
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "counts", "pairs"))), key=lambda r: r[0])
        parts = [_unpack(c, width * n).reshape(width, n) for _, n, c, p in rows if p == pairs]
        return np.concatenate([np.zeros((width, 0), np.uint64), *parts], axis=1).astype(np.float64)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk.of(texts, 0)
        n = chunk.size
        means = [s / np.maximum(n, 1) for s in _losses(chunk, told(answers, False), told(answers, True), totals, types)]
        columns = [texts.column("ids")[0].values, pa.array(n)]
        columns += [pa.array(x, mask=n == 0) for x in (means[1], means[0], means[1] - means[0])]
        return pa.table(columns, names=["doc_id", "n_words", "target_loss", "background_loss", "difference"])

    texts = chunks.select("chunk", "ids", "target", "size", "vocab", "codes").groupBy("chunk")
    answers = marked[0].unionByName(marked[1]).select("chunk", "bucket", "n", "counts", "pairs").groupBy("chunk")
    ddl = f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double"
    return texts.cogroup(answers).applyInArrow(run, ddl)
