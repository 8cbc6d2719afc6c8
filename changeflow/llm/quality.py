"""Quality of a text by a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over every position of the whole text, and each overlapping
chunk keeps the largest answer of each filter. The chunks' answers are averaged and a small dense
layer turns them into one probability. For scoring, embedding and filters are multiplied out into
tables by pairs of bytes, so that a position costs a few table rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.session import scratch_path, settle

#: Bound of the fit: examples of each label. Each is learned from whole.
EXAMPLES = 1500
#: Bytes of a chunk, and how far the next one starts after it.
CHUNK, HOP = 512, 384
WIDTH, FILTERS, EMBEDDED, HIDDEN = 6, 24, 8, 16
EPOCHS, BATCH, RATE = 14, 64, 0.01
#: Positions whose answers are in memory at a time.
POSITIONS = 1 << 16


def chunk_starts(size: int) -> np.ndarray:
    """Starts of chunks that cover a text of `size` bytes; the last one ends with the text."""
    if size <= CHUNK:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, size - CHUNK, HOP), size - CHUNK)


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def random(cls, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) / np.sqrt(by)).astype(np.float32)
        return cls(
            draw(256, EMBEDDED, by=2), draw(WIDTH, EMBEDDED, FILTERS, by=WIDTH * EMBEDDED / 4), np.zeros(FILTERS, np.float32),
            draw(FILTERS, HIDDEN, by=FILTERS), np.zeros(HIDDEN, np.float32), draw(HIDDEN, by=HIDDEN), np.zeros(1, np.float32),
        )

    def tables(self) -> list[np.ndarray]:
        """Answers by pair of bytes, for each of the pairs under a filter."""
        single = self.embed @ self.filters
        single = [single[k] for k in range(WIDTH)]
        return [(single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        """`pooled`: chunk means of the rectified largest answers, a row for each text."""
        hidden = np.maximum(pooled @ self.dense + self.dense_bias, 0)
        return 1 / (1 + np.exp(-(hidden @ self.out + self.out_bias[0]).astype(np.float64)))

    def pooled(self, text: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Mean over all chunks of a whole text."""
        text = _padded(text)
        starts = chunk_starts(len(text))
        best = np.empty((len(starts), FILTERS), dtype=np.float32)
        per_group = max(1, POSITIONS // HOP)
        for low in range(0, len(starts), per_group):
            own = starts[low : low + per_group]
            part = text[own[0] : own[-1] + CHUNK]
            answers = _answers(part, tables)
            # Chunks overlap: the largest of the pieces between their borders, then of each chunk's pieces.
            begin, end = own - own[0], own - own[0] + CHUNK - WIDTH + 1
            cuts = np.unique(np.concatenate((begin, end)))
            cuts = cuts[cuts < len(answers)]
            pieces = np.maximum.reduceat(answers, cuts, axis=0)
            first, last = np.searchsorted(cuts, begin), np.searchsorted(cuts, end)
            found = pieces[first]
            for k in range(1, int((last - first).max())):
                more = first + k < last
                found[more] = np.maximum(found[more], pieces[first[more] + k])
            best[low : low + per_group] = found
        return np.maximum(best + self.bias, 0).mean(axis=0)


def _padded(text: np.ndarray) -> np.ndarray:
    """A short text is filled up with zero bytes to one chunk."""
    if len(text) >= CHUNK:
        return text
    return np.concatenate((text, np.zeros(CHUNK - len(text), np.uint8)))


def _answers(data: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    n = len(data) - WIDTH + 1
    pairs = data[:-1].astype(np.int32) << 8 | data[1:]
    out = tables[0].take(pairs[:n], axis=0)
    for k in range(1, len(tables)):
        out += tables[k].take(pairs[2 * k : 2 * k + n], axis=0)
    return out


def train(chunks: np.ndarray, doc: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int = 1) -> Network:
    """Fit on chunks (a row of bytes each, sorted by their example `doc`) by stochastic gradients
    with running moments; `labels` and `weights` by example."""
    net, rng = Network.random(seed), np.random.default_rng(seed)
    names = list(net.__dataclass_fields__)
    moments = {n: [np.zeros_like(getattr(net, n)), np.zeros_like(getattr(net, n))] for n in names}
    first = np.searchsorted(doc, np.arange(len(labels) + 1))
    step, total = 0, EPOCHS * -(-len(labels) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for low in range(0, len(order), BATCH):
            own = order[low : low + BATCH]
            n = np.diff(np.stack((first[own], first[own + 1])), axis=0)[0]
            rows = np.repeat(first[own], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            grads = _gradients(net, chunks[rows], np.repeat(np.arange(len(own)), n), n, labels[own], weights[own])
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for name, g in grads.items():
                a, b = moments[name]
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                setattr(net, name, getattr(net, name) - rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8))
    return net


def _gradients(net, chunks, doc, n, labels, weights) -> dict[str, np.ndarray]:
    tables = net.tables()
    positions = CHUNK - WIDTH + 1
    best = np.empty((len(chunks), FILTERS), np.float32)
    place = np.empty((len(chunks), FILTERS), np.int64)
    for i, chunk in enumerate(chunks):
        answers = _answers(chunk, tables)
        place[i] = answers.argmax(axis=0)
        best[i] = answers[place[i], np.arange(FILTERS)]
    assert positions == len(answers)
    rectified = np.maximum(best + net.bias, 0)
    pooled = np.zeros((len(n), FILTERS), np.float32)
    np.add.at(pooled, doc, rectified / n[doc][:, None])
    before = pooled @ net.dense + net.dense_bias
    hidden = np.maximum(before, 0)
    p = 1 / (1 + np.exp(-(hidden @ net.out + net.out_bias[0])))
    error = ((p - labels) * weights / weights.sum()).astype(np.float32)
    d_before = np.outer(error, net.out) * (before > 0)
    d_pooled = d_before @ net.dense.T
    d_best = d_pooled[doc] / n[doc][:, None] * (rectified > 0)
    # Only the position of the largest answer has a share in it.
    d_single = np.zeros((WIDTH, 256, FILTERS), np.float32)
    row = np.arange(len(chunks))[:, None]
    column = np.broadcast_to(np.arange(FILTERS), place.shape)
    for k in range(WIDTH):
        np.add.at(d_single[k], (chunks[row, place + k], column), d_best)
    return {
        "embed": np.einsum("kbf,kef->be", d_single, net.filters),
        "filters": np.einsum("be,kbf->kef", net.embed, d_single),
        "bias": d_best.sum(axis=0),
        "dense": pooled.T @ d_before,
        "dense_bias": d_before.sum(axis=0),
        "out": hidden.T @ error,
        "out_bias": error.sum(keepdims=True),
    }


def _example_chunks(examples: DataFrame) -> DataFrame:
    def cut(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(2))
            ids, labels = batch.column(0), batch.column(1)
            for i in range(len(batch)):
                text = _padded(data[offsets[i] : offsets[i + 1]])
                starts = chunk_starts(len(text))
                rows = [text[s : s + CHUNK].tobytes() for s in starts]
                at = pa.array(np.full(len(rows), i))
                columns = [ids.take(at), labels.take(at), pa.array(starts), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "at", "chunk"])

    return examples.select("doc_id", "label", "text").mapInArrow(cut, "doc_id long, label int, at long, chunk binary")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", examples: int = EXAMPLES) -> tuple[Network | None, float]:
    """The network, or None if the labels lack one of the two values, and the share of label 1.
    `labels` has `doc_id` and the label and holds only rows to learn from; at most `examples` of
    each value are learned from, taken by a hash of the id, with all of their chunks: that much and
    no more comes to the driver. Examples count by how many they stand for."""
    spark = docs.sparkSession
    arrow.ship(spark)
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = settle(known.filter("label in (0, 1)"), scratch_path(spark, "labels"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    picked = [known.filter(f"label = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for y in (0, 1)]
    # Rows of one id and several texts: one of them is the example.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    rows = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    found = _example_chunks(rows).toArrow().sort_by([("doc_id", "ascending"), ("at", "ascending")])
    ids, doc = np.unique(found.column("doc_id").to_numpy(), return_inverse=True)
    first = np.searchsorted(doc, np.arange(len(ids)))
    y = found.column("label").to_numpy()[first] if len(ids) else np.zeros(0, int)
    if len(set(y.tolist())) < 2:
        return None, share
    chunks = np.frombuffer(b"".join(found.column("chunk").to_pylist()), np.uint8).reshape(-1, CHUNK)
    weights = np.array([sizes[k] / max(1, (y == k).sum()) for k in (0, 1)])[y]
    return train(chunks, doc, y, weights / weights.mean()), share


def score(docs: DataFrame, network: Network | None, share: float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `score`, the probability of label 1 of the whole text, and `predicted` (1 from
    0.5 on).

    Null and empty texts are one chunk of zero bytes. Without a network each row has `share`, the
    share of label 1. Null ids and repeated rows are scored like any row; an empty table gives no rows;
    other columns are not read. A very long text is worked through in groups of chunks.
    """
    spark = docs.sparkSession
    arrow.ship(spark)
    rows = arrow.renamed(docs, doc_id=doc_id, text=text)
    sent = spark.sparkContext.broadcast(network)

    def run(batches):
        network = sent.value
        tables = network.tables() if network else None
        for batch in batches:
            data, offsets = arrow.texts(batch.column(1))
            if network is None:
                scores = np.full(len(batch), share)
            else:
                pooled = [network.pooled(data[a:b], tables) for a, b in zip(offsets[:-1], offsets[1:])]
                scores = network.probability(np.stack(pooled)) if pooled else np.zeros(0)
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")
