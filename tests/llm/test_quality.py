import random

import numpy as np
import pytest
from fixtures import documents, empty, prose

from changeflow.llm import quality, toxicity


def corpus(n=300):
    rng, rows, labels = random.Random(3), [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(i, rng.randrange(5, 400))
        rows.append((i, text if good else text.replace(" ", rng.choice([" ## ", "*** ", " | "])), "en", "s0", None))
        labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, quality int").filter(toxicity.remainder("doc_id", 3) != 1)
    return quality.fit(documents(spark, rows), known, examples=120)


def test_held_out_rows_are_told_apart(spark, fitted):
    rows, labels = corpus()
    out = quality.score(documents(spark, rows, clash=["score"]), *fitted)
    held = out.filter(toxicity.remainder("doc_id", 3) == 1).collect()
    right = sum(r.predicted == dict(labels)[r.doc_id] for r in held)
    assert len(held) > 50 and right >= 0.97 * len(held)


def by_hand(network, text):
    """The network position by position and chunk by chunk."""
    data = np.frombuffer(text.encode(), np.uint8)
    data = np.concatenate((data, np.zeros(max(0, quality.CHUNK - len(data)), np.uint8)))
    best = []
    for s in quality.chunk_starts(len(data)):
        chunk = network.embed[data[s : s + quality.CHUNK]]
        answers = [
            np.einsum("ke,kef->f", chunk[i : i + quality.WIDTH], network.filters)
            for i in range(quality.CHUNK - quality.WIDTH + 1)
        ]
        best.append(np.maximum(np.max(answers, axis=0) + network.bias, 0))
    return network.probability(np.mean(best, axis=0)[None, :])[0]


def test_tables_give_the_network_of_all_chunks(spark, fitted):
    network = fitted[0]
    rows = [(i, t, "en", "a", None) for i, t in enumerate(["", "x", prose(1, 60), prose(2, 300), "é" * 700, "z" * 512, "z" * 513])]
    got = {r.doc_id: r.score for r in quality.score(documents(spark, rows), *fitted).collect()}
    for i, t, *_ in rows:
        assert got[i] == pytest.approx(by_hand(network, t), abs=2e-4)


def test_chunks_cover_the_whole_text():
    for size in (0, 1, 511, 512, 513, 900, 5000):
        starts = quality.chunk_starts(size)
        covered = np.zeros(max(size, 1), bool)
        for s in starts:
            covered[s : s + quality.CHUNK] = True
        assert covered.all() and (starts[-1] + quality.CHUNK == size or size < quality.CHUNK or len(starts) == 1)


def test_gradients_are_those_of_small_steps():
    rng = np.random.default_rng(0)
    net = quality.Network.random(4)
    chunks = rng.integers(97, 110, (5, quality.CHUNK)).astype(np.uint8)
    doc, n = np.array([0, 0, 1, 2, 2]), np.array([2, 1, 2])
    labels, weights = np.array([1, 0, 1]), np.array([1.0, 2.0, 1.0])

    def loss():
        tables = net.tables()
        best = np.stack([quality._answers(c, tables).max(axis=0) for c in chunks])
        pooled = np.zeros((3, quality.FILTERS), np.float32)
        np.add.at(pooled, doc, np.maximum(best + net.bias, 0) / n[doc][:, None])
        p = net.probability(pooled)
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weights.sum()

    grads = quality._gradients(net, chunks, doc, n, labels, weights)
    for name in ("bias", "dense", "out", "filters", "embed"):
        value = getattr(net, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        old, step = value[at], 1e-2
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=0.1, abs=2e-3), name


def test_awkward_rows(spark, fitted):
    docs = documents(spark)
    out = quality.score(docs, *fitted).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id in (40, 41)}) == 1
    assert quality.score(empty(spark), *fitted).count() == 0
    none = quality.fit(docs, spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int"))
    assert none == (None, 1.0) and quality.score(docs, *none).filter("score = 1.0").count() == docs.count()
