import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from fixtures import WORDS, documents, empty, prose
from pyspark.sql import functions as F

from changeflow.llm import arrow, toxicity

RUDE = ["grub", "snarl", "muck"]


def corpus(n=1200):
    """A tenth of the documents hold rude words, in any case and with marks."""
    rng, rows, labels = random.Random(5), [], []
    for i in range(n):
        words = prose(i, rng.randrange(20, 90)).split()
        toxic = i % 10 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice([*RUDE, "MUCK!!", "Snarl,"]))
        rows.append((i, " ".join(words), "en", f"s{i % 3}", None))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus()
    known = spark.createDataFrame(labels, "doc_id long, toxic int").filter(toxicity.remainder("doc_id", 5) != 0)
    return toxicity.fit(documents(spark, rows), known)


def test_held_out_rows_are_told_apart(spark, model):
    rows, labels = corpus()
    out = toxicity.score(documents(spark, rows, clash=["score", "evidence"]), model)
    out = out.withColumn("held_out", toxicity.remainder("doc_id", 5) == 0).collect()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in out if r.held_out]
    assert len(held) > 100 and all(r.predicted == dict(labels)[r.doc_id] for r in held)
    toxic = [r for r in held if r.predicted]
    assert all(r.score > 0.9 and r.evidence[0].toxic == 1 and r.evidence[0].similarity > 0 for r in toxic)


def vectors(model, texts):
    data, offsets = arrow.texts(pa.array(texts), lower=True)
    used, found = model.vectors(data, offsets)
    out = np.zeros((len(texts), len(model.terms)), np.float32)
    out[used] = found
    return out


def test_neighbours_are_those_of_brute_force(model):
    rng = random.Random(9)
    texts = [" ".join(rng.choice([*RUDE, *WORDS]) for _ in range(rng.randrange(1, 12))) for _ in range(300)]
    queries = vectors(model, texts)
    best, place = model.nearest(queries, 7)
    every = queries @ model.weights.T
    for q, b, p in zip(every, best, place):
        order = sorted(range(len(q)), key=lambda j: (-q[j], j))[:7]
        wanted = [j for j in order if q[j] > 0]
        np.testing.assert_allclose(b[: len(wanted)], q[wanted], rtol=1e-5)
        assert (p >= 0).sum() == len(wanted)
        assert all(abs(q[j] - s) < 1e-5 for j, s in zip(p, b) if j >= 0)


def test_index_skips_blocks_without_a_term(model):
    assert len(model.blocks) >= 1
    for (a, b), (terms, weights), j in zip(model.blocks, model.postings, range(len(model.blocks))):
        assert weights.shape == (len(terms), b - a)
        assert (model.most[terms, j] >= weights.max(axis=1) - 1e-6).all()


def test_awkward_rows(spark, model):
    docs = documents(spark)
    out = toxicity.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    bare = {r.score for r in out if r.doc_id in (40, 41, 42)}
    assert bare == {model.none} and not any(r.evidence for r in out if r.doc_id == 41)
    assert toxicity.score(empty(spark), model).count() == 0
    kept = toxicity.without_toxic(documents(spark, clash=["score"]), model)
    assert kept.columns == documents(spark, clash=["score"]).columns and kept.count() == docs.count()


def test_labels_that_tell_nothing(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, odd)).filter("score between 0 and 1").count() == docs.count()
    assert toxicity.fit(empty(spark), odd).none in (0.0, 0.5)


def test_ratio(spark):
    rows = spark.createDataFrame([(10, 10), (0, 10), (0, 0), (20, 20)], "n0 int, n1 int")
    got = [r[0] for r in rows.select(toxicity._ratio([20, 20])).collect()]
    assert got[0] == got[2] == got[3] == 0 and got[1] > 15
