import re
from collections import Counter, defaultdict

import pytest
from fixtures import awkward, documents, empty, prose
from pyspark.sql import functions as F

from changeflow.llm import mixing


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes):
    """Targets by repeated resharing: `sizes` by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 2 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / w for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return target


def test_permutation(spark):
    for n in (1, 2, 3, 10, 97, 4096):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))
    assert [r.p for r in rows] != sorted(r.p for r in rows)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 9, "d": 40, None: 7},
                                   {"a": 0, "b": 0}, {"x": 5}, {"a": 3, "b": 0, "c": 100, "d": 1}])
def test_targets_are_those_of_repeated_resharing(spark, sizes):
    rows = [(str(s), s, n) for s, n in sizes.items()]
    got = mixing.targets(spark.createDataFrame(rows, "key string, source string, source_size long")).collect()
    wanted = filled(sizes)
    for r in got:
        source = None if r.key == "None" else r.key
        assert r.target == pytest.approx(wanted[source], rel=1e-9, abs=1e-9)


def packed(rows, block):
    """Blocks that each row holds words of, and how many, packed in (source, id) order."""
    held, at = [], defaultdict(int)
    for i, row in rows:
        for k in range(n_words(row["text"])):
            held.append((i, (row["key"], (at[row["key"]] + k) // block)))
        at[row["key"]] += n_words(row["text"])
    return Counter(held)


def test_against_packing_by_hand(spark):
    docs = documents(spark, clash=["size", "key", "_row", "block"])
    plan = mixing.mix(docs, block=16, keep=["doc_id", "text"])
    rows = plan.rows.select("_row", "key", "_kept.text", "_first", "size").orderBy("_row").collect()
    times = Counter((r.key, r.block) for r in plan.slots.collect())
    by_hand = defaultdict(int)
    for (i, block), n in packed(enumerate(rows), 16).items():
        by_hand[rows[i]["_row"]] += n * times[block]
    sums = {r["_row"]: r.n for r in plan.pieces.groupBy("_row").agg(F.expr("sum(words * times)").alias("n")).collect()}
    assert {k: v for k, v in sums.items() if v} == {k: v for k, v in by_hand.items() if v}

    out = mixing.taken(plan).collect()
    assert len(out) == len(awkward())
    assert all(0 <= r.taken <= 2 * r.size for r in out)
    sizes = defaultdict(int)
    for _, t, _, s, _ in awkward():
        sizes[s] += n_words(t)
    wanted = filled(sizes)
    assert sorted({(r.source_size, round(r.target, 6)) for r in out}) == sorted({(sizes[s], round(wanted[s], 6)) for s in sizes})
    near = mixing.taken(mixing.mix(docs, block=16, keep=["doc_id", "source"]))
    for r in near.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect():
        assert abs(r.n - r.t) <= 16

    again = mixing.taken(mixing.mix(docs.repartition(3), block=16, keep=["doc_id", "text"]))
    assert sorted(map(str, again.collect())) == sorted(map(str, out))


def test_documents_of_the_mix(spark):
    plan = mixing.mix(documents(spark), block=16, keep=["doc_id", "text", "lang", "source", "n_chars"])
    mixed = mixing.mixed_documents(plan).collect()
    words = defaultdict(int)
    given = {t for _, t, *_ in awkward()}
    for r in mixed:
        words[str(r.doc_id)] += n_words(r.text)
        assert r.n_chars == len(r.text) and n_words(r.text)
    wanted = defaultdict(int)
    for r in mixing.taken(plan).collect():
        wanted[str(r.doc_id)] += r.taken
    assert {k: v for k, v in wanted.items() if v} == dict(words)
    assert any(r.text in given for r in mixed)
    for r in mixed:
        assert any(t and set(r.text.split()) <= set(t.split()) for t in given)


def test_shard_counts_are_spread(spark):
    rows = [(i, prose(i, 400), "en", f"s{i % 3}", None) for i in range(300)]
    plan = mixing.mix(documents(spark, rows), block=4)
    per_shard = mixing.shard_counts(plan).groupBy("shard").agg(F.sum("slots").alias("n")).collect()
    mean = sum(r.n for r in per_shard) / len(per_shard)
    assert len(per_shard) > 5 and all(abs(r.n - mean) < 6 * mean**0.5 for r in per_shard)


def test_empty(spark):
    assert mixing.taken(mixing.mix(empty(spark))).count() == 0
    nothing = documents(spark, [(1, None, "en", "a", None), (2, " ", "en", None, None)])
    assert [(r.size, r.target, r.taken) for r in mixing.taken(mixing.mix(nothing)).collect()] == [(0, 0.0, 0)] * 2


def test_no_python_in_the_plan(spark):
    plan = mixing.taken(mixing.mix(documents(spark)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
