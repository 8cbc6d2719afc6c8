import hashlib

import pytest
from fixtures import awkward, documents, empty, prose

from changeflow.llm import spots


def split(fingerprint):
    return {fingerprint[i : i + 8] for i in range(0, len(fingerprint), 8)}


def alike(a, b):
    return len(split(a) & split(b)) / len(split(a) | split(b))


def in_order(rows):
    return sorted(rows, key=lambda r: r[0], reverse=True)


def texts():
    rows = [(i, f"the {prose(i, 30 + 17 * i).replace(' ', ' the ')} end", "en", "a", None) for i in range(25)]
    return rows + [(30, "", "en", "a", None), (31, None, "en", "a", None), (32, "a", "en", "a", None), (33, "日本語\U0001f642" * 40, "en", "a", None),
                   (34, rows[3][1], "en", "a", None), (35, "same " * 50, "en", "a", None), (36, "?!", "en", "a", None)]


def test_against_the_next_document(spark):
    rows = in_order(texts())
    got = {r.doc_id: r for r in spots.against_next(documents(spark, rows, clash=["key", "part", "ghost"])).collect()}
    assert len(got) == len(rows)
    for k, (i, text, *_) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)]
        n = len(text)
        edited = text[: n - n // 3] + (after[1] or "")[: n // 3]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(alike(r.fingerprint, got[after[0]].fingerprint))
    assert got[34].fingerprint == got[3].fingerprint and got[30].fingerprint == got[31].fingerprint
    assert got[32].fingerprint != got[30].fingerprint != got[36].fingerprint
    long = [got[i] for i in range(5, 25)]
    assert all(r.near_edited > 0.3 for r in long) and all(r.near_next < 0.1 for r in long)


def test_many_ranges(spark):
    """More ranges than rows change nothing."""
    rows = texts()
    few = spots.against_next(documents(spark, rows)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = spots.against_next(documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(few) == sorted(many)


def test_signatures_by_hand(spark):
    rows = [(i, "the red fox and the old dog of the hill ran", "en", "a", None) for i in range(3)]
    docs = documents(spark, rows)
    anchors = spots.frequent_words(docs.select("text"), 1)
    (one,) = {r.fingerprint for r in spots.fingerprints(docs, anchors).collect()}
    # The anchor stands three times, each with two content words after it.
    assert len(split(one)) == 3
    other = [(1, "the red fox and the old cat of the hill ran", "en", "a", None)]
    (two,) = [r.fingerprint for r in spots.fingerprints(documents(spark, other), anchors).collect()]
    assert len(split(one) & split(two)) == 2


def test_similar_against_all_pairs(spark):
    base = texts()
    rows = base + [(100 + i, r[1].replace(" the ", " THE ", 1) + " tail" * (i % 3), *r[2:]) for i, r in enumerate(base[:25])]
    rows += [(200 + i, " ".join(w for k, w in enumerate(r[1].split()) if k % 29 != 7), *r[2:]) for i, r in enumerate(base[5:25])]
    prints = spots.fingerprints(documents(spark, rows)).cache()
    every = sorted({r.fingerprint for r in prints.collect()})
    for threshold in (0.8, 0.5):
        wanted = {(a, b): alike(a, b) for k, a in enumerate(every) for b in every[k + 1 :] if alike(a, b) >= threshold}
        got = {(r.a, r.b): r.likeness for r in spots.similar(prints, threshold).collect()}
        assert got == pytest.approx(wanted) and wanted


def test_awkward_rows(spark):
    docs = documents(spark)
    out = spots.against_next(docs).collect()
    assert len(out) == len(awkward()) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    repeated = [r for r in out if r.doc_id == 46]
    assert sum(r.near_next == 1.0 for r in repeated) >= 2
    assert spots.against_next(empty(spark)).count() == 0
    (alone,) = spots.against_next(documents(spark, [(5, "just one text here", "en", "a", None)])).collect()
    assert alone.near_next == 1.0
