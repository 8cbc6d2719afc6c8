import hashlib

import numpy as np
from fixtures import awkward, documents, empty, prose

from changeflow.llm import arrow, lists, substrings


def by_hand(rows, length):
    """Every window against all that start earlier; `rows` (id, text) in the order of removal."""
    seen, out = set(), []
    for i, text in rows:
        words = (text or "").encode().split()
        stay = [True] * len(words)
        new = []
        for p in range(len(words) - length + 1):
            key = b" ".join(words[p : p + length])
            if key in seen or key in new:
                stay[p : p + length] = [False] * length
            new.append(key)
        seen.update(new)
        kept = b" ".join(w for w, s in zip(words, stay) if s)
        out.append((str(i), len(words), len(words) - sum(stay), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def shared_rows():
    """Passages that many documents share, copies, edited copies, and a text that repeats itself."""
    passage, other = prose(900, 34), prose(901, 21)
    rows = [(i, f"{prose(i, 11)} {passage if i % 3 else other}\n{prose(100 + i, 7)}") for i in range(30)]
    rows += [(30 + i, prose(500, 80)) for i in range(8)]
    rows += [(40 + i, " ".join(w if k != 7 * i else "edited" for k, w in enumerate(prose(500, 80).split()))) for i in range(8)]
    rows += [(50, "ha " * 70), (51, "ha " * 45 + "ho " * 20), (52, f"{passage} {passage} {other}"), (53, other + " end")]
    rows += [(60 + i, "\x0b".join(prose(600, 25).split()) + " x　") for i in range(3)]
    return [(i, t, "en", "s0", None) for i, t in rows]


def test_against_all_windows(spark):
    rows = shared_rows()
    got = substrings.without_repeats(documents(spark, rows, clash=["d", "t", "a", "low", "ranges"]))
    assert found(got) == by_hand([r[:2] for r in rows], 20)


def test_other_lengths(spark):
    rows = shared_rows()
    for length, gram in ((8, 3), (12, 12), (40, 5)):
        got = substrings.without_repeats(documents(spark, rows), length, gram)
        assert found(got) == by_hand([r[:2] for r in rows], length), (length, gram)


def test_shuffled_instead_of_broadcast(spark, monkeypatch):
    rows = shared_rows()
    monkeypatch.setattr(lists, "BROADCAST_ROWS", -1)
    assert found(substrings.without_repeats(documents(spark, rows))) == by_hand([r[:2] for r in rows], 20)


def test_awkward_rows(spark):
    """Rows of one id and text are judged alike; other texts of one id follow by hash; null ids last."""
    got = found(substrings.without_repeats(documents(spark, clash=["spans"])))
    distinct = [r for r in awkward() if r[0] not in (None, 46)]
    by_id = by_hand([r[:2] for r in distinct], 20)
    assert [r for r in got if r[0] not in ("None", "46")] == by_id
    same = [r for r in got if r[0] == "46" and r[2] == 0]
    assert len([r for r in got if r[0] == "46"]) == 4 and len(same) == 4
    assert [r[1:3] for r in got if r[0] == "None"] == [(0, 0), (30, 0)]


def test_kept_text_and_repeats(spark):
    rows = shared_rows()
    out = substrings.without_repeats(documents(spark, rows), texts=True).collect()
    for r in out:
        words = {i: t for i, t, *_ in rows}[r.doc_id].encode().split()
        cut = {k for x in r.repeats or [] for k in range(x.low, x.high)}
        assert all(x.high - x.low >= 20 for x in r.repeats or [])
        assert r.kept.encode() == b" ".join(w for k, w in enumerate(words) if k not in cut)


def test_empty(spark):
    assert substrings.without_repeats(empty(spark)).count() == 0
    assert found(substrings.without_repeats(documents(spark, [(1, None, "en", "a", None)]))) == by_hand([(1, None)], 20)


def test_words_of_a_batch():
    import pyarrow as pa

    texts = ["a bc  d", None, "", "x" * 700 + " y", " é\x0b z", "tail"]
    data, offsets = arrow.texts(pa.array(texts, pa.string()).slice(0, 6))
    words = arrow.words(data, offsets)
    out = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end)]
    assert out == [w for t in texts for w in (t or "").encode().split()]
    assert np.diff(words.first).tolist() == [len((t or "").encode().split()) for t in texts]
    many = arrow.words(*arrow.texts(pa.array([w.decode() for w in out])))
    assert (many.hashes == words.hashes).all() and len(set(many.hashes.tolist())) == len(set(out))
