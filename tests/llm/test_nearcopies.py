import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import awkward, documents, empty, prose

from changeflow.llm import lists, nearcopies


def shingle_counts(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def similar(a, b):
    total = 0.0
    keys = set(a) | set(b)
    for d in set(a) & set(b):
        total += 1 / sum(max(a[x] / a[d], b[x] / b[d]) for x in keys)
    return total


def classes(rows, threshold=0.8):
    """Least id of the component of each row, from all pairs; ids and texts of the rows must differ."""
    sets = {i: shingle_counts(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    text = {i: t or "" for i, t, *_ in rows}
    for i in sets:
        for j in sets:
            if i < j and (text[i] == text[j] or similar(sets[i], sets[j]) >= threshold):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def edited(seed, text, share):
    rng = random.Random(seed)
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def copies():
    """Groups of copies from none to many edits, chains of edits, repeated lines, short texts."""
    rows = []
    for g in range(6):
        base = prose(1000 + g, 60 + 30 * g)
        rows += [edited(i + 100 * g, base, [0, 0.01, 0.02, 0.03, 0.05][i % 5]) for i in range(14)]
    chain = prose(2000, 120).split()
    for i in range(6):
        rows.append(" ".join(chain))
        chain[17 * i : 17 * i + 2] = ["odd", f"step{i}"]
    line = prose(3000, 12)
    rows += [f"{line}\n" * 9 + prose(3001 + i, 8) for i in range(4)] + ["one two", "ONE, two!", "one", ""]
    rows += [prose(4000 + i, 50) for i in range(20)]
    return [(i, t, "en", "a", None) for i, t in enumerate(rows)]


def test_against_all_pairs(spark):
    rows = copies()
    got = nearcopies.near_copies(documents(spark, rows, clash=["node", "root", "bucket"])).collect()
    wanted = classes(rows)
    assert {r.doc_id: r.class_id for r in got} == wanted
    sizes = Counter(wanted.values())
    texts = defaultdict(set)
    for i, t, *_ in rows:
        texts[wanted[i]].add(t)
    assert all(r.class_rows == sizes[r.class_id] and r.class_texts == len(texts[r.class_id]) for r in got)
    assert len(sizes) < len(rows)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lists, "BROADCAST_ROWS", -1)
    rows = copies()[:50]
    got = {r.doc_id: r.class_id for r in nearcopies.near_copies(documents(spark, rows)).collect()}
    assert got == classes(rows)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**62, 400).astype(np.uint64) for _ in range(2))
    both = np.sort(np.unique(np.concatenate((a[:300], b[:100]))))
    one, two = np.sort(a), both
    weights = [rng.integers(1, 4, len(x)).astype(float) for x in (one, two)]
    exact = nearcopies.similarity((one, weights[0]), (two, weights[1]))
    doc = np.concatenate((np.zeros(len(one), int), np.ones(len(two), int)))
    signed = nearcopies.signatures(doc, np.concatenate((one, two)), np.concatenate(weights), 2, 4000)
    assert (signed[0] == signed[1]).mean() == pytest.approx(exact, abs=0.03)
    scaled = nearcopies.signatures(doc, np.concatenate((one, two)), np.concatenate((weights[0] * 7, weights[1])), 2, 4000)
    assert (scaled == signed).all()


def test_similarity_by_definition():
    rng = random.Random(2)
    for _ in range(50):
        a, b = (Counter(rng.choices(range(30), k=rng.randint(1, 40))) for _ in range(2))
        sets = [(np.array(sorted(x)), np.array([float(x[k]) for k in sorted(x)])) for x in (a, b)]
        assert nearcopies.similarity(*sets) == pytest.approx(similar(a, b))


def test_shares_of_their_own_bound_the_similarity():
    rng = random.Random(4)
    for _ in range(200):
        common, own_a, own_b = (Counter(rng.choices(range(k, k + 20), k=rng.randint(1, 60))) for k in (0, 100, 200))
        other = Counter({k: rng.randint(1, 5) for k in common})
        a, b = common + own_a, other + own_b
        x, y = sum(own_a.values()) / sum(a.values()), sum(own_b.values()) / sum(b.values())
        assert similar(a, b) <= (1 - x) * (1 - y) / (1 - x * y) + 1e-9


def test_one_of_each(spark):
    docs = documents(spark, clash=["_row", "node"])
    kept = nearcopies.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    given = awkward()
    singles = {str(r[0]) for r in given if r[0] is not None and r[0] < 40}
    assert singles <= set(ids)
    # 40 (empty), 41 (null) and the null row are copies; white space alone is another text.
    assert ids.count("40") == 1 and ids.count("41") == 0 and ids.count("42") == 1
    # Three repeated rows leave one, the other text of the id stays; twelve copies leave the first.
    assert ids.count("46") == 2 and sum(i in ids for i in map(str, range(48, 60))) == 1 and "48" in ids
    assert ids.count("None") == 1


def test_copies_of_a_text_with_repeats_are_not_all_compared(spark, monkeypatch):
    """Each with three words of its own, too many for a link, beside words that all repeat: shingles of
    their own leave room for links, the others that they lack do not."""
    base, rows = prose(5000, 140).split() + ["la"] * 12 + prose(5001, 20).split(), []
    for i in range(60):
        words = list(base)
        for k in range(3):
            words[random.Random(3 * i + k).randrange(12 + 40 * k, 42 + 40 * k)] = f"odd{i}x{k}"
        rows.append((i, " ".join(words), "en", "a", None))
    linked = len(rows) - len(set(classes(rows).values()))
    compared, verified = [], nearcopies._verified
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    got = {r.doc_id: r.class_id for r in nearcopies.near_copies(documents(spark, rows)).collect()}
    assert got == classes(rows)
    assert linked < 30 and sum(compared) < 60 * 59 / 2 / 3


def test_facts_leave_room_for_every_link(spark):
    """No pair from the threshold on is settled by the facts of its texts, whatever is repeated or added."""
    rng, texts = random.Random(8), [""]
    for g in range(6):
        base = [w for w in prose(6000 + g, 60).split() for _ in range(rng.choice([1, 1, 1, 2, 9]))]
        texts += [edited(g * 50 + i, " ".join(base), [0.005, 0.01, 0.02, 0.04][i % 4]) for i in range(20)]
    rows = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts) if t], "node binary, text string")
    facts = nearcopies._facts(rows)
    one, two = (facts.select(*[facts[c].alias(f"{s}_{c}") for c in facts.columns]) for s in "ab")
    pairs = one.crossJoin(two).filter("a_node < b_node").filter(nearcopies._may_link("a_", "b_", 0.8))
    room = {(r.a_node[0], r.b_node[0]) for r in pairs.select("a_node", "b_node").collect()}
    sets = [shingle_counts(t) for t in texts]
    links = {(i, j) for i in range(1, len(texts)) for j in range(i + 1, len(texts)) if similar(sets[i], sets[j]) >= 0.8}
    assert len(links) > 100 and links <= room and len(room) < 2 * len(links)


def test_empty(spark):
    assert nearcopies.near_copies(empty(spark)).count() == 0 and nearcopies.one_of_each(empty(spark)).count() == 0
