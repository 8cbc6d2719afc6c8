import random
import re

import numpy as np
import pytest
from fixtures import awkward, documents, empty, prose

from changeflow.llm import leaks


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def best_alignment(item, text):
    """Smith-Waterman cell by cell."""
    above, best = [0] * (len(text) + 1), 0
    for w in item:
        row = [0]
        for j, v in enumerate(text):
            score = above[j] + (leaks.MATCH if w == v else leaks.MISS)
            row.append(max(0, score, above[j + 1] - leaks.GAP, row[j] - leaks.GAP))
        best, above = max(best, *row), row
    return best / (leaks.MATCH * len(item))


def items():
    out = [(i, prose(7000 + i, 12 + 5 * i)) for i in range(12)] + [(50, prose(7100, 150)), (51, "two words"), (52, ""), (53, None)]
    return out + [(54, "Éa été là où naît l’eau claire du moulin")]


def changed(seed, text, share):
    rng, out = random.Random(seed), []
    for w in text.split():
        turn = rng.random()
        out += [w] if turn > share else [] if turn < share / 3 else ["other"] if turn < 2 * share / 3 else [w, "more"]
    return " ".join(out)


def training():
    rows = [(i, f"{prose(i, 70)}. {changed(i, items()[i % 12][1], [0, 0.1, 0.2, 0.3][i % 4])}, {prose(200 + i, 40)}") for i in range(48)]
    rows += [(60, prose(60, 2000) + " " + items()[3][1].upper() + " " + prose(61, 300)), (61, items()[12][1])]
    rows += [(62, "ÉA ÉTÉ LÀ OÙ NAÎT L’EAU CLAIRE DU MOULIN"), (63, "two words"), (64, prose(64, 500))]
    return [(i, t, "en", "a", None) for i, t in rows]


def test_against_every_alignment(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = documents(spark, training(), clash=["item_id", "t", "gram"])
    got = {(r.doc_id, r.item_id): r.score for r in leaks.leaks(docs, bench).collect()}
    wanted = {}
    for i, text, *_ in training():
        for j, item in items():
            item = words_of(item)
            if 3 <= len(item) <= leaks.SEGMENT:
                score = best_alignment(item, words_of(text))
                if score >= leaks.THRESHOLD:
                    wanted[i, j] = score
    # Items 11 and 50 are longer than a segment: they are found by a part.
    assert {k for k in got if k[1] not in (11, 50)} == set(wanted)
    assert {(i, 11) for i in (11, 23, 35, 47)} <= set(got)
    for key, score in wanted.items():
        assert got[key] == pytest.approx(score)
    assert got[61, 50] == 1.0 and not any(k[1] in (51, 52, 53) for k in got)


def edited():
    """One copy of an item each, with every n-th word replaced or a word put in after every n-th."""
    out = []
    for k, (kind, n) in enumerate((kind, n) for kind in ("replaced", "more") for n in (2, 3, 4, 5)):
        words = prose(900 + k, 40).split()
        if kind == "replaced":
            words = [f"new{i}" if i % n == n - 1 else w for i, w in enumerate(words)]
        else:
            words = [x for i, w in enumerate(words) for x in ([w, f"new{i}"] if i % n == n - 1 else [w])]
        out.append((k, f"{prose(950 + k, 70)} {' '.join(words)} {prose(970 + k, 90)}", "en", "a", None))
    return out


@pytest.mark.parametrize("sent", [True, False])
def test_copies_with_no_long_run_unedited(spark, monkeypatch, sent):
    """Each is the only copy, so what an edit broke is rarer than what it left."""
    if not sent:
        monkeypatch.setattr(leaks, "BROADCAST_ROWS", 0)
    rows = [(k, prose(900 + k, 40)) for k in range(8)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in leaks.leaks(documents(spark, edited()), bench).collect()}
    wanted = {(i, j): best_alignment(words_of(item), words_of(text)) for i, text, *_ in edited() for j, item in rows}
    wanted = {k: v for k, v in wanted.items() if v >= leaks.THRESHOLD}
    assert got == pytest.approx(wanted) and {(k, k) for k in (2, 3, 4, 5, 6, 7)} <= set(got)


def test_align_cell_by_cell():
    rng = np.random.default_rng(0)
    items_, passages = rng.integers(2, 8, (60, 12)), rng.integers(2, 8, (60, 40))
    lengths = rng.integers(1, 13, 60)
    items_ = np.where(np.arange(12) < lengths[:, None], items_, 0)
    share, _ = leaks.align(items_, passages, lengths)
    for item, text, n, s in zip(items_, passages, lengths, share):
        assert s == pytest.approx(best_alignment(item[:n].tolist(), text.tolist()))


def test_rows_without_leaks_stay_as_they_are(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    clean = documents(spark, clash=["_row", "t"])
    kept = leaks.without_leaks(clean, bench)
    assert kept.columns == clean.columns and kept.count() == len(awkward())
    bad = [(None, items()[5][1], "en", "a", None), (46, "x " + items()[6][1], "en", "a", None)]
    mixed = documents(spark, awkward() + bad)
    assert leaks.without_leaks(mixed, bench).count() == len(awkward())


def test_empty(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert leaks.leaks(empty(spark), bench).count() == 0
    assert leaks.leaks(documents(spark), bench.limit(0)).count() == 0
    assert leaks.without_leaks(documents(spark), bench.limit(0)).count() == len(awkward())


def test_map_finds_every_seed(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)
    grams = spark.createDataFrame([(int(v),) for v in values], "gram long")
    bits = leaks._bit_map(grams, 500)
    assert leaks._marked(values.view(np.uint64), bits).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20_000).view(np.uint64)
    assert leaks._marked(others, bits).mean() < 0.01


def test_scattered_words_are_not_aligned(monkeypatch):
    """Passages with many of an item's words but none in a run, as common words lie, are told by their counts;
    whatever reaches the threshold is aligned, with the score that it has."""
    rng, seen, align = np.random.default_rng(5), [], leaks.align
    monkeypatch.setattr(leaks, "align", lambda *rows: seen.append(len(rows[0])) or align(*rows))
    lengths = rng.integers(3, 65, 400)
    items = rng.integers(10, 200, (400, leaks.SEGMENT))
    items[np.arange(leaks.SEGMENT) >= lengths[:, None]] = 0
    passages = rng.integers(1000, 9000, (400, leaks.PASSAGE))
    for k in range(400):
        own = items[k, : lengths[k]]
        if k % 2:  # copies with words replaced and put in, from few to too many
            copy = [x for w in own for x in ([w] if rng.random() > (k % 20) / 20 else [7, w] if rng.random() < 0.5 else [7])]
            passages[k, 30 : 30 + len(copy)] = copy
        else:  # six of ten words, far from each other
            some = rng.permutation(own)[: -(-6 * len(own) // 10)]
            passages[k, 3 * np.arange(len(some))] = some
    share, end = align(items, passages, lengths)
    rows, found, ends = leaks._reaching(items, passages, lengths, 0.5)
    wanted = np.flatnonzero(share >= 0.5)
    assert list(rows) == list(wanted) and (found == share[wanted]).all() and (ends == end[wanted]).all()
    assert 50 < len(wanted) < 200 and sum(seen) < 1.3 * len(wanted)
