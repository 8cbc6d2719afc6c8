import numpy as np
import pytest

from changeflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows, clash=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in clash:
        df = df.selectExpr("*", f"'y' as `{name}`")
    return df


def vectors(seed, n, d, rank=None):
    rng = np.random.default_rng(seed)
    shape = rng.standard_normal((rank or d, d)) * np.linspace(1, 3, rank or d)[:, None]
    return (rng.standard_normal((n, rank or d)) @ shape / 8 + rng.standard_normal(d)).astype(np.float32)


def check(spark, rows, wanted=4, clash=()):
    """Against a full eigendecomposition, deviations in whole numbers of any length."""
    good = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256.0 * float(np.float32(c)))) for c in v] for _, v in good], dtype=object)
    fit = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    z = (fit * n - s).astype(float) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = sorted(map(tuple, whitening.whiten(table(spark, rows, clash)).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[3], r[1]))
    held = int((values > 1e-9 * max(values[0], 1e-300)).sum()) if n > 1 else 0
    d = x.shape[1]
    want = []
    for (i, _), row in zip(good, x):
        away = (row * n - s).astype(float) / n
        deviation = int(((row * n - s) ** 2).sum())
        for k in range(min(wanted, d)):
            score = float(away @ axes[:, k] / np.sqrt(values[k])) if k < held else None
            want.append((i, k + 1, n, deviation if deviation < 1 << 63 else None, score, float(values[k] / values.sum()) if k < held else (0.0 if held else None)))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[3] or 0, r[1]))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in range(1, min(wanted, d) + 1):
        a, b = [r for r in got if r[1] == k], [r for r in want if r[1] == k]
        if k > held:
            assert all(r[4] is None for r in a)
            continue
        p, q = np.array([r[4] for r in a]), np.array([r[4] for r in b])
        assert min(np.abs(p - q).max(), np.abs(p + q).max()) < 1e-9
        assert np.allclose([r[5] for r in a], [r[5] for r in b], rtol=1e-10)
    assert all(r[6] < 1e-9 for r in got)


def rows_of(x):
    return [(k, [float(c) for c in v], 0) for k, v in enumerate(x)]


@pytest.mark.parametrize("n, d", [(400, 80), (300, 6), (50, 40), (120, 3)])
def test_equals_a_full_decomposition(spark, n, d):
    check(spark, rows_of(vectors(n, n, d)))


def test_fewer_directions_than_components(spark):
    check(spark, rows_of(vectors(1, 60, 50, rank=1)[:, :2]))
    check(spark, [(1, [0.5, 0.25, -1.0], 0)] * 3)


def test_awkward_rows(spark):
    x = vectors(2, 200, 40)
    rows = rows_of(x) + [(None, rows_of(x)[3][1], 1), (3, rows_of(x)[3][1], 1)] * 40
    rows += [(900, None, 1), (901, [None] * 40, 1), (902, [float("nan")] * 40, 1), (903, [float("inf")] + [0.0] * 39, 1), (904, [-0.0] * 40, 0)]
    check(spark, rows, clash=["x", "n", "component", "whitened", "_kept"])


def test_large_entries(spark):
    """Their deviations leave the range of long."""
    rows = rows_of(vectors(4, 40, 5) * np.float32(1e9))
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.deviation for r in got} == {None} and got[0].identity_error < 1e-6


def test_rows_of_another_length_are_left_out(spark):
    rows = rows_of(vectors(5, 30, 6)) + [(100, [1.0, 2.0], 0), (101, [], 0)]
    assert {r.vec_id for r in whitening.whiten(table(spark, rows)).collect()} == set(range(30))


def test_empty(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)]):
        got = whitening.whiten(table(spark, rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.collect() == []


def test_the_filter_finds_close_and_equal_eigenvalues():
    rng = np.random.default_rng(8)
    axes = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    for values in ([5, 5, 4.99, 4.98, *np.linspace(4.9, 0, 196)], [9, 1, 1, 1, *[1] * 50, *[0.0] * 146]):
        matrix = axes @ np.diag(values) @ axes.T
        found, q, residual = whitening.leading(lambda b: matrix @ b, 200, 4)
        assert np.allclose(found, values[:4], rtol=1e-12) and residual < 1e-9
        assert np.allclose(q.T @ q, np.eye(4), atol=1e-12)
