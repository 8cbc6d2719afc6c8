"""Whitening of embeddings by their leading components, found by Chebyshev-filtered subspace iteration.

A block of directions Q goes through a polynomial of the covariance that is small on the unwanted part
of the spectrum and grows fast above it; each step of the polynomial's recurrence is one distributed
pass that adds up X'(XQ) over the centred vectors. QR and Rayleigh-Ritz follow, until the residuals
certify the pairs wanted. The driver holds matrices of dimensions x directions, never a vector of data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.arrow import renamed, ship
from changeflow.session import scratch_path, settle

COMPONENTS = 4
#: Directions beyond those wanted; the unwanted spectrum begins below the last of them.
SPARE = 28
#: Degrees of the filter: of the first, and the most of a later one.
FIRST_DEGREE, MOST_DEGREE = 4, 16
#: A residual below this share of the largest eigenvalue certifies a pair; rounds end there, or when the
#: residuals stop falling at or below FLOOR. After so many rounds without either, the block is doubled.
CERTIFIED, FLOOR, ROUNDS = 1e-13, 1e-9, 8
#: An eigenvalue below this share of the largest one is none.
RANK = 1e-11
#: Entries up to this are multiplied in 64 bits; others in whole numbers of any length.
PLAIN = 1 << 20
ROWS_AT_ONCE = 1 << 14
#: Sums are added in parts below and from this on.
BASE = 10**15


def grid(vector: Column) -> Column:
    """floor(256 c) of each entry, as long; null if an entry is null or not finite. Entries beyond the range
    of long take its nearest end."""
    values = F.transform(vector, lambda c: c.cast("double"))
    good = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), F.transform(values, lambda c: F.floor(c * 256)))


def usable(rows: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """`vec_id` and `x` of the rows with whole vectors, and their number of entries: the one most rows have
    (of several the largest). Rows of another one are left out."""
    found = renamed(rows, vec_id=vec_id, x=grid(F.col(f"`{vector}`"))).filter("x is not null")
    sizes = found.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = sizes[0].d if sizes else 0
    return found.filter(F.size("x") == d), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _pieces(batches, column: str, d: int):
    """Matrices of some rows at a time, with the batch and the place of their first."""
    for batch in batches:
        whole = batch.column(batch.schema.get_field_index(column))
        for low in range(0, len(whole), ROWS_AT_ONCE):
            part = whole.slice(low, ROWS_AT_ONCE)
            yield batch, low, _matrix(part, d)


@dataclass
class Sums:
    """Exact sums over the fit list: rows, entries by dimension, and squares of all entries."""

    n: int
    s: list[int]
    squares: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([v / self.n for v in self.s])

    @property
    def trace(self) -> float:
        """Of the covariance."""
        return (self.n * self.squares - sum(v * v for v in self.s)) / (self.n * self.n)


def sums(fit: DataFrame, d: int) -> Sums:
    """Tasks add in whole numbers of any length; one row for each dimension leaves a task."""

    def add(batches):
        n, total, squares = 0, np.zeros(d, dtype=object), np.zeros(d, dtype=object)
        for _, _, x in _pieces(batches, "x", d):
            n += len(x)
            if len(x) and np.abs(x).max() >= PLAIN or (x == -(1 << 63)).any():
                x = x.astype(object)
            total, squares = total + x.sum(axis=0), squares + (x * x).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d), pa.array([str(int(v)) for v in total]), pa.array([str(int(v)) for v in squares])],
                ["k", "n", "s", "q"],
            )

    rows = fit.mapInArrow(add, "k int, n long, s string, q string")
    # Whole numbers in two halves, so that Spark adds them without rounding however large they are.
    half = lambda c: [F.sum((F.col(c).cast("decimal(38,0)") % BASE)).alias(f"{c}_low"), F.sum(F.expr(f"cast({c} as decimal(38,0)) div {BASE}")).alias(f"{c}_high")]
    found = rows.groupBy("k").agg(F.sum("n").alias("n"), *half("s"), *half("q")).orderBy("k").collect()
    whole = lambda r, c: int(r[f"{c}_high"]) * BASE + int(r[f"{c}_low"])
    return Sums(found[0].n, [whole(r, "s") for r in found], sum(whole(r, "q") for r in found)) if found else Sums(0, [], 0)


def product(fit: DataFrame, d: int, mean: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """Q -> V Q for the covariance V: one pass, in which each task hands on a row for each dimension."""

    def times(q: np.ndarray) -> np.ndarray:
        width = q.shape[1]
        names = [f"q{k}" for k in range(width)]

        def add(batches):
            total, seen = np.zeros((d, width)), False
            for _, _, x in _pieces(batches, "x", d):
                z = x - mean
                total += z.T @ (z @ q)
                seen = True
            if seen:
                columns = [pa.array(range(d), pa.int32()), *(pa.array(total[:, k]) for k in range(width))]
                yield pa.RecordBatch.from_arrays(columns, ["k", *names])

        rows = fit.mapInArrow(add, f"k int, {', '.join(f'{c} double' for c in names)}")
        found = rows.groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).orderBy("k").collect()
        return np.array([[r[c] for c in names] for r in found]) / n

    return times


def leading(times: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, spare: int = SPARE, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """The `wanted` largest eigenvalues of a symmetric matrix given by its products, unit eigenvectors as
    columns, and the largest residual as a share of the largest eigenvalue.

    The filter damps what lies between 0 and the least Ritz value of the block. Its degree grows from round to
    round. Where more eigenvalues than the block holds are nearly equal, nothing sets the wanted ones apart: then
    the block is doubled, and once it holds all directions Rayleigh-Ritz alone is exact."""
    rng = np.random.default_rng(seed)
    wanted, width = min(wanted, d), min(d, wanted + spare)
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    best, degree, rounds = np.inf, FIRST_DEGREE, 0
    while True:
        image = times(q)
        values, turned = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, image = q @ turned, image @ turned
        top = max(values[0], 0.0)
        residual = np.linalg.norm(image[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        residual = residual / top if top > 0 else 0.0
        settled = residual <= FLOOR and residual > best / 2
        if residual <= CERTIFIED or settled or width == d and rounds:
            values, q = values[:wanted], q[:, :wanted]
            return np.maximum(values, 0.0), q / np.linalg.norm(q, axis=0), float(residual)
        best, rounds = min(best, residual), rounds + 1
        if width < d:
            q = _filtered(times, q, image, max(values[-1], top * 1e-14), top, degree)
            degree = min(MOST_DEGREE, degree * 2)
            if rounds % ROUNDS == 0:
                width, best = min(d, 2 * width), np.inf
                rounds = 0 if width == d else rounds
                q = np.hstack((q / np.linalg.norm(q, axis=0), rng.standard_normal((d, width - q.shape[1])) / np.sqrt(d)))
        # With all directions one more step, from the eigenvectors found, takes out what rounding left.
        q = np.linalg.qr(q)[0]


def _filtered(times, q: np.ndarray, image: np.ndarray, unwanted: float, top: float, degree: int) -> np.ndarray:
    """Chebyshev polynomial of the matrix on [0, unwanted], scaled to 1 at `top`; the first product is known."""
    half = unwanted / 2
    scale = half / (half - top) if top > half else 1.0
    first, now, before = scale, (image - half * q) * (scale / half), q
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        now, before = (times(now) - half * now) * (2 * following / half) - before * (scale * following), now
        scale = following
    return now


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each row and component: `vec_id`, `component` (from 1, by falling eigenvalue), `n`, `deviation`,
    `whitened`, `explained` and `identity_error`.

    x = floor(256 c) of the entries; the covariance (divisor n, centred) is over the n distinct x. `deviation`
    is the exact sum of (n x - S)^2, S the sums by dimension, null where it leaves the range of long. `whitened`
    is x - S/n projected on the component, over the root of its eigenvalue; `explained` the eigenvalue over the
    trace; `identity_error` the largest entry of the covariance of `whitened` over the fit list, less the
    identity, of the components that have variance.

    Rows whose vector is null or holds a null or an entry that is not finite are dropped, and those of another
    length than most; null ids and repeated rows stay as they are; a component without variance has a null
    `whitened` and 0 as `explained` (null if there is no variance at all); equal eigenvalues share their
    space in some fixed way; an empty table gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    found, d = usable(rows, vec_id, vector)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    kind = dict(found.dtypes)["vec_id"]
    if not d:
        return _none(spark, kind, schema)
    fit = settle(found.select("x").distinct(), scratch_path(spark, "vectors"))
    total = sums(fit, d)
    mean, wanted = total.mean, min(components, d)
    values, axes, _ = leading(product(fit, d, mean, total.n), d, wanted)
    held = int((values > RANK * values[0]).sum()) if total.trace > 0 else 0
    axes, root = axes[:, :held], np.sqrt(values[:held])
    error = identity_error(fit, d, mean, total.n, axes / root) if held else 0.0
    explained = [float(v) / total.trace if k < held else 0.0 for k, v in enumerate(values)] if held else [None] * wanted

    def project(batches):
        for batch, low, x in _pieces(batches, "x", d):
            n = len(x)
            scores = np.zeros((n, wanted))
            scores[:, :held] = ((x - mean) @ axes) / root
            empty = np.tile(np.arange(wanted) >= held, n)
            columns = [
                batch.column(0).slice(low, n).take(pa.array(np.repeat(np.arange(n), wanted))),
                pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), n)), pa.array(np.full(n * wanted, total.n)),
                pa.array(deviations(x, total)).take(pa.array(np.repeat(np.arange(n), wanted))),
                pa.array(scores.ravel(), mask=empty), pa.array(explained * n, pa.float64()), pa.array(np.full(n * wanted, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", *(f.split()[0] for f in schema.split(", "))])

    return found.select("vec_id", "x").mapInArrow(project, f"vec_id {kind}, {schema}")


def _none(spark: SparkSession, kind: str, schema: str) -> DataFrame:
    return spark.createDataFrame([], f"vec_id {kind}, {schema}")


def deviations(x: np.ndarray, total: Sums) -> pa.Array:
    """Sum over the dimensions of (n x - S)^2 of each row, exact; null beyond long."""
    most = max(map(abs, total.s), default=0) + total.n * max(int(x.max(initial=0)), -int(x.min(initial=0)))
    exact = np.int64 if most * most * x.shape[1] < 1 << 62 else object
    away = x.astype(exact) * total.n - np.array(total.s, dtype=exact)
    squares = (away * away).sum(axis=1)
    return pa.array([int(v) if v < 1 << 63 else None for v in squares], pa.int64())


def identity_error(fit: DataFrame, d: int, mean: np.ndarray, n: int, axes: np.ndarray) -> float:
    """Largest entry of the covariance of the projections, less the identity: sums and products of pairs are
    added up in one pass."""
    width = axes.shape[1]

    def add(batches):
        total, seen = np.zeros((width + 1, width)), False
        for _, _, x in _pieces(batches, "x", d):
            scores = (x - mean) @ axes
            total += np.vstack((scores.T @ scores, scores.sum(axis=0)))
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["k", "v"])

    found = fit.mapInArrow(add, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").collect()
    total = np.array([r.v for r in found]).reshape(width + 1, width) / n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(width)).max())
