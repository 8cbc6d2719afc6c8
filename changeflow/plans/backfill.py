"""Resumable bulk load of the current-state tables from a source snapshot."""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from changeflow.operators.changes import stamp_loaded, with_reason
from changeflow.plans.snapshot import dead_snapshot, typed_snapshot
from changeflow.schema import TableSpec
from changeflow.session import one_line, run_together
from changeflow.sinks import files
from changeflow.sinks.store import TableStore
from changeflow.sources.scans import Source, open_source, snapshot_scan

#: Scheduler pool of the chunks, with its share of the cluster if the session schedules fairly.
POOL = "backfill"
#: Folders of a chunk.
GOOD, BAD = "good", "bad"


def chunk_bounds(low: int, high: int, chunks: int) -> list[tuple[int | None, int | None]]:
    """Half-open ranges that cover every key: the first has no lower, the last no upper end."""
    step = max(1, -(-(high - low + 1) // chunks))
    cuts: list[int | None] = [None, *range(low + step, high + 1, step), None]
    return list(zip(cuts[:-1], cuts[1:]))


def depth_bounds(src: DataFrame, key: str, chunks: int) -> list[tuple[int | None, int | None]]:
    """Half-open ranges of about as many rows each, whatever lies between the keys: cut at quantiles of the
    key, found by a sketch in one pass over the key alone. The first range has no lower, the last no
    upper end; a key that many rows share is never cut."""
    if isinstance(src.schema[key].dataType, StringType):
        raise ValueError(f"ranges need a number as first key column, {key} is text")
    shares = [k / chunks for k in range(1, chunks)] or [0.5]
    found = src.agg(F.min(key).alias("low"), F.percentile_approx(key, shares, max(10_000, 100 * chunks)).alias("cuts")).first()
    if found["low"] is None:
        return []
    inner = sorted({int(c) for c in found["cuts"] if c > found["low"]}) if chunks > 1 else []
    cuts: list[int | None] = [None, *inner, None]
    return list(zip(cuts[:-1], cuts[1:]))


def _plan(store: TableStore, spec: TableSpec, folder: str, src: DataFrame, run: str, chunks: int) -> list:
    """The ranges of a run, kept with it so that a resumed run uses the same ones. The hold begins
    before anything is read."""
    path, key = f"{folder}/plan", spec.pk[0]
    if not files.written(store.spark, path):
        store.hold(spec.source, run)
        try:
            ranges = depth_bounds(src, key, chunks)
        except ValueError as error:
            raise ValueError(f"{spec.source}: {error}") from None
        one_line(store.spark, json.dumps(ranges)).write.mode("overwrite").text(path)
    return json.loads(store.spark.read.text(path).first()[0])


def overwrite_load(df: DataFrame, folder: str) -> None:
    """Write a folder anew, whatever an earlier attempt left in it. Rows that carry a `_KIND` go to a folder
    for each kind."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy("_KIND") if "_KIND" in df.columns else writer).parquet(folder)


def append_load(df: DataFrame, folder: str, chunk: int) -> bool:
    """Write one chunk below a folder, unless it is already complete. The chunk is replaced as
    a whole, so a second attempt adds no row twice."""
    path = f"{folder}/chunk={chunk}"
    if files.written(df.sparkSession, path):
        return False
    overwrite_load(df, path)
    return True


def load_chunk(store: TableStore, spec: TableSpec, part: DataFrame, folder: str, chunk: int, at: Column | None) -> Row | None:
    """Read one range once: rows for the table and rows that break its rules go to folders of their own in
    one write, which counts both. None if the chunk was complete before."""
    store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", POOL)
    rows = stamp_loaded(with_reason(typed_snapshot(part, spec), spec), at)
    rows, seen = rows.withColumn("_KIND", F.when(F.col("error").isNull(), GOOD).otherwise(BAD)), Observation()
    good, bad = (F.count_if(F.col("_KIND") == kind).alias(kind) for kind in (GOOD, BAD))
    return seen.get if append_load(rows.observe(seen, good, bad), folder, chunk) else None


def backfill_table(
    store: TableStore,
    spec: TableSpec,
    src: Source | DataFrame,
    run: str,
    chunks: int = 8,
    at: Column | None = None,
    at_once: int = 8,
) -> int:
    """Load one table. Chunks are jobs of their own, `at_once` at a time, in one pool of the scheduler; those
    that are complete are skipped, and the table shows the new rows only when all of them are there. Each
    range reaches the source as a filter on the key, which should be indexed or sorted there, as for
    paging; the first one also takes the rows without key. Nothing is read twice but the key, for the ranges."""
    spark, key = store.spark, spec.pk[0]
    folder = f"{store.root}/{spec.current}/base/{run}"
    writer = f"backfill-{run}-{spec.source}"
    if store.done(writer, 1):
        return store.head()["tables"].get(spec.current, {"rows": 0})["rows"]
    ranges = _plan(store, spec, folder, open_source(spark, src), run, chunks)
    parts = [snapshot_scan(spark, src, key, low, high) for low, high in ranges]
    counts = run_together([partial(load_chunk, store, spec, part, folder, i, at) for i, part in enumerate(parts)], at_once)
    found = [f"{folder}/chunk={i}" for i in range(len(ranges))]
    if None in counts:  # an earlier attempt wrote some: footers know their numbers
        whole = spark.read.option("basePath", folder).schema("chunk int, _KIND string").parquet(*found)
        sizes = {r["_KIND"]: r["count"] for r in whole.groupBy("_KIND").count().collect()}
        counts = [{GOOD: sizes.get(GOOD, 0), BAD: sizes.get(BAD, 0)}]
    rows, broken = (sum(c[kind] for c in counts) for kind in (GOOD, BAD))
    if broken:
        places = [f"{path}/_KIND={BAD}" for path in found if files.exists(spark, f"{path}/_KIND={BAD}")]
        bad = spark.read.schema(f"{spec.current_ddl()}, error string").parquet(*places)
        store.commit(writer, 0, {}, extra={"_dead": dead_snapshot(bad, spec)})
    places = [f"{path}/_KIND={GOOD}" for path in found if files.exists(spark, f"{path}/_KIND={GOOD}")]
    store.replace_base(spec.source, places, rows, run, writer)
    return rows


def backfill(
    spark: SparkSession,
    specs: dict[str, TableSpec],
    sources: dict[str, Source | DataFrame],
    store: TableStore,
    run: str = "initial",
    chunks: int = 8,
    at: Column | None = None,
) -> dict[str, int]:
    """Load the tables in order; history is left alone. Start it again with the same run name
    to go on where it stopped."""
    return {
        name: backfill_table(store, spec, sources[name], run, chunks, at)
        for name, spec in specs.items()
    }
