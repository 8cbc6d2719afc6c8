"""Merge source rows changed since a time into the current-state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.changes import latest_per_key, union_rows, with_reason
from changeflow.plans.snapshot import dead_snapshot, typed_snapshot
from changeflow.schema import TableSpec
from changeflow.session import scratch_path, settle
from changeflow.sinks.store import BROADCAST_BYTES, BROADCAST_ROWS, TableStore
from changeflow.sources.scans import Source, delta_scan, open_source


def reconcile_rows(src: DataFrame, current: DataFrame, spec: TableSpec, since: str) -> tuple[DataFrame, DataFrame]:
    """The rows to merge: touched since, one per key, and not older than the target row; and the
    rows that break the rules of the table, with the reason. The source is read once. The target is looked at
    for the touched keys alone: up to `BROADCAST_ROWS` of them are sent to it, and it is not shuffled."""
    if spec.ts_col is None:
        raise ValueError(f"{spec.source} has no change time: it cannot be reconciled")
    ts, keys, seen = spec.targets[spec.ts_col], spec.pk_targets, Observation()
    rows = with_reason(typed_snapshot(delta_scan(src, since, spec.ts_col), spec), spec)
    width = sum((F.octet_length(F.col(k).cast("string")) + 16 for k in keys), F.lit(0))
    totals = [F.count("*").alias("rows"), F.sum(width).alias("bytes")]
    rows = settle(rows, scratch_path(src.sparkSession, "touched"), seen=seen, totals=totals)
    good, bad = rows.filter("error is null").drop("error"), rows.filter("error is not null")
    latest = latest_per_key(good, keys, [F.col(ts).desc()])
    have = current.select(*keys, F.col(ts).alias("_have"))
    if seen.get["rows"] <= BROADCAST_ROWS and (seen.get["bytes"] or 0) <= BROADCAST_BYTES:
        have = have.join(F.broadcast(good.select(*keys).distinct()), keys, "left_semi")
    merged = latest.join(have, keys, "left").filter(F.col("_have").isNull() | (F.col("_have") <= F.col(ts)))
    return merged.select(*good.columns), bad


def as_changes(rows: DataFrame) -> DataFrame:
    """Plain rows as folded upserts."""
    zero = F.lit(0).cast("decimal(20,0)")
    return rows.withColumns(
        {
            "_OP": F.lit("U"),
            "_UNSET": F.array().cast("array<string>"),
            "_COMMIT_LSN": zero,
            "_LSN": zero,
            "_SEQ": F.lit(0).cast("bigint"),
        }
    )


def reconcile(
    spark: SparkSession,
    specs: dict[str, TableSpec],
    sources: dict[str, Source | DataFrame],
    store: TableStore,
    since: str,
    run: str,
    table: str | None = None,
    at: Column | None = None,
) -> bool:
    """One commit over the tables (or one table); tables without a change time are left out, and asking
    for nothing else is an error. Deletes are not seen, history is left alone. Rows that break the
    rules of their table become dead letters."""
    names = [table] if table else [n for n, s in specs.items() if s.ts_col] or list(specs)
    parts = {
        name: reconcile_rows(open_source(spark, sources[name]), store.current(name), specs[name], since)
        for name in names
    }
    dead = union_rows([dead_snapshot(bad, specs[name]) for name, (_, bad) in parts.items()])
    changes = {name: as_changes(good) for name, (good, _) in parts.items()}
    return store.commit(f"reconcile-{run}", 0, changes, extra={"_dead": dead}, at=at)
