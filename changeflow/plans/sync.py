"""Drift check and staleness report over all tables."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.checks import DRIFT_THRESHOLD, compare_counts, drift
from changeflow.operators.changes import union_rows
from changeflow.operators.metrics import staleness

log = logging.getLogger(__name__)

Rows = Callable[[], DataFrame]


def count_or_none(name: str, rows: Rows) -> int | None:
    """Exact count; None when the table cannot be read, so that the others go on."""
    try:
        return rows().count()
    except Exception as error:
        log.error("cannot count %s: %s", name, error)
        return None


def sync_check(
    spark: SparkSession,
    pairs: dict[str, tuple[Rows, Rows]],
    threshold: int = DRIFT_THRESHOLD,
    estimates: dict[str, int] | None = None,
) -> DataFrame:
    """Source and target counts per table, their difference and whether it is in bounds. A
    positive estimate spares the count of the source."""
    source, target = [], []
    for name, (src, tgt) in pairs.items():
        known = (estimates or {}).get(name, 0)
        source.append((name, known if known > 0 else count_or_none(name, src)))
        target.append((name, count_or_none(name, tgt)))
    schema = "table_name string, row_count bigint"
    counts = compare_counts(
        spark.createDataFrame(source, schema), spark.createDataFrame(target, schema)
    )
    return drift(counts, threshold)


def staleness_report(histories: dict[str, DataFrame], now: Column) -> DataFrame:
    """Newest change, lag and size of every history table, in one pass over all of them."""
    rows = [h.select(F.lit(n).alias("table_name"), "_CDC_TS") for n, h in histories.items()]
    return staleness(union_rows(rows), now, ["table_name"])
