"""Comparing source and target: counts, drift and the report on it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Threshold, metric names, report texts.
DRIFT_THRESHOLD = 100
SYNC_METRICS = {
    "cdc.sync.pg_row_count": "source_rows",
    "cdc.sync.sf_row_count": "target_rows",
    "cdc.sync.row_diff": "diff",
    "cdc.sync.in_sync": "in_sync",
}
REPORT_LINE = "[%s] %s: PG=%s  SF=%s  diff=%s"
DRIFT_TEXT = (
    "PostgreSQL has **%s** rows, Snowflake has **%s** rows — drift of **%s** rows (threshold %s)."
)


def table_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def footer_count(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Parquet table from the footers of its files: the count is pushed into the scan, which
    Spark does for its newer reader alone. That is set in a session beside the caller's."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return table_count(own.read.parquet(path))


def table_statistics(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, estimate) from the statistics the catalog keeps of each table, by the name it is
    reported under; NULL where there are none."""
    rows = []
    for name, table in tables.items():
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Statistics'").first()
        known = re.search(r"(\d+) rows", found["data_type"]) if found else None
        rows.append((name, int(known[1]) if known else None))
    return spark.createDataFrame(rows, "table_name string, estimate bigint")


def estimate_count(stats: DataFrame, exact: DataFrame) -> DataFrame:
    """Row count per table: the estimate where there is a positive one, else the exact count.
    `stats` is (table_name, estimate), `exact` is (table_name, row_count)."""
    usable = F.when(F.col("estimate") > 0, F.col("estimate"))
    return exact.join(stats, "table_name", "left").select(
        "table_name", F.coalesce(usable, F.col("row_count")).alias("row_count")
    )


def compare_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts side by side; a table missing on one side has NULL there."""
    return source.select("table_name", F.col("row_count").alias("source_rows")).join(
        target.select("table_name", F.col("row_count").alias("target_rows")),
        "table_name",
        "full_outer",
    )


def drift(counts: DataFrame, threshold: int = DRIFT_THRESHOLD) -> DataFrame:
    """Difference per table and whether it is within the threshold. A missing count is shown as
    0 and is never in sync."""
    gap = F.abs(F.col("source_rows") - F.col("target_rows"))
    return counts.select(
        "table_name",
        F.coalesce("source_rows", F.lit(0)).cast("bigint").alias("source_rows"),
        F.coalesce("target_rows", F.lit(0)).cast("bigint").alias("target_rows"),
        F.coalesce(gap, F.lit(0)).cast("bigint").alias("diff"),
        F.coalesce(gap <= threshold, F.lit(False)).alias("in_sync"),
        (F.col("source_rows").isNull() | F.col("target_rows").isNull()).alias("failed"),
    )


def all_in_sync(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.bool_and("in_sync"), F.lit(True)).alias("all_in_sync"))


def _thousands(c: str) -> Column:
    return F.format_number(F.col(c), 0)


def drift_report(results: DataFrame, threshold: int = DRIFT_THRESHOLD) -> DataFrame:
    """One line per table, and the message about a drift where there is one."""
    status = F.when(F.col("in_sync"), "OK").otherwise("DRIFT")
    counts = [_thousands("source_rows"), _thousands("target_rows"), _thousands("diff")]
    drifted = ~F.col("in_sync") & ~F.col("failed")
    return results.select(
        "table_name",
        F.format_string(REPORT_LINE, status, F.col("table_name"), *counts).alias("line"),
        F.when(
            drifted, F.format_string(DRIFT_TEXT, *counts, F.format_number(F.lit(threshold), 0))
        ).alias("drift_text"),
    )


def sync_metrics(results: DataFrame) -> DataFrame:
    """Four gauges per table that could be counted."""
    gauges = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
            for m, c in SYNC_METRICS.items()
        ]
    )
    tag = F.concat(F.lit("table:"), F.lower("table_name")).alias("tag")
    return results.filter(~F.col("failed")).select(tag, F.inline(gauges))
