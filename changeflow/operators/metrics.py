"""Counts, gauges, rates and ages over change events and metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.scalars import op_name

# Metric names, the tag of a flush, the length of a reason tag.
PROCESSED = "cdc.events.processed"
PUBLISHED = "cdc.events.published"
FLUSH_EVENTS = "cdc.snowflake.flush_events"
FLUSH_MS = "cdc.snowflake.flush_duration_ms"
POLL_MS = "cdc.poll.duration_ms"
ERRORS = "cdc.snowflake.errors"
RECONNECTS = "cdc.reconnects"
RUN = "cdc.run"
LAG_MS = "cdc.replication.lag_ms"
FLUSHED = "flushed"
REASON_LENGTH = 32
# Messages a batch has taken, the first keys it merged (key as op, position as value), the time of its trigger, and the rows it read, each reading counted.
MESSAGES = "cdc.poll.messages"
FIRST_KEYS = "cdc.merge.first_keys"
BATCH_MS = "cdc.batch.duration_ms"
ROWS_READ = "cdc.batch.rows_read"


def count_events(changes: DataFrame) -> DataFrame:
    """Events per table and operation name."""
    return changes.groupBy("table_name", op_name(F.col("op")).alias("op_name")).agg(
        F.count("*").alias("events")
    )


def flush_counts(changes: DataFrame) -> DataFrame:
    """Events written per batch and table."""
    return changes.groupBy("batch_id", "table_name").agg(F.count("*").alias("events"))


def published_flushes(changes: DataFrame) -> DataFrame:
    """Batches in which a table was written, once per batch."""
    per_batch = changes.select("batch_id", "table_name").distinct()
    return per_batch.groupBy("table_name").agg(F.count("*").alias("flushes")).withColumn(
        "op_name", F.lit(FLUSHED)
    )


def confirmed_lsn(changes: DataFrame) -> DataFrame:
    """Highest commit position; rows outside a transaction count with their own position."""
    position = F.when(F.col("commit_lsn") != 0, F.col("commit_lsn")).otherwise(F.col("lsn"))
    return changes.agg(F.max(position).alias("confirmed_lsn"))


def lsn_range(changes: DataFrame) -> DataFrame:
    """Position of the first and the last event in arrival order."""
    return changes.agg(
        F.min_by("lsn", "seq").alias("first_lsn"), F.max_by("lsn", "seq").alias("last_lsn")
    )


def _minute(c: Column) -> Column:
    """Minutes since 1970 of a time without zone; no session zone has a part in it."""
    c = c.cast("timestamp_ntz")
    return F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)


def ntz_millis(c: Column) -> Column:
    """Milliseconds since 1970 of a time without zone; no session zone has a part in it."""
    c = c.cast("timestamp_ntz")
    return _minute(c) * 60_000 + F.floor(F.extract(F.lit("SECOND"), c) * 1000)


def staleness(history: DataFrame, now: Column, by: list[str] | None = None) -> DataFrame:
    """Newest change, minute boundaries between it and `now`, number of history rows."""
    newest = F.max("_CDC_TS")
    return history.groupBy(*(by or [])).agg(
        newest.alias("latest_pg_change"),
        (_minute(now) - _minute(newest)).alias("lag_minutes"),
        F.count("*").alias("total_history_rows"),
    )


def throughput(changes: DataFrame) -> DataFrame:
    """Events per second of commit time; 0 when no time has passed."""
    seconds = (F.max("ts_ms") - F.min("ts_ms")) / 1000.0
    total = F.count("*")
    rate = F.when(seconds > 0, total / seconds).otherwise(F.lit(0.0))
    return changes.agg(
        total.alias("total_events"),
        F.coalesce(seconds, F.lit(0.0)).alias("elapsed_s"),
        rate.alias("events_per_s"),
    )


def latest_gauge(metrics: DataFrame) -> DataFrame:
    """Last value per metric and set of tags (the order of tags does not matter)."""
    tags = F.array_sort("tags").alias("tags")
    return metrics.groupBy("metric", tags).agg(F.max_by("value", "at").alias("value"))


def sum_counter(metrics: DataFrame) -> DataFrame:
    """Sum per metric and set of tags."""
    tags = F.array_sort("tags").alias("tags")
    return metrics.groupBy("metric", tags).agg(F.sum("value").alias("value"))


def zero_fill(counts: DataFrame, tables: DataFrame, ops: list[str]) -> DataFrame:
    """A count for every table and operation, 0 where nothing happened."""
    names = F.explode(F.array(*[F.lit(o) for o in ops])).alias("op_name")
    grid = tables.select("table_name").distinct().select("table_name", names)
    return grid.join(counts, ["table_name", "op_name"], "left").select(
        "table_name", "op_name", F.coalesce("events", F.lit(0)).cast("bigint").alias("events")
    )


def replication_lag(changes: DataFrame, now_ms: Column) -> DataFrame:
    return changes.groupBy("table_name").agg((now_ms - F.max("ts_ms")).alias("lag_ms"))


def last_event_age(changes: DataFrame, now_ms: Column) -> DataFrame:
    """Seconds since the newest event, to a tenth; NULL before the first one."""
    return changes.agg(F.round((now_ms - F.max("ts_ms")) / 1000.0, 1).alias("age_s"))


def error_counts(dead: DataFrame) -> DataFrame:
    reason = F.substring("error", 1, REASON_LENGTH).alias("reason")
    return dead.groupBy("table_name", reason).agg(F.count("*").alias("errors"))


def metric_rows(
    rows: DataFrame, metric: str, value: str, at: Column, op: str | None = None
) -> DataFrame:
    """Counts as rows of the metric table."""
    return rows.select(
        F.lit(metric).alias("metric"),
        "table_name",
        (F.col(op) if op else F.lit(None).cast("string")).alias("op"),
        F.col(value).cast("double").alias("value"),
        at.cast("timestamp_ntz").alias("at"),
    )


def durations(metrics: DataFrame) -> DataFrame:
    """Poll and flush times of every batch and the restarts of the stream, from its own metric rows:
    each start has a run of its own."""
    kept = ["metric", "table_name", "op", "value", "batch_id", "at"]
    times = metrics.filter(F.col("metric").isin(POLL_MS, FLUSH_MS)).select(*kept)
    none = F.lit(None).cast("string")
    runs = metrics.filter(F.col("metric") == RUN).agg(
        F.lit(RECONNECTS).alias("metric"), none.alias("table_name"), none.alias("op"),
        (F.count_distinct("op") - 1).cast("double").alias("value"),
        F.max("batch_id").alias("batch_id"), F.max("at").alias("at"),
    )
    return times.unionByName(runs.filter("batch_id is not null"))


def live_rates(metrics: DataFrame, reports: DataFrame) -> DataFrame:
    """Messages of every batch and per second of its trigger: what the stream has counted, over the times in
    the reports of the query. A batch of which there is no report yet has no rate."""
    taken = metrics.filter(F.col("metric") == MESSAGES).groupBy("batch_id").agg(F.sum("value").alias("messages"))
    times = reports.filter(F.col("metric") == BATCH_MS).groupBy("batch_id").agg(F.max_by("value", "at").alias("ms"))
    rate = F.when(F.col("ms") > 0, 1000 * F.col("messages") / F.col("ms"))
    return taken.join(times, "batch_id", "left").select("batch_id", "messages", "ms", rate.alias("per_s"))
