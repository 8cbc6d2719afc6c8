"""Aggregates A1-A16, counts S5-S7, J3, drift and reports B3-B5."""

from pyspark.sql import functions as F

from changeflow.operators import changes as C
from changeflow.operators import checks as K
from changeflow.operators import metrics as M

from changeflow.plans.sync import staleness_report, sync_check
from changeflow.queries.changelog import CL, MAPPED, TX_EVENTS, changelog, read
from changeflow.queries.decoding import DEAD_SQL, decoded
from changeflow.queries.folding import history, mapped
from changeflow.queries.registry import query
from changeflow.session import scratch_path
from changeflow.sources.scans import select_tables

NOW = "2024-01-31 00:01:30"
OP_NAME_SQL = "case op when 'c' then 'insert' when 'u' then 'update' else 'delete' end"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def now_ms():
    return F.unix_millis(F.lit(NOW).cast("timestamp"))


NOW_MS = f"epoch_us(timestamp '{NOW}') // 1000"


@query("s05_table_count", "select count(*) as row_count from lineitem")
def table_count(spark, sf_dir):
    return K.footer_count(spark, f"{sf_dir}/lineitem.parquet")


COUNTS_SQL = """c as (select n_name as table_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1),
  s as (select n_name as table_name, count(*) as n from supplier join nation on s_nationkey = n_nationkey group by 1)"""


def per_nation(spark, sf_dir, table, key):
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("table_name"))
    counts = read(spark, sf_dir, table).groupBy(F.col(key).alias("n_nationkey"))
    counts = counts.agg(F.count("*").alias("row_count"))
    return counts.join(nation, "n_nationkey").select("table_name", "row_count")


def nation_counts(spark, sf_dir):
    customers = per_nation(spark, sf_dir, "customer", "c_nationkey")
    suppliers = per_nation(spark, sf_dir, "supplier", "s_nationkey")
    return customers, suppliers


@query(
    "s06_estimate_count",
    """select 'customer' as table_name, count(*) as row_count from customer
       union all select 'supplier', count(*) from supplier""",
)
def estimate_count(spark, sf_dir):
    """The customers are counted from the statistics of their table; the suppliers' table has none."""
    names = {t: f"{t}_{scratch_path(spark, 'x')[-12:]}" for t in ("customer", "supplier")}
    for source, name in names.items():
        read(spark, sf_dir, source).write.option("path", scratch_path(spark, source)).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {names['customer']} COMPUTE STATISTICS")
    stats = K.table_statistics(spark, names)
    # A count that has to be made is made of the table without an estimate alone.
    known = {r["table_name"] for r in stats.filter("estimate > 0").collect()}
    exact = C.union_rows([
        K.table_count(spark.table(n) if t not in known else spark.table(n).limit(0)).withColumn("table_name", F.lit(t))
        for t, n in names.items()
    ])
    return K.estimate_count(stats, exact)


@query(
    "s07_select_tables",
    f"with {CL} select seq, table_name from cl where table_name in ('events_p0', 'audit_log')",
)
def tables_selected(spark, sf_dir):
    rows = changelog(spark, sf_dir).select("seq", "table_name")
    return select_tables(rows, " events_p0, ,audit_log,")


@query(
    "j03_compare_counts",
    f"""with {COUNTS_SQL} select coalesce(c.table_name, s.table_name) as table_name,
          c.n as source_rows, s.n as target_rows from c full join s on c.table_name = s.table_name""",
)
def compare_counts(spark, sf_dir):
    return K.compare_counts(*nation_counts(spark, sf_dir))


DRIFT_SQL = f"""{COUNTS_SQL}, d as (
  select coalesce(c.table_name, s.table_name) as table_name, c.n as a, s.n as b
  from c full join s on c.table_name = s.table_name),
  results as (select table_name, coalesce(a, 0) as source_rows, coalesce(b, 0) as target_rows,
    coalesce(abs(a - b), 0) as diff, coalesce(abs(a - b) <= 55, false) as in_sync,
    a is null or b is null as failed from d)"""


@query("a14_drift", f"with {DRIFT_SQL} select * from results")
def drift(spark, sf_dir):
    return K.drift(compare_counts(spark, sf_dir), 55)


@query("a15_all_in_sync", f"with {DRIFT_SQL} select bool_and(in_sync) as all_in_sync from results")
def all_in_sync(spark, sf_dir):
    return K.all_in_sync(drift(spark, sf_dir))


@query(
    "a01_count_events",
    f"""with {MAPPED} select table_name, {OP_NAME_SQL} as op_name, count(*) as events
        from mapped group by all""",
)
def count_events(spark, sf_dir):
    return M.count_events(mapped(spark, sf_dir))


def batches(spark, sf_dir):
    """The change log with a batch number: one batch per transaction."""
    tx = F.call_function("div", F.col("seq"), F.lit(TX_EVENTS))
    return mapped(spark, sf_dir).withColumn("batch_id", tx)


@query(
    "a02_flush_counts",
    f"with {MAPPED} select tx as batch_id, table_name, count(*) as events from mapped group by all",
)
def flush_counts(spark, sf_dir):
    return M.flush_counts(batches(spark, sf_dir))


@query(
    "a03_published_flushes",
    f"""with {MAPPED} select table_name, count(distinct tx) as flushes, 'flushed' as op_name
        from mapped group by all""",
)
def published_flushes(spark, sf_dir):
    return M.published_flushes(batches(spark, sf_dir))


@query(
    "a04_confirmed_lsn",
    f"""with {MAPPED} select event_type, max(case when op = 'c' then lsn else commit_lsn end) as confirmed_lsn
        from mapped group by event_type""",
)
def confirmed_lsn(spark, sf_dir):
    """Of each kind of event; inserts have no commit position and count by their own."""
    rows = mapped(spark, sf_dir)
    kind = F.coalesce(F.filter("after", lambda v: v["name"] == "eventType")[0]["text"], F.lit("error"))
    lost = F.when(F.col("op") == "c", F.lit(0).cast("decimal(20,0)")).otherwise(F.col("commit_lsn"))
    parts = [
        M.confirmed_lsn(rows.withColumn("commit_lsn", lost).filter(kind == k)).withColumn("event_type", F.lit(k))
        for k in ("signup", "error", "click", "purchase", "view")
    ]
    return C.union_rows(parts).select(
        "event_type",
        F.col("confirmed_lsn").cast("bigint").alias("confirmed_lsn")
    )


@query(
    "a05_lsn_range",
    f"with {MAPPED} select arg_min(lsn, seq) as first_lsn, arg_max(lsn, seq) as last_lsn from mapped",
)
def lsn_range(spark, sf_dir):
    rows = M.lsn_range(mapped(spark, sf_dir))
    return rows.select(*[F.col(c).cast("bigint").alias(c) for c in rows.columns])


STALENESS_SQL = f"""make_timestamp(max(ts_ms) * 1000) as latest_pg_change,
  date_diff('minute', make_timestamp(max(ts_ms) * 1000), timestamp '{NOW}') as lag_minutes,
  count(*) as total_history_rows"""


@query("a06_staleness", f"with {MAPPED} select {STALENESS_SQL} from mapped")
def staleness(spark, sf_dir):
    return M.staleness(history(spark, sf_dir), now())


@query(
    "a07_throughput",
    f"""with {CL} select count(*) as total_events, (max(ts_ms) - min(ts_ms)) / 1000::double as elapsed_s,
          count(*) / ((max(ts_ms) - min(ts_ms)) / 1000::double) as events_per_s from cl""",
)
def throughput(spark, sf_dir):
    return M.throughput(changelog(spark, sf_dir))


TAGS_SQL = "list_sort(['table:' || (user_id % 3), 'type:' || event_type])"


def metric_log(spark, sf_dir):
    """Every event as a metric; the order of its tags depends on the event."""
    table = F.concat(F.lit("table:"), (F.col("user_id") % 3).cast("string"))
    kind = F.concat(F.lit("type:"), "event_type")
    return read(spark, sf_dir, "events").select(
        F.lit("cdc.value").alias("metric"),
        F.when(F.col("value") > 30, F.array(table, kind)).otherwise(F.array(kind, table)).alias("tags"),
        "value",
        F.col("ts").alias("at"),
    )


def _flat(rows):
    return rows.select("metric", F.array_join("tags", ",").alias("tags"), F.round("value", 2).alias("value"))


@query(
    "a08_latest_gauge",
    f"""select 'cdc.value' as metric, array_to_string({TAGS_SQL}, ',') as tags,
          round(arg_max(value, ts), 2) as value from events group by 2""",
)
def latest_gauge(spark, sf_dir):
    return _flat(M.latest_gauge(metric_log(spark, sf_dir)))


@query(
    "a09_sum_counter",
    f"""select 'cdc.value' as metric, array_to_string({TAGS_SQL}, ',') as tags,
          round(sum(value), 2) as value from events group by 2""",
)
def sum_counter(spark, sf_dir):
    return _flat(M.sum_counter(metric_log(spark, sf_dir)))


@query(
    "a10_zero_fill",
    f"""with {CL}, n as (select table_name, {OP_NAME_SQL} as op_name, count(*) as events from cl group by all),
          o as (select unnest(['insert', 'update', 'delete', 'truncate']) as op_name)
        select t.table_name, o.op_name, coalesce(n.events, 0) as events
        from (select distinct table_name from cl) t cross join o left join n using (table_name, op_name)""",
)
def zero_fill(spark, sf_dir):
    changes = changelog(spark, sf_dir)
    ops = ["insert", "update", "delete", "truncate"]
    return M.zero_fill(M.count_events(changes), changes, ops)


@query(
    "a11_replication_lag",
    f"with {CL} select table_name, {NOW_MS} - max(ts_ms) as lag_ms from cl group by table_name",
)
def replication_lag(spark, sf_dir):
    return M.replication_lag(changelog(spark, sf_dir), now_ms())


@query(
    "a12_last_event_age",
    f"with {CL} select round(({NOW_MS} - max(ts_ms)) / 1000::double, 1) as age_s from cl",
)
def last_event_age(spark, sf_dir):
    return M.last_event_age(changelog(spark, sf_dir), now_ms())


@query(
    "a13_error_counts",
    f"""with {DEAD_SQL} select table_name, left(error, 32) as reason, count(*) as errors
        from dead group by all""",
)
def error_counts(spark, sf_dir):
    return M.error_counts(decoded(spark, sf_dir, damaged=True).dead)


def sync_results(spark, sf_dir):
    t = lambda name: read(spark, sf_dir, name)
    pairs = {
        "CUSTOMER": (lambda: t("customer"), lambda: t("orders").select("o_custkey").distinct()),
        "ORDERS": (lambda: t("orders"), lambda: t("lineitem").select("l_orderkey").distinct()),
        "PART": (lambda: t("part"), lambda: t("lineitem").select("l_partkey").distinct()),
        "MISSING": (lambda: t("events"), lambda: t("no_such_table")),
    }
    return sync_check(spark, pairs)


SYNC_SQL = """counts as (
  select 'CUSTOMER' as table_name, (select count(*) from customer) as a, (select count(distinct o_custkey) from orders) as b
  union all select 'ORDERS', (select count(*) from orders), (select count(distinct l_orderkey) from lineitem)
  union all select 'PART', (select count(*) from part), (select count(distinct l_partkey) from lineitem)
  union all select 'MISSING', (select count(*) from events), null),
  results as (select table_name, a as source_rows, coalesce(b, 0) as target_rows,
    coalesce(abs(a - b), 0) as diff, coalesce(abs(a - b) <= 100, false) as in_sync, b is null as failed
    from counts)"""


@query("b03_sync_check", f"with {SYNC_SQL} select * from results")
def sync_check_query(spark, sf_dir):
    return sync_results(spark, sf_dir)


@query(
    "b04_drift_report",
    f"""with {SYNC_SQL} select table_name,
          format('[{{}}] {{}}: PG={{:,}}  SF={{:,}}  diff={{:,}}', case when in_sync then 'OK' else 'DRIFT' end,
            table_name, source_rows, target_rows, diff) as line,
          case when not in_sync and not failed then
            format('PostgreSQL has **{{:,}}** rows, Snowflake has **{{:,}}** rows — drift of **{{:,}}** rows (threshold 100).',
              source_rows, target_rows, diff) end as drift_text
        from results""",
)
def drift_report(spark, sf_dir):
    return K.drift_report(sync_results(spark, sf_dir))


@query(
    "b04_sync_metrics",
    f"""with {SYNC_SQL}, ok as (select 'table:' || lower(table_name) as tag, * from results where not failed)
        select tag, 'cdc.sync.pg_row_count' as metric, source_rows::double as value from ok
        union all select tag, 'cdc.sync.sf_row_count', target_rows::double from ok
        union all select tag, 'cdc.sync.row_diff', diff::double from ok
        union all select tag, 'cdc.sync.in_sync', case when in_sync then 1.0 else 0.0 end::double from ok""",
)
def sync_metrics(spark, sf_dir):
    return K.sync_metrics(sync_results(spark, sf_dir))


@query(
    "b05_staleness_report",
    f"with {CL} select table_name, {STALENESS_SQL} from cl group by table_name",
)
def staleness_report_query(spark, sf_dir):
    """One history per table name of the log, the partitions and the audit table."""
    rows = changelog(spark, sf_dir).withColumn("_CDC_TS", F.timestamp_add(
        "MILLISECOND", F.col("ts_ms"), F.lit("1970-01-01").cast("timestamp_ntz")))
    names = ["audit_log", "events_p0", "events_p1", "events_p2", "events_p3"]
    return staleness_report({n: rows.filter(F.col("table_name") == n) for n in names}, now())


