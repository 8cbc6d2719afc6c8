"""Scans S2-S4, sinks K4-K7, the stream T1-T7 and the workflows B1-B2, run end to end."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from changeflow.operators import metrics as M
from changeflow.plans import backfill as B
from changeflow.plans.reconcile import as_changes, reconcile
from changeflow.plans.snapshot import typed_snapshot
from changeflow.queries.changelog import (
    BOTH_SPECS,
    CL,
    FILE_POSITIONS,
    LANDED_BATCHES,
    MAPPED,
    SESSION_EVENTS,
    SPECS,
    changelog,
    files_per_batch,
    landed,
    landing,
    read,
)
from changeflow.queries.decoding import DEAD_SQL, MESSAGES, POS, TYPED, typed_columns
from changeflow.queries.folding import HISTORY_QUERY, LOADED_AT, STATE_SQL, loaded_at, show_history
from changeflow.queries.registry import query
from changeflow.schema import TableSpec
from changeflow.session import scratch_path, settle
from changeflow.sinks.layout import clustered_layout, create_tables, violates_not_null
from changeflow.sinks.store import TableStore
from changeflow.sources import scans as S
from changeflow.streaming import stream as T
from changeflow.streaming.progress import ProgressLog

ORDERS = TableSpec(
    source="orders",
    current="ORDERS",
    columns={
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    pk=("o_orderkey",),
    not_null=("o_orderkey",),
    ts_col="o_orderdate",
)
ORDER_SPECS = {"orders": ORDERS}
ORDERS_SQL = """o_orderkey as O_ORDERKEY, o_custkey as O_CUSTKEY, o_orderstatus as O_ORDERSTATUS,
  o_totalprice as O_TOTALPRICE, o_orderdate as O_ORDERDATE, o_orderpriority as O_ORDERPRIORITY"""
SINCE = "1998-01-01"


@query("s02_snapshot_scan", "select * from orders")
def snapshot_scan(spark, sf_dir):
    """The whole table by key ranges of like depth; together they cover every row once."""
    orders = S.Source(f"{sf_dir}/orders.parquet")
    ranges = B.depth_bounds(S.open_source(spark, orders), "o_orderkey", 4)
    parts = [S.snapshot_scan(spark, orders, "o_orderkey", *r) for r in ranges]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


@query(
    "s03_keyset_page",
    "select * from orders where o_orderkey > 500 order by o_orderkey limit 1000",
)
def keyset_page(spark, sf_dir):
    return S.keyset_page(read(spark, sf_dir, "orders"), "o_orderkey", 500, 1000)


@query("s04_delta_scan", f"select * from orders where o_orderdate >= '{SINCE}'")
def delta_scan(spark, sf_dir):
    return S.delta_scan(read(spark, sf_dir, "orders"), SINCE, "o_orderdate")


def order_store(spark, specs=ORDER_SPECS):
    return TableStore(spark, scratch_path(spark, "orders"), specs)


@query(
    "b01_backfill",
    f"""select {ORDERS_SQL.replace('o_totalprice as', "case when o_orderpriority = '1-URGENT' then 0 else o_totalprice end as")}
        from orders""",
)
def backfill(spark, sf_dir):
    """Eight chunks; a change and a compaction later the run is started again: the change stays."""
    store, sources = order_store(spark), {"orders": S.Source(f"{sf_dir}/orders.parquet")}
    B.backfill(spark, ORDER_SPECS, sources, store, at=loaded_at())
    urgent = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.lit(0.0))
    store.commit("change", 0, {"orders": as_changes(typed_snapshot(urgent, ORDERS))}, at=loaded_at())
    store.compact("orders")
    B.backfill(spark, ORDER_SPECS, sources, store, at=loaded_at())
    return store.current("orders").drop("_LOADED_AT")


def third_power_spec(top: int | None) -> TableSpec:
    """Orders whose keys are third powers. Those of keys beyond 2,097,151 do not fit into a bigint, where SQL ends
    with an error as well: then the column is an exact decimal."""
    fits = top is None or top**3 < 1 << 63
    return ORDERS if fits else replace(ORDERS, columns=ORDERS.columns | {"o_orderkey": "decimal(38,0)"})


@query(
    "b01_skewed_keys",
    f"""select {ORDERS_SQL.replace('o_orderkey as', 'o_orderkey * o_orderkey * o_orderkey as')}, true as even from orders""",
)
def skewed_backfill(spark, sf_dir):
    """Keys that are third powers, most of them in a small part of their range: the largest chunk still
    holds no more than one and a half times the mean."""
    orders = read(spark, sf_dir, "orders")
    spec = third_power_spec(orders.agg(F.max(F.abs("o_orderkey"))).first()[0])
    store, chunks = order_store(spark, {"orders": spec}), 8
    key = F.col("o_orderkey").cast(spec.columns["o_orderkey"])
    rows = B.backfill_table(store, spec, orders.withColumn("o_orderkey", key * key * key), "skewed", chunks, loaded_at())
    folder = f"{store.root}/{ORDERS.current}/base/skewed"
    sizes = spark.read.option("basePath", folder).parquet(f"{folder}/chunk=*").groupBy("chunk").count()
    even = sizes.agg((F.max("count") <= 1.5 * rows / chunks).alias("even"))
    return store.current("orders").drop("_LOADED_AT").join(F.broadcast(even))


# Orders with a second key column, which is NULL for some.
KEYED = TableSpec(
    source="orders",
    current="ORDERS",
    columns=ORDERS.columns,
    pk=("o_orderkey", "o_orderstatus"),
    not_null=("o_orderkey", "o_orderstatus", "o_custkey"),
    ts_col="o_orderdate",
)


def keyless_orders(spark, sf_dir):
    """Orders whose status is not known, as rows with NULL in a key column; others lack the customer."""
    orders = read(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    customer = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    return orders.withColumn("o_orderstatus", status).withColumn("o_custkey", customer)


def reconciled(spark, sf_dir):
    """A target whose prices are all wrong; rows touched since a day come from the source, twice."""
    store, orders = TableStore(spark, scratch_path(spark, "orders"), {"orders": KEYED}), keyless_orders(spark, sf_dir)
    B.backfill(spark, store.specs, {"orders": orders.withColumn("o_totalprice", F.lit(0.0))}, store)
    for run in ("first", "second"):
        reconcile(spark, store.specs, {"orders": orders}, store, SINCE, run=run)
    return store


USABLE = "o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'"


@query(
    "b02_reconcile",
    f"""select {ORDERS_SQL.replace('o_totalprice as', f"case when o_orderdate >= '{SINCE}' then o_totalprice else 0 end as")}
        from orders where {USABLE}""",
)
def reconcile_query(spark, sf_dir):
    """Rows that break the rules of the table are in it neither after the load nor after two merges."""
    return reconciled(spark, sf_dir).current("orders").drop("_LOADED_AT")


@query(
    "b02_rejected_rows",
    f"""select case when o_orderstatus = 'P' then 'key is null' else 'null in O_CUSTKEY' end as error,
          sum(case when o_orderdate >= '{SINCE}' then 3 else 1 end)::bigint as rows
        from orders where not ({USABLE}) group by error""",
)
def rejected_rows(spark, sf_dir):
    """The load and both merges say which rows they could not take."""
    return reconciled(spark, sf_dir).dead().groupBy("error").agg(F.count("*").alias("rows"))


@query("k04_overwrite_load", "select o_orderkey, o_totalprice from orders")
def overwrite_load(spark, sf_dir):
    """A fresh load replaces what an earlier one left."""
    folder = scratch_path(spark, "load")
    B.overwrite_load(read(spark, sf_dir, "lineitem"), folder)
    B.overwrite_load(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), folder)
    return spark.read.parquet(folder)


@query("k05_append_load", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def append_load(spark, sf_dir):
    """Chunks are appended; loading one again changes nothing."""
    folder = scratch_path(spark, "chunks")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    top = rows.agg(F.max("l_orderkey")).first()[0]
    for _ in range(2):
        for i, (low, high) in enumerate(B.chunk_bounds(0, top, 3)):
            B.append_load(rows.filter(S.key_range("l_orderkey", low, high)), folder, i)
    return spark.read.parquet(folder).drop("chunk")


@query(
    "k06_create_tables",
    f"with {CL} select user_id as USER_ID, value as VALUE, seq from cl where value is not null",
)
def create_tables_query(spark, sf_dir):
    """Create the tables twice, load the log into one, keep what satisfies NOT NULL: views have no
    value."""
    spec = TableSpec(
        source="log",
        current=f"LOG_{scratch_path(spark, 'x')[-12:]}",
        columns={"userId": "bigint", "value": "double", "seq": "bigint"},
        pk=("seq",),
        not_null=("seq", "value"),
    )
    folder = scratch_path(spark, "tables")
    create_tables(spark, {"log": spec}, folder)
    names = create_tables(spark, {"log": spec}, folder)
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("USER_ID"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("VALUE"),
        F.col("event_id").alias("SEQ"),
        loaded_at().alias("_LOADED_AT"),
    )
    bad = violates_not_null(events, [spec.targets[c] for c in spec.not_null])
    events.join(bad.select("SEQ"), "SEQ", "left_anti").select(*events.columns).write.insertInto(names[0])
    return spark.table(names[0]).select("USER_ID", "VALUE", F.col("SEQ").alias("seq"))


@query("k07_clustered_layout", "select l_returnflag, l_orderkey, l_linenumber from lineitem")
def clustered(spark, sf_dir):
    """Three values of the key hold all rows: the ranges still split them."""
    path = scratch_path(spark, "clustered")
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    clustered_layout(rows, ["l_returnflag"], 8).write.parquet(path)
    return spark.read.parquet(path)


# Streams

_RUNS: dict[tuple, TableStore] = {}


def new_store(spark, specs=SPECS):
    return TableStore(spark, scratch_path(spark, "store"), specs)


def streamed(spark, sf_dir):
    """One run over the landed log in four batches; shared by the queries that look at it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        store = new_store(spark)
        T.drain(
            spark,
            landing(spark, sf_dir),
            store,
            scratch_path(spark, "checkpoint"),
            max_files=files_per_batch(spark, sf_dir),
            at=loaded_at(),
        )
        _RUNS[key] = store
    return _RUNS[key]


@query("t01_start_cdc", STATE_SQL)
def start_cdc(spark, sf_dir):
    """The state the stream leaves is the state of the whole log."""
    return streamed(spark, sf_dir).current("events").select(*typed_columns())


SEGMENTS = f"""{POS}, {MESSAGES}, span as (select min(event_id * 20 + k) as low, max(event_id * 20 + k) as high from msgs),
  files as (select low, high,
    (high - low + {LANDED_BATCHES * FILE_POSITIONS}) // {LANDED_BATCHES * FILE_POSITIONS} as per_batch from span),
  step as (select low, ((high - low) // ({LANDED_BATCHES} * per_batch) + 1) * per_batch as size from files)"""


@query(
    "t02_batch_bounds",
    f"""with {SEGMENTS}, {MAPPED}
        select ((seq * 20 + 10 - low) // size)::bigint as batch_id,
          case op when 'c' then 'insert' when 'u' then 'update' else 'delete' end as op, count(*)::double as value
        from mapped, step group by all""",
)
def batch_bounds(spark, sf_dir):
    """A quarter of the landed files per batch: the counts of every batch."""
    counts = streamed(spark, sf_dir).metrics().filter(F.col("metric") == M.PROCESSED)
    return counts.select("batch_id", "op", "value")


@query(
    "t02_byte_bounds",
    f"""with {SEGMENTS}, {MAPPED}
        select ((seq * 20 + 10 - low) // (size // (select per_batch from files)))::bigint as batch_id, count(*)::double as value
        from mapped, step group by all""",
)
def byte_bounds(spark, sf_dir):
    """Every file is larger than the bound, so each is a batch of its own: the counts of every batch."""
    store = new_store(spark)
    T.drain(spark, landing(spark, sf_dir), store, scratch_path(spark, "checkpoint"), max_bytes=1, at=loaded_at())
    counts = store.metrics().filter(F.col("metric") == M.PROCESSED)
    return counts.groupBy("batch_id").agg(F.sum("value").alias("value"))


@query(
    "a07_live_rates",
    f"""with {SEGMENTS} select ((event_id * 20 + k - low) // size)::bigint as batch_id, count(*)::double as rows,
          true as timed, 0 as restarts from msgs, step group by all""",
)
def live_rates(spark, sf_dir):
    """The messages of each batch of a run, per second of what the listener was told of its time."""
    log, store = ProgressLog(), new_store(spark)
    spark.streams.addListener(log)
    try:
        files = files_per_batch(spark, sf_dir)
        reports = T.drain(spark, landing(spark, sf_dir), store, scratch_path(spark, "checkpoint"), max_files=files, at=loaded_at())
    finally:
        spark.streams.removeListener(log)
    for report in reports:  # the last ones may still have been on their way
        log.add(report)
    rates = M.live_rates(store.metrics(), log.rows(spark))
    timed = F.abs(F.col("per_s") * F.col("ms") / 1000 - F.col("messages")) < 0.01
    return rates.select("batch_id", F.col("messages").alias("rows"), timed.alias("timed"), F.lit(log.restarts).alias("restarts"))


NEWEST = "(select max(ts_ms) from mapped)"


@query(
    "a13_stream_metrics",
    f"""with {CL}, {DEAD_SQL}, mapped as (
          select cl.* from cl left join dead on dead.seq = cl.seq * 20 + 10 where cl.table_name like 'events_%' and dead.seq is null)
        select '{M.ERRORS}' as metric, case when table_name is not null then 'events' end as table_name,
          left(error, 32) as op, count(*)::double as value from dead group by all
        union all select '{M.LAG_MS}', 'events', null, epoch_ms(timestamp '{LOADED_AT}') - {NEWEST}
        union all select '{M.RECONNECTS}', null, null, 0
        union all select '{M.ERRORS}', null, 'none', {LANDED_BATCHES}""",
)
def stream_metrics(spark, sf_dir):
    """Errors, lag and zeros of a batch of the damaged log as the stream wrote them; and the number of
    batches of the sound log that say they had no error."""
    store = new_store(spark)
    T.process_batch(store, landed(spark, sf_dir, damaged=True), "writer", 0, at=loaded_at())
    kept = F.col("metric").isin(M.ERRORS, M.LAG_MS, M.RECONNECTS)
    rows = store.metrics().filter(kept).select("metric", "table_name", "op", "value")
    sound = streamed(spark, sf_dir).metrics().filter((F.col("metric") == M.ERRORS) & (F.col("value") == 0))
    none = F.lit(None).cast("string")
    zeros = sound.agg(F.lit(M.ERRORS).alias("metric"), none.alias("table_name"), F.lit("none").alias("op"), F.count("*").cast("double").alias("value"))
    return rows.unionByName(zeros)


@query(
    "p09_first_keys",
    f"""with {SEGMENTS}, {MAPPED}
        select ((seq * 20 + 10 - low) // size)::bigint as batch_id, user_id as USER_ID, seq
        from mapped, step where op <> 'd' qualify row_number() over (partition by batch_id order by seq) <= {T.SAMPLED}""",
)
def first_keys(spark, sf_dir):
    """The first keys of every batch, as the stream has recorded them."""
    keys = streamed(spark, sf_dir).metrics().filter(F.col("metric") == M.FIRST_KEYS)
    seq = ((F.col("value") - 10) / 20).cast("bigint")
    return keys.select("batch_id", F.col("op").cast("bigint").alias("USER_ID"), seq.alias("seq"))


@query("t05_two_sessions", HISTORY_QUERY)
def two_sessions(spark, sf_dir):
    """Two sessions at a time, their messages in turn, over batches that end within both: every event still
    has the transaction and the relation of its own session."""
    span, raw = SESSION_EVENTS * 20, landed(spark, sf_dir)
    pair, side = F.expr("session_id div 2"), F.col("session_id") % 2
    place = pair * 2 * span + (F.col("seq") - F.col("session_id") * span) * 2 + side
    raw = settle(raw.withColumn("seq", place))
    low, high = raw.agg(F.min("seq"), F.max("seq")).first()
    store, step = new_store(spark), (high - low) // 4 + 1
    for batch in range(4):
        inside = F.col("seq").between(low + batch * step, low + (batch + 1) * step - 1)
        T.process_batch(store, raw.filter(inside), "writer", batch, at=loaded_at())
    return show_history(store.history("events"))


@query(
    "t03_per_table_fanout",
    f"""with {CL}, named as (select * replace (case when table_name = 'audit_log' then table_name else 'events' end as table_name) from cl),
          latest as (select * from named qualify row_number() over (partition by table_name, user_id order by seq desc) = 1)
        select table_name, {TYPED} from latest where op <> 'd'""",
)
def per_table_fanout(spark, sf_dir):
    """Two tables out of one batch."""
    store = new_store(spark, BOTH_SPECS)
    T.drain(spark, landing(spark, sf_dir), store, scratch_path(spark, "checkpoint"), at=loaded_at())
    states = [
        store.current(t).select(F.lit(t).alias("table_name"), *typed_columns()) for t in BOTH_SPECS
    ]
    return states[0].unionByName(states[1])


@query("t04_replay_safe", HISTORY_QUERY)
def replay_safe(spark, sf_dir):
    """Every batch is handed in twice under its number: history is not doubled."""
    store, raw = new_store(spark), landed(spark, sf_dir)
    for _ in range(2):
        T.process_batch(store, raw, "writer", 0, at=loaded_at())
    return show_history(store.history("events"))


@query("t05_stateful_context", HISTORY_QUERY)
def stateful_context(spark, sf_dir):
    """Transactions and sessions run across batches: every history row still has its own."""
    return show_history(streamed(spark, sf_dir).history("events"))


@query("t06_drain", STATE_SQL)
def drain(spark, sf_dir):
    """A second drain of the same folder finds nothing new; then the table is compacted."""
    store, checkpoint = new_store(spark), scratch_path(spark, "checkpoint")
    half = files_per_batch(spark, sf_dir, 2)
    for _ in range(2):
        T.drain(spark, landing(spark, sf_dir), store, checkpoint, max_files=half, at=loaded_at())
    store.compact("events")
    return store.current("events").select(*typed_columns())


@query("t07_resume_position", HISTORY_QUERY)
def resume_position(spark, sf_dir):
    """A stream takes what has landed of the first sessions and is lost with its checkpoint; a new one
    sees all files and goes on behind the position: every event is there once."""
    store, raw = new_store(spark), landed(spark, sf_dir)
    half = raw.agg(F.expr("(min(session_id) + max(session_id)) div 2")).first()[0]
    T.process_batch(store, raw.filter(F.col("session_id") <= half), "lost", 0, at=loaded_at())
    T.drain(spark, landing(spark, sf_dir), store, scratch_path(spark, "checkpoint"), at=loaded_at())
    return show_history(store.history("events"))


@query(
    "t07_late_messages",
    f"""with {POS}, {MESSAGES} select session_id, event_id * 20 + k as seq, msg_type, 'landed late' as error
        from msgs where msg_type = 'C' and event_id * 20 + k < (select max(event_id * 20 + k) from msgs where msg_type <> 'C')""",
)
def late_messages(spark, sf_dir):
    """The ends of transactions land after all else: what lies behind the position is reported."""
    store, raw = new_store(spark), landed(spark, sf_dir)
    ends = F.substring("data", 1, 1) == F.lit(b"C")
    T.process_batch(store, raw.filter(~ends), "writer", 0, at=loaded_at())
    T.process_batch(store, raw.filter(ends), "writer", 1, at=loaded_at())
    return store.dead().select("session_id", "seq", "msg_type", "error")


@query(
    "a16_durations",
    f"""with {SEGMENTS}, b as (select distinct ((event_id * 20 + k - low) // size)::bigint as batch_id from msgs, step)
        select metric, batch_id, true as counted from b, (select unnest(['{M.POLL_MS}', '{M.FLUSH_MS}']) as metric)
        union all select '{M.RECONNECTS}', max(batch_id), true from b""",
)
def durations(spark, sf_dir):
    """Times of every batch and the restarts of the run, as the stream wrote them: none is negative."""
    rows = M.durations(streamed(spark, sf_dir).metrics())
    return rows.select("metric", "batch_id", (F.col("value") >= 0).alias("counted"))


@query("t04_drop_relanded", f"with {CL} select session_id, seq, table_name from cl")
def drop_relanded(spark, sf_dir):
    """Every event lands twice; the stream lets one pass."""
    path = scratch_path(spark, "relanded")
    log = changelog(spark, sf_dir).select(
        "session_id", "seq", "table_name", F.timestamp_millis("ts_ms").alias("landed_at")
    )
    log.write.parquet(path)
    log.write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    messages = spark.readStream.schema(schema).parquet(path)
    out, checkpoint = scratch_path(spark, "once"), scratch_path(spark, "checkpoint")
    query_ = (
        T.drop_relanded(messages, "landed_at", "1 day")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.schema(schema).parquet(out).drop("landed_at")
