import pathlib

import pytest
from pyspark.sql import functions as F

import messages as m
from changeflow.operators import checks as K
from changeflow.operators import metrics as M
from changeflow.plans import backfill as B
from changeflow.plans.reconcile import reconcile
from changeflow.plans.sync import sync_check
from changeflow.schema import CUSTOMER_DEVICES, CUSTOMERS, RAW_WAL, REGISTRY, TableSpec
from changeflow.session import scratch_path
from changeflow.sinks import files
from changeflow.sinks.store import TableStore
from changeflow.sources import scans as S
from changeflow.streaming import stream as T
from changeflow.streaming.progress import ProgressLog

SPEC = TableSpec(
    source="t",
    current="T",
    columns={"id": "bigint", "tenantId": "string", "doc": "variant", "updated_at": "timestamp_ntz"},
    pk=("id", "tenantId"),
    json=("doc",),
    ts_col="updated_at",
)
SPECS = {"t": SPEC}


def source(spark, rows):
    schema = "id long, tenantId string, doc struct<k:int>, updated_at timestamp_ntz, surplus int"
    return spark.createDataFrame(rows, schema.replace("timestamp_ntz", "string")).withColumn(
        "updated_at", F.col("updated_at").cast("timestamp_ntz")
    )


def rows_of(ids, day="2024-01-01", k=1):
    return [(i, "x", (k,), day, 0) for i in ids]


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "store"), SPECS)


def state(store):
    rows = store.current("t").select("ID", "TENANT_ID", F.to_json("DOC").alias("DOC")).collect()
    return {(r["ID"], r["TENANT_ID"]): r["DOC"] for r in rows}


@pytest.mark.parametrize("low,high,chunks", [(1, 10, 3), (0, 0, 8), (-5, 5, 1), (7, 9, 8)])
def test_chunks_cover_every_key_once(low, high, chunks):
    bounds = B.chunk_bounds(low, high, chunks)
    for key in range(low - 3, high + 4):
        hits = [b for b in bounds if (b[0] is None or key >= b[0]) and (b[1] is None or key < b[1])]
        assert len(hits) == 1


def test_backfill_resumes_after_a_failure(spark, store, monkeypatch):
    src = source(spark, [*rows_of(range(-3, 50)), (1, "y", (2,), "2024-01-01", 0)])
    written, real = [], B.append_load

    def failing(df, folder, chunk):
        if len(written) == 3:
            raise RuntimeError("lost")
        written.append(chunk)
        return real(df, folder, chunk)

    monkeypatch.setattr(B, "append_load", failing)
    with pytest.raises(RuntimeError):
        B.backfill(spark, SPECS, {"t": src}, store, chunks=5)
    assert state(store) == {}
    again = []
    monkeypatch.setattr(B, "append_load", lambda *a: again.append(real(*a)))
    assert B.backfill(spark, SPECS, {"t": src}, store, chunks=5) == {"t": 54}
    assert again == [False, False, False, True, True]
    assert len(state(store)) == 54 and state(store)[(1, "y")] == '{"k":2}'


def test_a_finished_backfill_is_skipped(spark, store):
    B.backfill(spark, SPECS, {"t": source(spark, rows_of(range(5)))}, store)
    B.backfill(spark, SPECS, {"t": source(spark, rows_of(range(9)))}, store)
    assert len(state(store)) == 5
    B.backfill(spark, SPECS, {"t": source(spark, rows_of(range(9)))}, store, run="second")
    assert len(state(store)) == 9


def test_backfill_of_an_empty_source(spark, store):
    assert B.backfill(spark, SPECS, {"t": source(spark, [])}, store) == {"t": 0}


def test_rows_without_key_become_dead_letters(spark, store):
    src = source(spark, [*rows_of(range(4)), (None, "x", (1,), "2024-01-01", 0)])
    B.backfill(spark, SPECS, {"t": src}, store)
    assert len(state(store)) == 4
    assert [r["error"] for r in store.dead().collect()] == ["key is null"]


def change(spark, store, batch, i, k):
    from changeflow.plans.reconcile import as_changes
    from changeflow.plans.snapshot import typed_snapshot

    store.commit("w", batch, {"t": as_changes(typed_snapshot(source(spark, rows_of([i], k=k)), SPEC))})


def test_a_finished_backfill_is_skipped_after_compaction(spark, store):
    src = {"t": source(spark, rows_of(range(5)))}
    B.backfill(spark, SPECS, src, store)
    change(spark, store, 0, 1, 9)
    store.compact("t")
    assert B.backfill(spark, SPECS, src, store) == {"t": 5}
    assert state(store)[(1, "x")] == '{"k":9}'


def test_changes_during_a_backfill_outlive_compaction(spark, store, monkeypatch):
    src, real = {"t": source(spark, rows_of(range(8)))}, B.append_load
    monkeypatch.setattr(B, "append_load", lambda df, folder, chunk: 1 / 0 if chunk else real(df, folder, chunk))
    with pytest.raises(ZeroDivisionError):
        B.backfill(spark, SPECS, src, store, chunks=4)
    change(spark, store, 0, 1, 9)
    store.compact("t")
    monkeypatch.setattr(B, "append_load", real)
    B.backfill(spark, SPECS, src, store, chunks=4)
    assert len(state(store)) == 8 and state(store)[(1, "x")] == '{"k":9}'
    store.compact("t")
    assert len(state(store)) == 8 and state(store)[(1, "x")] == '{"k":9}'


STRICT = TableSpec(
    source="t",
    current="T",
    columns={"id": "bigint", "tenantId": "string", "doc": "variant", "updated_at": "timestamp_ntz", "surplus": "int"},
    pk=("id", "tenantId"),
    not_null=("id", "tenantId", "surplus"),
    ts_col="updated_at",
)


def test_one_rule_for_rows_on_every_path(spark):
    specs = {"t": STRICT}
    store = TableStore(spark, scratch_path(spark, "store"), specs)
    rows = [*rows_of([1, 2]), (3, None, (1,), "2024-01-01", 0), (4, "x", (1,), "2024-01-01", None), (None, "x", (1,), "2024-01-01", 0)]
    wanted = ["key is null", "key is null", "null in SURPLUS"]
    B.backfill(spark, specs, {"t": source(spark, rows)}, store)
    assert store.current("t").count() == 2
    assert sorted(r["error"] for r in store.dead().collect()) == wanted
    for run in "abc":
        reconcile(spark, specs, {"t": source(spark, rows)}, store, "2023-01-01", run)
    assert store.current("t").count() == 2
    assert sorted(r["error"] for r in store.dead().collect()) == sorted(wanted * 4)


def test_text_keys_are_refused(spark, store):
    spec = TableSpec(source="t", current="T", columns={"name": "string"}, pk=("name",))
    store.specs = {"t": spec}
    with pytest.raises(ValueError, match="first key column"):
        B.backfill(spark, store.specs, {"t": spark.createDataFrame([("a",)], "name string")}, store)


def test_changes_before_the_backfill_are_replaced(spark, store):
    from changeflow.plans.reconcile import as_changes
    from changeflow.plans.snapshot import typed_snapshot

    old = as_changes(typed_snapshot(source(spark, rows_of([99])), SPEC))
    store.commit("w", 0, {"t": old})
    B.backfill(spark, SPECS, {"t": source(spark, rows_of(range(3)))}, store)
    assert sorted(k[0] for k in state(store)) == [0, 1, 2]


def test_reconcile_keeps_newer_rows(spark, store):
    have = [*rows_of([1], "2024-01-01"), *rows_of([2], "2024-03-01"), *rows_of([3], "2024-01-01")]
    B.backfill(spark, SPECS, {"t": source(spark, have)}, store)
    new = [*rows_of([1], "2024-02-01", 7), *rows_of([2], "2024-02-01", 7), *rows_of([3], "2023-01-01", 7), *rows_of([4], "2024-02-01", 7)]
    reconcile(spark, SPECS, {"t": source(spark, new)}, store, "2024-01-15", "r1")
    assert state(store) == {(1, "x"): '{"k":7}', (2, "x"): '{"k":1}', (3, "x"): '{"k":1}', (4, "x"): '{"k":7}'}
    assert store.history("t").count() == 0


def test_reconcile_needs_a_change_time(spark, store):
    store.specs = {"customer_devices": CUSTOMER_DEVICES}
    src = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="no change time"):
        reconcile(spark, store.specs, {"customer_devices": src}, store, "2024-01-01", "r")


def test_delta_scan_names_a_missing_column(spark):
    with pytest.raises(ValueError, match="updated_at"):
        S.delta_scan(spark.range(1), "2024-01-01")


def test_filters_reach_the_files(spark):
    path = scratch_path(spark, "src")
    source(spark, rows_of(range(10))).write.parquet(path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    scan = plan(S.snapshot_scan(spark, S.Source(path), "id", 2, 5))
    assert "GreaterThanOrEqual(id,2)" in scan and "LessThan(id,5)" in scan
    assert "GreaterThanOrEqual(updated_at" in plan(S.delta_scan(spark.read.parquet(path), "2024-01-01"))


def test_pages(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert [r["k"] for r in S.keyset_page(df, "k", 3, 4).collect()] == [4, 5, 6, 7]


def test_table_list():
    assert S.table_list(" a, b,,c ,") == ["a", "b", "c"]


def test_sync_check_goes_on_after_a_failure(spark):
    pairs = {
        "A": (lambda: spark.range(10), lambda: spark.range(110)),
        "B": (lambda: spark.range(10), lambda: spark.range(111)),
        "C": (lambda: spark.read.parquet("/nowhere"), lambda: spark.range(1)),
    }
    rows = {r["table_name"]: r for r in sync_check(spark, pairs).collect()}
    assert (rows["A"]["diff"], rows["A"]["in_sync"]) == (100, True)
    assert (rows["B"]["diff"], rows["B"]["in_sync"]) == (101, False)
    assert (rows["C"]["in_sync"], rows["C"]["failed"]) == (False, True)
    estimate = sync_check(spark, {"A": pairs["A"]}, estimates={"A": 7}).first()
    assert estimate["source_rows"] == 7


def test_report_texts(spark):
    results = sync_check(spark, {"T": (lambda: spark.range(1500), lambda: spark.range(1234))})
    row = K.drift_report(results).first()
    assert row["line"] == "[DRIFT] T: PG=1,500  SF=1,234  diff=266"
    assert "drift of **266** rows (threshold 100)" in row["drift_text"]
    assert K.all_in_sync(results).first()[0] is False


def test_staleness_counts_minute_boundaries(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:59",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("_CDC_TS")
    )
    now = F.lit("2024-01-01 00:01:01").cast("timestamp_ntz")
    assert M.staleness(rows, now).first()["lag_minutes"] == 1


def test_staleness_has_no_session_zone(spark):
    """Four hours over the change to summer time are 240 minutes in any zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = spark.createDataFrame([("2024-03-31 00:30:00",)], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("_CDC_TS")
        )
        now = F.lit("2024-03-31 04:30:00").cast("timestamp_ntz")
        assert M.staleness(rows, now).first()["lag_minutes"] == 240
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_ties_are_broken_by_what_rows_hold(spark):
    from changeflow.operators.changes import latest_per_key

    rows = [(1, "2024-01-01", v) for v in "abcdefgh"]
    df = spark.createDataFrame(rows, "id long, t string, v string")
    kept = {latest_per_key(df.orderBy(F.rand(i)).repartition(4), ["id"], [F.desc("t")]).first()["v"] for i in range(4)}
    assert len(kept) == 1


def test_rates_and_ages_without_events(spark):
    empty = spark.createDataFrame([], "ts_ms long")
    assert M.throughput(empty).first()["events_per_s"] == 0.0
    assert M.last_event_age(empty, F.lit(1000)).first()["age_s"] is None
    one = spark.createDataFrame([(5,)], "ts_ms long")
    assert M.throughput(one).first()["events_per_s"] == 0.0


def test_example_schema():
    assert CUSTOMERS.pk_targets == ["ID", "TENANT_ID"]
    assert list(CUSTOMERS.target_types)[5:7] == ["METADATA", "TAGS"]
    assert list(REGISTRY) == ["customers", "customer_devices"]
    assert CUSTOMERS.history == "CUSTOMERS_HISTORY"


# The stream over the example schema

CUSTOMER_COLUMNS = [(c, 25, c in ("id", "tenant_id")) for c in CUSTOMERS.columns]


def land(spark, folder, payloads, first):
    rows = [(1, i, 1000 + i, p) for i, p in enumerate(payloads, start=first)]
    df = spark.createDataFrame(rows, "session_id long, seq long, lsn long, data binary")
    df = df.withColumn("lsn", F.col("lsn").cast("decimal(20,0)"))
    df.coalesce(1).write.mode("append").parquet(folder)
    return first + len(payloads)


def customer(i, email, metadata="{}"):
    when = "2024-01-01 00:00:00"
    return [str(i), "acme", email, "active", "p1", metadata, "[]", when, when]


def test_stream_end_to_end(spark):
    folder, store = scratch_path(spark, "land"), TableStore(spark, scratch_path(spark, "s"), REGISTRY)
    checkpoint = scratch_path(spark, "checkpoint")
    n = land(
        spark,
        folder,
        [
            m.begin(500, 10**12),
            m.relation(1, "customers_p3", CUSTOMER_COLUMNS),
            m.relation(2, "ignored", [("id", 23, True)]),
            m.insert(1, customer(1, "a", '{"big":1}')),
            m.insert(1, customer(2, "b")),
            m.insert(2, ["1"]),
        ],
        0,
    )
    T.drain(spark, folder, store, checkpoint)
    # The second batch goes on in the same transaction, with the relation announced before.
    changed = customer(1, "new")
    changed[5] = m.UNCHANGED
    n = land(
        spark,
        folder,
        [m.update(1, changed), m.delete(1, customer(2, "b"), tag=b"O"), b"U\0", m.insert(1, customer("x", "c"))],
        n,
    )
    T.drain(spark, folder, store, checkpoint)
    T.drain(spark, folder, store, checkpoint)
    (row,) = store.current("customers").select("ID", "EMAIL", F.to_json("METADATA").alias("M")).collect()
    assert (int(row["ID"]), row["EMAIL"], row["M"]) == (1, "new", '{"big":1}')
    history = store.history("customers").orderBy("_CDC_LSN").collect()
    assert [(r["_CDC_OP"], int(r["_CDC_LSN"])) for r in history] == [("I", 1003), ("I", 1004), ("U", 1006), ("D", 1007), ("I", 1009)]
    assert len({r["_CDC_TS"] for r in history}) == 1
    assert {(r["seq"], r["error"]) for r in store.dead().collect()} == {
        (8, "row message cut short"),
        (9, "bad value in ID"),
    }
    assert store.position() == {"seq": n - 1, "session_id": 1, "confirmed_lsn": "500"}
    processed = store.metrics().filter(F.col("metric") == M.PROCESSED)
    assert processed.agg(F.sum("value")).first()[0] == 5.0
    assert not files.children(spark, f"{store.root}/_work")


def test_messages_that_land_again(spark):
    """A new checkpoint sees all files again: what was taken is passed over, what was not and lies
    behind the position is a dead letter."""
    folder, store = scratch_path(spark, "land"), TableStore(spark, scratch_path(spark, "s"), REGISTRY)
    head = [m.begin(500, 0), m.relation(1, "customers", CUSTOMER_COLUMNS)]
    land(spark, folder, [*head, m.insert(1, customer(1, "a"))], 0)
    n = land(spark, folder, [m.insert(1, customer(2, "b"))], 5)
    T.drain(spark, folder, store, scratch_path(spark, "checkpoint"))
    assert store.history("customers").count() == 2
    land(spark, folder, [m.insert(1, customer(3, "late")), m.insert(1, customer(4, "late"))], 3)
    land(spark, folder, [m.insert(1, customer(5, "c"))], n)
    T.drain(spark, folder, store, scratch_path(spark, "checkpoint"))
    T.drain(spark, folder, store, scratch_path(spark, "checkpoint"))
    assert {int(r["ID"]) for r in store.current("customers").collect()} == {1, 2, 5}
    assert store.history("customers").count() == 3
    late = store.dead().filter("error = 'landed late'")
    assert {(r["seq"], r["msg_type"]) for r in late.collect()} == {(3, "I"), (4, "I")}


def test_binary_values(spark):
    spec = TableSpec(source="files", current="FILES", columns={"id": "bigint", "body": "binary", "name": "string"}, pk=("id",))
    folder, store = scratch_path(spark, "land"), TableStore(spark, scratch_path(spark, "s"), {"files": spec})
    columns = [("id", 20, True), ("body", 17, False), ("name", 25, False)]
    rows = [["1", b"\x00\xff", "a"], ["2", "text", "b"], ["3", None, b"\x01"]]
    land(spark, folder, [m.begin(500, 0), m.relation(1, "files", columns), *[m.insert(1, r) for r in rows]], 0)
    T.drain(spark, folder, store, scratch_path(spark, "checkpoint"))
    assert {r["ID"]: bytes(r["BODY"]) for r in store.current("files").collect()} == {1: b"\x00\xff", 2: b"text"}
    assert [r["error"] for r in store.dead().collect()] == ["bad value in NAME"]
    assert {r["ID"]: r["BODY"] and bytes(r["BODY"]) for r in store.history("files").collect()} == {1: b"\x00\xff", 2: b"text", 3: None}


def test_history_has_unchanged_values_of_the_old_row(spark):
    folder, store = scratch_path(spark, "land"), TableStore(spark, scratch_path(spark, "s"), REGISTRY)
    new = customer(1, "new", m.UNCHANGED)
    payloads = [m.begin(500, 0), m.relation(1, "customers", CUSTOMER_COLUMNS), m.update(1, new, customer(1, "a", '{"k":1}'))]
    land(spark, folder, payloads, 0)
    T.drain(spark, folder, store, scratch_path(spark, "checkpoint"))
    row = store.history("customers").select("EMAIL", F.to_json("METADATA").alias("M")).first()
    assert (row["EMAIL"], row["M"]) == ("new", '{"k":1}')


def test_a_batch_without_messages(spark):
    store = TableStore(spark, scratch_path(spark, "s"), REGISTRY)
    empty = spark.createDataFrame([], RAW_WAL)
    assert T.process_batch(store, empty, "w", 0)
    assert not T.process_batch(store, empty, "w", 0)
    assert store.current("customers").count() == 0 and store.position() is None


@pytest.mark.parametrize("keys,chunks", [([k**3 for k in range(-40, 400)], 8), ([5] * 30 + [7], 4), ([1], 8), (list(range(100)), 1)])
def test_ranges_of_like_depth_cover_every_row_once(spark, keys, chunks):
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "id long")
    bounds = B.depth_bounds(df, "id", chunks)
    sizes = [S.snapshot_scan(spark, df, "id", *b).count() for b in bounds]
    assert sum(sizes) == len(keys) + 1 and bounds[0][0] is None and bounds[-1][1] is None
    if len(set(keys)) == len(keys) > chunks:
        assert max(sizes) <= 1.5 * len(keys) / chunks
    assert B.depth_bounds(df.filter("false"), "id", chunks) == []


def test_each_chunk_reads_the_source_once(spark, store, monkeypatch):
    """The source is read for the ranges and once for each chunk, good and bad rows in one write."""
    reads, real = [], B.snapshot_scan
    monkeypatch.setattr(B, "snapshot_scan", lambda *a: reads.append(a[3:]) or real(*a))
    src = source(spark, [*rows_of(range(20)), (None, "x", (1,), "2024-01-01", 0), (3, None, (1,), "2024-01-01", 0)])
    assert B.backfill(spark, SPECS, {"t": src}, store, chunks=4) == {"t": 20}
    assert len(reads) == 4 and reads[0][0] is None and reads[-1][1] is None
    assert sorted(r["error"] for r in store.dead().collect()) == ["key is null", "key is null"]
    assert sorted(k[0] for k in state(store)) == list(range(20))


def test_what_bounds_a_batch():
    assert T.batch_bounds(5)["max_files"] == 5
    assert T.batch_bounds(max_events=500, events_per_file=100)["max_files"] == 5
    assert T.batch_bounds(max_events=50, events_per_file=100)["max_files"] == 1
    assert T.batch_bounds(3, max_events=500, events_per_file=100)["max_files"] == 3
    assert T.batch_bounds(max_bytes=1 << 30)["max_bytes"] == 1 << 30
    for wrong in ({"max_events": 5}, {"max_files": 1, "max_bytes": 1}):
        with pytest.raises(ValueError):
            T.batch_bounds(**wrong)


def test_batches_are_bounded_by_bytes(spark):
    """As many files as fit into the bound, one at least."""
    folder, n = scratch_path(spark, "land"), 0
    for _ in range(6):
        n = land(spark, folder, [m.begin(500, 0)] * 50, n)
    size = max(f.stat().st_size for f in pathlib.Path(folder.removeprefix("file:")).glob("part-*"))
    taken = []
    query = (
        S.wal_stream(spark, folder, max_bytes=2 * size).writeStream.foreachBatch(lambda df, i: taken.append(df.count()))
        .option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert taken == [100, 100, 100]


def test_a_moved_key_keeps_values_of_an_earlier_batch(spark):
    """The second batch moves the row twice and leaves out its document."""
    folder, store = scratch_path(spark, "land"), TableStore(spark, scratch_path(spark, "s"), REGISTRY)
    checkpoint = scratch_path(spark, "checkpoint")
    head = [m.begin(500, 0), m.relation(1, "customers", CUSTOMER_COLUMNS)]
    n = land(spark, folder, [*head, m.insert(1, customer(1, "a", '{"k":1}')), m.insert(1, customer(7, "b"))], 0)
    T.drain(spark, folder, store, checkpoint)
    key = lambda i: [str(i), "acme", *[None] * 7]
    moves = [m.update(1, customer(i + 1, m.UNCHANGED if i == 2 else "new", m.UNCHANGED), key(i), b"K") for i in (1, 2)]
    land(spark, folder, moves, n)
    T.drain(spark, folder, store, checkpoint)
    rows = store.current("customers").select("ID", "EMAIL", F.to_json("METADATA").alias("M")).collect()
    assert sorted((int(r.ID), r.EMAIL, r.M) for r in rows) == [(3, "new", '{"k":1}'), (7, "b", "{}")]
    assert not files.children(spark, f"{store.root}/_work")


def test_sessions_that_are_open_and_one_that_is_over(spark, monkeypatch):
    """Two sessions go on in the next batch, the one that has been idle is forgotten."""
    monkeypatch.setattr(T, "SESSION_IDLE", 100)
    store = TableStore(spark, scratch_path(spark, "s"), REGISTRY)

    def batch(number, rows):
        df = spark.createDataFrame([(s, q, q, p) for s, q, p in rows], "session_id long, seq long, lsn long, data binary")
        T.process_batch(store, df.withColumn("lsn", F.col("lsn").cast("decimal(20,0)")), "w", number)

    announced = m.relation(1, "customers", CUSTOMER_COLUMNS)
    batch(0, [(0, 0, announced), (1, 150, announced), (2, 151, announced), (1, 152, m.begin(10, 0)), (2, 153, m.begin(20, 0))])
    batch(1, [(2, 160, m.insert(1, customer(2, "b"))), (1, 161, m.insert(1, customer(1, "a"))), (0, 162, m.insert(1, customer(3, "c")))])
    assert {int(r.ID) for r in store.current("customers").collect()} == {1, 2}
    assert [(r.seq, r.error) for r in store.dead().collect()] == [(162, "unknown relation")]
    assert store.position()["confirmed_lsn"] == "20"


def test_reports_become_rows(spark):
    from types import SimpleNamespace

    log = ProgressLog()
    report = lambda run, batch, rows: SimpleNamespace(
        runId=run, batchId=batch, numInputRows=rows, durationMs={"triggerExecution": 500}, timestamp="2024-01-01T00:00:00.000Z"
    )
    for p in (report("a", 0, 10), report("a", 0, 10), report("a", 1, 0), report("b", 1, 20)):
        log.add(p)
    assert log.restarts == 1
    rows = log.rows(spark)
    assert sorted((r.metric, r.op, r.batch_id, r.value) for r in rows.collect()) == [
        (M.BATCH_MS, "a", 0, 500.0), (M.BATCH_MS, "b", 1, 500.0), (M.ROWS_READ, "a", 0, 10.0), (M.ROWS_READ, "b", 1, 20.0)]
    taken = spark.createDataFrame([(M.MESSAGES, 5.0, 0), (M.MESSAGES, 8.0, 2)], "metric string, value double, batch_id long")
    assert sorted((r.batch_id, r.messages, r.per_s) for r in M.live_rates(taken, rows).collect()) == [(0, 5.0, 10.0), (2, 8.0, None)]


def test_counts_come_from_footers(spark):
    path = scratch_path(spark, "counted")
    spark.range(0, 1000, 1, 5).write.parquet(path)
    found = K.footer_count(spark, path)
    assert found.first()[0] == 1000
    assert "PushedAggregation: [COUNT(*)]" in found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
