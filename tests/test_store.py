import pytest
from pyspark.sql import functions as F

from changeflow.operators.changes import fold_changes
from changeflow.plans.reconcile import as_changes
from changeflow.schema import TableSpec
from changeflow.session import scratch_path
from changeflow.sinks import files
from changeflow.sinks import store as store_module
from changeflow.sinks.layout import clustered_layout, create_tables, violates_not_null
from changeflow.sinks.store import TableStore

SPEC = TableSpec(source="t", current="T", columns={"id": "bigint", "v": "string"}, pk=("id",))
OTHER = TableSpec(source="o", current="O", columns={"id": "bigint", "v": "string"}, pk=("id",))
SPECS = {"t": SPEC, "o": OTHER}


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_path(spark, "store"), SPECS)


def upserts(spark, pairs):
    return as_changes(spark.createDataFrame(pairs, "ID long, V string"))


def deletes(spark, ids):
    rows = as_changes(spark.createDataFrame([(i, None) for i in ids], "ID long, V string"))
    return rows.withColumn("_OP", F.lit("D"))


def state(store, source="t", **options):
    return {r["ID"]: r["V"] for r in store.current(source, **options).collect()}


def test_empty_store(store):
    assert state(store) == {} and store.history("t").count() == 0
    assert store.position() is None and store.state() == (None, None)


def test_commits_are_applied_in_order(spark, store):
    assert store.commit("w", 0, {"t": upserts(spark, [(1, "a"), (2, "b")])})
    assert store.commit("w", 1, {"t": deletes(spark, [1])})
    assert store.commit("w", 2, {"t": upserts(spark, [(1, "c")])})
    assert state(store) == {1: "c", 2: "b"}


def test_a_batch_is_committed_once_per_writer(spark, store):
    assert store.commit("w", 0, {"t": upserts(spark, [(1, "a")])})
    assert not store.commit("w", 0, {"t": upserts(spark, [(1, "again")])})
    assert store.commit("other", 0, {"t": upserts(spark, [(2, "b")])})
    assert state(store) == {1: "a", 2: "b"}


def test_two_writers_of_the_same_number(spark, store):
    """Both start from the same record: the second one fails and shows nothing."""
    head = store.head()
    store.commit("a", 0, {"t": upserts(spark, [(1, "a")])}, head=head)
    with pytest.raises(Exception, match="another writer has committed"):
        store.commit("b", 0, {"t": upserts(spark, [(2, "b")])}, head=head)
    assert state(store) == {1: "a"}
    assert store.commit("b", 0, {"t": upserts(spark, [(2, "b")])})
    assert state(store) == {1: "a", 2: "b"}


def test_failure_before_the_record_leaves_all_tables_as_they_were(spark, store, monkeypatch):
    store.commit("w", 0, {"t": upserts(spark, [(1, "a")]), "o": upserts(spark, [(1, "a")])})
    real = TableStore._record
    monkeypatch.setattr(TableStore, "_record", lambda *a, **k: 1 / 0)
    history = {"t": history_rows(spark, [1])}
    with pytest.raises(ZeroDivisionError):
        store.commit("w", 1, {"t": deletes(spark, [1]), "o": upserts(spark, [(2, "b")])}, history)
    assert state(store) == {1: "a"} and state(store, "o") == {1: "a"}
    assert store.history("t").count() == 0
    monkeypatch.setattr(TableStore, "_record", real)
    store.commit("w", 1, {"t": deletes(spark, [1]), "o": upserts(spark, [(2, "b")])}, history)
    assert state(store) == {} and state(store, "o") == {1: "a", 2: "b"}
    assert store.history("t").count() == 1


def history_rows(spark, ids):
    rows = spark.createDataFrame([(i, "v") for i in ids], "ID long, V string")
    return rows.select(
        "*",
        F.lit("U").alias("_CDC_OP"),
        F.col("ID").cast("decimal(20,0)").alias("_CDC_LSN"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("_CDC_TS"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("_LOADED_AT"),
    )


def test_history_lies_in_days(spark, store):
    """A filter on days reads their folders alone, and many tasks of a batch leave few files."""
    days = history_rows(spark, range(400)).withColumn("_CDC_TS", F.expr("timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, int(ID % 4))"))
    store.commit("w", 0, {}, {"t": days.repartition(40)})
    folder = f"{store.root}/T_HISTORY/writer=w/batch_id=0"
    assert [n for n in files.children(spark, folder) if n.startswith("_CDC_DAY")] == [f"_CDC_DAY=2024-01-0{d}" for d in range(1, 5)]
    assert len(files.children(spark, f"{folder}/_CDC_DAY=2024-01-02")) <= 8
    assert store.history("t").count() == 400 and store.history("t").columns[-1] == "_LOADED_AT"
    some = store.history("t", "2024-01-02", "2024-01-03")
    assert some.count() == 200
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_CDC_DAY" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_nothing_is_written_for_nothing(spark, store):
    none = spark.createDataFrame([], "metric string, table_name string, op string, value double, at timestamp_ntz")
    store.commit("w", 0, {}, {"t": history_rows(spark, [])}, extra={"_metrics": none})
    assert files.children(spark, f"{store.root}/_metrics/writer=w") == []
    assert store.metrics().count() == 0 and store.history("t").count() == 0


def test_compaction_keeps_the_state(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(i, f"v{i}") for i in range(100)])})
    store.compact("t", bucket_rows=30)
    table = store.head()["tables"]["T"]
    assert (table["rows"], table["buckets"], table["deltas"]) == (100, 4, [])
    store.commit("w", 1, {"t": deletes(spark, range(0, 100, 2))})
    store.commit("w", 2, {"t": upserts(spark, [(1, "new"), (200, "x")])})
    expected = {i: f"v{i}" for i in range(1, 100, 2)} | {1: "new", 200: "x"}
    assert state(store) == state(store, broadcast_rows=0) == expected
    store.compact("t", bucket_rows=30)
    assert state(store) == expected
    assert store.head()["tables"]["T"]["rows"] == 51


def test_large_changes_do_not_move_the_base(spark, store):
    """Beyond the broadcast bound the base is read by bucket: only the changes are exchanged."""
    store.commit("w", 0, {"t": upserts(spark, [(i, f"v{i}") for i in range(100)])})
    store.compact("t", bucket_rows=10)
    store.commit("w", 1, {"t": upserts(spark, [(1, "new")])})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.current("t", broadcast_rows=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "Bucketed: true" in plan


def test_small_changes_do_not_move_the_base(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(i, f"v{i}") for i in range(100)])})
    store.compact("t", bucket_rows=10)
    store.commit("w", 1, {"t": upserts(spark, [(1, "new")])})
    df = store.current("t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    untouched = plan[: plan.index("LeftSemi")]
    assert "Exchange hashpartitioning" not in untouched.split("LeftAnti")[1].split("+- Project")[0]


def test_filters_reach_the_base(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(i, f"v{i}") for i in range(100)])})
    store.compact("t")
    store.commit("w", 1, {"t": upserts(spark, [(1, "new")])})
    plan = store.current("t").filter("ID = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ID,7)" in plan


def test_compaction_is_due_by_size_alone(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "FOLD_DELTAS", 3)
    store.commit("w", 0, {"t": upserts(spark, [(i, "v") for i in range(100)])})
    assert not store.compaction_due("t")
    store.compact("t")
    base = store.head()["tables"]["T"]["base"]
    for i in range(1, 20):
        store.commit("w", i, {"t": upserts(spark, [(1, f"a{i}")])})
        if store.folding_due("t"):
            store.fold("t")
    table = store.head()["tables"]["T"]
    assert table["base"] == base and len(table["deltas"]) <= 6
    assert {d.get("level", 0) for d in table["deltas"]} >= {2}
    assert state(store) == {i: "v" for i in range(100)} | {1: "a19"}
    assert not store.compaction_due("t") and store.maintain() == []
    store.commit("w", 20, {"t": upserts(spark, [(i, "a") for i in range(30)])})
    assert store.maintain() == ["t"]
    table = store.head()["tables"]["T"]
    assert table["base"] != base and not table["deltas"] and state(store)[29] == "a"


def test_fold_keeps_deletes_and_unset_values(spark, store, monkeypatch):
    monkeypatch.setattr(store_module, "FOLD_DELTAS", 3)
    store.commit("w", 0, {"t": upserts(spark, [(1, "kept"), (2, "gone"), (3, "old")])})
    store.compact("t")
    unset = upserts(spark, [(1, None)]).withColumn("_UNSET", F.array(F.lit("V")))
    for i, rows in enumerate([unset, deletes(spark, [2]), upserts(spark, [(3, "new")])], start=1):
        store.commit("w", i, {"t": rows})
    expected = state(store)
    store.fold("t")
    assert len(store.head()["tables"]["T"]["deltas"]) == 1
    assert state(store) == expected == {1: "kept", 3: "new"}


def test_a_hold_keeps_changes_apart(spark, store, monkeypatch):
    """Changes from before and after the start of a backfill are not folded into one, and the base
    waits."""
    monkeypatch.setattr(store_module, "FOLD_DELTAS", 2)
    store.commit("w", 0, {"t": upserts(spark, [(1, "a")])})
    store.hold("t", "run")
    store.commit("w", 1, {"t": upserts(spark, [(1, "b")])})
    store.compact("t")
    table = store.head()["tables"]["T"]
    assert table["base"] is None and len(table["deltas"]) == 2 and not store.compaction_due("t")


def test_expire_keeps_what_is_valid(spark, store):
    for i in range(4):
        store.commit("w", i, {"t": upserts(spark, [(i, "v")])})
    store.compact("t")
    before = state(store)
    store.compact("t")
    assert store.expire(keep=1) > 0
    assert state(store) == before
    assert len(files.children(spark, f"{store.root}/_commits")) == 1
    assert len(files.children(spark, f"{store.root}/T/base")) == 1


def half_written(spark, store, number):
    path = f"{store.root}/_commits/{number:012d}"
    spark.range(1).select(F.lit("{").alias("value")).write.text(path)
    files.remove(spark, f"{path}/_SUCCESS")


def test_a_half_written_record_blocks_nothing(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(1, "a")])})
    half_written(spark, store, 2)
    assert state(store) == {1: "a"}
    assert store.commit("w", 1, {"t": upserts(spark, [(2, "b")])})
    half_written(spark, store, 4)
    assert store.commit("w", 2, {"t": upserts(spark, [(1, "c")])})
    assert state(store) == {1: "c", 2: "b"} and store.head()["n"] == 5


def test_two_writers_conflict_behind_a_half_written_record(spark, store):
    half_written(spark, store, 1)
    head = store.head()
    store.commit("a", 0, {"t": upserts(spark, [(1, "a")])}, head=head)
    with pytest.raises(Exception, match="another writer has committed"):
        store.commit("b", 0, {"t": upserts(spark, [(2, "b")])}, head=head)
    assert state(store) == {1: "a"}


def test_expire_drops_catalog_entries(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(1, "a")])})
    entries = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("changeflow_")}
    before = entries()
    store.compact("t")
    store.compact("t")
    store.expire(keep=1)
    assert len(entries() - before) == 1


def test_a_new_session_reads_the_same_state(spark, store):
    """The catalog entry of a base lives in the session; its files say the rest."""
    store.commit("w", 0, {"t": upserts(spark, [(i, f"v{i}") for i in range(50)])})
    store.compact("t", bucket_rows=10)
    base = store.head()["tables"]["T"]["base"][0]
    for table in spark.catalog.listTables():
        if table.name.startswith("changeflow_"):
            spark.sql(f"drop table {table.name}")
    assert files.exists(spark, base)
    assert state(TableStore(spark, store.root, SPECS)) == {i: f"v{i}" for i in range(50)}


def test_layout_splits_a_hot_key(spark):
    rows = spark.range(30000).select(F.when(F.col("id") < 20000, 0).otherwise(F.col("id")).alias("k"), "id")
    laid = clustered_layout(rows, ["k"], 8)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 30000 / 8
    assert laid.count() == 30000


def test_tables_are_created_once(spark):
    spec = TableSpec(source="x", current="X_CREATED", columns={"id": "bigint", "doc": "variant"}, pk=("id",))
    folder = scratch_path(spark, "tables")
    names = create_tables(spark, {"x": spec}, folder)
    assert names == create_tables(spark, {"x": spec}, folder) == ["X_CREATED", "X_CREATED_HISTORY"]
    assert spark.table("X_CREATED").columns == ["ID", "DOC", "_LOADED_AT"]
    assert spark.table("X_CREATED_HISTORY").columns[-4:] == ["_CDC_OP", "_CDC_LSN", "_CDC_TS", "_LOADED_AT"]


def test_not_null_rule(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "ID long, V string")
    assert violates_not_null(rows, ["ID", "V"]).count() == 2


def test_fold_over_commits_keeps_unset_values(spark, store):
    store.commit("w", 0, {"t": upserts(spark, [(1, "kept")])})
    unset = upserts(spark, [(1, None)]).withColumn("_UNSET", F.array(F.lit("V")))
    store.commit("w", 1, {"t": unset})
    assert state(store) == {1: "kept"}
    assert fold_changes(unset, ["ID"]).first()["_UNSET"] == ["V"]
