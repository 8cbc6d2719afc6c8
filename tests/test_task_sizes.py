"""Steps that cost much for each message: made once, and in tasks that leave no core waiting for a second turn."""

import pathlib

from pyspark.sql import functions as F

import messages as m
from changeflow.operators import decode as D
from changeflow.queries import changelog as C
from changeflow.schema import TableSpec
from changeflow.session import scratch_path, settle, shared_dir
from changeflow.sinks.store import TableStore
from changeflow.streaming import stream as T
from test_landing import SF_DIR, files_of


def test_decoding_has_more_tasks_than_the_bytes_ask_for(spark):
    """60,000 messages are a few hundred kilobytes in a shuffle: sized by them there would be one task or two. The
    folder has a file for each task and table."""
    begin, relation = m.begin(500, 0), m.relation(1, "boats", [("id", 23, True), ("name", 25, False)])
    row, seq = m.insert(1, ["1", "Anna"]), F.col("id") % 100
    data = F.when(seq == 0, F.lit(begin)).when(seq == 1, F.lit(relation)).otherwise(F.lit(row))
    raw = spark.range(60_000).select(
        F.expr("id div 100").alias("session_id"), (F.col("id") + 1).alias("seq"),
        F.lit(7).cast("decimal(20,0)").alias("lsn"), data.alias("data"),
    )
    rows = D.decode_wal(raw).rows
    assert len(rows.inputFiles()) >= 5
    good = rows.filter("error is null and table_name = 'boats' and commit_lsn = 500").count()
    assert good == rows.count() == 60_000 - 1_200


def test_messages_go_from_the_events_into_the_files(spark):
    """They are not kept a second time on the way."""
    shared = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.glob("settled-*"))
    C.landed_wal(spark, SF_DIR)
    assert set(shared.glob("settled-*")) == before


def test_last_event_without_a_message(spark):
    """An event without its user has no row message: the files end before it."""
    place = scratch_path(spark, "unknown")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumn("value", F.lit(1.5))
    user = F.when(F.col("event_id") < 999, F.col("user_id"))
    events.filter("event_id <= 999").withColumn("user_id", user).write.parquet(f"{place}/events.parquet")
    folder, per_batch = C.landed_wal(spark, place)
    seqs = lambda df: sorted(r["seq"] for r in df.select("seq").collect())
    found = seqs(spark.read.parquet(folder))
    assert found == seqs(C.wal(spark, place)) and found[-1] // C.EVENT_POSITIONS == 998
    assert len(files_of(folder)) == C.LANDED_BATCHES * per_batch


def test_rows_that_are_read_once_are_not_kept(spark):
    """The same rows, decoded as they are read, with no copy of them in the shared folder."""
    begin, relation = m.begin(500, 0), m.relation(1, "boats", [("id", 23, True), ("name", 25, False)])
    payloads = [begin, relation, m.insert(1, ["1", "Anna"]), m.insert(1, ["2", None]), m.insert(1, ["3", "Carla"])[:-2], m.insert(9, ["4"])]
    rows = [(1, k, k, p) for k, p in enumerate(payloads, start=100)]
    raw = spark.createDataFrame(rows, "session_id long, seq long, lsn long, data binary").withColumn(
        "lsn", F.col("lsn").cast("decimal(20,0)")
    )
    kept, passing = (D.decode_wal(raw, folder=scratch_path(spark, "once"), keep=k) for k in (True, False))
    assert any("/rows/" in f for f in kept.rows.inputFiles())
    assert not any("/rows/" in f for f in passing.rows.inputFiles())
    for part in ("changes", "dead"):
        ordered = [getattr(d, part).orderBy("seq").collect() for d in (kept, passing)]
        assert len(ordered[0]) == 2 and ordered[0] == ordered[1]


def stream_of(spark, sessions, first=100):
    """Messages of some sessions, one after the other: a begin, a relation and rows, some of them damaged."""
    rows = []
    for s in range(sessions):
        payloads = [m.begin(500 + s, 0), m.relation(1, "boats", [("id", 23, True), ("name", 25, False)])]
        payloads += [m.insert(1, [str(k), f"n{s}"]) for k in range(20)] + [m.insert(1, ["3", "Carla"])[:-2], m.insert(9, ["4"])]
        rows += [(s, first + s * 40 + k, k, p) for k, p in enumerate(payloads)]
    raw = spark.createDataFrame(rows, "session_id long, seq long, lsn long, data binary")
    return settle(raw.repartition(3).withColumn("lsn", F.col("lsn").cast("decimal(20,0)")))


def test_messages_behind_the_position_are_passed_over_and_counted(spark):
    raw = stream_of(spark, 4, 1000)
    for taken, behind in ((None, 0), (999, 0), (1050, 35)):
        decoded = D.decode_wal(raw, taken=taken)
        assert decoded.behind == behind and decoded.rows.filter(F.col("seq") <= (taken or 0)).count() == 0
        assert decoded.rows.count() == raw.filter((F.col("seq") > (taken or 0)) & (F.col("lsn") > 1)).count()
    assert D.decode_wal(raw.filter("seq < 0"), taken=5).rows.count() == 0


def test_a_batch_behind_nothing_does_not_ask_what_was_taken(spark, monkeypatch):
    """Folders of all earlier batches were listed for every batch, and dead letters without any were written."""
    spec = TableSpec(source="boats", current="BOATS", columns={"id": "bigint", "name": "string"}, pk=("id",), not_null=("id",))
    store = TableStore(spark, scratch_path(spark, "store"), {"boats": spec})
    raw = stream_of(spark, 3, 0)
    good = raw.filter("seq % 40 < 22")
    assert T.process_batch(store, good.filter("seq < 80"), "w", 0)
    monkeypatch.setattr(store, "taken", lambda: 1 / 0)
    assert T.process_batch(store, good.filter("seq >= 80"), "w", 1)
    assert store.head()["state_bytes"] > 0 and store.history("boats").count() == 60 and store.dead().count() == 0
    monkeypatch.undo()
    assert T.process_batch(store, raw.filter("seq = 62"), "w", 2)  # a damaged message of an earlier session
    assert [r["error"] for r in store.dead().collect()] == [T.LATE]
