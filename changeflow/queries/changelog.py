"""Inputs of the registered queries, all derived by Spark from the given tables.

`changelog` turns every row of `events` into one change event of a table keyed by user.
`wal` encodes the same events as raw log messages. The SQL text `CL` is the same change log for
the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.schema import TableSpec
from changeflow.session import scratch_path, tasks_for
from changeflow.sinks import files
from changeflow.sources.scans import wal_scan

EVENTS = TableSpec(
    source="events",
    current="EVENTS",
    columns={
        "userId": "bigint",
        "eventType": "string",
        "value": "double",
        "props": "variant",
        "ts": "timestamp_ntz",
    },
    pk=("userId",),
    json=("props",),
    not_null=("userId",),
    ts_col="ts",
    cluster_by=("userId",),
    prefixes=("events_",),
)
SPECS = {"events": EVENTS}
AUDIT = TableSpec(
    source="audit_log",
    current="AUDIT_LOG",
    columns=EVENTS.columns,
    pk=EVENTS.pk,
    json=EVENTS.json,
    not_null=EVENTS.not_null,
    ts_col="ts",
)
BOTH_SPECS = SPECS | {"audit_log": AUDIT}

TX_EVENTS = 7  # events per transaction
SESSION_EVENTS = 700  # events per connection lifetime
EVENT_POSITIONS = 20  # positions of the log per event
AUDIT_VALUE = 120.0  # events from this value on belong to a table that is not replicated
CUT_VALUE = 1.0  # in the damaged log, messages below this value lose their last bytes
PARTITIONS = 4

# The change log as a DuckDB common table expression.
CL = f"""cl as (
  select event_id as seq, event_id * 100 + 16777216 as lsn,
    case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
    event_id // {TX_EVENTS} as tx, event_id // {SESSION_EVENTS} as session_id,
    (event_id // {TX_EVENTS} * {TX_EVENTS} + {TX_EVENTS - 1}) * 100 + 16777266 as commit_lsn,
    epoch_us(first_value(ts) over (partition by event_id // {TX_EVENTS} order by event_id)) // 1000 as ts_ms,
    case when value >= {AUDIT_VALUE} then 'audit_log'
         else 'events_p' || (user_id % {PARTITIONS}) end as table_name,
    user_id, event_type, case when event_type <> 'view' then value end as value,
    cast(json(props) as varchar) as props, ts
  from events)"""
# Only events of replicated tables, under the parent's name.
MAPPED = f"{CL}, mapped as (select * replace ('events' as table_name) from cl where table_name like 'events_%')"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def base_events(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """`events` with the columns of the change log, before any image is made; if wanted only those given, which
    are whole transactions, and in so many tasks."""
    tx = F.call_function("div", F.col("event_id"), F.lit(TX_EVENTS))
    # A commit time belongs to a transaction: the time of its first event.
    first = F.min_by("ts", "event_id").over(Window.partitionBy("tx"))
    rows = (read(spark, sf_dir, "events") if events is None else events).withColumn("tx", tx)
    return (
        (rows.repartition(tasks, "tx") if tasks else rows)
        .withColumn("commit_ts", first)
        .select(
            F.col("event_id").alias("seq"),
            (F.col("event_id") * 100 + 16777216).cast("decimal(20,0)").alias("lsn"),
            F.when(F.col("event_type") == "signup", "c")
            .when(F.col("event_type") == "error", "d")
            .otherwise("u")
            .alias("op"),
            "tx",
            F.call_function("div", F.col("event_id"), F.lit(SESSION_EVENTS)).alias("session_id"),
            ((F.col("tx") * TX_EVENTS + TX_EVENTS - 1) * 100 + 16777266)
            .cast("decimal(20,0)")
            .alias("commit_lsn"),
            F.unix_micros(F.col("commit_ts").cast("timestamp")).alias("commit_us"),
            F.when(F.col("value") >= AUDIT_VALUE, "audit_log")
            .otherwise(F.concat(F.lit("events_p"), F.col("user_id") % PARTITIONS))
            .alias("table_name"),
            "user_id",
            "event_type",
            "value",
            "props",
            "ts",
        )
    )


def source_texts() -> dict[str, Column]:
    """Column name -> text as the source would send it, NULL where the value is NULL."""
    return {
        "userId": F.col("user_id").cast("string"),
        "eventType": F.col("event_type"),
        "value": F.when(F.col("event_type") != "view", F.col("value").cast("string")),
        "props": F.col("props"),
        "ts": F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    }


def _image(texts: dict[str, Column]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.when(t.isNull(), "n").otherwise("t").alias("kind"),
                t.alias("text"),
                F.lit(None).cast("binary").alias("bin"),
            )
            for n, t in texts.items()
        ]
    )


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as change events: old key for deletes, new row otherwise."""
    texts = source_texts()
    key_only = {n: t if n == "userId" else F.lit(None).cast("string") for n, t in texts.items()}
    op = F.col("op")
    return base_events(spark, sf_dir).select(
        "op",
        F.lit("public").alias("schema_name"),
        "table_name",
        F.when(op == "d", _image(key_only)).alias("before"),
        F.when(op != "d", _image(texts)).alias("after"),
        "lsn",
        "commit_lsn",
        F.call_function("div", F.col("commit_us"), F.lit(1000)).alias("ts_ms"),
        "session_id",
        "seq",
    )


# Encoding of log messages, all with built-in functions.


def _uint(c: Column, size: int) -> Column:
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), size * 2, "0"))


def _text(c: Column) -> Column:
    return F.encode(c, "UTF-8")


def _ascii(s: str) -> Column:
    return F.lit(s.encode())


def tuple_bytes(texts: list[Column]) -> Column:
    values = [
        F.when(t.isNull(), _ascii("n")).otherwise(
            F.concat(_ascii("t"), _uint(F.octet_length(t), 4), _text(t))
        )
        for t in texts
    ]
    return F.concat(F.lit(len(texts).to_bytes(2, "big")), *values)


def _relation(oid: int, table: str) -> bytes:
    columns = [("userId", 20, 1), ("eventType", 25, 0), ("value", 701, 0), ("props", 3802, 0), ("ts", 1114, 0)]
    body = b"R" + oid.to_bytes(4, "big") + b"public\0" + table.encode() + b"\0" + b"f"
    body += len(columns).to_bytes(2, "big")
    for name, type_oid, flags in columns:
        body += bytes([flags]) + name.encode() + b"\0" + type_oid.to_bytes(4, "big") + b"\xff\xff\xff\xff"
    return body


AUDIT_OID = 900
PARTITION_OID = 100
MISSING_OID = 77


def wal(
    spark: SparkSession, sf_dir: str, damaged: bool = False, events: DataFrame | None = None, tasks: int | None = None
) -> DataFrame:
    """The change log as raw messages: begin, relations at the start of a session, row, commit.

    Updates of purchases carry the full old row. With `damaged`, messages of small values lose
    their last three bytes and clicks in the audit table name an oid that was never announced.
    """
    # What several messages hold is made once, in steps of their own: as one expression they are a method
    # too large for the JVM to compile.
    e = base_events(spark, sf_dir, events, tasks).withColumns({f"_{n}": t for n, t in source_texts().items()})
    texts = [F.col(f"_{n}") for n in source_texts()]
    null = F.lit(None).cast("string")
    oid = F.when(F.col("table_name") == "audit_log", F.lit(AUDIT_OID)).otherwise(
        PARTITION_OID + F.col("user_id") % PARTITIONS
    )
    if damaged:
        lost = (F.col("table_name") == "audit_log") & (F.col("event_type") == "click")
        oid = F.when(lost, F.lit(MISSING_OID)).otherwise(oid)
    e = e.withColumns(
        {
            "_oid": _uint(oid, 4),
            "_new": tuple_bytes(texts),
            "_key": tuple_bytes([texts[0], null, null, null, null]),
            "_commit": _uint(F.col("commit_lsn"), 8),
            "_micros": _uint(F.col("commit_us") - 946684800000000, 8),
        }
    )
    oid, new, key, commit, micros = (F.col(f"_{n}") for n in ("oid", "new", "key", "commit", "micros"))
    row = (
        F.when(F.col("op") == "c", F.concat(_ascii("I"), oid, _ascii("N"), new))
        .when(F.col("op") == "d", F.concat(_ascii("D"), oid, _ascii("K"), key))
        .when(
            F.col("event_type") == "purchase",
            F.concat(_ascii("U"), oid, _ascii("O"), new, _ascii("N"), new),
        )
        .otherwise(F.concat(_ascii("U"), oid, _ascii("N"), new))
    )
    e, row = e.withColumn("_row", row), F.col("_row")
    if damaged:
        cut = F.substring(row, F.lit(1), (F.octet_length(row) - 3).cast("int"))
        row = F.when(F.col("value") < CUT_VALUE, cut).otherwise(row)
    begin = F.concat(_ascii("B"), commit, micros, _uint(F.col("tx"), 4))
    end = F.concat(_ascii("C"), F.lit(b"\0"), commit, commit, micros)
    tables = [("audit_log", AUDIT_OID)]
    tables += [(f"events_p{i}", PARTITION_OID + i) for i in range(PARTITIONS)]
    first = lambda size: F.col("seq") == F.call_function("div", F.col("seq"), F.lit(size)) * size
    last = F.col("seq") == F.col("tx") * TX_EVENTS + TX_EVENTS - 1
    parts = [(0, F.when(first(TX_EVENTS), begin))]
    parts += [
        (k, F.when(first(SESSION_EVENTS), F.lit(_relation(o, t))))
        for k, (t, o) in enumerate(tables, start=1)
    ]
    parts += [(10, row), (15, F.when(last, end))]
    messages = F.array(
        *[F.struct(F.lit(k).alias("k"), data.alias("data")) for k, data in parts]
    )
    return (
        e.select("session_id", "seq", "lsn", F.explode(messages).alias("m"))
        .filter(F.col("m.data").isNotNull())
        .select(
            "session_id",
            (F.col("seq") * EVENT_POSITIONS + F.col("m.k")).alias("seq"),
            "lsn",
            F.col("m.data").alias("data"),
        )
    )


LANDED_BATCHES = 4
FILE_POSITIONS = 250_000  # positions a landed file spans at most


def _span(spark: SparkSession, sf_dir: str, damaged: bool, ids: Row) -> tuple[int, int]:
    """First and last position of the messages. Positions rise with the events, so those of the first and the last
    transaction tell, unless its event has no message."""
    tx = lambda event_id: F.call_function("div", event_id, F.lit(TX_EVENTS))
    outer = F.lit(False)
    for end in (ids["low"], ids["high"]):
        outer |= tx(F.col("event_id")) == tx(F.lit(end))
    ends = (F.min("seq"), F.max("seq"))
    low, high = wal(spark, sf_dir, damaged, read(spark, sf_dir, "events").filter(outer)).agg(*ends).first()
    if low is None or (low // EVENT_POSITIONS, high // EVENT_POSITIONS) != (ids["low"], ids["high"]):
        low, high = wal(spark, sf_dir, damaged).agg(*ends).first()
    return low, high


def landed_wal(spark: SparkSession, sf_dir: str, damaged: bool = False) -> tuple[str, int]:
    """Land the messages as a log writer does: one file after the other, in arrival order.
    Returns the folder and the number of files per batch that makes four batches."""
    path, parts = scratch_path(spark, "landing"), scratch_path(spark, "parts")
    events, event_id = read(spark, sf_dir, "events"), F.col("event_id")
    ids = events.agg(F.min(event_id).alias("low"), F.max(event_id).alias("high"), F.count("*").alias("n")).first()
    low, high = _span(spark, sf_dir, damaged, ids)
    per_batch = -(-(high - low + 1) // (LANDED_BATCHES * FILE_POSITIONS))
    step = (high - low) // (LANDED_BATCHES * per_batch) + 1
    number = (high - low) // step + 1
    # One job makes the messages and writes every file, without a copy of them in between; a span without messages
    # is a file without rows.
    tasks = tasks_for(spark, ids["n"])
    messages = wal(spark, sf_dir, damaged, tasks=tasks)
    numbered = messages.withColumn("file", F.call_function("div", F.col("seq") - low, F.lit(step)))
    numbered = numbered.repartition(min(tasks, number), "file")
    numbered.write.option("maxRecordsPerFile", 0).partitionBy("file").parquet(parts)
    messages.filter("false").coalesce(1).write.parquet(f"{parts}/empty")
    files.land(spark, parts, "file", number, path)
    return path, per_batch


_LANDED: dict[tuple, tuple[str, int]] = {}


def _landed(spark: SparkSession, sf_dir: str, damaged: bool) -> tuple[str, int]:
    key = (spark.sparkContext.applicationId, sf_dir, damaged)
    if key not in _LANDED:
        _LANDED[key] = landed_wal(spark, sf_dir, damaged)
    return _LANDED[key]


def landing(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    """The landing folder of this session; written once."""
    return _landed(spark, sf_dir, damaged)[0]


def files_per_batch(spark: SparkSession, sf_dir: str, batches: int = LANDED_BATCHES) -> int:
    return _landed(spark, sf_dir, False)[1] * LANDED_BATCHES // batches


def landed(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    return wal_scan(spark, landing(spark, sf_dir, damaged))
