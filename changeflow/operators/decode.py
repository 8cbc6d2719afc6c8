"""Landed log messages -> change events, as one Spark job.

Begin and relation messages are few and small. They are pulled out once into a written
table, from which the transaction context and the relation versions are built. Row messages
are moved once, to put each block of arrival order together; relations come by broadcast
when they are small, and the tuple bytes are decoded in the same stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions import tuples, wire
from changeflow.functions.scalars import pg_micros_to_ms
from changeflow.operators.fill import BLOCK, FAN_IN, block_of, fill_forward
from changeflow.schema import RELATION_DDL, TX_DDL
from changeflow.session import settle, ship, tasks_for

ROW_TYPES = ("I", "U", "D")
OPS = {"I": "c", "U": "u", "D": "d"}
OPEN_END = 1 << 62

# About what a name and its type take in a relation carried over from an earlier batch.
RELATION_BYTES = 64
# Relations are broadcast up to this size (bytes of their messages), joined by shuffle beyond.
RELATION_BROADCAST_BYTES = 64 << 20


@dataclass
class Decoded:
    """`rows` holds every row message, decoded, with `error` set on the bad ones; `control_errors` is the
    number of control messages that could not be used. `behind` is the number of messages that
    were passed over."""

    rows: DataFrame
    control_dead: DataFrame
    control_errors: int
    relations: DataFrame
    transactions: DataFrame
    behind: int = 0

    @property
    def changes(self) -> DataFrame:
        return good_changes(self.rows)

    @property
    def dead(self) -> DataFrame:
        return dead_rows(self.rows).unionByName(self.control_dead)


def classify(raw: DataFrame) -> DataFrame:
    """Message type = first byte; empty messages carry nothing."""
    return raw.filter(F.octet_length("data") > 0).withColumn(
        "msg_type", F.expr(wire.tag("data", "1"))
    )


def count_ignored(raw: DataFrame) -> DataFrame:
    """How many messages of each type without an effect were seen."""
    return (
        classify(raw)
        .filter(~F.col("msg_type").isin("B", "R", *ROW_TYPES))
        .groupBy("msg_type")
        .agg(F.count("*").alias("messages"))
    )


def _begin_columns(messages: DataFrame) -> DataFrame:
    is_begin = F.col("msg_type") == "B"
    lsn, micros = F.expr(wire.unsigned64("data", "2")), F.expr(wire.signed64("data", "10"))
    return messages.withColumns(
        {
            "commit_lsn": F.when(is_begin, lsn),
            "ts_ms": F.when(is_begin, pg_micros_to_ms(micros)),
        }
    )


def _begin_error() -> Column:
    return F.when(F.octet_length("data") < 17, "begin message cut short").when(
        F.col("ts_ms").isNull(), "commit time out of range"
    )


def decode_begin(messages: DataFrame) -> DataFrame:
    """Begin messages -> commit position and commit time; `error` set when cut short."""
    begins = _begin_columns(messages.filter(F.col("msg_type") == "B"))
    return begins.withColumn("error", _begin_error())


def _relation_columns(messages: DataFrame) -> DataFrame:
    def only(expression: str) -> Column:
        return F.when(F.col("msg_type") == "R", F.expr(expression))

    return (
        messages.withColumn("oid", only(wire.unsigned("data", "2", 4)))
        .withColumn("_ns", only(wire.cstring("data", "6")))
        .withColumn("_t", only("7 + octet_length(_ns)"))
        .withColumn("_tb", only(wire.cstring("data", "_t")))
        .withColumn("_c", only("_t + octet_length(_tb) + 2"))
        .withColumn("_fold", only(wire.relation_columns("data", "_c")))
        .withColumn("namespace", F.col("_ns").cast("string"))
        .withColumn("table_name", F.col("_tb").cast("string"))
        .drop("_t", "_c", "_ns", "_tb")
    )


def _relation_error() -> Column:
    text = F.expr("is_valid_utf8(namespace) and is_valid_utf8(table_name) and _fold.ok")
    cut = F.expr(wire.overrun("data", "_fold.off"))
    return F.when(cut, "relation message cut short").when(~text, "relation name is not text")


def decode_relation(messages: DataFrame) -> DataFrame:
    """Relation messages -> oid, namespace, table and columns; `error` set on broken ones."""
    relations = _relation_columns(messages.filter(F.col("msg_type") == "R"))
    return relations.select("*", F.col("_fold.cols").alias("columns"), _relation_error().alias("error")).drop("_fold")


def counted(raw: DataFrame, seen: Observation, taken: int | None = None) -> DataFrame:
    """`raw`; a pass over it tells `seen` how many messages are not after the position `taken`."""
    behind = F.lit(False) if taken is None else ~F.coalesce(F.col("seq") > taken, F.lit(False))
    return raw.observe(seen, F.count_if(behind).alias("behind"))


def decode_control(
    messages: DataFrame, folder: str | None = None
) -> tuple[DataFrame, DataFrame, dict]:
    """Begin and relation messages, decoded in one pass over the log and kept; and the `bytes` of
    all relation messages with the number of `errors`."""
    control = messages.filter(F.col("msg_type").isin("B", "R"))
    seen = Observation()
    is_relation = F.col("msg_type") == "R"
    size = F.sum(F.when(is_relation, F.octet_length("data"))).alias("bytes")
    errors = F.count_if(F.when(is_relation, _relation_error()).otherwise(_begin_error()).isNotNull()).alias("errors")
    control = settle(_relation_columns(_begin_columns(control)), folder, seen=seen, totals=[size, errors])
    begins = control.filter(F.col("msg_type") == "B").withColumn("error", _begin_error())
    relations = control.filter(F.col("msg_type") == "R").withColumn("error", _relation_error())
    begins = begins.select(*messages.columns, "commit_lsn", "ts_ms", "error")
    names = ("oid", "namespace", "table_name")
    columns = F.col("_fold.cols").alias("columns")
    relations = relations.select(*messages.columns, *names, columns, "error")
    return begins, relations, {"bytes": int(seen.get["bytes"] or 0), "errors": int(seen.get["errors"])}


def relation_versions(relations: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """One row per announcement with the range of `seq` in which it is the newest one."""
    rows = relations.select(
        "session_id", "oid", "namespace", "table_name", "columns", F.col("seq").alias("valid_from")
    )
    if earlier is not None:
        rows = rows.unionByName(earlier.drop("valid_to"))
    following = F.lead("valid_from", 1, OPEN_END).over(
        Window.partitionBy("session_id", "oid").orderBy("valid_from")
    )
    return rows.withColumn("valid_to", following).to(StructType.fromDDL(RELATION_DDL))


def carry_transactions(
    rows: DataFrame,
    begins: DataFrame,
    positions: DataFrame,
    earlier: DataFrame | None = None,
    block: int = BLOCK,
    fan_in: int = FAN_IN,
    folder: str | None = None,
) -> DataFrame:
    """Stamp each row message with the newest earlier begin of its session, 0 and 0 before the
    first one. `positions` lists (session_id, seq) of all messages, read without their bytes."""
    context = F.struct("commit_lsn", "ts_ms")
    by_block = block_of(F.col("seq"), block)
    starts = begins.select("session_id", "seq", context.alias("tx"))
    if earlier is not None:
        starts = starts.unionByName(
            earlier.select("session_id", F.lit(-1).cast("bigint").alias("seq"), context.alias("tx"))
        )
    empty = F.lit(None).cast(starts.schema["tx"].dataType).alias("tx")
    # Positions are counted before begins join them: tasks count by hashing, the newest begin takes a sort.
    counted = positions.groupBy("session_id", by_block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
    ends = (
        counted.unionByName(starts.withColumn("block", by_block), allowMissingColumns=True)
        .groupBy("session_id", "block")
        .agg(F.max_by("tx", F.when(F.col("tx").isNotNull(), F.col("seq"))).alias("tx"), F.sum("n").alias("n"))
    )
    events = rows.withColumn("tx", empty).unionByName(starts, allowMissingColumns=True)
    # The ends of the blocks are read on two levels: written once, not computed twice.
    seen = Observation()
    totals = [F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("messages")]
    ends = settle(ends, folder, seen=seen, totals=totals).drop("n")
    few = seen.get["blocks"] <= fan_in
    # What follows takes the messages apart in the same tasks.
    tasks = tasks_for(rows.sparkSession, seen.get["messages"] or 0)
    events = events.withColumn("block", by_block).repartition(tasks, "session_id", "block")
    filled = fill_forward(events, ends, "session_id", "seq", "tx", fan_in, few)
    return (
        filled.filter(F.col("msg_type").isNotNull())
        .withColumn("commit_lsn", F.coalesce("tx.commit_lsn", F.lit(0).cast("decimal(20,0)")))
        .withColumn("ts_ms", F.coalesce("tx.ts_ms", F.lit(0).cast("bigint")))
        .drop("tx", "block")
    )


def oid_of_row() -> Column:
    return F.expr(wire.unsigned("data", "2", 4))


def versions_by_block(messages: DataFrame, versions: DataFrame, block: int) -> DataFrame:
    """The versions once for each block of positions in which messages ask for their oid: nearly always one.
    Tasks reduce the messages to their blocks before anything is shuffled, so an oid that all of them
    have is looked up once for a block and not once for a message."""
    place = block_of(F.col("seq"), block)
    asked = messages.select(F.col("session_id").alias("_session"), oid_of_row().alias("_oid"), place.alias("_block")).distinct()
    reaches = (F.col("valid_from") < (F.col("_block") + 1) * block) & (F.col("valid_to") > F.col("_block") * block)
    return asked.join(versions, ["_session", "_oid"]).filter(reaches)


def resolve_relation(
    rows: DataFrame, relations: DataFrame, small: bool, block: int = BLOCK, messages: DataFrame | None = None
) -> DataFrame:
    """Attach the relation that was the newest for the row's oid at that point of the session.
    The table column is NULL where the oid has never been announced. Relations that are not `small`
    are joined by block of positions as well, so that no oid is one key for all its messages;
    `messages` are the rows as they were read, if `rows` cost work."""
    versions = relations.select(
        F.col("session_id").alias("_session"),
        F.col("oid").alias("_oid"),
        F.col("namespace").alias("schema_name"),
        "table_name",
        F.col("columns.name").alias("names"),
        "valid_from",
        "valid_to",
    )
    rows = rows.withColumn("oid", oid_of_row())
    here = (F.col("session_id") == F.col("_session")) & (F.col("oid") == F.col("_oid"))
    if small:
        versions = F.broadcast(versions)
    else:
        rows = rows.withColumn("_block", block_of(F.col("seq"), block))
        versions = versions_by_block(rows if messages is None else messages, versions, block).withColumnRenamed("_block", "_in")
        here &= F.col("_block") == F.col("_in")
    return rows.join(
        versions, here & (F.col("seq") >= F.col("valid_from")) & (F.col("seq") < F.col("valid_to")), "left"
    ).drop("_session", "_oid", "_block", "_in", "valid_from", "valid_to")


def decode_rows(rows: DataFrame) -> DataFrame:
    """Tuple bytes -> before and after images; `error` set on cut messages and unknown oids.

    Insert: new tuple only. Update: optional old tuple (K or O), then the new one; without a new
    tuple the event stays with after = NULL. Delete: old tuple if the tag is K or O. The message
    itself is kept for bad rows only.
    """
    known = F.col("table_name").isNotNull()
    kind, tag = F.col("msg_type"), F.col("_tag")
    has_old = tag.isin("K", "O") & kind.isin("U", "D")
    has_new = (tag == "N") & kind.isin("I", "U")
    then_new = has_old & (kind == "U")

    ship(rows.sparkSession)
    # Not moved or repeated by the optimizer, so that a message is taken apart once. Its names are sent as one text.
    images = F.arrow_udf(tuples.named_images, tuples.IMAGES_DDL).asNondeterministic()
    ended = F.when(F.size("names") > 0, F.concat(F.array_join("names", "\0", ""), F.lit("\0")))
    rows = rows.withColumn("_tag", F.expr(wire.tag("data", "6")))
    rows = rows.withColumn("_images", images("data", ended, known & (has_old | has_new), then_new))
    rows = rows.withColumn("_one", F.col("_images.one")).withColumn("_two", F.col("_images.two"))

    length = F.octet_length("data")
    cut = (
        F.expr(wire.overrun("data", "_one.off"))
        | F.coalesce(F.expr(wire.overrun("data", "_two.off")), F.lit(False))
        | (then_new & (F.col("_one.off") > length))  # nothing left for the second tag
    )
    # The oid is looked up before the tag is read: an unknown oid wins over a missing tag.
    error = (
        F.when(length < 5, "row message cut short")
        .when(~known, "unknown relation")
        .when((length < 6) | cut, "row message cut short")
        .when((kind == "I") & (tag != "N"), "insert without new tuple")
    )
    after = F.when(has_new, F.col("_one.vals")).when(then_new, F.col("_two.vals"))
    rows = rows.withColumn("error", error)
    return rows.select(
        "session_id",
        "seq",
        "lsn",
        "msg_type",
        length.alias("msg_len"),
        "schema_name",
        "table_name",
        "commit_lsn",
        "ts_ms",
        F.when(has_old, F.col("_one.vals")).alias("before"),
        after.alias("after"),
        "error",
        F.when(F.col("error").isNotNull(), F.col("data")).alias("data"),
    )


def op_of_message() -> Column:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in OPS.items())
    return F.expr(f"case msg_type {cases} end")


def good_changes(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNull()).select(
        op_of_message().alias("op"),
        "schema_name",
        "table_name",
        "before",
        "after",
        "lsn",
        "commit_lsn",
        "ts_ms",
        "session_id",
        "seq",
    )


def dead_rows(rows: DataFrame) -> DataFrame:
    """Messages that could not be used, kept with the reason."""
    table = F.col("table_name") if "table_name" in rows.columns else F.lit(None).cast("string")
    length = F.col("msg_len") if "msg_len" in rows.columns else F.octet_length("data")
    return rows.filter(F.col("error").isNotNull()).select(
        "session_id",
        "seq",
        "lsn",
        "msg_type",
        length.alias("msg_len"),
        table.alias("table_name"),
        "error",
        "data",
    )


def decode_wal(
    raw: DataFrame,
    relations: DataFrame | None = None,
    transactions: DataFrame | None = None,
    block: int = BLOCK,
    fan_in: int = FAN_IN,
    broadcast_bytes: int = RELATION_BROADCAST_BYTES,
    folder: str | None = None,
    wanted: Callable[[Column], Column] | None = None,
    keep: bool = True,
    taken: int | None = None,
    relation_bytes: int | None = None,
) -> Decoded:
    """Decode a batch. `relations` and `transactions` are what earlier batches left open, `relation_bytes` their size
    if it is known. `wanted` says of a table name whether its rows are decoded at all. Messages up to the position
    `taken` are passed over.

    The decoded rows are kept in the shared folder, one folder per table: whoever needs the
    changes of one table reads only those, and nothing is decoded twice. With `folder` the
    intermediate data goes there, for the caller to remove. A caller that reads the rows once
    needs no copy of them: without `keep` they are decoded as they are read.
    """
    place = lambda name: f"{folder}/{name}" if folder else None
    seen = Observation()
    later = (lambda df: df) if taken is None else lambda df: df.filter(F.col("seq") > taken)
    begins, announced, found = decode_control(classify(later(counted(raw, seen, taken))), place("control"))
    size, behind = found["bytes"], seen.get.get("behind") or 0
    if behind:
        raw = later(raw)
    messages = classify(raw)
    versions = relation_versions(announced.filter(F.col("error").isNull()), relations)
    if relations is not None:
        size += relations.agg(held_bytes()).first()[0] or 0 if relation_bytes is None else relation_bytes
    small = size <= broadcast_bytes

    row_messages = messages.filter(F.col("msg_type").isin(*ROW_TYPES))
    stamped = carry_transactions(
        row_messages,
        begins.filter(F.col("error").isNull()),
        raw.select("session_id", "seq"),
        transactions,
        block,
        fan_in,
        place("ends"),
    )
    resolved = resolve_relation(stamped, versions, small, block, row_messages)
    if wanted is not None:
        resolved = resolved.filter(F.col("table_name").isNull() | wanted(F.col("table_name")))
    rows = decode_rows(resolved)
    if keep:
        rows = settle(rows, place("rows"), by="table_name")
    control_dead = dead_rows(begins).unionByName(dead_rows(announced))
    return Decoded(rows, control_dead, found["errors"], versions, _open_transactions(begins, transactions), behind)


def held_bytes() -> Column:
    """About what relations take that are carried over to the next batch."""
    return F.sum(RELATION_BYTES + F.size("columns") * RELATION_BYTES)


def _open_transactions(begins: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Newest context per session."""
    starts = begins.filter(F.col("error").isNull()).select(
        "session_id", "commit_lsn", "ts_ms", F.col("seq").alias("seen")
    )
    if earlier is not None:
        starts = starts.unionByName(earlier)
    newest = starts.groupBy("session_id").agg(F.max_by(F.struct("commit_lsn", "ts_ms", "seen"), "seen").alias("tx"))
    rows = newest.select("session_id", "tx.commit_lsn", "tx.ts_ms", "tx.seen")
    return rows.to(StructType.fromDDL(TX_DDL))
