"""Scalar functions F1-F12 over whole tables."""

from pyspark.sql import functions as F

from changeflow.functions import scalars as S
from changeflow.queries.changelog import PARTITIONS, base_events, read, source_texts
from changeflow.queries.registry import query

POSITION = "l_orderkey * 12345678901"
POSITION_TEXT = f"format('{{:X}}/{{:08X}}', ({POSITION}) >> 32, ({POSITION}) & 4294967295)"


def positions(spark, sf_dir):
    lsn = F.expr(POSITION).cast("decimal(20,0)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", lsn.alias("lsn"))


@query(
    "f01_lsn_to_int",
    f"select l_orderkey, l_linenumber, ({POSITION})::bigint as lsn from lineitem",
)
def lsn_to_int(spark, sf_dir):
    text = S.lsn_to_text(F.col("lsn"))
    return positions(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", S.lsn_to_int(text).cast("bigint").alias("lsn")
    )


@query(
    "f02_lsn_to_text",
    f"select l_orderkey, l_linenumber, {POSITION_TEXT} as lsn_text from lineitem",
)
def lsn_to_text(spark, sf_dir):
    return positions(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", S.lsn_to_text(F.col("lsn")).alias("lsn_text")
    )


@query(
    "f03_pg_micros_to_ms",
    "select event_id, epoch_us(ts) // 1000 as ts_ms from events",
)
def pg_micros_to_ms(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - S.PG_EPOCH_US
    return read(spark, sf_dir, "events").select(
        "event_id", S.pg_micros_to_ms(micros).alias("ts_ms")
    )


@query(
    "f04_ms_to_ntz",
    """select event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) as ts_ntz,
         strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y-%m-%d %H:%M:%S.%f') as ts_text
       from events""",
)
def ms_to_ntz(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").select(
        "event_id", S.ms_to_ntz(ms).alias("ts_ntz"), S.ms_to_text(ms).alias("ts_text")
    )


@query(
    "f05_upper_snake",
    r"""with names as (
          select p_partkey, split_part(p_name, ' ', 1) || upper(left(split_part(p_name, ' ', 2), 1))
            || substr(split_part(p_name, ' ', 2), 2) || p_type || 'HTTPServer2Id' as name from part)
        select p_partkey, upper(regexp_replace(name, '([a-z])([A-Z])', '\1_\2', 'g')) as target_name
        from names""",
)
def upper_snake(spark, sf_dir):
    words = F.split("p_name", " ")
    name = F.concat(words[0], F.initcap(words[1]), "p_type", F.lit("HTTPServer2Id"))
    return read(spark, sf_dir, "part").select(
        "p_partkey", S.upper_snake(name).alias("target_name")
    )


@query(
    "f06_root_table",
    f"""select event_id, case user_id % {PARTITIONS} when 0 then 'other_p0' when 1 then 'first' else 'events' end as table_name
        from events""",
)
def root_table(spark, sf_dir):
    """Two prefixes fit one partition: the first in the list wins."""
    part = (F.col("user_id") % PARTITIONS).cast("string")
    name = F.when(part == "0", "other_p0").otherwise(F.concat(F.lit("events_p"), part))
    prefixes = {"events_p1": "first", "events_": "events", "events_p2": "never"}
    return read(spark, sf_dir, "events").select("event_id", S.root_table(name, prefixes).alias("table_name"))


OP_SQL = "case event_type when 'signup' then 'c' when 'error' then 'd' when 'view' then 't' else 'u' end"


def _ops(spark, sf_dir):
    kind = F.col("event_type")
    op = F.when(kind == "signup", "c").when(kind == "error", "d").when(kind == "view", "t")
    return read(spark, sf_dir, "events").select("event_id", op.otherwise("u").alias("op"))


@query(
    "f07_op_label",
    f"""with o as (select event_id, {OP_SQL} as op from events)
        select event_id, case op when 'c' then 'I' when 'u' then 'U' when 'd' then 'D' else op end as label
        from o""",
)
def op_label(spark, sf_dir):
    return _ops(spark, sf_dir).select("event_id", S.op_label(F.col("op")).alias("label"))


@query(
    "f08_op_name",
    f"""with o as (select event_id, {OP_SQL} as op from events)
        select event_id, case op when 'c' then 'insert' when 'u' then 'update' when 'd' then 'delete' else op end as op_name
        from o""",
)
def op_name(spark, sf_dir):
    return _ops(spark, sf_dir).select("event_id", S.op_name(F.col("op")).alias("op_name"))


@query(
    "f09_variant",
    """select event_id, cast(json(props) as varchar) as props,
         cast(json_extract_string(props, '$.k') as integer) as k from events""",
)
def to_variant(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(
        "event_id", S.to_variant(F.col("props")).alias("v")
    )
    return rows.select(
        "event_id", F.to_json("v").alias("props"), F.variant_get("v", "$.k", "int").alias("k")
    )


@query(
    "f10_json_text",
    """select event_id, cast(to_json({'kind': event_type, 'value': case when event_type <> 'view' then value end,
         'ids': [event_id, user_id]}) as varchar) as doc, event_type as plain from events""",
)
def json_text(spark, sf_dir):
    value = F.when(F.col("event_type") != "view", F.col("value"))
    doc = F.struct(
        F.col("event_type").alias("kind"),
        value.alias("value"),
        F.array("event_id", "user_id").alias("ids"),
    )
    rows = read(spark, sf_dir, "events").withColumn("doc", doc)
    types = dict(rows.dtypes)
    return rows.select(
        "event_id",
        S.json_text(F.col("doc"), types["doc"]).alias("doc"),
        S.json_text(F.col("event_type"), types["event_type"]).alias("plain"),
    )


@query(
    "f11_cast_to_spec",
    """select event_id as seq, user_id, case when event_type <> 'view' then value end as value, ts,
         cast(null as double) as bad from events""",
)
def cast_to_spec(spark, sf_dir):
    texts = source_texts()
    return base_events(spark, sf_dir).select(
        "seq",
        S.cast_to_spec(texts["userId"], "bigint").alias("user_id"),
        S.cast_to_spec(texts["value"], "double").alias("value"),
        S.cast_to_spec(texts["ts"], "timestamp_ntz").alias("ts"),
        S.cast_to_spec(texts["eventType"], "double", strict=False).alias("bad"),
    )
