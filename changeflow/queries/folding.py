"""Projections P1-P9, folding W1-W2, merge J1-J2, K1-K3 and the flagship over the change log."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeflow.operators import changes as C
from changeflow.operators import merge as M
from changeflow.operators.moves import fill_moved, fold_moved
from changeflow.queries.changelog import (
    EVENTS,
    MAPPED,
    SPECS,
    TX_EVENTS,
    changelog,
    read,
)
from changeflow.queries.decoding import KEY_ONLY, TYPED, typed_columns
from changeflow.queries.registry import query

LOADED_AT = "2024-02-01 00:00:00"
KEYS = EVENTS.pk_targets
HISTORY_SQL = """case when op = 'd' then null else event_type end as EVENT_TYPE,
  case when op = 'd' then null else value end as VALUE,
  case when op = 'd' then null else props end as PROPS,
  case when op = 'd' then null else ts end as TS,
  case op when 'c' then 'I' when 'u' then 'U' else 'D' end as _CDC_OP,
  lsn as _CDC_LSN, make_timestamp(ts_ms * 1000) as _CDC_TS"""
LATEST = "qualify row_number() over (partition by user_id order by seq desc) = 1"
STATE_SQL = f"""with {MAPPED}, latest as (select * from mapped {LATEST})
  select {TYPED} from latest where op <> 'd'"""


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def mapped(spark, sf_dir):
    return C.mapped_only(changelog(spark, sf_dir), SPECS)


def folded(spark, sf_dir):
    good, _ = C.split_bad(C.typed_changes(mapped(spark, sf_dir), EVENTS), EVENTS)
    return C.fold_changes(good, KEYS)


def current_state(spark, sf_dir):
    """The state of the table after the whole change log."""
    rows = C.stamp_loaded(folded(spark, sf_dir), loaded_at())
    return M.first_state(rows, list(EVENTS.target_types)).select(*typed_columns())


query("current_state", STATE_SQL)(current_state)


@query("p01_mapped_only", f"with {MAPPED} select seq, table_name from mapped")
def mapped_only(spark, sf_dir):
    return mapped(spark, sf_dir).select("seq", "table_name")


@query("p02_project_row", f"with {MAPPED} select seq, {TYPED} from mapped where op <> 'd'")
def project_row(spark, sf_dir):
    rows = C.upserts(mapped(spark, sf_dir))
    return C.project_row(rows, EVENTS, "after").select("seq", *typed_columns())


@query("p03_upserts", f"with {MAPPED} select seq, op from mapped where op in ('c', 'u')")
def upserts(spark, sf_dir):
    return C.upserts(mapped(spark, sf_dir)).select("seq", "op")


@query("p04_deletes", f"with {MAPPED} select seq, user_id as USER_ID from mapped where op = 'd'")
def deletes(spark, sf_dir):
    rows = C.deletes(mapped(spark, sf_dir))
    return C.project_row(rows, EVENTS, "before").select("seq", "USER_ID")


@query(
    "p05_history_image",
    f"""with {MAPPED} select seq, user_id as USER_ID,
          case when op <> 'd' then event_type end as EVENT_TYPE from mapped""",
)
def history_image(spark, sf_dir):
    rows = C.history_image(mapped(spark, sf_dir))
    return C.project_row(rows, EVENTS, "image").select("seq", "USER_ID", "EVENT_TYPE")


@query(
    "p06_align_columns",
    "select event_id as EVENT_ID, value as VALUE, cast(null as varchar) as LABEL from events",
)
def align_columns(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    rows = rows.toDF(*[c.upper() for c in rows.columns])
    return C.align_columns(rows, {"EVENT_ID": "bigint", "VALUE": "double", "LABEL": "string"})


@query(
    "p07_audit_columns",
    f"""with {MAPPED} select seq, case op when 'c' then 'I' when 'u' then 'U' else 'D' end as _CDC_OP,
          lsn as _CDC_LSN, make_timestamp(ts_ms * 1000) as _CDC_TS from mapped""",
)
def audit_columns(spark, sf_dir):
    rows = C.audit_columns(mapped(spark, sf_dir))
    return rows.select("seq", "_CDC_OP", F.col("_CDC_LSN").cast("bigint").alias("_CDC_LSN"), "_CDC_TS")


@query(
    "p08_stamp_loaded",
    f"with {MAPPED} select seq, timestamp '{LOADED_AT}' as _LOADED_AT from mapped",
)
def stamp_loaded(spark, sf_dir):
    return C.stamp_loaded(mapped(spark, sf_dir).select("seq"), loaded_at())


@query(
    "p09_pk_sample",
    f"with {MAPPED} select user_id as USER_ID, seq from mapped where op <> 'd' order by seq limit 10",
)
def pk_sample(spark, sf_dir):
    rows = C.project_row(C.upserts(mapped(spark, sf_dir)), EVENTS, "after")
    return C.pk_sample(rows, KEYS, "seq")


@query(
    "u01_union_rows",
    f"""with {MAPPED} select seq, op, user_id as USER_ID,
          case when op <> 'd' then event_type end as EVENT_TYPE from mapped""",
)
def union_rows(spark, sf_dir):
    rows = mapped(spark, sf_dir)
    new = C.project_row(C.upserts(rows), EVENTS, "after").select("seq", "op", "USER_ID", "EVENT_TYPE")
    old = C.project_row(C.deletes(rows), EVENTS, "before").select("seq", "op", "USER_ID")
    return C.union_rows([new, old])


@query(
    "w01_latest_per_key",
    f"with {MAPPED} select seq, op, user_id, event_type from mapped {LATEST}",
)
def latest_per_key(spark, sf_dir):
    rows = C.project_row(C.history_image(mapped(spark, sf_dir)), EVENTS, "image")
    latest = C.latest_per_key(rows, KEYS, [F.col("seq").desc()])
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "event_type")
    return latest.select("seq", "op", F.col("USER_ID").alias("user_id")).join(events, "seq")


def history(spark, sf_dir):
    return C.stamp_loaded(C.history_rows(mapped(spark, sf_dir), EVENTS), loaded_at())


def show_history(rows):
    return rows.select(
        *typed_columns(),
        "_CDC_OP",
        F.col("_CDC_LSN").cast("bigint").alias("_CDC_LSN"),
        "_CDC_TS",
        "_LOADED_AT",
    )


HISTORY_QUERY = f"""with {MAPPED} select user_id as USER_ID, {HISTORY_SQL},
  timestamp '{LOADED_AT}' as _LOADED_AT from mapped"""


@query("w02_dedup_history", HISTORY_QUERY)
def dedup_history(spark, sf_dir):
    first = history(spark, sf_dir)
    again = first.filter("_CDC_OP <> 'U'").withColumn(
        "_LOADED_AT", F.timestamp_add("HOUR", F.lit(1), F.col("_LOADED_AT"))
    )
    return show_history(C.dedup_history(first.unionByName(again)))


# Merge: the suppliers are the target, keyed like the users of the change log.

TARGET_SQL = """target as (select s_suppkey as user_id, s_name as event_type, s_acctbal as value,
  cast(null as varchar) as props, cast(null as timestamp) as ts from supplier)"""
MERGE_SQL = f"""with {MAPPED}, {TARGET_SQL}, net as (select * from mapped {LATEST})
  select {TYPED} from target where user_id not in (select user_id from net)
  union all select {TYPED} from net where op <> 'd'"""


def merge_target(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("USER_ID"),
        F.col("s_name").alias("EVENT_TYPE"),
        F.col("s_acctbal").alias("VALUE"),
        F.parse_json(F.lit(None).cast("string")).alias("PROPS"),
        F.lit(None).cast("timestamp_ntz").alias("TS"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("_LOADED_AT"),
    )


def net_changes(spark, sf_dir):
    return C.stamp_loaded(folded(spark, sf_dir), loaded_at())


@query("k01_apply_changes", MERGE_SQL)
def apply_changes(spark, sf_dir):
    target, net = merge_target(spark, sf_dir), net_changes(spark, sf_dir)
    return M.apply_changes(target, net, KEYS).select(*typed_columns())


@query("k01_apply_small_changes", MERGE_SQL)
def apply_small_changes(spark, sf_dir):
    target, net = merge_target(spark, sf_dir), net_changes(spark, sf_dir)
    return M.apply_changes(target, net, KEYS, small=True).select(*typed_columns())


@query(
    "k02_delete_by_key",
    f"""with {MAPPED} select c_custkey as USER_ID, c_name from customer
        where c_custkey not in (select user_id from mapped where op = 'd')""",
)
def delete_by_key(spark, sf_dir):
    """Customers that no delete of the log names."""
    gone = C.project_row(C.deletes(mapped(spark, sf_dir)), EVENTS, "before")
    customers = read(spark, sf_dir, "customer")
    target = customers.select(F.col("c_custkey").alias("USER_ID"), "c_name")
    return M.delete_by_key(target, gone, KEYS)


@query("k03_append_history", HISTORY_QUERY)
def append_history(spark, sf_dir):
    return show_history(history(spark, sf_dir))


@query(
    "j01_merge_join",
    f"""with {MAPPED}, {TARGET_SQL}, net as (select * from mapped {LATEST})
        select coalesce(t.user_id, n.user_id) as USER_ID, t.user_id is not null as in_target,
          n.user_id is not null as in_source from target t full join net n on t.user_id = n.user_id""",
)
def merge_join(spark, sf_dir):
    joined = M.merge_join(merge_target(spark, sf_dir), net_changes(spark, sf_dir), KEYS)
    return joined.select(
        "USER_ID",
        F.col("_t").isNotNull().alias("in_target"),
        F.col("_s").isNotNull().alias("in_source"),
    )


@query(
    "j02_delete_anti",
    """select o_orderkey, o_totalprice from orders
       where o_orderkey not in (select l_orderkey from lineitem)""",
)
def delete_anti(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    keys = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.delete_anti(orders, keys, ["o_orderkey"])


@query("w02_dedup_composite", HISTORY_QUERY)
def dedup_composite(spark, sf_dir):
    """Repair by the key, the position and the operation: updates have been loaded twice."""
    first = history(spark, sf_dir)
    again = first.filter("_CDC_OP = 'U'").withColumn("_LOADED_AT", F.timestamp_add("HOUR", F.lit(1), F.col("_LOADED_AT")))
    return show_history(C.dedup_history(first.unionByName(again), (*KEYS, "_CDC_LSN", "_CDC_OP")))


def imaged(rows, image, wanted, change):
    """The rows with one image changed where `wanted` holds."""
    return rows.withColumn(image, F.when(wanted, change(F.col(image))).otherwise(F.col(image)))


def value_of(image, name):
    return F.filter(image, lambda v: v["name"] == name)[0]["text"]


@query(
    "k01_unchanged_values",
    f"""with {MAPPED}, latest as (select * from mapped {LATEST}),
          gone as (select user_id, max(seq) as del from mapped where op = 'd' group by user_id),
          known as (select user_id, arg_max(props, seq) as props from mapped left join gone using (user_id)
            where op <> 'd' and event_type <> 'click' and seq > coalesce(del, -1) group by user_id)
        select {TYPED.replace("props as", "known.props as")} from latest left join known using (user_id) where op <> 'd'""",
)
def unchanged_values(spark, sf_dir):
    """Clicks are updates that leave `props` out as unchanged: it keeps the value it had."""
    rows = mapped(spark, sf_dir)
    click = (F.col("op") == "u") & (value_of(F.col("after"), "eventType") == "click")
    left_out = lambda v: F.when(v["name"] == "props", v.withField("kind", F.lit("u")).withField("text", F.lit(None).cast("string"))).otherwise(v)
    rows = imaged(rows, "after", click, lambda image: F.transform(image, left_out))
    good, _ = C.split_bad(C.typed_changes(rows, EVENTS), EVENTS)
    state = C.stamp_loaded(C.fold_changes(good, KEYS), loaded_at())
    return M.first_state(state, list(EVENTS.target_types)).select(*typed_columns())


MOVED = 1_000_000_000


@query(
    "k01_moved_key",
    f"""with {MAPPED}, steps as (
          select * replace (case when op = 'u' and event_type = 'purchase' then user_id + {MOVED} else user_id end as user_id),
            seq * 2 + 1 as step, op <> 'd' as there from mapped
          union all select *, seq * 2, false from mapped where op = 'u' and event_type = 'purchase')
        select {TYPED} from steps qualify row_number() over (partition by user_id order by step desc) = 1 and there""",
)
def moved_key(spark, sf_dir):
    """Purchases move the key of their row: the old key is gone, the new one is there."""
    rows = mapped(spark, sf_dir)
    moves = (F.col("op") == "u") & (value_of(F.col("after"), "eventType") == "purchase")
    old = F.filter("after", lambda v: v["name"] == "userId")
    rows = rows.withColumn("before", F.when(moves, old).otherwise(F.col("before")))
    further = lambda v: F.when(
        v["name"] == "userId", v.withField("text", (v["text"].cast("bigint") + MOVED).cast("string"))
    ).otherwise(v)
    rows = imaged(rows, "after", moves, lambda image: F.transform(image, further))
    good, _ = C.split_bad(C.typed_changes(rows, EVENTS), EVENTS)
    state = C.stamp_loaded(C.fold_changes(good, KEYS), loaded_at())
    return M.first_state(state, list(EVENTS.target_types)).select(*typed_columns())


def chained(spark, sf_dir):
    """Each purchase of a user moves the key of the user's row further; purchases and clicks leave `value`
    out as unchanged."""
    rows = mapped(spark, sf_dir)
    events = read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type")
    rows = rows.join(events, "seq")
    purchase = (F.col("op") == "u") & (F.col("event_type") == "purchase")
    rows = rows.withColumn("moves", F.count_if(purchase).over(Window.partitionBy("user_id").orderBy("seq")))
    key_at = lambda moves: F.array(F.struct(
        F.lit("userId").alias("name"), F.lit("t").alias("kind"),
        (F.col("user_id") + moves * MOVED).cast("string").alias("text"), F.lit(None).cast("binary").alias("bin"),
    ))
    before = F.when(purchase, key_at(F.col("moves") - 1)).when(F.col("op") == "d", key_at(F.col("moves")))
    left_out = lambda v: F.when(v["name"] == "value", v.withField("kind", F.lit("u")).withField("text", F.lit(None).cast("string"))).otherwise(v)
    others = F.filter("after", lambda v: v["name"] != "userId")
    others = F.when(F.col("event_type").isin("purchase", "click"), F.transform(others, left_out)).otherwise(others)
    after = F.when(F.col("op") != "d", F.concat(key_at(F.col("moves")), others))
    rows = rows.withColumn("before", before).withColumn("after", after).drop("user_id", "event_type", "moves")
    return C.split_bad(C.typed_changes(rows, EVENTS), EVENTS)[0]


@query(
    "k01_moved_unchanged",
    f"""with {MAPPED}, {TARGET_SQL}, latest as (
          select *, count(*) filter (op = 'u' and event_type = 'purchase') over (partition by user_id order by seq) as moves
          from mapped {LATEST}
        ), gone as (select user_id, max(seq) as del from mapped where op = 'd' group by user_id),
        known as (select user_id, mapped.value from mapped left join gone using (user_id)
          where op <> 'd' and event_type not in ('purchase', 'click') and seq > coalesce(del, -1) {LATEST}),
        state as (
          select l.* replace (l.user_id + l.moves * {MOVED} as user_id,
            case when k.user_id is not null then k.value when g.user_id is null then t.value end as value)
          from latest l left join known k using (user_id) left join gone g using (user_id) left join target t using (user_id)
          where op <> 'd')
        select {TYPED} from state
        union all select {TYPED} from target where user_id not in (select user_id from mapped)""",
)
def moved_unchanged(spark, sf_dir):
    """Chains of moves in one batch: a value that no event of the chain has is the old row's, under its first key."""
    target, keys = merge_target(spark, sf_dir), KEYS
    net = C.stamp_loaded(fill_moved(target, fold_moved(chained(spark, sf_dir), keys), keys), loaded_at())
    return M.apply_changes(target, net, keys).select(*typed_columns())
