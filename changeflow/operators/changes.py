"""Operators over change events: routing, projection, typing, folding, history rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.scalars import (
    cast_to_spec_sql,
    ident,
    literal,
    ms_to_ntz,
    op_label,
    root_table,
)
from changeflow.schema import TableSpec, prefix_map

# Columns a folded change carries beside the data columns.
FOLD_COLUMNS = ("_OP", "_UNSET", "_COMMIT_LSN", "_LSN", "_SEQ", "_N", "_LOADED_AT")


def mapped_only(changes: DataFrame, specs: dict[str, TableSpec]) -> DataFrame:
    """Rename partitions to their parent table and keep the registered tables."""
    parent = root_table(F.col("table_name"), prefix_map(specs))
    return changes.withColumn("table_name", parent).filter(F.col("table_name").isin(*specs))


def upserts(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("op").isin("c", "u") & (F.size("after") > 0))


def deletes(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("op") == "d")


def image_values(rows: DataFrame, image: str, names: list[str], prefix: str) -> DataFrame:
    """One struct column `<prefix><name>` (kind, text, bin) per source column name, NULL where
    the image lacks it. Columns that come in the order of the names are taken by their places, so that a
    wide row is not searched for each; only an image in another order is. Only expressions that Spark
    compiles are used, no lambda, and few of them: the JVM compiles no method of more than 8,000 bytes."""
    order = ident(f"{prefix}order")
    in_place = f"slice({image}.name, 1, {len(names)}) = array({', '.join(map(literal, names))})"
    rows = rows.selectExpr("*", f"if({in_place}, null, {image}.name) as {order}")
    place = lambda k, n: f"cast(coalesce(array_position({order}, {literal(n)}) - 1, {k}) as int)"
    picked = [f"get({image}, {place(k, n)}) as {ident(prefix + n)}" for k, n in enumerate(names)]
    return rows.selectExpr("*", *picked).drop(f"{prefix}order")


def value_sql(value: str, type_name: str, strict: bool) -> str:
    """A value of an image (kind, text, bin) in the type of its target. A value sent in binary fits a
    binary target alone; for others it is bad: NULL, or an error in strict mode."""
    if type_name == "binary":
        return f"if({value}.kind = 'b', {value}.bin, cast({value}.text as binary))"
    text = cast_to_spec_sql(f"{value}.text", type_name, strict)
    return f"if({value}.kind = 'b', raise_error('binary value for a {type_name} column'), {text})" if strict else text


def project_row(
    changes: DataFrame, spec: TableSpec, image: str, strict: bool = True, old: str | None = None
) -> DataFrame:
    """The data columns of the target, typed, taken from one image; an unchanged value from the image
    `old`, where there is one that has it."""
    names = list(spec.columns)
    picked = image_values(changes, image, names, "_i_")
    value = {c: ident(f"_i_{c}") for c in names}
    if old:
        picked = image_values(picked, old, names, "_f_")
        taken = [f"if(coalesce({v}.kind = 'u', false), {ident(f'_f_{c}')}, {v}) as {ident(f'_p_{c}')}" for c, v in value.items()]
        picked, value = picked.selectExpr("*", *taken), {c: ident(f"_p_{c}") for c in names}
    typed = [f"{value_sql(value[c], t, strict)} as {ident(spec.targets[c])}" for c, t in spec.columns.items()]
    return picked.selectExpr(*map(ident, changes.columns), *typed)


def history_image(changes: DataFrame) -> DataFrame:
    """New row for inserts and updates, old row for deletes; events without it are left out."""
    row = F.when(F.col("op").isin("c", "u"), F.col("after")).otherwise(F.col("before"))
    return changes.withColumn("image", row).filter(F.col("image").isNotNull())


def align_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Exactly the columns of the target: missing ones as NULL, surplus ones dropped."""
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None).cast(t)).alias(c) for c, t in types.items()]
    )


def audit_columns(changes: DataFrame) -> DataFrame:
    return changes.withColumns(
        {
            "_CDC_OP": op_label(F.col("op")),
            "_CDC_LSN": F.col("lsn"),
            "_CDC_TS": ms_to_ntz(F.col("ts_ms")),
        }
    )


def now_utc() -> Column:
    return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")


def stamp_loaded(df: DataFrame, at: Column | None = None) -> DataFrame:
    return df.withColumn("_LOADED_AT", now_utc() if at is None else at.cast("timestamp_ntz"))


def pk_sample(df: DataFrame, pk: list[str], order: str, n: int = 10) -> DataFrame:
    """The first keys of a batch, to trace records."""
    return df.select(*pk, order).orderBy(order).limit(n)


def union_rows(frames: list[DataFrame]) -> DataFrame:
    """Stack batches; columns are matched by name, missing ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row that comes first in `order` for each key. Spark keeps one row per key in every
    task before the shuffle, so a hot key moves one row per task."""
    # Rows equal in `order` are told apart by what they hold, so that every run keeps the same one.
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("variant", "map")]
    window = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*[F.col(ident(c)) for c in plain]))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedup_history(history: DataFrame, keys: tuple[str, ...] = ("_CDC_LSN",)) -> DataFrame:
    """First loaded row per key."""
    return latest_per_key(history, list(keys), [F.col("_LOADED_AT").asc()])


def typed_changes(changes: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """Events of one table as rows to apply: data columns, `_OP` (U or D), order and `_UNSET`.

    A value marked unchanged is taken from the old row when the event has it, otherwise its
    column goes to `_UNSET`. An update that moves the key also deletes the old key, and its row
    names that key in `_FROM`. Rows keep `_BAD`, the names of the columns whose text could not be
    cast (never in strict mode).
    """
    columns, target = list(spec.columns), spec.targets
    rows = image_values(changes, "after", columns, "_a_")
    rows = image_values(rows, "before", columns, "_b_")

    new = {c: ident(f"_v_{c}") for c in columns}
    old = {c: f"{ident(f'_b_{c}')}.text" for c in spec.pk}
    unchanged = {c: f"coalesce({ident(f'_a_{c}')}.kind = 'u', false)" for c in columns}
    typed = {c: ident(f"_t_{c}") for c in columns}
    typed_old = {c: ident(f"_o_{c}") for c in spec.pk}
    texts = [f"if({unchanged[c]}, {ident(f'_b_{c}')}, {ident(f'_a_{c}')}) as {new[c]}" for c in columns]
    casts = [f"{value_sql(new[c], t, strict)} as {typed[c]}" for c, t in spec.columns.items()]
    given = {c: f"({new[c]}.text is not null or {new[c]}.bin is not null)" for c in columns}
    casts += [
        f"{cast_to_spec_sql(old[c], spec.columns[c], strict)} as {typed_old[c]}" for c in spec.pk
    ]
    rows = rows.selectExpr("*", *texts).selectExpr("*", *casts)

    def names_where(conditions: dict[str, str]) -> str:
        # Most rows have none: for them no lists are made.
        none = "cast(array() as array<string>)"
        hits = [f"if({w}, {literal(target[c])}, null)" for c, w in conditions.items()]
        any_ = " or ".join(f"({w})" for w in conditions.values())
        return f"if({any_}, array_compact(array({', '.join(hits)})), {none})"

    old_key = ", ".join(f"{typed_old[c]} as {ident(target[c])}" for c in spec.pk)
    has_old_key = " and ".join(f"{old[c]} is not null" for c in spec.pk)
    same_key = " and ".join(f"{old[c]} = {new[c]}.text" for c in spec.pk)
    moved = f"op = 'u' and {has_old_key} and not ({same_key})"

    def row(op: str, tick: int, values: dict[str, str], unset: str, bad: str, moves: str) -> str:
        data = ", ".join(f"{values[c]} as {ident(target[c])}" for c in columns)
        return f"""struct({data}, '{op}' as _OP, {unset} as _UNSET, commit_lsn as _COMMIT_LSN,
            lsn as _LSN, seq * 2 + {tick} as _SEQ, {bad} as _BAD, if({moves}, struct({old_key}), null) as _FROM)"""

    upsert = row(
        "U",
        1,
        typed,
        names_where({c: f"{unchanged[c]} and not {given[c]}" for c in columns}),
        names_where({c: f"{given[c]} and {typed[c]} is null" for c in columns}),
        moved,
    )
    delete = row(
        "D",
        0,
        {c: typed_old.get(c, f"cast(null as {t})") for c, t in spec.columns.items()},
        "cast(array() as array<string>)",
        names_where({c: f"{old[c]} is not null and {typed_old[c]} is null" for c in spec.pk}),
        "false",
    )
    is_upsert = "op in ('c', 'u') and size(after) > 0"
    applied = f"""array(
        if(op = 'd' or ({is_upsert} and {moved}), {delete}, null),
        if({is_upsert}, {upsert}, null))"""
    return rows.selectExpr("session_id", "seq", f"inline({applied})").filter("_OP is not null")


def _broken(spec: TableSpec, known: str = "true") -> list[tuple[str, str]]:
    """Conditions a row must not meet, with their reasons: a key or NOT NULL column is NULL. `known`
    is where a NULL is a value and not an unchanged one."""
    key = " or ".join(f"{ident(c)} is null" for c in spec.pk_targets)
    rest = [spec.targets[c] for c in spec.not_null if c not in spec.pk]
    return [(key, "key is null")] + [(f"{ident(c)} is null and {known.format(literal(c))}", f"null in {c}") for c in rest]


def _reason(broken: list[tuple[str, str]]) -> str:
    return "case " + " ".join(f"when {w} then {literal(r)}" for w, r in broken) + " end"


def with_reason(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with `error`, which of the table's rules they break; NULL for those that break none."""
    return rows.withColumn("error", F.expr(_reason(_broken(spec))))


def _change_reason(spec: TableSpec) -> str:
    # A delete needs its key alone; an unchanged value is not NULL.
    return _reason(
        [("size(_BAD) > 0", "bad value"), *_broken(spec, "_OP <> 'D' and not array_contains(_UNSET, {})")]
    )


def unusable(spec: TableSpec) -> Column:
    """True for typed rows that cannot be applied: bad text, no key, or NULL where there must be none."""
    return F.expr(f"({_change_reason(spec)}) is not null")


def split_bad(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows that cannot be applied with the reason."""
    lost = F.concat(F.lit("bad value in "), F.array_join("_BAD", ","))
    reason = F.when(F.size("_BAD") > 0, lost).otherwise(F.expr(_change_reason(spec)))
    bad = rows.filter(unusable(spec)).withColumn("error", reason)
    good = rows.filter(~unusable(spec)).drop("_BAD", "session_id", "seq")
    return good, bad


def fold_changes(rows: DataFrame, keys: list[str], order: str = "_SEQ") -> DataFrame:
    """One row per key: the last operation, and for each column the last value known.

    An unchanged value does not hide the earlier value of the column; a delete makes every
    earlier value unknown again, as NULL. Aggregation starts in each task, so a hot key moves
    one partial row per task.
    """
    rows = rows.drop("_FROM")
    meta = [c for c in rows.columns if c in FOLD_COLUMNS]
    data = [c for c in rows.columns if c not in FOLD_COLUMNS and c not in keys]

    def last_known(c: str) -> str:
        # A deleted row has NULL in every data column already.
        known = f"_OP = 'D' or not array_contains(_UNSET, {literal(c)})"
        return f"max_by(struct({ident(c)}), if({known}, {order}, null)) as {ident(c)}"

    last = f"max_by(struct({', '.join(meta)}), {order}) as _last"
    folded = rows.groupBy(*keys).agg(F.expr(last), *[F.expr(last_known(c)) for c in data])
    unknown = ", ".join(f"if({ident(c)} is null, {literal(c)}, null)" for c in data)
    unset = f"array_compact(cast(array({unknown}) as array<string>))"
    return folded.selectExpr(
        *map(ident, keys),
        *[f"{ident(c)}.{ident(c)} as {ident(c)}" for c in data],
        *[f"{unset if c == '_UNSET' else f'_last.{c}'} as {c}" for c in meta],
    )


def history_rows(changes: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """History rows of one table, without the load time."""
    rows = audit_columns(project_row(history_image(changes), spec, "image", strict, old="before"))
    types = spec.target_types | {
        "_CDC_OP": "string",
        "_CDC_LSN": "decimal(20,0)",
        "_CDC_TS": "timestamp_ntz",
    }
    return align_columns(rows, types)
