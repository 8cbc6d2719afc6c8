"""Snapshot rows of a source table, typed for its target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.scalars import cast_to_spec, json_text
from changeflow.schema import TableSpec


def typed_snapshot(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Target names and types. Nested values become JSON first; a column the source lacks is
    NULL, one the target lacks is dropped."""
    have = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = []
    for c, target_type in spec.columns.items():
        if c not in have:
            value = F.lit(None).cast(target_type)
        elif have[c] == target_type:
            value = F.col(c)
        else:
            value = cast_to_spec(json_text(F.col(c), have[c]), target_type)
        out.append(value.alias(spec.targets[c]))
    return rows.select(*out)


def dead_snapshot(bad: DataFrame, spec: TableSpec) -> DataFrame:
    """Snapshot rows that cannot be in the table (with `error`) as dead letters: the row as JSON."""
    none = F.lit(None)
    data = F.encode(F.to_json(F.struct(*spec.target_types)), "UTF-8")
    return bad.select(
        none.cast("bigint").alias("session_id"),
        none.cast("bigint").alias("seq"),
        none.cast("decimal(20,0)").alias("lsn"),
        none.cast("string").alias("msg_type"),
        F.octet_length(data).alias("msg_len"),
        F.lit(spec.source).alias("table_name"),
        "error",
        data.alias("data"),
    )
