"""Applying folded changes to a current-state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def merge_join(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on the whole key: structs `_t` and `_s`, either one NULL when the row
    has no partner. NULL keys never match."""
    t = target.select(*keys, F.struct(*target.columns).alias("_t"))
    s = source.select(*keys, F.struct(*source.columns).alias("_s"))
    return t.join(s, keys, "full_outer")


def delete_anti(target: DataFrame, keys_to_drop: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the target whose key is not listed."""
    return target.join(keys_to_drop.select(*keys), keys, "left_anti")


def delete_by_key(target: DataFrame, deleted: DataFrame, keys: list[str]) -> DataFrame:
    return delete_anti(target, deleted, keys)


def _resolved(c: str, old: Column, new: Column, unset: Column) -> Column:
    return F.when(F.array_contains(unset, c), old).otherwise(new).alias(c)


def _upsert_columns(columns: list[str], keys: list[str]) -> list[Column]:
    """The new row: keys, values (unset ones from the old row) and load time of the change."""
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c == "_LOADED_AT":
            out.append(F.col("_s")[c].alias(c))
        else:
            out.append(_resolved(c, F.col("_t")[c], F.col("_s")[c], F.col("_s._UNSET")))
    return out


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: list[str], small: bool = False
) -> DataFrame:
    """Target after the changes (one folded row per key with its load time, see `fold_changes`).

    Matched rows are replaced or, for `_OP` = D, dropped; unmatched upserts are inserted. With
    `small` (the caller has checked the size of the changes) the changed keys are broadcast and
    the target is neither shuffled nor sorted; otherwise one full outer join does it.
    """
    columns = target.columns
    if small:
        touched = F.broadcast(changes.select(*keys))
        untouched = target.join(touched, keys, "left_anti")
        # At most one old row per change is needed, for the values the change leaves open.
        old = target.join(touched, keys, "left_semi").select(*keys, F.struct(*columns).alias("_t"))
        live = changes.filter("_OP <> 'D'").select(*keys, F.struct(*changes.columns).alias("_s"))
        new = live.join(old, keys, "left").select(*_upsert_columns(columns, keys))
        return untouched.unionByName(new)
    joined = merge_join(target, changes, keys).filter("_s is null or _s._OP <> 'D'")
    kept = F.col("_s").isNull()
    rows = []
    for c, new in zip(columns, _upsert_columns(columns, keys)):
        rows.append(new if c in keys else F.when(kept, F.col("_t")[c]).otherwise(new).alias(c))
    return joined.select(*rows)


def first_state(changes: DataFrame, columns: list[str]) -> DataFrame:
    """State of an empty table after the changes."""
    return changes.filter("_OP <> 'D'").select(*columns)
