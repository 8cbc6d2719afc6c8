"""Run a registered query and its SQL, and compare columns, types and rows."""

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"},
    "TIMESTAMP": {"timestamp_ntz"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return v


def compare(spark, sf_dir, query, con):
    """Returns the list of differences."""
    df = query.run(spark, sf_dir)
    rel = con.sql(query.sql)
    ours = dict(df.dtypes)
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    found = []
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} / {sorted(theirs)}"]
    for c, t in ours.items():
        if t not in TYPES.get(theirs[c], {theirs[c]}):
            found.append(f"type of {c}: {t} / {theirs[c]}")
    names = sorted(ours)
    a = Counter(tuple(_cell(r[c]) for c in names) for r in df.collect())
    order = [rel.columns.index(c) for c in names]
    b = Counter(tuple(_cell(r[i]) for i in order) for r in rel.fetchall())
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        found.append(f"{sum(a.values())} / {sum(b.values())} rows; only ours {only_a}; only SQL {only_b}")
    if not a:
        found.append("no rows")
    return found
