"""Table definitions and file layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schema import TableSpec


def create_tables(spark: SparkSession, specs: dict[str, TableSpec], folder: str) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the current and the history table of every spec."""
    names = []
    for spec in specs.values():
        for name, ddl in ((spec.current, spec.current_ddl()), (spec.history, spec.history_ddl())):
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
                f"LOCATION '{folder.rstrip('/')}/{name}'"
            )
            names.append(name)
    return names


def violates_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that break a NOT NULL rule (Parquet tables do not enforce it)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))


def clustered_layout(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Rows in ranges of the keys, sorted inside each file, so that a scan skips row groups by
    their minimum and maximum. A hash of the row is the last range key: the rows of one hot key
    are spread over several files instead of one task."""
    plain = [
        f.name for f in df.schema if f.dataType.typeName() not in ("variant", "map")
    ]
    ranges = [*[F.col(k) for k in keys], F.xxhash64(*plain)]
    ranged = df.repartitionByRange(parts, *ranges) if parts else df.repartitionByRange(*ranges)
    return ranged.sortWithinPartitions(*keys)
