"""Sources: landed log messages, snapshot ranges, pages and deltas."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schema import RAW_WAL


def wal_scan(spark: SparkSession, path: str) -> DataFrame:
    """Landed log messages as a batch."""
    return spark.read.schema(RAW_WAL).parquet(path)


def wal_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Landed log messages as a stream, so many files or bytes of files per batch (one file at least)."""
    reader = spark.readStream.schema(RAW_WAL)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


@dataclass(frozen=True)
class Source:
    """Where the rows of a table come from: a Spark format with its options."""

    path: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)


def key_range(key: str, low: int | None, high: int | None) -> Column:
    """Half-open range; one without a lower end also has the rows without key, so that ranges side by side
    cover every row once. Ends beyond a bigint are decimals."""
    c = F.col(key)
    low, high = (end if end is None or abs(end) < 1 << 63 else Decimal(end) for end in (low, high))
    if low is None:
        return F.lit(True) if high is None else (c < high) | c.isNull()
    return c >= low if high is None else (c >= low) & (c < high)


def open_source(spark: SparkSession, src: Source | DataFrame) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    reader = spark.read.format(src.format).options(**src.options)
    return reader.load(src.path) if src.path else reader.load()


def snapshot_scan(
    spark: SparkSession,
    src: Source | DataFrame,
    key: str,
    low: int | None,
    high: int | None,
    parts: int = 8,
) -> DataFrame:
    """Rows of one key range. A JDBC source is read by `parts` parallel range queries; with
    files the range reaches the scan as a pushed filter."""
    if isinstance(src, Source) and src.format == "jdbc" and None not in (low, high):
        bounds = {
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
        src = Source(src.path, src.format, src.options | bounds)
    return open_source(spark, src).filter(key_range(key, low, high))


def keyset_page(df: DataFrame, key: str, after: int, n: int) -> DataFrame:
    """The next `n` rows after a key, in key order."""
    return df.filter(F.col(key) > after).orderBy(key).limit(n)


def delta_scan(df: DataFrame, since: str | Column, ts_col: str = "updated_at") -> DataFrame:
    """Rows touched since a time; the comparison is pushed down to the source."""
    if ts_col not in df.columns:
        raise ValueError(f"the source has no column {ts_col}: a delta cannot be read from it")
    if isinstance(since, str):
        since = F.lit(since).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) >= since)


def table_list(text: str) -> list[str]:
    """'a, b,,c' -> ['a', 'b', 'c']"""
    return [name for name in (part.strip() for part in text.split(",")) if name]


def select_tables(df: DataFrame, tables: str | list[str], column: str = "table_name") -> DataFrame:
    """Rows of the configured tables."""
    names = table_list(tables) if isinstance(tables, str) else tables
    return df.filter(F.col(column).isin(names))
