"""Session settings and the shared folder for intermediate data."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import changeflow

T = TypeVar("T")

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int = 8, name: str = "changeflow", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Small shuffles keep a task per core: decoding is work for the processor, not the disk.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. Only a local session may fall back on a folder
    of this machine."""
    sc = spark.sparkContext
    folder = sc.getConf().get(CHECKPOINT_DIR) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="changeflow-"))
        folder = sc.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def settle(
    df: DataFrame, folder: str | None = None, by: str | None = None, seen: Observation | None = None,
    totals: list[Column] | None = None,
) -> DataFrame:
    """Cut the lineage: compute once, keep the rows in the shared folder as Parquet, if wanted
    in one folder per value of a column. With `folder` they go there, for the caller to remove.
    `seen` receives `totals` while the rows are written."""
    path = folder or scratch_path(df.sparkSession, "settled")
    writer = (df.observe(seen, *totals) if seen else df).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    return kept.select(*df.columns)


def tasks_for(spark: SparkSession, rows: int, most: int = 200_000, least: int = 10_000) -> int:
    """Partitions for a step that costs much for each row: two for each core, with no less than `least` and, where
    there are many rows, no more than `most` in each. Sized by the bytes of the shuffle there would be about one for
    each core, and a few beyond that make all wait for a second turn."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // most), min(2 * cores, rows // least))


def spread(df: DataFrame) -> DataFrame:
    """Rows that are read, in tasks of like size where a few would have most of them: a row group of a Parquet file is
    read by one task, however many rows it has."""
    sizes = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"))
    rows, largest = sizes.agg(F.sum("rows"), F.max("rows")).first()
    spark = df.sparkSession
    if not rows or largest <= 2 * rows / spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(tasks_for(spark, rows), *df.columns)


def one_line(spark: SparkSession, text: str) -> DataFrame:
    """A single line of text, for records written next to the data."""
    return spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))


def run_together(actions: list[Callable[[], T]], at_once: int = 8) -> list[T]:
    """Run independent Spark actions from a few threads; the cluster shares its cores between
    their jobs. The first failure is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda action: action(), actions))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers through Spark, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(changeflow.__file__)
    path = os.path.join(tempfile.mkdtemp(prefix="changeflow-"), "changeflow.zip")
    with zipfile.ZipFile(path, "w") as package:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.join("changeflow", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
