"""The landing folder of the registered queries: written in few jobs, however many files land."""

import os
import pathlib
import uuid

import pytest
from pyspark.sql import functions as F

from changeflow.queries import changelog as C
from changeflow.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


def files_of(folder):
    return sorted(pathlib.Path(folder.removeprefix("file:")).glob("part-*.parquet"))


def jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        found = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_files(spark, monkeypatch):
    jobs = []
    for positions in (250_000, 1_000):
        monkeypatch.setattr(C, "FILE_POSITIONS", positions)
        (folder, per_batch), n = jobs_of(spark, lambda: C.landed_wal(spark, SF_DIR))
        jobs.append(n)
        assert len(files_of(folder)) == C.LANDED_BATCHES * per_batch
    assert per_batch > 1 and max(jobs) <= min(jobs) + 1


@pytest.mark.parametrize("gap", [0, 500])
def test_files_land_in_order_and_hold_every_message(spark, monkeypatch, gap):
    """A span of positions without messages is a file without rows."""
    monkeypatch.setattr(C, "FILE_POSITIONS", 1_000)
    place = scratch_path(spark, "gap")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    late = F.col("event_id") >= 50
    events.withColumn("event_id", F.col("event_id") + F.when(late, gap).otherwise(0)).write.parquet(f"{place}/events.parquet")
    folder, per_batch = C.landed_wal(spark, place)
    files, wal = files_of(folder), C.wal(spark, place)
    times = [os.stat(f).st_mtime for f in files]
    assert times == sorted(set(times)) and len(files) == C.LANDED_BATCHES * per_batch
    key = lambda df: sorted((r["session_id"], r["seq"], r["lsn"], bytes(r["data"])) for r in df.select("session_id", "seq", "lsn", "data").collect())
    assert key(spark.read.parquet(folder)) == key(wal)
    seqs = [[r["seq"] for r in spark.read.parquet(str(f)).select("seq").collect()] for f in files]
    low, high = min(map(min, filter(None, seqs))), max(map(max, filter(None, seqs)))
    step = (high - low) // len(files) + 1
    assert all((s - low) // step == k for k, part in enumerate(seqs) for s in part)
    assert (not all(seqs)) == bool(gap)
