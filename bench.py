"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs twice and the faster run counts: the first one also pays for starting the JVM's
compiler. Every result row is computed (noop sink), none is collected.
"""

from __future__ import annotations

import json
import os
import time

from changeflow.operators.decode import decode_wal
from changeflow.queries import QUERIES
from changeflow.queries.changelog import SPECS, files_per_batch, landing
from changeflow.session import local_session, scratch_path
from changeflow.sinks.store import TableStore
from changeflow.sources.scans import wal_scan
from changeflow.streaming.stream import drain, process_batch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REGISTERED = (
    "current_state w01_latest_per_key w02_dedup_history k01_apply_changes k01_apply_small_changes "
    "k03_append_history a01_count_events a06_staleness a09_sum_counter f01_lsn_to_int f09_variant "
    "d04_carry_tx s02_snapshot_scan s04_delta_scan b01_backfill b02_reconcile b03_sync_check"
).split()


def decode(spark, sf_dir):
    return decode_wal(wal_scan(spark, landing(spark, sf_dir))).rows


def stream_batch(spark, sf_dir):
    """The landed log as one batch: decode, fold, history, dead letters, counts, commit."""
    store = TableStore(spark, scratch_path(spark, "bench"), SPECS)
    process_batch(store, wal_scan(spark, landing(spark, sf_dir)), "bench", 0)
    return store.current("events")


def stream_many_batches(spark, sf_dir):
    """The same log in small batches through the stream itself: no batch rewrites the base."""
    store = TableStore(spark, scratch_path(spark, "bench"), SPECS)
    files = files_per_batch(spark, sf_dir)
    drain(spark, landing(spark, sf_dir), store, scratch_path(spark, "checkpoint"), max_files=files)
    return store.current("events")


def main() -> None:
    spark = local_session(CPUS, "changeflow-bench")
    landing(spark, SF_DIR)
    messages = wal_scan(spark, landing(spark, SF_DIR)).count()
    runs = {"decode_wal": decode, "stream_batch": stream_batch, "stream_many_batches": stream_many_batches}
    runs |= {name: QUERIES[name].run for name in REGISTERED}
    seconds = {}
    for name, run in runs.items():
        taken = []
        for _ in range(2):
            start = time.perf_counter()
            run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "sum of the faster of two runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "messages": messages,
                "decoded_messages_per_s": round(messages / seconds["decode_wal"]),
                "streamed_messages_per_s": round(messages / seconds["stream_batch"]),
            }
        )
    )


if __name__ == "__main__":
    main()
