"""Current-state and history tables as Parquet folders.

A batch adds one small folder of folded changes per table and one folder of history rows; the
size of a batch decides what is written, not the size of the table. Many small folders of changes
are folded into one (`fold`), which reads changes only. The current state is the base of a table
with the changes since then applied, by the same join whether it is read or written out again
(`compact`, when the changes have grown to a share of the base, in a job of its own). A base is
bucketed by key, so that join does not shuffle it.

What is valid is said by the newest record under `_commits`: a one-line JSON file, written by
Spark with mode "error" so that a second writer of the same number fails. Folders no record
names are leftovers of a failed attempt and are overwritten by the retry.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.scalars import literal
from changeflow.operators.changes import fold_changes, now_utc
from changeflow.operators.merge import apply_changes, first_state
from changeflow.schema import DEAD_DDL, METRIC_DDL, RELATION_DDL, TAKEN_DDL, TX_DDL, TableSpec
from changeflow.session import one_line, run_together
from changeflow.sinks import files

# The changed keys are broadcast when the state is built, up to this many rows and bytes.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 100_000
FOLD_DELTAS = 32  # so many folders of changes of one level become one of the next
HISTORY_DAY = "_CDC_DAY"  # folder of a history row below its batch
DELTA_SHARE = 0.25  # compaction is due when the changes reach this share of the base

_FOLD_DDL = (
    "_OP string, _UNSET array<string>, _COMMIT_LSN decimal(20,0), _LSN decimal(20,0), "
    "_SEQ bigint, _N bigint, _LOADED_AT timestamp_ntz"
)


def write_counted(df: DataFrame, path: str, keys: list[str]) -> dict:
    """Write a folder; its number of rows and the bytes of its keys are counted on the way."""
    seen = Observation()
    width = sum((F.octet_length(F.col(k).cast("string")) + 16 for k in keys), F.lit(0))
    totals = [F.count(F.lit(1)).alias("rows"), F.sum(width).alias("key_bytes")]
    df.observe(seen, *totals).write.mode("overwrite").parquet(path)
    found = seen.get
    return {"path": path, "rows": int(found["rows"]), "key_bytes": int(found["key_bytes"] or 0)}


def _entry(path: str) -> str:
    """Name of the catalog entry of a bucketed base."""
    return f"changeflow_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"


class TableStore:
    def __init__(self, spark: SparkSession, root: str, specs: dict[str, TableSpec]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = specs

    # What is committed

    def head(self) -> dict:
        """The newest complete record."""
        folder = f"{self.root}/_commits"
        for name in reversed(files.children(self.spark, folder)):
            if files.written(self.spark, f"{folder}/{name}"):
                return json.loads(files.first_line(self.spark, f"{folder}/{name}"))
        return {"n": 0, "writers": {}, "tables": {}, "position": None, "state": None}

    def done(self, writer: str, batch_id: int, head: dict | None = None) -> bool:
        return (head or self.head())["writers"].get(writer, -1) >= batch_id

    def _record(self, head: dict, **changed) -> None:
        """Publish the next record. Fails if another writer has published since `head`, or takes the
        same number. Numbers of records that were left half written are passed over."""
        folder = f"{self.root}/_commits"
        later = [n for n in map(int, files.children(self.spark, folder)) if n > head["n"]]
        if any(files.written(self.spark, f"{folder}/{n:012d}") for n in later):
            raise RuntimeError(f"another writer has committed after record {head['n']}")
        record = head | changed | {"n": max([head["n"], *later]) + 1}
        line = one_line(self.spark, json.dumps(record))
        line.write.mode("error").text(f"{folder}/{record['n']:012d}")

    def _table(self, head: dict, name: str) -> dict:
        return head["tables"].get(name, {"base": None, "rows": 0, "buckets": 0, "deltas": [], "holds": {}})

    # Reading

    def _base(self, spec: TableSpec, table: dict) -> DataFrame:
        """The base as a bucketed external table, so that joins on the key use its buckets."""
        if not table["buckets"]:
            return self.spark.read.schema(spec.current_ddl()).parquet(*table["base"])
        name = _entry(table["base"][0])
        keys = ", ".join(f"`{k}`" for k in spec.pk_targets)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({spec.current_ddl()}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {table['buckets']} BUCKETS "
            f"LOCATION {literal(table['base'][0])}"
        )
        return self.spark.table(name)

    def _changes(self, spec: TableSpec, table: dict) -> DataFrame:
        """One row per key over all changes since the base."""
        cols = ", ".join(f"`{c}` {t}" for c, t in spec.target_types.items())
        schema = f"{cols}, {_FOLD_DDL}"
        rows = self.spark.read.schema(schema).parquet(*[d["path"] for d in table["deltas"]])
        return fold_changes(rows, spec.pk_targets, "_N") if len(table["deltas"]) > 1 else rows

    def current(self, source: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Current state: one row per key."""
        spec = self.specs[source]
        table = self._table(self.head(), spec.current)
        columns = [*spec.target_types, "_LOADED_AT"]
        if not table["deltas"]:
            if table["base"] is None:
                return self.spark.createDataFrame([], spec.current_ddl())
            return self._base(spec, table)
        changes = self._changes(spec, table)
        if table["base"] is None:
            return first_state(changes, columns)
        total = lambda field: sum(d[field] for d in table["deltas"])
        small = total("rows") <= broadcast_rows and total("key_bytes") <= BROADCAST_BYTES
        return apply_changes(self._base(spec, table), changes, spec.pk_targets, small=small)

    def _committed(self, folder: str, schema: str) -> DataFrame:
        """Rows of the committed batches below writer=/batch_id= folders."""
        path = f"{self.root}/{folder}"
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, batch_id bigint")
        typed = StructType.fromDDL(f"{schema}, writer string, batch_id bigint")
        writers = self.head()["writers"]
        rows = self.spark.read.schema(typed).parquet(path)
        if not writers:
            return rows.filter("false").drop("writer")
        # One look-up, however many writers there have been; it prunes folders.
        last = F.create_map(*[F.lit(x) for w, b in writers.items() for x in (w, int(b))])
        return rows.filter(F.col("batch_id") <= F.try_element_at(last, F.col("writer"))).drop("writer")

    def history(self, source: str, low: str | None = None, high: str | None = None) -> DataFrame:
        """Every event, if wanted those committed from day `low` to day `high`: other days' folders are
        not read."""
        spec = self.specs[source]
        rows = self._committed(spec.history, f"{spec.history_ddl()}, {HISTORY_DAY} date")
        for day, inside in ((low, F.col(HISTORY_DAY) >= F.lit(low).cast("date")), (high, F.col(HISTORY_DAY) <= F.lit(high).cast("date"))):
            rows = rows.filter(inside) if day else rows
        return rows.drop("batch_id", HISTORY_DAY)

    def dead(self) -> DataFrame:
        return self._committed("_dead", DEAD_DDL)

    def metrics(self) -> DataFrame:
        return self._committed("_metrics", METRIC_DDL)

    def taken(self) -> DataFrame:
        """Ranges of the positions that the stream has taken."""
        return self._committed("_taken", TAKEN_DDL).drop("batch_id")

    def state(self, head: dict | None = None) -> tuple[DataFrame, DataFrame] | tuple[None, None]:
        """Relations and transactions the last stream batch left open."""
        path = (head or self.head())["state"]
        if not path:
            return None, None
        relation, tx = StructType.fromDDL(RELATION_DDL), StructType.fromDDL(TX_DDL)
        both = StructType([*relation, *[f for f in tx if f.name != "session_id"]])
        rows = self.spark.read.schema(both).parquet(path)
        return (
            rows.filter(F.col("oid").isNotNull()).select(*relation.names),
            rows.filter(F.col("oid").isNull()).select(*tx.names),
        )

    def position(self) -> dict | None:
        """Confirmed log position and the last (session_id, seq) taken."""
        return self.head()["position"]

    # Writing

    def commit(
        self,
        writer: str,
        batch_id: int,
        changes: dict[str, DataFrame],
        history: dict[str, DataFrame] | None = None,
        extra: dict[str, DataFrame | Callable[[], DataFrame | None]] | None = None,
        state: DataFrame | None = None,
        position: dict | None = None,
        at: Column | None = None,
        head: dict | None = None,
        state_bytes: Callable[[], int] | None = None,
    ) -> bool:
        """Write a batch and make all of it valid at once. A batch this writer has committed
        already is left alone. `changes` holds folded changes per source table. `extra` are
        other folders; one given as a function is asked for after the tables are written, and may be None. `head`
        is the record the batch was computed from, if not the newest. `state_bytes` tells, once
        the state is written, how much its relations take in memory."""
        head = head or self.head()
        if self.done(writer, batch_id, head):
            return False
        part = f"writer={writer}/batch_id={batch_id}"
        at = now_utc() if at is None else at.cast("timestamp_ntz")
        open_state = head["state"] if state is None else f"{self.root}/_state/{writer}-{batch_id}"

        def write_change(source: str, rows: DataFrame) -> tuple[str, dict]:
            name = self.specs[source].current
            path = f"{self.root}/{name}/changes/{writer}-{batch_id}"
            stamped = rows.withColumn("_N", F.lit(head["n"] + 1).cast("bigint"))
            stamped = stamped.withColumn("_LOADED_AT", at)
            delta = write_counted(stamped, path, self.specs[source].pk_targets)
            return name, delta | {"n": head["n"] + 1}

        def write_rows(folder: str, rows: DataFrame) -> None:
            path, seen = f"{self.root}/{folder}/{part}", Observation()
            rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            if not seen.get["rows"]:
                files.remove(self.spark, path)

        def write_history(source: str, rows: DataFrame) -> None:
            spec = self.specs[source]
            # A folder per day of commit; parts of it are sized by bytes, sorted by the clustering columns.
            rows = rows.withColumn(HISTORY_DAY, F.col("_CDC_TS").cast("date")).hint("rebalance", HISTORY_DAY)
            rows = rows.sortWithinPartitions(HISTORY_DAY, *[spec.targets[c] for c in spec.cluster_by], "_CDC_TS")
            path = f"{self.root}/{spec.history}/{part}"
            rows.write.mode("overwrite").partitionBy(HISTORY_DAY).parquet(path)

        deltas = [partial(write_change, t, rows) for t, rows in changes.items()]
        others = [partial(write_history, t, rows) for t, rows in (history or {}).items()]
        later = {name: rows for name, rows in (extra or {}).items() if callable(rows)}
        now = {name: rows for name, rows in (extra or {}).items() if name not in later}
        others += [partial(write_rows, name, rows) for name, rows in now.items()]
        if state is not None:
            others.append(lambda: state.coalesce(1).write.mode("overwrite").parquet(open_state))
        done = run_together([*deltas, *others])
        made = {name: rows() for name, rows in later.items()}
        run_together([partial(write_rows, name, rows) for name, rows in made.items() if rows is not None])
        tables = dict(head["tables"])
        for name, delta in done[: len(deltas)]:
            if delta["rows"]:
                table = self._table(head, name)
                tables[name] = table | {"deltas": [*table["deltas"], delta]}
        self._record(
            head,
            writers=head["writers"] | {writer: batch_id},
            tables=tables,
            state=open_state,
            state_bytes=state_bytes() if state_bytes else head.get("state_bytes") if state is None else None,
            position=position or head["position"],
        )
        return True

    def hold(self, source: str, run: str) -> int:
        """Keep changes that come from now on apart from earlier ones until `run` replaces the base:
        the base is not compacted before that. Returns the number of the record it starts from."""
        head, name = self.head(), self.specs[source].current
        table = self._table(head, name)
        holds = table.get("holds", {}) | {run: head["n"]}
        self._record(head, tables=head["tables"] | {name: table | {"holds": holds}})
        return head["n"]

    def replace_base(self, source: str, paths: list[str], rows: int, run: str, writer: str) -> None:
        """Make written folders the base of a table, end the hold of `run` and record that `writer`
        has done so, all at once. Changes committed after the hold began stay on top of the
        base, earlier ones are replaced by it. Without folders the table stays as it is."""
        head = self.head()
        spec = self.specs[source]
        table = self._table(head, spec.current)
        holds = dict(table.get("holds", {}))
        if run not in holds:
            raise ValueError(f"{source} has no hold of run {run}: start a new run")
        since = holds.pop(run)
        if paths:
            later = [d for d in table["deltas"] if d["n"] > since]
            table = {"base": paths, "rows": rows, "buckets": 0, "deltas": later}
        self._record(
            head,
            writers=head["writers"] | {writer: 1},
            tables=head["tables"] | {spec.current: table | {"holds": holds}},
        )

    def _foldable(self, table: dict) -> tuple[int, int] | None:
        """The first FOLD_DELTAS changes in a row of one level that no hold sets apart."""
        holds = table.get("holds", {}).values()
        kinds = [(d.get("level", 0), sum(h < d["n"] for h in holds)) for d in table["deltas"]]
        start = 0
        for i, kind in enumerate(kinds):
            if kind != kinds[start]:
                start = i
            if i - start + 1 >= FOLD_DELTAS:
                return start, i + 1
        return None

    def folding_due(self, source: str, head: dict | None = None) -> bool:
        return self._foldable(self._table(head or self.head(), self.specs[source].current)) is not None

    def fold(self, source: str) -> None:
        """Fold many small folders of changes into one. The base is neither read nor written."""
        head, spec = self.head(), self.specs[source]
        table = self._table(head, spec.current)
        found = self._foldable(table)
        if found is None:
            return
        low, high = found
        several = table["deltas"][low:high]
        path = f"{self.root}/{spec.current}/changes/fold-{uuid.uuid4().hex[:12]}"
        one = write_counted(self._changes(spec, table | {"deltas": several}), path, spec.pk_targets)
        one |= {"n": several[-1]["n"], "level": several[0].get("level", 0) + 1}
        deltas = [*table["deltas"][:low], one, *table["deltas"][high:]]
        self._record(head, tables=head["tables"] | {spec.current: table | {"deltas": deltas}})

    def compaction_due(self, source: str, head: dict | None = None) -> bool:
        """Whether the changes have reached their share of the base, in rows; their number is of no
        matter. An empty base is due with the first fold."""
        table = self._table(head or self.head(), self.specs[source].current)
        if table.get("holds"):
            return False
        changed = sum(d["rows"] for d in table["deltas"])
        folded = any(d.get("level", 0) for d in table["deltas"])
        return changed >= DELTA_SHARE * table["rows"] if table["rows"] else folded

    def maintain(self) -> list[str]:
        """Compact the tables that are due. A job of its own: the stream never rewrites a base."""
        due = [source for source in self.specs if self.compaction_due(source)]
        for source in due:
            self.compact(source)
        return due

    def compact(self, source: str, bucket_rows: int = BUCKET_ROWS) -> None:
        """Write the current state out as a new base, bucketed and sorted by key. While a backfill is
        under way its changes have to stay apart: then only small changes are folded."""
        head = self.head()
        spec = self.specs[source]
        table = self._table(head, spec.current)
        if table.get("holds"):
            return self.fold(source)
        state = self.current(source, broadcast_rows=0)
        expected = table["rows"] + sum(d["rows"] for d in table["deltas"])
        buckets = table["buckets"]
        # As long as the buckets are not twice too full, rows stay in theirs and nothing moves.
        if not buckets or expected > 2 * buckets * bucket_rows:
            buckets = max(1, min(MAX_BUCKETS, math.ceil(expected / bucket_rows)))
            state = state.repartition(buckets, *spec.pk_targets)
        path = f"{self.root}/{spec.current}/base/{uuid.uuid4().hex[:12]}"
        name = _entry(path)
        seen = Observation()
        (
            state.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.format("parquet")
            .option("path", path)
            .bucketBy(buckets, *spec.pk_targets)
            .sortBy(*spec.pk_targets)
            .saveAsTable(name)
        )
        rows = int(seen.get["rows"])
        base = {"base": [path], "rows": rows, "buckets": buckets, "deltas": []}
        self._record(head, tables=head["tables"] | {spec.current: base})

    def expire(self, keep: int = 2) -> int:
        """Remove all but the newest `keep` records, and change and base folders none of those
        names. Run it while no batch is being written."""
        folder = f"{self.root}/_commits"
        every = files.children(self.spark, folder)
        names = [n for n in every if files.written(self.spark, f"{folder}/{n}")]
        kept = names[-keep:]
        live = set()
        for name in kept:
            record = json.loads(files.first_line(self.spark, f"{folder}/{name}"))
            live.add(record["state"])
            for table in record["tables"].values():
                live.update(table["base"] or [])
                live.update(d["path"] for d in table["deltas"])
        dropped = [f"{folder}/{n}" for n in names[:-keep]]
        folders = [f"{s.current}/{k}" for s in self.specs.values() for k in ("changes", "base")]
        for sub in [*folders, "_state"]:
            paths = [f"{self.root}/{sub}/{c}" for c in files.children(self.spark, f"{self.root}/{sub}")]
            dropped += [p for p in paths if not any(f"{f}/".startswith(f"{p}/") for f in live)]
        for path in dropped:
            if "/base/" in path:
                self.spark.sql(f"DROP TABLE IF EXISTS {_entry(path)}")
            files.remove(self.spark, path)
        return len(dropped)
