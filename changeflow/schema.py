"""Row contracts and the table registry."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from changeflow.functions.scalars import upper_snake_name

LSN = T.DecimalType(20, 0)  # unsigned 64 bit does not fit a long

# Landed log messages. `seq` is the arrival order over the whole landing zone (strictly
# increasing, also across sessions); `session_id` marks one lifetime of the log connection.
RAW_WAL = T.StructType(
    [
        T.StructField("session_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("lsn", LSN),
        T.StructField("data", T.BinaryType()),
    ]
)

IMAGE_DDL = "array<struct<name:string,kind:string,text:string,bin:binary>>"

CHANGE_DDL = (
    f"op string, schema_name string, table_name string, before {IMAGE_DDL}, after {IMAGE_DDL}, "
    "lsn decimal(20,0), commit_lsn decimal(20,0), ts_ms bigint, session_id bigint, seq bigint"
)

DEAD_DDL = (
    "session_id bigint, seq bigint, lsn decimal(20,0), msg_type string, msg_len int, "
    "table_name string, error string, data binary"
)

RELATION_DDL = (
    "session_id bigint, oid bigint, namespace string, table_name string, "
    "columns array<struct<name:string,type_oid:bigint,is_key:boolean>>, "
    "valid_from bigint, valid_to bigint"
)

# `seen` is the position of the begin message.
TX_DDL = "session_id bigint, commit_lsn decimal(20,0), ts_ms bigint, seen bigint"

# Stored below a folder per batch, which gives it the column batch_id.
METRIC_DDL = "metric string, table_name string, op string, value double, at timestamp_ntz"

# Positions a batch has taken, as ranges inside blocks of positions.
TAKEN_DDL = "block bigint, low bigint, high bigint"

# Audit columns of a history table, after its data columns.
HISTORY_AUDIT = {
    "_CDC_OP": "string",
    "_CDC_LSN": "decimal(20,0)",
    "_CDC_TS": "timestamp_ntz",
    "_LOADED_AT": "timestamp_ntz",
}


@dataclass(frozen=True)
class TableSpec:
    """One replicated table.

    `columns` maps source column names to Spark types; target names follow from the
    source names. `pk`, `json`, `not_null`, `ts_col` and `cluster_by` use source names.
    """

    source: str
    current: str
    columns: dict[str, str]
    pk: tuple[str, ...]
    json: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    ts_col: str | None = None
    cluster_by: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    targets: dict[str, str] = field(init=False, compare=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "targets", {c: upper_snake_name(c) for c in self.columns})

    @property
    def history(self) -> str:
        return f"{self.current}_HISTORY"

    @property
    def pk_targets(self) -> list[str]:
        return [self.targets[c] for c in self.pk]

    @property
    def target_types(self) -> dict[str, str]:
        return {self.targets[c]: t for c, t in self.columns.items()}

    def current_ddl(self) -> str:
        cols = [f"`{c}` {t}" for c, t in self.target_types.items()]
        return ", ".join([*cols, "`_LOADED_AT` timestamp_ntz"])

    def history_ddl(self) -> str:
        cols = self.target_types | HISTORY_AUDIT
        return ", ".join(f"`{c}` {t}" for c, t in cols.items())


# The example source schema (names, types, keys, partition prefix).
CUSTOMERS = TableSpec(
    source="customers",
    current="CUSTOMERS",
    columns={
        "id": "decimal(20,0)",
        "tenant_id": "string",
        "email": "string",
        "status": "string",
        "plan_id": "string",
        "metadata": "variant",
        "tags": "variant",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    pk=("id", "tenant_id"),
    json=("metadata", "tags"),
    not_null=("id", "tenant_id"),
    ts_col="updated_at",
    cluster_by=("tenant_id",),
    prefixes=("customers_",),
)
CUSTOMER_DEVICES = TableSpec(
    source="customer_devices",
    current="CUSTOMER_DEVICES",
    columns={
        "id": "decimal(20,0)",
        "customer_id": "decimal(20,0)",
        "tenant_id": "string",
        "device_id": "string",
        "label": "string",
        "created_at": "timestamp_ntz",
    },
    pk=("id",),
    not_null=("id", "customer_id", "tenant_id", "device_id"),
    cluster_by=("id",),
)

REGISTRY: dict[str, TableSpec] = {s.source: s for s in (CUSTOMERS, CUSTOMER_DEVICES)}


def prefix_map(specs: dict[str, TableSpec]) -> dict[str, str]:
    """Partition prefix -> parent table, in registry order."""
    return {p: s.source for s in specs.values() for p in s.prefixes}
