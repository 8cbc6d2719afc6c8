"""Change data capture on Spark: decode, fold, keep history, backfill, reconcile, check."""

from changeflow.schema import CHANGE_DDL, HISTORY_AUDIT, IMAGE_DDL, RAW_WAL, TableSpec

__all__ = ["CHANGE_DDL", "HISTORY_AUDIT", "IMAGE_DDL", "RAW_WAL", "TableSpec"]
