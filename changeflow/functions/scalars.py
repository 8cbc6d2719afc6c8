"""Scalar column functions. All are built-in Spark expressions; nothing here is a UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epochs, name pattern and operation labels.
PG_EPOCH_US = 946684800000000  # 2000-01-01 in Unix microseconds
CAMEL_PATTERN = "([a-z])([A-Z])"
OP_LABELS = {"c": "I", "u": "U", "d": "D"}
OP_NAMES = {"c": "insert", "u": "update", "d": "delete"}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

_TWO_32 = 4294967296


def lsn_to_int(c: Column) -> Column:
    """'1A/2B3C4D5E' -> unsigned 64-bit position as decimal(20,0)."""
    parts = F.split(c, "/")
    high = F.conv(parts[0], 16, 10).cast("decimal(10,0)")
    low = F.conv(parts[1], 16, 10).cast("decimal(10,0)")
    return (high * F.lit(_TWO_32).cast("decimal(10,0)") + low).cast("decimal(20,0)")


def lsn_to_text(c: Column) -> Column:
    """Position -> 'HIGH/LOWLOWLO' in upper-case hex, low half padded to eight digits."""
    position = c.cast("decimal(20,0)")
    half = F.lit(_TWO_32).cast("decimal(10,0)")
    high = F.call_function("div", position, half)
    low = F.pmod(position, half).cast("bigint")
    return F.concat(F.hex(high), F.lit("/"), F.lpad(F.hex(low), 8, "0"))


def pg_micros_to_ms(c: Column) -> Column:
    """Microseconds since 2000-01-01 -> Unix milliseconds, cut toward zero; NULL on overflow."""
    return F.call_function("div", F.try_add(c, F.lit(PG_EPOCH_US)), F.lit(1000))


def ms_to_ntz(c: Column) -> Column:
    return F.timestamp_add("MILLISECOND", c, F.lit("1970-01-01").cast("timestamp_ntz"))


def ms_to_text(c: Column) -> Column:
    return F.date_format(ms_to_ntz(c), TIMESTAMP_FORMAT)


def upper_snake(c: Column) -> Column:
    """camelCase -> UPPER_SNAKE; runs of capitals stay together."""
    return F.upper(F.regexp_replace(c, CAMEL_PATTERN, "$1_$2"))


def upper_snake_name(name: str) -> str:
    """The same rule for a name known on the driver."""
    return re.sub(CAMEL_PATTERN, r"\1_\2", name).upper()


def root_table(c: Column, prefixes: dict[str, str]) -> Column:
    """Partition name -> parent table; the first matching prefix wins, other names stay."""
    hits = [F.when(c.startswith(p), F.lit(parent)) for p, parent in prefixes.items()]
    return F.coalesce(*hits, c)


def _label(c: Column, labels: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in labels.items()], c)


def op_label(c: Column) -> Column:
    return _label(c, OP_LABELS)


def op_name(c: Column) -> Column:
    return _label(c, OP_NAMES)


def to_variant(c: Column, strict: bool = True) -> Column:
    return F.parse_json(c) if strict else F.try_parse_json(c)


def json_text(c: Column, type_name: str) -> Column:
    """JSON text of a struct, array, map or variant column, NULL fields included; any other
    column as it is."""
    nested = type_name.split("<")[0].split("(")[0] in ("struct", "array", "map", "variant")
    return F.to_json(c, {"ignoreNullFields": "false"}) if nested else c


def cast_to_spec(c: Column, type_name: str, strict: bool = True) -> Column:
    """Text to the target type. Strict raises on bad text, otherwise bad text gives NULL."""
    if type_name == "variant":
        return to_variant(c, strict)
    return c.cast(type_name) if strict else c.try_cast(type_name)


def cast_to_spec_sql(text: str, type_name: str, strict: bool = True) -> str:
    """`cast_to_spec` as SQL text, for tables of many columns: one call instead of many."""
    if type_name == "variant":
        return f"parse_json({text})" if strict else f"try_parse_json({text})"
    return f"cast({text} as {type_name})" if strict else f"try_cast({text} as {type_name})"


def ident(name: str) -> str:
    """A column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string in SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
