"""Expressions that read big-endian fields out of a binary log message.

Offsets are 1-based byte positions as in `substring`. A broken message yields short or empty
slices instead of an error and is recognised afterwards by its final offset.
"""

from __future__ import annotations

_REST = 2147483647

NO_COLUMNS = "cast(array() as array<struct<name:string,type_oid:bigint,is_key:boolean>>)"


def unsigned(data: str, off: str, size: int) -> str:
    """Unsigned field of 1, 2 or 4 bytes as bigint."""
    return f"cast(conv(hex(substring({data}, {off}, {size})), 16, 10) as bigint)"


def unsigned64(data: str, off: str) -> str:
    return f"cast(conv(hex(substring({data}, {off}, 8)), 16, 10) as decimal(20,0))"


def signed64(data: str, off: str) -> str:
    return f"cast(conv(hex(substring({data}, {off}, 8)), 16, -10) as bigint)"


def tag(data: str, off: str) -> str:
    """One byte as a character; empty past the end."""
    return f"cast(substring({data}, {off}, 1) as string)"


def cstring(data: str, off: str) -> str:
    """The bytes from `off` up to the next zero byte. Latin-1 maps every byte to one character
    and back, so the zero is found whatever the bytes are."""
    rest = f"substring({data}, {off}, {_REST})"
    first = f"split_part(decode({rest}, 'ISO-8859-1'), '\\0', 1)"
    return f"encode({first}, 'ISO-8859-1')"


def overrun(data: str, off: str) -> str:
    """True when reading ran past the end of the message."""
    return f"{off} > octet_length({data}) + 1"


def _items(count: str) -> str:
    """1..count; `sequence` itself would count down to 0."""
    return f"if({count} > 0, sequence(1, cast({count} as int)), cast(array() as array<int>))"


def relation_columns(data: str, off: str) -> str:
    """Struct (off, cols, ok): per column flags byte, zero-ended name, 4-byte type, 4-byte modifier."""
    flags = unsigned(data, "acc.off", 1)
    name = cstring(data, "acc.off + 1")
    oid = unsigned(data, "acc.off + 2 + octet_length(f.name)", 4)
    return f"""aggregate(
        {_items(unsigned(data, off, 2))},
        named_struct('off', {off} + 2, 'cols', {NO_COLUMNS}, 'ok', true),
        (acc, i) -> if({overrun(data, 'acc.off')}, acc,
            transform(
                array(named_struct('name', {name}, 'flags', {flags})),
                f -> named_struct(
                    'off', acc.off + 1 + octet_length(f.name) + 1 + 8,
                    'cols', array_append(acc.cols, named_struct(
                        'name', cast(f.name as string), 'type_oid', {oid},
                        'is_key', (f.flags & 1) = 1)),
                    'ok', acc.ok and is_valid_utf8(cast(f.name as string))))[0]))"""
