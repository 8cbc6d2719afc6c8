"""The values of the tuples of a batch of row messages, for all messages at once.

The first values of all messages are found with a handful of numpy passes over the bytes of the batch, then the
second ones and so on; the contents are cut out by Arrow. A broken message yields short or empty values and
ends behind its last byte, by which it is recognised, as in `wire`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: A length field can hold more than any message has bytes.
_MAX_SIZE = 1 << 30
_KINDS = np.frombuffer(b"tbnu", np.uint8)
_VALUE = pa.struct([("name", pa.string()), ("kind", pa.string()), ("text", pa.string()), ("bin", pa.binary())])
_TUPLE = pa.struct([("off", pa.int32()), ("vals", pa.list_(_VALUE))])
IMAGES = pa.struct([("one", _TUPLE), ("two", _TUPLE)])
_VALUE_DDL = "struct<name:string,kind:string,text:string,bin:binary>"
_TUPLE_DDL = f"struct<off:int,vals:array<{_VALUE_DDL}>>"
IMAGES_DDL = f"struct<one:{_TUPLE_DDL},two:{_TUPLE_DDL}>"


def _unsigned(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Big-endian fields; `raw` reaches beyond the last of them."""
    found = np.zeros(len(at), np.int64)
    for k in range(size):
        found <<= 8
        found |= raw[at + k]
    return found


def _places(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each tuple ends, and how many values were found in it; then, by message and number, where the content of
    each value begins and ends, in turn, and its kind."""
    count = np.where(wanted & (starts + 2 <= ends), _unsigned(raw, np.minimum(starts, ends), 2), 0)
    place, sizes, rows, steps = starts + 2, np.zeros(len(starts), np.int64), np.flatnonzero(count > 0), []
    at, end, most = place[rows], ends[rows], count[rows]
    while True:
        more = (most > len(steps)) & (at <= end)
        if not more.all():
            place[rows], sizes[rows] = at, len(steps)
            rows, at, end, most = (c[more] for c in (rows, at, end, most))
        if not len(rows):
            break
        kind = raw[at]
        kind[at >= end] = 0
        head = np.where((kind == _KINDS[0]) | (kind == _KINDS[1]), 5, 1)
        size = _unsigned(raw, np.minimum(at + 1, end), 4)
        size[(size > _MAX_SIZE) | (at + 5 > end)] = _MAX_SIZE
        size[head == 1] = 0
        low = at + head
        at = low + size
        steps.append((rows, np.minimum(low, end), np.minimum(at, end), kind))
    # Values were found one number after the other; a message's first value is behind all of those before it.
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    bounds, kinds = np.zeros(2 * total + 1, np.int32), np.zeros(total, np.uint8)
    for k, (rows, low, high, kind) in enumerate(steps):
        to = first[rows] + k
        kinds[to] = kind
        to *= 2
        bounds[to] = low
        to += 1
        bounds[to] = high
    bounds[-1] = bounds[-2] if total else 0
    return place, sizes, bounds, kinds


def _names(names: pa.ListArray, which: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The announced name of each value; one beyond them is called col_<index>. `which` says for each message the list
    of its names, -1 if it has none."""
    flat, offsets = names.values, np.append(names.offsets.to_numpy(), 0)
    low, high = offsets[:-1][which], offsets[1:][which]
    known, low = np.where(which < 0, 0, high - low), np.where(which < 0, 0, low)
    number = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    surplus = pa.array([f"col_{k}" for k in range(int(sizes.max(initial=0)))] if (sizes > known).any() else [], pa.string())
    at = np.where(number < np.repeat(known, sizes), np.repeat(low, sizes), len(flat)) + number
    return pa.concat_arrays([flat, surplus]).take(pa.array(at))


def _text(contents: pa.Array) -> pa.Array:
    """Bytes as text; what is not UTF-8 is replaced."""
    text = pa.Array.from_buffers(pa.string(), len(contents), contents.buffers(), contents.null_count, contents.offset)
    try:
        text.validate(full=True)
    except pa.ArrowInvalid:
        text = pa.array([v if v is None else v.decode("utf-8", "replace") for v in contents.to_pylist()], pa.string())
    return text


def _tuples(
    raw: np.ndarray, data: pa.Array, begins: np.ndarray, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray,
    names: pa.ListArray, which: np.ndarray,
) -> tuple[np.ndarray, pa.Array]:
    place, sizes, bounds, kind = _places(raw, starts, ends, wanted)
    # Contents and what is between them, in turn: every second one is a content.
    pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), data.buffers()[2]])
    named, at, known = _names(names, which, sizes), np.arange(0, 2 * len(kind), 2), np.isin(kind, _KINDS)
    if not known.all():
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[known], minlength=len(sizes))
        named, at, kind = named.filter(pa.array(known)), at[known], kind[known]
    cut = lambda which: pieces.take(pa.array(at, mask=kind != which)) if (kind == which).any() else pa.nulls(len(kind), pa.binary())
    letters = pa.Array.from_buffers(pa.string(), len(kind), [None, pa.py_buffer(np.arange(len(kind) + 1, dtype=np.int32)), pa.py_buffer(kind)])
    columns = [named, letters, _text(cut(_KINDS[0])), cut(_KINDS[1])]
    values = pa.StructArray.from_arrays(columns, fields=list(_VALUE))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    vals = pa.ListArray.from_arrays(pa.array(offsets), values, type=pa.list_(_VALUE))
    off = np.minimum(place - begins + 1, np.iinfo(np.int32).max).astype(np.int32)
    return place, pa.StructArray.from_arrays([pa.array(off), vals], fields=list(_TUPLE), mask=pa.array(~wanted))


def _images(data: pa.Array, names: pa.ListArray, which: np.ndarray, first: pa.Array, second: pa.Array) -> pa.Array:
    data = pa.concat_arrays([data]).cast(pa.binary())
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    stored = np.frombuffer(data.buffers()[2] or b"", np.uint8)
    raw, begins, ends = np.concatenate([stored, np.zeros(8, np.uint8)]), offsets[:-1], offsets[1:]
    one, two = (c.fill_null(False).to_numpy(zero_copy_only=False) for c in (first, second))
    place, one_tuple = _tuples(raw, data, begins, begins + 6, ends, one, names, which)
    inside = np.minimum(place, ends)
    follows = one & two & (place < ends) & (raw[inside] == ord("N"))
    _, two_tuple = _tuples(raw, data, begins, np.where(follows, inside + 1, begins), ends, follows, names, which)
    return pa.StructArray.from_arrays([one_tuple, two_tuple], fields=list(IMAGES))


def images(data: pa.Array, names: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """The tuple behind the tag of each message that is asked for by `first`, and the one behind a tag N that follows
    it where `second` asks for it: struct (off, vals) with the values and the 1-based place behind them."""
    names = names.cast(pa.list_(pa.string()))
    which = np.where(names.is_null().to_numpy(zero_copy_only=False), -1, np.arange(len(names)))
    return _images(data, names, which, first, second)


def named_images(data: pa.Array, names: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    """`images`, where `names` are those of a message as one text, each ended by a zero byte as on the wire. Messages of
    a table have the same ones: each distinct text is taken apart once for a batch."""
    found = pa.concat_arrays([names]).cast(pa.string()).dictionary_encode()
    lists = [text.split("\0")[:-1] for text in found.dictionary.to_pylist()]
    which = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return _images(data, pa.array(lists, pa.list_(pa.string())), which, first, second)
