"""Vectorised words of a batch of texts, for operators that work on Arrow batches inside tasks.

A batch of texts is one buffer of bytes; words, their hashes and the hashes of word runs are found
with a handful of numpy passes over it, never with a loop over words or bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.session import ship  # noqa: F401

#: Bytes of text that are worked on at a time; one longer text is a group of its own.
GROUP_BYTES = 1 << 20
#: Words beyond this many bytes are hashed one by one.
LONG_WORD = 256
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of a word `[^\x20\x09-\x0D]+`, and of a run of letters, digits and non-ASCII characters.
PLAIN = ~_table((0x20, 0x20), (0x09, 0x0D))
LETTERS = _table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some consecutive texts. `first[i]:first[i + 1]` are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.start))

    def starts(self, n: int) -> np.ndarray:
        """Hash of the first n bytes of each word, n up to 8; a shorter word is taken whole."""
        eights = _eights(self.data)[self.start]
        with np.errstate(over="ignore"):
            return mix((eights & _MASKS[np.minimum(self.end - self.start, n)]) * _A + np.uint64(n))

    def runs(self, n: int, seed: int = 0) -> np.ndarray:
        """Hash of the n words from each word on. Runs over the end of a text are of no meaning:
        `room() >= n` tells the others."""
        with np.errstate(over="ignore"):
            return mix(run_sums(mix(self.hashes + np.uint64(seed * int(_A) % (1 << 64))), n) + np.uint64(n))


def run_sums(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial of n values in a row from each place on, by doubling; zeros follow the end."""
    done, width, power, total = 0, 1, _A | np.uint64(1), None
    block, factor = values, power
    shift = lambda a, k: np.concatenate((a[k:], np.zeros(min(k, len(a)), np.uint64)))
    scale = np.uint64(1)
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                part = shift(block, done) * scale
                total = part if total is None else total + part
                done, scale = done + width, scale * factor
            if width * 2 > n:
                return total
            block = block + shift(block, width) * factor
            width, factor = width * 2, factor * factor


def texts(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, if wanted in lower case; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = pc.utf8_lower(column) if lower else column
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def groups(offsets: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about `size` bytes."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = PLAIN) -> Words:
    """The words of the texts between `offsets`."""
    low = int(offsets[0])
    data, at = data[low : int(offsets[-1])], offsets - low
    inside = np.concatenate(([False], kind[data], [False]))
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    step = inside[1:] & ~inside[:-1]
    step[edges] = inside[edges + 1]
    start = np.flatnonzero(step)
    stop = inside[:-1] & ~inside[1:]
    stop[edges] = inside[edges]
    end = np.flatnonzero(stop)
    return Words(data, start, end, np.searchsorted(start, at), _hashes(data, start, end))


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, zeros after the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    eights = _eights(data)
    size = end - start
    with np.errstate(over="ignore"):
        out = mix((eights[start] & _MASKS[np.minimum(size, 8)]) + size.astype(np.uint64) * _A)
        left = np.flatnonzero((size > 8) & (size <= LONG_WORD))
        done = 8
        while len(left):
            rest = size[left] - done
            out[left] = mix(out[left] * _A + (eights[start[left] + done] & _MASKS[np.minimum(rest, 8)]))
            left, done = left[rest > 8], done + 8
    for i in np.flatnonzero(size > LONG_WORD):
        digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, dtype="<u8")[0]
    return out


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of the bytes, none of them empty."""
    return _hashes(data, start, end)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def as_lists(values: pa.Array, first: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, type=pa.int32()), values)


def renamed(docs: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the named columns, under the operator's own names, so that no other column can clash."""
    return docs.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(k) for k, c in columns.items()])
