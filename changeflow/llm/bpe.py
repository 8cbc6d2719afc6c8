"""Byte-level BPE: ranked merges are folded over the byte arrays of distinct words, texts are put together
from their words' tokens, and decoding joins the bytes of the tokens.

Inside a task the words of some megabytes of text are told apart by numpy, and all words not met before
are folded at once, as rows of one array: in each round every row merges its leftmost two neighbours
of least rank, found in a hash table of the rank map. A text is never shuffled, nor are its words."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from changeflow.llm import arrow

#: Bytes of text that are encoded at a time.
GROUP_BYTES = 4 << 20
#: Words and pieces that a task remembers, and the bytes up to which a word is remembered.
REMEMBERED, WORD_BYTES = 1_000_000, 64
#: Ranks lie below this.
RANKS = 1 << 17
#: Bytes of a piece from which on it is merged by itself, with the merges to come in a heap.
LONG_PIECE = 65
#: Pieces that are folded as one array.
ROWS = 1 << 16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file, a line each: base64 of a token's bytes, rank."""
    with open(path, "rb") as f:
        lines = [line.split() for line in f if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    if {bytes([b]) for b in range(256)} - ranks.keys() or len(set(ranks.values())) < len(ranks):
        raise ValueError("a byte-level vocabulary has every byte, and a rank of its own for each token")
    if min(ranks.values()) < 0 or max(ranks.values()) >= RANKS:
        raise ValueError(f"ranks from 0 and below {RANKS} are needed")
    return ranks


class RankMap:
    """The rank of every two tokens whose bytes together are a token; `RANKS` for all others."""

    def __init__(self, ranks: dict[bytes, int]):
        self.of = {
            ranks[token[:k]] * RANKS + ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.bits = max(10, (4 * len(self.of)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, RANKS, dtype=np.int32)
        keys, values = np.array([*self.of], dtype=np.int64), np.array([*self.of.values()], dtype=np.int32)
        places = self._places(keys)
        while len(keys):  # of those that meet at a free place the first stays, the others go on by one
            places, order = np.sort(places), np.argsort(places, kind="stable")
            keys, values = keys[order], values[order]
            stays = (self.keys[places] < 0) & np.concatenate(([True], places[1:] != places[:-1]))
            self.keys[places[stays]], self.values[places[stays]] = keys[stays], values[stays]
            places, keys, values = (places[~stays] + 1) % len(self.keys), keys[~stays], values[~stays]

    def _places(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * RANKS + right
        places, out = self._places(keys), np.full(len(keys), RANKS, dtype=np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.keys[places]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[places[hit]]
            on = ~hit & (found >= 0)
            open_, places = open_[on], (places[on] + 1) % len(self.keys)
        return out


class Merges:
    """Encodes pieces, the matches of the pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.rank = RankMap(ranks)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def fold(self, pieces: list[bytes]) -> list[bytes]:
        """The tokens of each piece, as 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        for k in np.flatnonzero(sizes >= LONG_PIECE).tolist():
            out[k] = np.array(self.long(pieces[k]), dtype="<u4").tobytes()
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] < LONG_PIECE]
        for low in range(0, len(order), ROWS):
            rows = order[low : low + ROWS]
            for k, tokens in zip(rows.tolist(), self._rows([pieces[k] for k in rows.tolist()])):
                out[k] = tokens
        return out

    def _rows(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces of like sizes. A row's tokens stand at its left, -1 after them; a row that has nothing left
        to merge is taken out."""
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        now = np.full((len(pieces), width), -1, dtype=np.int32)
        filled = np.arange(width) < sizes[:, None]
        now[filled] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        each = np.full((len(pieces), width), RANKS, dtype=np.int32)  # the last column stays as it is
        pairs = filled[:, 1:]
        each[:, :-1][pairs] = self.rank(now[:, :-1][pairs], now[:, 1:][pairs])
        done, rows = now.copy(), np.arange(len(pieces))
        while len(rows):
            at = each.argmin(axis=1)
            line = np.arange(len(rows))
            least = each[line, at]
            over = least == RANKS
            if over.any():
                done[rows[over]] = -1
                done[rows[over], : now.shape[1]] = now[over]
                now, each, rows, at, least = now[~over], each[~over], rows[~over], at[~over], least[~over]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            # Of the two merged tokens the right one's column falls away, and the left one's pair.
            place = np.arange(now.shape[1] - 1)
            now = np.take_along_axis(now, place + (place > at[:, None]), 1)
            each = np.take_along_axis(each, place + (place >= at[:, None]), 1)
            now[line, at] = least
            left = np.flatnonzero(at > 0)
            each[left, at[left] - 1] = self.rank(now[left, at[left] - 1], least[left])
            right = np.flatnonzero(at + 1 < now.shape[1])
            right = right[now[right, at[right] + 1] >= 0]
            each[line, at] = RANKS
            each[right, at[right]] = self.rank(least[right], now[right, at[right] + 1])
        kept = done >= 0
        packed, ends = done[kept].astype("<u4").tobytes(), (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def long(self, piece: bytes) -> list[int]:
        """One piece, with the merges to come in a heap by rank and place."""
        now, find = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist(), self.rank.of.get
        n = len(now)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, k) for k in range(n - 1) if (r := find(now[k] * RANKS + now[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            right = after[at]
            if now[at] < 0 or right < 0 or find(now[at] * RANKS + now[right]) != rank:
                continue
            now[at], now[right] = rank, -1
            after[at] = after[right]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    r = find(now[left] * RANKS + now[after[left]])
                    if r is not None:
                        heapq.heappush(heap, (r, left))
        return [t for t in now if t >= 0]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of some texts, and the number of the first of each text. A word begins
    where a text does, and at each single space between two characters that are surely not white space:
    the patterns of byte-level BPE end a match before such a space, whatever stands around it."""
    # By first byte: of those outside ASCII, C2, E1, E2 and E3 begin white space and much else.
    filled = np.ones(256, dtype=bool)
    filled[[*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0xC3), 0xE1, 0xE2, 0xE3]] = False
    cut = np.flatnonzero(data == 0x20)
    within = np.searchsorted(offsets, cut, "right") - 1
    cut = cut[(cut > offsets[within]) & (cut + 1 < offsets[within + 1])]
    before = cut - 1
    for _ in range(3):
        before = before - ((data[before] & 0xC0) == 0x80)
    cut = cut[filled[data[cut + 1]] & filled[data[before]]]
    start = np.sort(np.concatenate((offsets[:-1][offsets[:-1] < offsets[1:]], cut)), kind="stable")
    return start, np.append(start, offsets[-1])[1:], np.searchsorted(start, offsets)


class Encoder:
    """Encodes Arrow columns of texts inside a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges = Merges(ranks)
        self.spelling = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The tokens of distinct words, as 32-bit integers."""
        for known in (self.words, self.pieces):
            if len(known) > REMEMBERED:
                known.clear()
        coded = list(map(self.words.get, words))
        new = [k for k, c in enumerate(coded) if c is None]
        parts = [list(map(str.encode, self.split(words[k].decode()))) for k in new]
        unknown = list({p for part in parts for p in part if p not in self.pieces})
        own = dict(zip(unknown, self.merges.fold(unknown))) if unknown else {}
        self.pieces.update((p, t) for p, t in own.items() if len(p) <= WORD_BYTES)
        for k, part in zip(new, parts):
            coded[k] = b"".join([self.pieces.get(p) or own[p] for p in part])
        self.words.update((words[k], coded[k]) for k in new if len(words[k]) <= WORD_BYTES)
        return coded

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each group of texts: the number of the first, the tokens of all, and where each one's begin."""
        data, offsets = arrow.texts(column)
        for low, high in arrow.groups(offsets, GROUP_BYTES):
            at = offsets[low : high + 1] - offsets[low]
            own = data[offsets[low] : offsets[high]]
            start, end, first = spaced(own, at)
            hashes = arrow.spans(own, start, end)
            _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
            raw = own.tobytes()
            coded = self.encode([raw[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())])
            tokens = np.frombuffer(b"".join(coded), dtype="<u4")
            sizes = np.array([len(c) >> 2 for c in coded], dtype=np.int64)
            begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            sizes = sizes[which]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            tokens = tokens[np.repeat(begins[which] - ends[:-1], sizes) + np.arange(ends[-1])]
            yield low, tokens, ends[first]

    def decode(self, tokens: np.ndarray) -> bytes:
        return b"".join(map(self.spelling.__getitem__, tokens.tolist()))


@lru_cache(maxsize=2)
def _encoder(name: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(SparkFiles.get(name)), pattern)


def _tasks(docs: DataFrame, vocabulary: str, pattern: str, columns: list[str], fields: list, make) -> DataFrame:
    """The first of the columns, and what `make` gives for each batch, encoder and column of the second."""
    read_ranks(vocabulary)
    spark = docs.sparkSession
    arrow.ship(spark)
    spark.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]
    source = arrow.renamed(docs, doc_id=columns[0], value=columns[1])
    names = ["doc_id", *(n for n, _ in fields)]

    def work(batches):
        encoder = _encoder(name, pattern)
        for batch in batches:
            for low, rows in make(encoder, batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(rows[0])), *rows], names)

    kinds = ", ".join(f"{n} {kind}" for n, kind in fields)
    return source.mapInArrow(work, f"doc_id {dict(source.dtypes)['doc_id']}, {kinds}")


def encode(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and `tokens` (array of int), the encoding of each whole text: each match of `pattern` by the
    ranks of the file `vocabulary`, without special tokens. A match may hold a space between two other
    characters as its first one only, as in the public patterns of this kind.

    Null text is empty: no tokens. Null ids, repeated rows and ties stay as they are, a row each; an empty
    table gives no rows; a text or a word of any length is encoded whole, in memory that grows with that
    text alone. Other columns are not read, whatever their names. Words of a group of texts are told
    apart by 64 bits of hash.
    """

    def lists(encoder, column):
        for low, tokens, first in encoder.texts(column):
            yield low, [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(tokens.view("<i4")))]

    return _tasks(docs, vocabulary, pattern, [doc_id, text], [("tokens", "array<int>")], lists)


def decode(rows: DataFrame, vocabulary: str, doc_id: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """`doc_id` and `decoded`, the bytes of the row's tokens joined, as binary; null stays null."""

    def joined(encoder, column):
        # A row at a time, so that a batch of long rows is not held as numbers and bytes at once.
        for k, row in enumerate(column):
            value = encoder.decode(row.values.to_numpy(zero_copy_only=False)) if row.is_valid else None
            yield k, [pa.array([value], pa.binary())]

    return _tasks(rows, vocabulary, ".", [doc_id, tokens], [("decoded", "binary")], joined)


def digests(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`encode` and decoding in one pass, with digests in place of the lists: `doc_id`, `n_tokens`,
    `ids_sha256` (of the tokens as unsigned 32-bit integers, least byte first) and `decoded_sha256` (of the
    bytes that the tokens are decoded to). Rows as in `encode`."""

    def hashed(encoder, column):
        for low, tokens, first in encoder.texts(column):
            each = [tokens[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield low, [
                pa.array(np.diff(first)),
                pa.array([sha256(t.tobytes()).hexdigest() for t in each], pa.string()),
                pa.array([sha256(encoder.decode(t)).hexdigest() for t in each], pa.string()),
            ]

    fields = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    return _tasks(docs, vocabulary, pattern, [doc_id, text], fields, hashed)
