"""Token counts of every prefix of a text, by dynamic programming over the text's bytes.

The last token of the encoding of a prefix is the only token that ends there and may stand after the
last token of the prefix before it. So one pass from left to right gives each prefix its last token
and, from the shorter prefix, its number of tokens. Whether two tokens may stand side by side is
found by merging their bytes once. Questions on truncation and budget are then answered from the
counts, without encoding again.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.arrow import renamed, ship

#: Fixed value: the public pattern of byte-level BPE that splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose counts a task remembers; beyond it the memory is emptied.
REMEMBERED = 400_000
OUT_BYTES = 8 << 20


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the rest for 256 and up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of a byte-level BPE vocabulary in the JSON form of the tokenizers library."""

    def __init__(self, spec: dict):
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        if not plain or before.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE has its counts by prefix")
        letters = byte_letters()
        as_bytes = lambda token: bytes(map(letters.__getitem__, token))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.id = {bytes([b]): b for b in range(256)}
        self.parts = [(b, b) for b in range(256)]
        self.joined: dict[int, int] = {}
        for a, b in pairs:
            left, right = as_bytes(a), as_bytes(b)
            pair = (self.id[left], self.id[right])
            self.joined[pair[0] << 20 | pair[1]] = self.id[left + right] = len(self.parts)
            self.parts.append(pair)
        self.ending = ahocorasick.Automaton()
        for token, number in self.id.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), number))
        self.ending.make_automaton()
        self.split = regex.compile(PATTERN).findall
        added = [t for t in spec.get("added_tokens") or []]
        if any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("added tokens with rules of their own are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.beside: dict[int, bool] = {}
        self.known: dict[str, np.ndarray] = {}
        self.total: dict[str, int] = {}

    def follows(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens are encoded as these two. The merges that made them are
        undone, latest first; none of them may come after a merge over the border."""
        latest, joined, parts = len(self.parts), self.joined, self.parts
        while True:
            if joined.get(left << 20 | right, latest) < latest:
                return False
            # A byte has no merge to undo: then the other side is next, and with none left all is told.
            if left > right and left > 255 or right < 256 <= left:
                latest, left = left, parts[left][1]
            elif right > 255:
                latest, right = right + 1, parts[right][0]
            else:
                return True

    def piece(self, data: bytes) -> list[int]:
        """Tokens of each prefix of a piece of the split, by bytes; 0 for the empty one."""
        size, beside = len(data) + 1, self.beside
        counts, last = [0] * size, [-1] * size
        done = -1
        for end, (n, token) in self.ending.iter(data.decode("latin-1")):
            if end == done:
                continue
            before = last[end + 1 - n]
            if before >= 0:
                key = before << 20 | token
                good = beside.get(key)
                if good is None:
                    if len(beside) > REMEMBERED:
                        beside.clear()
                    good = beside[key] = self.follows(before, token)
                if not good:
                    continue
            last[end + 1] = token
            counts[end + 1] = counts[end + 1 - n] + 1
            done = end
        return counts

    def size(self, piece: str) -> int:
        """Tokens of a whole piece."""
        found = self.total.get(piece)
        if found is None:
            if len(self.total) > REMEMBERED:
                self.total.clear()
            found = self.total[piece] = self.piece(piece.encode())[-1]
        return found

    def inner(self, piece: str) -> np.ndarray:
        """Tokens after each character of a piece that is itself split anew when it is cut."""
        found = self.known.get(piece)
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            by_byte = np.array(self.piece(piece.encode()), dtype=np.int32)
            ends = np.cumsum([len(c.encode()) for c in piece])
            found = by_byte[ends]
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # cut, it is no longer a contraction
                for k in range(1, len(piece)):
                    found[k - 1] = sum(self.size(p) for p in self.split(piece[:k]))
            self.known[piece] = found
        return found

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """The text cut at special strings."""
        if self.special is None:
            return [(text, False)] if text else []
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [(text[at : m.start()], False)] * (m.start() > at) + [(m.group(), True)]
            at = m.end()
        return out + [(text[at:], False)] * (at < len(text))

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        total, size = 0, self.size
        known = self.total
        for part, special in self.segments(text):
            if special:
                total += 1
                continue
            pieces = self.split(part)
            try:
                total += sum(map(known.__getitem__, pieces))
            except KeyError:
                total += sum(map(size, pieces))
        return total

    def counts(self, text: str) -> np.ndarray:
        """Tokens of the prefix that ends after each character of the text."""
        out, base = [], 0
        for part, special in self.segments(text):
            if special:
                # A cut special string is ordinary text after what stands before it.
                own = [base + self._cut(part[:k]) for k in range(1, len(part))] + [base + 1]
                out.append(np.array(own, dtype=np.int32))
                base += 1
                continue
            pieces = self.split(part)
            before = self._before(pieces, base)
            out.append(self._within(pieces, before))
            base = int(before[-1])
        counts = np.concatenate(out) if out else np.zeros(0, np.int32)
        return self._joined(text, counts)

    def _before(self, pieces: list[str], base: int = 0) -> np.ndarray:
        sizes = np.fromiter(map(self.size, pieces), dtype=np.int32, count=len(pieces))
        return base + np.concatenate(([0], np.cumsum(sizes)))

    def _within(self, pieces: list[str], before: np.ndarray) -> np.ndarray:
        inner = [self.inner(p) for p in pieces]
        counts = np.concatenate(inner) + np.repeat(before[:-1], [len(p) for p in pieces])
        self._blanks(pieces, before, counts)
        return counts.astype(np.int32)

    def _cut(self, part: str) -> int:
        return sum(self.size(p) for p in self.split(part))

    def _blanks(self, pieces: list[str], before: np.ndarray, counts: np.ndarray) -> None:
        """A prefix that ends inside white space before a word has all of that space in one piece."""
        at = 0
        for i, p in enumerate(pieces):
            if i and p[0].isspace() and pieces[i - 1].isspace():
                run = pieces[i - 1] + p[0]
                counts[at] = before[i - 1] + self.size(run)
            at += len(p)

    def _joined(self, text: str, counts: np.ndarray) -> np.ndarray:
        """Cut special strings may join the piece before them: count those prefixes from the last
        special string on."""
        if self.special is None:
            return counts
        last = 0
        for m in self.special.finditer(text):
            base = int(counts[last - 1]) if last else 0
            head = text[last : m.start()]
            for k in range(1, m.end() - m.start()):
                counts[m.start() + k - 1] = base + self._cut(head + m.group()[:k])
            last = m.end()
        return counts

    def answer(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of the text, and characters of the longest prefix of at most `budget` tokens. A
        prefix has at least the tokens of all pieces but its last two, so that only the counts
        near the budget are worked out."""
        if self.special is not None and self.special.search(text):
            counts = self.counts(text)
            fits = np.flatnonzero(counts <= budget)
            return int(counts[-1]), int(fits[-1]) + 1 if len(fits) else 0
        pieces = self.split(text)
        try:
            sizes = list(map(self.total.__getitem__, pieces))
        except KeyError:
            sizes = list(map(self.size, pieces))
        total = sum(sizes)
        if total <= budget:
            return total, len(text)
        before = np.concatenate(([0], np.cumsum(sizes)))
        near = int(np.searchsorted(before, budget))
        low, high = max(0, near - 3), min(len(pieces), near + 3)
        fits = np.flatnonzero(self._within(pieces[low:high], before[low : high + 1]) <= budget)
        start = sum(map(len, pieces[:low]))
        return total, start + int(fits[-1]) + 1 if len(fits) else start


@lru_cache(maxsize=4)
def _counter(name: str) -> PrefixCounter:
    with open(SparkFiles.get(name), encoding="utf-8") as f:
        return PrefixCounter(json.load(f))


def token_counts(docs: DataFrame, tokenizer: str, limit: int, store: bool = False, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `n_bytes`, `n_tokens`, `over_limit` and `fits`, the characters of the
    longest prefix of at most `limit` tokens; with `store`, `prefix_tokens`, the tokens after each
    character. `tokenizer` is the path of a vocabulary on the driver; Spark hands it to the tasks.

    Null text is empty: 0 bytes, 0 tokens, no prefix. Null ids, repeated rows and ties stay as they
    are, a row each; an empty table gives no rows; other columns are not read. A text of any length
    is counted whole, in memory that grows with that text alone.
    """
    spark = docs.sparkSession
    name = tokenizer.rsplit("/", 1)[-1]
    ship(spark)
    spark.sparkContext.addFile(tokenizer)
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
              ("over_limit", pa.bool_()), ("fits", pa.int64())]
    ddl = "n_bytes long, n_tokens long, over_limit boolean, fits long"
    if store:
        fields, ddl = [*fields, ("prefix_tokens", pa.list_(pa.int32()))], ddl + ", prefix_tokens array<int>"
    source = renamed(docs, doc_id=doc_id, text=text)
    kind = dict(source.dtypes)["doc_id"]

    def count(batches):
        counter = _counter(name)
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            rows, size, low = [], 0, 0
            for i, value in enumerate(column):
                value = value.as_py() or ""
                if store:
                    prefix = counter.counts(value)
                    total = int(prefix[-1]) if len(prefix) else 0
                    fits = np.flatnonzero(prefix <= limit)
                    fit = int(fits[-1]) + 1 if len(fits) else 0
                else:
                    (total, fit), prefix = counter.answer(value, limit), None
                rows.append((len(value.encode()), total, total > limit, fit, prefix))
                size += len(value) * 4 if store else 32
                if size > OUT_BYTES:
                    yield _batch(ids.slice(low, len(rows)), rows, fields, store)
                    rows, size, low = [], 0, i + 1
            if rows:
                yield _batch(ids.slice(low, len(rows)), rows, fields, store)

    return source.mapInArrow(count, f"doc_id {kind}, {ddl}")


def _batch(ids: pa.Array, rows: list, fields: list, store: bool) -> pa.RecordBatch:
    columns = [ids] + [pa.array(x, type=t) for x, (_, t) in zip(list(zip(*rows))[: 5 if store else 4], fields[1:])]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in fields])


def prefix_tokens(chars: Column | int, store: str = "prefix_tokens") -> Column:
    """Tokens of the prefix of so many characters, from the store."""
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.when(chars <= 0, 0).otherwise(F.get(F.col(store), F.least(chars, F.size(store)) - 1))


def chars_in_budget(budget: int, store: str = "prefix_tokens") -> Column:
    """Characters of the longest prefix of at most `budget` tokens, from the store."""
    return F.coalesce(
        F.array_max(F.transform(store, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))), F.lit(0)
    )
