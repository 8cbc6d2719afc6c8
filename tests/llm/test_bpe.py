import base64
import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from fixtures import awkward, documents, empty

from changeflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ALPHABET = ["a", "b", "'ll", "'", "l", " ", " ", "  ", "\n", "\t", "é", "日本", "1", "23", "!", "...", "the", " of", "　",
            " ", "\u0085", " ", "\U0001f642", "-" * 12, "\r\n", "'T", "'s", "́", "\u0001", "\u0002", "\x1c",
            "привет", "ß", " ", " ", "\x00", "<|endoftext|>", "\U0010ffff"]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, longest, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def rows(values):
    return [(i, t, "en", "s", 0) for i, t in enumerate(values)]


def test_texts_equal_the_library(spark, library):
    rng = random.Random(6)
    long = ["".join(rng.choices("abcdefghij", k=5000)), "=" * 3000, "ab" * 700, "x" * 64, "y" * 65, "z" * 66, "café" * 400]
    values = texts(1500, 60) + long + [t + " " + t for t in long]
    docs = documents(spark, rows(values))
    coded = bpe.encode(docs, PATH, PATTERN)
    found = {r.doc_id: r.tokens for r in coded.collect()}
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, PATH).collect()}
    for k, t in enumerate(values):
        assert found[k] == library.encode_ordinary(t), t
        assert back[k] == t.encode()


def test_pieces_equal_the_library(library):
    """By rows and by heap, of all sizes, with the same piece twice."""
    rng = random.Random(9)
    merges = bpe.Merges(bpe.read_ranks(PATH))
    pieces = [bytes(rng.choices(b"abehinorst", k=rng.randint(1, 40))) for _ in range(3000)] + [bytes([b]) for b in range(256)]
    pieces += pieces[:5] + [rng.randbytes(rng.randint(1, 30)) for _ in range(500)]
    for p, tokens in zip(pieces, merges.fold(pieces)):
        wanted = library._core_bpe.encode_single_piece(p)
        assert list(struct.unpack(f"<{len(tokens) // 4}I", tokens)) == wanted == merges.long(p), p
    assert merges.fold([]) == []


def test_null_tokens_stay_null(spark):
    df = spark.createDataFrame([(1, None), (2, []), (None, [64, 65])], "doc_id long, tokens array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, PATH).collect()}
    spelled = {rank: token for token, rank in bpe.read_ranks(PATH).items()}
    assert got == {1: None, 2: b"", None: spelled[64] + spelled[65]}


def test_words_are_forgotten_and_found_again(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "GROUP_BYTES", 50)
    encoder = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
    values = texts(200, 30, 11)
    got = [t for _, tokens, first in encoder.texts(pa.array(values)) for t in np.split(tokens, first[1:-1])]
    assert [t.tolist() for t in got] == [library.encode_ordinary(t) for t in values]


def test_digests(spark, library):
    docs = documents(spark, clash=["tokens", "n_tokens", "_kept"])
    wanted = []
    for i, t, *_ in awkward():
        ids = library.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = bpe.digests(docs, PATH, PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(wanted, key=key)


def test_empty(spark):
    assert bpe.digests(empty(spark), PATH, PATTERN).count() == 0
    assert bpe.encode(empty(spark), PATH, PATTERN).count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    bad = tmp_path / "ranks"
    bad.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(bad))
