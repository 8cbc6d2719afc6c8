import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from changeflow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def table(spark, rows, clash=()):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in clash:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def brute_force(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - int(np.fmod(c, 100))
        whole[c] = own.get(head, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    below, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, cs in members.items():
        for d in range(len(p) + 1):
            below[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += p not in children
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in whole if tuple(whole[c]) == p))).encode()).hexdigest()
    return sorted(
        (min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], below[p], digest(p))
        for p, cs in members.items()
    )


def found(df):
    return sorted(map(tuple, trie.prefix_trie(df).collect()))


def mixed(seed, convs, hot=0):
    """Short texts from few, so that many prefixes are shared; some conversations are one and the same."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-300, 5000), convs) + [0, 100, 700]:
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "日本 x"])) for t in range(rng.randint(1, 7))]
    for c in range(10_000, 10_000 + hot):
        rows += [(c, t, "user", f"copy {t}") for t in range(9)]
    return rows


@pytest.fixture(params=[1, 5, 40])
def blocks(spark, request):
    """The same rows in one block and in many, so that prefixes reach over several."""
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", kept)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_all_prefixes(spark, blocks):
    rows = mixed(1, 90) + mixed(2, 20, hot=150)
    assert found(table(spark, rows)) == brute_force(rows)


def test_one_conversation_many_times_and_a_long_one(spark, blocks):
    rows = [(c, t, "user", "same") for c in range(200) for t in range(6)]
    rows += [(300 + k, t, "user", "x" * (t % 3)) for k in range(2) for t in range(400)]
    assert found(table(spark, rows)) == brute_force(rows)


def test_awkward_rows(spark):
    rows = [(5, None, "user", "first"), (5, 1, "user", "later"), (5, 1, "user", "also"), (5, 1, "user", "also"), (5, None, None, None)]
    rows += [(None, 1, "user", "of none"), (106, 0, "user", "a" * 50_000), (206, 0, "", ""), (-7, 3, "user", "below zero")]
    rows += [(1, 0, "user", "gone with its head")]
    assert found(table(spark, rows, clash=["keys", "head_id", "turns", "_part", "size"])) == brute_force(rows)


def test_only_conversations_without_turns_left(spark):
    """The head is absent and takes the place of all turns: the root is a leaf."""
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, t, "user", "x") for t in range(3)]
    assert found(table(spark, rows)) == brute_force(rows)
    assert [r[1:6] for r in found(table(spark, rows))] == [(0, None, 1, 0, 1)]


def test_empty(spark):
    assert trie.prefix_trie(table(spark, [])).collect() == []
    assert trie.prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []


def test_searches_equal_a_walk():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.integers(0, 6, n)
        search = trie.RangeLeast(values)
        at, bound = np.repeat(np.arange(n), 7), np.tile(np.arange(7), n)
        right, left = search.right(at, bound), search.left(at, bound)
        for k, (i, d) in enumerate(zip(at, bound)):
            r = i
            while r + 1 < n and values[r + 1] >= d:
                r += 1
            low = i
            while low > 0 and values[low] >= d:
                low -= 1
            assert (right[k], left[k]) == (r, low)
        low, high = np.sort(rng.integers(0, n, (2, 50)), axis=0)
        assert (search.least(low, high) == [values[a : b + 1].min() for a, b in zip(low, high)]).all()
