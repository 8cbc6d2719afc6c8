"""Values of tuples, of a batch of messages at once, against a model that reads byte by byte."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

import messages as m
from changeflow.functions import tuples
from changeflow.operators import decode as D
from changeflow.queries.decoding import joined_texts, wide_bytes
from changeflow.session import settle, spread


def model(data, start, names):
    """(place behind the tuple, its values), places from 1 as in `substring`."""
    at, values = start + 2, []
    count = int.from_bytes(data[start : start + 2], "big") if start + 2 <= len(data) else 0
    for k in range(count):
        if at > len(data):
            break
        kind, size = data[at : at + 1].decode("latin-1"), int.from_bytes(data[at + 1 : at + 5], "big")
        if kind in ("t", "b"):
            following = at + 5 + (min(size, 1 << 30) if at + 5 <= len(data) else 1 << 30)
        else:
            following = at + 1
        content = data[at + 5 : following]
        name = names[k] if k < len(names) else f"col_{k}"
        if kind and kind in "tbnu":
            text = content.decode("utf-8", "replace") if kind == "t" else None
            values.append({"name": name, "kind": kind, "text": text, "bin": content if kind == "b" else None})
        at = following
    return at + 1, values


def random_messages(rng, n):
    value = lambda: rng.choice([None, m.UNCHANGED, "", "Anna", "ž€" * rng.randint(1, 4), bytes(rng.randbytes(rng.randint(0, 5)))])
    for _ in range(n):
        new, old = ([value() for _ in range(rng.choice([0, 1, 3, 40]))] for _ in range(2))
        data = bytearray(m.update(1, new, old=old, tag=b"O") if rng.random() < 0.5 else m.insert(1, new))
        if rng.random() < 0.3:
            data = data[: rng.randint(1, len(data))]
        if rng.random() < 0.3 and len(data) > 6:
            data[rng.randrange(6, len(data))] = rng.randrange(256)
        yield bytes(data)


def test_damaged_messages_read_as_byte_by_byte():
    rng = random.Random(5)
    data = list(random_messages(rng, 3000))
    names = [rng.choice([None, [], ["a"], [f"n{k}" for k in range(20)]]) for _ in data]
    first, second = ([rng.random() < 0.9 for _ in data] for _ in range(2))
    columns = [pa.array(data, pa.binary()), pa.array(names, pa.list_(pa.string())), pa.array(first), pa.array(second)]
    # The batch is a slice, as Arrow may hand one over; each message ends where the next one begins.
    found = tuples.images(*[c.slice(7) for c in columns]).to_pylist()
    for raw, names_, one, two, row in zip(data[7:], names[7:], first[7:], second[7:], found, strict=True):
        place, values = model(raw, 6, names_ or []) if one else (None, None)
        assert (row["one"] is None) == (not one)
        if one:
            assert row["one"]["vals"] == values
            assert row["one"]["off"] == place or min(row["one"]["off"], place) > len(raw) + 1
        follows = one and two and raw[place - 1 : place] == b"N"
        assert (row["two"] is None) == (not follows)
        if follows:
            assert row["two"]["vals"] == model(raw, place, names_ or [])[1]


def test_an_empty_batch():
    types = (pa.binary(), pa.list_(pa.string()), pa.bool_(), pa.bool_())
    assert tuples.images(*[pa.array([], t) for t in types]).to_pylist() == []


def row_messages(spark, data):
    rows = [(1, k, 0, "I", d, "public", "t", ["a", "b"], 0, 0) for k, d in enumerate(data)]
    schema = """session_id long, seq long, lsn int, msg_type string, data binary, schema_name string, table_name string,
        names array<string>, commit_lsn int, ts_ms long"""
    return spark.createDataFrame(rows, schema)


def test_text_that_is_not_utf8_reads_as_spark_replaces_it(spark):
    rng = random.Random(6)
    parts = [b"a", b"\xc3", b"\xa9", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"\xf0\x9f", b"\xed\xa0\x80", b"\xff", b"\xc0\x80", b"\xf4\x90"]
    texts = [b"".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(500)]
    made = [b"I\0\0\0\1N\0\2" + b"".join(k + len(t).to_bytes(4, "big") + t for k in (b"t", b"b")) for t in texts]
    after = D.decode_rows(row_messages(spark, made)).select(F.col("after")[0]["text"].alias("t"), F.col("after")[1]["bin"].alias("b"))
    assert after.filter(~F.col("t").eqNullSafe(F.expr("make_valid_utf8(cast(b as string))"))).count() == 0


def test_a_filter_does_not_read_the_tuples_again(spark):
    """No fold over the bytes is left, and the images are made in one step, whoever looks at the errors."""
    rows = D.decode_rows(row_messages(spark, [m.insert(1, ["7", "Anna"])])).filter("error is null")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("images(") == 1 and "aggregate(" not in plan
    assert rows.count() == 1


def test_names_as_one_text_read_as_a_list_of_them():
    """Also with the empty name, and for messages without names or a batch that is a slice."""
    rng = random.Random(7)
    data, lists = list(random_messages(rng, 500)), [None, ["a"], [""], ["", "b"], [f"n{k}" for k in range(20)]]
    names = [rng.choice(lists) for _ in data]
    texts = [n and "".join(f"{name}\0" for name in n) for n in names]
    every = pa.array([True] * len(data))
    one, two = (
        f(*[c.slice(7) for c in (pa.array(data, pa.binary()), pa.array(n, t), every, every)]).to_pylist()
        for f, n, t in ((tuples.images, names, pa.list_(pa.string())), (tuples.named_images, texts, pa.string()))
    )
    assert one == two and len(one) == 493


def test_names_are_sent_as_one_text(spark):
    rows = D.decode_rows(row_messages(spark, [m.insert(1, ["7", "Anna", "x"])]))
    assert [v["name"] for v in rows.first()["after"]] == ["a", "b", "col_2"]
    assert "array_join(names" in rows._jdf.queryExecution().optimizedPlan().toString()


def test_joined_texts_of_every_kind(spark):
    images = [[("t", "a"), ("n", None), ("t", "")], [("u", None), ("n", None), ("t", "a")], [("b", None), ("t", "b")], [("n", None)], []]
    kinds = "after array<struct<kind:string,text:string>>"
    found = spark.createDataFrame([(i,) for i in images], kinds).select(joined_texts("after").alias("t"))
    assert [r["t"] for r in found.collect()] == ["a|-|", "-|a", "b", "-", ""]


def test_a_large_row_group_is_no_single_task(spark):
    """All lines are one row group, which one task reads: messages are made and decoded by several."""
    rows = settle(wide_bytes(spark, "/root/testdata/sf0.01"))
    assert rows.count() == 60_000 and len(rows.inputFiles()) >= 5
    few = spark.read.parquet("/root/testdata/sf0.01/region.parquet")
    assert spread(few.limit(0)).count() == 0
