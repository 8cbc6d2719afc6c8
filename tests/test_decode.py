import random
import struct

import pytest
from pyspark.sql import functions as F

import messages as m
from changeflow.operators import decode as D
from changeflow.schema import RAW_WAL

COLUMNS = [("id", 23, True), ("port", 25, False), ("name", 25, False)]
RELATION = m.relation(1, "boats", COLUMNS)


def raw_of(spark, payloads, session=1, first=100):
    rows = [(session, i, i, p) for i, p in enumerate(payloads, start=first)]
    return spark.createDataFrame(rows, "session_id long, seq long, lsn long, data binary").select(
        "session_id", "seq", F.col("lsn").cast("decimal(20,0)").alias("lsn"), "data"
    )


def texts(image):
    return None if image is None else {v["name"]: v["text"] for v in image}


def decode(spark, payloads, **options):
    out = D.decode_wal(raw_of(spark, payloads), **options)
    return out.changes.orderBy("seq").collect(), out.dead.orderBy("seq").collect()


def primed(*rows):
    return [m.begin(500, 0), RELATION, *rows]


@pytest.fixture(scope="module")
def decoded(spark):
    """All good cases in one run: each is found by its position."""
    payloads = primed(
        m.insert(1, ["1", "north", "Anna"]),  # 102
        m.update(1, ["1", "north", "Berta"]),
        m.delete(1, ["1", None, None]),
        m.insert(1, ["2", "north", None]),
        m.insert(99, ["1", "north", "x"]),  # 106: never announced
        b"",
        m.update(1, ["2", "north", "b"], old=["2", "north", "a"]),  # 108
        m.update(1, ["3", "north", "b"], old=["2", None, None], tag=b"K"),
        m.update(1, ["3", "north", m.UNCHANGED]),  # 110
        m.insert(1, ["4", "north", b"\x00\xff"]),
        m.insert(1, ["5", "north", "e", "extra"]),  # 112: more values than columns
        b"U" + struct.pack(">I", 1) + b"X",  # 113: no new tuple
        b"D" + struct.pack(">I", 1) + b"X",  # 114: no old tuple
        m.delete(1, ["4", "north", "e"], tag=b"O"),  # 115
        m.commit(),
        b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 2) + b"t\0\0\0\x016" + b"z",  # 117
        b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 1) + b"t\0\0\0\x03a\xffb",  # 118
        b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 0),  # 119
        b"O" + bytes(8),
        b"T" + bytes(8),
    )
    changes, dead = decode(spark, payloads)
    return {r["seq"]: r for r in changes}, {r["seq"]: r for r in dead}


# Byte by byte, as the protocol pages lay them out.
LITERAL = {
    "begin": b"B" b"\0\0\0\0\0\0\1\xf4" b"\0\0\0\0\0\0\0\0" b"\0\0\0\1",
    "relation": b"R" b"\0\0\0\1" b"public\0" b"boats\0" b"d" b"\0\2" b"\1no\0" b"\0\0\0\x17" b"\xff\xff\xff\xff"
    b"\0name\0" b"\0\0\0\x19" b"\xff\xff\xff\xff",
    "insert": b"I" b"\0\0\0\1" b"N" b"\0\2" b"t\0\0\0\0017" b"t\0\0\0\4Anna",
    "update": b"U" b"\0\0\0\1" b"K" b"\0\2" b"t\0\0\0\0017" b"n" b"N" b"\0\2" b"t\0\0\0\0018" b"u",
    "delete": b"D" b"\0\0\0\1" b"O" b"\0\2" b"t\0\0\0\0018" b"b\0\0\0\2\0\xff",
}


def test_literal_messages(spark):
    columns = [("no", 23, True), ("name", 25, False)]
    assert list(LITERAL.values()) == [
        m.begin(500, 0), m.relation(1, "boats", columns), m.insert(1, ["7", "Anna"]),
        m.update(1, ["8", m.UNCHANGED], old=["7", None], tag=b"K"), m.delete(1, ["8", b"\0\xff"], tag=b"O"),
    ]
    rows = {r["op"]: r for r in decode(spark, list(LITERAL.values()))[0]}
    image = lambda values: [(v["name"], v["kind"], v["text"], v["bin"] and bytes(v["bin"])) for v in values]
    assert {r["table_name"] for r in rows.values()} == {"boats"}
    assert image(rows["c"]["after"]) == [("no", "t", "7", None), ("name", "t", "Anna", None)]
    assert image(rows["u"]["before"]) == [("no", "t", "7", None), ("name", "n", None, None)]
    assert image(rows["u"]["after"]) == [("no", "t", "8", None), ("name", "u", None, None)]
    assert image(rows["d"]["before"]) == [("no", "t", "8", None), ("name", "b", None, b"\0\xff")]


def test_insert(decoded):
    r = decoded[0][102]
    assert (r["op"], r["schema_name"], r["table_name"]) == ("c", "public", "boats")
    assert texts(r["after"]) == {"id": "1", "port": "north", "name": "Anna"}
    assert r["before"] is None
    assert (r["lsn"], r["commit_lsn"], r["ts_ms"]) == (102, 500, 946684800000)


def test_update(decoded):
    r = decoded[0][103]
    assert (r["op"], texts(r["after"])["name"], r["before"]) == ("u", "Berta", None)


def test_delete(decoded):
    r = decoded[0][104]
    assert (r["op"], r["after"], texts(r["before"])["id"]) == ("d", None, "1")


def test_null_column(decoded):
    assert texts(decoded[0][105]["after"])["name"] is None


def test_unknown_relation(decoded):
    assert 106 not in decoded[0]
    assert decoded[1][106]["error"] == "unknown relation"


def test_empty_message(decoded):
    assert 107 not in decoded[0] and 107 not in decoded[1]


def test_relation_is_reused(decoded):
    assert decoded[0][102]["table_name"] == decoded[0][103]["table_name"] == "boats"


def test_update_with_old_row(decoded):
    r = decoded[0][108]
    assert (texts(r["before"])["name"], texts(r["after"])["name"]) == ("a", "b")


def test_update_with_old_key(decoded):
    r = decoded[0][109]
    assert (texts(r["before"])["id"], texts(r["after"])["id"]) == ("2", "3")


def test_unchanged_value_keeps_its_kind(decoded):
    name = decoded[0][110]["after"][2]
    assert (name["kind"], name["text"]) == ("u", None)


def test_binary_value(decoded):
    name = decoded[0][111]["after"][2]
    assert (name["kind"], bytes(name["bin"]), name["text"]) == ("b", b"\x00\xff", None)


def test_surplus_value_is_named_by_its_index(decoded):
    assert texts(decoded[0][112]["after"])["col_3"] == "extra"


def test_update_without_new_row_is_kept(decoded):
    assert (decoded[0][113]["op"], decoded[0][113]["after"]) == ("u", None)


def test_delete_without_old_row_is_kept(decoded):
    assert (decoded[0][114]["op"], decoded[0][114]["before"]) == ("d", None)


def test_delete_with_full_row(decoded):
    assert texts(decoded[0][115]["before"])["name"] == "e"


def test_other_kind_takes_one_byte_and_gives_no_column(decoded):
    assert texts(decoded[0][117]["after"]) == {"id": "6"}


def test_bad_text_is_replaced(decoded):
    assert texts(decoded[0][118]["after"]) == {"id": "a�b"}


def test_row_without_columns(decoded):
    assert decoded[0][119]["after"] == []


def test_control_messages_do_nothing(decoded):
    assert not {116, 120, 121} & (set(decoded[0]) | set(decoded[1]))


def test_every_cut_is_a_dead_letter(spark):
    """Each prefix of a message with both images is refused, whatever it ends in."""
    whole = m.update(1, ["10", "north", "bb"], old=["9", None, "aa"])
    cuts = [whole[:n] for n in range(1, len(whole))]
    changes, dead = decode(spark, primed(*cuts, whole))
    assert len(changes) == 1 and changes[0]["seq"] == 102 + len(cuts)
    assert [d["seq"] for d in dead] == list(range(102, 102 + len(cuts)))


def test_broken_control_messages(spark):
    name = m.relation(2, "t", [(b"\xff\xfe", 23, True)])
    payloads = [m.begin(7, 0)[:12], RELATION[:-6], name, m.begin(7, 2**63 - 1), m.insert(1, ["1"])]
    changes, dead = decode(spark, payloads)
    assert changes == []
    assert [d["error"] for d in dead] == [
        "begin message cut short",
        "relation message cut short",
        "relation name is not text",
        "commit time out of range",
        "unknown relation",
    ]


def test_huge_lengths_do_not_raise(spark):
    bad = [
        b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 65535),
        b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 1) + b"t\xff\xff\xff\xffabc",
        b"R" + struct.pack(">I", 5) + b"n\0t\0d\xff\xff",
    ]
    changes, dead = decode(spark, primed(*bad))
    assert changes == [] and len(dead) == 3


def test_relation_can_change(spark):
    wider = m.relation(1, "boats", [*COLUMNS, ("age", 23, False)])
    changes, _ = decode(
        spark, primed(m.insert(1, ["1", "a", "b"]), wider, m.insert(1, ["1", "a", "b", "7"]))
    )
    assert [sorted(texts(c["after"])) for c in changes] == [
        ["id", "name", "port"],
        ["age", "id", "name", "port"],
    ]


def test_events_before_the_first_begin(spark):
    changes, _ = decode(spark, [RELATION, m.insert(1, ["1", "a", "b"])])
    assert (changes[0]["commit_lsn"], changes[0]["ts_ms"]) == (0, 0)


def test_sessions_do_not_share_context(spark):
    first = raw_of(spark, primed(m.insert(1, ["1", "a", "b"])), session=1, first=1)
    second = raw_of(spark, [m.insert(1, ["2", "a", "b"])], session=2, first=10)
    out = D.decode_wal(first.unionByName(second))
    assert out.changes.count() == 1
    assert [d["error"] for d in out.dead.collect()] == ["unknown relation"]


def test_context_of_an_earlier_batch(spark):
    first = D.decode_wal(raw_of(spark, primed(m.insert(1, ["1", "a", "b"]))))
    later = raw_of(spark, [m.insert(1, ["2", "a", "b"])], first=900_000)
    out = D.decode_wal(later, first.relations, first.transactions)
    (row,) = out.changes.collect()
    assert (row["commit_lsn"], row["table_name"]) == (500, "boats")


@pytest.fixture(scope="module")
def random_log():
    """Transactions of any length over two sessions, with the context each row must get."""
    rng = random.Random(7)
    rows, expected, seq = [], {}, 0
    for session in (1, 2):
        rows.append((session, seq, RELATION))
        seq += 1
        tx = 0
        for _ in range(60):
            if rng.random() < 0.7:
                tx = rng.randint(1, 2**63 + 5)
                rows.append((session, seq, m.begin(tx, tx % 10**12)))
                seq += rng.randint(1, 3)
            for _ in range(rng.choice([0, 1, 2, 25])):
                rows.append((session, seq, m.insert(1, [str(seq), "a", "b"])))
                ms = (tx % 10**12 + 946684800000000) // 1000 if tx else 0
                expected[seq] = (tx, ms)
                seq += rng.randint(1, 3)
    return rows, expected


@pytest.mark.parametrize("block,fan_in", [(1, 2), (7, 3), (64, 1), (4096, 4096), (10**9, 10)])
@pytest.mark.parametrize("parts", [1, 16])
def test_context_does_not_depend_on_layout(spark, random_log, block, fan_in, parts):
    rows, expected = random_log
    shuffled = random.Random(block).sample(rows, len(rows))
    raw = spark.createDataFrame(
        [(s, q, q, p) for s, q, p in shuffled], "session_id long, seq long, lsn long, data binary"
    )
    raw = raw.repartition(parts).withColumn("lsn", F.col("lsn").cast("decimal(20,0)"))
    messages = D.classify(raw)
    begins, _, _ = D.decode_control(messages)
    stamped = D.carry_transactions(
        messages.filter("msg_type = 'I'"), begins, raw.select("session_id", "seq"), None, block, fan_in
    )
    got = {r["seq"]: (int(r["commit_lsn"]), r["ts_ms"]) for r in stamped.collect()}
    assert got == expected


def test_relations_join_the_same_without_broadcast(spark, random_log):
    rows, _ = random_log
    raw = spark.createDataFrame(
        [(s, q, q, p) for s, q, p in rows], "session_id long, seq long, lsn long, data binary"
    ).withColumn("lsn", F.col("lsn").cast("decimal(20,0)"))
    small, large = D.decode_wal(raw), D.decode_wal(raw, broadcast_bytes=-1)
    assert sorted(small.changes.collect()) == sorted(large.changes.collect())


@pytest.mark.parametrize("block", [1, 3, 10, 1000])
def test_versions_change_inside_and_between_blocks(spark, block):
    """Two oids in two sessions, announced anew again and again, some asked for before they are announced."""
    rng, rows, wanted, names = random.Random(block), [], {}, {}
    for seq in range(200):
        session, oid = seq // 100, rng.choice([1, 2])
        if rng.random() < 0.2:
            names[session, oid] = f"t{seq}"
            rows.append((session, seq, seq, m.relation(oid, f"t{seq}", [("a", 25, True)])))
        else:
            wanted[seq] = names.get((session, oid))
            rows.append((session, seq, seq, m.insert(oid, ["x"])))
    raw = spark.createDataFrame(rows, "session_id long, seq long, lsn long, data binary").repartition(7)
    messages = D.classify(raw)
    versions = D.relation_versions(D.decode_relation(messages))
    inserts = messages.filter("msg_type = 'I'")
    for small in (True, False):
        found = D.resolve_relation(inserts, versions, small, block).select("seq", "table_name").collect()
        assert sorted(map(tuple, found)) == sorted(wanted.items()), small


def test_one_oid_in_all_messages_is_spread_over_the_tasks(spark):
    """Without a broadcast no task gets more than twice the median."""
    one = m.insert(1, ["x"])
    raw = spark.range(0, 40_000, 1, 4).select(
        F.lit(1).cast("bigint").alias("session_id"), F.col("id").alias("seq"), F.lit(0).cast("decimal(20,0)").alias("lsn"),
        F.when(F.col("id") == 0, F.lit(m.relation(1, "t", [("a", 25, True)]))).otherwise(F.lit(one)).alias("data"),
    )
    messages = D.classify(raw)
    versions = D.relation_versions(D.decode_relation(messages))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = D.resolve_relation(messages.filter("msg_type = 'I'"), versions, False, 100)
        assert rows.filter("table_name = 't'").count() == 39_999
        sizes = sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_schema_contract(spark):
    assert RAW_WAL.names == ["session_id", "seq", "lsn", "data"]
