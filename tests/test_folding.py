"""Folding and merging against a plain Python model on random change logs."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import changes as C
from changeflow.operators import merge as M
from changeflow.schema import CHANGE_DDL, TableSpec

SPEC = TableSpec(
    source="t",
    current="T",
    columns={"id": "bigint", "tenantId": "string", "a": "string", "b": "double", "doc": "variant"},
    pk=("id", "tenantId"),
    json=("doc",),
    prefixes=("t_",),
)
KEYS = SPEC.pk_targets
SHOWN = ["ID", "TENANT_ID", "A", "B", "DOC"]
U = object()  # unchanged


def cell(name, v):
    if v is U:
        return (name, "u", None, None)
    return (name, "n" if v is None else "t", v, None)


def image(values):
    return None if values is None else [cell(n, v) for n, v in zip(SPEC.columns, values)]


def event(seq, op, before, after, table="t"):
    return (op, "public", table, image(before), image(after), seq * 10, seq * 10 + 5, 1000 + seq, 1, seq)


def frame(spark, events):
    return spark.createDataFrame(
        [(*e[:5], e[5], e[6], *e[7:]) for e in events], CHANGE_DDL.replace("decimal(20,0)", "bigint")
    ).withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("lsn", "commit_lsn")})


def random_log(rng, n, hot=0.4):
    """Events with full, key-only or no old rows, unchanged values, deletes and moved keys.
    Returns them with the state after each one."""
    state, events, states = {}, [], []
    for seq in range(1, n + 1):
        key = ("1", "x") if rng.random() < hot else (str(rng.randint(1, 6)), rng.choice("xy"))
        a = rng.choice([None, "p", "q", "é" * 3])
        b = rng.choice([None, "1.5", "-2.0"])
        doc = rng.choice([None, '{"k":1}', "[1,2]"])
        kind = rng.random()
        if kind < 0.2 and key in state:
            full = rng.random() < 0.5
            old = [*key, *(state[key] if full else (None, None, None))]
            events.append(event(seq, "d", old, None))
            del state[key]
        elif kind < 0.3 and key in state:
            new_key = (str(rng.randint(10, 12)), key[1])
            old = [*key, *(state[key] if rng.random() < 0.5 else (None, None, None))]
            events.append(event(seq, "u", old, [*new_key, a, b, doc]))
            del state[key]
            state[new_key] = (a, b, doc)
        elif kind < 0.6 and key in state:
            had = state[key]
            # Only a value that is not NULL can be sent as unchanged.
            keep = [v is not None and rng.random() < 0.6 for v in had]
            sent = [U if k else v for k, v in zip(keep, (a, b, doc))]
            old = [*key, *had] if rng.random() < 0.3 else None
            events.append(event(seq, "u", old, [*key, *sent]))
            state[key] = tuple(h if k else v for k, h, v in zip(keep, had, (a, b, doc)))
        else:
            events.append(event(seq, "u" if key in state else "c", None, [*key, a, b, doc]))
            state[key] = (a, b, doc)
        states.append(dict(state))
    return events, states


def as_rows(state):
    return sorted(
        ((int(i), t, a, None if b is None else float(b), d) for (i, t), (a, b, d) in state.items()),
        key=str,
    )


def collected(df):
    rows = df.select("ID", "TENANT_ID", "A", "B", F.to_json("DOC").alias("DOC")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def net(spark, events, loaded="2024-01-01"):
    good, _ = C.split_bad(C.typed_changes(frame(spark, events), SPEC), SPEC)
    return C.stamp_loaded(C.fold_changes(good, KEYS), F.lit(loaded))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_batching_gives_the_same_state(spark, seed):
    rng = random.Random(seed)
    events, states = random_log(rng, 120)
    columns = [*SPEC.target_types, "_LOADED_AT"]
    whole = M.first_state(net(spark, events), columns)
    assert collected(whole) == as_rows(states[-1])
    cut = rng.randint(30, 90)
    first = M.first_state(net(spark, events[:cut]), columns)
    assert collected(first) == as_rows(states[cut - 1])
    for small in (False, True):
        both = M.apply_changes(first, net(spark, events[cut:]), KEYS, small=small)
        assert collected(both) == as_rows(states[-1])


def test_applying_a_batch_twice_changes_nothing(spark):
    events, states = random_log(random.Random(5), 60)
    once = M.first_state(net(spark, events), [*SPEC.target_types, "_LOADED_AT"])
    for small in (False, True):
        assert collected(M.apply_changes(once, net(spark, events), KEYS, small)) == as_rows(states[-1])


def test_input_order_and_partitions_do_not_matter(spark):
    events, states = random_log(random.Random(8), 80)
    for parts in (1, 16):
        rows = frame(spark, random.Random(parts).sample(events, len(events))).repartition(parts)
        good, _ = C.split_bad(C.typed_changes(rows, SPEC), SPEC)
        state = C.fold_changes(good, KEYS).filter("_OP <> 'D'")
        assert collected(state) == as_rows(states[-1])


def test_delete_then_insert_in_one_batch_leaves_the_row(spark):
    events = [
        event(1, "c", None, ["1", "x", "p", None, None]),
        event(2, "d", ["1", "x", None, None, None], None),
        event(3, "c", None, ["1", "x", "q", None, None]),
    ]
    assert collected(net(spark, events).filter("_OP <> 'D'")) == [(1, "x", "q", None, None)]


def test_unset_values_are_kept_from_the_target(spark):
    target = [event(1, "c", None, ["1", "x", "old", "1.0", '{"k":1}'])]
    state = M.first_state(net(spark, target), [*SPEC.target_types, "_LOADED_AT"])
    later = net(spark, [event(2, "u", None, ["1", "x", U, "2.0", U])], "2024-01-02")
    assert later.first()["_UNSET"] == ["A", "DOC"]
    for small in (False, True):
        out = M.apply_changes(state, later, KEYS, small=small)
        assert collected(out) == [(1, "x", "old", 2.0, '{"k":1}')]
        assert str(out.first()["_LOADED_AT"]).startswith("2024-01-02")


def test_null_keys_never_match(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b")], "k long, v string")
    joined = M.merge_join(rows, rows, ["k"])
    assert joined.count() == 3


def test_bad_rows_are_set_apart(spark):
    events = [
        event(1, "c", None, ["1", "x", "p", "oops", None]),
        event(2, "c", None, [None, "x", "p", "1", None]),
        event(3, "c", None, ["3", "x", "p", "1", "{broken"]),
        event(4, "d", None, None),
        event(5, "c", None, ["5", "x", "p", "1", None]),
    ]
    good, bad = C.split_bad(C.typed_changes(frame(spark, events), SPEC, strict=False), SPEC)
    assert [r["ID"] for r in good.collect()] == [5]
    reasons = {r["seq"]: r["error"] for r in bad.collect()}
    assert reasons == {
        1: "bad value in B",
        2: "key is null",
        3: "bad value in DOC",
        4: "key is null",
    }


def test_strict_mode_fails_the_batch(spark):
    rows = C.typed_changes(frame(spark, [event(1, "c", None, ["x", "x", None, None, None])]), SPEC)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows.collect()


def test_history_has_every_event_with_an_image(spark):
    events, _ = random_log(random.Random(3), 50)
    events.append(event(51, "u", None, None))
    events.append(event(52, "d", None, None))
    rows = C.history_rows(frame(spark, events), SPEC).collect()
    assert len(rows) == 50
    assert {r["_CDC_OP"] for r in rows} <= {"I", "U", "D"}


def test_replaying_history_gives_the_state(spark):
    """With full old rows and no unchanged values, the last history row per key is the state."""
    events = [
        e for e in random_log(random.Random(4), 80)[0]
        if e[0] == "d" or all(c[1] != "u" for c in e[4])
    ]
    events = [e for e in events if e[0] != "u" or e[3] is None or e[3][0][2] == e[4][0][2]]
    rows = C.history_rows(frame(spark, events), SPEC)
    last = C.latest_per_key(rows, KEYS, [F.col("_CDC_LSN").desc()]).filter("_CDC_OP <> 'D'")
    assert collected(last) == collected(net(spark, events).filter("_OP <> 'D'"))


def test_routing(spark):
    events = [event(i, "c", None, ["1", "x", None, None, None], t) for i, t in enumerate(["t", "t_p3", "t_archive", "other"])]
    rows = C.mapped_only(frame(spark, events), {"t": SPEC}).orderBy("seq").collect()
    assert [(r["seq"], r["table_name"]) for r in rows] == [(0, "t"), (1, "t"), (2, "t")]


def test_missing_and_surplus_columns(spark):
    short = ("c", "public", "t", None, [cell("id", "1"), cell("tenantId", "x"), cell("extra", "z")], 1, 1, 1, 1, 1)
    good, bad = C.split_bad(C.typed_changes(frame(spark, [short]), SPEC), SPEC)
    assert collected(good) == [(1, "x", None, None, None)] and bad.count() == 0
    assert good.first()["_UNSET"] == []


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """Both forms keep one row per key and task on the near side of the exchange."""
    good, _ = C.split_bad(C.typed_changes(frame(spark, random_log(random.Random(1), 5)[0]), SPEC), SPEC)
    fold = C.fold_changes(good, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in fold
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    window = C.latest_per_key(rows, ["k"], [F.col("id").desc()])
    assert "WindowGroupLimit" in window._jdf.queryExecution().executedPlan().toString()
