"""Stages over all messages or changes are small enough for the JVM to compile: a method of more than 8,000 bytes
of bytecode is interpreted, row by row."""

import contextlib
import io
import re

import pytest

from changeflow.operators.changes import fold_changes, history_rows, image_values, mapped_only, split_bad, typed_changes
from changeflow.queries import changelog as C
from changeflow.session import settle

SF_DIR = "/root/testdata/sf0.001"
COMPILED = 8_000


def largest_method(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))


@pytest.fixture
def planned(spark):
    """Plans as they are, not as they are changed while they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("damaged", [False, True])
def test_messages(planned, damaged):
    assert largest_method(C.wal(planned, SF_DIR, damaged)) < COMPILED


def test_changes_and_history(planned):
    changes = mapped_only(settle(C.changelog(planned, SF_DIR)), C.SPECS)
    good, bad = split_bad(typed_changes(changes, C.EVENTS, False), C.EVENTS)
    for rows in (fold_changes(good, C.EVENTS.pk_targets), bad, history_rows(changes, C.EVENTS, False)):
        assert largest_method(rows) < COMPILED


def test_values_of_an_image_in_any_order(spark):
    value = "named_struct('name', '{0}', 'kind', 't', 'text', '{0}{1}', 'bin', cast(null as binary))"
    orders = ["ab", "ba", "xab", "abx", "b", "a", "x", ""]
    kind = "array<struct<name:string,kind:string,text:string,bin:binary>>"
    image = lambda i, o: f"cast(array({', '.join(value.format(c, i) for c in o)}) as {kind})"
    rows = " union all ".join(f"select {i} as i, {image(i, o)} as image" for i, o in enumerate(orders))
    picked = image_values(spark.sql(f"{rows} union all select 8, cast(null as {kind})"), "image", ["a", "b"], "_v_")
    found = {r["i"]: (r["a"], r["b"]) for r in picked.selectExpr("i", "_v_a.text as a", "_v_b.text as b").collect()}
    wanted = {i: tuple(f"{c}{i}" if c in o else None for c in "ab") for i, o in enumerate([*orders, ""])}
    assert found == wanted and picked.columns == ["i", "image", "_v_a", "_v_b"]
