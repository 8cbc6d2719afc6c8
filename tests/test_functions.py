import json

import pytest
from pyspark.sql import functions as F

from changeflow.functions import scalars as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text,number",
    [("0/0", 0), ("1A/2B3C4D5E", 0x1A2B3C4D5E), ("FFFFFFFF/FFFFFFFF", 2**64 - 1), ("0/00000001", 1), ("80000000/0", 2**63)],
)
def test_positions(spark, text, number):
    assert int(value(spark, S.lsn_to_int(F.lit(text)))) == number
    back = value(spark, S.lsn_to_text(F.lit(str(number)).cast("decimal(20,0)")))
    assert back == f"{number >> 32:X}/{number & 0xFFFFFFFF:08X}"


@pytest.mark.parametrize("name,target", [("id", "ID"), ("tenantId", "TENANT_ID"), ("HTTPServer2Id", "HTTPSERVER2ID"), ("plan_id", "PLAN_ID"), ("aBcD", "A_BC_D")])
def test_names(spark, name, target):
    assert S.upper_snake_name(name) == target
    assert value(spark, S.upper_snake(F.lit(name))) == target


@pytest.mark.parametrize("us,ms", [(0, 946684800000), (1999, 946684800001), (-1, 946684799999), (-946684800000001, 0)])
def test_times(spark, us, ms):
    assert value(spark, S.pg_micros_to_ms(F.lit(us).cast("bigint"))) == ms


def test_time_text(spark):
    assert value(spark, S.ms_to_text(F.lit(1704067207179).cast("bigint"))) == "2024-01-01 00:00:07.179000"


def test_time_out_of_range_is_null(spark):
    assert value(spark, S.pg_micros_to_ms(F.lit(2**63 - 1).cast("bigint"))) is None


def test_first_prefix_wins(spark):
    prefixes = {"a_": "first", "a_b_": "second"}
    assert value(spark, S.root_table(F.lit("a_b_1"), prefixes)) == "first"
    assert value(spark, S.root_table(F.lit("b_1"), prefixes)) == "b_1"


def test_json_text_keeps_null_fields(spark):
    doc = F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert json.loads(value(spark, S.json_text(doc, "struct<a:int,b:string>"))) == {"a": 1, "b": None}
    assert value(spark, S.json_text(F.lit("{x"), "string")) == "{x"


def test_bad_json(spark):
    assert value(spark, S.to_variant(F.lit("{x"), strict=False)) is None
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        value(spark, F.to_json(S.to_variant(F.lit("{x"))))


def test_labels(spark):
    rows = spark.createDataFrame([("c",), ("u",), ("d",), ("x",)], "op string")
    got = rows.select(S.op_label(F.col("op")), S.op_name(F.col("op"))).collect()
    assert [tuple(r) for r in got] == [("I", "insert"), ("U", "update"), ("D", "delete"), ("x", "x")]
