"""Keys whose third powers are larger than a bigint."""

import pytest
from pyspark.sql import functions as F

from changeflow.queries import QUERIES
from changeflow.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("shift,kind", [(0, "bigint"), (2_000_000, "bigint"), (9_000_000, "decimal(38,0)")])
def test_third_powers_are_exact(spark, shift, kind):
    place = scratch_path(spark, "keys")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").withColumn("o_orderkey", F.col("o_orderkey") + shift)
    orders.write.parquet(f"{place}/orders.parquet")
    result = QUERIES["b01_skewed_keys"].run(spark, place)
    assert dict(result.dtypes)["O_ORDERKEY"] == kind
    found = result.select("O_ORDERKEY", "even").collect()
    assert sorted(int(r["O_ORDERKEY"]) for r in found) == sorted(r["o_orderkey"] ** 3 for r in orders.select("o_orderkey").collect())
    assert all(r["even"] for r in found)
