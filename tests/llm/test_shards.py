import zlib

from fixtures import awkward, documents, empty
from pyspark.sql import functions as F

from changeflow.llm import shards


def test_curve_visits_every_cell_and_moves_one_step(spark):
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = spark.range(side**dims).select(
            *[F.expr(f"(id div {side**k}) % {side}").alias(f"c{k}") for k in range(dims)]
        )
        names = cells.columns
        rows = cells.withColumn("h", shards.hilbert_index([F.col(c) for c in names], bits)).orderBy("h").collect()
        assert [r.h for r in rows] == list(range(side**dims))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[c] - b[c]) for c in names) == 1
        assert not any(rows[0][c] for c in names)


def test_order_of_string_prefixes(spark):
    names = ["", "a", "src1", "src10", "src2", "é", "zz"]
    rows = spark.createDataFrame([(n,) for n in names], "s string").select("s", shards.text_prefix("s").alias("n"))
    by_number = [r.s for r in rows.orderBy("n").collect()]
    assert by_number == sorted(names, key=lambda s: s.encode())


def test_runs_are_even_gapless_and_whole(spark):
    docs = documents(spark, clash=["shard", "_rank", "curve"])
    rows = shards.hilbert_shards(docs, 7, keep=["doc_id", "text"]).collect()
    given = awkward()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in given
    )
    slots = {k: sorted(r.slot for r in rows if r.shard == k) for k in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    along = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert along == sorted(along)


def test_fewer_rows_than_shards_and_none(spark):
    few = shards.hilbert_shards(documents(spark, awkward()[:3]), 24).collect()
    assert sorted(r.slot for r in few) == [0, 0, 0] and len({r.shard for r in few}) == 3
    assert shards.hilbert_shards(empty(spark), 24).count() == 0


def test_files_have_narrow_ranges(spark, tmp_path):
    rows = [(i, "w " * (1 + i * 37 % 400), "en", f"s{i % 20:02d}", None) for i in range(4000)]
    shards.write_shards(shards.hilbert_shards(documents(spark, rows), 64, keep=["doc_id", "source"]), str(tmp_path / "out"))
    files = spark.read.parquet(str(tmp_path / "out")).groupBy("shard").agg(
        F.min("source").alias("a"), F.max("source").alias("b"), F.min("size").alias("c"), F.max("size").alias("d")
    ).collect()
    by_source = sum(r.a <= "s07" <= r.b for r in files)
    by_size = sum(r.c <= 100 <= r.d for r in files)
    assert len(files) == 64 and by_source <= 32 and by_size <= 32


def test_no_python_in_the_plan(spark):
    plan = shards.hilbert_shards(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
