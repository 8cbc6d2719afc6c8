import re
from collections import Counter

import corpus_pipeline
import pytest
from fixtures import awkward, documents, empty, prose
from test_nearcopies import classes

from changeflow.llm import queries


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Clean documents, near copies, rude ones and ones that hold an item of the benchmark."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, prose(i, 60 + i % 50), "en", f"s{i % 3}", None) for i in range(400)]
    rows = [(i, t + " muck grub muck" if i % 8 == 0 else t, *r) for i, t, *r in rows]
    rows += [(500 + i, rows[i][1] + " tail", "en", "s1", None) for i in range(1, 30) if i % 8]
    items = [(i, prose(9000 + i, 25)) for i in range(5)]
    rows += [(600 + i, f"{prose(700 + i, 40)} {items[i % 5][1]}", "en", "s2", None) for i in range(15)]
    rows = [(i, t, l, s, len(t)) for i, t, l, s, _ in rows]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, 1, int(i % 8 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_every_stage_takes_effect(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        kept[name] = docs
        assert name == "sharding" or docs.columns == columns
        if name in ("toxicity", "near_copies", "decontamination"):
            assert docs.exceptAll(before).isEmpty()
    ids = {name: sorted(r.doc_id for r in df.collect()) for name, df in kept.items()}
    assert ids["toxicity"] == [i for i in range(400) if i % 8] + [500 + i for i in range(1, 30) if i % 8] + [600 + i for i in range(15)]
    rows = [tuple(r) for r in kept["toxicity"].collect()]
    near = [r for r in rows if r[0] < 31 or r[0] >= 500]
    firsts = {i for i, c in classes(near).items() if i == c}
    assert [i for i in ids["near_copies"] if i < 31 or i >= 500] == sorted(firsts)
    assert [i for i in ids["near_copies"] if 31 <= i < 500] == [i for i in range(31, 400) if i % 8]
    assert ids["decontamination"] == [i for i in ids["near_copies"] if i < 600]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, mixed = Counter(), Counter()
    for r in kept["decontamination"].collect():
        sizes[r.source] += words(r.text)
    for r in kept["source_mix"].collect():
        mixed[r.source] += words(r.text)
    total = sum(sizes.values())
    assert abs(sum(mixed.values()) - 1.5 * total) <= 3 * 128 and all(mixed[s] <= 2 * sizes[s] for s in sizes)
    shards = Counter(r.shard for r in kept["sharding"].collect())
    assert set(shards) == set(range(24)) and max(shards.values()) - min(shards.values()) <= 1
    assert sum(shards.values()) == len(ids["source_mix"])


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_stand_awkward_and_empty_tables(spark, sf_dir):
    for docs in (documents(spark, awkward(), clash=["shard", "_row", "node"]), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert set(docs.columns) <= set(out.columns), name
            assert out.count() >= (0 if docs.isEmpty() else 20), name
