"""Registered queries of the operators, with SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import bpe, language, leaks, mixing, nearcopies, quality, shards, spots, substrings, tokens, toxicity, trie, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query("op2_benchmark_leaks")
def benchmark_leaks(spark, sf_dir):
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("t")


@query("op3_substring_dedup")
def substring_dedup(spark, sf_dir):
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


@query("op4_quality")
def quality_scores(spark, sf_dir):
    """Labels of a third of the ids are never looked at."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(toxicity.remainder("doc_id", 3) != 1)
    network, share = quality.fit(docs, labels.select("doc_id", "quality"))
    held_out = F.coalesce(toxicity.remainder("doc_id", 3) == 1, F.lit(False))
    return quality.score(docs, network, share).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op5_loss_difference")
def loss_difference(spark, sf_dir):
    """Target: the documents labelled as good; background: all documents."""
    docs = table(spark, sf_dir, "documents")
    good = language.target_ids(table(spark, sf_dir, "labels").filter("quality = 1"))
    return language.score(docs, language.fit(docs, good), good)


@query("op6_near_copies")
def near_copies(spark, sf_dir):
    return nearcopies.near_copies(table(spark, sf_dir, "documents")).drop("node", "class_of")


@query("op7_spot_signatures")
def spot_signatures(spark, sf_dir):
    return spots.against_next(table(spark, sf_dir, "documents"))


@query("op8_hilbert_shards")
def hilbert_shards(spark, sf_dir):
    placed = shards.hilbert_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def toxicity_model(spark, docs, sf_dir):
    """Labels of a fifth of the ids are never looked at."""
    labels = table(spark, sf_dir, "labels").filter(toxicity.remainder("doc_id", 5) != 0)
    return toxicity.fit(docs, labels.select("doc_id", "toxic"))


@query("op9_toxicity")
def toxic_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    held_out = F.coalesce(toxicity.remainder("doc_id", 5) == 0, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


@query("op10_source_mix")
def source_mix(spark, sf_dir):
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


@query("op11_whitening")
def whitened_vectors(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_byte_bpe")
def byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query(
    "op13_prefix_trie",
    """
    with given as (
        select conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') as said,
               length(coalesce(text, '')) as size
        from conversations where conv_id is not null
    ), own as (
        select conv_id, md5(said) as key, size,
               row_number() over (partition by conv_id order by turn nulls first, md5(said)) as place
        from given
    ), convs as (
        select conv_id as c, conv_id - conv_id % 100 as head, xor(list_reduce(
            list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::ubigint),
            lambda crc, byte: list_reduce(
                [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[],
                lambda s, k: case when s % 2 = 1 then xor(s >> 1, 3988292384::ubigint) else s >> 1 end,
                xor(crc, byte)
            ), 4294967295::ubigint), 4294967295::ubigint) % 6 as h
        from (select distinct conv_id from given)
    ), turns as (
        select c, 0 as part, place, key, size from convs join own on own.conv_id = head where place <= h
        union all select c, 1, place, key, size from convs join own on own.conv_id = c where place > h
    ), placed as (
        select c, key, size, row_number() over (partition by c order by part, place) as d from turns
    ), members as (
        select c, d, size, string_agg(key, '') over (partition by c order by d) as path from placed
        union all select c, 0, 0, '' from convs
    ), nodes as (
        select path, d, min(c) as conv_id, count(*) as n, any_value(size) as size from members group by all
    ), deepest as (
        select c, max(d) as d from members group by c
    ), ends as (
        select path, string_agg(c::varchar, ',' order by c) as ids from members join deepest using (c, d) group by path
    ), children as (
        select path[:32 * (d - 1)] as path, count(*) as n from nodes where d > 0 group by all
    ), above as (
        select path, n, size, d, unnest(range(d + 1)) as k from nodes
    ), below as (
        select path[:32 * k] as path, sum((n - 1) * size) as saved, count(*) filter (not exists (
            select 1 from children where children.path = above.path)) as leaves
        from above group by all
    )
    select nodes.conv_id, nodes.d::bigint as depth, up.conv_id as parent_conv_id, nodes.n as n_convs,
           coalesce(children.n, 0) as n_children, leaves as n_leaves, saved::bigint as saved_tokens,
           sha256(coalesce(ids, '')) as ends_sha256
    from nodes join below using (path) left join children using (path) left join ends using (path)
    left join nodes up on nodes.d > 0 and up.path = nodes.path[:32 * (nodes.d - 1)]
    """,
)
def prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))
