"""Small tables with the awkward cases every operator has to stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = (
    "lamp river stone cloud paper window garden bridge copper silver winter summer morning evening market "
    "valley harbor engine mirror basket candle forest island ladder magnet needle orange pepper rabbit saddle"
).split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward():
    """Null ids, texts, languages and sources; empty and very long texts; ties and repeated rows."""
    rows = [(i, prose(i, 20 + 13 * (i % 9)), ["en", "de"][i % 2], f"s{i % 4}") for i in range(40)]
    rows += [(40, "", "en", "s0"), (41, None, "en", "s1"), (42, " \n\t ", None, None), (43, "one", "en", None)]
    rows += [(44, prose(44, 6000), "en", "s0"), (None, prose(45, 30), "en", "s2"), (None, None, None, None)]
    rows += [(46, prose(46, 90), "en", "s3")] * 3 + [(46, prose(47, 90), "en", "s3")]
    rows += [(48 + i, "café 日本語 \U0001f642 " + prose(48, 60), "en", "s0") for i in range(12)]
    return [(i, t, l, s, len(t) if t is not None else None) for i, t, l, s in rows]


def documents(spark, rows=None, clash=()):
    """The rows as a table over several partitions, with extra columns of clashing names."""
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(5)
    for name in clash:
        df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
