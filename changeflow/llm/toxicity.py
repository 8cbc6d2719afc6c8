"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The terms are words and the first bytes of words, each from 1, 2, 4 and 8 occurrences on, whose share
of examples differs between the labels beyond chance (a likelihood ratio, which holds for rare terms
too). Their document frequencies are counted over all documents. Examples lie in blocks; the index keeps the largest
weight of each term in each block, so a block whose bound is below the k-th best similarity found is
never scored, and the neighbours are still the exact ones. Neighbours vote with their similarity;
votes become probabilities by a curve fitted on the examples, each left out of its own vote.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow
from changeflow.session import scratch_path, settle

#: Bounds of the fit: examples of each label, terms, and neighbours asked.
EXAMPLES = 2000
TERMS = 4096
NEIGHBOURS = 15
#: Twice the log likelihood ratio from which a term's share differs between the labels.
BEYOND_CHANCE = 25.0
#: Terms are whole words and their first bytes, from so many occurrences in a text on.
STARTS = (4, 5, 6, 8)
LEVELS = (1, 2, 4, 8)
BLOCK = 64
EVIDENCE = 3


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo `of`."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.encode(column.cast("string"), "UTF-8")), F.lit(of))


@dataclass
class Model:
    """`terms` sorted, with the `levels` of each; `weights` (examples x terms) are unit rows in the
    order of the blocks."""

    terms: np.ndarray
    levels: np.ndarray
    idf: np.ndarray
    weights: np.ndarray
    labels: np.ndarray
    share: np.ndarray
    ids: np.ndarray
    none: float
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self):
        n = len(self.ids)
        self.edges = np.arange(0, n + BLOCK, BLOCK).clip(max=n) if n else np.zeros(1, int)
        blocks = list(zip(self.edges[:-1], self.edges[1:]))
        self.blocks = [(a, b) for a, b in blocks if b > a]
        # The inverted index: for each block its terms, and the weights of those terms only.
        self.postings = []
        self.most = np.zeros((len(self.terms), len(self.blocks)), dtype=np.float32)
        for j, (a, b) in enumerate(self.blocks):
            part = self.weights[a:b]
            terms = np.flatnonzero(part.any(axis=0))
            self.postings.append((terms, np.ascontiguousarray(part[:, terms].T)))
            self.most[:, j] = part.max(axis=0)

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and places of the k nearest examples of each unit row, by falling similarity
        and then place; -1 where there are fewer with a similarity above zero."""
        n = len(queries)
        best = np.zeros((n, k), dtype=np.float32)
        place = np.full((n, k), -1, dtype=np.int64)
        if not n or not self.blocks:
            return best, place
        bound = queries @ self.most
        order = np.argsort(-bound, axis=1, kind="stable")
        active = np.arange(n)
        for turn in range(len(self.blocks)):
            block = order[active, turn]
            # Equal bounds are scored too, so that ties fall by place; the margin is for rounding.
            open_ = (bound[active, block] > 0) & (bound[active, block] * 1.00001 >= best[active, -1])
            active, block = active[open_], block[open_]
            if not len(active):
                break
            by = np.argsort(block, kind="stable")
            for rows in np.split(active[by], np.flatnonzero(np.diff(block[by])) + 1):
                j = order[rows[0], turn]
                terms, weights = self.postings[j]
                scores = queries[np.ix_(rows, terms)] @ weights
                places = np.broadcast_to(np.arange(*self.blocks[j]), scores.shape)
                all_s = np.concatenate((best[rows], scores), axis=1)
                all_p = np.concatenate((place[rows], np.where(scores > 0, places, -1)), axis=1)
                all_s = np.where(all_p >= 0, all_s, 0)
                sort = np.lexsort((np.where(all_p < 0, 1 << 60, all_p), -all_s), axis=1)[:, :k]
                best[rows], place[rows] = np.take_along_axis(all_s, sort, 1), np.take_along_axis(all_p, sort, 1)
        return best, place

    def votes(self, best: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Share of the toxic among the neighbours' weights; an example counts as many as it stands for."""
        weight = best * self.share[place] * (place >= 0)
        total = weight.sum(axis=1)
        return np.where(total > 0, (weight * self.labels[place]).sum(axis=1) / np.where(total > 0, total, 1), np.nan)

    def probability(self, votes: np.ndarray) -> np.ndarray:
        known = 1 / (1 + np.exp(-(self.slope * (2 * np.nan_to_num(votes) - 1) + self.shift)))
        return np.where(np.isnan(votes), self.none, known)

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that have a term, and their unit rows."""
        doc, term, count = term_counts(self.terms, self.levels, data, offsets)
        used, row = np.unique(doc, return_inverse=True)
        out = np.zeros((len(used), len(self.terms)), dtype=np.float32)
        out[row, term] = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return used, out / np.where(norm > 0, norm, 1)


def word_terms(words: arrow.Words) -> list[np.ndarray]:
    """The terms of each word, one array for each kind."""
    return [words.hashes] + [words.starts(n) for n in STARTS]


def term_counts(terms: np.ndarray, levels: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    """(text, place in the sorted `terms`, occurrences) where the occurrences reach the term's level."""
    words = arrow.words(data, offsets, arrow.LETTERS)
    if not len(terms) or not len(words.hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    single, first, many = np.unique(terms, return_index=True, return_counts=True)
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[single & np.uint64(0xFFFF)] = True
    doc, keys = words.doc(), []
    for found in word_terms(words):
        hit = np.flatnonzero(maybe[found & np.uint64(0xFFFF)])
        at = np.searchsorted(single, found[hit]).clip(max=len(single) - 1)
        same = single[at] == found[hit]
        keys.append(doc[hit[same]] * len(single) + at[same])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    doc, at = key // len(single), key % len(single)
    n = many[at]
    place = np.repeat(first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc, count = np.repeat(doc, n), np.repeat(count, n)
    reached = count >= levels[place]
    return doc[reached], place[reached], count[reached]


def _example_terms(examples: DataFrame) -> DataFrame:
    """Each example's terms and the levels they reach."""

    def find(batches):
        for batch in batches:
            labels = batch.column(0).to_numpy()
            data, offsets = arrow.texts(batch.column(1), lower=True)
            for low, high in arrow.groups(offsets):
                words = arrow.words(data, offsets[low : high + 1], arrow.LETTERS)
                doc = words.doc()
                for found in word_terms(words):
                    order = np.lexsort((found, doc))
                    own, term = doc[order], found[order]
                    new = np.ones(len(own), dtype=bool)
                    new[1:] = (own[1:] != own[:-1]) | (term[1:] != term[:-1])
                    new = np.flatnonzero(new)
                    n = np.diff(np.append(new, len(own)))
                    for level in LEVELS:
                        at = new[n >= level]
                        columns = [labels[low + own[at]], arrow.signed(term[at]), np.full(len(at), level, np.int32)]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["label", "term", "level"])

    return examples.select("label", "text").mapInArrow(find, "label int, term long, level int")


def _example_vectors(examples: DataFrame, terms: np.ndarray, levels: np.ndarray) -> DataFrame:
    def find(batches):
        for batch in batches:
            data, offsets = arrow.texts(batch.column(1), lower=True)
            for low, high in arrow.groups(offsets):
                doc, place, n = term_counts(terms, levels, data, offsets[low : high + 1])
                columns = [batch.column(0).take(pa.array(low + doc)), pa.array(place.astype(np.int32)), pa.array(n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "n"])

    return examples.select("doc_id", "text").mapInArrow(find, "doc_id long, place int, n int")


def _frequencies(docs: DataFrame, terms: np.ndarray, levels: np.ndarray) -> DataFrame:
    """Documents that each term is in, over all rows; term -1 counts the documents."""

    def count(batches):
        total = np.zeros(len(terms), dtype=np.int64)
        rows = 0
        for batch in batches:
            data, offsets = arrow.texts(batch.column(0), lower=True)
            rows += len(batch)
            for low, high in arrow.groups(offsets):
                total += np.bincount(term_counts(terms, levels, data, offsets[low : high + 1])[1], minlength=len(terms))
        found = np.flatnonzero(total)
        columns = [pa.array(np.concatenate(([-1], found))), pa.array(np.concatenate(([rows], total[found])))]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES) -> Model:
    """The model from at most `examples` rows of each label, taken by a hash of the id; `labels` has
    `doc_id` and the label and holds only rows to learn from. What comes to the driver is bounded by
    examples x terms; frequencies are counted over all of `docs`."""
    spark = docs.sparkSession
    arrow.ship(spark)
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = settle(known.filter("label in (0, 1)"), scratch_path(spark, "labels"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = [known.filter(f"label = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples) for y in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    # Rows of one id and several texts: one of them is the example.
    rows = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = settle(rows, scratch_path(spark, "examples"))

    every = rows.select("doc_id", "label").toArrow()
    n = [int((every.column("label").to_numpy() == y).sum()) for y in (0, 1)]
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if not all(n):
        return _without_terms(share)
    seen = [F.count_if(F.col("label") == y).alias(f"n{y}") for y in (0, 1)]
    counts = _example_terms(rows).groupBy("term", "level").agg(*seen)
    chosen = counts.withColumn("ratio", _ratio(n)).filter(f"ratio >= {BEYOND_CHANCE}")
    chosen = sorted((r["term"] % (1 << 64), r["level"]) for r in chosen.orderBy(F.desc("ratio"), "term", "level").limit(TERMS).collect())
    if not chosen:
        return _without_terms(share)
    terms = np.array([t for t, _ in chosen], dtype=np.uint64)
    levels = np.array([level for _, level in chosen], dtype=np.int64)
    seen = {r["term"]: r["n"] for r in _frequencies(texts, terms, levels).collect()}
    df = np.array([seen.get(i, 0) for i in range(len(terms))], dtype=np.float64)
    idf = np.log((1 + seen.get(-1, 0)) / (1 + df)).clip(min=1e-6).astype(np.float32)
    vectors = _example_vectors(rows, terms, levels).toArrow()
    return _model(terms, levels, idf, every, vectors, sizes, n)


def _ratio(n: list[int]) -> Column:
    """Twice the log likelihood ratio of a term's examples in both labels against one common share."""
    part = lambda k, of: F.when(k > 0, k * F.log(k / of)).otherwise(0.0)
    whole = F.col("n0") + F.col("n1")
    cells = [(F.col(f"n{y}"), n[y]) for y in (0, 1)]
    own = sum(part(k, F.lit(m)) + part(m - k, F.lit(m)) for k, m in cells)
    common = part(whole, F.lit(sum(n))) + part(sum(n) - whole, F.lit(sum(n)))
    return 2 * (own - common)


def _without_terms(share: float) -> Model:
    none = np.zeros(0, np.int64)
    return Model(none.view(np.uint64), none, none.astype(np.float32), np.zeros((0, 0), np.float32), none, none, none, share)


def _model(terms, levels, idf, every, vectors, sizes, n) -> Model:
    ids = every.column("doc_id").to_numpy()
    order = np.argsort(ids)
    ids, labels = ids[order], every.column("label").to_numpy()[order]
    row = np.searchsorted(ids, vectors.column("doc_id").to_numpy())
    at = vectors.column("place").to_numpy()
    weights = np.zeros((len(ids), len(terms)), dtype=np.float32)
    weights[row, at] = (1 + np.log(vectors.column("n").to_numpy())) * idf[at]
    norm = np.sqrt((weights * weights).sum(axis=1))
    share = np.array([sizes[y] / n[y] for y in (0, 1)])[labels]
    # Examples without a term are nobody's neighbour; they tell how toxic a text without terms is.
    bare = norm == 0
    none = float((share * labels)[bare].sum() / (share[bare].sum() + 1))
    ids, labels, share, weights = (x[~bare] for x in (ids, labels, share, weights))
    weights = weights / norm[~bare][:, None]
    # Blocks of examples that share their strongest term have tight bounds.
    order = np.lexsort((ids, labels, weights.max(axis=1, initial=0), weights.argmax(axis=1) if len(ids) else labels))
    model = Model(terms, levels, idf, weights[order], labels[order], share[order], ids[order], none)
    best, place = model.nearest(model.weights, NEIGHBOURS + 1)
    own = place == np.arange(len(place))[:, None]
    lost = ~own.any(axis=1)  # among many equal ones; then the last is left out instead
    own[lost, -1] = True
    k = place.shape[1] - 1
    votes = model.votes(best[~own].reshape(-1, k), place[~own].reshape(-1, k))
    model.slope, model.shift = _curve(votes, model.labels, model.share)
    return model


def _curve(votes: np.ndarray, labels: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """Logistic curve from votes to labels, by Newton's method with a slight pull to slope 4."""
    good = ~np.isnan(votes)
    x, y, w = 2 * votes[good] - 1, labels[good], share[good]
    b = np.array([4.0, 0.0])
    design = np.stack((x, np.ones(len(x))), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ b))
        pull = np.array([b[0] - 4.0, b[1]])
        gradient = design.T @ (w * (p - y)) + pull
        step = np.linalg.solve((design * (w * p * (1 - p))[:, None]).T @ design + np.eye(2), gradient)
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `score`, the probability of label 1, `predicted` (1 from 0.5 on) and
    `evidence`, the nearest examples with similarity and label.

    Null and empty texts have no terms and get the rate of such examples; so does every text if the
    labels told nothing. Null ids and repeated rows are scored like any row, an empty table gives no
    rows, other columns are not read, and a very long text is scored whole.
    """
    spark = docs.sparkSession
    arrow.ship(spark)
    rows = arrow.renamed(docs, doc_id=doc_id, text=text)
    sent = spark.sparkContext.broadcast(model)
    evidence_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float32()), ("toxic", pa.int32())]))

    def find(batches):
        model = sent.value
        for batch in batches:
            scores = np.full(len(batch), model.none)
            evidence: list = [[] for _ in range(len(batch))]
            for used, found, best, place in _scored(model, batch.column(1)):
                scores[used] = found
                for row, s, p in zip(used.tolist(), best[:, :EVIDENCE].tolist(), place[:, :EVIDENCE].tolist()):
                    evidence[row] = [
                        {"doc_id": int(model.ids[j]), "similarity": x, "toxic": int(model.labels[j])} for x, j in zip(s, p) if j >= 0
                    ]
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(evidence, evidence_type)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted", "evidence"])

    kind = dict(rows.dtypes)["doc_id"]
    ddl = f"doc_id {kind}, score double, predicted int, evidence array<struct<doc_id:long,similarity:float,toxic:int>>"
    return rows.mapInArrow(find, ddl)




def _scored(model: Model, texts: pa.Array):
    """Rows that have terms, their scores, similarities and neighbours, by groups of texts."""
    data, offsets = arrow.texts(texts, lower=True)
    for low, high in arrow.groups(offsets):
        used, vectors = model.vectors(data, offsets[low : high + 1])
        best, place = model.nearest(vectors, NEIGHBOURS)
        yield low + used, model.probability(model.votes(best, place)), best, place


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns as they are, whose text is not predicted as toxic."""
    spark = docs.sparkSession
    arrow.ship(spark)
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(batches):
        model = sent.value
        for batch in batches:
            scores = np.full(len(batch), model.none)
            for used, found, _, _ in _scored(model, batch.column(at)):
                scores[used] = found
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(keep, docs.schema)
