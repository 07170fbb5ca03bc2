"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine over block-max indexes.

A bounded, documented sample of different labelled texts serves as examples. The terms compared are those
whose contexts (word before, word after) are significantly more frequent in toxic examples; contexts
are counted once however many copies hold them. Examples lie in blocks, and for each term and block
the index holds the largest weight; a text visits blocks in the order of their bounds and stops where
the next bound can't reach its k-th best similarity, so the neighbours are exact. Their votes,
weighted by similarity and by how the sample was drawn, pass an isotonic fit made on the examples,
each judged without itself. The neighbours' ids are the evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import fold, saved

#: Bound of the labelled sample: examples of each label.
EXAMPLES = 4_000
NEIGHBOURS = 15
BLOCK = 64
#: A term needs this many different contexts in toxic examples, this z score, and may not be in a
#: larger share of the examples that aren't toxic.
LEAST_CONTEXTS = 5
LEAST_Z = 5.0
MOST_COMMON = 0.2
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Index:
    """Examples as unit TF-IDF vectors, term by term, with the largest weight of each block."""

    def __init__(self, terms: dict[str, float], examples: list[tuple], k: int = NEIGHBOURS):
        """terms: idf; examples: (id, label, sampling weight, counts of terms)."""
        self.terms = {t: i for i, t in enumerate(sorted(terms))}
        self.idf = np.array([terms[t] for t in sorted(terms)])
        self.k = k
        vectors = [(e, *self.vector(e[3])) for e in examples]
        vectors = [v for v in vectors if len(v[1])]
        # examples with the same heaviest term share blocks
        vectors.sort(key=lambda v: (int(v[1][v[2].argmax()]), -float(v[2].max()), str(v[0][0])))
        self.ids = [v[0][0] for v in vectors]
        self.label = np.array([v[0][1] for v in vectors], float)
        self.weight = np.array([v[0][2] for v in vectors], float)
        blocks = -(-len(vectors) // BLOCK)
        term = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0, np.int64)
        value = np.concatenate([v[2] for v in vectors]) if vectors else np.zeros(0)
        owner = np.repeat(np.arange(len(vectors)), [len(v[1]) for v in vectors])
        order = np.lexsort((owner, term))
        self.owner, self.value = owner[order], value[order]
        self.bounds = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.most = np.zeros((len(self.terms), blocks))
        np.maximum.at(self.most, (term, owner // BLOCK), value)
        # rest: labels of examples without a term, for texts without one
        none = [e for e in examples if not e[3]]
        total = sum(e[2] for e in none)
        self.base = (sum(e[1] * e[2] for e in none) + 0.01) / (total + 1)

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(sorted(self.terms[t] for t in counts), np.int64)
        if not len(at):
            return at, np.zeros(0)
        by = {self.terms[t]: n for t, n in counts.items()}
        value = np.array([1 + np.log(by[i]) for i in at.tolist()]) * self.idf[at]
        return at, value / np.sqrt((value ** 2).sum())

    def nearest(self, counts: dict[str, int], without: object = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and similarities of the k nearest examples, ties by position."""
        at, value = self.vector(counts)
        if not len(at) or not self.ids:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = value @ self.most[at]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == self.k and bound[b] < best[-1] - 1e-12:
                break
            score = np.zeros(BLOCK)
            for i, x in zip(at.tolist(), value.tolist()):
                if self.most[i, b]:
                    lo, hi = self.bounds[i], self.bounds[i + 1]
                    a, z = lo + np.searchsorted(self.owner[lo:hi], [b * BLOCK, (b + 1) * BLOCK])
                    score[self.owner[a:z] - b * BLOCK] += x * self.value[a:z]
            some = np.flatnonzero(score > 0) + b * BLOCK
            if without is not None:
                some = np.array([s for s in some if self.ids[s] != without], np.int64)
            best_at, best = np.append(best_at, some).astype(np.int64), np.append(best, score[some - b * BLOCK])
            keep = np.lexsort((best_at, -np.round(best, 12)))[:self.k]
            best_at, best = best_at[keep], best[keep]
        return best_at, best

    def vote(self, counts: dict[str, int], without: object = None) -> tuple[float, np.ndarray, np.ndarray]:
        at, near = self.nearest(counts, without)
        if not len(at):
            return self.base, at, near
        weight = near ** 2 * self.weight[at]
        return float((weight * self.label[at]).sum() / weight.sum()), at, near

    def counts(self, text: str | None) -> dict[str, int]:
        return Counter(w for w in words(text) if w in self.terms)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the best rising fit: values of x and what they stand for (pool adjacent violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist()):
        pools.append([a, b * c, c])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
            last = pools.pop()
            pools[-1] = [last[0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _examples(docs: DataFrame, labels: DataFrame, held_out: int, folds: int, most: int) -> tuple[DataFrame, dict[int, float]]:
    """The sample's texts and, by label, how many different labelled texts each of them stands for.

    Equal texts are one, under the smallest id and the label most of their rows have.
    """
    known = labels.where("toxic is not null and doc_id is not null and toxic in (0, 1)").where(fold("doc_id", folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    own = docs.select("doc_id", F.xxhash64("text").alias("h")).join(known, "doc_id")
    different = own.groupBy("h").agg(F.min("doc_id").alias("doc_id"), (F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    different = saved(different, "labelled-texts")
    first = [different.where(F.col("toxic") == t).orderBy(F.xxhash64("h"), "h").limit(most) for t in (0, 1)]
    picked = F.broadcast(first[0].unionByName(first[1]))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).join(picked, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    texts = saved(texts.select("doc_id", "text", "toxic"), "examples")
    total = {r["toxic"]: r["count"] for r in different.groupBy("toxic").count().collect()}
    used = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    return texts, {t: total[t] / n for t, n in used.items()}


def _terms(texts: DataFrame, weight: dict[int, float]) -> dict[str, float]:
    """The terms that mark toxic examples, with their inverse document frequency; examples count as
    many texts as they stand for. The sample bounds their number, nothing else does."""
    used = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n = sum(weight[t] * k for t, k in used.items())

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = words(text)
                if not own:
                    continue
                around = sorted(set(zip(own, [""] + own[:-1], own[1:] + [""])))
                seen: set[str] = set()
                first = [0 if t in seen else seen.add(t) or 1 for t, _, _ in around]
                yield [[t for t, _, _ in around], [f"{a} {b}" for _, a, b in around], [toxic] * len(around), first]

    found = map_batches(texts.select("text", "toxic"), run, "term string, around string, toxic int, first int")
    contexts = found.groupBy("term", "around").agg(
        F.max("toxic").alias("toxic"), F.min("toxic").alias("low"), F.sum(F.col("first") * F.col("toxic")).alias("marked"), F.sum(F.col("first") * (1 - F.col("toxic"))).alias("plain"),
    )
    stats = contexts.groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum(1 - F.col("low")).alias("b"), F.sum("marked").alias("marked"), F.sum("plain").alias("plain"),
    )
    stats = saved(stats, "terms")
    total = stats.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total or not total["a"] or not total["b"]:
        return {}
    share = (F.col("a") + F.col("b")) / (total["a"] + total["b"])
    z = (F.col("a") / total["a"] - F.col("b") / total["b"]) / F.sqrt(share * (1 - share) * (1 / total["a"] + 1 / total["b"]))
    chosen = stats.withColumn("z", z).where((F.col("a") >= LEAST_CONTEXTS) & (F.col("z") >= LEAST_Z) & (F.col("plain") <= max(MOST_COMMON * used.get(0, 0), LEAST_CONTEXTS)))
    rows = chosen.select("term", "marked", "plain").collect()
    df = [weight.get(1, 0) * r["marked"] + weight.get(0, 0) * r["plain"] for r in rows]
    return {r["term"]: float(np.log((1 + n) / (1 + d)) + 0.01) for r, d in zip(rows, df)}


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, examples: int = EXAMPLES) -> tuple[Index, np.ndarray, np.ndarray]:
    """Index and calibration, from labelled rows outside the held-out fold. At most ``examples`` different
    texts of each label are used, and all terms in them that mark toxic ones."""
    texts, weight = _examples(docs, labels, held_out, folds, examples)
    terms = _terms(texts, weight)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            counts = [Counter(w for w in words(t) if w in terms) for t in batch.column(1).to_pylist()]
            yield [batch.column(0), batch.column(2), [sorted(c) for c in counts], [[c[t] for t in sorted(c)] for c in counts]]

    rows = map_batches(texts.select("doc_id", "text", "toxic"), run, f"id {dict(docs.dtypes)['doc_id']}, toxic int, terms array<string>, counts array<int>").collect()
    found = [(r["id"], r["toxic"], weight[r["toxic"]], dict(zip(r["terms"], r["counts"]))) for r in rows]
    index = Index(terms, found)
    judged = [(index.vote(e[3], without=e[0])[0], e[1], e[2]) for e in found if e[3]]
    if not judged:
        return index, np.array([0.0, 1.0]), np.array([0.0, 1.0])
    x, y, w = map(np.array, zip(*judged))
    # a rare label's few examples shouldn't make a step of 0 or 1
    steps, values = isotonic(x.astype(float), y.astype(float), w.astype(float))
    return index, steps, np.clip(values, 0.001, 0.999)


def score(docs: DataFrame, model: tuple[Index, np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """A row per document: score between 0 and 1, predicted (score >= 0.3), evidence ids and their
    similarities. Null texts, empty ones and ones without a term get the base rate of such examples;
    without labelled rows every score is near 0."""
    keep = keep or []
    sent = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.col(text_col).alias("text__"), F.col(id_col), *keep)
    front = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[1:]]
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        index, steps, values = sent.value
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                counts = index.counts(text)
                vote, at, near = index.vote(counts)
                s = float(np.interp(vote, steps, values)) if counts else vote
                s = min(1.0, max(0.0, s))
                rows.append((s, int(s >= THRESHOLD), [index.ids[k] for k in at], near.tolist()))
            yield [*batch.columns[1:], *([list(c) for c in zip(*rows)] or [[], [], [], []])]

    return map_batches(given, run, ", ".join(front) + f", score double, predicted int, evidence array<{kind}>, similarity array<double>")
