"""Document quality by hierarchical empirical Bayes over sites.

A logistic classifier on figures of the text gives each document's own evidence. Hosts and the paths
on them have quality rates of their own: labelled documents count with their label, all others with
a small weight and the classifier's probability, summed by path and from the paths by host. The
spread of the rates between sites, beyond what their sizes explain, sets how strongly a site with
few documents is drawn to the level above it. A document's score is its own odds times the odds that
its path's posterior (without the document itself) adds to the global rate.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches
from ratingloom.llm.common import fold, saved

#: Weight of a document without a label in its site's rate.
UNLABELLED = 0.1
KEPT = 0.3
FEATURES = (
    "log_words", "word_length", "symbols", "capitals", "digits", "stutter", "variety", "open_lines", "repeated_lines", "separators", "exclamations",
)
_SYMBOL = re.compile(r"[#*$%&<>]")
_DIGIT = re.compile(r"\d")
_LETTER = re.compile(r"[^\W\d_]")
_END = re.compile(r"[.!?…。！？:;\"'”’»)\]]\s*$")


def figures(text: str | None) -> tuple[float, ...]:
    """The figures the classifier sees; an empty text has zeros."""
    words = (text or "").split()
    if not words:
        return (0.0,) * len(FEATURES)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = len(_LETTER.findall(text))
    capitals = sum(w.isupper() and len(w) > 2 for w in words)
    return (
        math.log1p(len(words)),
        min(chars / len(words), 30.0),
        len(_SYMBOL.findall(text)) / chars,
        capitals / len(words),
        len(_DIGIT.findall(text)) / max(1, letters),
        sum(a == b for a, b in zip(words, words[1:])) / len(words),
        math.log(len(set(words))) / math.log1p(len(words)),
        sum(not _END.search(x) for x in lines) / len(lines),
        1 - len(set(lines)) / len(lines),
        text.count("|") / len(words),
        text.count("!!") / len(words),
    )


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(inside / (1 - inside))


def _described(docs: DataFrame) -> DataFrame:
    def run(given: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in given:
            rows = [figures(t) for t in batch.column(0).to_pylist()]
            yield [*batch.columns[1:], *([list(c) for c in zip(*rows)] or [[] for _ in FEATURES])]

    front = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[1:]]
    return map_batches(docs, run, ", ".join(front) + "".join(f", {f} double" for f in FEATURES))


def _evidence(described: DataFrame) -> Column:
    """The classifier's log odds, from the labelled rows; without both labels their smoothed rate."""
    known = described.where("y is not null")
    count = known.agg(F.count("*").alias("n"), F.sum("y").alias("good")).first()
    n, good = count["n"], count["good"] or 0
    if not good or good == n:
        return F.lit(math.log((good + 0.5) / (n - good + 0.5)))
    frame = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known)
    model = LogisticRegression(featuresCol="x", labelCol="y", regParam=0.001, maxIter=60).fit(frame.select("x", "y"))
    terms = [F.col(f) * float(w) for f, w in zip(FEATURES, model.coefficients)]
    return sum(terms, F.lit(float(model.intercept)))


def _pull(rates: DataFrame, above: str, mean: float) -> float:
    """How many documents' worth a site is drawn to the level above: the rate's own variance over
    the variance between sites, by moments weighted with the sites' sizes."""
    rate = F.col("good") / F.col("n")
    m = rates.where("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(rate - F.col(above), 2)).alias("spread"),
        F.sum(F.col(above) * (1 - F.col(above))).alias("noise"),
    ).first()
    if not m["n"]:
        return 1.0
    between = max((m["spread"] - m["noise"]) / m["n"], 1e-6)
    return min(max(mean * (1 - mean) / between - 1, 0.5), 1e5)


def site_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: str | Column = "source", path: str | Column = "lang",
    label_id: str = "doc_id", label_col: str = "quality", folds: int = 4, held_out: int = 2,
) -> DataFrame:
    """A row per document: held_out, evidence (the classifier's probability), site_rate (posterior of
    its path), score and kept (score >= 0.3).

    Labels are learned outside the held-out fold only; an id with several labels counts with the
    best. Null hosts and paths are sites of their own, null and empty texts have figures of zero, and
    rows that repeat an id each get a row. Without labels all rates are one half.
    """
    as_column = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
    known = labels.select(F.col(label_id).alias("label_id"), F.col(label_col).cast("double").alias("y")).where("y in (0, 1)")
    known = known.groupBy("label_id").agg(F.max("y").alias("y"))
    given = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"), as_column(host).alias("host"), as_column(path).alias("path"))
    figured = _described(given.withColumn("held_out", fold("id", folds) == held_out))
    # figures are small rows: the labels meet them, not the texts
    labelled = figured.join(known, figured["id"] == known["label_id"], "left").drop("label_id")
    described = saved(labelled.withColumn("y", F.when(~F.col("held_out"), F.col("y"))), "described")

    scored = described.select("id", "host", "path", "held_out", "y", _evidence(described).alias("odds"))
    scored = scored.withColumn("p", 1 / (1 + F.exp(-F.col("odds"))))
    weight = F.when(F.col("y").isNotNull(), F.lit(1.0)).otherwise(F.lit(UNLABELLED))
    scored = scored.withColumn("w", weight).withColumn("g", F.col("w") * F.coalesce("y", "p"))

    paths = saved(scored.groupBy("host", "path").agg(F.sum("g").alias("good"), F.sum("w").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    total = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = min(max(total["good"] / total["n"], 1e-3), 1 - 1e-3) if total["n"] else 0.5
    host_pull = _pull(hosts.withColumn("above", F.lit(mean)), "above", mean)
    host_rates = hosts.select("host", ((F.col("good") + host_pull * mean) / (F.col("n") + host_pull)).alias("host_rate"))
    rates = paths.join(host_rates, "host")
    path_pull = _pull(rates, "host_rate", mean)

    own = (F.col("good") - F.col("g") + path_pull * F.col("host_rate")) / (F.col("n") - F.col("w") + path_pull)
    placed = scored.join(rates, ["host", "path"]).withColumn("site_rate", F.greatest(F.least(own, F.lit(1.0)), F.lit(0.0)))
    odds = F.col("odds") + _logit(F.col("site_rate")) - math.log(mean / (1 - mean))
    score = 1 / (1 + F.exp(-odds))
    return placed.select(F.col("id").alias(id_col), "held_out", F.col("p").alias("evidence"), "site_rate", score.alias("score"), (score >= KEPT).alias("kept"))
