"""From raw documents to packed sequences: every stage is one corpus operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import langid, ngram_join, packing, suffix_dedup, tiling
from ratingloom.llm.common import saved
from ratingloom.llm.tokens import public_path

#: Passages of over fifty words go where they stand more than once.
REPEATED_WORDS = 51


def packed_columns(docs: DataFrame, *shown: str) -> DataFrame:
    """``docs`` with all columns but the shown ones in one, so that no name clashes."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in shown]
    return docs.select(*shown, F.struct(*rest, F.lit(0).alias("rest__")).alias("rest__"))


def unpacked_columns(table: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again, with the changed ones."""
    columns = {c: F.col(c) if c in table.columns and c in ("doc_id", "text") else F.col(f"rest__.`{c}`") for c in docs.columns}
    return table.select(*[changed.get(c, column).alias(c) for c, column in columns.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without a letter, so without a language, go, and a document
    without ``lang`` gets the predicted one. If no language was learned, all with a letter stay."""
    samples = langid.language_samples(docs)
    if not samples:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    judged = langid.identify(packed_columns(docs, "doc_id", "text"), samples, keep=["text", "rest__"])
    judged = judged.where(F.col("lang_pred") != langid.UNDETERMINED)
    return unpacked_columns(judged, docs, lang=F.coalesce("rest__.lang", "lang_pred"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles: the first. Rows
    that repeat its id stay if their texts differ."""
    found = ngram_join.near_duplicates(docs, width=5, percent=80)
    first = found.where("component_id is null or component_id = doc_id").select("doc_id").distinct()
    kept = docs.join(first.where("doc_id is not null"), "doc_id", "left_semi")
    kept = packed_columns(kept, "doc_id", "text").groupBy("doc_id", "text").agg(F.min("rest__").alias("rest__"))
    return unpacked_columns(kept, docs).unionByName(docs.where("doc_id is null")).select(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of words that stand elsewhere too; a document with nothing else goes."""
    found = suffix_dedup.deduplicate(packed_columns(docs, "doc_id", "text"), length=REPEATED_WORDS, unit="words", with_text=True, keep=["rest__"])
    left = found.where((F.col("n_removed") == 0) | (F.trim("kept") != ""))
    return unpacked_columns(left, docs, text=F.col("kept"), n_chars=F.length("kept").cast("bigint"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    leaks = tiling.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(saved(leaks.select("doc_id").distinct(), "leaks"), "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: the pieces of documents, where they lie, and their ids."""
    return packing.pack(docs, public_path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: No stage but the first parts of some can be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
