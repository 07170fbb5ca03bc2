"""The corpus queries by name, each over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import (
    collisions, langid, lexical, line_rules, ngram_join, packing, site_quality, suffix_dedup, tiling, token_files, toxicity, whitening, wrappers,
)
from ratingloom.llm.common import fold
from ratingloom.llm.tokens import public_path
from ratingloom.workspace import fresh_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, folder, "documents"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    judged = toxicity.score(docs.withColumn("held_out", fold("doc_id", 4) == 2), model, keep=["held_out"])
    return judged.select("doc_id", "held_out", "score", "predicted", "evidence", "similarity")


def op4_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A document's host is its source; its path, as in the pages' URLs, the language section there."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return site_quality.site_quality(docs, labels, host="source", path=F.concat_ws("/", "source", "lang"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_path("byte_bpe_50k.json"))


def op6_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, folder, "pages"))


def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.judge(table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.held_out_languages(table(spark, folder, "documents"))


def op9_tiling(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of a document and a benchmark item it covers by half or more."""
    found = tiling.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_tiles", "longest_tile")


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = fresh_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), files, public_path("word_bpe_49k.json"))
    return token_files.read(spark, files, with_ids=False)


def op11_shared_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_collisions(spark: SparkSession, folder: str) -> DataFrame:
    return collisions.nearest(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op4_site_quality": op4_site_quality,
    "op5_packing": op5_packing,
    "op6_wrappers": op6_wrappers,
    "op7_line_rules": op7_line_rules,
    "op8_language_id": op8_language_id,
    "op9_tiling": op9_tiling,
    "op10_token_files": op10_token_files,
    "op11_shared_search": op11_shared_search,
    "op12_collisions": op12_collisions,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op11_shared_search": r"""
        with found as (
            select doc_id, row_number() over () as d, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9A-Za-z\x{80}-\x{10FFFF}]+') as words
            from documents),
        sized as (select doc_id, d, words, len(words)::bigint as n from found where len(words) > 0),
        totals as (select count(*)::bigint as nn, sum(n)::bigint as ll from sized),
        tf as (select d, term, count(*)::bigint as tf from (select d, unnest(words) as term from sized) group by d, term),
        wanted as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as term
            from benchmark),
        weight as (
            select term, floor(1000 * ln((2 * nn + 2)::double / (2 * count(*) + 1)::double))::bigint as w
            from tf, totals where term in (select term from wanted) group by term, nn),
        norm as (select d, doc_id, 10 + (90 * n * nn) // ll as m from sized, totals),
        scored as (
            select item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
            from wanted join weight using (term) join tf using (term) join norm using (d)
            group by item_id, doc_id, d),
        ranked as (
            select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
            from scored where score > 0)
        select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10
    """,
}
