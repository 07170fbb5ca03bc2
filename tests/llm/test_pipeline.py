import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import conftest as samples


@pytest.fixture
def inputs(spark, tmp_path):
    """Documents of which each stage has something to do, and a benchmark."""
    item = samples.sentence(77, 40)
    texts = [samples.sentence(k, 60) + "\n" + samples.sentence(k + 500, 40) for k in range(20)]
    texts += ["12 34 %", None]  # 20, 21: no language
    texts += [texts[0], texts[1] + " once more"]  # 22, 23: copies
    shared = samples.sentence(900, 60)
    texts += [samples.sentence(k, 90) + mark + shared + mark + samples.sentence(k + 50, 90) for k, mark in ((300, " < "), (400, " > "))]  # 24, 25
    texts += [samples.sentence(600, 80) + " " + item + " " + samples.sentence(700, 30)]  # 26: leak
    rows = [(k, t, "xx" if k % 2 else "yy", "a", None if t is None else len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), texts, shared


def test_each_stage_does_its_part(spark, inputs):
    folder, texts, shared = inputs
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.saved(stage(spark, docs, folder), name)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = out
        kept[name] = {r.doc_id: r for r in docs.collect()}
    everything = set(range(len(texts)))
    assert set(kept["language_id"]) == everything - {20, 21}
    assert set(kept["ngram_jaccard_join"]) == everything - {20, 21, 22, 23}
    third = kept["suffix_array_dedup"]
    assert set(third) == everything - {20, 21, 22, 23}
    for k in (24, 25):
        assert third[k].text == texts[k].replace(shared + " ", "") and third[k].n_chars == len(third[k].text)
    assert all(third[k].text == texts[k] for k in third if k not in (24, 25))
    assert set(kept["benchmark_decontamination"]) == everything - {20, 21, 22, 23, 26}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} == set(kept["benchmark_decontamination"])
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_odd_and_missing_documents(spark, odd_documents, no_documents, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = {name: F.lit(name) for name in ("lang_pred", "bits_per_byte", "kept", "n_removed", "n_bytes", "n_spans", "kept_sha256", "component_id")}
    columns = [*odd_documents.columns, *extra]
    assert {"score", "id", "h", "key"} < set(columns)
    for docs in (odd_documents.withColumns(extra), no_documents.withColumns(extra)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.saved(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_rows_that_repeat_an_id_and_a_missing_language(spark, tmp_path):
    one, two = samples.sentence(1, 50), samples.sentence(2, 50)
    rows = [(1, one, "xx", "a", 1), (1, two, "xx", "b", 1), (1, one, "xx", "c", 1), (2, one, "yy", "d", 1), (3, samples.sentence(3, 50), None, "e", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.ngram_jaccard_join(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in kept if r.doc_id != 3) == sorted([(1, one, "xx", "a"), (1, two, "xx", "b")])
    judged = corpus_pipeline.language_id(spark, docs, str(tmp_path)).collect()
    assert len(judged) == 5 and {r.lang for r in judged if r.doc_id == 3} <= {"xx", "yy"}
