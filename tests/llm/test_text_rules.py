import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from ratingloom.llm import langid, line_rules, site_quality, toxicity
from ratingloom.llm.common import combine, word_hashes
from ratingloom.llm.queries import op3_toxicity, op4_site_quality, op7_line_rules, op8_language_id
from tests.llm.conftest import sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab \n\x1c é", max_size=30), max_size=5))
def test_equal_words_have_equal_hashes(texts):
    hashes, at = word_hashes([t.encode() for t in texts])
    own = [WORDS.findall(t) for t in texts]
    assert [b - a for a, b in zip(at, at[1:])] == [len(w) for w in own]
    flat = [w for ws in own for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat))
    assert len(combine(hashes, 3)) == max(0, len(flat) - 2)


def base(text):
    words = WORDS.findall(text or "")
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 20 or 100 * len(cover) > 30 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(cover), failed


def test_base_figures_equal_brute_force(spark, odd_documents, small_data):
    for rows, found in (
        (odd_documents.collect(), line_rules.judge(odd_documents).collect()),
        (spark.read.parquet(f"{small_data}/documents.parquet").collect(), op7_line_rules(spark, small_data).collect()),
    ):
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
        assert got == Counter((r.doc_id, *base(r.text)) for r in rows)
        assert not any(r.kept and r.base_failed for r in found)


def test_lines_are_judged_first():
    good = "This is a line of running text that ends as it should."
    text = "\n".join([good, "Home | News | Sport | Contact", "All rights reserved.", good, "THIS IS ALL SHOUTED TEXT!!", "Read the menu", "go go go go go go"])
    cleaned, failed, repeated, lost = line_rules.clean(text)
    assert cleaned == good and (failed, repeated) == (6, 1)
    assert lost == len(re.sub(r"\s", "", text)) - len(re.sub(r"\s", "", good))
    assert line_rules.clean("") == ("", 0, 0, 0)


def test_clean_and_junk_documents_are_told_apart(spark, small_data):
    labels = spark.read.parquet(f"{small_data}/labels.parquet")
    for found in (op7_line_rules(spark, small_data), op4_site_quality(spark, small_data)):
        rows = found.join(labels, "doc_id").select("quality", "kept", *[c for c in ("base_failed",) if c in found.columns]).collect()
        good = [r.kept for r in rows if r.quality == 1 and not (hasattr(r, "base_failed") and r.base_failed)]
        bad = [r.kept for r in rows if r.quality == 0]
        assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_an_automaton_knows_all_substrings():
    text = bytes([0, 1, 0, 0, 1, 2, 0, 1])
    move = langid.suffix_automaton(text, 3)
    for a in range(3):
        for b in range(3):
            for c in range(3):
                state = 0
                for s in (a, b, c):
                    state = int(move[state, s]) if state >= 0 else -1
                assert (state >= 0) == (bytes([a, b, c]) in text)


def pieces(text, sample):
    count, here = 0, b""
    for b in text:
        one = bytes([b])
        if here + one in sample:
            here += one
        else:
            count, here = count + 1, one if one in sample else b""
    return count + (len(text) > 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abc é", max_size=300), min_size=1, max_size=4), st.text("abcé ", min_size=1, max_size=60))
def test_pieces_equal_brute_force(texts, sample):
    raw = [t.encode() for t in texts]
    parser = langid.CrossParser({"x": sample.encode(), "y": b"ab"})
    got = parser.pieces(raw).tolist()
    assert got == [[pieces(t, sample.encode()), pieces(t, b"ab")] for t in raw]


def test_pieces_go_on_across_blocks():
    dice = __import__("random").Random(2)
    sample = bytes(dice.choices(b"abcdefgh ", k=6000))
    parser = langid.CrossParser({"x": sample})
    texts = [sample[:5000], sample[7:], sample[100:900] + sample[3000:3700], bytes(dice.choices(b"abcdefgh z", k=3000)), b"", sample[:256], sample[:257]]
    assert parser.pieces(texts)[:, 0].tolist() == [pieces(t, sample) for t in texts]
    assert parser.pieces(texts[:2])[:, 0].tolist() == [1, 1]


def test_only_letters_make_a_language():
    parser = langid.CrossParser({"x": b"some words of a language"})
    signs = ["²", "½ ①", "Ⅷ", "12 % 34", "_", "", None, "١٢"]
    assert [x[0] for x in parser.judge(signs)] == ["und"] * len(signs)
    assert [x[0] for x in parser.judge(["a", "² b", "北"])] == ["x"] * 3


def test_languages_of_odd_documents(odd_documents, no_documents):
    found = langid.held_out_languages(odd_documents).collect()
    assert len(found) == odd_documents.count()
    und = Counter(r.doc_id for r in found if r.lang_pred == "und")
    assert und == Counter([1, 2, 3, 7, None])
    assert all(0 <= r.score <= 1 for r in found)
    assert langid.held_out_languages(no_documents).count() == 0
    nothing = langid.identify(odd_documents, {})
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_held_out_languages_are_right(spark, small_data):
    docs = spark.read.parquet(f"{small_data}/documents.parquet").select("doc_id", "lang")
    rows = op8_language_id(spark, small_data).where("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 40 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_toxicity_of_odd_documents(odd_documents, no_documents, labels):
    for given_labels in (labels, labels.limit(0)):
        model = toxicity.fit(odd_documents, given_labels)
        rows = toxicity.score(odd_documents, model).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r["score"] <= 1 and r.predicted == (r["score"] >= 0.3) for r in rows)
        assert toxicity.score(no_documents, model).count() == 0
    assert toxicity.score(odd_documents, toxicity.fit(no_documents, labels)).count() == odd_documents.count()


def test_nearest_examples_are_exact():
    import numpy as np
    dice = np.random.default_rng(5)
    terms = {f"t{k}": 1 + k / 7 for k in range(30)}
    names = sorted(terms)
    examples = [(k, int(k % 3 == 0), 1.0, {names[i]: int(dice.integers(1, 4)) for i in dice.choice(30, dice.integers(0, 6), False)}) for k in range(700)]
    index = toxicity.Index(terms, examples, k=9)
    whole = {index.ids[p]: p for p in range(len(index.ids))}
    for trial in range(40):
        query = {names[i]: int(dice.integers(1, 3)) for i in dice.choice(30, dice.integers(1, 8), False)}
        at, value = index.vector(query)
        mine = dict(zip(at.tolist(), value.tolist()))
        cosine = {}
        for e in examples:
            a, v = index.vector(e[3])
            c = sum(mine.get(i, 0) * x for i, x in zip(a.tolist(), v.tolist()))
            if c > 0:
                cosine[whole[e[0]]] = round(c, 12)
        best = sorted(cosine, key=lambda p: (-cosine[p], p))[:9]
        got, near = index.nearest(query)
        assert got.tolist() == best and near.tolist() == pytest.approx([cosine[p] for p in best])


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op3_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    caught = sum(r.predicted for r in rows if r.toxic == 1)
    wrong = sum(r.predicted for r in rows if r.toxic == 0)
    assert caught >= 0.4 * sum(r.toxic for r in rows) and wrong <= 0.05 * len(rows)


def test_language_samples_are_bounded(spark, monkeypatch):
    rows = [(k % 3, f"word{'abc'[k % 3]} " * 3, "xx") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.language_samples(docs, documents=3)
    assert sorted(found["xx"].split()) == sorted(f"word{c}".encode() for c in "abc" for _ in range(3))
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError):
        langid.language_samples(docs.unionByName(docs.withColumn("lang", F.lit("yy"))))


def test_stage_keeps_letters_without_languages(spark):
    docs = spark.createDataFrame([(1, "Some words", None), (2, "12 %", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()] == [1]


@pytest.fixture(scope="module")
def insults(spark):
    """Texts and labels: a word in most toxic texts, and one in a toxic text with many copies."""
    plain = [(k, sentence(k, 20), 0) for k in range(2000)]
    marked = []
    for k in range(300):
        words = sentence(5000 + k, 20).split()
        words.insert(k % 20, "vilest" if k % 5 < 3 else "cruder")
        marked.append((5000 + k, " ".join(words), 1))
    copied = " ".join("grimmest " + sentence(9000 + j, 3).rstrip(".") for j in range(30))
    copies = [(9000 + k, copied, 1) for k in range(400)]
    rows = [(k, t, y) for k, t, y in plain + marked + copies]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")


@pytest.mark.parametrize("examples", [150, 4000])
def test_strong_terms_stay_whatever_the_size(insults, examples):
    index, _, _ = toxicity.fit(*insults, examples=examples)
    assert {"vilest", "cruder", "grimmest"} <= set(index.terms)
    # each copied text is one example
    assert sum(9000 <= k < 9400 for k in index.ids) == 1


def test_examples_are_one_row_each(spark, insults):
    docs, labels = insults
    copied = docs.where("doc_id between 5000 and 5099").crossJoin(spark.range(9)).select("doc_id", "text")
    index, _, _ = toxicity.fit(docs.unionByName(copied), labels, examples=150)
    assert len(set(index.ids)) == len(index.ids)


def test_isotonic_steps_rise():
    import numpy as np
    x, y = np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0.0, 1.0, 0.0, 1.0, 1.0])
    steps, values = toxicity.isotonic(x, y, np.ones(5))
    assert values.tolist() == [0.0, 0.5, 1.0] and steps.tolist() == [0.1, 0.3, 0.4]


def test_site_quality_of_odd_documents(odd_documents, no_documents, labels):
    for given_labels in (labels, labels.limit(0)):
        rows = site_quality.site_quality(odd_documents, given_labels).collect()
        assert len(rows) == odd_documents.count()
        assert all(0 <= r["score"] <= 1 and 0 <= r.site_rate <= 1 for r in rows)
    assert site_quality.site_quality(no_documents, labels).count() == 0


def test_sparse_sites_shrink_to_the_level_above(spark):
    """Equal texts: a site's own labels decide, more so the more there are."""
    rows = [(k, "the same words in every text here.", site, "p") for k, site in enumerate(["good"] * 300 + ["bad"] * 300 + ["new"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([(k, int(k < 300 or k % 5 == 0)) for k in range(600)], "doc_id bigint, quality int")
    found = {r.doc_id: r.site_rate for r in site_quality.site_quality(docs, labels).collect()}
    overall = sum(found.values()) / len(found)
    assert found[1] > 0.9 and found[301] < 0.4
    assert abs(found[600] - overall) < 0.15
