import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import collisions, lexical, queries, whitening
from tests.llm.conftest import sentence

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked_by_hand(docs, items, k=10):
    found = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    found = [(i, c, c.total()) for i, c in found if c]
    n, length = len(found), sum(size for _, _, size in found)
    holders = Counter(term for _, c, _ in found for term in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall((text or "").translate(LOWER)))
    out = []
    for item, own in wanted.items():
        scores = []
        for i, c, size in found:
            m = 100 - 90 + 90 * size * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * holders[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in own & set(c))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


def test_search_matches_a_plain_ranking(spark, odd_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    items = [(1, sentence(1)), (2, sentence(2) + " " + sentence(1)), (3, None), (4, ""), (5, "É é 北京 O'CLOCK straße"), (None, "12 a"), (6, "absent zzz"),
             (1, "a 34"), (7, sentence(1) + sentence(2)), (8, " ".join(sentence(1000 + k) for k in range(200))), (9, sentence(1))]
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, id int, term string")
    expected = ranked_by_hand(docs, items)
    assert rows(lexical.search(odd_documents, given)) == expected
    # many small blocks, and only the best three
    assert rows(lexical.search(odd_documents, given, k=3, block_terms=30)) == ranked_by_hand(docs, items, 3)


def test_search_of_the_whole_table(spark, small_data):
    docs, items = (spark.read.parquet(f"{small_data}/{t}.parquet") for t in ("documents", "benchmark"))
    given = [[tuple(r) for r in t.select(c, "text").collect()] for t, c in ((docs, "doc_id"), (items, "item_id"))]
    assert rows(queries.op11_shared_search(spark, small_data)) == ranked_by_hand(*given)


def test_search_with_ties_and_many_copies(spark):
    docs = [(k, "same text here") for k in range(300)] + [(-5, "same text here"), (1000, "other words")]
    items = [(1, "text"), (2, "same text"), (3, "same text here other")]
    made = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(made) == ranked_by_hand(docs, items)


def test_search_without_documents_or_items(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert rows(lexical.search(no_documents, items)) == []
    assert rows(lexical.search(odd_documents.where("text is null"), items)) == []
    assert rows(lexical.search(odd_documents, items.limit(0))) == []


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(sentence(k) for k in range(50)).encode() + b" " + b"q" * 500 + "é".encode() * 300
    whole = [w for piece in lexical.terms(text) for w in piece]
    monkeypatch.setattr(lexical, "PIECE", 64)
    assert [w for piece in lexical.terms(text) for w in piece] == whole and len(whole) > 1000


@pytest.mark.parametrize("seed", range(30))
def test_shared_sums_give_every_item_its_terms(seed):
    dice = random.Random(seed)
    items = [sorted(dice.sample(range(40), dice.randint(1, 25))) for _ in range(dice.randint(1, 30))] + [[1, 2, 3]] * 3
    graph = lexical.Sharing(items)
    value = {t: {t: 1} for own in items for t in own}
    for symbol, parts in graph.sums:
        value[symbol] = Counter()
        for p in parts:
            value[symbol].update(value[p])
    for own, left in zip(items, graph.left):
        total = Counter()
        for symbol in left:
            total.update(value[symbol])
        assert total == Counter(own)  # every term once
    shared, plain = graph.additions()
    assert shared <= plain


def test_items_of_a_topic_share_sums():
    topic = list(range(30))
    graph = lexical.Sharing([topic + [100 + k, 200 + k // 2] for k in range(50)])
    shared, plain = graph.additions()
    assert shared < plain / 5


def nearest_by_hand(given, k=10):
    """For each query row, distances of the k nearest and the ids closer than the last of them."""
    good = [(i, np.array(v, float)) for i, v in given if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for at, (i, v) in enumerate(good):
        if i % 100 == 0:
            found = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for other, (j, w) in enumerate(good) if other != at and len(w) == len(v))
            out.append((i, found[:k]))
    return out


def recall(table, expected):
    got = {}
    for r in table.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    hits = total = 0
    for query, found in expected:
        own = sorted(got.get(query, []))
        assert [x[0] for x in own] == list(range(1, len(own) + 1)) and [x[1:] for x in own] == sorted(x[1:] for x in own)
        true = {j for _, j in found}
        hits, total = hits + len(true & {x[2] for x in own}), total + len(true)
    return hits / total


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_neighbours_of_the_whole_table(spark, small_data, shard_rows):
    vectors = spark.read.parquet(f"{small_data}/embeddings.parquet")
    given = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = collisions.nearest(vectors, F.col("id") % 100 == 0, shard_rows=shard_rows)
    by_id = {i: np.array(v, float) for i, v in given}
    assert recall(found, nearest_by_hand(given)) >= 0.95
    for r in found.collect():
        assert r.score == pytest.approx(np.linalg.norm(by_id[r.query_id] - by_id[r.vec_id]), rel=1e-14)


def test_neighbours_in_clusters_and_a_hot_vector(spark):
    dice = np.random.default_rng(3)
    centres = dice.standard_normal((20, 24)) * 5
    given = [(k, (centres[k % 20] + 0.1 * dice.standard_normal(24)).tolist()) for k in range(2000)] + [(5000 + k, centres[0].tolist()) for k in range(400)]
    table = spark.createDataFrame([(i, v, 1.0, 2) for i, v in given], "vec_id bigint, embedding array<double>, score double, row int").repartition(4)
    found = collisions.nearest(table, F.col("id") % 100 == 0, shard_rows=500)
    assert recall(found.where("query_id < 5000"), [x for x in nearest_by_hand(given) if x[0] < 5000]) >= 0.95
    copies = found.where("query_id = 5100").collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in copies) == [(k + 1, 5000 + k, 0.0) for k in range(10)]  # ties by id, itself left out


def test_neighbours_of_odd_vectors(spark):
    inf, nan = math.inf, math.nan
    given = [(0, [1.0, 0.0]), (100, [1.0, 1.0]), (100, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (200, [nan, 1.0]), (300, [inf, 1.0]), (400, [None, 1.0]), (None, [1.0, 2.0]),
             (500, []), (600, [1.0, 2.0, 3.0]), (7, [1.0, 2.0]), (-100, [3.0, 4.0]), (8, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v, 1, "s") for i, v in given], "vec_id bigint, embedding array<double>, dim int, shard string")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in collisions.nearest(table, F.col("id") % 100 == 0).collect())
    root = math.sqrt
    assert [r for r in found if r[0] == 0] == [(0, 1, 8, 0.0), (0, 2, 100, 1.0), (0, 3, 100, 1.0), (0, 4, 7, 2.0), (0, 5, -100, root(20))]
    own = [(r[1], r[2], r[3]) for r in found if r[0] == 100]  # two rows, each with the other at distance 0
    assert sorted(own) == sorted(2 * [(1, 100, 0.0), (2, 0, 1.0), (3, 7, 1.0), (4, 8, 1.0), (5, -100, root(13))])
    assert {r[0] for r in found} == {0, 100, -100}  # a vector alone with its length has no neighbours
    assert collisions.nearest(table.limit(0), F.col("id") % 100 == 0).collect() == []
    assert collisions.nearest(table.where("embedding is null"), F.col("id") % 100 == 0).collect() == []


def whitened_by_hand(given):
    good = [(i, v) for i, v in given if v and None not in v and np.isfinite(v).all()]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], object)
    n, total = len(x), x.sum(axis=0)
    centred = ((n * x - total) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:8]
    return [i for i, _ in good], n, [int(d) for d in ((n * x - total) ** 2).sum(axis=1)], values[order], centred @ axes[:, order] / np.sqrt(values[order]), values.sum()


def test_whitening_of_the_whole_table(spark, small_data):
    vectors = spark.read.parquet(f"{small_data}/embeddings.parquet")
    ids, n, deviation, values, expected, trace = whitened_by_hand([(r.vec_id, r.embedding) for r in vectors.collect()])
    place = {i: at for at, i in enumerate(ids)}
    made = queries.op13_whitening(spark, small_data).collect()
    assert len(made) == 8 * n and {(r.vec_id, r.component) for r in made} == {(i, k) for i in ids for k in range(1, 9)}
    got = np.zeros_like(expected)
    for r in made:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[place[r.vec_id]] and 0 <= r.identity_error < 1e-10
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-10)
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-9


def test_whitening_of_odd_vectors(spark):
    inf, nan = math.inf, math.nan
    given = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (2, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 2.0]),
             (7, []), (8, [1.0, 2.0, 3.0]), (9, [1e300, 0.0]), (10, [-3.0, 4.5])]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in given], "vec_id bigint, embedding array<double>, component int, n double").repartition(3)
    kept = [(i, v) for i, v in given if v and len(v) == 2 and v[0] != 1e300]
    _, n, deviation, values, expected, trace = whitened_by_hand(kept)
    made = whitening.whiten(table).collect()
    assert n == 6 and len(made) == 12
    assert sorted(r.deviation for r in made if r.component == 1) == sorted(deviation)
    assert sorted(abs(r.whitened) for r in made if r.component == 2) == pytest.approx(sorted(abs(x) for x in expected[:, 1]), abs=1e-9)
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 1")).collect() == []  # nothing varies
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 5.0]) for k in range(9)], "vec_id bigint, embedding array<double>")
    assert {r.component for r in whitening.whiten(line).collect()} == {1}  # the other two have no variance


def test_large_entries_keep_exact_deviations(spark):
    given = [(k, [2.0 ** 40 * k, 1.0]) for k in range(3)]
    made = whitening.whiten(spark.createDataFrame(given, "vec_id bigint, embedding array<double>"), components=1).collect()
    assert {r.vec_id: r.deviation for r in made} == {0: None, 1: 0, 2: None}  # beyond 64 bits: null


@pytest.mark.parametrize("values", [[5, 2, 2, 2, 1, 1, 0, -1], [1, 1, 1], [3], [2, 1 + 1e-9, 1, 0.5], [0, 0, 0], [1e9, 1, 1e-3]])
def test_eigenpairs_by_division(values):
    dice = np.random.default_rng(1)
    basis, _ = np.linalg.qr(dice.standard_normal((len(values), len(values))))
    matrix = basis @ np.diag(values).astype(float) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenpairs(matrix, 8)
    scale = max(1, max(map(abs, values)))
    assert found == pytest.approx(sorted(values, reverse=True), abs=1e-14 * scale * 8)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * scale * 8
