from dataclasses import replace

import numpy as np
import pytest

from contract import spark_queries
from ratingloom import schemas
from ratingloom.config import PRESET_A
from ratingloom.operators import blocks, factorize, topn
from ratingloom.plans import checks
from tests.conftest import rows_of

N_USERS, N_ITEMS = 40, 60


@pytest.fixture(scope="module")
def fitted(spark):
    """Ratings in which user 0 has rated every item and user 1 all but three; also the model and
    all scores as a dense matrix."""
    dice = np.random.default_rng(11)
    rows = {(u, i) for u in range(N_USERS) for i in range(N_ITEMS) if dice.random() < 0.2}
    rows = {r for r in rows if r[0] != 1} | {(1, i) for i in range(N_ITEMS - 3)}
    rows |= {(0, i) for i in range(N_ITEMS)}
    rated = [(u, i, float(dice.integers(1, 11)) / 2) for u, i in sorted(rows)]
    ratings = spark.createDataFrame(rated + rated[:30], schemas.RATINGS).cache()
    model = factorize.fit(ratings, replace(PRESET_A, max_iter=3, rank=4))
    users = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    scores = {(u, i): float(users[u] @ items[i]) for u in users for i in items}
    return ratings, model, scores, rows


def best(scores, user, n, without=()):
    ranked = sorted((-s, i) for (u, i), s in scores.items() if u == user and (u, i) not in without)
    return [i for _, i in ranked[:n]]


def lists_of(table):
    lists = {}
    for r in table.orderBy("user_id", "rank").collect():
        lists.setdefault(r.user_id, []).append(r.item_id)
    return lists


def test_lists_match_brute_force(fitted):
    _, model, scores, _ = fitted
    lists = topn.recommend(model, 7)
    assert lists_of(lists) == {u: best(scores, u, 7) for u in range(N_USERS)}
    for r in lists.collect():
        assert r.score == pytest.approx(scores[r.user_id, r.item_id], abs=1e-4)


def test_subset_repeats_and_unknown_users(fitted, make):
    _, model, scores, _ = fitted
    users = make([(3,), (3,), (999,), (2**40,), (None,), (5,)], schemas.USERS)
    lists = topn.recommend(model, 4, users)
    assert lists_of(lists) == {u: best(scores, u, 4) for u in (3, 5)}
    assert lists.count() == 8


def test_more_asked_than_there_are_items(fitted):
    _, model, _, _ = fitted
    assert topn.recommend(model, 500).count() == N_USERS * N_ITEMS


@pytest.mark.parametrize("n", [5, 30])
def test_unseen_lists_match_brute_force(fitted, n):
    ratings, model, scores, rows = fitted
    lists = lists_of(topn.recommend_unseen(model, n, ratings))
    expected = {u: best(scores, u, n, without=rows) for u in range(N_USERS)}
    assert lists == {u: items for u, items in expected.items() if items}
    assert 0 not in lists and len(lists[1]) == 3


def test_unseen_lists_of_some_users(fitted, make):
    ratings, model, scores, rows = fitted
    users = make([(1,), (1,), (8,), (999,)], schemas.USERS)
    lists = lists_of(topn.recommend_unseen(model, 5, ratings, users))
    assert lists == {u: best(scores, u, 5, without=rows) for u in (1, 8)}
    nobody = topn.recommend_unseen(model, 5, ratings, make([(999,)], schemas.USERS))
    assert nobody.count() == 0


def test_titles_keep_the_rank_and_drop_unlisted_items(fitted, make):
    _, model, scores, _ = fitted
    catalogue = make([(i, f"t{i}", None) for i in range(N_ITEMS) if i % 2], schemas.ITEMS)
    titled = topn.with_titles(topn.recommend(model, 6), catalogue)
    for r in titled.collect():
        assert best(scores, r.user_id, 6)[r["rank"] - 1] == r.item_id
        assert r.title == f"t{r.item_id}" and r.item_id % 2


def test_shape_check_notices_faults(make):
    schema = "user_id bigint, rank int, item_id bigint, score float"
    good = [(1, 1, 5, 3.0), (1, 2, 4, 2.0), (1, 3, 6, 2.0)]
    gap = [(2, 1, 5, 3.0), (2, 3, 4, 2.0)]
    rising = [(3, 1, 5, 2.0), (3, 2, 4, 3.0)]
    twice = [(4, 1, 5, 3.0), (4, 2, 5, 2.0)]
    found = rows_of(checks.list_shape(make(good + gap + rising + twice, schema)))
    assert found == [
        (1, 3, True, True, True), (2, 2, False, True, True), (3, 2, True, False, True),
        (4, 2, True, True, False),
    ]


@pytest.mark.parametrize(("user_block", "item_block"), [(7, 9), (2048, 16_384), (1, 60)])
def test_block_sizes_do_not_change_lists(fitted, user_block, item_block):
    ratings, model, scores, rows = fitted
    lists = blocks.best_outside(model, 6, ratings, user_block=user_block, item_block=item_block)
    expected = {u: best(scores, u, 6, without=rows) for u in range(N_USERS)}
    assert lists_of(lists) == {u: items for u, items in expected.items() if items}


def test_left_out_pairs_may_be_unknown_null_or_repeated(fitted, make):
    _, model, scores, _ = fitted
    pairs = [(3, 5), (3, 5), (3, 999), (999, 5), (None, 5), (3, None), (2**40, 2**40)]
    lists = blocks.best_outside(model, 60, make(pairs, "user_id bigint, item_id bigint"), make([(3,), (4,)], schemas.USERS))
    assert lists_of(lists) == {3: best(scores, 3, 60, without={(3, 5)}), 4: best(scores, 4, 60)}
    assert blocks.best_outside(model, 0, make(pairs, "user_id bigint, item_id bigint")).count() == 0


def test_largest_of_rows_with_ties_and_gaps():
    dice = np.random.default_rng(5)
    for width, n in ((3, 5), (700, 2), (5000, 10), (64, 1)):
        scores = dice.integers(0, 30, (20, width)).astype(np.float32)
        scores[dice.random(scores.shape) < 0.3] = -np.inf
        scores[0], scores[1] = 1.0, -np.inf
        row, column = blocks._largest(scores, n)
        found = [(r, c) for r, c in zip(row.tolist(), column.tolist())]
        expected = []
        for r in range(20):
            ranked = sorted((-scores[r, c], c) for c in range(width) if np.isfinite(scores[r, c]))
            expected += [(r, c) for _, c in ranked[:n]]
        assert found == expected


def test_check_of_best_lists_notices_faults(fitted, make):
    ratings, model, scores, rows = fitted
    schema = "user_id bigint, rank int, item_id bigint, score float"
    listed = {u: best(scores, u, 4, without=rows) for u in range(2, 8)}
    right = {u: [(u, k + 1, i, scores[u, i]) for k, i in enumerate(own)] for u, own in listed.items()}
    wrong = dict(right)
    wrong[3] = right[3][:3]  # too short
    wrong[4] = right[4][:3] + [(4, 4, right[4][3][2], right[4][3][3] + 1)]  # a score of its own
    worse = best(scores, 5, 6, without=rows)[5]
    wrong[5] = right[5][:3] + [(5, 4, worse, scores[5, worse])]  # a better one is missing
    rated = next(i for u, i in sorted(rows) if u == 6)
    wrong[6] = right[6][:3] + [(6, 4, rated, scores[6, rated])]  # seen
    lists = make([r for own in wrong.values() for r in own], schema)
    found = checks.nothing_better(model, lists, 4, ratings.select("user_id", "item_id"))
    assert {r.user_id: r.best_ok for r in found.collect()} == {2: True, 3: False, 4: False, 5: False, 6: False, 7: True}


def test_blocks_beyond_the_grid_grow_instead_of_copying_more(fitted, monkeypatch):
    """With a block per id, users and items go to at most GRID blocks of the other side each; and a
    cell that holds a single user's scores at a time still gives the same lists."""
    ratings, model, scores, rows = fitted
    made = []

    def counted(*args):
        cells = cells_of(*args)
        made.append(cells.filter(f"kind != {blocks._PAIR}").count())
        return cells

    cells_of = blocks._cells
    monkeypatch.setattr(blocks, "_cells", counted)
    monkeypatch.setattr(blocks, "SCORES", 1)
    lists = blocks.best_outside(model, 5, ratings, user_block=1, item_block=1)
    assert made and made[0] <= blocks.GRID * (N_USERS + N_ITEMS)
    wanted = {u: best(scores, u, 5, rows) for u in range(N_USERS)}
    assert lists_of(lists) == {u: items for u, items in wanted.items() if items}


def test_lists_of_all_users_leave_mllib_blocks_alone(fitted, monkeypatch):
    """All users' lists are the factor blocks' own products, with equal scores by item id, and
    don't go through MLlib's row-by-row top-N."""
    _, model, scores, _ = fitted

    def refused(*args):
        raise AssertionError("recommendForAllUsers")

    monkeypatch.setattr(type(model), "recommendForAllUsers", refused)
    monkeypatch.setattr(type(model), "recommendForUserSubset", refused)
    assert lists_of(topn.recommend(model, 3)) == {u: best(scores, u, 3) for u in range(N_USERS)}


def records(ids, factors):
    rows = np.empty(len(ids), blocks._record(factors.shape[1]))
    rows["id"], rows["factor"] = ids, factors
    return rows


def test_a_block_carries_its_lists_through_the_cells(monkeypatch):
    """Lists after several cells are those of one sort over everything, with equal scores by id,
    left-out pairs and factors that aren't finite; later cells are scored in part only."""
    dice = np.random.default_rng(3)
    monkeypatch.setattr(blocks, "WIDTH", 16)
    monkeypatch.setattr(blocks, "SCORES", 160)
    users = dice.integers(-2, 3, (50, 3)).astype(np.float32)
    items = dice.integers(-2, 3, (900, 3)).astype(np.float32)
    items[5, 0], items[6, 1], users[7, 2], users[8] = np.nan, np.inf, np.nan, 0
    out = {(int(u), int(i)) for u, i in zip(dice.integers(0, 60, 9000), dice.integers(0, 999, 9000))}
    block = blocks._Block(blocks._unpacked([records(np.arange(50), users).tobytes()], 3), 4)
    scored = []

    def counted(a, b, **options):
        scored.append(len(a) * b.shape[1])
        return matmul(a, b, **options)

    matmul = np.matmul
    monkeypatch.setattr(np, "matmul", counted)
    for cell in np.array_split(dice.permutation(900), 5):
        pairs = np.array(sorted(p for p in out if p[1] in set(cell.tolist()) or p[1] >= 900))
        block.meet(blocks._unpacked([records(cell, items[cell]).tobytes()], 3), [tuple(pairs.T)])
    assert sum(scored) < 50 * 900 * 3 / 5
    found = {}
    for batch in block.found():
        for r in batch.to_pylist():
            found.setdefault(r["user_id"], []).append((r["rank"], r["item_id"], r["score"]))
    expected = {}
    for u in set(range(50)) - {7}:
        ranked = sorted((-float(users[u] @ items[i]), i) for i in range(900) if i not in (5, 6) and (u, i) not in out)
        expected[u] = [(k + 1, i, -s) for k, (s, i) in enumerate(ranked[:4])]
    assert found == expected


def test_users_go_once_into_the_cells_and_only_lists_leave_them(fitted, make):
    _, model, _, _ = fitted
    users, items = factorize.factors(model, "user"), factorize.factors(model, "item")
    cells = blocks._cells(users, items, make([], "user_id bigint, item_id bigint"), 3, 4, model.rank)
    sent = {}
    for r in cells.collect():
        sent[r.kind] = sent.get(r.kind, 0) + len(r.packed) // blocks._record(model.rank).itemsize
    assert sent == {blocks._USER: N_USERS, blocks._ITEM: 3 * N_ITEMS}
    lists = topn.recommend(model, 5)
    assert "Window" not in lists._jdf.queryExecution().toString()


@pytest.mark.parametrize("query", ["recommend_top_n", "recommend_unseen"])
def test_checked_lists_are_made_once(spark, small_data, monkeypatch, query):
    """However often the checks read a list, each of its rows is computed a single time."""
    made = spark.sparkContext.accumulator(0)
    name = "recommend" if query == "recommend_top_n" else "recommend_unseen"
    plain = getattr(topn, name)

    def counted(*args):
        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        lists = plain(*args)
        return lists.mapInArrow(count, lists.schema)

    monkeypatch.setattr(topn, name, counted)
    checked = spark_queries.QUERIES[query](spark, small_data).collect()
    assert checked and all(r.best_ok for r in checked)
    assert made.value == sum(r.n_rows for r in checked)
