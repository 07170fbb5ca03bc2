from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.config import PRESET_A, PRESET_B
from ratingloom.operators import evaluate, factorize, predict, sampling
from ratingloom.plans import checks
from ratingloom.workspace import fresh_path
from tests.conftest import rows_of


def planted(seed=3, users=200, items=100, rank=3, observed=0.6):
    """Ratings of exact low rank, split into train and test rows."""
    dice = np.random.default_rng(seed)
    values = dice.normal(size=(users, rank)) @ dice.normal(size=(rank, items)) / rank**0.5
    shown = dice.random((users, items)) < observed
    train = [(u, i, float(values[u, i])) for u, i in zip(*np.nonzero(shown))]
    test = [(u, i, float(values[u, i])) for u, i in zip(*np.nonzero(~shown))]
    to_int = lambda rows: [(int(u), int(i), r) for u, i, r in rows]
    return to_int(train), to_int(test)


@pytest.fixture(scope="module")
def low_rank(spark):
    train, test = planted()
    return (
        spark.createDataFrame(train, schemas.RATINGS).cache(),
        spark.createDataFrame(test, schemas.RATINGS).cache(),
    )


def test_planted_structure_is_found(low_rank):
    train, test = low_rank
    exact = factorize.fit(train, replace(PRESET_A, rank=3, reg_param=0.001))
    score = evaluate.rmse(predict.predict(exact, test)).first()
    assert score.n == test.count() and score.rmse < 0.05
    usual = factorize.fit(train, PRESET_A)
    assert evaluate.rmse(predict.predict(usual, test)).first().rmse < 0.2


def test_user_factors_are_optimal_and_the_check_can_fail(low_rank):
    train, _ = low_rank
    model = factorize.fit(train, PRESET_B)
    good = checks.optimality(model, train, PRESET_B.reg_param)
    assert good.filter("ok").count() == good.count() == 200
    wrong = checks.optimality(model, train, 5 * PRESET_B.reg_param)
    assert wrong.filter("not ok").count() > 0


def test_repeats_weigh_in(low_rank):
    train, _ = low_rank
    few = train.limit(50)
    plain, doubled = factorize.fit(train), factorize.fit(train.unionAll(few))
    assert rows_of(plain.userFactors) != rows_of(doubled.userFactors)
    weighted = train.unionAll(few)
    assert checks.optimality(doubled, weighted, 0.05).filter("not ok").count() == 0


def test_same_ratings_give_the_same_model(low_rank, spark, tmp_path):
    train, test = low_rank
    first = factorize.fit(train)
    again = factorize.fit(train.repartition(5))
    one = evaluate.rmse(predict.predict(first, test)).first().rmse
    two = evaluate.rmse(predict.predict(again, test)).first().rmse
    assert one == pytest.approx(two, abs=1e-5)
    factorize.save_model(first, str(tmp_path / "m"))
    loaded = factorize.load_model(str(tmp_path / "m"))
    assert rows_of(loaded.itemFactors) == rows_of(first.itemFactors)


def test_unusable_rows_do_not_stop_the_fit(low_rank, make):
    train, _ = low_rank
    bad = make([(2**40, 1, 3.0), (1, 2**40, 3.0), (1, 1, None), (None, 1, 2.0)], schemas.RATINGS)
    model = factorize.fit(train.unionAll(bad))
    assert model.userFactors.count() == 200 and model.itemFactors.count() == 100


def test_predictions_say_what_is_unknown(low_rank, make):
    train, _ = low_rank
    model = factorize.fit(train)
    asked = make([(1, 1), (999, 1), (1, 999), (999, 999), (None, 1), (2**40, 1), (1, 1)],
                 schemas.PAIRS)
    answers = predict.predict(model, asked)
    status = sorted((r.status, r.prediction is not None) for r in answers.collect())
    assert status == [
        ("ok", True), ("ok", True), ("unknown_both", False), ("unknown_item", False),
        ("unknown_user", False), ("unknown_user", False), ("unknown_user", False),
    ]
    items = make([(1, "Heat", "Action")], schemas.ITEMS)
    shown = predict.prediction_report(answers, items).filter("status = 'ok'").first()
    exact = answers.filter("status = 'ok'").first().prediction
    assert shown.title == "Heat" and shown.predicted_rating == pytest.approx(exact, abs=0.0051)


def test_report_keeps_the_exact_prediction_in_one_pass(low_rank, make):
    train, _ = low_rank
    model = factorize.fit(train)
    asked = make([(1, 1), (1, 1), (999, 1)], schemas.PAIRS)
    items = make([(1, "Heat", "Action"), (1, "Heat", "Action"), (1, "Fire", "Drama")], schemas.ITEMS)
    titles = items.select("item_id", "title").distinct()
    report = predict.prediction_report(predict.predict(model, asked), titles, keep_exact=True)
    rows = report.collect()
    assert sorted((r.user_id, r.title) for r in rows) == [
        (1, "Fire"), (1, "Fire"), (1, "Heat"), (1, "Heat"), (999, "Fire"), (999, "Heat"),
    ]
    assert all(r.predicted_rating == pytest.approx(r.prediction, abs=0.0051) for r in rows
               if r.status == "ok")


def test_rmse_equals_the_evaluator(low_rank):
    train, test = low_rank
    model = factorize.fit(train)
    expected = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(
        model.transform(test)
    )
    assert evaluate.rmse(predict.predict(model, test)).first().rmse == pytest.approx(expected)


def test_nothing_to_evaluate(low_rank, make):
    train, test = low_rank
    model = factorize.fit(train)
    cold = make([(5000, 6000, 3.0)], schemas.RATINGS)
    for rows in (cold, test.limit(0)):
        assert rows_of(evaluate.rmse(predict.predict(model, rows))) == [(0, None)]


def test_grouped_sums_solve_the_same_problem(low_rank):
    """One user and one item hold a third of the rows each, partly in repeated pairs."""
    train, test = low_rank
    hot_user = train.filter("user_id = 3").select(F.explode(F.array_repeat(F.struct("*"), 60)))
    hot_item = train.filter("item_id = 5").select(F.explode(F.array_repeat(F.struct("*"), 50)))
    skewed = train.unionAll(hot_user.select("col.*")).unionAll(hot_item.select("col.*"))
    config = replace(
        PRESET_A, rank=3, reg_param=0.001, solver="grouped_sums", hot_pairs=90
    )
    model = factorize.fit(skewed, config)
    good = checks.optimality(model, skewed, config.reg_param)
    assert good.filter("ok").count() == good.count() == 200
    score = evaluate.rmse(predict.predict(model, test)).first()
    assert score.n == test.count() and score.rmse < 0.05


def test_the_settings_alone_choose_the_route(low_rank, monkeypatch):
    train, _ = low_rank
    taken = []
    monkeypatch.setattr(factorize, "fit_by_sums", lambda rows, config: taken.append(config))
    factorize.fit(train, replace(PRESET_A, max_iter=1))
    assert not taken
    factorize.fit(train, replace(PRESET_A, solver="grouped_sums"))
    assert len(taken) == 1
    with pytest.raises(ValueError, match="unknown solver"):
        factorize.fit(train, replace(PRESET_A, solver="guess"))


def test_too_much_for_a_block_is_refused_by_name(low_rank):
    train, _ = low_rank
    with pytest.raises(ValueError, match="raise user_blocks and item_blocks"):
        factorize.fit(train, replace(PRESET_A, max_rows_per_block=20))
    with pytest.raises(ValueError, match="solver='grouped_sums'"):
        factorize.fit(train, replace(PRESET_A, user_blocks=1000, item_blocks=1000, max_rows_per_block=50))


def test_split_model_and_constant(spark, small_data):
    from ratingloom.sources import star_tables
    train, test = sampling.split_ratings(star_tables.ratings(spark, small_data))
    model = factorize.fit(train)
    users = factorize.factors(model, "user").select("user_id")
    assert rows_of(users) == rows_of(train.select("user_id").distinct())
    assert evaluate.rmse(predict.predict(model, test)).first().n == 1127


def test_hot_keys_are_summed_in_pieces_of_about_hot_pairs(low_rank):
    """A hot key moves one sum per piece, not one per task its rows come from."""
    from ratingloom.operators.normal_equations import weighted_pairs

    train, test = low_rank
    pairs = weighted_pairs(factorize.usable_ratings(train), 10)
    pieces = pairs.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("size"), F.countDistinct("user_id_piece").alias("pieces"),
        F.max("user_id_piece").alias("last"), F.bool_and("user_id_hot").alias("hot"),
    ).collect()
    assert all(r.hot == (r.size > 10) for r in pieces)
    assert all(r.last < -(-r.size // 10) if r.hot else r.last == 0 for r in pieces)
    assert sum(r.pieces for r in pieces) <= sum(-(-r.size // 10) for r in pieces)
    config = replace(PRESET_A, rank=3, reg_param=0.001, solver="grouped_sums", hot_pairs=10)
    model = factorize.fit(train, config)
    good = checks.optimality(model, train, config.reg_param)
    assert good.filter("ok").count() == good.count() == 200
    score = evaluate.rmse(predict.predict(model, test)).first()
    assert score.rmse < 0.05


def test_grouped_sums_in_slices_leave_only_the_last_factors(spark, low_rank, monkeypatch):
    """Half-rounds of a few keys at a time give the same factors as those of all keys; what a step
    has shuffled and written is gone when the next has used it."""
    import os
    from urllib.parse import urlparse

    from ratingloom.operators import normal_equations

    config = replace(PRESET_A, rank=3, reg_param=0.001, max_iter=2, solver="grouped_sums", hot_pairs=20)
    train = factorize.usable_ratings(low_rank[0])
    whole = normal_equations.alternate(train, config)
    monkeypatch.setattr(normal_equations, "SLICE_PAIRS", 5000)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    statuses = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before, set_before = statuses.size(), spark.conf.get(setting, None)
    made = []
    monkeypatch.setattr(normal_equations, "fresh_path", lambda *args: made.append(fresh_path(*args)) or made[-1])
    sliced = normal_equations.alternate(train, config)
    assert statuses.size() <= before + 2 and spark.conf.get(setting, None) == set_before
    left = [x for x in os.listdir(urlparse(made[0]).path) if not x.startswith(".")]
    assert sorted(left) == ["items-1", "users-1"]
    assert len(os.listdir(urlparse(made[0] + "/users-1").path)) > 1
    for one, other, key in zip(whole, sliced, ("user_id", "item_id")):
        one, other = ({r[key]: r.features for r in t.collect()} for t in (one, other))
        assert one.keys() == other.keys()
        assert all(one[k] == pytest.approx(other[k], abs=1e-3) for k in one)
