import pytest

from ratingloom import schemas
from ratingloom.config import SplitConfig
from ratingloom.operators import append, sampling
from ratingloom.sources import star_tables
from tests.conftest import rows_of


def test_split_keeps_every_row_and_ignores_partitioning(spark, small_data):
    ratings = star_tables.ratings(spark, small_data)
    train, test = sampling.split_ratings(ratings)
    assert rows_of(train.unionAll(test)) == rows_of(ratings)
    again, _ = sampling.split_ratings(ratings.repartition(3))
    assert rows_of(train) == rows_of(again)
    assert {(r.part, r.n) for r in sampling.split_stats(ratings).collect()} == {
        ("train", 4873), ("test", 1127)
    }


def test_split_is_not_changed_by_later_rows(make):
    rows = [(u, i, 1.0) for u in range(30) for i in range(10)]
    old = make(rows, schemas.RATINGS)
    more = append.append_ratings(old, make([(99, i, 2.0) for i in range(50)], schemas.RATINGS))
    train, _ = sampling.split_ratings(old)
    bigger, _ = sampling.split_ratings(more)
    assert set(rows_of(train)) == {r for r in rows_of(bigger) if r[0] != 99}


def test_split_settings(make):
    rows = make([(u, i, 1.0) for u in range(40) for i in range(40)], schemas.RATINGS)
    half, _ = sampling.split_ratings(rows, SplitConfig(seed=1, buckets=2, train_buckets=1))
    assert 700 < half.count() < 900
    train, test = sampling.split_ratings(rows, method="random")
    assert train.count() + test.count() == 1600
    with pytest.raises(ValueError):
        sampling.split_ratings(rows, method="guess")


def test_sampled_items_depend_on_the_seed_only(make):
    pool = make([(k, f"t{k}", None) for k in range(50)], schemas.ITEMS)
    first = rows_of(sampling.sample_items(pool, 5, seed=1))
    assert first == rows_of(sampling.sample_items(pool.repartition(7), 5, seed=1))
    assert first != rows_of(sampling.sample_items(pool, 5, seed=2))
    assert sampling.sample_items(pool, 80).count() == 50
    one = sampling.sample_items(pool.limit(1)).collect()
    assert len(one) == 1


def test_fraction_has_no_repeats(make):
    pool = make([(k, f"t{k}", None) for k in range(2000)], schemas.ITEMS)
    drawn = sampling.sample_fraction(pool, 0.1)
    assert 120 < drawn.count() < 280
    assert drawn.distinct().count() == drawn.count()


def test_append_matches_columns_by_name(make):
    old = make([(1, 2, 3.0)], schemas.RATINGS)
    new = make([(20, 10, 4.0)], "item_id bigint, user_id bigint, rating double")
    assert rows_of(append.append_ratings(old, new)) == [(1, 2, 3.0), (10, 20, 4.0)]


def test_append_keeps_repeats_or_the_latest(make):
    schema = "user_id bigint, item_id bigint, rating double, rated_at timestamp_ntz"
    from datetime import datetime
    early, late = datetime(2000, 1, 1), datetime(2001, 1, 1)
    old = make([(1, 2, 5.0, late), (1, 3, 1.0, early), (1, 4, 2.0, None)], schema)
    new = make([(1, 2, 1.0, early), (1, 3, 2.0, early), (1, 4, 1.0, early)], schema)
    assert append.append_ratings(old, new).count() == 6
    latest = append.append_ratings(old, new, on_conflict="latest")
    assert rows_of(latest.drop("rated_at")) == [(1, 2, 1.0), (1, 3, 2.0), (1, 4, 1.0)]  # the later batch, whatever its times
    with pytest.raises(ValueError):
        append.append_ratings(old, new, on_conflict="guess")
