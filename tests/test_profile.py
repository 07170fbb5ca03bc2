from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.operators import lookup, profile
from tests.conftest import rows_of

ITEMS = [(1, "Heat", "Action"), (2, "Babe", "Family"), (3, "Heat", "Drama"), (4, "Unrated", None)]
RATINGS = [(10, 1, 4.0), (10, 2, 3.0), (11, 2, 5.0), (12, 3, 1.0), (12, 9, 2.0)]


def test_popularity_groups_by_id_not_title_alone(make):
    items, ratings = make(ITEMS, schemas.ITEMS), make(RATINGS, schemas.RATINGS)
    assert rows_of(profile.item_popularity(items, ratings)) == [
        (1, "Heat", 1), (2, "Babe", 2), (3, "Heat", 1)
    ]


def test_popular_items_breaks_ties_by_id(make):
    items, ratings = make(ITEMS, schemas.ITEMS), make(RATINGS, schemas.RATINGS)
    top = [tuple(r) for r in profile.popular_items(items, ratings, 2).collect()]
    assert top == [(2, "Babe", 2), (1, "Heat", 1)]


def test_popularity_counts_a_repeated_catalogue_entry_like_the_join(make):
    items = make(ITEMS + [(2, "Babe", "Other"), (2, "Babe!", "Other")], schemas.ITEMS)
    ratings = make(RATINGS, schemas.RATINGS)
    joined = items.join(ratings, "item_id").groupBy("item_id", "title").count()
    assert rows_of(profile.item_popularity(items, ratings)) == rows_of(joined)


def test_popularity_of_a_hot_item_shuffles_counts_not_rows(spark, make):
    items = make(ITEMS, schemas.ITEMS)
    ratings = spark.range(0, 30_000, 1, 4).select(
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(2 + F.col("id") % 2).alias("item_id"),
        F.lit(3.0).alias("rating"),
    )
    table = profile.item_popularity(items, ratings)
    assert [r["count"] for r in table.orderBy("item_id").collect()] == [10_000] * 3


def test_stats(make):
    items, ratings = make(ITEMS, schemas.ITEMS), make(RATINGS, schemas.RATINGS)
    assert rows_of(profile.dataset_stats(items, ratings)) == [(4, 5, 3, 12)]
    assert rows_of(profile.hottest_keys(ratings)) == [(2, 2)]


def test_empty_tables_have_stats(make):
    items, ratings = make([], schemas.ITEMS), make([], schemas.RATINGS)
    assert rows_of(profile.dataset_stats(items, ratings)) == [(0, 0, 0, 0)]
    assert rows_of(profile.max_user_id(ratings)) == [(0,)]
    assert rows_of(profile.hottest_keys(ratings)) == [(0, 0)]


def test_item_lookup_answers_every_request(make):
    items = make(ITEMS, schemas.ITEMS)
    wanted = make([(1,), (7,), (1,), (None,)], "item_id bigint")
    assert rows_of(lookup.item_lookup(items, wanted)) == sorted([
        (1, "Heat", "Action", "ok"), (1, "Heat", "Action", "ok"), (7, None, None, "not_found"),
        (None, None, None, "not_found"),
    ], key=repr)
    assert rows_of(lookup.item_by_id(items, 2)) == [(2, "Babe", "Family")]


def test_user_ratings_once_per_rating(make):
    ratings = make(RATINGS, schemas.RATINGS)
    users = make([(10,), (10,), (99,), (None,)], schemas.USERS)
    assert rows_of(lookup.user_ratings(ratings, users)) == [(10, 1, 4.0), (10, 2, 3.0)]
    assert rows_of(lookup.ratings_of_user(ratings, 11)) == [(11, 2, 5.0)]


def test_filters_reach_the_scan(spark, make, tmp_path, capsys):
    make(RATINGS, schemas.RATINGS).write.parquet(str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r"))
    lookup.ratings_of_user(stored, 10).explain()
    assert "EqualTo(user_id,10)" in capsys.readouterr().out


def test_requests_are_checked(make):
    requests = make(
        [("1", "5"), ("", "5"), ("x", "5"), ("1", "0"), ("1", "-2"), ("1", "many"), (None, "1")],
        "user string, count string",
    )
    checked = lookup.validate_requests(requests, numeric=["user"], positive=["count"])
    assert [r.reason for r in checked.collect()] == [
        None, "bad_user", "bad_user", "bad_count", "bad_count", "bad_count", "bad_user"
    ]
    assert dict(checked.dtypes)["user"] == "bigint"


def test_an_optional_number_may_be_missing(make):
    requests = make([("1", ""), ("1", " "), ("1", None), ("1", "7"), ("1", "x")],
                    "request_id string, user_id string")
    checked = lookup.validate_requests(requests, ["request_id"], optional=["user_id"])
    assert [(r.user_id, r.reason) for r in checked.collect()] == [
        (None, None), (None, None), (None, None), (7, None), (None, "bad_user_id")
    ]
