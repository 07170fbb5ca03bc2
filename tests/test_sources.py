import json

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.functions import to_id, to_number
from ratingloom.sources import (
    accepted, json_records, parse_lines, parse_submissions, read_items, read_ratings, read_uploads,
    rejected, stage, upload_lines, write_json_records,
)
from ratingloom.sources.rejects import check_items, check_ratings
from tests.conftest import rows_of


def test_items_with_commas_and_doubled_quotes(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(
        "movieId,title,genres\n"
        '1,"American President, The (1995)",Comedy|Drama\n'
        '2,"""Great Performances"" Cats, Part 1 (1998)",Musical\n'
        "3,Heat (1995),Action\n",
        encoding="utf-8",
    )
    assert rows_of(read_items(spark, str(path))) == [
        (1, "American President, The (1995)", "Comedy|Drama"),
        (2, '"Great Performances" Cats, Part 1 (1998)', "Musical"),
        (3, "Heat (1995)", "Action"),
    ]


def test_bad_csv_rows_are_told_apart(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("movieId,title,genres\nx,Bad id,Drama\n7,Short\n8,Fine,Drama\n")
    checked = check_items(read_items(spark, str(path)))
    assert rows_of(accepted(checked)) == [(7, "Short", None), (8, "Fine", "Drama")]
    assert rows_of(rejected(checked)) == [(None, "Bad id", "Drama", "bad_item")]


def test_ratings_csv_with_and_without_time(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("userId,movieId,rating,timestamp\n1,31,2.5,1260759144\n")
    assert rows_of(read_ratings(spark, str(path))) == [(1, 31, 2.5)]
    timed = read_ratings(spark, str(path), keep_time=True)
    assert timed.select(F.unix_timestamp("rated_at")).first()[0] == 1260759144


def test_check_ratings_names_the_reason(make):
    rows = [
        (1, 2, 3.0), (None, 2, 3.0), (1, None, 3.0), (1, 2, None), (1, 2, float("nan")),
        (2**31, 2, 3.0), (1, -(2**31) - 1, 3.0), (1, 2, float("inf")), (1, 2, 7.0),
    ]
    checked = check_ratings(make(rows, schemas.RATINGS), max_rating=5)
    reasons = [r.reason for r in checked.collect()]
    assert reasons == [
        None, "no_user", "bad_item", "bad_rating", "bad_rating", "user_out_of_range",
        "item_out_of_range", "bad_rating", "rating_out_of_range",
    ]
    assert accepted(check_ratings(make(rows[-1:], schemas.RATINGS))).count() == 1


@pytest.mark.parametrize("text,number", [
    ("7", 7), (" 7\t", 7), ("+7\r", 7), ("-7", -7), ("1.5", None), ("", None), (" ", None),
    ("7x", None), ("9" * 20, None), (None, None),
])
def test_to_id(make, text, number):
    table = make([(text,)], "t string")
    assert table.select(to_id(F.col("t"))).first()[0] == number


@pytest.mark.parametrize("text,number", [
    ("7", 7.0), (" 4.5 ", 4.5), (".5", 0.5), ("5.", 5.0), ("1e1", 10.0), ("5d", None),
    ("5f", None), ("NaN", None), ("Infinity", None), ("0x1p3", None), ("", None), (None, None),
])
def test_to_number(make, text, number):
    table = make([(text,)], "t string")
    assert table.select(to_number(F.col("t"))).first()[0] == number


def test_upload_lines_good_and_bad(make):
    content = "\n\nbad\n\nx,y\n 7 , 4.5 \r\n8,3,extra\n9,1e999\n\n"
    parsed = parse_lines(upload_lines(make([(5, content)], "user_id bigint, content string")))
    assert rows_of(accepted(parsed).drop("line")) == [(5, 7, 4.5), (5, 8, 3.0)]
    refused = {(r.line, r.reason) for r in rejected(parsed).collect()}
    assert refused == {
        ("bad", "bad_item"), ("", "bad_item"), ("x,y", "bad_item"), ("9,1e999", "bad_rating")
    }


def test_uploaded_files_take_the_user_from_the_folder(spark, tmp_path):
    sample = "260,9\n1,8\n16,7\n25,8\n32,9\n335,4\n379,3\n296,7\n858,10\n50,8"
    for user in (3, 4):
        folder = tmp_path / f"user_id={user}"
        folder.mkdir()
        (folder / "ratings.csv").write_text(sample)
    lines = read_uploads(spark, str(tmp_path))
    assert accepted(parse_lines(lines)).groupBy("user_id").count().collect().__len__() == 2
    assert accepted(parse_lines(lines)).count() == 20
    assert rows_of(rejected(parse_lines(lines, max_rating=5)).select("reason").distinct()) == [
        ("rating_out_of_range",)
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(
    st.tuples(
        st.integers(-(2**31), 2**31 - 1),
        st.floats(allow_nan=False, allow_infinity=False, width=32),
    ),
    min_size=1, max_size=20,
))
def test_parsing_undoes_formatting(spark, ratings):
    content = "\n".join(f"{item},{rating!r}" for item, rating in ratings)
    lines = upload_lines(spark.createDataFrame([(1, content)], "user_id bigint, content string"))
    parsed = accepted(parse_lines(lines))
    assert sorted((r.item_id, r.rating) for r in parsed.collect()) == sorted(ratings)


def form(*values):
    return [(f"f{k}", v) for k, v in enumerate(values)]


def submissions(spark, *forms):
    schema = schemas.T.StructType([
        schemas.T.StructField("id", schemas.T.LongType()),
        schemas.T.StructField("fields", schemas.FORM_FIELDS),
    ])
    return spark.createDataFrame(list(enumerate(forms)), schema)


def test_forms_skip_blank_titles_and_a_dangling_triple(spark):
    forms = submissions(
        spark,
        form("Heat", "6", "4", "  ", "7", "5", "Babe", "34", "1"),
        form("Heat", "6", "4", "Babe", "34"),
        form("Heat", "6"),
        form(),
        form("Heat", "six", "4", "Babe", "34", "good"),
    )
    parsed = parse_submissions(forms)
    assert rows_of(accepted(parsed)) == [(0, 34, 1.0), (0, 6, 4.0), (1, 6, 4.0)]
    assert rows_of(rejected(parsed)) == [
        (4, 34, None, "bad_rating"), (4, None, 4.0, "bad_item")
    ]


def test_json_keeps_nulls_and_text(make, spark, tmp_path):
    rows = [(1, 'Say "hi" / é', None), (2, None, "Drama")]
    table = make(rows, schemas.ITEMS)
    texts = [r[0] for r in table.select(json_records(*schemas.ITEM_COLUMNS)).collect()]
    expected = [dict(zip(schemas.ITEM_COLUMNS, row)) for row in rows]
    assert [json.loads(t) for t in texts] == expected
    path = str(tmp_path / "json")
    write_json_records(table, path)
    written = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert sorted(written, key=lambda r: r["item_id"]) == expected


def test_staging_spreads_a_hot_key_and_prunes(spark, tmp_path):
    hot = spark.range(0, 200_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("user_id"),
        F.col("id").alias("item_id"), F.lit(1.0).alias("rating"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = stage(hot, str(tmp_path / "r"), cluster_by=["user_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert staged.count() == 200_000
    assert rows_of(staged.exceptAll(hot)) == []
    per_file = staged.filter("user_id = 7").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1
    assert max(r["count"] for r in per_file) < 200_000 / 4
