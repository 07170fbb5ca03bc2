"""Uploaded rating files: lines of ``item,rating`` without a header, one user per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.functions import strip, to_id, to_number
from ratingloom.sources.rejects import parsed_reason, user_reason

UPLOAD_FILES = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("user_id", T.LongType()),
])


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    """``user_id, line`` from text files under ``path/user_id=<id>/``. Files split by line, so
    one huge upload is read by many tasks."""
    files = spark.read.schema(UPLOAD_FILES).text(path)
    return files.select("user_id", F.col("value").alias("line"))


def upload_lines(uploads: DataFrame) -> DataFrame:
    """``user_id, line`` from ``user_id, content``, one row per whole uploaded text."""
    lines = F.split(strip(F.col("content")), "\n")
    return uploads.select("user_id", F.explode(lines).alias("line"))


def parse_lines(
    lines: DataFrame, min_rating: float | None = None, max_rating: float | None = None
) -> DataFrame:
    """``user_id, item_id, rating, line, reason``: a bad line is set aside, not fatal. An item id
    outside the int range is as bad as no number."""
    # Generators keep what they make: a filter on the reason doesn't split and match again.
    split = lines.select("user_id", "line", F.explode(F.array(F.split("line", ","))).alias("f"))
    parsed = F.struct(
        to_id(F.get("f", F.lit(0)), "int").alias("item_id"),
        to_number(F.get("f", F.lit(1))).alias("rating"),
    )
    return split.select("user_id", "line", F.explode(F.array(parsed)).alias("p")).select(
        "user_id", "p.item_id", "p.rating", "line"
    ).withColumn("reason", parsed_reason(user_reason(), min_rating, max_rating))
