"""Item and rating tables from CSV, with fixed schemas (never inferred, so read once)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom import schemas


def _read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    # Quotes inside a quoted title are doubled; without `escape` they break the row apart.
    return (
        spark.read.schema(schema).option("header", True).option("sep", ",")
        .option("quote", '"').option("escape", '"').csv(path)
    )


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """``item_id, title, genres``. A field that does not parse is null, see ``null_ids``."""
    return _read_csv(spark, path, schemas.ITEMS)


def read_ratings(spark: SparkSession, path: str, keep_time: bool = False) -> DataFrame:
    """``user_id, item_id, rating`` and, on demand, ``rated_at`` from the epoch seconds."""
    table = _read_csv(spark, path, schemas.RATINGS_CSV)
    if keep_time:
        table = table.withColumn("rated_at", F.timestamp_seconds("timestamp"))
    return table.drop("timestamp")


def write_csv(table: DataFrame, path: str) -> None:
    """Write a table in the format the readers above take."""
    table.write.option("header", True).option("escape", '"').csv(path)
