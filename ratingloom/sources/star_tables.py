"""Items and ratings read out of an order-processing star schema: each line item is one rating
of a part by the customer who ordered it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genres"),
    )


def timed_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """``user_id, item_id, rating, rated_at``."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5) * 0.5).cast("double").alias("rating"),
        F.col("o_orderdate").alias("rated_at"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return timed_ratings(spark, folder).drop("rated_at")
