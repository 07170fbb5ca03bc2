"""Columnar staging of the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Pieces that the rows of one key are spread over.
SPREAD = 32


def spread(table: DataFrame, *columns: str) -> DataFrame:
    """Bring rows with equal columns together, in up to ``SPREAD`` places.

    The place follows from the row's content: a key that holds a third of the table does not end up
    in one task, a task that is run again sends the same rows the same way, and the input is
    computed once, where ranges would first sample it.
    """
    place = F.pmod(F.xxhash64(*table.columns), F.lit(SPREAD))
    return table.repartition(*columns, place)


def stage(table: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Write a table as parquet, replacing what is there, and read it back.

    With ``cluster_by`` the files are sorted by these columns, so that a filter on them skips row
    groups by their min/max.
    """
    if cluster_by:
        table = spread(table, *cluster_by).sortWithinPartitions(*cluster_by)
    table.write.mode("overwrite").parquet(path)
    return read_staged(table.sparkSession, path)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
