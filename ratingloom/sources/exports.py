"""Rows as JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_records(*columns: str) -> Column:
    """The row as a JSON object; null fields are written as null, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_json_records(table: DataFrame, path: str) -> None:
    """One JSON object per line, a part file per partition."""
    table.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
