"""Rating forms: an ordered list of name/value fields, three per rated item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import strip, to_id, to_number
from ratingloom.sources.rejects import parsed_reason


def parse_submissions(submissions: DataFrame, fields: str = "fields") -> DataFrame:
    """One row per filled-in triple (title, item, rating); the other columns are kept.

    A triple with a blank title and an incomplete last triple carry no rating and are left out.
    A triple whose item or rating is not a number is kept with a ``reason``.
    """
    keys = [c for c in submissions.columns if c != fields]
    triples = F.floor(F.size(fields) / 3).cast("int")
    # With no whole triple the sequence would count down from 0, so it is cut to nothing.
    starts = F.slice(F.sequence(F.lit(0), F.greatest(triples, F.lit(1)) - 1), F.lit(1), triples)

    def value(position: Column) -> Column:
        return F.get(F.col(fields), position)["value"]

    rated = F.transform(
        starts,
        lambda k: F.struct(
            (F.length(strip(value(k * 3))) > 0).alias("titled"),
            value(k * 3 + 1).alias("item"),
            value(k * 3 + 2).alias("rating"),
        ),
    )
    entries = submissions.select(*keys, F.explode(rated).alias("entry")).filter("entry.titled")
    # A second generator keeps the parsed numbers, so that a filter on the reason doesn't parse again.
    parsed = F.struct(
        to_id(F.col("entry.item"), "int").alias("item_id"),
        to_number(F.col("entry.rating")).alias("rating"),
    )
    return (
        entries.select(*keys, F.explode(F.array(parsed)).alias("p"))
        .select(*keys, "p.item_id", "p.rating")
        .withColumn("reason", parsed_reason(F.when(F.lit(False), "")))
    )
