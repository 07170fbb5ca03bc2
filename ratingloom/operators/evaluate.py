"""How far predictions are from the ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rmse(
    predictions: DataFrame, label: str = "rating", prediction: str = "prediction"
) -> DataFrame:
    """``n, rmse`` over the rows that have a prediction: one aggregate, null when there are none."""
    predicted = F.nanvl(F.col(prediction).cast("double"), F.lit(None).cast("double"))
    # Null where there is no prediction, which both aggregates pass over.
    errors = predictions.select((F.col(label) - predicted).alias("error"))
    return errors.agg(
        F.count("error").alias("n"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
    )
