"""Rating files dropped into a folder, appended to the store in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratingloom.plans.store import Store
from ratingloom.sources.uploads import UPLOAD_FILES, parse_lines


def watch_uploads(spark: SparkSession, inbox: str, max_files: int = 10_000) -> DataFrame:
    """``user_id, line`` of files as they land under ``inbox/user_id=<id>/``."""
    files = (
        spark.readStream.schema(UPLOAD_FILES).option("maxFilesPerTrigger", max_files).text(inbox)
    )
    return files.select("user_id", F.col("value").alias("line"))


def ingest_uploads(
    store: Store, inbox: str, checkpoint: str, name: str = "uploads",
    min_rating: float | None = None, max_rating: float | None = None,
) -> StreamingQuery:
    """Append all files waiting in the inbox, then stop. One refit can follow many appends.

    A batch is named by the stream, whose id its checkpoint keeps, and its number: replayed after a
    failure it is recognised by the store, and each file is appended once. Another inbox or a new
    checkpoint is another stream. Lines that can't be read are kept as rejects.
    """

    def append(lines: DataFrame, number: int) -> None:
        stream = lines.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        parsed = parse_lines(lines, min_rating, max_rating)
        store.append(parsed, source=f"{name}:{stream or checkpoint}:{number}")

    return (
        watch_uploads(store.spark, inbox)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
