"""Parquet in hash buckets of a key, which later joins on the key read without a shuffle.

The files are ordinary ones in ordinary folders. A session reads them through an external table of
its own catalog that knows of the buckets; dropping that table leaves the files alone.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gather(table: DataFrame, key: str, buckets: int) -> DataFrame:
    """Brings rows together by bucket. Spark cuts a bucket that is much larger than the others, as
    that of a hot key, into several tasks by size, and puts small ones together."""
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("_bucket")
    return table.select("*", bucket).hint("rebalance", "_bucket").drop("_bucket")


def write_bucketed(gathered: DataFrame, path: str, key: str, buckets: int, partition_by: tuple[str, ...] = ()) -> None:
    """Replace what is under ``path`` by a table from ``gather``. Files are sorted by the key, and keep
    a Bloom filter of it where no dictionary tells as much."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = gathered.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    gathered.sparkSession.sql(f"DROP TABLE {name}")


def bucketed_table(
    spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int,
    partition_by: tuple[str, ...] = (), partitions: Iterable[tuple] = (),
) -> DataFrame:
    """The files under ``path`` with their buckets. Of a partitioned table only the partitions named
    are read; their folders need not be listed to be found."""
    name = "bucketed_" + hashlib.md5(f"{path}|{buckets}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parted = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parted} "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    values = [", ".join(f"{c} = {v!r}" for c, v in zip(partition_by, p)) for p in partitions]
    for lo in range(0, len(values), 1000):
        added = " ".join(f"PARTITION ({v})" for v in values[lo:lo + 1000])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def bucket_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the largest bucket under ``path``, from the names and sizes of the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    bucket = F.regexp_extract("path", r"_(\d{5})\.c\d+[^/]*$", 1)
    return files.groupBy(bucket).agg(F.sum("length").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
