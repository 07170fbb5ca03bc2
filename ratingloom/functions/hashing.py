"""Hashes of row content: the same row gets the same value under any partitioning or retry."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(seed: int, *columns: str) -> Column:
    """Pseudo-random sort key of a row."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c) for c in columns]))


def hash_bucket(seed: int, buckets: int, *columns: str) -> Column:
    """Bucket number in ``[0, buckets)``, from the first 32 bits of the row's hash."""
    head = F.substring(sample_key(seed, *columns), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)
