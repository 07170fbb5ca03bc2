"""What each batch supersedes, written once per batch, so that nothing is grouped again at a read.

Under the rule ``latest`` a pair's row in the last batch that has the pair wins, and within a batch
the newest. For each batch there are two tables: ``dead``, the (user, item, batch) whose rows the
batch made invalid, and ``kept``, the winning row of each pair that the batch itself holds more than
once. Ratings as of a batch are the stored rows without the dead ones up to it, and the kept rows.

A pair dies once in each batch it is in. Changes of the number of rated pairs per item follow from
the same tables and are written beside them.
"""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

if TYPE_CHECKING:
    from ratingloom.plans.store import Store

PAIR = ["user_id", "item_id"]

SETTLED_LOG = T.StructType([
    T.StructField("by", T.LongType()),
    T.StructField("folder", T.StringType()),
])

DEAD = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("batch", T.LongType()),
    T.StructField("by", T.LongType()),
])

KEPT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("rated_at", T.TimestampType()),
    T.StructField("part", T.StringType()),
    T.StructField("batch", T.LongType()),
])

CHANGES = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("n", T.LongType()),
])


def settle(store: Store, upto: int) -> list[str]:
    """Write the tables of the batches that have none yet, in order; folders up to ``upto``."""
    done = _folders(store)
    for by in range(1, upto + 1):
        if by not in done:
            done[by] = _settle_one(store, by, [done[b] for b in range(1, by)])
    return [done[b] for b in range(1, upto + 1)]


def _folders(store: Store) -> dict[int, str]:
    """One folder for each settled batch; two readers who settle one at once write the same rows."""
    rows = store._log("settled_log", SETTLED_LOG).groupBy("by").agg(F.min("folder").alias("folder")).collect()
    return {r.by: r.folder for r in rows}


def _settle_one(store: Store, by: int, before: list[str]) -> str:
    folder = f"settled/by={by}-{uuid.uuid4().hex}"
    path = f"{store.path}/{folder}"
    own = store.rows_of_batch(by).select(*PAIR, "rating", "rated_at", "part", "batch")
    pairs = own.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    repeated = pairs.filter("n > 1").select(*PAIR)
    # the part follows from the pair, so it is the same for all its rows
    newest = F.max(F.struct("rated_at", "rating")).alias("newest")
    kept = own.join(repeated, PAIR, "left_semi").groupBy(*PAIR).agg(newest, F.max("part").alias("part"))
    kept = kept.select(*PAIR, "newest.rating", "newest.rated_at", "part", F.lit(by).cast("bigint").alias("batch"))
    kept.select(*KEPT.names).write.parquet(f"{path}/kept")
    killed = repeated.withColumn("batch", F.lit(by).cast("bigint"))
    changes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    if by > 1:
        earlier = current(store, by - 1, before).select(*PAIR, "batch")
        killed = killed.unionByName(earlier.join(pairs.select(*PAIR), PAIR, "left_semi"))
    killed.withColumn("by", F.lit(by).cast("bigint")).write.parquet(f"{path}/dead")
    if by > 1:
        gone = store.spark.read.schema(DEAD).parquet(f"{path}/dead").filter("by > batch")
        gone = gone.groupBy("item_id").agg((-F.count(F.lit(1))).alias("n"))
        changes = changes.unionByName(gone).groupBy("item_id").agg(F.sum("n").alias("n"))
    changes.write.parquet(f"{path}/changes")
    store._add("settled_log", SETTLED_LOG, (by, folder))
    return folder


def _read(store: Store, folders: list[str], name: str, schema: T.StructType) -> DataFrame:
    return store.spark.read.schema(schema).parquet(*[f"{store.path}/{f}/{name}" for f in folders])


def current(store: Store, upto: int, folders: list[str], part: str | None = None) -> DataFrame:
    """``user_id, item_id, rating, rated_at, batch``: the valid row of every pair as of a batch."""
    rows = store.stored(upto, part).select(*PAIR, "rating", "rated_at", "batch")
    if not folders:
        return rows
    dead, kept = _read(store, folders, "dead", DEAD), _read(store, folders, "kept", KEPT)
    if part is not None:
        kept = kept.filter(F.col("part") == part)
    valid = rows.join(dead, [*PAIR, "batch"], "left_anti")
    again = kept.drop("part").join(dead.filter("by > batch"), [*PAIR, "batch"], "left_anti")
    return valid.unionByName(again)


def rated_pairs(store: Store, folders: list[str]) -> DataFrame:
    """``item_id, n``: how many users have rated each item, as the sum of all batches' changes."""
    if not folders:
        return store.spark.createDataFrame([], CHANGES)
    changes = _read(store, folders, "changes", CHANGES)
    return changes.groupBy("item_id").agg(F.sum("n").alias("n")).filter("n > 0")
