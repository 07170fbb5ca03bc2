"""Which users exist, and ids for new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.operators.profile import distinct_users, max_user_id
from ratingloom.sources.staging import stage
from ratingloom.workspace import fresh_path


def known_users(
    requests: DataFrame, users: DataFrame, mode: str = "exists", largest: int | None = None
) -> DataFrame:
    """Add ``known``. ``exists``: the user is among ``users`` (any table with ``user_id``, such as
    the ratings). ``range``: the id is not above the largest one in use, whether it is there or
    not; ``largest`` saves looking for it."""
    if mode == "range":
        top = max_user_id(users).scalar() if largest is None else F.lit(largest)
        within = F.col("user_id") <= top
        return requests.withColumn("known", F.coalesce(within, F.lit(False)))
    if mode != "exists":
        raise ValueError(f"unknown mode {mode!r}")
    return _join_known(requests, distinct_users(users))


def _join_known(requests: DataFrame, users: DataFrame) -> DataFrame:
    """Requests without an id are known without a join, which would bring them all to one task."""
    marked = users.withColumn("_known", F.lit(True))
    named = requests.filter(F.col("user_id").isNotNull())
    nameless = requests.filter(F.col("user_id").isNull()).withColumn("known", F.lit(False))
    joined = (
        named.join(marked, "user_id", "left")
        .withColumn("known", F.coalesce("_known", F.lit(False)))
        .select(*requests.columns, "known")
    )
    return joined.unionByName(nameless)


def repeated_requests(requests: DataFrame) -> DataFrame:
    """``request_id, n`` of ids that several requests use."""
    counted = requests.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def allocate_users(
    requests: DataFrame, users: DataFrame, mode: str = "exists", largest: int | None = None
) -> DataFrame:
    """``request_id, user_id, is_new`` for requests ``request_id, user_id`` (null: any new id).

    ``users`` is any table with ``user_id``; ``largest`` saves looking for the largest id in it.
    ``request_id`` must be unique (see ``repeated_requests``); new ids follow its order.

    ``exists``: a user that is there keeps its id, every other request gets the next free one.
    ``range``: requests are taken one after the other against a running largest id. A null
    raises it by one and gets it; an id above it is new and becomes the largest; an id up to it
    is known and kept.

    Both rules are prefix sums over the requests, so they are done as a two-level scan: requests
    are range-partitioned by ``request_id`` and written with the number of their partition, scanned
    within each in parallel, and shifted by the totals of the partitions before. No window runs
    over all rows, and there are as many ranges as the session has shuffle partitions.
    """
    if mode not in ("exists", "range"):
        raise ValueError(f"unknown mode {mode!r}")
    top = max_user_id(users).scalar() if largest is None else F.lit(largest)
    counted = requests.select("request_id", "user_id")
    if mode == "exists":
        counted = _join_known(counted, distinct_users(users))
        counted = counted.withColumn("_step", (~F.col("known")).cast("bigint"))
        counted = counted.withColumn("_floor", F.lit(None).cast("bigint"))
    else:
        counted = counted.withColumn("_step", F.col("user_id").isNull().cast("bigint"))
        counted = counted.withColumn("_floor", F.col("user_id"))

    scanned = _prefix_scan(counted, "request_id")
    if mode == "exists":
        is_new = ~F.col("known")
        user_id = F.when(is_new, top + F.col("_steps")).otherwise(F.col("user_id"))
    else:
        # Largest id after this request's own step and before its own explicit id.
        running = F.col("_steps") + F.greatest(top, F.col("_floors"))
        is_new = F.col("user_id").isNull() | (F.col("user_id") > running)
        user_id = F.coalesce("user_id", running)
    return scanned.select("request_id", user_id.alias("user_id"), is_new.alias("is_new"))


def _prefix_scan(counted: DataFrame, key: str) -> DataFrame:
    """Add ``_steps``, the sum of ``_step`` up to and with the row, and ``_floors``, the largest
    ``_floor`` less its own ``_steps`` over the rows before."""
    ranges = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = counted.repartitionByRange(ranges, key).withColumn("_range", F.spark_partition_id())
    ranged = stage(numbered, fresh_path(counted.sparkSession, "ranges"))
    upto = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local_steps", F.sum("_step").over(upto))
    local = local.withColumn("_height", F.col("_floor") - F.col("_local_steps"))
    local = local.withColumn("_local_floors", F.max("_height").over(before))

    # One row per range: small enough for one window and a broadcast.
    totals = local.groupBy("_range").agg(
        F.max("_local_steps").alias("_n"), F.max("_height").alias("_top")
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # A height is relative to its own range's start; less the shift it holds everywhere.
    shifts = shifts.withColumn("_base", F.max(F.col("_top") - F.col("_shift")).over(earlier))
    shifts = shifts.select("_range", "_shift", "_base")
    return local.join(F.broadcast(shifts), "_range").select(
        *counted.columns,
        (F.col("_shift") + F.col("_local_steps")).alias("_steps"),
        F.greatest("_base", F.col("_local_floors") - F.col("_shift")).alias("_floors"),
    )
