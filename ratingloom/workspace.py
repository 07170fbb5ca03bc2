"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def local_session(app: str, cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter builds its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local-mode session without the setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="ratingloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query in here has shuffled goes from disk when it ends, not when the driver's garbage
    collector happens to come by. For jobs whose every step is written and read back."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove(spark: SparkSession, *paths: str) -> None:
    """Removes written intermediates that nothing reads any more."""
    sc = spark.sparkContext
    for path in paths:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def findable(table: DataFrame) -> DataFrame:
    """Lets Python workers that start in another folder find this package where it is installed
    at the same place; otherwise ship it with --py-files."""
    table.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return table
