"""All logs of a store in one file per version, put in place by a rename that never replaces a file.

A version holds the rows of every log as JSON lines (``log``, ``row``) and is never changed. The next
one is written beside it by Spark, rows of the last one and new ones, and counts from the moment it
has its name; a writer that dies before leaves nothing visible. A writer that finds the name taken
starts again from the version that took it, so no row is lost. Reading takes one listing of a folder
of at most ``KEPT`` names and one file, however many rows were added.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Versions that stay for readers who began earlier.
KEPT = 100
#: How often a writer starts again when others are faster.
ATTEMPTS = 20
ENTRIES = T.StructType([T.StructField("log", T.StringType()), T.StructField("row", T.StringType())])
_NAME = re.compile(r"v(\d{10})\.json")


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}/manifest"
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._fs.Path(self.path)
        self._files = self._folder.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """The numbers of the versions there are, rising."""
        if not self._files.exists(self._folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(self._folder)]
        return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)

    def entries(self, version: int | None = None) -> DataFrame:
        """``log, row`` of all logs, of the last version or an earlier one."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).json(self._file(version))

    def log(self, name: str, schema: T.StructType) -> DataFrame:
        own = self.entries().filter(F.col("log") == name)
        return own.select(F.from_json("row", schema).alias("r")).select("r.*")

    def add(self, name: str, schema: T.StructType, *rows: tuple) -> None:
        given = self.spark.createDataFrame(list(rows), schema)
        self.extend(given.select(F.lit(name).alias("log"), F.to_json(F.struct(*schema.names)).alias("row")))

    def extend(self, entries: DataFrame) -> None:
        """Makes the next version: the last one's rows and these."""
        for _ in range(ATTEMPTS):
            there = self.versions()
            last = there[-1] if there else None
            rows = entries if last is None else self.entries(last).unionByName(entries)
            folder = f"{self.path}/_writing-{uuid.uuid4().hex}"
            rows.coalesce(1).write.json(folder)
            try:
                won = self._put(folder, 0 if last is None else last + 1)
            finally:
                self._files.delete(self._fs.Path(folder), True)
            if won:
                for old in there[:1 - KEPT]:
                    self._files.delete(self._fs.Path(self._file(old)), False)
                return
        raise RuntimeError(f"{self.path}: other writers were faster {ATTEMPTS} times")

    def _file(self, version: int) -> str:
        return f"{self.path}/v{version:010}.json"

    def _put(self, folder: str, version: int) -> bool:
        """Gives the written file the version's name, unless another has it."""
        found = self._files.globStatus(self._fs.Path(f"{folder}/part-*"))
        source = self._files.makeQualified(found[0].getPath())
        target = self._files.makeQualified(self._fs.Path(self._file(version)))
        context = self._fs.FileContext.getFileContext(source.toUri(), self._conf)
        gateway = self.spark.sparkContext._gateway
        plain = gateway.new_array(self._fs.Options.Rename, 1)
        plain[0] = self._fs.Options.Rename.NONE
        try:
            context.rename(source, target, plain)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True
