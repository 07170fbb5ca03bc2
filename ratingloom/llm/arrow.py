"""Python functions over Arrow batches, with ids kept as exact integers and nulls as nulls."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Columns = list
#: Bytes of a group after which memory is given back.
LARGE_GROUP = 256 << 10
#: glibc has this call, other C libraries give back by themselves.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def findable(table: DataFrame) -> DataFrame:
    """Lets Python workers that start in another folder find this package where it is installed
    at the same place; otherwise ship it with --py-files."""
    table.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return table


def give_back() -> None:
    """Returns freed memory to the system: Spark uses a worker again for later tasks, and what an
    earlier one's arrays took would stay with it otherwise."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def batch_of(columns: Columns, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for column, field in zip(columns, schema, strict=True):
        if isinstance(column, pa.Array):
            arrays.append(column if column.type == field.type else column.cast(field.type))
        else:
            arrays.append(pa.array(column, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def sliced(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that what Python makes of one stays small
    however many rows of whatever length Spark puts together."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for lo in range(0, max(1, batch.num_rows), step):
            yield batch.slice(lo, step)


def map_batches(table: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[Columns]], ddl: str | StructType) -> DataFrame:
    """``run`` takes the batches of a partition and yields lists of columns, as Python lists,
    numpy arrays or Arrow arrays, in the order of the schema."""
    schema = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(schema)
        try:
            for columns in run(batches):
                yield batch_of(columns, target)
        finally:
            give_back()

    return findable(table).mapInArrow(apply, schema)


def map_groups(table: DataFrame, keys: list[str], run: Callable[[pa.Table], Columns], ddl: str | StructType) -> DataFrame:
    """``run`` takes all rows of a group, which the caller keeps bounded, and returns columns."""
    schema = StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl

    def apply(rows: pa.Table) -> pa.Table:
        out = pa.Table.from_batches([batch_of(run(rows), to_arrow_schema(schema))])
        if rows.nbytes >= LARGE_GROUP:
            give_back()
        return out

    return findable(table).groupBy(*keys).applyInArrow(apply, schema)
