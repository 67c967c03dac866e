"""Plumbing for operators that run numpy over Arrow batches in bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import attach

#: Rows and bytes of text that one slice holds; longer texts make a slice of their own.
SLICE_ROWS, SLICE_BYTES = 512, 4 << 20


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that no slice holds more than ``rows`` rows or about ``size`` bytes."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, min(rows, n * size // max(1, batch.nbytes)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def texts(column: pa.Array) -> list[str]:
    """The strings of a column, null as empty."""
    return [x or "" for x in column.to_pylist()]


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def map_tasks(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str | T.StructType, **limits: int) -> DataFrame:
    """``mapInArrow`` with a function from a slice to the columns of its results.

    ``start`` makes the function anew in each task, so what it remembers goes when the task ends and
    a worker that serves another operator next holds nothing of it.
    """
    attach(df.sparkSession)
    spark_schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow_schema = to_arrow_schema(spark_schema)

    def run(batches):
        function = start()
        for part in slices(batches, **limits):
            columns = function(part)
            yield pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in arrow_schema], schema=arrow_schema)

    return df.mapInArrow(run, spark_schema)


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str | T.StructType, **limits: int) -> DataFrame:
    """:func:`map_tasks` with a function that remembers nothing."""
    return map_tasks(df, lambda: function, schema, **limits)
