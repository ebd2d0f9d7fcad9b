"""Arrow batches in and out of Python steps."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and share a machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, step: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` over dicts of columns: lists in, lists or arrays out.

    ``step`` gets an iterator of ``{column: arrow array}`` and yields ``{column: values}``.
    """
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        columns = ({n: b.column(i) for i, n in enumerate(b.schema.names)} for b in batches)
        try:
            for out in step(columns):
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in ((out[f.name], f) for f in target)], schema=target
                )
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def map_series(value: Callable, kind: str) -> Callable[..., Column]:
    """A column function from ``value()``, which makes a task's function of single values.

    Arrow arrays only: a worker that never loads pandas is a third smaller.
    """
    target = to_arrow_schema(StructType.fromDDL(f"v {kind}")).field(0).type

    @arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = value()
        try:
            for values in batches:
                yield pa.array((one(v.as_py()) for v in values), target, size=len(values))
        finally:
            give_back()

    return run


def map_arrays(step: Callable[[Iterator[pa.Array]], Iterator[list]], kind: str) -> Callable[..., Column]:
    """A column function from ``step``, which turns each of a task's arrays into a list of values."""
    target = to_arrow_schema(StructType.fromDDL(f"v {kind}")).field(0).type

    @arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for values in step(batches):
                yield pa.array(values, target)
        finally:
            give_back()

    return run
