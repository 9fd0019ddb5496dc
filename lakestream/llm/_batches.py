"""Arrow batch helpers shared by the operators that run Python inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lakestream.llm import _hashing

#: Text bytes that an operator looks at together; a longer document comes alone.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and the offsets of its rows (a null is empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text column of each holds at most ``budget`` bytes, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + budget, "right")))
            yield batch.slice(at, to - at)
            at = to


def task(run: Callable) -> Callable:
    """A function for mapInArrow that gives the worker's unused memory back when a task ends.

    Workers outlive tasks and stages; what their allocators keep would be
    missing to the next stage's.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _hashing.forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return whole


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False)
