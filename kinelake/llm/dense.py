"""Sums of fixed-size count arrays over all documents.

Every task adds up one array and hands on its rows that are not all zero; rows meet by number, spread over tasks; the
driver gets one array of the fixed size. What is shuffled follows the number of tasks, so the input; what is held
follows the array's size alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinelake.llm import textkit as K
from kinelake.llm.store import n_partitions

SCHEMA = "k int, v binary"


def _rows(found) -> Iterator[pa.RecordBatch]:
    for k, v in found:
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.astype("<u4" if int(v.max()) < 1 << 32 else "<u8").tobytes()], pa.binary())], names=["k", "v"])


def total(docs: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None], shape: tuple[int, int]) -> np.ndarray:
    """`count` adds what a batch has to the task's array of this shape; the sum over all tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                count(batch, held)
        yield from _rows((k, held[k]) for k in np.flatnonzero(held.any(axis=1)).tolist())
        K.tidy()

    def one(data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u4" if len(data) == 4 * shape[1] else "<u8").astype(np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[k] = one(v) + found.get(k, 0)
        yield from _rows(found.items())

    out = np.zeros(shape, np.int64)
    sums = docs.mapInArrow(partial, SCHEMA).repartition(min(shape[0], n_partitions(docs.sparkSession)), "k").mapInArrow(add, SCHEMA)
    for k, v in sums.toLocalIterator():
        out[k] += one(v)
    return out
