"""Vectors in Arrow batches as integer matrices, used inside tasks."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Integer components are stored in 32 bits.
MOST = 1 << 31


def whole(column: str = "embedding"):
    """Whether a vector has components and all of them are finite numbers."""
    def finite(x):
        d = x.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) != float("inf"))

    return (F.size(column) > 0) & F.coalesce(F.forall(column, finite), F.lit(False))


def longest(rows: DataFrame, column: str = "embedding") -> int:
    """The greatest length of a vector; 1 without any."""
    return rows.agg(F.max(F.size(column))).first()[0] or 1


def floors(column: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) of the vectors of ``column``, all of one length, as rows
    of a 64-bit matrix. x counts as a double; a result beyond 32 bits raises."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * scale)
    if len(scaled) and np.abs(scaled).max() >= MOST:
        raise OverflowError(f"a component times {scale} does not fit 32 bits")
    return scaled.astype(np.int64).reshape(len(column), -1)


def packed(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    data = np.ascontiguousarray(rows)
    width = data.shape[1] * data.itemsize
    ends = np.arange(len(data) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def unpacked(cells, kind: str, width: int) -> np.ndarray:
    """The matrix whose rows ``packed`` wrote."""
    return np.frombuffer(b"".join(cells), kind).reshape(-1, width)


def batches_of(rows: Iterator[pa.RecordBatch], at_least: int) -> Iterator[pa.Table]:
    """The batches, joined until they hold ``at_least`` rows."""
    held, n = [], 0
    for batch in rows:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= at_least:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
