"""Vectors of whole numbers in tasks: which rows have one, and how a batch of them becomes a matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components of whole-number vectors stay below this, so that sums of products over 64 components fit in 64 bits.
LARGEST = 1 << 27


def usable(vector: Column, size: int | None = None) -> Column:
    """Whether a vector is there, has ``size`` components (any number where None) and each of them is a finite number."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    right = vector.isNotNull() & finite
    return F.coalesce(right if size is None else right & (F.size(vector) == size), F.lit(False))


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * c) of each component as a double, without a negative zero."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a list column as rows; shorter ones end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == size).all():
        return flat.reshape(-1, size)
    found = np.zeros((len(column), size), dtype=flat.dtype)
    found[np.arange(size)[None, :] < lengths[:, None]] = flat
    return found


def checked(found: np.ndarray, largest: int = LARGEST) -> np.ndarray:
    """``found``, none of whose numbers may be larger than what the arithmetic that follows holds exactly."""
    if found.size and max(-int(found.min()), int(found.max())) > largest:
        raise ValueError(f"a vector has a component beyond {largest}")
    return found


def blocks_of(vectors: DataFrame, size: int, largest: int) -> DataFrame:
    """(kind, cells): the whole-number vectors ``x`` as binary matrices of ``size`` columns, in the smallest kind of integer that holds them.

    What is read again and again then costs little more than its bytes. The
    order of the rows plays no role in them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = checked(matrix(batch.column("x"), size), largest)
            if len(x):
                most = max(-int(x.min()), int(x.max()))
                kind = next(k for k in ("<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], ["kind", "cells"])

    return vectors.select("x").mapInArrow(run, "kind string, cells binary")


def matrices(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The matrices of ``blocks_of``, as 64-bit integers."""
    for kind, cells in zip(batch.column("kind").to_pylist(), batch.column("cells"), strict=True):
        yield np.frombuffer(cells.as_buffer(), kind).reshape(-1, size).astype(np.int64)


def column_sums(blocks: DataFrame, size: int) -> tuple[int, list[int]]:
    """How many rows the matrices have, and the exact sum of each of their ``size`` columns.

    A task sends one row per column; the sums are decimals, so no number of rows overflows them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(size, dtype=object)
        for batch in batches:
            for part in matrices(batch, size):
                n += len(part)
                sums += part.sum(axis=0).astype(object)
        values = pa.array([*map(str, sums), str(n)], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1, dtype=np.int32)), values], ["at", "value"])

    parts = blocks.mapInArrow(run, "at int, value string")
    rows = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found = {r["at"]: int(r["value"]) for r in rows}
    return found.get(size, 0), [found.get(i, 0) for i in range(size)]
