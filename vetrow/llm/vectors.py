"""Vectors as bytes: what the two vector operators read from an array column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vetrow.llm.common import map_batches


def component_type(df: DataFrame, column: str) -> np.dtype:
    """float32 for arrays of floats, else float64."""
    kind = df.schema[column].dataType
    return np.dtype("<f4") if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else np.dtype("<f8")


def as_bytes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, class_id, dim, vec`` of every row: the components as bytes and the hash of them (equal
    vectors share it). Null where the vector or its id is null, empty, zero, or holds null or non-finite components."""
    kind = component_type(df, vector_col)

    def one(values) -> bytes | None:
        if values is None or len(values) == 0 or None in values:
            return None
        v = np.array(values, kind) + kind.type(0)  # no negative zeros
        return v.tobytes() if np.isfinite(v).all() and v.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            raw = [one(v) if i is not None else None for i, v in zip(ids.to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([None if r is None else xxhash.xxh3_64_intdigest(r) - (1 << 63) for r in raw], pa.int64()),
                pa.array([None if r is None else len(r) // kind.itemsize for r in raw], pa.int32()),
                pa.array(raw, pa.binary())], ["vec_id", "class_id", "dim", "vec"])

    return map_batches(df.select(F.col(id_col).cast("long"), F.col(vector_col).cast(T.ArrayType(T.FloatType() if kind.itemsize == 4 else T.DoubleType()))),
                       run, "vec_id long, class_id long, dim int, vec binary")


def matrix(raw: list[bytes], kind: np.dtype) -> np.ndarray:
    """Rows of equal length in double precision."""
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
