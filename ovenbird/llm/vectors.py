"""Vectors as blocks of integers, for the operators that need exact scores.

A component x becomes floor(scale * x), x as a double.  Sums of products must
fit a 64-bit number, so components beyond ``largest(dims)`` are set to it (for 64
components that is 2 ** 27: only values whose distances no bigint could hold).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column

_DOUBLE_MAX = float(np.finfo(np.float64).max)


def largest(dims: int) -> int:
    """A bound b such that ``dims`` squares of differences of numbers within
    [-b, b] sum to less than 2 ** 62."""
    return min((1 << 30) - 1, int(np.sqrt((1 << 62) / max(1, dims)) / 2))


def whole_vectors(df: DataFrame, names: dict[str, str], vector: str, dims: int | None = None) -> DataFrame:
    """The columns ``names`` (new name -> column) and ``embedding`` (array of
    double) of rows whose vector is there and has only finite components, and
    ``dims`` of them if that is given."""
    v = column(df, vector).cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & F.abs(x).between(0.0, _DOUBLE_MAX))
    if dims is not None:
        good = good & (F.size(v) == dims)
    return df.filter(good).select(*[column(df, c).alias(n) for n, c in names.items()], v.alias("embedding"))


def quantise(col: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Rows x dims integers of an Arrow list array without nulls; a shorter
    vector ends in zeros."""
    col = col.cast(pa.large_list(pa.float64())) if not pa.types.is_large_list(col.type) else col
    flat, lengths = col.flatten().to_numpy(zero_copy_only=False), col.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(col), dims))
    if len(flat):
        row = np.repeat(np.arange(len(col)), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        with np.errstate(over="ignore"):
            out[row, place] = np.floor(flat * scale)
    top = largest(dims)
    return np.clip(out, -top, top).astype(np.int64)


def pack(numbers: np.ndarray) -> pa.Array:
    """One binary per row of a matrix of 32-bit or 64-bit numbers."""
    rows, width = numbers.shape[0], numbers.shape[1] * numbers.dtype.itemsize
    off = np.arange(rows + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(off.tobytes()),
                                                     pa.py_buffer(np.ascontiguousarray(numbers).tobytes())])


def unpack(col: pa.Array, width: int, dtype) -> np.ndarray:
    """The matrix of ``pack``."""
    if not len(col) or not width:
        return np.zeros((len(col), width), dtype)
    raw = np.frombuffer(b"".join(col.to_pylist()), dtype=dtype)
    return raw.reshape(len(col), width)


def packed(df: DataFrame, dims: int, scale: int) -> DataFrame:
    """``embedding`` replaced by ``v``: its integers as a binary of 32-bit numbers."""
    keep = [c for c in df.columns if c != "embedding"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            v = pack(quantise(b.column(b.schema.get_field_index("embedding")), dims, scale).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in keep], v], names=[*keep, "v"])
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes if n != "embedding")
    return df.mapInArrow(run, f"{schema}, v binary")
