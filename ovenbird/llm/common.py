"""Helpers that the operators of this package share.

Intermediate results go to the shared folder that the session names in
``spark.checkpoint.dir``; nothing is kept on one executor only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: White space of the byte-level contracts: space and \t \n \v \f \r.
SPACES = b" \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of a narrow table that are worth a task of their own.
TASK_ROWS = 200_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """A narrow table of at most ``rows`` rows in no more tasks than they fill
    (a table with more partitions than that is merged, never a larger one split)."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


class Scratch:
    """Tables of one operator call, in a folder of its own under the shared
    checkpoint folder.  ``put`` cuts the lineage: later stages read the files,
    so a lost executor costs only the tasks that were running on it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """``rows``: an upper bound of the rows of ``df``, if one is known."""
        path = f"{self.base}/{name}"
        (df if rows is None else few(df, rows)).write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.delete(path, True)


def column(df: DataFrame, name: str):
    """The column of exactly this name (names may hold dots)."""
    return df[f"`{name}`"]


def free_name(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(text):
    """SHA-256 of a text; a null text is empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def sha(text: str | bytes | None) -> bytes:
    """``text_hash`` in a Python worker."""
    return hashlib.sha256(text.encode("utf-8") if isinstance(text, str) else text or b"").digest()


#: Bytes of an Arrow batch between the JVM and a Python worker (long documents).
BATCH_BYTES = 8 << 20


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and text only (other columns are not read), in batches of bounded
    bytes for the Python workers."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").cast("string").alias("text"))


def text_slices(batch_column, limit: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` bytes together, so that
    work arrays stay bounded; a longer text forms a range of its own."""
    lengths = np.diff(offsets(batch_column))
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def offsets(col) -> np.ndarray:
    """Byte offsets of an Arrow string or binary array (nulls count as empty)."""
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    raw = np.frombuffer(col.buffers()[1], dtype=np.int64)
    return raw[col.offset: col.offset + len(col) + 1].copy() if len(col) else np.zeros(1, np.int64)


def flat_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string array as one byte array, and their offsets
    in it; a null is an empty text."""
    col = col.fill_null("") if col.null_count else col
    big = col.cast(pa.large_binary())
    off = offsets(big)
    data = big.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def batches(it: Iterable[pa.RecordBatch], limit: int = 8 << 20, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Re-cut Arrow batches so that each holds about ``limit`` bytes of text."""
    for b in it:
        if not b.num_rows:
            continue
        col = b.column(b.schema.get_field_index(text))
        for i, j in text_slices(col, limit):
            yield b.slice(i, j - i)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
