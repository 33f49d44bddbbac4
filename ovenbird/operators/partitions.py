"""Partitions by rows.

AQE merges shuffle partitions up to a size in compressed bytes.  A step that needs
many times those bytes in memory, or much time per byte, takes as many partitions
as its rows fill instead: the work of a task then stays the same however many rows
there are.  The rows of a stored table are counted from its files' footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a task.
TASK_ROWS = 100_000


def by_rows(df: DataFrame, rows: int, *keys: str, task_rows: int = TASK_ROWS, least: int = 1) -> DataFrame:
    """``df`` of about ``rows`` rows in partitions by ``keys`` of about ``task_rows`` rows,
    and in ``least`` at least."""
    return df.repartition(max(least, -(-rows // task_rows)), *keys)
