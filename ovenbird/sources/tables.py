"""Table plumbing: session tables, column defaults and writes of tables.

Paths go through Spark's writers, so the same code works on any file system
that a cluster shares.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import work_dir


def session_table(df: DataFrame, name: str) -> DataFrame:
    """``CREATE TEMPORARY TABLE name AS SELECT``: a stored snapshot under a name of
    the session.  Later changes of the source don't show, and readers don't compute it
    again; ``drop_session_table`` releases it."""
    path = work_dir(df.sparkSession, f"session-{name}-{uuid.uuid4().hex}")
    replace_table(df, path)
    df.sparkSession.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_session_table(spark: SparkSession, name: str) -> None:
    """Remove a session table and its stored rows."""
    files = spark.table(name).inputFiles()
    spark.catalog.dropTempView(name)
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill omitted columns with their declared defaults (a column that is
    present keeps its values, NULLs included, as an INSERT with the column
    listed would)."""
    out = df
    for name, expr in defaults.items():
        if name not in out.columns:
            out = out.withColumn(name, expr)
    return out


def replace_partitions(df: DataFrame, path: str, by: list[str], rebalance: bool = True) -> None:
    """Write ``df`` over the partitions that it has rows for; others stay.  A
    hot partition is split over tasks (``rebalance``), small ones share one.  Rows read
    from files that are partitioned by ``by`` need no shuffle for that: scans split
    large files and share small ones, and a file has rows of one partition only."""
    out = df.hint("rebalance", *by) if rebalance else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def append_rows(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """``INSERT INTO``: append to a (partitioned) table folder."""
    out = df.hint("rebalance", *by) if by else df
    w = out.write.mode("append")
    (w.partitionBy(*by) if by else w).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """``CREATE OR REPLACE TABLE AS SELECT`` of a result that doesn't read
    ``path`` itself; the commit replaces the folder's files."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
