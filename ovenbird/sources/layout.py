"""Co-located tables: facts that are joined on one key are stored in buckets of
that key, so that joins and groupings on it read bucket by bucket and shuffle
neither side.

A table is shuffled once, when it is stored (one file a bucket and write), and
never again by its readers.  Tables join without an exchange if they have the
same number of buckets; it should let a bucket fit into a task (at 100 TB some
tens of thousands).  A bucket is read by one task, so a key must not hold much
more than its share: ``store`` counts the rows of the largest key and stores
the table without buckets if it exceeds ``max_key_rows``; readers then shuffle
and Spark splits the hot key, with the same results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: Rows of one key that a bucket may hold.
MAX_KEY_ROWS = 1_000_000


def store(df: DataFrame, name: str, key: str, buckets: int, max_key_rows: int | None = MAX_KEY_ROWS) -> DataFrame:
    """Store ``df`` as the session's table ``name`` in ``buckets`` buckets of ``key``
    (replacing an earlier one).  ``max_key_rows=None``: the key is known to be unique."""
    spark = df.sparkSession
    even = max_key_rows is None or df.groupBy(key).count().filter(F.col("count") > max_key_rows).isEmpty()
    # Stored beside the earlier table, which may be the source of its successor.
    fresh = f"{name}_{uuid.uuid4().hex}"
    writer = _writer(df, key, buckets) if even else df.write.format("parquet")
    writer.option("path", work_dir(spark, f"layout-{fresh}")).saveAsTable(fresh)
    drop(spark, name)
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    return spark.table(name)


def append(df: DataFrame, name: str, key: str) -> None:
    """Add rows to a stored table, in its buckets (a bucket gets a file more)."""
    buckets = bucket_count(df.sparkSession, name)
    rows = df.select(df.sparkSession.table(name).columns)
    (_writer(rows, key, buckets) if buckets else rows.write.format("parquet")).mode("append").saveAsTable(name)


def _writer(df: DataFrame, key: str, buckets: int):
    # Partitioned as the buckets are, so that a task writes one file.
    return df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)


def bucket_count(spark: SparkSession, name: str) -> int:
    """Buckets of a stored table, 0 if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else 0


def drop(spark: SparkSession, name: str) -> None:
    """Remove the table and its files."""
    if spark.catalog.tableExists(name):
        folder = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()[0]["data_type"]
        spark.sql(f"DROP TABLE {name}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
