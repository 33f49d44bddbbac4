"""Append-only change feeds on Structured Streaming.

A table that only grows is a folder of parquet files; new files are new rows.
The file source with ``Trigger.AvailableNow`` processes whatever arrived since
the last run and records the offset in its checkpoint only after the sink
write of the micro-batch succeeded (the offset moves on consumption, and a
run with nothing new starts no batch).  Sinks are ``BatchTable`` tables: a batch
replayed after a failure overwrites its own partition.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.changes import insert_feed
from .batches import BatchTable, start_query

#: changes of a batch -> rows to append
Job = Callable[[DataFrame], DataFrame]


def run_available(spark: SparkSession, source_dir: str, schema, checkpoint: str,
                  body: Callable[[DataFrame, int], None], file_format: str = "parquet") -> None:
    """Process every file not yet consumed under ``source_dir`` and stop."""
    stream = spark.readStream.schema(schema).format(file_format).load(source_dir)
    start_query(stream, body, checkpoint).awaitTermination()


def discard(_df: DataFrame, _batch_id: int) -> None:
    """Body of the priming run (the feed starts after the rows present at
    creation, like a stream created without its initial rows)."""
    return None


class AppendFeed:
    """An append-only feed over a landing folder with its own checkpoint."""

    def __init__(self, spark: SparkSession, landing_dir: str, state_dir: str, schema,
                 job: Job | None = None):
        """``job`` turns a batch of changes into the rows to append (default: the
        changes themselves)."""
        self.spark = spark
        self.landing_dir = landing_dir
        self.schema = schema
        self.job = job or (lambda df: df)
        none = insert_feed(spark.createDataFrame([], schema))
        self.sink = BatchTable(spark, os.path.join(state_dir, "sink"), self.job(none).schema)
        self.checkpoint = os.path.join(state_dir, "checkpoint")

    def prime(self) -> None:
        """Skip the rows already present (``SHOW_INITIAL_ROWS = FALSE``)."""
        run_available(self.spark, self.landing_dir, self.schema, self.checkpoint, discard)

    def body(self, df: DataFrame, batch_id: int) -> None:
        self.sink.write(self.job(insert_feed(df)), batch_id)

    def consume(self) -> None:
        """Process the rows that arrived since the last consumption."""
        run_available(self.spark, self.landing_dir, self.schema, self.checkpoint, self.body)

    def consumed(self) -> DataFrame:
        """Everything the job has appended so far (empty if nothing)."""
        return self.sink.read()


def land(df: DataFrame, landing_dir: str) -> None:
    """Append rows to a landing folder as new files."""
    df.write.mode("append").parquet(landing_dir)
