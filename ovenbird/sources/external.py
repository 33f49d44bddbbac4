"""External-table style scans: typed columns computed from a semi-structured
``value`` column of parquet files in a stage folder, and the writer that lands
partner files there."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.variant import object_of


FILE_METADATA = ("file_path", "file_name", "file_size", "file_block_start", "file_block_length", "file_modification_time")


def stage_path(base: str, partner: str) -> str:
    """``@stage/partner/`` — one subfolder per partner under a base URL."""
    return os.path.join(base.rstrip("/"), partner) + "/"


def land_objects(df: DataFrame, path: str, mode: str = "append", by: dict[str, Column] | None = None) -> None:
    """Write each row as one semi-structured ``value`` object (parquet).  ``by``:
    columns of the path (``name=value`` folders), computed from the row."""
    value = object_of(**{c: F.col(c) for c in df.columns}).alias("value")
    if by:
        rows = df.select(value, *[c.alias(name) for name, c in by.items()]).hint("rebalance", *by)
        rows.write.mode(mode).partitionBy(*by).parquet(path)
    else:
        df.select(value).write.mode(mode).parquet(path)


def external_scan(spark: SparkSession, path: str, schema: T.StructType,
                  paths: dict[str, str] | None = None, objects: bool = False,
                  partitions: T.StructType | None = None, file_columns: dict[str, Column] | None = None) -> DataFrame:
    """Typed scan over ``value`` objects: column ``c`` = ``value:path::type``
    (strict cast; a value that does not convert fails the query).  Files
    with plain columns instead of ``value`` are read as objects of their
    columns.  ``objects``: the files are known to hold ``value``, so no file
    footer is read to infer a schema.

    ``partitions``: columns of the path (``name=value`` folders); a filter on them
    leaves out whole folders.  ``file_columns``: columns over the metadata of the
    file that a row comes from (``FILE_METADATA``)."""
    extra = list(partitions.fields) if partitions else []
    if objects:
        raw = spark.read.schema(T.StructType([T.StructField("value", T.VariantType()), *extra])).parquet(path)
    else:
        raw = spark.read.parquet(path)
    if file_columns:
        raw = raw.select("*", "_metadata.*")
    if "value" not in raw.columns:
        known = {f.name for f in extra} | (set(FILE_METADATA) if file_columns else set())
        own = {c: F.col(c) for c in raw.columns if c not in known}
        raw = raw.select(object_of(**own).alias("value"), *[c for c in raw.columns if c in known])
    paths = paths or {}
    cols = []
    for f in schema.fields:
        p = paths.get(f.name, f.name)
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.variant_get("value", f"$.{p}", "variant").alias(f.name))
        else:
            cols.append(F.variant_get("value", f"$.{p}", f.dataType.simpleString()).alias(f.name))
    cols += [F.col(f.name).cast(f.dataType) for f in extra]
    cols += [c.alias(name) for name, c in (file_columns or {}).items()]
    return raw.select(*cols)


def path_value(name: str) -> Column:
    """A file column: the value of a ``name=value`` folder of the file's path."""
    return F.nullif(F.regexp_extract("file_path", f"/{name}=([^/]*)/", 1), F.lit(""))
