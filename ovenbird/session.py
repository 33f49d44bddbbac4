"""Session construction and the few settings every job relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the jobs assume. UTC keeps timestamp_ntz arithmetic and the oracle
# comparison stable; ANSI stays on so failed casts raise like the source dialect.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python-side call-site capture costs several JVM round trips per column
    # function; plans are built from hundreds of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Optional heap for local runs (all tasks share the driver JVM); measured on
# this machine the default heap was as fast as 8 GB for the bench, so it is
# only set when asked for.
LOCAL_DRIVER_MEMORY = os.environ.get("OVENBIRD_LOCAL_DRIVER_MEMORY")

# Settings for the large-cluster deployment (about 100 TB of facts on ~1000
# executors).  Shuffle partitions start high and AQE coalesces them to the
# advisory size; skewed partitions are split; scans read 256 MB splits; a
# join side is broadcast only when its measured size is under 64 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "128",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings of a job whose steps are stored and read again by the next one.  Spark keeps the
# shuffle files of a step until the driver's garbage collector finds its plan, so without the
# first they add up over all steps; with it they go when the step is stored.  A frame that is
# run twice meanwhile shuffles again.  Streams started meanwhile keep these settings.
STORED_STEPS_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ovenbird", cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with the engine's settings applied
    (``cluster=True`` adds ``CLUSTER_CONF``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local") and LOCAL_DRIVER_MEMORY:
            builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    for key, value in {**BASE_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the settings that can change on a running session (static ones,
    such as the debugging switch, only take effect in ``build_session``)."""
    spark.conf.set("spark.sql.session.timeZone", BASE_CONF["spark.sql.session.timeZone"])


_steps_lock = threading.Lock()
#: session -> how many blocks are open, and what they will put back
_steps_open: dict[int, tuple[int, dict[str, str | None]]] = {}


@contextmanager
def stored_steps(spark: SparkSession) -> Iterator[None]:
    """Run a block under ``STORED_STEPS_CONF``.  Blocks may be nested or open in several
    threads at once (sinks of streams); the last one to end puts the settings back."""
    session = spark._jvm.System.identityHashCode(spark._jsparkSession)
    with _steps_lock:
        if session not in _steps_open:
            was = spark.conf.getAll
            _steps_open[session] = (0, {k: was.get(k) for k in STORED_STEPS_CONF})
            for k, v in STORED_STEPS_CONF.items():
                spark.conf.set(k, v)
        n, before = _steps_open[session]
        _steps_open[session] = (n + 1, before)
    try:
        yield
    finally:
        with _steps_lock:
            n, before = _steps_open.pop(session)
            if n > 1:
                _steps_open[session] = (n - 1, before)
            else:
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared filesystem and is used as is. Only
    a local master (one machine, as in tests) may leave it unset: then a scratch
    folder is made and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ovenbird-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)  # made here, removed here
        spark.conf.set("spark.checkpoint.dir", configured)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)
