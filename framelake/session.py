"""Session defaults and durable materialisation."""

from __future__ import annotations

import contextlib
import gc
import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Numbering passes leave checkpoint files behind; let Spark drop them once
    # the DataFrame that owns them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
}


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle width: about 128 MiB each, never fewer than two per core.

    AQE can merge partitions at run time but cannot add any, so a large job has
    to start wide.
    """
    return max(2 * cores, math.ceil(input_bytes / target_bytes), 1)


def build(app: str, master: str | None = None, cores: int = 8, input_bytes: int = 0,
          extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the duration of one eager job."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def wide_enough(df: DataFrame):
    """Start the shuffles of an eager job wide enough for the optimizer's size estimate
    of ``df``. AQE merges what turns out too small, so only a floor is set, and a
    width already configured higher stays."""
    spark = df.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = int(spark.conf.get(INITIAL, None) or 0)
    estimate = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # Tables without statistics, such as local rows, report an absurd size.
    wanted = shuffle_partitions(estimate, 0) if estimate < 1 << 60 else 0
    return settings(spark, {INITIAL: str(wanted)} if wanted > max(configured, before) else {})


def pin_utc(spark: SparkSession) -> None:
    """Stamps and MJD are defined in UTC; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession, label: str) -> str:
    """New folder on shared storage, removed when the driver ends.

    For tables that the returned DataFrame still reads, so that they cannot be
    deleted any earlier.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return system.makeQualified(path).toString()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to shared storage as compressed Parquet and read back: like ``durable``,
    for tables of which later jobs read a few columns or which are large."""
    folder = f"{scratch(df.sparkSession, label)}/table"
    df.write.option("compression", "zstd").parquet(folder)
    found = df.sparkSession.read.schema(df.schema).parquet(folder)
    found._stored_in = folder
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing will read again, and let Spark drop the
    shuffle files of jobs whose plans nothing refers to any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_in)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    for table in tables[:1]:
        table.sparkSession._jvm.System.gc()


def durable(df: DataFrame) -> DataFrame:
    """Materialise on shared storage and cut the lineage.

    Survives executor loss, and freezes values such as row ids that would
    differ if the plan were evaluated twice.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (as ``--py-files`` would)."""
    context = spark.sparkContext
    if getattr(context, "_framelake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), "framelake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    context._framelake_shipped = True
