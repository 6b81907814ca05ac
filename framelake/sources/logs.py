"""Receiver logs and buffer snapshots as typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.functions.header import value_of
from framelake.operators import ordered

# Shapes of the log lines.
PROGRESS = (r"\[Progress\] Blocks written: (\d+) \| Ring buffer: ([0-9.]+)% full "
            r"\((\d+)/(\d+) MB\)")
BANDWIDTH = r"total_recv:\s*(\d+)\s*KB,Process Bandwidth:\s*([0-9.]+) Gbps,cost time:(\d+)ms"
IDLE = r"total_recv:\s*(\d+)\s+Bandwidth: 0 Gbps, cost time us_elapsed:\s*(\d+)"
STARTED = r"Run started at: (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
ENDED = r"Run ended at: (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"
LEVEL = r"^\[(ERROR|WARN|DEBUG)\]\s*(.*)$"
COUNTER = r"^\s*(header_state|blocks_in_use|bytes_written|bytes_read|bytes_available)[ \t]*:[ \t]*(\S+)\s*$"
# The same lines as format strings, for rendering.
PROGRESS_LINE = "[Progress] Blocks written: %d | Ring buffer: %.1f%% full (%d/%d MB)"
BANDWIDTH_LINE = "NowTime:%s,gpu_id:0,total_recv:%-8dKB,Process Bandwidth:%6.3f Gbps,cost time:%dms"
IDLE_LINE = "total_recv: 0          Bandwidth: 0 Gbps, cost time us_elapsed: %d "
STARTED_LINE = "Run started at: %s"
COUNTER_LINE = "%s : %d"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Log lines as (file, block, line, value), ordered by (block, line) in a file.

    The text reader splits large logs. Lines keep their order through the start of
    the split and a row id that grows inside it, so no file has to be one row.
    """
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")


def classify(lines: DataFrame) -> DataFrame:
    """Kind of every line with its figures. A line that is not recognised, or whose figures are
    damaged, has kind ``other`` and no figures."""
    v = F.col("value")

    def figures(pattern: str, **kinds):
        """The groups of a pattern as columns, and whether all of them can be read."""
        found = {n: F.nullif(F.regexp_extract(v, pattern, i), F.lit("")).try_cast(k)
                 for i, (n, k) in enumerate(kinds.items(), 1)}
        ok = reduce(lambda a, b: a & b, [c.isNotNull() for c in found.values()])
        return {n: F.when(ok, c) for n, c in found.items()}, ok

    progress, is_progress = figures(PROGRESS, blocks="bigint", fill_pct="double", used_mb="bigint",
                                    total_mb="bigint")
    busy, is_busy = figures(BANDWIDTH, kb="bigint", gbps="double", elapsed_ms="bigint")
    idle, is_idle = figures(IDLE, kb="bigint", us="bigint")
    started, is_started = figures(STARTED, at="timestamp_ntz")
    ended, is_ended = figures(ENDED, at="timestamp_ntz")
    kind = (F.when(is_progress, "progress").when(is_busy, "bandwidth").when(is_idle, "idle")
            .when(is_started, "started").when(is_ended, "ended").when(v.rlike(COUNTER), "snapshot")
            .when(v.rlike(LEVEL), F.lower(F.regexp_extract(v, LEVEL, 1)))
            .otherwise("other"))
    return lines.select(
        *[c for c in lines.columns if c != "value"], kind.alias("kind"),
        *[progress[c].alias(c) for c in ("blocks", "fill_pct", "used_mb", "total_mb")],
        F.coalesce(busy["kb"], F.when(is_idle, F.lit(0).cast("bigint"))).alias("kb"),
        F.coalesce(busy["gbps"], F.when(is_idle, F.lit(0.0))).alias("gbps"),
        F.coalesce(busy["elapsed_ms"], F.call_function("div", idle["us"], F.lit(1000).cast("bigint"))
                   ).alias("elapsed_ms"),
        F.coalesce(started["at"], ended["at"]).alias("marked_at"),
        F.when(v.rlike(COUNTER), F.regexp_extract(v, COUNTER, 1)).alias("counter"),
        F.when(v.rlike(COUNTER), F.regexp_extract(v, COUNTER, 2)).try_cast("bigint").alias("amount"),
        F.when(v.rlike(LEVEL), F.regexp_extract(v, LEVEL, 2)).alias("message"))


def with_run(rows: DataFrame, file: str, order: list[str]) -> DataFrame:
    """Number the runs of each file (how many start markers precede the line) and its lines."""
    return ordered.running_sums(
        rows, [file], order, {"run_id": F.when(F.col("kind") == "started", 1).otherwise(0),
                              "line_no": F.lit(1)})


def write(lines: DataFrame, path: str, file: str, order: list[str]) -> None:
    """Write log lines (column ``value``) as text, one folder of ``path`` for each ``file``.

    Lines are dealt out by ranges of (file, order): a long log spans several part files, whose
    names keep its order."""
    columns = [file, *order]
    (lines.repartitionByRange(*columns).sortWithinPartitions(*columns).select(file, "value")
     .write.partitionBy(file).text(path))


def read_folders(spark: SparkSession, path: str, file: str = "file") -> DataFrame:
    """What :func:`write` wrote: every folder is one log."""
    lines = spark.read.text(path, recursiveFileLookup=False).select(
        file, F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    return with_run(classify(lines), file, ["path", "block", "line"])


def read(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return with_run(classify(read_lines(spark, paths)), "file", ["block", "line"])


def parse_snapshot(df: DataFrame, text: str = "value") -> DataFrame:
    """Buffer counters from ``key : value`` text, one snapshot per row."""
    counters = ("blocks_in_use", "bytes_written", "bytes_read", "bytes_available")
    found = {k: value_of(F.col(text), k, r"[ \t]*:[ \t]*") for k in ("header_state", *counters)}
    return df.select(
        *df.columns, found["header_state"].alias("header_state"),
        *[found[k].try_cast("bigint").alias(k) for k in counters])
