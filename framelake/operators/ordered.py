"""Order-dependent scans that stay distributed when one key holds most rows.

A window partitioned by stream puts a whole stream into one task. Here the rows
are range-partitioned on (keys, order) instead, so a large stream spans many
partitions, each numbered in place and frozen on shared storage. What a partition
needs to know about the ones before it (how many rows, what running total, which
last row) is one small record per partition and key.

``order`` must be a total order within a key, or tie only on rows that are
interchangeable and few: equal rows cannot be told apart and share one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.joins import attach_bounded
from framelake.session import durable, wide_enough

PART = "_part"
ROW = "_row"


def lay_out(df: DataFrame, keys: list[str], order: list[str], width: int | None = None) -> DataFrame:
    """Sort across the cluster and number the rows of each partition.

    Adds ``_part`` (partition in sort order) and ``_row`` (increasing over the
    whole table). The result is materialised: range boundaries come from a sample
    and would move if the plan ran again. The driver takes in some 300 sampled rows for
    each partition; ``width`` sets their number where rows are wide and their count is known.
    """
    columns = [*keys, *order]
    ranged = df.repartitionByRange(width, *columns) if width else df.repartitionByRange(*columns)
    numbered = ranged.sortWithinPartitions(*columns).withColumn(ROW, F.monotonically_increasing_id())
    with wide_enough(df):
        # monotonically_increasing_id keeps the partition number in its upper bits.
        return durable(numbered.withColumn(PART, F.shiftright(F.col(ROW), 33)))


def _before(keys: list[str]):
    return (Window.partitionBy(*keys).orderBy(PART)
            .rowsBetween(Window.unboundedPreceding, -1))


def positions(df: DataFrame, keys: list[str], order: list[str],
              name: str = "pos") -> DataFrame:
    """Dense 0-based position of every row within its key."""
    rows = lay_out(df, keys, order)
    spans = rows.groupBy(PART, *keys).agg(
        F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = spans.select(
        PART, *keys,
        (F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)) - F.col("_first")).alias("_shift"))
    # One record per (partition, key), so the shuffled form is balanced too.
    placed = attach_bounded(rows, starts, [PART, *keys])
    return placed.select(*df.columns, (F.col(ROW) + F.col("_shift")).alias(name))


def running_sums(df: DataFrame, keys: list[str], order: list[str],
                 sums: dict[str, Column]) -> DataFrame:
    """Running totals within a key, up to and including the row."""
    added = {f"_v{i}": (name, col) for i, (name, col) in enumerate(sums.items())}
    rows = lay_out(
        df.select("*", *[col.alias(v) for v, (_, col) in added.items()]), keys, order)
    inside = (Window.partitionBy(PART, *keys).orderBy(ROW)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.select(
        *df.columns, PART, *[F.sum(v).over(inside).alias(f"_l{v}") for v in added])
    totals = rows.groupBy(PART, *keys).agg(*[F.sum(v).alias(v) for v in added])
    carried = totals.select(
        PART, *keys, F.row_number().over(Window.partitionBy(*keys).orderBy(PART)).alias("_i"),
        *[F.sum(v).over(_before(keys)).alias(f"_c{v}") for v in added])
    # Only the first key of a partition can continue an earlier one, so this has
    # at most one row per partition.
    carried = carried.filter("_i > 1").drop("_i")
    joined = attach_bounded(local, carried, [PART, *keys])
    return joined.select(*df.columns, *[
        (F.col(f"_l{v}") + F.coalesce(F.col(f"_c{v}"), F.lit(0))).alias(name)
        for v, (name, _) in added.items()])


def previous(df: DataFrame, keys: list[str], order: list[str],
             values: dict[str, Column]) -> DataFrame:
    """Values of the preceding row within a key; null on the first row."""
    packed = F.struct(*[col.alias(name) for name, col in values.items()])
    rows = lay_out(df.withColumn("_v", packed), keys, order)
    inside = Window.partitionBy(PART, *keys).orderBy(ROW)
    local = rows.select(*df.columns, PART, F.lag("_v").over(inside).alias("_p"))
    lasts = rows.groupBy(PART, *keys).agg(F.max_by("_v", ROW).alias("_v"))
    carried = (lasts.select(
        PART, *keys, F.lag("_v").over(Window.partitionBy(*keys).orderBy(PART)).alias("_c"))
        .filter(F.col("_c").isNotNull()))
    joined = attach_bounded(local, carried, [PART, *keys])
    return joined.select(*df.columns, *[
        F.coalesce(F.col("_p"), F.col("_c")).getField(name).alias(name) for name in values])


def as_of(probes: DataFrame, events: DataFrame, keys: list[str], ts: str, values: list[str],
          order: list[str] | None = None) -> DataFrame:
    """Probes with the ``values`` of the last event of their key at or before their time, null
    where there is none.

    Both lie in one order, cut into ranges of (key, time): a key with almost all rows spans many
    tasks. A range looks back within itself and takes the last event before it from
    one small record for each range and key. Of events at one time the last by ``order``
    counts, and it counts for probes of that time. Keys match null-safely.
    """
    order = order or []
    packed = F.struct(*[F.col(v) for v in values])
    marked = events.select(*keys, ts, *order, packed.alias("_v"), F.lit(0).alias("_probe"),
                           F.lit(None).alias("_p"))
    kept = F.struct(*[F.col(c) for c in probes.columns])
    asked = probes.select(*keys, ts, *[F.lit(None).cast(events.schema[o].dataType).alias(o) for o in order],
                          F.lit(None).cast(events.select(packed.alias("v")).schema["v"].dataType).alias("_v"),
                          F.lit(1).alias("_probe"), kept.alias("_p"))
    both = marked.withColumn("_p", F.col("_p").cast(asked.schema["_p"].dataType)).unionByName(asked)
    rows = lay_out(both, keys, [ts, "_probe", *order])
    inside = (Window.partitionBy(PART, *keys).orderBy(ROW)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = rows.select("_p", PART, *keys, "_probe", F.last("_v", ignorenulls=True).over(inside).alias("_near")).filter(
        "_probe = 1")
    lasts = rows.filter("_probe = 0").groupBy(PART, *keys).agg(F.max_by("_v", ROW).alias("_v"))
    # A range without events of a key passes on what came before it.
    spans = rows.groupBy(PART, *keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    every = _joined_spans(spans, lasts, [PART, *keys])
    carried = every.select(
        PART, *keys, F.last("_v", ignorenulls=True).over(_before(keys)).alias("_far")).filter(F.col("_far").isNotNull())
    found = attach_bounded(local, carried, [PART, *keys])
    return found.select("_p.*", *[
        F.coalesce(F.col("_near"), F.col("_far")).getField(v).alias(v) for v in values])


def _joined_spans(spans: DataFrame, lasts: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by keys of which some may be null: both sides have a record per range and key."""
    both = spans.withColumn("_v", F.lit(None).cast(lasts.schema["_v"].dataType)).unionByName(lasts.select(*keys, "_v"))
    return both.groupBy(*keys).agg(F.first("_v", ignorenulls=True).alias("_v"))
