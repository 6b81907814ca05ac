"""Joins whose small side is broadcast only after its size has been measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.session import durable


BROADCAST_BYTES = 64 << 20
# Fewest buckets a hot key is spread over; a session with wider shuffles gets more.
SALT_BUCKETS = 16
# Most records of a per-partition summary that may pass through the driver.
LOCAL_ROWS = 50_000


def _width(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0)).cast("bigint") + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(col))), F.lit(0)).cast("bigint")
    return F.lit(8).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Size of a table in bytes, by one aggregate over all its rows."""
    per_row = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("b")).first()["b"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def attach(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
           spread_by: list[str] | None = None, limit: int = BROADCAST_BYTES,
           null_safe: bool = False) -> DataFrame:
    """Join ``dim`` onto ``fact`` by equal columns.

    A dimension measured below ``limit`` is broadcast and the fact side does not
    move. Above it both sides shuffle; ``spread_by`` names fact columns that vary
    inside one key, and spreads a hot key over ``SALT_BUCKETS`` tasks or more with the
    matching dimension rows repeated per bucket.
    """
    if how not in ("left", "inner", "leftsemi", "left_semi", "leftanti", "left_anti"):
        raise ValueError(f"{how} join: the dimension may be repeated, so none of its rows can be kept alone")
    keys = list(on)
    if fits_broadcast(dim, limit):
        dim = F.broadcast(dim)
    else:
        if spread_by:
            ways = max(SALT_BUCKETS, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
            fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(ways)).cast("int"))
            dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
            keys = keys + ["_salt"]
        # Spark's own estimate takes a stored table for its compressed bytes and leaves out the rows that the
        # salt repeats, so without a hint it may broadcast what was found too large.
        dim = dim.hint("merge")
    if null_safe:
        return _null_safe(fact, dim, keys, how).drop("_salt")
    return fact.join(dim, keys, how).drop("_salt")


def attach_bounded(fact: DataFrame, side: DataFrame, on: list[str],
                   max_rows: int = LOCAL_ROWS) -> DataFrame:
    """Left join, null-safe, of a side expected to hold a record per partition or so.

    Up to ``max_rows`` records pass through the driver and are broadcast; with more,
    the side is stored and both sides shuffle.
    """
    found = side.limit(max_rows + 1).toArrow()
    if found.num_rows <= max_rows and found.nbytes <= BROADCAST_BYTES:
        local = side.sparkSession.createDataFrame(found, side.schema)
        return _null_safe(fact, F.broadcast(local), on, "left")
    return _null_safe(fact, durable(side), on, "left")


def _null_safe(fact: DataFrame, dim: DataFrame, keys: list[str], how: str) -> DataFrame:
    renamed = dim.select(*[
        F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in dim.columns])
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return fact.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def lookup_with_fallback(fact: DataFrame, dim: DataFrame, key: str, index: str,
                         dim_key: str, dim_index: str, value: str,
                         spread_by: list[str] | None = None) -> DataFrame:
    """Value of the dimension row with equal key, else of the row at the given
    position, else null. ``how`` says which rule answered.

    Where several dimension rows share a key the one at the lowest position wins.
    """
    by_key = dim.groupBy(F.col(dim_key).alias(key)).agg(
        F.min_by(value, dim_index).alias("_by_key"), F.lit(True).alias("_key_hit"))
    by_index = dim.select(F.col(dim_index).alias(index), F.col(value).alias("_by_index"),
                          F.lit(True).alias("_index_hit"))
    out = attach(fact, by_key, [key], "left", spread_by)
    out = attach(out, by_index, [index], "left", spread_by)
    return out.select(
        *fact.columns,
        F.when(F.col("_key_hit"), F.col("_by_key")).otherwise(F.col("_by_index")).alias(value),
        F.when(F.col("_key_hit"), "key").when(F.col("_index_hit"), "index")
        .otherwise("none").alias("how"))
