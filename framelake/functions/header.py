"""Recording headers: ``KEY value #comment`` text to typed columns and back.

Each header is one row of at most a few KiB, so all of this works inside the row
and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.timestamps import mjd_text

HEADER_BYTES = 4096
# Keys every header must carry, with the type each is read as.
REQUIRED = {
    "NANT": "int",
    "PKT_HEADER": "int",
    "PKT_DATA": "int",
    "PKT_NSAMP": "int",
    "PKT_TSAMP": "double",
    "PKT_NPOL": "int",
    "PKT_NBIT": "int",
    "BYTES_PER_SECOND": "bigint",
}
# Keys found in templates or added when a recording starts.
OPTIONAL = {
    "HDR_VERSION": "string",
    "HDR_SIZE": "int",
    "OBS_OFFSET": "bigint",
    "OBS_ID": "string",
    "RESOLUTION": "bigint",
    "FILE_SIZE": "bigint",
    "MJD_START": "double",
    "UTC_START": "string",
}
KEY_WIDTH = 20


# What a header line looks like. A comment needs no blank before it.
LINE = r"(?m)^[ \t]*([^\s#\x00]+)[ \t]+([^\s#\x00]+)"


def _first(text: Column, key: str, separator: str) -> Column:
    return F.regexp_extract(text, rf"(?m)^[ \t]*{key}{separator}([^\s#\x00]+)", 1)


def value_of(text: Column, key: str, separator: str = r"[ \t]+") -> Column:
    """First value of a key, null when absent. Where a key repeats the first counts."""
    return F.nullif(_first(text, key, separator), F.lit(""))


def typed(text: Column, key: str, kind: str) -> Column:
    if kind == "string":
        return value_of(text, key)
    # An absent key extracts as empty text, which casts to null as well.
    return _first(text, key, r"[ \t]+").try_cast(kind)


def keys_of(text: Column) -> Column:
    """Keys in text order, repetitions included."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(1))


def repeated_keys(keys: Column) -> Column:
    """Keys that occur more than once: equal neighbours after sorting."""
    ordered = F.array_sort(keys)
    n = F.size(keys)
    pairs = F.arrays_zip(
        F.slice(ordered, F.lit(1), F.greatest(n - 1, F.lit(0))).alias("a"),
        F.slice(ordered, F.lit(2), F.greatest(n - 1, F.lit(0))).alias("b"))
    return F.array_distinct(F.transform(
        F.filter(pairs, lambda p: p["a"] == p["b"]), lambda p: p["a"]))


def parse(df: DataFrame, text: str = "header_text") -> DataFrame:
    """Typed columns, named as the keys in lower case."""
    known = {**REQUIRED, **OPTIONAL}
    return df.select(
        *df.columns, *[typed(F.col(text), k, kind).alias(k.lower()) for k, kind in known.items()])


def extra(df: DataFrame, text: str = "header_text") -> DataFrame:
    """Add ``extra``: a map of the keys that have no typed column."""
    known = [*REQUIRED, *OPTIONAL]
    staged = df.withColumn("_keys", keys_of(F.col(text))).withColumn(
        "_values", F.regexp_extract_all(F.col(text), F.lit(LINE), F.lit(2)))
    entries = F.arrays_zip(F.col("_keys").alias("key"), F.col("_values").alias("value"))
    first = F.filter(entries, lambda e, i: ~e["key"].isin(known)
                     & (F.array_position("_keys", e["key"]) == i + 1))
    return staged.select(*df.columns, F.map_from_entries(first).alias("extra"))


def validate(df: DataFrame, text: str = "header_text") -> DataFrame:
    """Which required keys are missing or unreadable, and which keys repeat.

    Rows are reported, not dropped: split on ``ok`` to route rejects.
    """
    missing = F.array_remove(F.array(*[
        F.when(typed(F.col(text), k, kind).isNull(), F.lit(k)).otherwise("")
        for k, kind in REQUIRED.items()]), "")
    staged = df.withColumn("_missing", missing).withColumn("_keys", keys_of(F.col(text)))
    return staged.select(
        *df.columns, F.col("_missing").alias("missing_keys"),
        repeated_keys(F.col("_keys")).alias("duplicate_keys"),
        (F.size("_missing") == 0).alias("ok"))


def consistency(parsed: DataFrame, pkts_per_block: int) -> DataFrame:
    """Cross-checks between header fields. Mismatches are reported, not rejected.

    ``implied_us`` is the packet spacing from samples times sampling interval,
    ``declared_us`` the spacing from the declared byte rate.
    """
    c = F.col
    pkt = c("pkt_header").cast("bigint") + c("pkt_data")
    payload = c("nant").cast("bigint") * c("pkt_nsamp") * c("pkt_npol") * c("pkt_nbit")
    rate = F.try_divide(c("bytes_per_second").cast("double"), pkt)
    implied = c("pkt_nsamp") * c("pkt_tsamp")
    declared = F.try_divide(F.lit(1e6), rate)
    return parsed.select(
        "*",
        (c("pkt_data") == payload).alias("data_ok"),
        (F.try_mod(pkt * F.lit(pkts_per_block), c("resolution")) == 0).alias("resolution_ok"),
        rate.alias("pkt_per_s"), implied.alias("implied_us"), declared.alias("declared_us"),
        (F.abs(implied - declared) <= F.lit(1e-6) * declared).alias("rate_ok"))


def _line(key: str, value: Column) -> Column:
    return F.concat(F.rpad(F.lit(key), KEY_WIDTH, " "), value)


def _rendered(key: str) -> Column:
    value = F.col(key.lower())
    if key == "PKT_TSAMP":
        return F.format_string("%.6f", value)
    if key == "MJD_START":
        return mjd_text(value)
    return value.cast("string")


# Order of the keys in a written header.
WRITTEN = [*REQUIRED, "FILE_SIZE", "MJD_START", "UTC_START"]


def render(with_version: bool = False) -> Column:
    """Header text from the typed columns; null when one of them is null."""
    lines = [_line(k, _rendered(k)) for k in WRITTEN]
    if with_version:
        lines = [_line("HDR_VERSION", F.lit("1.0")),
                 _line("HDR_SIZE", F.lit(str(HEADER_BYTES)))] + lines
    return F.concat(*[F.concat(line, F.lit("\n")) for line in lines])


def pad(text: Column) -> Column:
    """Header text filled with zero bytes to the fixed header size.

    Longer text is an error rather than cut: the reader would lose keys.
    """
    padded = F.rpad(text.cast("binary"), F.lit(HEADER_BYTES), F.lit(b"\x00"))
    return F.when(F.octet_length(text) <= HEADER_BYTES, padded).otherwise(
        F.raise_error(F.lit(f"header exceeds {HEADER_BYTES} bytes")))
