"""Flow rules with masks, as a table: tuple-space search.

Rules with the same set of masks form one tuple. Under the masks of a tuple a packet has one key,
so a tuple is one hash lookup however many rules it holds, and a table of rules costs as many
lookups as it has distinct sets of masks. Nothing compares packets with rules one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions.address import hex_key, ip_to_be
from framelake.functions.frames import ETH_IPV4
from framelake.operators.flows import FLOW
from framelake.operators.joins import attach, fits_broadcast
from framelake.session import durable

# All ones for each field.
FULL = {"src_mac": (1 << 48) - 1, "dst_mac": (1 << 48) - 1, "src_ip": (1 << 32) - 1, "dst_ip": (1 << 32) - 1,
        "src_port": 0xFFFF, "dst_port": 0xFFFF}
# Up to so many tuples are looked up in turn by each packet where it is; with more, each
# distinct flow is looked up once and the packets take over its rule.
MOST_CHAINED = 32
# Sets of masks handled in one pass over the flows.
SLICE = 2000


def prefix_mask(length: int, bits: int = 32) -> int:
    """Mask of the leading ``length`` of ``bits`` bits."""
    return (1 << bits) - (1 << (bits - length))


def number(field: str, value: Column) -> Column:
    """A flow field as a number: addresses in network order."""
    if field.endswith("_mac"):
        return hex_key(F.replace(value, F.lit(":"), F.lit("")))
    return ip_to_be(value) if field.endswith("_ip") else value.cast("bigint")


def normalised(rules: DataFrame) -> DataFrame:
    """Rules as numbers: ``rule_id``, ``priority``, and for each flow field its value under the mask
    and the mask ``<field>_mask``.

    A field without a value is not compared. A mask column may be missing, or null: then all
    bits of the field count. Masks are numbers.
    """
    masks, values = [], []
    for f in FLOW:
        given = F.col(f"{f}_mask").cast("bigint") if f"{f}_mask" in rules.columns else F.lit(None).cast("bigint")
        mask = F.when(F.col(f).isNull(), 0).otherwise(F.coalesce(given, F.lit(FULL[f]))).cast("bigint")
        masks.append(mask.alias(f"{f}_mask"))
        values.append(F.coalesce(number(f, F.col(f)).bitwiseAND(mask), F.lit(0).cast("bigint")).alias(f))
    readable = [F.col(f).isNull() | number(f, F.col(f)).isNotNull() for f in FLOW]
    # A rule whose value cannot be read matches nothing, rather than everything.
    return rules.filter(reduce(lambda a, b: a & b, readable)).select("rule_id", "priority", *values, *masks)


def _rank() -> Column:
    """Rules in order of precedence: the highest priority, of equal ones the smallest id."""
    return F.struct(F.col("priority").cast("bigint").alias("p"), (-F.col("rule_id").cast("bigint")).alias("r"))


def _masked(f: str, mask) -> Column:
    """A numbered field under a mask; without a mask bit an unreadable field counts as well."""
    mask = mask if isinstance(mask, Column) else F.lit(mask).cast("bigint")
    return F.when(mask == 0, F.lit(0).cast("bigint")).otherwise(F.col(f"_{f}").bitwiseAND(mask))


def best_rule(packets: DataFrame, rules: DataFrame, spread_by: list[str] | None = None,
              chained: int = MOST_CHAINED) -> DataFrame:
    """Packets with ``rule_id`` and ``priority`` of the rule of highest precedence among those they
    satisfy, null where they satisfy none.

    ``rules``: rule_id, priority and the columns that ``normalised`` takes. Only IPv4 packets
    match. A packet field that is null or unreadable satisfies a rule that does not
    compare it. ``spread_by`` names packet columns that vary within a flow.
    """
    table = durable(_deduplicated(normalised(rules)))
    masks = [f"{f}_mask" for f in FLOW]
    sets = [tuple(r) for r in table.select(*masks).distinct().limit(chained + 1).collect()]
    numbered = packets.withColumns({f"_{f}": number(f, F.col(f)) for f in FLOW})
    if len(sets) <= chained and fits_broadcast(table):
        found = _chained(numbered, table, sorted(sets))
    else:
        found = _by_flow(numbered, table, spread_by)
    return found.drop(*[f"_{f}" for f in FLOW])


def _deduplicated(table: DataFrame) -> DataFrame:
    """Of rules with equal masks and values the one that takes precedence."""
    keys = [*FLOW, *[f"{f}_mask" for f in FLOW]]
    return table.groupBy(*keys).agg(F.max(_rank()).alias("_best"))


def _answer(df: DataFrame, best: str) -> DataFrame:
    return df.withColumns({"rule_id": (-F.col(f"{best}.r")), "priority": F.col(f"{best}.p")}).drop(best)


def _chained(packets: DataFrame, table: DataFrame, sets: list[tuple]) -> DataFrame:
    """One broadcast lookup for each tuple, in the stage that reads the packets."""
    out, names = packets, []
    for i, masks in enumerate(sets):
        compared = [(f, m) for f, m in zip(FLOW, masks) if m]
        here = reduce(lambda a, b: a & b, [F.col(f"{f}_mask") == m for f, m in zip(FLOW, masks)])
        side = table.filter(here).select(*[F.col(f).alias(f"_r{i}_{f}") for f, _ in compared],
                                         F.lit(ETH_IPV4).alias(f"_r{i}"), F.col("_best").alias(f"_b{i}"))
        tests = [F.col("eth_type") == F.col(f"_r{i}")] + [
            _masked(f, m) == F.col(f"_r{i}_{f}") for f, m in compared]
        out = out.join(F.broadcast(side), reduce(lambda a, b: a & b, tests), "left").drop(
            f"_r{i}", *[f"_r{i}_{f}" for f, _ in compared])
        names.append(f"_b{i}")
    none = F.lit(None).cast("struct<p:bigint,r:bigint>")
    best = F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0]) if names else none
    return _answer(out.withColumn("_best", best).drop(*names), "_best")


def _by_flow(packets: DataFrame, table: DataFrame, spread_by: list[str] | None) -> DataFrame:
    """Each distinct flow meets every tuple once; its best rule is found map-side."""
    keys = [f"_{f}" for f in FLOW]
    flows = durable(packets.filter(F.col("eth_type") == ETH_IPV4).select(*keys).distinct())
    names = [f"{f}_mask" for f in FLOW]
    sets = table.select(*names).distinct()
    slices = max(1, -(-sets.count() // SLICE))
    found = None
    for s in range(slices):
        # At most SLICE sets or so are in the plan at once, as one array.
        part = [r.asDict() for r in sets.filter(F.pmod(F.xxhash64(*names), F.lit(slices)) == s).collect()]
        if not part:
            continue
        listed = F.array(*[F.struct(*[F.lit(r[n]).cast("bigint").alias(n) for n in names]) for r in part])
        asked = flows.withColumn("_set", F.explode(listed)).select(
            *keys, *[F.col(f"_set.{n}").alias(n) for n in names],
            *[_masked(f, F.col(f"_set.{f}_mask")).alias(f) for f in FLOW])
        hit = attach(asked, table, [*FLOW, *names], "inner", spread_by=keys).groupBy(*keys).agg(
            F.max("_best").alias("_best"))
        found = hit if found is None else found.unionByName(hit)
    if found is None:
        return _answer(packets.withColumn("_best", F.lit(None).cast("struct<p:bigint,r:bigint>")), "_best")
    if slices > 1:
        found = found.groupBy(*keys).agg(F.max("_best").alias("_best"))
    found = durable(found).withColumn("eth_type", F.lit(ETH_IPV4))
    return _answer(attach(packets, found, [*keys, "eth_type"], "left", spread_by=spread_by, null_safe=True), "_best")
