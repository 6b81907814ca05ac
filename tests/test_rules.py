"""Masked flow rules as a table."""

import random

import pytest
from pyspark.sql import functions as F

from framelake.operators import rules
from framelake.operators.flows import FLOW
from framelake.operators.rules import prefix_mask

PACKET = "seq int, eth_type int, src_mac string, dst_mac string, src_ip string, dst_ip string, src_port int, dst_port int"
RULE = ("rule_id int, priority int, src_mac string, src_mac_mask bigint, dst_mac string, src_ip string, src_ip_mask bigint, "
        "dst_ip string, dst_ip_mask bigint, src_port int, src_port_mask bigint, dst_port int, dst_port_mask bigint")
MACS = ["02:a2:02:00:02:fa", "02:a2:02:00:02:fb", "10:70:fd:11:e2:e3"]


def number(field, value):
    if value is None:
        return None
    if field.endswith("_mac"):
        return int(value.replace(":", ""), 16)
    if field.endswith("_ip"):
        total = 0
        for octet in value.split("."):
            if not octet.isdigit():
                return None
            total = total * 256 + int(octet)
        return total
    return value


def satisfied(packet, rule):
    if packet["eth_type"] != 0x0800:
        return False
    for f in FLOW:
        if rule.get(f) is None:
            continue
        if number(f, rule[f]) is None:
            return False
        mask = rule.get(f"{f}_mask")
        mask = rules.FULL[f] if mask is None else mask
        value = number(f, packet[f])
        if mask and (value is None or value & mask != number(f, rule[f]) & mask):
            return False
    return True


def brute(packets, table):
    out = {}
    for p in packets:
        found = [(-r["priority"], r["rule_id"]) for r in table if satisfied(p, r)]
        out[p["seq"]] = (min(found)[1], -min(found)[0]) if found else (None, None)
    return out


def sample(seed, n_packets=300, n_rules=120):
    rng = random.Random(seed)

    def ip():
        return f"10.{rng.choice([17, 18])}.{rng.randint(0, 3)}.{rng.randint(0, 7)}"

    def maybe(value, p=0.3):
        return None if rng.random() < p else value

    packets = [dict(seq=i, eth_type=rng.choice([2048, 2048, 2054, None]), src_mac=rng.choice([*MACS, None]),
                    dst_mac=rng.choice(MACS), src_ip=rng.choice([ip(), ip(), "10.17.1", None]), dst_ip=ip(),
                    src_port=rng.randint(60000, 60003), dst_port=rng.choice([17201, 17202])) for i in range(n_packets)]
    table = [dict(rule_id=i, priority=rng.randint(0, 5), src_mac=maybe(rng.choice(MACS)),
                  src_mac_mask=maybe(0xFFFFFFFFFF00), dst_mac=maybe(rng.choice(MACS)), src_ip=maybe(ip()),
                  src_ip_mask=maybe(prefix_mask(rng.choice([0, 8, 16, 24, 30]))), dst_ip=maybe(ip()),
                  dst_ip_mask=maybe(prefix_mask(rng.choice([16, 24]))), src_port=maybe(rng.randint(60000, 60003)),
                  src_port_mask=maybe(0xFFFE), dst_port=maybe(17202), dst_port_mask=maybe(0xFFFF)) for i in range(n_rules)]
    return packets, table


def frames_of(spark, packets, table):
    names = [c.split()[0] for c in PACKET.split(", ")]
    rule_names = [c.split()[0] for c in RULE.split(", ")]
    return (spark.createDataFrame([tuple(p[n] for n in names) for p in packets], PACKET),
            spark.createDataFrame([tuple(r[n] for n in rule_names) for r in table], RULE))


def found(df):
    return {r.seq: (r.rule_id, r.priority) for r in df.collect()}


@pytest.mark.parametrize("seed, chained", [(0, 32), (1, 400), (2, 0), (3, 400)])
def test_equals_brute_force(spark, seed, chained):
    packets, table = sample(seed, n_rules=12 if chained == 400 else 120)
    a, b = frames_of(spark, packets, table)
    assert found(rules.best_rule(a, b, spread_by=["seq"], chained=chained)) == brute(packets, table)


def test_slices_of_mask_sets(spark, monkeypatch):
    monkeypatch.setattr(rules, "SLICE", 10)
    packets, table = sample(7)
    a, b = frames_of(spark, packets, table)
    assert found(rules.best_rule(a, b)) == brute(packets, table)


def test_no_rules_no_packets_and_rules_without_masks(spark):
    packets, table = sample(5, 40, 30)
    a, b = frames_of(spark, packets, table)
    for chained in (0, 32):
        assert set(found(rules.best_rule(a, b.limit(0), chained=chained)).values()) == {(None, None)}
        assert found(rules.best_rule(a.limit(0), b, chained=chained)) == {}
    plain = b.select("rule_id", "priority", *FLOW)
    exact = [{k: v for k, v in r.items() if not k.endswith("_mask")} for r in table]
    assert found(rules.best_rule(a, plain)) == brute(packets, exact)


def test_an_unreadable_rule_matches_nothing(spark):
    packets, _ = sample(6, 20)
    a, _ = frames_of(spark, packets, [])
    bad = spark.createDataFrame([(1, 1, None, None, "10.17", None, None, None)], "rule_id int, priority int, " + ", ".join(
        f"{f} {'int' if 'port' in f else 'string'}" for f in FLOW))
    assert set(found(rules.best_rule(a, bad)).values()) == {(None, None)}


def test_packets_stay_where_they_are(spark):
    packets, table = sample(8, 50, 6)
    a, b = frames_of(spark, packets, table)
    plan = rules.best_rule(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Exchange hashpartitioning" not in plan.split(
        "BroadcastExchange")[0]


def test_a_hundred_thousand_rules(spark):
    key = F.col("id")
    address = F.concat(F.lit("10."), F.pmod(F.shiftright(key, 16), F.lit(256)).cast("string"), F.lit("."),
                       F.pmod(F.shiftright(key, 8), F.lit(256)).cast("string"), F.lit("."), F.pmod(key, F.lit(256)).cast("string"))
    blank = {f: F.lit(None).cast("int" if "port" in f else "string") for f in FLOW if f != "src_ip"}
    table = spark.range(100_000).select(
        key.alias("rule_id"), F.pmod(key, F.lit(3)).alias("priority"), address.alias("src_ip"),
        F.when(key % 2 == 0, prefix_mask(31)).alias("src_ip_mask"), *[v.alias(f) for f, v in blank.items()])
    packets = spark.range(50_000).select(key.alias("seq"), F.lit(2048).alias("eth_type"), address.alias("src_ip"),
                                         *[v.alias(f) for f, v in blank.items()])
    got = rules.best_rule(packets, table).collect()
    assert len(got) == 50_000

    def want(i):
        # Even rules cover two addresses, odd ones one.
        options = [(i - i % 2, (i - i % 2) % 3)] + ([(i, i % 3)] if i % 2 else [])
        return max(options, key=lambda o: (o[1], -o[0]))

    assert all((r.rule_id, r.priority) == want(r.seq) for r in got)
