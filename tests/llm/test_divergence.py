import collections
import random
import re

import numpy as np
import pytest

from framelake import session
from framelake.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=10, top=10):
    docs = collections.defaultdict(list)
    for text, lang, source in rows:
        docs[lang or ""].append((source or "", TERM.findall(fold(text or ""))))
    out = []
    for lang, members in docs.items():
        df = collections.Counter(t for _, terms in members for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = collections.defaultdict(collections.Counter)
        for source, terms in members:
            counts[source].update(t for t in terms if df[t] >= least)
        whole = sum(counts.values(), collections.Counter())

        def shares(c):
            total = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for s in counts:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:limit])]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def sample(seed, sources=7, docs=160):
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "ñandú", "Straße", "日本"]
    rows = []
    for _ in range(docs):
        source = rng.choice([f"s{i}" for i in range(sources)] + ["s0"] * sources)
        weights = [1 / (1 + (i * (1 + hash_of(source)) % 13)) for i in range(len(vocabulary))]
        rows.append((" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 60))).title(),
                     rng.choice(["en", "fr", None]), source))
    return rows


def hash_of(text):
    return sum(map(ord, text)) % 7


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = sample(seed)
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_many_blocks_and_tiles(spark):
    rows = sample(9, sources=11, docs=260)
    found = divergence.audit(spark.createDataFrame(rows, SCHEMA), block_terms=8, tile=3)
    assert rows_of(found) == brute(rows)


def test_a_tile_pair_is_compared_once():
    import pyarrow as pa

    def column(idx, counts, total):
        rows = [(idx, -1, total, len(counts), None)]
        return rows + [(idx, i, c, None, None) for i, c in enumerate(counts) if c]

    rows = column(0, [3, 3, 0, 1], 20) + column(64, [0, 3, 3, 1], 30)
    names = ["idx", "pos", "n", "size", "term"]
    table = pa.table({
        "lang": ["x"] * len(rows), "ta": pa.array([0] * len(rows), pa.int32()), "tb": pa.array([1] * len(rows), pa.int32()),
        **{c: pa.array([r[i] for r in rows], pa.string() if c == "term" else pa.int64()) for i, c in enumerate(names)}})
    p = [1 + 10**9 * (c + 2) // 20 for c in (3, 3, 0, 1)]
    q = [1 + 10**9 * (c + 2) // 30 for c in (0, 3, 3, 1)]
    assert divergence._compare(table, 10).to_pylist() == [
        {"lang": "x", "a": 0, "b": 64, "term": None, "value": sum((x - y) ** 2 // (x + y) for x, y in zip(p, q))}]


def test_runs_hold_equal_neighbours():
    column = divergence.Column(np.array([1, 2, 5]), np.array([4, 4, 4]), 40, 7)
    assert column.start.tolist() == [0, 1, 3, 5, 6] and column.count.tolist() == [0, 4, 0, 4, 0]


def test_shares_are_exact_for_large_counts():
    n = 10**12
    assert divergence._share(np.array([n]), 3 * n).tolist() == [1 + 10**9 * (n + 2) // (3 * n)]


def test_nulls_empty_ties_repeats_and_other_columns(spark):
    rows = [(None, None, None), ("", "en", "a"), ("one", "en", "b")] + [("same same", "de", s) for s in "xyz" for _ in range(5)]
    rows += [("same same", "de", "x")]
    df = spark.createDataFrame([(*r, 1, {"k": "v"}) for r in rows], SCHEMA + ", idx int, block map<string,string>")
    assert rows_of(divergence.audit(df)) == brute(rows)


def test_empty_table(spark):
    found = divergence.audit(spark.createDataFrame([], SCHEMA))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"] and found.count() == 0


def test_a_long_text(spark):
    long = " ".join(f"word{chr(97 + i % 20)}" for i in range(400_000))
    rows = [(long, "en", "a")] + [("worda wordb", "en", "b")] * 9
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def joins_of(spark, run):
    """Joins in the plans of all jobs of a call, as they ran."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    jobs = store.executionsList()
    plans = [jobs.apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
    return re.findall(r"^\(\d+\) (\w+Join\w*).*\n(?:(?!\(\d+\)).*\n)*?Left keys \[\d+\]: \[(.*)\]", "\n".join(plans), re.M)


def test_the_vocabulary_does_not_pass_through_the_driver(spark):
    df = spark.createDataFrame(sample(4), SCHEMA)
    joins = joins_of(spark, lambda: divergence.audit(df).collect())
    assert len(joins) > 5
    assert {kind for kind, keys in joins if "term#" in keys} == {"SortMergeJoin"}


def test_the_vocabulary_is_sampled_by_its_size(spark, monkeypatch):
    parts = []

    def lay_out(*args):
        rows = laid(*args)
        parts.append(rows.rdd.getNumPartitions())
        return rows

    laid = divergence.ordered.lay_out
    monkeypatch.setattr(divergence.ordered, "lay_out", lay_out)
    rows = sample(5)
    with session.settings(spark, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        found = rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA), block_terms=16))
    assert found == brute(rows) and parts[0] <= 3
