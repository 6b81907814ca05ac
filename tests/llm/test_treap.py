import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from framelake.llm import treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sample(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(200)] + ["Ärger", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(k):
        return " ".join(rng.choices(vocabulary, weights, k=k)).upper()

    return [(i, text(rng.randint(0, 80))) for i in range(n)], [(i, text(rng.randint(1, 30))) for i in range(12)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_over_several_shards(spark, seed):
    docs, items = sample(seed)
    found = treap.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS),
                         shard_docs=40, shard_bytes=4000)
    assert rows_of(found) == brute(docs, items)


def test_items_in_blocks(spark):
    docs, items = sample(5, 60)
    found = treap.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block=20)
    assert rows_of(found) == brute(docs, items)


def test_ties_go_to_the_smaller_id_and_a_null_id_comes_last(spark):
    docs = [(i, "alpha beta") for i in (9, 3, 7)] + [(None, "alpha beta"), (1, "gamma " * 5), (2, None), (4, "...")]
    items = [(1, "ALPHA alpha"), (2, "nothing"), (3, None), (1, "ALPHA alpha"), (None, "beta")]
    found = treap.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert rows_of(found) == brute(docs, items)
    assert [r.doc_id for r in found.filter("item_id IS NULL").orderBy("rank").collect()] == [3, 7, 9, None]


def test_only_twenty_of_many_copies(spark):
    docs = [(i, "copy of one text") for i in range(500)] + [(1000, "another text")]
    items = [(1, "copy text")]
    found = treap.search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))
    assert rows_of(found) == brute(docs, items)


def test_empty_tables_and_other_columns(spark):
    docs, items = sample(1, 20)
    some = spark.createDataFrame([(*d, {"k": 1}, 5) for d in docs], DOCS + ", terms map<string,int>, score int")
    asked = spark.createDataFrame([(*i, "k") for i in items], ITEMS + ", key string")
    assert rows_of(treap.search(some, asked)) == brute(docs, items)
    none = treap.search(spark.createDataFrame([], DOCS), asked)
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0
    assert treap.search(some, spark.createDataFrame([], ITEMS)).count() == 0


def test_a_long_text_and_an_item_of_many_terms(spark):
    words = [f"u{i}" for i in range(3000)]
    docs = [(1, " ".join(words * 200)), (2, "u5 u6"), (3, "u7 " * 4)]
    items = [(1, " ".join(words)), (2, "u7")]
    found = treap.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert rows_of(found) == brute(docs, items)


def shard_of(docs):
    ids, texts = pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.large_string())
    sizes = [len(terms(d[1])) for d in docs]
    made = treap._shard(ids, texts, sum(s > 0 for s in sizes), sum(sizes)).to_pylist()[0]
    return made, treap.Shard(made["masks"], made["drops"], made["height"], made["doc_ids"])


def test_every_quarter_holds_the_greatest_impact_below_it():
    made, shard = shard_of(sample(2, 50)[0])
    level = [0]
    for _ in range(shard.height):
        below = []
        for node in level:
            children = [int(shard.down(np.array([node]), np.array([r]), c)[0]) for r in (0, 1) for c in (0, 1)]
            children = [c for c in children if c != shard.none]
            assert shard.most[node] == max(shard.most[c] for c in children)
            below += children
        assert sorted(set(below)) == sorted(below)
        level = below
    assert len(level) == sum(len(set(terms(t))) for _, t in sample(2, 50)[0])


def test_narrow_ranges_give_the_same(monkeypatch):
    docs, items = sample(4, 120)
    made, shard = shard_of(docs)
    names = treap._names(made["terms"]).to_pylist()
    rows = np.arange(len(names))
    weights = np.random.default_rng(1).integers(0, 50, len(names))
    results = []
    for paths in (4_000_000, 50, 1):
        monkeypatch.setattr(treap, "PATHS", paths)
        best = treap.Best(20)
        treap._descend(shard, rows, weights, best)
        results.append(best.found)
    assert results[0] == results[1] == results[2] and len(results[0]) == 20


def test_a_search_visits_few_ranges(monkeypatch):
    docs = [(i, f"common word x{i}") for i in range(1000)]
    made, shard = shard_of(docs)
    names = treap._names(made["terms"]).to_pylist()
    rows = np.array([names.index(b"x700"), names.index(b"common")])
    taken = []
    down = shard.down
    monkeypatch.setattr(shard, "down", lambda at, *rest: (taken.append(len(at)), down(at, *rest))[1])
    best = treap.Best(1)
    treap._descend(shard, rows, np.array([7000, 1]), best)
    # All ranges of documents together are twice as many as documents, for each bit.
    assert best.found[0][2] == 700 and sum(taken) < 1000
