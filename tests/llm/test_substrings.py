import collections
import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from framelake.llm import substrings as sub


def brute(rows, length=200):
    count = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        count.update(b[s:s + length] for s in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcde é\n", k=n))
    shared, edge = text(600), text(200 - 30)
    rows = [None, "", "a" * 199, "a" * 200, "b" * 201, "xy" * 700, "short"]
    rows += [text(rng.randrange(50, 1500)) for _ in range(25)]
    rows += [text(rng.randrange(300)) + shared + text(rng.randrange(300)) for _ in range(12)]
    rows += [text(150) + shared[rng.randrange(300):] for _ in range(8)]
    rows += [text(20) + edge for _ in range(4)] + [rows[10], rows[10], "abc" + rows[11][:-2]]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"spread": 2, "shard_bytes": 4000}])
def test_against_brute_force(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, k long")
    found = sub.remove_repeated(docs, **options)
    assert found.columns == ["doc_id", "text", "k", "repeats"]
    got = sorted((r.doc_id, r.repeats.n_bytes, r.repeats.n_removed, r.repeats.n_spans, r.repeats.kept_sha256)
                 for r in found.collect())
    assert got == brute(rows)


def test_merge_ranges_follow_windows(spark, monkeypatch):
    ranges, sizes = [], spark.sparkContext.accumulator(0)
    search, merge = sub._search_shard, sub._merge_range
    monkeypatch.setattr(sub, "_search_shard", lambda length, n: ranges.append(n) or search(length, n))

    def counted(length):
        inner = merge(length)

        def run(key, table):
            if sum(len(b) for b in table["keys"].to_pylist()) > 8 * 200:
                sizes.add(1)
            return inner(key, table)

        return run

    monkeypatch.setattr(sub, "_merge_range", counted)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for keys in (1 << 20, 100):
        found = sub.remove_repeated(docs, spread=2, shard_bytes=4000, range_keys=keys).collect()
        got.append(sorted((r.doc_id, *r.repeats[:3], r.repeats.kept_sha256) for r in found))
    assert got[0] == got[1] == brute(rows)
    # 100 keys expected in a range of the second run, and never twice as many; one range holds all in the first.
    assert ranges[0] == 1 and ranges[1] > 16 and sizes.value == 1


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "q" * 50 + "".join(map(str, range(90)))), (1, None),
                                  (None, "q" * 50 + "".join(map(str, range(90))))], "doc_id long, text string")
    got = [r.repeats.n_removed for r in sub.remove_repeated(docs).collect()]
    assert sorted(got) == [0, 220, 220]
    assert sub.remove_repeated(docs.limit(0)).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n, k in ((1, 1), (300, 2), (500, 4), (64, 1)):
        symbols = rng.integers(1, k + 1, n).astype(np.uint16)
        order = sub.suffix_array(symbols)
        plain = sorted(range(n), key=lambda i: symbols[i:].tolist())
        assert order.tolist() == plain
        shared = sub.common_prefixes(symbols, order)
        for i in range(1, n):
            a, b = symbols[order[i - 1]:].tolist(), symbols[order[i]:].tolist()
            same = 0
            while same < min(len(a), len(b)) and a[same] == b[same]:
                same += 1
            assert shared[i] == same


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(sub, "BLOCK_BYTES", 1000)
    texts = pa.array(["".join(random.Random(2).choices("abc", k=5500)), "x"])
    windows = []
    for _, data, bounds, at in sub._blocks(texts, 200):
        _, first, last, _, _ = sub.contexts(data, bounds)
        windows += [w + at for a, b in zip(first, last) for w in range(a, b + 1)]
    assert sorted(windows) == list(range(5500 - 199))


def test_shard_of_very_many_contexts():
    rng = random.Random(6)
    bodies = list({bytes(rng.choices(range(256), k=6)) for _ in range(66_000)})
    bodies[-1] = bodies[0][:5] + bytes([bodies[0][5] ^ 1])
    n = len(bodies)
    table = pa.table({"k": pa.array(range(n), pa.int64()), "lo": pa.array([0] * n, pa.int64()),
                      "spread": [False] * n, "once": [True] * n, "body": pa.array(bodies, pa.binary())})
    found = sub._search_shard(5, 1)(table).to_pylist()
    count = collections.Counter(b[s:s + 5] for b in bodies for s in (0, 1))
    assert {r["k"] for r in found} == {i for i, b in enumerate(bodies) if count[b[:5]] > 1 or count[b[1:]] > 1}
    assert {0, n - 1} <= {r["k"] for r in found}


def test_parts_end_windows():
    parts = [np.frombuffer(b, np.uint8) for b in (b"abcabc", b"abcab", b"cab", b"ab", b"", b"\0\0\0\0", b"abcabcx")]
    count = collections.Counter(p.tobytes()[s:s + 3] for p in parts for s in range(len(p) - 2))
    for p, (many, _) in zip(parts, sub.repeated_windows(parts, 3)):
        assert many.tolist() == [count[p.tobytes()[s:s + 3]] > 1 for s in range(len(p) - 2)]


def test_memory_of_a_block_and_of_a_shard():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 1 << 20).astype(np.uint8)
    bounds = np.arange(0, len(data) + 1, 1 << 12)
    parts = [p for at in range(0, len(data) // 2, 256) for p in (data[at:at + 256], data[at:at + 250])]

    def peak(fn, *args):
        tracemalloc.start()
        fn(*args)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    # In multiples of the bytes; both were above 70 with arrays of 64 bits throughout.
    assert peak(sub.contexts, data, bounds) < 56 * len(data)
    assert peak(sub.repeated_windows, parts) < 64 * len(data)
