import random
import re

import numpy as np

from framelake.llm import minhash
from framelake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=5):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 7)))
    rows = [None, "", " \t\n", "one two", "ONE  two", "one two three", "x" * 5000, "x" * 5000]
    # Copies that differ by a few words: many of them do not link with each other, or with any.
    for size, copies in ((40, 60), (300, 40)):
        base = [word() for _ in range(size)]
        for c in range(copies):
            text = list(base)
            for _ in range(c * size // 700):
                text[rng.randrange(size)] = word()
            rows.append(" ".join(text))
    rows += [" ".join(word() for _ in range(rng.randrange(5, 80))) for _ in range(60)]
    rows += rows[8:12]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(docs).collect())
    assert got == brute(rows)


def test_groups_in_blocks_equal_one_block(spark):
    rows = [(i, t) for i, t in corpus() if t and len(t.split()) > 4][:80]
    sets = [np.sort(s) for s in np.split(*_split(rows))]
    want = {tuple(sorted(p)) for p in _closure(minhash.link_blocks(
        [i for i, _ in rows], [i for i, _ in rows], sets, [0] * len(rows), (75, 100)))}
    half = len(rows) // 2
    links = []
    for a, b in ((range(half), range(half)), (range(half, len(rows)), range(half, len(rows))),
                 (range(half), range(half, len(rows)))):
        pick = list(a) if a == b else [*a, *b]
        side = [0] * len(pick) if a == b else [0] * len(a) + [1] * len(b)
        links += minhash.link_blocks([rows[k][0] for k in pick], [rows[k][0] for k in pick],
                                     [sets[k] for k in pick], side, (75, 100))
    assert {tuple(sorted(p)) for p in _closure(links)} == want


def _split(rows):
    import pyarrow as pa

    hashes, first = minhash.shingle_sets(pa.array([t for _, t in rows]))
    return hashes, first[1:-1]


def _closure(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [(x, find(x)) for x in list(root)]


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (3, None)],
        "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept)
                 for r in minhash.near_duplicates(docs).collect())
    assert [g for g in got if g[0] > 0] == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    for edges in ([(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 60)], [],
                  [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]):
        want = {}
        for x, y in _closure(edges):
            want[x] = y
        for a, b in edges:
            if a == b and all(a not in e for e in edges if e[0] != e[1]):
                want.pop(a, None)
        got = {r.node: r.component for r in components(
            spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == want
