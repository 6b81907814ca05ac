import re

import pytest

from framelake.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n=10):
    tokens, hit, names = folded(text), set(), set()
    for item, body in items:
        want = folded(body)
        size = min(n, len(want))
        if not size or item is None:
            continue
        grams = {tuple(want[k:k + size]) for k in range(len(want) - size + 1)}
        for k in range(len(tokens) - size + 1):
            if tuple(tokens[k:k + size]) in grams:
                hit.update(range(k, k + size))
                names.add(str(item))
    return len(tokens), sorted(hit), sorted(names)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Alpha beta GAMMA"), (10, "é-ü"),
         (3, None), (4, "..."), (5, "one two three four five six seven eight nine ten"), (None, "lone item"),
         (2, "Alpha beta GAMMA")]
TEXTS = [None, "", "...", "One, two; THREE four-five six seven eight nine ten eleven twelve",
         "alpha beta", "x alpha.beta gamma y alpha beta gamma", "É ü é ü", "one two three four five six seven eight nine",
         "a " * 3000 + "alpha beta gamma " + "b" * 500, "lone item", "\x80 alpha\nbeta\tgamma"]


@pytest.mark.parametrize("block", [1_000_000, 1])
def test_against_brute_force(spark, block):
    docs = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(TEXTS)], "doc_id int, text string, items string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r.doc_id: r for r in dec.scan(docs, items, block=block).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        found = got[i].found
        assert (found.n_words, list(found.hits), list(found.items)) == brute(text, ITEMS), text
        assert got[i].items == "keep"


def test_empty_and_cut(spark):
    docs = spark.createDataFrame([(1, "keep this. Alpha, beta gamma! and this"), (2, None)], "doc_id int, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.doc_id for r in dec.drop_contaminated(docs, none).collect()} == {1, 2}
    assert {r.doc_id for r in dec.drop_contaminated(docs, items).collect()} == {2}
    assert {r.text for r in dec.cut_spans(docs, items).collect()} == {"keep this. ! and this", None}
    assert dec.scan(docs.limit(0), items).count() == 0
