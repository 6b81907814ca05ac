import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from framelake.llm import packing


def check(plan, counts, capacity):
    held = collections.Counter()
    for number, lengths in plan:
        assert number > 0 and 0 < sum(lengths) <= capacity
        for length in lengths:
            held[length] += number
    assert held == +collections.Counter(counts)
    return sum(number for number, _ in plan)


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_everything_in_few_sequences(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1024])
    counts = collections.Counter(min(capacity, 1 + int(rng.expovariate(1 / (capacity * rng.choice([0.1, 0.4, 0.7])))))
                                 for _ in range(rng.choice([10, 500, 20000])))
    used = check(packing.plan(counts, capacity), counts, capacity)
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    # Pieces of more than half a sequence cannot share one.
    least = max(least, sum(c for n, c in counts.items() if 2 * n > capacity))
    assert used <= least * 1.02 + 3


@pytest.mark.parametrize("counts", [{}, {1: 5}, {1024: 7}, {513: 9}, {512: 9}, {600: 1, 424: 1}, {1: 1, 1024: 1}])
def test_plan_corner_cases(counts):
    check(packing.plan(counts), counts, 1024)


def test_groups_have_equal_cardinality():
    histogram = np.zeros(101, np.int64)
    histogram[[90, 80, 70, 60]] = [7, 1, 20, 2]
    grouped = packing.group(histogram, 50, 3)
    assert [sum(a.values()) for _, a in grouped] == [10, 10, 10]
    assert [size for size, _ in grouped] == [90, 70, 70]


def test_configurations_beat_single_sizes():
    chosen = packing.configurations([6, 5, 4], [10, 10, 10], 10)
    assert sum(n for _, n in chosen) == pytest.approx(15)


TEXTS = [(1, None), (2, ""), (3, "word " * 30), (4, "a b c " * 40), (5, "same"), (5, "same"), (None, "no id")]


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id long, text string, length string")
    rows = packing.pack_documents(docs, capacity=16).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.piece))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, text in set(TEXTS):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want, first = [], (len(ids) - 1) % 16 + 1
        for i, end in enumerate(range(first, len(ids) + 1, 16)):
            start = end - 16 if i else 0
            want.append((start, end - start, zlib.crc32(ids[start:end].tobytes()), i))
        assert sorted(pieces[doc]) == sorted(want * TEXTS.count((doc, text)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 16
    assert packing.pack_documents(docs.limit(0)).count() == 0
