import numpy as np
import pytest

from framelake.llm import embeddings as emb


def corpus():
    rng = np.random.default_rng(6)
    rows = [rng.standard_normal(16) for _ in range(150)]
    for spread, copies in ((0.02, 40), (0.25, 60), (0.3, 60)):
        base = rng.standard_normal(16)
        rows += [base + spread * rng.standard_normal(16) for _ in range(copies)]
    rows += [rows[0].copy() for _ in range(30)] + [rows[1] * 1e200, rows[1] * 1e-200]
    rng.shuffle(rows)
    return [(7 * i, [float(x) for x in v]) for i, v in enumerate(rows)]


ODD = [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] + [1.0] * 15),
       (9005, [None] + [1.0] * 15), (9006, [float("inf")] + [1.0] * 15), (9007, [1.0, 2.0]), (9008, [2.0, 4.0])]


def brute(rows, cosine=0.9):
    root, count = {i: i for i, _ in rows}, dict.fromkeys((i for i, _ in rows), 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ok = [(i, np.array(v, float)) for i, v in rows
          if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    ok = [(i, v / np.abs(v).max()) for i, v in ok]
    for k, (i, a) in enumerate(ok):
        for j, b in ok[:k]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                count[i] += 1
                count[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, count[i], find(i), find(i) == i) for i, _ in rows)


@pytest.mark.parametrize("tile", [6000, 20])
def test_against_brute_force(spark, tile):
    rows = corpus() + ODD
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, size int")
    got = sorted(tuple(r) for r in emb.near_duplicates(vectors, tile=tile).collect())
    assert got == brute(rows)


def test_given_table_and_empty(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert sorted(tuple(r) for r in emb.near_duplicates(vectors).collect()) == brute(rows)
    assert emb.near_duplicates(vectors.limit(0)).count() == 0


def test_tiles_that_no_subspace_can_bridge_are_left_out():
    far = np.zeros(16)
    far[0] = 1
    found = [(0, 16, np.full(16, 0.4), np.full(16, 0.5)), (1, 16, np.full(16, -0.5), np.full(16, -0.4)),
             (2, 8, np.zeros(8), np.zeros(8))]
    assert emb.near(found, 0.9) == [(0, 0), (1, 1), (2, 2)]
