"""Near-duplicate vectors by a subspace pigeonhole join.

Vectors of length one are rotated at random and split into ``BLOCKS`` subspaces. Cosine at
least t means a squared distance of at most 2 - 2t, and in some subspace the squared distance
is then at most the share of that budget that falls to its dimensions. So a pair is a
candidate if any subspace is within its budget, and the union of the candidates is verified
by cosine in double precision. Nothing is missed, whatever the data.

The vectors are dealt into cells by the nearest of a few pivots, and cells into tiles of
bounded size. Two tiles meet in one task, unless the boxes around them are farther apart than
the budget in every subspace. Links are counted in the task, and of the pairs found only edges
that keep connected what is linked leave it: never all pairs of a group.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.components import components
from framelake.session import stored

COSINE = 0.9
BLOCKS = 4
# Vectors of a tile, tiles there are at least, and pivots that cells are drawn around.
TILE = 6000
LEAST_TILES = 12
PIVOTS = 64
# Rows of one tile compared with the other at once.
_ROWS = 512
_PAIRS = 1 << 15
# Single precision may be off by this much in a squared distance.
_SLACK = 1e-4


@functools.lru_cache(maxsize=8)
def rotation(size: int) -> np.ndarray:
    """Orthogonal matrix, the same in every process."""
    drawn = np.random.default_rng(size).standard_normal((size, size))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def subspaces(size: int, blocks: int = BLOCKS) -> list[slice]:
    edges = np.linspace(0, size, min(blocks, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def budgets(size: int, cosine: float, blocks: int = BLOCKS) -> np.ndarray:
    """Squared distance allowed in each subspace, in proportion to its dimensions."""
    return np.array([(2 - 2 * cosine) * (s.stop - s.start) / size for s in subspaces(size, blocks)])


def matrix(bodies: list[bytes], size: int) -> np.ndarray:
    """Rows of length one, in double precision, from components in single or double."""
    raw = [np.frombuffer(b, np.float32 if len(b) == 4 * size else np.float64) for b in bodies]
    x = np.array(raw, np.float64).reshape(len(raw), size)
    # By the largest component first, so that no square overflows or vanishes.
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id``, ``size`` and ``body`` (components, as 4-byte values where that loses
    nothing) of the vectors that can link: not null, empty or zero, every component finite."""
    def check(batches):
        for batch in batches:
            ids, sizes, bodies = [], [], []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v")):
                values = v.values
                if values is None or len(values) == 0 or values.null_count:
                    continue
                x = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                narrow = x.astype(np.float32)
                ids.append(i)
                sizes.append(len(x))
                bodies.append((narrow if (narrow == x).all() else x).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()),
                                              pa.array(bodies, pa.binary())], names=["vec_id", "size", "body"])

    picked = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v"))
    return picked.filter("v IS NOT NULL AND vec_id IS NOT NULL").mapInArrow(
        check, "vec_id long, size int, body binary")


def tiled(units: DataFrame, tile: int = TILE, pivots: int = PIVOTS) -> DataFrame:
    """Add ``tile``: the cell around the nearest pivot, cut by hash where it is too large.

    The pivots are a bounded sample, evenly by hash, of each vector size.
    """
    spark = units.sparkSession
    sizes = {r["size"]: r["n"] for r in units.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = {}
    for size, n in sizes.items():
        cells = max(1, min(pivots, n // tile))
        rows = (units.filter(F.col("size") == size).orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(cells).collect())
        chosen[size] = matrix([r["body"] for r in rows], size)
    handed = spark.sparkContext.broadcast(chosen)

    def place(sizes: pa.Array, bodies: pa.Array) -> pa.Array:
        out = np.zeros(len(bodies), np.int32)
        numbers = sizes.to_numpy()
        every = bodies.to_pylist()
        for size in np.unique(numbers):
            rows = np.flatnonzero(numbers == size)
            out[rows] = (matrix([every[i] for i in rows], int(size)) @ handed.value[int(size)].T).argmax(1)
        return pa.array(out)

    cells = stored(units.withColumn("cell", F.arrow_udf(place, "int")("size", "body")), "cells")
    held = {(r["size"], r["cell"]): r["n"] for r in
            cells.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    ways = {}
    for (size, cell), n in held.items():
        least = LEAST_TILES if sum(s == size for s, _ in held) < LEAST_TILES else 1
        ways[size, cell] = max(-(-n // tile), -(-least * n // sizes[size]))
    first, at = {}, 0
    for key in sorted(ways):
        first[key], at = at, at + ways[key]
    if not ways:
        return cells.withColumn("tile", F.lit(0))
    # One row for each cell: at most PIVOTS for each size of vector.
    table = F.broadcast(spark.createDataFrame(
        [(s, c, first[s, c], w) for (s, c), w in ways.items()], "size int, cell int, first int, ways int"))
    own = F.pmod(F.xxhash64("vec_id", "body"), F.col("ways")).cast("int")
    return cells.join(table, ["size", "cell"]).select("vec_id", "size", "body", (F.col("first") + own).alias("tile"))


def boxes(tiles: DataFrame) -> list[tuple]:
    """(tile, size, least and greatest rotated components) of every tile."""
    def bound(table: pa.Table) -> pa.Table:
        size = table["size"][0].as_py()
        x = matrix(table["body"].to_pylist(), size) @ rotation(size)
        return pa.table({"tile": [table["tile"][0].as_py()], "size": [size], "lo": [x.min(0)], "hi": [x.max(0)]},
                        schema=pa.schema([("tile", pa.int32()), ("size", pa.int32()),
                                          ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]))

    return [(r["tile"], r["size"], np.array(r["lo"]), np.array(r["hi"])) for r in
            tiles.groupBy("tile").applyInArrow(bound, "tile int, size int, lo array<double>, hi array<double>").collect()]


def near(found: list[tuple], cosine: float, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """Pairs of tiles that some subspace does not rule out, each with itself included."""
    out = []
    for i, (a, size, lo, hi) in enumerate(found):
        limits, parts = budgets(size, cosine, blocks) + _SLACK, subspaces(size, blocks)
        for b, other, lo2, hi2 in found[i:]:
            gap = np.maximum(0, np.maximum(lo - hi2, lo2 - hi)) ** 2 if size == other else None
            if gap is not None and any(gap[s].sum() <= t for s, t in zip(parts, limits)):
                out.append((min(a, b), max(a, b)))
    return out


def compare(x: np.ndarray, y: np.ndarray, same: bool, cosine: float, blocks: int = BLOCKS):
    """Links found for each row of ``x`` and of ``y``, and edges (row of x, row of y) that
    connect what is linked. With ``same`` both are one tile."""
    size = x.shape[1]
    turn, parts = rotation(size), subspaces(size, blocks)
    limits = (budgets(size, cosine, blocks) + _SLACK).astype(np.float32)
    rx, ry = (x @ turn).astype(np.float32), (y @ turn).astype(np.float32)
    # d(a, b)^2 as one product: [a, |a|^2, 1] . [-2 b, 1, |b|^2].
    left, right = [], []
    for s in parts:
        a, b = rx[:, s], ry[:, s]
        left.append(np.column_stack([a, (a * a).sum(1), np.ones(len(a), np.float32)]))
        right.append(np.ascontiguousarray(np.column_stack([-2 * b, np.ones(len(b), np.float32), (b * b).sum(1)]).T))
    of_x, of_y, edges = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), []
    label = np.arange(len(x) + len(y))
    if same:
        label[len(x):] = np.arange(len(x))
    for at in range(0, len(x), _ROWS):
        rows = slice(at, at + _ROWS)
        hit = left[0][rows] @ right[0] <= limits[0]
        for a, b, t in zip(left[1:], right[1:], limits[1:]):
            hit |= a[rows] @ b <= t
        i, j = np.nonzero(hit)
        if same:
            keep = j > i + at
            i, j = i[keep], j[keep]
        # Where many pairs are candidates, one product is cheaper than picking them out.
        cosines = x[rows] @ y.T if len(i) > hit.size // 50 else None
        for part in range(0, len(i), _PAIRS):
            p, q = i[part:part + _PAIRS] + at, j[part:part + _PAIRS]
            value = np.einsum("ij,ij->i", x[p], y[q]) if cosines is None else cosines[p - at, q]
            linked = value >= cosine
            p, q = p[linked], q[linked]
            of_x += np.bincount(p, minlength=len(x))
            of_y += np.bincount(q, minlength=len(y))
            edges += _joining(label, p, q, len(x))
    return of_x, of_y, edges


def _joining(label, p, q, offset) -> list[tuple[int, int]]:
    """Those of the pairs that join parts not yet joined; ``label`` is kept up to date."""
    out = []
    open_ = label[p] != label[q + offset]
    p, q = p[open_], q[open_]
    while len(p):
        # One pair for each part that a pair would merge into a smaller one.
        a, b = label[p], label[q + offset]
        high, low = np.maximum(a, b), np.minimum(a, b)
        order = np.lexsort((low, high))
        head = np.ones(len(order), bool)
        head[1:] = high[order][1:] != high[order][:-1]
        pick = order[head]
        out += list(zip(p[pick].tolist(), q[pick].tolist()))
        into = np.arange(len(label))
        into[high[pick]] = low[pick]
        while True:
            further = into[into]
            if (further == into).all():
                break
            into = further
        label[:] = into[label]
        open_ = label[p] != label[q + offset]
        p, q = p[open_], q[open_]
    return out


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding",
                    cosine: float = COSINE, tile: int = TILE, blocks: int = BLOCKS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector.

    Vectors link at a cosine of at least ``cosine``. Vectors that are null, empty, zero or
    hold a null or non-finite component, and rows without an id, link with nothing, and so do
    vectors of different sizes. Rows that share an id are one node, with the links of all of
    them, those among each other included.
    """
    spark = vectors.sparkSession
    tiles = stored(tiled(usable(vectors, id, vector), tile), "tiles")
    pairs = near(boxes(tiles), cosine, blocks)
    # What a tile meets: bounded by the number of tiles, not of vectors.
    meets: dict[int, list] = {}
    for a, b in pairs:
        meets.setdefault(a, []).append((a, b, 0))
        if a != b:
            meets.setdefault(b, []).append((a, b, 1))
    table = spark.createDataFrame(list(meets.items()), "tile int, meets array<struct<p:int,q:int,side:int>>")
    dealt = tiles.join(F.broadcast(table), "tile").select(
        "vec_id", "size", "body", F.explode("meets").alias("m")).select("vec_id", "size", "body", "m.*")

    def meet(key: tuple, found: pa.Table) -> pa.Table:
        found = found.sort_by([("side", "ascending"), ("vec_id", "ascending")])
        ids, side = found["vec_id"].to_numpy(), found["side"].to_numpy()
        body, n = found["body"].to_pylist(), int((side == 0).sum())
        same = key[0].as_py() == key[1].as_py()
        if n == 0 or not same and n == len(body):
            return _links([], [], [], [])
        size = found["size"][0].as_py()
        x = matrix(body[:n], size)
        y = x if same else matrix(body[n:], size)
        of_x, of_y, edges = compare(x, y, same, cosine, blocks)
        second = ids[:n] if same else ids[n:]
        rows = [(ids[:n], of_x), (second, of_y)]
        counted = [(i[c > 0], c[c > 0]) for i, c in rows]
        return _links(np.concatenate([i for i, _ in counted]), np.concatenate([c for _, c in counted]),
                      [ids[a] for a, _ in edges], [second[b] for _, b in edges])

    found = stored(dealt.groupBy("p", "q").applyInArrow(
        meet, "vec_id long, links long, a long, b long"), "links")
    counts = found.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    labels = components(found.filter("a IS NOT NULL").select("a", "b"))
    every = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"))
    out = (every.join(counts, "vec_id", "left")
           .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _links(ids, counts, a, b) -> pa.Table:
    shape = pa.schema([("vec_id", pa.int64()), ("links", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
    n, m = len(ids), len(a)
    return pa.table([pa.array([*ids, *[None] * m], pa.int64()), pa.array([*counts, *[None] * m], pa.int64()),
                     pa.array([*[None] * n, *a], pa.int64()), pa.array([*[None] * n, *b], pa.int64())], schema=shape)
