"""How the word use of sources differs within a language, on run-length columns.

The vocabulary of a language is put in an order in which terms with equal counts in the largest
sources are neighbours, and cut into blocks. In a block every source is one column of counts,
kept as runs of equal values. Two sources are compared on the common borders of their runs,
each value counting as often as the run is long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm import vocab, words
from framelake.operators import ordered
from framelake.operators.joins import attach, attach_bounded
from framelake.session import durable, stored

LEAST_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
# Terms of a block and sources of a tile: what one task holds at once.
BLOCK_TERMS = 16_384
TILE = 64
# Blocks of a range when the vocabulary is sorted.
RANGE_BLOCKS = 4
# Largest sources whose counts decide the order of terms one by one.
LEADING = 16
# Text whose terms are counted together before they leave a worker.
COUNT_BYTES = 4 << 20

COUNTED = "lang string, source string, term string, tf bigint, df bigint"
# Row of a column: a count (term of the language's column only), or with pos -1 the column's
# denominator and the size of the block.
COLUMN = "lang string, part bigint, block bigint, ta int, tb int, idx int, pos bigint, n bigint, size bigint, term string"
FOUND = "lang string, a int, b int, term string, value bigint"


def _count_block(lang: pa.Array, source: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    text, term, distinct = words.folded_terms(texts, words.LETTERS)
    (lang_code, langs), (source_code, sources) = words.codes(lang), words.codes(source)
    n_terms = max(1, len(distinct))
    # Once for each text and term, then once for each group and term.
    in_text, times = np.unique(text * n_terms + term, return_counts=True)
    group = lang_code * len(sources) + source_code
    keys, at = np.unique(group[in_text // n_terms] * n_terms + in_text % n_terms, return_inverse=True)
    tf = np.bincount(at, weights=times, minlength=len(keys)).astype(np.int64)
    df = np.bincount(at, minlength=len(keys)).astype(np.int64)
    of = keys // n_terms
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(of // len(sources))).cast(pa.string()),
         sources.take(pa.array(of % len(sources))).cast(pa.string()),
         distinct.take(pa.array(keys % n_terms)).cast(pa.string()), pa.array(tf), pa.array(df)],
        ["lang", "source", "term", "tf", "df"])


def _count(batches):
    for batch in batches:
        for a, b in vocab.byte_blocks(batch.column(2), COUNT_BYTES):
            part = batch.slice(a, b - a)
            yield _count_block(part.column(0), part.column(1), part.column(2))


def _share(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exact for counts of any size."""
    if len(counts) and int(counts.max()) + 2 >= (1 << 63) // SCALE:
        return np.array([1 + SCALE * (int(c) + 2) // total for c in counts], np.int64)
    return 1 + SCALE * (counts + 2) // total


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Column:
    """Counts of one source over a block, as runs: where each begins, its count, its share."""

    def __init__(self, pos: np.ndarray, counts: np.ndarray, total: int, size: int):
        dense = np.zeros(size, np.int64)
        dense[pos] = counts
        self.start = np.r_[0, np.flatnonzero(np.diff(dense)) + 1]
        self.count = dense[self.start]
        self.share = _share(self.count, total)
        self.size = size

    def meet(self, other: Column):
        """Common runs: where each begins, its length, and which run of either it lies in."""
        start = np.union1d(self.start, other.start)
        length = np.diff(start, append=self.size)
        return (start, length, np.searchsorted(self.start, start, "right") - 1,
                np.searchsorted(other.start, start, "right") - 1)

    def distance(self, other: Column) -> int:
        _, length, a, b = self.meet(other)
        return int((_gap(self.share[a], other.share[b]) * length).sum())


def _typical(source: Column, whole: Column, terms: list[str], top: int) -> list[tuple[str, int]]:
    """Terms of a block that the source uses more than its language: the ``top`` of them."""
    start, length, a, b = source.meet(whole)
    more = (source.count[a] > 0) & (source.share[a] > whole.share[b])
    start, length = start[more], length[more]
    value = _gap(source.share[a[more]], whole.share[b[more]])
    if not len(value):
        return []
    order = np.argsort(-value, kind="stable")
    enough = order[min(len(order) - 1, int(np.searchsorted(np.cumsum(length[order]), top)))]
    found = [(terms[i], int(v)) for s, n, v in zip(start, length, value) if v >= value[enough]
             for i in range(s, s + n)]
    return sorted(found, key=lambda f: (-f[1], f[0].encode()))[:top]


def _compare(table: pa.Table, top: int, tile: int = TILE) -> pa.Table:
    """Sums over one block for the pairs of two tiles of sources; in a pair of a tile with itself
    the leading terms of its sources as well."""
    ta, tb = table["ta"][0].as_py(), table["tb"][0].as_py()
    idx, pos, n, size = (table[c].to_numpy() for c in ("idx", "pos", "n", "size"))
    order = np.lexsort((pos, idx))
    idx, pos, n, size = idx[order], pos[order], n[order], size[order]
    edges = np.flatnonzero(np.diff(idx, prepend=idx[0] - 1))
    columns = {}
    for lo, hi in zip(edges, np.r_[edges[1:], len(idx)]):
        # The first row of a column states its denominator and the size of the block.
        columns[int(idx[lo])] = Column(pos[lo + 1:hi], n[lo + 1:hi], int(n[lo]), int(size[lo]))
    whole = columns.pop(-1, None)
    rows = []
    for a, left in columns.items():
        for b, right in columns.items():
            if a < b and (ta == tb or a // tile != b // tile):
                rows.append((a, b, None, left.distance(right)))
    if whole is not None:
        terms = table["term"].take(pa.array(order[1:whole.size + 1])).to_pylist()
        for a, column in columns.items():
            rows += [(a, None, t, v) for t, v in _typical(column, whole, terms, top)]
    lang = table["lang"][0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(rows), pa.string()), "a": pa.array([r[0] for r in rows], pa.int32()),
        "b": pa.array([r[1] for r in rows], pa.int32()), "term": pa.array([r[2] for r in rows], pa.string()),
        "value": pa.array([r[3] for r in rows], pa.int64())})


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          least_docs: int = LEAST_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS, tile: int = TILE) -> DataFrame:
    """One row (lang, source, part, item, value, rank) for each pair of sources of a language
    (``pair``, all ranks) and for the terms a source uses more than its language (``term``, to
    rank ``top``), ranked by value, then by the UTF-8 order of the item.

    Null text, language and source count as empty, so they form a group like others; a repeated
    row counts again. A language without a kept term has pairs of value 0; an empty table has no
    rows. Other columns are ignored. Texts are counted in blocks of 4 MB, a longer one by itself.
    """
    spark = docs.sparkSession

    def filled(name, alias):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(alias)

    body = docs.select(filled(lang, "lang"), filled(source, "source"), filled(text, "text"))
    by_lang = Window.partitionBy("lang")
    # One row a source, numbered by falling size.
    groups = durable(body.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_docs")).select(
        "lang", "source", (F.row_number().over(by_lang.orderBy(F.desc("_docs"), "source")) - 1).alias("idx"),
        F.count(F.lit(1)).over(by_lang).alias("_n")).withColumn(
        "tiles", F.expr(f"int(div(_n + {tile - 1}, {tile}))")).drop("_n"))
    counts = stored(attach(
        body.mapInArrow(_count, COUNTED).groupBy("lang", "source", "term").agg(
            F.sum("tf").alias("tf"), F.sum("df").alias("df")),
        groups, ["lang", "source"], "inner").select("lang", "idx", "term", "tf", "df"), "counts")

    leading = F.array(*[F.sum(F.when(F.col("idx") == k, F.col("tf")).otherwise(0)) for k in range(LEADING)])
    rest = F.bit_xor(F.when(F.col("idx") >= LEADING, F.xxhash64("idx", "tf")).otherwise(0))
    kept = stored(counts.groupBy("lang", "term").agg(
        F.sum("tf").alias("n"), F.sum("df").alias("df"), leading.alias("leading"), rest.alias("rest")).filter(
        F.col("df") >= least_docs).drop("df"), "kept")
    width = max(1, math.ceil(kept.count() / (RANGE_BLOCKS * block_terms)))
    rows = ordered.lay_out(kept, ["lang"], ["leading", "rest", "term"], width)
    in_part = F.col(ordered.ROW).bitwiseAND((1 << 33) - 1)
    rows = rows.select("lang", "term", "n", F.col(ordered.PART).cast("bigint").alias("part"),
                       F.expr(f"div({ordered.ROW} & {(1 << 33) - 1}, {block_terms})").alias("block"),
                       in_part.alias("_at"))
    sizes = durable(rows.groupBy("lang", "part", "block").agg(
        F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("_sum")))
    placed = stored(attach_bounded(rows, sizes, ["lang", "part", "block"]).select(
        "lang", "term", "n", "part", "block", (F.col("_at") - F.col("_lo")).alias("pos")), "placed")
    # The vocabulary grows with the text, so both sides shuffle whatever its size: a broadcast would
    # pass all of it through the driver. A term has no more rows than its language has sources.
    cells = stored(counts.select("lang", "term", "idx", "tf").join(
        placed.select("lang", "term", "part", "block", "pos").hint("merge"), ["lang", "term"]).select(
        "lang", "part", "block", "idx", "pos", F.col("tf").alias("n")), "cells")

    langs = durable(groups.groupBy("lang").agg(F.max("tiles").alias("tiles")).join(
        sizes.groupBy("lang").agg(F.sum("size").alias("v"), F.sum("_sum").alias("total")), ["lang"], "left"))
    totals = attach(groups, cells.groupBy("lang", "idx").agg(F.sum("n").alias("n")), ["lang", "idx"])
    totals = attach(totals, langs.select("lang", "v"), ["lang"])
    denominators = totals.filter("v IS NOT NULL").select(
        "lang", "idx", (F.coalesce("n", F.lit(0)) + 2 * F.col("v")).alias("n"), "tiles").unionByName(
        langs.filter("v IS NOT NULL").select(
            "lang", F.lit(-1).alias("idx"), (F.col("total") + 2 * F.col("v")).alias("n"), "tiles"))
    # A column has a row in every block, so that a source without any term there counts too.
    heads = attach(sizes.select("lang", "part", "block", "size"), denominators, ["lang"], "inner").select(
        "lang", "part", "block", "idx", F.lit(-1).cast("bigint").alias("pos"), "n", "size", "tiles",
        F.lit(None).cast("string").alias("term"))
    filler = [F.lit(None).cast("bigint").alias("size")]
    tiles = langs.select("lang", "tiles")
    of_lang = attach(placed, tiles, ["lang"]).select(
        "lang", "part", "block", F.lit(-1).alias("idx"), "pos", "n", *filler, "tiles", "term")
    of_source = attach(cells, tiles, ["lang"]).select(
        "lang", "part", "block", "idx", "pos", "n", *filler, "tiles", F.lit(None).cast("string").alias("term"))
    columns = heads.unionByName(of_lang).unionByName(of_source)
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    mine = F.expr(f"int(div(idx, {tile}))")
    dealt = columns.withColumn("_o", other).select(
        "lang", "part", "block",
        F.when(F.col("idx") < 0, F.col("_o")).otherwise(F.least(mine, "_o")).alias("ta"),
        F.when(F.col("idx") < 0, F.col("_o")).otherwise(F.greatest(mine, "_o")).alias("tb"),
        "idx", "pos", "n", "size", "term")

    found = stored(dealt.groupBy("lang", "part", "block", "ta", "tb").applyInArrow(
        lambda table: _compare(table, top, tile), FOUND), "compared")
    half = found.filter("term IS NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # Without a kept term no block compares the sources of a language.
    bare = attach(groups, langs.filter("v IS NULL").select("lang"), ["lang"], "leftsemi").select("lang", "idx")
    zero = bare.withColumnRenamed("idx", "a").join(bare.withColumnRenamed("idx", "b"), ["lang"]).filter(
        "a < b").withColumn("value", F.lit(0).cast("bigint"))
    half = half.unionByName(zero)
    both = half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"))
    pairs = attach(both, names, ["lang", "b"], "inner").select("lang", "a", F.lit("pair").alias("part"), "item", "value")
    terms = found.filter("term IS NOT NULL").select(
        "lang", "a", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))
    names = groups.select("lang", F.col("idx").alias("a"), "source")
    return attach(ranked, names, ["lang", "a"], "inner").select("lang", "source", "part", "item", "value", "rank")
