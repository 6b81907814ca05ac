"""Ranked search over shards of documents, each indexed by a K2-treap.

A shard is a grid with a row for each term and a column for each document, in which a cell holds
the impact of the term on the document. The grid is cut into quarters again and again; of every
quarter that is not empty the index keeps which of its own quarters are not empty and by how much
its greatest impact is below that of the quarter around it. A search follows the rows of all
terms of an item from the top together, always into the ranges of documents whose sum of greatest
impacts is the highest, and ends where no range can hold a better document.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm import vocab, words
from framelake.operators.joins import attach
from framelake.session import stored

TOP = 20
# Text and documents of a shard; a longer text is a shard by itself.
SHARD_BYTES = 8 << 20
SHARD_DOCS = 8192
# Ranges of documents taken further at once, fewer of them until enough documents are found, and
# path ends held at once for an item.
BEAM, FIRST_BEAM = 256, 32
PATHS = 4_000_000
# Terms of items that are handed to all workers at once.
BLOCK_TERMS = 200_000

SHARD = "terms binary, df binary, masks binary, drops binary, height int, doc_ids array<bigint>"
_ONES = np.array([bin(i).count("1") for i in range(16)], np.int64)


def _packed(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd"), kind)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers, a zero before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 25 + floor(25 * length * documents / terms), exact for any size."""
    if 25 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
        return 75 + 25 * lengths * n_docs // n_terms
    return np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], np.int64)


def _shard(doc_ids: pa.Array, texts: pa.Array, n_docs: int, n_terms: int) -> pa.RecordBatch | None:
    text, term, distinct = words.folded_terms(texts, words.LETTERS_DIGITS)
    if not len(text):
        return None
    lengths = np.bincount(text, minlength=len(texts))
    keys, tf = np.unique(text * len(distinct) + term, return_counts=True)
    text, term = keys // len(distinct), keys % len(distinct)
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * _norms(lengths, n_docs, n_terms)[text])
    # Frequent terms are neighbours, and so are documents of like length: their impacts are alike.
    df = np.bincount(term)
    by_df = np.argsort(-df, kind="stable")
    row = np.empty(len(df), np.int64)
    row[by_df] = np.arange(len(df))
    worded = np.flatnonzero(lengths)
    by_length = worded[np.argsort(lengths[worded], kind="stable")]
    column = np.zeros(len(texts), np.int64)
    column[by_length] = np.arange(len(by_length))
    height = max(1, int(max(len(df), len(by_length)) - 1).bit_length())

    cell = (_spread(row[term]) << np.uint64(1)) | _spread(column[text])
    order = np.argsort(cell)
    cell, most = cell[order], impact[order]
    masks, levels = [], [most]
    for _ in range(height):
        quarter, cell = (cell & np.uint64(3)).astype(np.uint8), cell >> np.uint64(2)
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        masks.append(np.bitwise_or.reduceat(np.uint8(1) << quarter, first))
        levels.append(np.maximum.reduceat(levels[-1], first))
        cell = cell[first]
    masks, levels = masks[::-1], levels[::-1]
    drops = [levels[0]] + [np.repeat(up, _ONES[mask]) - down for up, mask, down in zip(levels, masks, levels[1:])]
    names = distinct.take(pa.array(by_df)).cast(pa.large_binary())
    ids = doc_ids.take(pa.array(by_length)).cast(pa.int64())
    return pa.RecordBatch.from_pydict({
        "terms": [_packed(np.frombuffer(b"\n".join(names.to_pylist()), np.uint8))],
        "df": [_packed(df[by_df].astype(np.int32))], "masks": [_packed(np.concatenate(masks))],
        "drops": [_packed(np.concatenate(drops).astype(np.int32))], "height": pa.array([height], pa.int32()),
        "doc_ids": pa.array([ids.to_pylist()], pa.list_(pa.int64()))})


def index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = SHARD_BYTES,
          shard_docs: int = SHARD_DOCS) -> tuple[DataFrame, int]:
    """Stored shards of all documents, one row each, and the number of documents with a term.

    Every document lies in one shard, in which its terms count whole. Shards are cut by bytes
    within a task; no row is moved.
    """
    body = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").cast("string").alias("text"))

    def count(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0, np.int64)]
        for a, b in vocab.byte_blocks(texts):
            _, bounds, _, start, _ = words.spans(texts[a:b], words.LETTERS_DIGITS)
            out.append(np.diff(np.searchsorted(start, bounds)))
        return pa.array(np.concatenate(out))

    totals = body.select(F.arrow_udf(count, "bigint")("text").alias("n")).agg(
        F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"] or 0

    def build(batches):
        held, size, rows = [], 0, 0

        def flush():
            ids = pa.concat_arrays([p.column(0) for p in held])
            texts = pa.concat_arrays([p.column(1).cast(pa.large_string()) for p in held])
            return _shard(ids, texts, n_docs, n_terms)

        for batch in batches:
            for a, b in vocab.byte_blocks(batch.column(1)):
                for c in range(a, b, shard_docs):
                    part = batch.slice(c, min(b, c + shard_docs) - c)
                    if held and (size + part.nbytes > shard_bytes or rows + part.num_rows > shard_docs):
                        made, held, size, rows = flush(), [], 0, 0
                        if made:
                            yield made
                    held.append(part)
                    size, rows = size + part.nbytes, rows + part.num_rows
        if held:
            made = flush()
            if made:
                yield made

    return stored(body.mapInArrow(build, SHARD), "shards"), n_docs


class Shard:
    """A K2-treap as arrays: quarters in the order of their levels, each with the mask of its
    own quarters, the first of them, and the greatest impact in it. The last entry is empty."""

    def __init__(self, masks: bytes, drops: bytes, height: int, doc_ids: list):
        masks, drops = _unpacked(masks, np.uint8), _unpacked(drops, np.int32)
        self.height, self.doc_ids, self.none = height, doc_ids, len(drops)
        self.masks = np.zeros(len(drops) + 1, np.uint8)
        self.masks[:len(masks)] = masks
        ones = _ONES[self.masks]
        self.first = np.cumsum(ones) - ones + 1
        self.most = np.zeros(len(drops) + 1, np.int64)
        self.most[0] = drops[0]
        lo, hi = 0, 1
        for _ in range(height):
            n = int(ones[lo:hi].sum())
            self.most[hi:hi + n] = np.repeat(self.most[lo:hi], ones[lo:hi]) - drops[hi:hi + n]
            lo, hi = hi, hi + n

    def down(self, at: np.ndarray, row_bit: np.ndarray, column_bit: int) -> np.ndarray:
        """Quarters below those given, on the side of the row bit and the column bit."""
        quarter = (2 * row_bit + column_bit).astype(np.uint8)
        mask = self.masks[at]
        there = (mask >> quarter) & 1
        return np.where(there == 1, self.first[at] + _ONES[mask & ((np.uint8(1) << quarter) - np.uint8(1))], self.none)


class Best:
    """The highest scores so far, of equal ones those with the smaller ids; a null id comes last."""

    def __init__(self, top: int):
        self.top, self.found, self.floor = top, [], 1

    def add(self, scores, ids) -> None:
        self.found += [(-int(s), i is None, i) for s, i in zip(scores, ids) if s >= self.floor]
        self.found = sorted(self.found, key=lambda f: (f[0], f[1], f[2] or 0))[:self.top]
        if len(self.found) == self.top:
            self.floor = -self.found[-1][0]


def _descend(shard: Shard, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Put the best documents of a shard into ``best``. ``rows`` are the rows of an item's terms."""
    # An item of very many terms goes through narrower ranges of documents, one after the other.
    depth = 0
    while depth < shard.height and len(rows) << (shard.height - depth) > PATHS:
        depth += 1
    span = shard.height - depth
    for begin in range(0, ((len(shard.doc_ids) - 1) >> span) + 1):
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            at = shard.down(at, (rows >> (shard.height - 1 - level)) & 1, (begin >> (depth - 1 - level)) & 1)
        _best_first(shard, rows, weights, best, depth, begin, at[None, :])


def _best_first(shard: Shard, rows, weights, best: Best, level: int, column: int, paths: np.ndarray) -> None:
    levels, columns = np.array([level]), np.array([column])
    bounds = shard.most[paths] @ weights
    if level == shard.height:
        best.add(bounds, [shard.doc_ids[column]])
        return
    while True:
        live = bounds >= best.floor
        if not live.any():
            return
        levels, columns, bounds, paths = levels[live], columns[live], bounds[live], paths[live]
        beam = BEAM if len(best.found) == best.top else FIRST_BEAM
        if len(bounds) > beam:
            order = np.argpartition(-bounds, beam)
            now, later = order[:beam], order[beam:]
        else:
            now, later = np.arange(len(bounds)), np.zeros(0, np.int64)
        row_bit = (rows[None, :] >> (shard.height - 1 - levels[now])[:, None]) & 1
        below = np.concatenate([shard.down(paths[now], row_bit, bit) for bit in (0, 1)])
        level = np.tile(levels[now] + 1, 2)
        column = np.concatenate([2 * columns[now], 2 * columns[now] + 1])
        bound = shard.most[below] @ weights
        done = (level == shard.height) & (bound >= best.floor)
        if done.any():
            # Cells of one document: the bound is its score.
            best.add(bound[done], [shard.doc_ids[c] for c in column[done]])
        on = (level < shard.height) & (bound >= best.floor)
        levels, columns = np.r_[levels[later], level[on]], np.r_[columns[later], column[on]]
        bounds, paths = np.r_[bounds[later], bound[on]], np.concatenate([paths[later], below[on]])


def _names(terms: bytes) -> pa.Array:
    return pa.array(_unpacked(terms, np.uint8).tobytes().split(b"\n"), pa.large_binary())


def _frequencies(shards: DataFrame, vocabulary) -> np.ndarray:
    """Documents that hold each of the terms."""
    def count(batches):
        wanted = pa.array(vocabulary.value, pa.large_binary())
        sums = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for terms, df in zip(batch.column(0), batch.column(1)):
                at = pc.index_in(wanted, _names(terms.as_py()))
                held = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                sums[held] += _unpacked(df.as_py(), np.int32)[at.drop_null().to_numpy()]
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some), "df": pa.array(sums[some])})

    out = np.zeros(len(vocabulary.value), np.int64)
    found = shards.select("terms", "df").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(
        F.sum("df").alias("df"))
    for row in found.toLocalIterator():
        out[row["term"]] = row["df"]
    return out


def _search(shards: DataFrame, handed, top: int) -> DataFrame:
    """Best documents of each item in each task: shards of a task share what they found."""
    def find(batches):
        vocabulary, weights, items = pickle.loads(handed.value)
        wanted = pa.array(vocabulary, pa.large_binary())
        best = {key: Best(top) for key, _, _ in items}
        for batch in batches:
            for row in batch.to_pylist():
                at = pc.fill_null(pc.index_in(wanted, _names(row["terms"])), -1).to_numpy().astype(np.int64)
                shard = Shard(row["masks"], row["drops"], row["height"], row["doc_ids"])
                for key, terms, times in items:
                    here = (at[terms] >= 0) & (weights[terms] > 0)
                    if here.any():
                        _descend(shard, at[terms[here]], weights[terms[here]] * times[here], best[key])
        rows = [(key, i, -s) for key, b in best.items() for s, _, i in b.found]
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([r[0] for r in rows], pa.int64()), "doc_id": pa.array([r[1] for r in rows], pa.int64()),
            "score": pa.array([r[2] for r in rows], pa.int64())})

    return shards.select("terms", "masks", "drops", "height", "doc_ids").mapInArrow(
        find, "key bigint, doc_id bigint, score bigint")


def _item_terms(batches):
    for batch in batches:
        for a, b in vocab.byte_blocks(batch.column(1)):
            of, term, distinct = words.folded_terms(batch.column(1)[a:b], words.LETTERS_DIGITS)
            n = max(1, len(distinct))
            keys, times = np.unique(of * n + term, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column(0)[a:b].take(pa.array(keys // n)),
                "term": distinct.cast(pa.large_binary()).take(pa.array(keys % n)).cast(pa.binary()),
                "times": pa.array(times.astype(np.int64))})


def search(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, block: int = BLOCK_TERMS, **options) -> DataFrame:
    """The ``top`` best documents of each item as rows (item_id, rank, doc_id, score).

    All documents are searched. A repeated document ranks as often as it occurs, and each row
    of ``items`` is searched by itself, so a repeated item gives its rows again. Null and
    wordless texts count in nothing and are not found; documents without an id rank last among
    equal scores. Items without a term, or without one that occurs, have no rows. Other
    columns of both tables are ignored.
    """
    spark = docs.sparkSession
    shards, n_docs = index(docs, text, doc_id, **options)
    asked = stored(items.select(
        F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("key")), "items")
    terms = stored(asked.select("key", "text").mapInArrow(_item_terms, "key bigint, term binary, times bigint"), "terms")
    # Items go to the workers in blocks, so that neither driver nor worker holds all of many.
    blocks = max(1, -(-terms.count() // block))
    found = None
    for b in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toArrow()
        code, distinct = words.codes(part["term"].combine_chunks())
        vocabulary = distinct.to_pylist()
        sent = spark.sparkContext.broadcast(vocabulary)
        df = _frequencies(shards, sent)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) if n else 0 for n in df],
                           np.int64)
        keys, times = part["key"].to_numpy(), part["times"].to_numpy()
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.diff(keys[order], prepend=-1))
        batches = [(int(keys[o[0]]), code[o], times[o]) for o in np.split(order, edges[1:]) if len(o)]
        handed = spark.sparkContext.broadcast(pickle.dumps((vocabulary, weights, batches)))
        here = stored(_search(shards, handed, top), "found")
        found = here if found is None else found.unionByName(here)
        sent.unpersist()
        handed.unpersist()
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return attach(ranked, asked.select("key", "item_id"), ["key"], "inner").select("item_id", "rank", "doc_id", "score")
