"""Packing of documents into sequences of a fixed number of tokens.

The number of distinct lengths is bounded by the capacity, so the packing itself is decided
on the histogram of lengths, whatever the number of documents:

1. linear grouping: the pieces longer than ``small`` are sorted and cut into groups of equal
   cardinality, and each group is rounded up to its largest length;
2. configurations: the few rounded sizes are packed by a linear programme over
   configurations (multisets that fit), solved by column generation and rounded down;
3. substitution: the longest actual pieces within a place's size take the places, the last
   place of a sequence takes the longest that fits the room that rounding has left, and what
   is left over and the small pieces go into the remaining gaps by best fit, longest first.

Each step works on counts: sequences with the same content so far are one entry. The result
says how many sequences of which content there are; Spark numbers the pieces of each length
and looks up their place.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import records, vocab
from framelake.operators import ordered
from framelake.operators.joins import attach_bounded
from framelake.session import stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
CAPACITY = 1024
GROUPS = 96
# Pieces up to this share of the capacity are small: they fill gaps.
SMALL = 1 / 3

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# -- pieces ----------------------------------------------------------------------------

def pieces(docs: DataFrame, capacity: int = CAPACITY, text: str = "text", id: str = "doc_id",
           tokenizer: str = TOKENIZER, layout: str = "byte", end_id: int | None = END_ID,
           cache_entries: int = vocab.CACHE_ENTRIES) -> DataFrame:
    """Tokenise, and cut what is longer than ``capacity``; the first piece may be shorter.

    A null text counts as empty and is the end id alone. Nothing is shuffled.
    """
    shape = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                       ("length", pa.int64()), ("ids_crc32", pa.int64())])
    kind = vocab.id_type(max(vocab.vocabulary_size(tokenizer), (end_id or 0) + 1))

    def cut(batches):
        for batch in batches:
            rows = {c: [] for c in shape.names}
            for doc, raw in zip(batch.column("doc_id").to_pylist(),
                                records.encode(batch.column("text"), tokenizer, layout, end_id,
                                                    cache_entries)):
                ids = np.frombuffer(raw, kind).astype("<u4")
                if not len(ids):
                    continue
                first = (len(ids) - 1) % capacity + 1
                ends = range(first, len(ids) + 1, capacity)
                for i, end in enumerate(ends):
                    start = end - capacity if i else 0
                    for c, v in zip(shape.names, (doc, i, start, end - start,
                                                  zlib.crc32(ids[start:end].tobytes()))):
                        rows[c].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=shape)

    picked = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return picked.mapInArrow(cut, PIECES)


# -- the plan, on counts ---------------------------------------------------------------

def group(counts: np.ndarray, small: int, groups: int) -> list[tuple[int, dict[int, int]]]:
    """Groups of equal cardinality of the lengths above ``small``, longest first: the size
    they are rounded up to, and the count of each actual length."""
    large = {n: int(counts[n]) for n in range(len(counts) - 1, small, -1) if counts[n]}
    if not large:
        return []
    share = -(-sum(large.values()) // groups)
    out, room = [], 0
    for n, count in large.items():
        while count:
            if room == 0:
                out.append((n, {}))
                room = share
            take = min(room, count)
            out[-1][1][n] = out[-1][1].get(n, 0) + take
            room, count = room - take, count - take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Configurations and their numbers, from the linear programme of least sequences.

    Starts with one size per configuration; each round prices a new one by an unbounded
    knapsack over the dual values and pivots it into the basis.
    """
    size, need = np.array(sizes), np.array(demand, float)
    k = len(size)
    basis = np.diag(capacity // size).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    amount = inverse @ need
    for _ in range(40 * k):
        price = inverse.sum(0)
        value, column = _knapsack(size, price, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ column
        up = step > 1e-10
        ratio = np.full(k, np.inf)
        ratio[up] = amount[up] / step[up]
        out = int(np.argmin(ratio))
        amount = amount - step * ratio[out]
        amount[out] = ratio[out]
        basis[:, out] = column
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    return [(basis[:, i].astype(int), max(0.0, float(amount[i]))) for i in range(k)]


def _knapsack(size, price, capacity: int) -> tuple[float, np.ndarray]:
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(int(size.min()), capacity + 1):
        fits = size <= c
        worth = np.where(fits, best[c - np.where(fits, size, 0)] + price, -1.0)
        i = int(np.argmax(worth))
        if worth[i] > best[c - 1]:
            best[c], chosen[c] = worth[i], i
        else:
            best[c] = best[c - 1]
    column, c = np.zeros(len(size)), capacity
    while c > 0:
        if chosen[c] < 0 or best[c] == best[c - 1]:
            c -= 1
            continue
        column[chosen[c]] += 1
        c -= int(size[chosen[c]])
    return float(best[capacity]), column


class Bins:
    """Sequences by their room left: entries of (number of sequences, content). The content
    is a chain of (length, content before)."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room = capacity, {}

    def put(self, room: int, number: int, content):
        if number:
            self.by_room.setdefault(room, []).append((number, content))

    def fill(self, length: int, number: int):
        """Best fit of equal pieces: into the smallest room that holds one, else anew."""
        while number:
            room = min((r for r in self.by_room if r >= length), default=None)
            if room is None:
                # As many to a sequence as go, so that equal pieces stay few entries.
                each = self.capacity // length
                full, rest = divmod(number, each)
                for n, count in ((each, full), (rest, 1)):
                    content = None
                    for _ in range(n):
                        content = (length, content)
                    if n:
                        self.put(self.capacity - n * length, count, content)
                return
            entries = self.by_room[room]
            have, content = entries.pop()
            if not entries:
                del self.by_room[room]
            take = min(have, number)
            if take < have:
                self.put(room, have - take, content)
            self.put(room - length, take, (length, content))
            number -= take

    def entries(self):
        for found in self.by_room.values():
            yield from found


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         small: float = SMALL) -> list[tuple[int, list[int]]]:
    """(number of sequences, lengths in them in order) that hold every piece."""
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        histogram[length] += n
    bins, limit = Bins(capacity), max(1, int(capacity * small))
    grouped = group(histogram, limit, groups)
    rest = histogram.copy()
    if grouped:
        sizes = [size for size, _ in grouped]
        chosen = configurations(sizes, [sum(a.values()) for _, a in grouped], capacity)
        for column, amount in sorted(chosen, key=lambda x: tuple(-x[0])):
            places = [sizes[g] for g in range(len(sizes)) for _ in range(column[g])]
            _substitute(bins, places, int(amount + 1e-9), rest, limit, capacity)
    for length in range(capacity, 0, -1):
        if rest[length]:
            bins.fill(length, int(rest[length]))
    out = []
    for number, content in bins.entries():
        lengths = []
        while content is not None:
            lengths.append(content[0])
            content = content[1]
        out.append((number, lengths))
    return out


def _substitute(bins: Bins, places: list[int], number: int, rest: np.ndarray, small: int, capacity: int):
    """``number`` sequences with the given places, longest first, taken from the counts in
    ``rest``; equal sequences are one entry. A place that no large piece fits stays empty."""
    while number > 0:
        chosen, room = Counter(), capacity
        for i, size in enumerate(places):
            most = room if i == len(places) - 1 else min(size, room)
            longest = next((n for n in range(most, small, -1) if rest[n] > chosen[n]), None)
            if longest is not None:
                chosen[longest] += 1
                room -= longest
        if not chosen:
            return
        take = min(number, *(int(rest[a]) // n for a, n in chosen.items()))
        content = None
        for length, n in chosen.items():
            for _ in range(n):
                content = (length, content)
            rest[length] -= n * take
        bins.put(room, take, content)
        number -= take


# -- placing the pieces ----------------------------------------------------------------

SLOTS = "length long, first long, number long, sequence long, offset long"


def slots(entries: list[tuple[int, list[int]]]) -> list[tuple]:
    """Runs of places: the pieces of ``length`` numbered from ``first`` on go, one each, to
    ``number`` sequences from ``sequence`` on, at ``offset``."""
    used, out, sequence = {}, [], 0
    for number, lengths in entries:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            out.append((length, first, number, sequence, offset))
            used[length] = first + number
            offset += length
        sequence += number
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL) -> DataFrame:
    """Give every piece its ``sequence_id`` and ``offset`` (gapless from 0).

    Only the counts of the at most ``capacity`` lengths reach the driver, and what comes
    back is a table of runs bounded by lengths and groups alone. Pieces are numbered within
    their length by a distributed sort, so a length that holds a third of all pieces is no
    single task. Repeated rows are separate pieces; an empty table stays empty.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in
              cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = slots(plan(counts, capacity, groups, small))
    numbered = ordered.positions(cut, ["length"], ["doc_id", "piece"], "_rank")
    by_length = (spark.createDataFrame(runs, SLOTS).groupBy("length")
                 .agg(F.sort_array(F.collect_list(F.struct("first", "number", "sequence", "offset"))).alias("_runs")))
    placed = attach_bounded(numbered, by_length, ["length"])
    # The run that holds a rank is the last that begins at or before it.
    at = F.aggregate("_runs", F.lit(None).cast("struct<first:long,number:long,sequence:long,offset:long>"),
                     lambda kept, run: F.when(run["first"] <= F.col("_rank"), run).otherwise(kept))
    return (placed.withColumn("_run", at)
            .withColumn("sequence_id", F.col("_run.sequence") + F.col("_rank") - F.col("_run.first"))
            .withColumn("offset", F.col("_run.offset"))
            .select(*cut.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces of all documents with their places."""
    return pack(stored(pieces(docs, capacity, **options), "pieces"), capacity)
