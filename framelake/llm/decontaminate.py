"""Benchmark passages in training text.

The windows of all benchmark items (runs of ten normalised words, or a whole shorter item)
form a hash set that is broadcast to the scan of the documents. Hash hits are verified
word by word. The benchmark's size is checked: beyond ``BLOCK_WINDOWS`` windows the set is
cut into blocks of that size, and the documents are scanned once for each.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import vocab, words, workers

WINDOW = 10
# Windows broadcast at once: about 100 bytes each.
BLOCK_WINDOWS = 500_000
_BITS = 20

ITEM_WINDOWS = "n int, hash long, text binary, items array<string>"


def windows_of_items(items: DataFrame, id: str = "item_id", text: str = "text",
                     n: int = WINDOW) -> DataFrame:
    """Distinct windows: number of words, hash, normalised text, and the ids (as strings) of
    the items they occur in. Items without words or without an id have none."""
    def cut(batches):
        for batch in batches:
            found = words.words_of(batch.column("t"), words.LETTERS_DIGITS)
            rows = {"n": [], "hash": [], "text": [], "item": []}
            for i, item in enumerate(batch.column("i").to_pylist()):
                a, b = found.first[i], found.first[i + 1]
                size = min(n, b - a)
                if size == 0:
                    continue
                tokens = [found.folded(k) for k in range(a, b)]
                for k in range(b - a - size + 1):
                    rows["n"].append(int(size))
                    rows["hash"].append(int(words.join_hash(found.hash[a + k:a + k + size]).view(np.int64)))
                    rows["text"].append(b" ".join(tokens[k:k + size]))
                    rows["item"].append(item)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("n", pa.int32()), ("hash", pa.int64()), ("text", pa.binary()), ("item", pa.string())]))

    picked = items.select(F.col(f"`{id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))
    rows = picked.filter(F.col("i").isNotNull()).mapInArrow(cut, "n int, hash long, text binary, item string")
    return rows.groupBy("n", "hash", "text").agg(F.sort_array(F.collect_set("item")).alias("items"))


class Lookup:
    """Hash set of windows for one scan."""

    def __init__(self, rows):
        self.by_size = {}
        for row in rows:
            same = self.by_size.setdefault(row["n"], {}).setdefault(row["hash"], {})
            same[bytes(row["text"])] = list(row["items"])
        self.tables = {}
        for n, found in self.by_size.items():
            hashes = np.sort(np.fromiter(found, np.int64, len(found))).view(np.uint64)
            # A bitmap over the low bits answers for nearly all windows of a document.
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[hashes & np.uint64((1 << _BITS) - 1)] = True
            self.tables[n] = bitmap

    def hits(self, found: words.Words):
        """(word, number of words, items) of every occurrence of a window."""
        for n, bitmap in self.tables.items():
            hashes, whole = words.sequences(found, n)
            known = self.by_size[n]
            for at in np.flatnonzero(bitmap[hashes & np.uint64((1 << _BITS) - 1)] & whole):
                same = known.get(int(hashes[at].view(np.int64)))
                if same is None:
                    continue
                items = same.get(b" ".join(found.folded(k) for k in range(at, at + n)))
                if items is not None:
                    yield int(at), n, items


@workers.kept_for("decontamination", 2)
def _lookup(handed: bytes) -> Lookup:
    return Lookup(pickle.loads(handed))


SCANNED = "n_words long, hits array<int>, items array<string>, starts array<int>, ends array<int>"


def _scan_batch(texts: pa.Array, lookup: Lookup) -> pa.Array:
    """Per text: number of words, places of the hit words, items, and byte ranges of runs of
    hit words."""
    shape = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())),
                       ("items", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())),
                       ("ends", pa.list_(pa.int32()))])
    parts = []
    for start, stop in vocab.byte_blocks(texts):
        block = texts[start:stop]
        found = words.words_of(block, words.LETTERS_DIGITS)
        hit, items = np.zeros(len(found.hash), bool), {}
        for at, n, names in lookup.hits(found):
            hit[at:at + n] = True
            items.setdefault(int(found.text[at]), set()).update(names)
        _, bounds = words.text_bytes(block)
        rows = []
        for i in range(len(block)):
            a, b = int(found.first[i]), int(found.first[i + 1])
            row = {"n_words": b - a, "hits": [], "items": [], "starts": [], "ends": []}
            if i in items:
                places = np.flatnonzero(hit[a:b])
                breaks = np.flatnonzero(np.diff(places) > 1)
                heads, tails = places[np.r_[0, breaks + 1]], places[np.r_[breaks, len(places) - 1]]
                row |= {"hits": places, "items": sorted(items[i]),
                        "starts": found.start[a + heads] - bounds[i], "ends": found.end[a + tails] - bounds[i]}
            rows.append(row)
        parts.append(pa.array(rows, shape))
    return pa.concat_arrays(parts) if parts else pa.array([], shape)


def scan(docs: DataFrame, items: DataFrame, text: str = "text", into: str = "found",
         item_id: str = "item_id", item_text: str = "text", n: int = WINDOW,
         block: int = BLOCK_WINDOWS) -> DataFrame:
    """Add the struct ``into``: number of words, places of hit words, sorted ids of items
    with occurring windows, and UTF-8 byte ranges of the runs of hit words.

    A word is hit if it lies inside any occurrence of a window. Null and wordless texts have
    no words and no hits, and an empty benchmark hits nothing. Other columns are kept; one
    of the name ``into`` is replaced. One row out per row in; documents never shuffle.
    """
    from framelake.session import stored

    spark = docs.sparkSession
    table = stored(windows_of_items(items, item_id, item_text, n), "windows")
    blocks = max(1, -(-table.count() // block))
    columns = []
    for b in range(blocks):
        # At most ``block`` rows or so reach the driver at once.
        part = table.filter(F.pmod(F.xxhash64("n", "hash", "text"), F.lit(blocks)) == b)
        handed = spark.sparkContext.broadcast(pickle.dumps([r.asDict() for r in part.collect()]))
        columns.append(_finder(handed)(F.col(f"`{text}`")))
    if blocks == 1:
        return docs.withColumn(into, columns[0])
    names = [f"_b{b}" for b in range(blocks)]
    for name, column in zip(names, columns):
        docs = docs.withColumn(name, column)
    return docs.withColumn(into, _merged(names, text)).drop(*names)


def _finder(handed):
    def find(texts: pa.Array) -> pa.Array:
        workers.begin("decontamination")
        return _scan_batch(texts, _lookup(handed.value))

    return F.arrow_udf(find, f"struct<{SCANNED.replace(' ', ':').replace(',:', ',')}>")


def _merged(names: list[str], text: str):
    """Union of what several blocks found; byte ranges may then overlap."""
    def union(part):
        return F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{b}.{part}") for b in names]))))

    def chain(part):
        return F.flatten(F.array(*[F.col(f"{b}.{part}") for b in names]))

    return F.struct(F.col(f"{names[0]}.n_words").alias("n_words"), union("hits").alias("hits"),
                    union("items").alias("items"), chain("starts").alias("starts"),
                    chain("ends").alias("ends"))


def digest(found: str = "found"):
    """Columns ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    items = F.col(f"{found}.items")
    return [F.col(f"{found}.n_words").alias("n_words"),
            F.size(f"{found}.hits").cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
            (F.size(f"{found}.hits") > 0).alias("contaminated")]


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without any hit, with their columns as they were."""
    mark = words.free_name(docs.columns, "_contamination")
    found = scan(docs, items, text, mark, **options)
    return found.filter(F.size(f"{mark}.hits") == 0).drop(mark)


def cut_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents with the runs of hit words taken out of ``text``; none is dropped."""
    mark = words.free_name(docs.columns, "_contamination")

    def clean(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        parts = []
        for begin, stop in vocab.byte_blocks(texts):
            out, block = [], slice(begin, stop)
            for t, ss, es in zip(texts[block].to_pylist(), starts[block].to_pylist(), ends[block].to_pylist()):
                if t and ss:
                    raw, kept, at = t.encode(), [], 0
                    for s, e in sorted(zip(ss, es)):
                        kept.append(raw[at:max(at, s)])
                        at = max(at, e)
                    t = (b"".join(kept) + raw[at:]).decode()
                out.append(t)
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    found = scan(docs, items, text, mark, **options)
    cut = F.arrow_udf(clean, "string")
    return found.withColumn(text, cut(F.col(f"`{text}`"), F.col(f"{mark}.starts"), F.col(f"{mark}.ends"))).drop(mark)
