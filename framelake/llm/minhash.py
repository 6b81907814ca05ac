"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its word shingles. Documents with equal sets form one class from
the start. For one representative of each class, two collections of ``SIDE`` small hashes
are computed, each of ``ROWS`` min-hashes; a table is a pair of one hash of either
collection, so 2 * SIDE * ROWS min-hashes give SIDE * SIDE tables whose keys combine
2 * ROWS of them. Two documents share a table exactly if they agree in some hash of either
collection, so a hash that no other document has is dropped before any pair is formed.

Tables give candidates; links are confirmed on the full sets, without ever writing down all
pairs of a group:

* large groups are settled first: each document is compared with one or two others that share a
  single small hash with it, and a hash all of whose documents are connected then forms no
  tables;
* each key names one pivot, the document with the most collisions, and everything in it is
  compared with the pivot;
* keys whose documents are then still in several components join their documents into
  groups, and there each document is compared, in numpy, with all of other components. A
  large group is cut into blocks, and each pair of blocks is one task.

All steps give edges that connect what is linked; components are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import vocab, words, workers
from framelake.llm.components import components
from framelake.operators.joins import attach
from framelake.session import discard, stored

WORDS = 5
SIMILARITY = (75, 100)
SIDE, ROWS = 20, 3
# Text turned into shingles at once.
BLOCK_BYTES = 1 << 20
# Documents of a group compared in one task with those of another block.
BLOCK = 1500

_FACTORS = np.random.default_rng(17).integers(0, 1 << 32, (2, SIDE, ROWS), np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = np.random.default_rng(18).integers(0, 1 << 32, (2, SIDE, ROWS), np.uint64).astype(np.uint32)


# -- shingles --------------------------------------------------------------------------

def shingle_sets(texts: pa.Array, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, ascending, and where each text's begin.

    A text of fewer than ``n`` words has its whole sequence as one shingle; null or wordless
    texts have none.
    """
    found = words.words_of(texts, words.NOT_SPACE)
    hashes, whole = words.sequences(found, n)
    text = found.text[:len(hashes)][whole]
    hashes = hashes[whole]
    lengths = np.diff(found.first)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if len(short):
        extra = np.array([words.join_hash(found.hash[found.first[i]:found.first[i + 1]]) for i in short], np.uint64)
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, extra])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    text, hashes = text[fresh], hashes[fresh]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint (texts x 2) and small hashes (texts x 2 * SIDE) of each set."""
    n = len(first) - 1
    marks, small = np.zeros((n, 2), np.int64), np.zeros((n, 2 * SIDE), np.int64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return marks, small
    heads = first[full]
    for i, salt in enumerate((np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))):
        marks[full, i] = np.add.reduceat(words.mix(hashes ^ salt), heads).view(np.int64)
    narrow = (hashes >> np.uint64(32)).astype(np.uint32)
    for side in range(2):
        for k in range(SIDE):
            joined = np.full(len(full), side * SIDE + k, np.uint64)
            for r in range(ROWS):
                least = np.minimum.reduceat(narrow * _FACTORS[side, k, r] + _SHIFTS[side, k, r], heads)
                joined = words.mix(joined * np.uint64(0x9E3779B97F4A7C15) + least)
            small[full, side * SIDE + k] = joined.view(np.int64)
    return marks, small


def _sign(docs: DataFrame, n: int) -> DataFrame:
    def sign(batches):
        shape = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()),
                           ("f2", pa.int64()), ("small", pa.list_(pa.int64()))])
        workers.begin("minhash")
        for batch in batches:
            texts = batch.column("text")
            for start, stop in vocab.byte_blocks(texts, BLOCK_BYTES):
                hashes, first = shingle_sets(texts[start:stop], n)
                marks, small = signatures(hashes, first)
                ends = np.arange(0, small.size + 1, small.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[start:stop], pa.array(np.diff(first).astype(np.int64)),
                     pa.array(marks[:, 0]), pa.array(marks[:, 1]),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(small.reshape(-1)))], schema=shape)

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, f1 long, f2 long, small array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def sets(batches):
        shape = pa.schema([("doc_id", pa.int64()), ("shingles", pa.list_(pa.int64()))])
        workers.begin("minhash")
        for batch in batches:
            texts = batch.column("text")
            for start, stop in vocab.byte_blocks(texts, BLOCK_BYTES):
                hashes, first = shingle_sets(texts[start:stop], n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[start:stop],
                     pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64)))],
                    schema=shape)

    return docs.mapInArrow(sets, "doc_id long, shingles array<long>")


# -- candidates ------------------------------------------------------------------------

def shared_hashes(classes: DataFrame) -> DataFrame:
    """``rep``, ``slot``, ``h`` of the small hashes that occur more than once, with how often
    (``n``) and in which document first (``anchor``). ``classes`` has ``rep`` and ``small``."""
    hashes = classes.select("rep", F.posexplode("small").alias("slot", "h"))
    # Stored before the join, so that Spark can split a hash that very many documents have.
    repeated = stored(hashes.groupBy("slot", "h").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("anchor"))
                      .filter("n > 1"), "repeated")
    return hashes.join(repeated, ["slot", "h"])


def first_pairs(shared: DataFrame) -> DataFrame:
    """One or two pairs for each document: with the least document that shares a hash with it, and
    with the first document of its most frequent hash. ``a`` < ``b``."""
    others = shared.filter("rep <> anchor")
    each = others.groupBy("rep").agg(F.min("anchor").alias("least"), F.max(F.struct(
        "n", (-F.col("anchor")).alias("first"))).alias("top"))
    pairs = each.select("rep", F.explode(F.array_distinct(F.array("least", -F.col("top.first")))).alias("other"))
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def unsettled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The hashes whose documents are in more than one component. Documents that share a table
    and are not connected yet share such hashes on both sides, so no candidate is lost."""
    known = shared.join(labels, F.col("rep") == F.col("node"), "left").select(
        "rep", "slot", "h", "n", F.coalesce("component", "rep").alias("label"))
    mixed = known.groupBy("slot", "h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    return shared.join(stored(mixed.select("slot", "h"), "unsettled"), ["slot", "h"])


def tables(shared: DataFrame) -> DataFrame:
    """``key``, ``rep`` and ``weight`` of every table entry that can hold a second document.

    A document must have shared hashes in both collections; ``weight`` sums how often they occur.
    """
    # At most 2 * SIDE entries for a document.
    each = shared.groupBy("rep").agg(F.collect_list(F.struct("slot", "h")).alias("all"), F.sum("n").alias("weight"))
    left = F.filter("all", lambda x: x["slot"] < SIDE)
    right = F.filter("all", lambda x: x["slot"] >= SIDE)
    pairs = (each.select("rep", "weight", F.explode(left).alias("u"), right.alias("right"))
             .select("rep", "weight", "u", F.explode("right").alias("v")))
    return pairs.select(F.xxhash64("u", "v").alias("key"), "rep", "weight")


def stars(entries: DataFrame) -> DataFrame:
    """Each document with the pivots of its keys: ``a`` and ``b``, distinct, a < b."""
    pivots = (entries.groupBy("key").agg(F.max(F.struct("weight", F.col("rep"))).alias("top"),
                                         F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("key", F.col("top.rep").alias("pivot")))
    met = entries.join(stored(pivots, "pivots"), "key").filter("rep <> pivot")
    return met.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def confirm(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    least, of = similarity
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(of * common >= least * (F.size("x") + F.size("y") - common)).select("a", "b")


# -- groups that the pivots left in several components ---------------------------------

def mixed_groups(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """``rep``, ``label`` and ``grp`` of the documents of keys in several components."""
    known = entries.select("key", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("label"))
    mixed = (known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                      F.min("rep").alias("anchor"))
             .filter("lo <> hi").select("key", "anchor"))
    members = stored(known.join(stored(mixed, "mixed"), "key").select("rep", "label", "anchor").distinct(), "members")
    found = components(members.select(F.col("rep").alias("a"), F.col("anchor").alias("b")))
    return (members.select("rep", "label").distinct()
            .join(found.select(F.col("node").alias("rep"), F.col("component").alias("grp")), "rep"))


def link_blocks(ids, labels, sets, side, similarity) -> list[tuple[int, int]]:
    """Edges that connect the similar documents of two blocks (``side`` 0 and 1, or one block
    with itself where all are 0). Documents already connected are not compared."""
    least, of = similarity
    names, label = np.unique(np.asarray(labels), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    side = np.asarray(side)
    second = np.flatnonzero(side == side.max())
    # Shingles of the second block by number, so that a set is a mark on numbers.
    numbers, flat = np.unique(np.concatenate([sets[i] for i in second]), return_inverse=True)
    ends = np.cumsum(sizes[second])
    starts, marked = ends - sizes[second], np.zeros(len(numbers), bool)
    out = []
    for i in np.flatnonzero(side == 0):
        want = label[second] != label[i]
        if side.max() == 0:
            want &= second > i
        small, large = np.minimum(sizes[second], sizes[i]), np.maximum(sizes[second], sizes[i])
        want &= of * small >= least * large
        if not want.any():
            continue
        at = np.minimum(np.searchsorted(numbers, sets[i]), len(numbers) - 1)
        at = at[numbers[at] == sets[i]]
        marked[at] = True
        if want.mean() > 0.2:
            common = np.add.reduceat(marked[flat], starts, dtype=np.int64)
        else:
            common = np.zeros(len(second), np.int64)
            for k in np.flatnonzero(want):
                common[k] = np.count_nonzero(marked[flat[starts[k]:ends[k]]])
        marked[at] = False
        for k in np.flatnonzero(want & (of * common >= least * (sizes[second] + sizes[i] - common))):
            j = second[k]
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def group_links(groups: DataFrame, sets: DataFrame, similarity: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """Edges within the groups, by pairs of blocks of about ``block`` documents."""
    sized = groups.join(stored(groups.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "sizes"), "grp")
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = sized.select("rep", "label", "grp", blocks.alias("blocks"),
                          F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("own"))
    with_sets = placed.join(sets.select(F.col("doc_id").alias("rep"), "shingles"), "rep")
    # A document goes to the pairs its block is the first or the second of.
    paired = with_sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "label", "shingles")

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        sets = [np.sort(s.values.to_numpy().view(np.uint64)) for s in table["shingles"]]
        found = link_blocks(table["rep"].to_numpy(), table["label"].to_numpy(), sets,
                            table["side"].to_numpy(), similarity)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    return paired.groupBy("grp", "p", "q").applyInArrow(link, "a long, b long")


# -- the whole -------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", n: int = WORDS,
                    similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and
    ``kept`` (that id is its own), for each document.

    Documents link if their shingle sets reach the similarity (hundredths of the union).
    Null, empty and wordless texts link with nothing; equal texts always link. A document
    whose id is null links with nothing either, and is kept. Rows that share an id are one
    document if their sets are equal; if not, they are joined by their id.
    """
    picked = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = stored(_sign(picked, n), "signatures")
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    grouped = usable.groupBy("f1", "f2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("small").alias("small"))
    classes = stored(grouped, "classes")
    shared = stored(shared_hashes(classes), "shared")
    members = shared.select("rep").distinct().select(F.col("rep").alias("doc_id"), F.lit(True).alias("_in"))
    wanted = attach(picked.filter("doc_id IS NOT NULL"), stored(members, "wanted"), ["doc_id"], "inner")
    sets = stored(_sets(wanted.select("doc_id", "text"), n).filter(F.size("shingles") > 0), "sets")
    # Large groups are settled on single hashes, before tables are formed of what is open.
    early = stored(confirm(stored(first_pairs(shared), "first"), sets, similarity), "early")
    settled = stored(components(early), "settled")
    entries = stored(tables(unsettled(shared, settled)), "tables")
    discard(shared, settled)
    pairs = stored(stars(entries), "stars")
    links = stored(confirm(pairs, sets, similarity), "links").union(early)
    labels = stored(components(links), "labels")
    groups = stored(mixed_groups(entries, labels), "groups")
    discard(entries, pairs, labels)
    more = stored(group_links(groups, sets, similarity), "more")
    discard(groups, sets)
    found = stored(components(links.union(more)), "found")
    discard(more)
    by_class = (classes.join(found, F.col("rep") == F.col("node"), "left")
                .select("f1", "f2", "n_shingles", F.coalesce("component", "rep").alias("component_id")))
    out = signed.join(by_class, ["f1", "f2", "n_shingles"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("_found"))
    component = F.coalesce("_found", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
