"""Removal of byte strings that occur more than once in the corpus.

A suffix array over the whole corpus is neither needed nor possible. Most of the text occurs
once, so it is set aside first, without losing any repetition:

* every window of ``LENGTH`` bytes names an anchor, the least hash among the shorter windows
  in it. Equal windows name equal anchors, wherever they are, so a window can only repeat if
  its anchor does. Neighbouring windows with one anchor form a context;
* equal contexts repeat as a whole. What is left to decide are repeated anchors with
  differing contexts, at the ends of repeated passages.

The differing contexts of an anchor go to one shard, and a shard builds the suffix array of
its contexts by Larsson-Sadakane refinement, and common prefixes by Kasai's rule; neighbours
that share ``LENGTH`` bytes repeat. An anchor with very many contexts is spread over several
shards. Each of those writes out its distinct windows as sorted keys, cut into key ranges by
binary search, and each range is merged across shards by binary search in the keys of all. The
number of ranges follows from the number of windows, so a range does not grow with the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import vocab, words
from framelake.operators.joins import attach
from framelake.session import stored

LENGTH = 200
# Bytes of the anchor windows; they must be a power of two and fit a window four times.
ANCHOR = 32
# Contexts of an anchor beyond which it is spread, and bytes of contexts in a shard.
SPREAD = 2000
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 2 << 20
# Windows of spread anchors in a key range of the merge.
RANGE_KEYS = 1 << 20

_SEEDS = np.random.default_rng(77).integers(1, 1 << 63, 260, np.uint64) | np.uint64(1)
_BYTE, _STEP, _MIX = _SEEDS[:256], _SEEDS[256:257], _SEEDS[257]
_PLACE = np.uint64((1 << 24) - 1)


# -- contexts --------------------------------------------------------------------------

def contexts(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """Contexts of a block of texts: text, first and last window start within the text,
    hash of the anchor, hash of the context. Blocks are below 2**24 bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    # Arrays of a block are let go of, or narrowed, as soon as they can be: each takes eight times its bytes.
    hashes, width, step = _BYTE[data], 1, _STEP
    while width < 4 * ANCHOR:
        if width == ANCHOR:
            anchor = words.mix(hashes)
        wider = hashes[:-width] * step
        wider += hashes[width:]
        hashes, width, step = wider, 2 * width, step * step
    wide = hashes
    del hashes, wider
    # The least hash and, of equal ones, the last place.
    least = anchor & ~_PLACE
    least |= np.arange(int(_PLACE), int(_PLACE) - len(anchor), -1).astype(np.uint64)
    span, size = length - ANCHOR + 1, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[:size - span], least[span - size:])
    least &= _PLACE
    at = np.int32(_PLACE) - least.astype(np.int32)
    del least
    # A window may not reach into the next text.
    inside = np.ones(len(at) + 1, bool)
    inside[-1] = False
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[:len(at)]
    inside[:-1] = np.arange(length, len(at) + length, dtype=np.int32) <= bounds[1:].astype(np.int32)[text]
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | ~inside[:-2]
    first = np.flatnonzero(change & inside[:-1])
    if not len(first):
        return none, none, none, none, none
    last_of = np.ones(len(at), bool)
    last_of[:-1] = change[1:] | ~inside[1:-1]
    last = np.flatnonzero(last_of & inside[:-1])
    size = last + length - first
    mark = wide[first] * _MIX + wide[first + (size - 4 * ANCHOR) // 2]
    mark = mark * _MIX + wide[first + size - 4 * ANCHOR]
    mark = words.mix(mark * _MIX + (size * 1024 + at[first] - first).astype(np.uint64))
    text = text[first].astype(np.int64)
    return (text, first - bounds[text], last - bounds[text], anchor[at[first]].view(np.int64), mark.view(np.int64))


def _blocks(texts: pa.Array, length: int):
    """(first text, bytes, bounds, offset in the text) of blocks; a longer text comes in parts
    that overlap so that each window is in one of them."""
    for start, stop in vocab.byte_blocks(texts, BLOCK_BYTES):
        data, bounds = words.text_bytes(texts[start:stop])
        if len(data) <= 2 * BLOCK_BYTES:
            yield start, data, bounds, 0
            continue
        for at in range(0, len(data), BLOCK_BYTES):
            part = data[at:at + BLOCK_BYTES + length - 1]
            yield start, part, np.array([0, len(part)]), at


def _occurrences(keyed: DataFrame, length: int) -> DataFrame:
    def find(batches):
        for batch in batches:
            keys = batch.column("k").to_numpy()
            for start, data, bounds, at in _blocks(batch.column("text"), length):
                text, first, last, anchor, mark = contexts(data, bounds, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (anchor, mark, keys[start + text], first + at, last + at)],
                    names=["h", "c", "k", "lo", "hi"])

    return keyed.mapInArrow(find, "h long, c long, k long, lo long, hi long")


# -- suffix array ----------------------------------------------------------------------

def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of 16-bit symbols, by Larsson-Sadakane refinement: suffixes are
    sorted by four symbols, and groups not yet single are split by the rank of the suffix
    twice as far on, until every suffix has a rank of its own."""
    n = len(symbols)
    kind = _places(n)
    padded = np.concatenate([symbols, np.zeros(4, np.uint16)])
    key = padded[:n].astype(np.uint64)
    for i in range(1, 4):
        key <<= 16
        key |= padded[i:n + i]
    order = np.argsort(key, kind="stable").astype(kind)
    key = key[order]
    head = np.ones(n, bool)
    head[1:] = key[1:] != key[:-1]
    del key
    # The rank of a group is the place of its first member.
    rank = np.empty(n + 1, kind)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n, dtype=kind), 0).astype(kind, copy=False))
    rank[n] = -1
    open_ = _unsorted(head)
    far = 4
    while len(open_):
        suffix = order[open_]
        key = rank[suffix].astype(np.int64)
        key *= n + 1
        key += rank[np.minimum(suffix + far, n)]
        by_key = np.argsort(key, kind="stable").astype(kind)
        suffix, key = suffix[by_key], key[by_key]
        del by_key
        # Groups keep their places: open_ is ascending, and so is the first part of the key.
        order[open_] = suffix
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        del key
        rank[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        last = np.ones(len(open_), bool)
        last[:-1] = new[1:]
        open_ = open_[~(new & last)]
        far *= 2
    return order


def _places(n: int) -> type:
    """Type of places among ``n`` symbols, and of sums of three of them: half as wide where it can be."""
    return np.int32 if n < 1 << 29 else np.int64


def _unsorted(head: np.ndarray) -> np.ndarray:
    last = np.ones(len(head), bool)
    last[:-1] = head[1:]
    return np.flatnonzero(~(head & last)).astype(_places(len(head)))


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Symbols that each suffix in ``order`` shares with the one before it (0 for the first).

    Kasai's rule, all at once: where a suffix and its neighbour are preceded by the same
    symbol, it shares one less than the suffix one further to the front, so only the others
    are compared, four symbols at a time.
    """
    n = len(symbols)
    kind = _places(n)
    before = np.full(n, -1, kind)
    before[order[1:]] = order[:-1]
    here = np.arange(n, dtype=kind)
    derived = (here > 0) & (before > 0)
    at = np.flatnonzero(derived).astype(kind)
    derived[at] = symbols[at - 1] == symbols[before[at] - 1]
    del at
    shared = np.zeros(n, kind)
    live = np.flatnonzero(~derived & (before >= 0)).astype(kind)
    a, b = live.copy(), before[live]
    del before
    while len(live):
        same = (a < n) & (b < n)
        same[same] = symbols[a[same]] == symbols[b[same]]
        live, a, b = live[same], a[same] + 1, b[same] + 1
        shared[live] += 1
    here[derived] = 0
    base = np.maximum.accumulate(here)
    del here, derived
    shared = shared[base]
    base -= np.arange(n, dtype=kind)
    shared += base
    return np.maximum(shared, 0)[order]


# A symbol above the bytes.
SEPARATOR = 256


def repeated_windows(parts: list[np.ndarray], length: int = LENGTH):
    """For each part which of its windows occurs elsewhere in the parts, and the class of each
    window over all parts (equal windows, equal class)."""
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    symbols = np.zeros(int(sizes.sum()) + len(parts), np.uint16)
    for s, part in zip(starts, parts):
        symbols[s:s + len(part)] = part
        # A window has no separator in it, so what shares ``length`` symbols with it is a window too.
        symbols[s + len(part)] = SEPARATOR
    order = suffix_array(symbols)
    shared = common_prefixes(symbols, order)
    new = shared < length
    del shared
    classes = np.empty(len(symbols), order.dtype)
    classes[order] = np.cumsum(new, dtype=order.dtype)
    del order, new
    many = np.bincount(classes, minlength=classes.max() + 1)[classes] > 1
    return [(many[s:s + max(0, k - length + 1)], classes[s:s + max(0, k - length + 1)])
            for s, k in zip(starts, sizes)]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


# -- shards ----------------------------------------------------------------------------

def _context_bytes(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted contexts (``k``, ``lo``, ``hi``, and what is kept with them)."""
    narrow = F.struct(*[F.col(c).cast("int").alias(c) for c in ("lo", "hi", "shard")], "spread", "once")
    per_text = wanted.groupBy("k").agg(F.collect_list(narrow).alias("w"))

    def cut(batches):
        for batch in batches:
            rows = {c: [] for c in ("k", "lo", "shard", "spread", "once", "body")}
            for k, text, places in zip(*(batch.column(c) for c in ("k", "text", "w"))):
                raw = text.as_py().encode()
                for p in places.as_py():
                    for c in ("lo", "shard", "spread", "once"):
                        rows[c].append(p[c])
                    rows["k"].append(k.as_py())
                    rows["body"].append(raw[p["lo"]:p["hi"] + length])
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("k", pa.int64()), ("lo", pa.int64()), ("shard", pa.int32()), ("spread", pa.bool_()),
                ("once", pa.bool_()), ("body", pa.binary())]))

    # Rows that are equal throughout have one key; any of them has the bytes.
    found = attach(keyed, stored(per_text, "wanted"), ["k"], "inner")
    return found.select("k", "text", "w").mapInArrow(
        cut, "k long, lo long, shard int, spread boolean, once boolean, body binary").dropDuplicates(["k", "lo"])


SHARD_OUT = ("k long, starts array<long>, ends array<long>, "
             "part int, keys binary, owners binary, places binary, done binary")
_OUT = pa.schema([("k", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                  ("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()),
                  ("places", pa.binary()), ("done", pa.binary())])


def _search_shard(length: int, ranges: int):
    def search(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_search(table, length, ranges), schema=_OUT)

    return search


def _search(table: pa.Table, length: int, ranges: int) -> list[dict]:
    bodies = [np.frombuffer(b, np.uint8) for b in table["body"].to_pylist()]
    keys, lows = table["k"].to_numpy(), table["lo"].to_numpy()
    spread, once = table["spread"].to_pylist(), table["once"].to_pylist()
    rows, left = [], {"key": [], "owner": [], "place": [], "done": []}
    for i, (many, classes) in enumerate(repeated_windows(bodies, length)):
        # Contexts that occur several times are covered already and only serve as partners.
        if once[i] and many.any():
            first, last = runs(many)
            rows.append({"k": int(keys[i]), "starts": first + lows[i], "ends": last + lows[i] + length})
        if spread[i]:
            window = _window_keys(bodies[i], length)
            left["key"].append(window)
            left["owner"].append(np.full(len(window), keys[i]))
            left["place"].append(np.arange(len(window)) + lows[i])
            left["done"].append(many | (not once[i]))
    if left["key"]:
        joined = {c: np.concatenate(v) for c, v in left.items()}
        order = np.argsort(joined["key"], kind="stable")
        joined = {c: v[order] for c, v in joined.items()}
        # One entry for each distinct window; equal ones were found here already.
        head = np.ones(len(order), bool)
        head[1:] = joined["key"][1:] != joined["key"][:-1]
        joined = {c: v[head] for c, v in joined.items()}
        limits = np.array([(part << 64) // ranges for part in range(1, ranges)], np.uint64)
        cuts = [0, *np.searchsorted(joined["key"], limits), len(joined["key"])]
        for part in range(ranges):
            a, b = cuts[part], cuts[part + 1]
            if a < b:
                rows.append({"part": part, "keys": joined["key"][a:b].tobytes(),
                             "owners": joined["owner"][a:b].astype(np.int64).tobytes(),
                             "places": joined["place"][a:b].astype(np.int64).tobytes(),
                             "done": joined["done"][a:b].tobytes()})
    return rows


def _window_keys(body: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every window, from hashes of power-of-two widths that overlap."""
    hashes, width, step = _BYTE[body], 1, _STEP
    while 2 * width <= length:
        hashes = hashes[:-width] * step + hashes[width:]
        width, step = 2 * width, step * step
    count = len(body) - length + 1
    return words.mix(hashes[:count] * _MIX + hashes[length - width:][:count])


def _merge_range(length: int):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(b, np.uint64) for b in table["keys"].to_pylist()]
        every = np.sort(np.concatenate(lists))
        rows = []
        for i, own in enumerate(lists):
            # A key found more than once among all is in another shard too.
            found = np.searchsorted(every, own, "right") - np.searchsorted(every, own, "left") > 1
            found &= ~np.frombuffer(table["done"][i].as_py(), bool)
            owners = np.frombuffer(table["owners"][i].as_py(), np.int64)[found]
            places = np.frombuffer(table["places"][i].as_py(), np.int64)[found]
            order = np.argsort(owners, kind="stable")
            owners, places = owners[order], places[order]
            for mine in np.split(np.arange(len(owners)), np.flatnonzero(np.diff(owners)) + 1):
                if len(mine):
                    at = places[mine]
                    rows.append({"k": int(owners[mine[0]]), "starts": at, "ends": at + length})
        return pa.Table.from_pylist(rows, schema=pa.schema(list(_OUT)[:3]))

    return merge


def covered(keyed: DataFrame, length: int = LENGTH, spread: int = SPREAD,
            shard_bytes: int = SHARD_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """``k``, ``starts``, ``ends``: maximal byte ranges of each text (``k``, ``text``) that
    repeated windows cover, one row for each text that has any."""
    found = stored(_occurrences(keyed, length), "occurrences")
    # Aggregates are stored before they are joined, so that Spark can split a hot anchor.
    twice = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("h"), "anchors")
    again = stored(found.join(twice, "h"), "repeated")
    groups = stored(again.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "lo", "hi")).alias("at")), "contexts")
    # Equal contexts: all their windows repeat.
    whole = again.join(groups.filter("n > 1").select("h", "c"), ["h", "c"], "left_semi")
    pieces = whole.select("k", F.array("lo").alias("starts"), F.array(F.col("hi") + length).alias("ends"))
    # Anchors with differing contexts, of which some occur once.
    differing = (groups.groupBy("h").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least"))
                 .filter("contexts > 1 AND least = 1"))
    differing = stored(differing, "differing")
    open_ = groups.join(differing, "h").select(
        "h", "c", "n", "contexts", "at.*", (F.col("at.hi") - F.col("at.lo") + length).alias("size"))
    open_ = stored(open_, "open")
    # An anchor's shard, and for one with very many contexts a number of shards of its own.
    ways = F.ceil(F.col("contexts") / spread).cast("long")
    windows = F.when(ways > 1, F.col("size") - (length - 1))
    total = open_.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"), F.coalesce(F.sum(windows), F.lit(0)).alias("w")).first()
    shards = max(1, -(-total["s"] // shard_bytes))
    ranges = max(1, -(-total["w"] // range_keys))
    sub = F.when(ways > 1, F.pmod(F.xxhash64("c", "k", "lo"), ways)).otherwise(F.lit(0))
    wanted = open_.select("k", "lo", "hi", (F.col("n") == 1).alias("once"), F.pmod(F.xxhash64("h", sub), F.lit(shards)).alias("shard"),
                          (ways > 1).alias("spread"))
    bodies = _context_bytes(keyed, wanted, length)
    searched = stored(bodies.groupBy("shard").applyInArrow(_search_shard(length, ranges), SHARD_OUT), "searched")
    left = searched.filter("part IS NOT NULL")
    # As many tasks as ranges; a shuffle that is wider anyway stays as it is.
    if ranges > int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left = left.repartition(ranges, "part")
    merged = left.groupBy("part").applyInArrow(
        _merge_range(length), "k long, starts array<long>, ends array<long>")
    every = pieces.union(searched.filter("k IS NOT NULL").select("k", "starts", "ends")).union(merged)
    ranges = every.groupBy("k").agg(F.flatten(F.collect_list("starts")).alias("starts"),
                                    F.flatten(F.collect_list("ends")).alias("ends"))
    union = F.arrow_udf(_unions, "struct<starts:array<int>,ends:array<int>>")
    return ranges.select("k", union("starts", "ends").alias("u")).select("k", "u.*")


def _unions(starts: pa.Array, ends: pa.Array) -> pa.Array:
    found = [_merged(a.values.to_numpy(), b.values.to_numpy()) for a, b in zip(starts, ends)]
    kind = pa.list_(pa.int32())
    return pa.StructArray.from_arrays([pa.array([f[i].astype(np.int32) for f in found], kind) for i in (0, 1)],
                                      names=["starts", "ends"])


# -- removal ---------------------------------------------------------------------------

def _merged(starts, ends):
    """Maximal ranges of overlapping or touching ones, ascending."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    head = np.ones(len(starts), bool)
    head[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(head)
    return starts[first], ends[np.concatenate([first[1:] - 1, [len(starts) - 1]])]


def remove_repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", into: str = "repeats",
                    length: int = LENGTH, **options) -> DataFrame:
    """Add the struct ``into``: ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept`` (the remaining bytes) and ``kept_sha256``.

    Strings are judged on the texts as given, in UTF-8, and never cross texts; a null text is
    empty. Rows equal in id and text are separate occurrences, so all of both is removed if
    they are long enough. A removed run can cut a character in two, so what is kept is bytes.
    Other columns stay; one of the name ``into`` is replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(F.xxhash64(F.col(f"`{id}`").cast("string"), body).alias("k"), body.alias("text"))
    found = stored(covered(keyed, length, **options), "covered")
    shape = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                       ("kept", pa.binary()), ("kept_sha256", pa.string())])

    def cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        data, bounds = words.text_bytes(texts)
        for i in range(len(texts)):
            raw, gone, spans = data[bounds[i]:bounds[i + 1]].tobytes(), 0, 0
            kept = raw
            if starts[i].is_valid:
                a, b = starts[i].values.to_numpy(), ends[i].values.to_numpy()
                gone, spans = int((b - a).sum()), len(a)
                edges = np.concatenate([[0], np.ravel(np.column_stack([a, b])), [len(raw)]])
                kept = b"".join(raw[s:e] for s, e in zip(edges[::2], edges[1::2]))
            out.append({"n_bytes": len(raw), "n_removed": gone, "n_spans": spans, "kept": kept,
                        "kept_sha256": hashlib.sha256(kept).hexdigest()})
        return pa.array(out, shape)

    cleaner = F.arrow_udf(cut, "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary,kept_sha256:string>")
    key = F.xxhash64(F.col(f"`{id}`").cast("string"), body).alias("k")
    own = docs.select(F.struct("*").alias("_row"), body.alias("_text"), key)
    joined = attach(own, found, ["k"])
    kept = [c for c in docs.columns if c != into]
    return joined.withColumn("_out", cleaner(F.col("_text"), F.col("starts"), F.col("ends"))).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in kept], F.col("_out").alias(into))
