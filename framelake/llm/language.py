"""Language of a text by the nearest of several centroids per language.

A text becomes a TF-IDF vector of its letter bigrams and trigrams (case folded, everything
that is no letter is a word boundary), hashed into ``DIMENSIONS`` places and scaled to
length one. Each language has a few centroids, found by clustering the vectors of a bounded
sample of labelled texts. The prediction is the language of the centroid with the highest
cosine. A text farther from every centroid than texts of its size usually are is rejected.
"""

from __future__ import annotations

import dataclasses
import functools
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm import vocab, workers
from framelake.session import stored

DIMENSIONS = 8192
# Labelled texts learned from, for each language: about this many, evenly over all.
PER_LANGUAGE = 400
CENTROIDS = 4
# Rejection: below this share of the cosine that 99 of 100 training texts of the size reach.
SLACK = 0.45
UNKNOWN = "und"
# Texts turned into dense vectors together.
_ROWS = 128

_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_SHIFT = np.uint32(32 - DIMENSIONS.bit_length() + 1)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x30000)])


def grams(text: str) -> tuple[np.ndarray, int]:
    """Hashed places of all bigrams and trigrams, and the number of letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    table = _letters()
    letter = table[np.minimum(points, len(table) - 1)]
    n = int(np.count_nonzero(letter))
    if n == 0:
        return np.zeros(0, np.int64), 0
    # One boundary after each word, and one in front.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    line = np.concatenate([[np.uint32(32)], np.where(letter, points, np.uint32(32))[kept],
                           [np.uint32(32)]]).astype(np.uint32)
    a, b = line[:-1] * _A, line[1:] * _B
    two = (a + b) ^ (b >> np.uint32(15))
    three = (two[:-1] * _C) ^ (line[2:] * _A)
    three ^= three >> np.uint32(13)
    return np.concatenate([(two * _B) >> _SHIFT, (three * _C) >> _SHIFT]).astype(np.int64), n


def counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Count vectors (texts x dimensions) and letters of each text."""
    found = [grams(t) for t in texts]
    rows = np.repeat(np.arange(len(texts)), [len(g) for g, _ in found])
    places = rows * DIMENSIONS + np.concatenate([g for g, _ in found])
    dense = np.bincount(places, minlength=len(texts) * DIMENSIONS).reshape(len(texts), DIMENSIONS)
    return dense, np.array([n for _, n in found])


def weighted(dense: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.log1p(dense.astype(np.float32)) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


@dataclasses.dataclass
class Model:
    languages: list[str]          # of each centroid
    centroids: np.ndarray         # centroids x dimensions, of length one
    idf: np.ndarray
    limits: np.ndarray            # least cosine by the power of two of the size

    def predict(self, texts: list[str]):
        """(language, score, rejected) of each text."""
        for start in range(0, len(texts), _ROWS):
            part = texts[start:start + _ROWS]
            dense, letters = counts(part)
            if not self.languages:
                yield from ((UNKNOWN, 0.0, True) for _ in part)
                continue
            near = weighted(dense, self.idf) @ self.centroids.T
            best = near.argmax(1)
            sizes = _sizes(letters)
            for i, k in enumerate(best):
                if letters[i] == 0:
                    yield UNKNOWN, 0.0, True
                else:
                    score = float(min(1.0, max(0.0, near[i, k])))
                    yield self.languages[k], score, bool(score < self.limits[sizes[i]])


def _sizes(letters: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(letters, 1)).astype(int), 0, 31)


def cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means. Starts from the row nearest the mean and adds, each time, the row
    farthest from all chosen; clusters of under a fiftieth of the rows are dropped."""
    mean = rows.mean(0)
    chosen = [int((rows @ mean).argmax())]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        far = int(nearest.argmin())
        chosen.append(far)
        nearest = np.maximum(nearest, rows @ rows[far])
    centres = rows[chosen]
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(1)
        sums = np.array([rows[own == i].sum(0) for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    sizes = np.bincount((rows @ centres.T).argmax(1), minlength=len(centres))
    kept = sizes >= max(1, len(rows) / 50)
    return centres[kept] if kept.any() else centres[sizes.argmax():][:1]


def fit(labels: list[str], dense: np.ndarray, letters: np.ndarray, k: int = CENTROIDS,
        slack: float = SLACK) -> Model:
    """Model of labelled count vectors.

    Labels may be wrong: rows nearer to the mean of another language than to that of their
    own are left out before clustering, else they would form centroids of their own.
    """
    usable = letters > 0
    names = sorted(set(np.array(labels, object)[usable])) if len(labels) else []
    if not names:
        return Model([], np.zeros((0, DIMENSIONS), np.float32), np.ones(DIMENSIONS, np.float32), np.zeros(32))
    dense, letters = dense[usable], letters[usable]
    own = np.array([names.index(x) for x in np.array(labels, object)[usable]])
    idf = (np.log((1 + len(own)) / (1 + (dense > 0).sum(0))) + 1).astype(np.float32)
    rows = weighted(dense, idf)
    kept = np.ones(len(own), bool)
    for _ in range(3):
        means = np.array([rows[kept & (own == i)].sum(0) for i in range(len(names))])
        means /= np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
        agrees = (rows @ means.T).argmax(1) == own
        # A language none of whose rows agree keeps them all.
        kept = agrees | ~np.isin(own, own[agrees])
    languages, centroids = [], []
    for i, name in enumerate(names):
        found = cluster(rows[kept & (own == i)], k)
        languages += [name] * len(found)
        centroids.append(found)
    centroids = np.concatenate(centroids).astype(np.float32)
    reached = (rows[kept] @ centroids.T).max(1)
    sizes = _sizes(letters[kept])
    limits, last = np.zeros(32), 0.0
    for size in range(32):
        # Short texts are far from any centroid; sizes not seen take the limit of smaller ones.
        if (sizes == size).any():
            last = slack * float(np.quantile(reached[sizes == size], 0.01))
        limits[size] = last
    return Model(languages, centroids, idf, limits)


def held_out(id: Column) -> Column:
    """Rows never learned from: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
          k: int = CENTROIDS, slack: float = SLACK) -> Model:
    """Fit on a sample of the labelled texts of ``docs``: about ``per_language`` different
    texts of each language, chosen evenly by the hash of the text, so copies count once.

    Rows without label or text are not learned from. The sample's vectors are bounded by
    ``per_language``, the number of languages and ``DIMENSIONS``, and go to the driver.
    """
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL").withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in
             rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, min(1.0, per_language / max(1, n))).otherwise(share)
    # Another hash than partitioning uses.
    sample = rows.filter(F.pmod(F.xxhash64("h", F.lit(7)), F.lit(1 << 20)) < share * (1 << 20))
    sample = sample.groupBy("lang", "h").agg(F.first("text").alias("text"))

    def vectors(batches):
        for batch in batches:
            out = {"lang": [], "letters": [], "places": [], "numbers": []}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                dense, letters = counts([body])
                places = np.flatnonzero(dense[0])
                for c, v in zip(out, (name, int(letters[0]), places, dense[0][places])):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("lang", pa.string()), ("letters", pa.int64()), ("places", pa.list_(pa.int32())),
                ("numbers", pa.list_(pa.int32()))]))

    found = stored(sample.select("lang", "text").mapInArrow(
        vectors, "lang string, letters long, places array<int>, numbers array<int>"), "vectors")
    table = found.orderBy("lang", "letters", F.xxhash64("places", "numbers")).toArrow()
    dense = np.zeros((table.num_rows, DIMENSIONS), np.float32)
    for i, (p, n) in enumerate(zip(table["places"], table["numbers"])):
        dense[i, p.values.to_numpy()] = n.values.to_numpy()
    return fit(table["lang"].to_pylist(), dense, table["letters"].to_numpy(), k, slack)


@workers.kept_for("language", 2)
def _model(handed: bytes) -> Model:
    return pickle.loads(handed)


def predict(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """Add the struct ``into``: ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    A text that is null or has no letter is ``und`` with score 0, and rejected, as is every
    text where nothing was learned. Equal cosines go to the first language by name. Other
    columns are kept; one row out per row in, without a shuffle.
    """
    handed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    shape = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def find(texts: pa.Array) -> pa.Array:
        workers.begin("language")
        known, parts = _model(handed.value), []
        for start, stop in vocab.byte_blocks(texts):
            block = [t or "" for t in texts[start:stop].to_pylist()]
            found = list(known.predict(block))
            parts.append(pa.StructArray.from_arrays(
                [pa.array([f[i] for f in found], shape[i].type) for i in range(3)], fields=list(shape)))
        return pa.concat_arrays(parts) if parts else pa.array([], shape)

    found = F.arrow_udf(find, "struct<lang_pred:string,score:double,rejected:boolean>")
    return docs.withColumn(into, found(F.col(f"`{text}`")))


def identify(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
             into: str = "language", **options) -> DataFrame:
    """Learn from the labelled rows that are not held out, and predict all rows."""
    model = learn(docs.filter(~held_out(F.col(f"`{id}`"))), text, lang, **options)
    return predict(docs, model, text, into)
