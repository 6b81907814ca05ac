"""Words of texts and 64-bit hashes of word sequences, for whole Arrow batches in numpy.

Words are runs of bytes of a class, so they are found and hashed without making a Python
object of any of them. Equal words have equal hashes in every process.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Words of more bytes are hashed one by one.
LONG_WORD = 64
_BYTES = np.arange(256)
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, 300, np.uint64) | np.uint64(1)
_BYTE_HASH = _SEEDS[:256][_FOLD]
_STEP, _LINK, _M1, _M2 = _SEEDS[256:260]

# Classes of word bytes. Bytes from 0x80 on belong to characters beyond ASCII.
LETTERS = (((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80))
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
LETTERS_DIGITS = (((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
                  | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80))


def free_name(columns: list[str], name: str) -> str:
    """A column name that none of the columns has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


@dataclasses.dataclass
class Words:
    """Words of a block of texts, in order: hash, text they are of, byte range in ``data``,
    and for each text where its words begin (``first``, one entry more than texts)."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray

    def folded(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes().lower()


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null as empty) and the offsets of each."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or len(bounds) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def words_of(texts: pa.Array, in_word: np.ndarray) -> Words:
    """Words of each text: maximal runs of bytes of the class ``in_word``. Hashes ignore
    the case of A-Z only."""
    data, bounds = text_bytes(texts)
    inside = in_word[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    before[heads] = False
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[heads[1:] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, bounds)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(_hash(data, start, end), text, start, end, first, data)


def _hash(data, start, end) -> np.ndarray:
    length = end - start
    out = np.zeros(len(start), np.uint64)
    live = np.flatnonzero(length <= LONG_WORD)
    at, k = start[live], 0
    while len(live):
        out[live] = out[live] * _STEP + _BYTE_HASH[data[at]]
        k += 1
        more = length[live] > k
        live, at = live[more], at[more] + 1
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes().lower())
    return mix(out + length.astype(np.uint64))


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of the given lengths that follow each other in ``data``."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Dense codes of strings, equal for equal strings and no others, and what they stand for."""
    coded = pc.dictionary_encode(values)
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def spans(texts: pa.Array, in_word: np.ndarray):
    """Bytes of the texts, where each text begins, which bytes are in words, and where each
    word begins and ends."""
    data, bounds = text_bytes(texts)
    inside = in_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    return data, bounds, inside, start, np.flatnonzero(inside & (~after | edge[1:])) + 1


def folded_terms(texts: pa.Array, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each word its text and its code, with the distinct words, A-Z lower-cased."""
    data, bounds, inside, start, end = spans(texts, in_word)
    code, distinct = codes(strings(_FOLD[data[inside]], end - start))
    return np.searchsorted(bounds, start, "right") - 1, code, distinct


def sequences(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and whether they are of one text."""
    count = max(0, len(words.hash) - n + 1)
    out = np.full(count, n, np.uint64)
    for j in range(n):
        out *= _LINK
        out += words.hash[j:j + count]
    return mix(out), words.text[:count] == words.text[n - 1:n - 1 + count]


def join_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole sequence, as ``sequences`` gives it for its length."""
    with np.errstate(over="ignore"):
        out = np.uint64(len(hashes))
        for h in hashes:
            out = out * _LINK + h
    return mix(np.array([out], np.uint64))[0]
