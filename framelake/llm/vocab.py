"""Encoders of public vocabularies, one per Python worker, with a cache of words.

Running text repeats its words, and the tokenizers here never merge across the start
of a word. A text is therefore cut at those safe boundaries, each distinct piece is
encoded once by the library, and the results are joined: the ids are the library's own
for the whole text. ``tests/llm/test_vocab.py`` holds this against encoding whole texts.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa

from framelake.llm import workers

# Bytes of text encoded together, and entries a worker keeps.
BLOCK_BYTES = 1 << 20
CACHE_ENTRIES = 1_000_000
# Longer pieces are not worth keeping.
CACHE_CHARS = 48

# In a byte-level vocabulary no token spans the change from other text to a space or
# line feed, whatever follows.
_BEFORE_SPACE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# Characters of which the library's lower case is not surely that of Python; a text with a
# special string must not gain one either.
_UNUSUAL = re.compile("[^\x00-\u012f\u0131-\u024f]")
_MARKED = re.compile(r"\n[^ \n]*| *[^ \n]+| +")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_AFTER_TEXT = re.compile(r"(?<=\S)(?=[ \n])")


def byte_level_pieces(text: str) -> list[str]:
    """Pieces of white space followed by other characters."""
    if _OTHER_SPACE.search(text):
        return _AFTER_TEXT.split(text)
    return _BEFORE_SPACE.findall(text)


def word_pieces(text: str) -> list[str]:
    """Pieces between spaces, for vocabularies that drop white space and capitals."""
    if "<" not in text and not _UNUSUAL.search(text):
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def marked_pieces(text: str) -> list[str]:
    """Pieces for vocabularies that put a mark in place of each space and one in front of
    the text: what follows a mark, up to the next mark after other text.

    A piece that begins with a line feed stood there without a mark before it.
    """
    if not text:
        return []
    text = text.replace("▁", " ")  # the mark itself
    if text[0] == " " or "  " in text:
        return [p if p[0] == "\n" else p[1:] for p in _MARKED.findall(" " + text)]
    return text.replace("\n", " \n").split(" ")


class Cached:
    """Values of pieces, computed by ``encode`` in batches of the missing ones."""

    def __init__(self, encode, split, entries: int = CACHE_ENTRIES, tails: str = "", vocabulary: int = 0):
        self.encode, self.split, self.entries, self.known, self.tails = encode, split, entries, {}, tails
        self.vocabulary = vocabulary

    def each(self, texts: list[str]):
        """For each text the values of its pieces."""
        known = self.known
        if len(known) > self.entries:
            known.clear()
        split = [self.split(t) for t in texts]
        missing = list(set().union(*split).difference(known)) if split else []
        # A letter and a tail that is always a token of its own are looked up in two parts. Only
        # after a plain letter: normalising takes others apart, and the tail may join what is left.
        cut = [p for p in missing if p[-1:] in self.tails and p[-2:-1].isalpha() and p[-2:-1].isascii()] if self.tails else []
        whole = missing
        if cut:
            whole = set(missing).difference(cut)
            whole.update({p[:-1] for p in cut}.difference(known), set(self.tails).difference(known))
            whole = list(whole)
        if whole:
            known.update(zip(whole, self.encode(whole)))
        for p in cut:
            known[p] = known[p[:-1]] + known[p[-1]]
        for pieces in split:
            yield map(known.__getitem__, pieces)
        for pieces in (missing, whole):
            for piece in pieces:
                if len(piece) > CACHE_CHARS:
                    known.pop(piece, None)


def _library(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name)


# Words encoded in one text. In a vocabulary of words the last token of each carries the end
# mark; at the byte level the first begins with the space, written as the sign below.
TOGETHER = 500
# Letters of Latin scripts count as plain, but for the one that lower-casing takes apart; at the byte
# level so does all printable text without a sign that could begin a special string.
_EDGES = {
    "word": (re.compile("[a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u024f]+"), " ", lambda token: token.endswith("</w>")),
    "byte": (re.compile(" [!-;=-~\u00c0-\u012f\u0131-\u024f]+"), "", lambda token: token.startswith("Ġ")),
}


@workers.kept_for("tokens", 4)
def ids_of(path: str, layout: str, entries: int = CACHE_ENTRIES) -> Cached:
    """Id bytes of a ``tokenizers`` file; ``layout`` is how it treats spaces (``word`` or
    ``byte``). Ids are little-endian, of ``id_type`` width. A worker keeps ``entries`` pieces,
    about 150 bytes each."""
    library = _library(path)
    kind = id_type(library.get_vocab_size())
    plain, edge, marks = _EDGES[layout]
    is_edge = np.zeros(library.get_vocab_size(), bool)
    is_edge[[i for token, i in library.get_vocab().items() if marks(token)]] = True

    def one_by_one(pieces):
        found = library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(e.ids, kind).tobytes() for e in found]

    def together(pieces):
        # Plain words in one text, which the library takes much faster: each has exactly one
        # token that ends it, or begins it.
        ids = np.array(library.encode_batch_fast([edge.join(pieces)], add_special_tokens=False)[0].ids, kind)
        at = np.flatnonzero(is_edge[ids])
        if len(at) != len(pieces):
            return one_by_one(pieces)
        cuts = [0, *(at + 1)] if edge else [*at, len(ids)]
        raw, size = ids.tobytes(), kind.itemsize
        return [raw[a * size:b * size] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(pieces):
        simple = [p for p in pieces if plain.fullmatch(p)]
        known = {}
        for start in range(0, len(simple), TOGETHER):
            part = simple[start:start + TOGETHER]
            known.update(zip(part, together(part)))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, one_by_one(rest)))
        return [known[p] for p in pieces]

    # A full stop or comma between a plain letter and white space is a token of its own.
    return Cached(encode, {"word": word_pieces, "byte": byte_level_pieces}[layout], entries, ".,",
                  library.get_vocab_size())


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


@functools.lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    return _library(path).get_vocab_size()


@workers.kept_for("tokens", 2)
def lengths_of(path: str) -> Cached:
    """Token counts of a ``sentencepiece`` model whose pieces hold word marks only in front
    and never a line feed; other models are refused."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁") or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses the start of a word")

    def encode(pieces):
        # The library puts a mark before each piece. It stands for the space before it,
        # and is one too many before a line feed, where it stays a token of its own. An
        # empty piece is a mark by itself.
        found = model.encode(pieces, num_threads=1)
        return [(len(ids) - (p[0] == "\n")) if p else 1 for p, ids in zip(pieces, found)]

    return Cached(encode, marked_pieces)


def byte_blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """Ranges of rows of about ``limit`` bytes of text each; a longer text stands alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, stop
        start = stop


def windows(text: str, limit: int = BLOCK_BYTES):
    """Parts of a long text, each ending before a single space between words, or the whole
    where there is none. White space runs are never cut."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start() + 1]
        start = cut.start() + 1
    yield text[start:]


# A space between two words; the cut comes before it.
_CUT = re.compile(r"\S (?=\S)")
