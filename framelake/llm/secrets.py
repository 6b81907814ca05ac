"""Secrets in text: fixed patterns, and random strings shown by token efficiency.

A string made up at random has no words in it, so a byte-pair vocabulary needs a token for
every character or two; names, words and numbers in running text take more characters per
token. A key glued to plain words by ``/``, ``=``, ``-`` or ``_`` is found by the parts between
them. Strings that are random for a known and harmless reason are left out.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm import vocab, workers

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# The kinds of spans, in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

# Random strings: length of the strings looked at, and the characters per token below
# which one is reported.
LEAST = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile(r"[A-Za-z0-9+]+")
MAX_CHARS_PER_TOKEN = 1.9
# Known digests (32, 40, 64, 96 or 128 hexadecimal digits), identifiers and plain numbers.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})",
                    re.IGNORECASE)
INTEGRITY = re.compile(r"sha(?:1|224|256|384|512)[-_=]([A-Za-z0-9+/_-]+)=*", re.IGNORECASE)
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
NUMBER = re.compile(r"[0-9_+/=-]+")
DIGEST_HINT = re.compile(r"(sha-?(?:1|224|256|384|512)|md5|commit|integrity)[-:= ]*$", re.IGNORECASE)
HEX_DIGEST = re.compile(r"[0-9a-f]{20,128}", re.IGNORECASE)
BASE64_DIGEST = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# Characters of a digest in base64, without padding.
BASE64_SIZES = {"md5": 22, "sha1": 27, "sha224": 38, "sha256": 43, "sha384": 64, "sha512": 86}
# Known values that a longer string holds as whole parts.
KNOWN = re.compile(rf"(?<![A-Za-z0-9+])(?:{UUID.pattern}|{DIGEST.pattern}|"
                   + "|".join(f"{name}[-_=][A-Za-z0-9+/_-]{{{size}}}={{0,2}}" for name, size in BASE64_SIZES.items())
                   + r")(?![A-Za-z0-9+])", re.IGNORECASE)

SPANS = T.StructType([
    T.StructField("n_assign", T.LongType(), False), T.StructField("n_access", T.LongType(), False),
    T.StructField("n_hex", T.LongType(), False), T.StructField("n_random", T.LongType(), False),
    T.StructField("base_sha256", T.StringType(), False), T.StructField("spans", T.StringType(), False),
    T.StructField("starts", T.ArrayType(T.IntegerType(), False), False),
    T.StructField("ends", T.ArrayType(T.IntegerType(), False), False)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the fixed patterns.

    An assignment consumes what it matches even where its value is too short; in the other
    patterns a run that is too short holds no longer one, so the length is in the pattern.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


@workers.kept_for("secrets", 2)
def _encoding(ranks: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})


def _stated_digest(text: str, start: int, part: str) -> bool:
    """Whether a digest is announced right before a string that has the shape of one."""
    hint = DIGEST_HINT.search(text, max(0, start - 12), start)
    if not hint or HEX_DIGEST.fullmatch(part):
        return hint is not None
    name = hint[1].lower().replace("-", "")
    sizes = BASE64_SIZES.values() if name == "integrity" else (BASE64_SIZES.get(name),)
    return len(part.rstrip("=")) in sizes and BASE64_DIGEST.fullmatch(part) is not None


def _stretches(scores: list[float]) -> list[tuple[int, int]]:
    """First and end places of the maximal stretches by sum, in one pass (Ruzzo and Tompa). Every
    positive score is in one of them."""
    # First, end, sum before and after, and the last earlier stretch with a smaller sum before.
    found, total = [], 0.0
    for i, score in enumerate(scores):
        first, left, total = i, total, total + score
        while score > 0:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((first, i + 1, left, total, j))
                break
            first, _, left, _, _ = found[j]
            del found[j:]
    return [(first, end) for first, end, *_ in found]


def _parts(run: str, ranks: str, ratio: float) -> list[tuple[int, int, float]]:
    """Start, end and score of the parts of a string. The score is positive where a part takes a
    token for fewer than ``ratio`` characters; numbers never do, and known values keep stretches apart."""
    known, out = [m.span() for m in KNOWN.finditer(run)], []
    for m in PART.finditer(run):
        part = m.group()
        if _inside(known, *m.span()):
            score = -(ratio + 1) * len(run)
        else:
            score = ratio * len(_encoding(ranks).encode_ordinary(part)) - len(part)
        out.append((*m.span(), min(score, 0) if NUMBER.fullmatch(part) else score))
    return out


def _inside(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the ascending, separate spans holds all from start to end."""
    at = bisect.bisect_right(spans, start, key=lambda s: s[0]) - 1
    return at >= 0 and end <= spans[at][1]


def _touches(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    at = bisect.bisect_left(spans, end, key=lambda s: s[0]) - 1
    return at >= 0 and start < spans[at][1]


def random_spans(text: str, ranks: str, ratio: float,
                 base: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Strings that take a token for fewer than ``ratio`` characters: a run as a whole, or else the
    stretches of its parts that do. One of which ``base`` holds all that is random is left out."""
    out = []
    for m in CANDIDATE.finditer(text):
        run, at = m.group(), m.start()
        if _inside(base, at, m.end()) or any(known.fullmatch(run) for known in (DIGEST, UUID, NUMBER)):
            continue
        parts = _parts(run, ranks, ratio)
        whole = len(run) < ratio * len(_encoding(ranks).encode_ordinary(run))
        # Separators are tokens too; letters alone must be random without them.
        if whole and (any(c.isdigit() for c in run) or sum(p[2] for p in parts) > 0):
            # Words and a key can follow the name of a digest too, so a value in parts has its size.
            named = INTEGRITY.fullmatch(run)
            known = named and (PART.fullmatch(named[1]) or KNOWN.fullmatch(run))
            spans = [] if known else [(0, len(run))]
        else:
            spans = [(parts[i][0], parts[j - 1][1]) for i, j in _stretches([p[2] for p in parts])]
        for s, e in spans:
            if e - s < LEAST or NUMBER.fullmatch(run[s:e]) or _stated_digest(text, at + s, run[s:e]):
                continue
            if _touches(base, at + s, at + e) and all(
                    _inside(base, at + a, at + b) for a, b, score in parts if score > 0 and s <= a and b <= e):
                continue
            out.append((at + s, 3, at + e))
    return out


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal ranges of overlapping or touching spans, ascending."""
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def scan_text(text: str, ranks: str = RANKS, ratio: float = MAX_CHARS_PER_TOKEN) -> dict:
    """Spans of one text, in code points with the end exclusive. A random string adds nothing
    where base spans hold all of its random parts, and is left out; one that reaches beyond stays."""
    base = sorted(base_spans(text))
    more = random_spans(text, ranks, ratio, _joined([(s, e) for s, _, e in base]))

    def stated(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    every = sorted(base + more)
    counts = [sum(k == i for _, k, _ in every) for i in range(4)]
    return {"n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2], "n_random": counts[3],
            "base_sha256": hashlib.sha256(stated(base).encode()).hexdigest(), "spans": stated(every),
            "starts": [s for s, _, _ in every], "ends": [e for _, _, e in every]}


def _scan_batch(texts: pa.Array, ranks: str, ratio: float) -> pa.Array:
    from pyspark.sql.pandas.types import to_arrow_type

    kind, parts = to_arrow_type(SPANS), []
    for start, stop in vocab.byte_blocks(texts):
        block = [scan_text(t or "", ranks, ratio) for t in texts[start:stop].to_pylist()]
        parts.append(pa.array(block, kind))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def scan(docs: DataFrame, text: str = "text", into: str = "found", ranks: str = RANKS,
         ratio: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """Add the struct column ``into`` with counts and spans of the secrets of each text.

    Null counts as empty; a column named ``into`` is replaced, all others are kept. Whole
    texts are scanned, one row out per row in, without a shuffle.
    """
    def find(texts: pa.Array) -> pa.Array:
        workers.begin("secrets")
        return _scan_batch(texts, ranks, ratio)

    return docs.withColumn(into, F.arrow_udf(find, SPANS)(F.col(f"`{text}`")))


def _cut(text: str, starts, ends, mark: str) -> str:
    out, at = [], 0
    for s, e in sorted(zip(starts, ends)):
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", ranks: str = RANKS,
           ratio: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """Replace each run of overlapping secrets in ``text`` by ``mark``; no row is dropped.

    A null text stays null. Other columns, a length column among them, are left alone.
    """
    def clean(texts: pa.Array) -> pa.Array:
        workers.begin("secrets")
        parts = []
        for start, stop in vocab.byte_blocks(texts):
            out = []
            for t in texts[start:stop].to_pylist():
                found = scan_text(t, ranks, ratio) if t else None
                out.append(_cut(t, found["starts"], found["ends"], mark) if found and found["starts"] else t)
            parts.append(pa.array(out, pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return docs.withColumn(text, F.arrow_udf(clean, T.StringType())(F.col(f"`{text}`")))
