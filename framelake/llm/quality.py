"""Line-first quality rules: lines are judged one by one, failing ones removed, and documents
that lose too much of their text that way are rejected."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm import vocab, words

# A document may lose this share of its word characters, in percent.
MOST_LOST = 50
FEWEST_WORDS = 10
# Most words in repeated windows, in percent.
MOST_REPEATED = 20
WINDOW = 5

SYMBOLS = b"#*$%&|<>"

# Rules of lines, as regular expressions of RE2, which Arrow and SQL engines share.
# A line of prose ends with one of these.
SENTENCE_END = "[.!?:;…。！？।\"'”’»)\\]][\\x20\\x09-\\x0D]*$"
# Signs between the entries of a menu.
SEPARATOR = "[|>»•·]"
PUNCTUATION = "[!-/:-@\\[-`{-~]"
# Phrases of notices that sites repeat on every page.
BOILERPLATE = (
    "(?i)(cookie policy|uses? cookies|accept (all )?cookies|enable javascript|javascript is|privacy policy|"
    "terms of (use|service)|all rights reserved|copyright ©|copyright \\(c\\)|lorem ipsum|click here|"
    "skip to (main )?content|sign up for our|subscribe to our|read more|share on|powered by)")
SPACE = "[\\x20\\x09-\\x0D]"

FOUND = ("struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
         "n_repeat_words:bigint,n_lines_removed:bigint,lost_chars:bigint,text:string>")


def failing(lines: pa.Array) -> np.ndarray:
    """Which of these lines are no prose: they do not end like a sentence, are a menu, hold two
    or more signs of punctuation a word, or a phrase of site notices."""
    n_words = pc.count_substring_regex(lines, "[^\\x20\\x09-\\x0D]+").to_numpy(zero_copy_only=False)
    signs = pc.count_substring_regex(lines, PUNCTUATION).to_numpy(zero_copy_only=False)
    breaks = pc.count_substring_regex(lines, SEPARATOR).to_numpy(zero_copy_only=False)
    ends = pc.match_substring_regex(lines, SENTENCE_END).to_numpy(zero_copy_only=False)
    notice = pc.match_substring_regex(lines, BOILERPLATE).to_numpy(zero_copy_only=False)
    menu = (breaks >= 2) & (4 * breaks >= n_words)
    return ~ends | menu | (signs >= 2 * n_words) | notice


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense codes of pairs of codes: equal pairs, and no others, get one code."""
    if not len(a):
        return a
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def _repeated_words(codes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text: words in windows of five that occur twice or more in it."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.zeros(n_texts, np.int64)
    two = _paired(codes[:-1], codes[1:])
    four = _paired(two[:-2], two[2:])
    five = _paired(_paired(four[:n], codes[WINDOW - 1:]), text[:n])
    inside = text[:n] == text[WINDOW - 1:]
    often = inside & (np.bincount(five, weights=inside)[five] >= 2)
    edge = np.zeros(len(codes) + 1, np.int64)
    edge[:n] += often
    edge[WINDOW:WINDOW + n] -= often
    return np.bincount(text, weights=np.cumsum(edge)[:-1] > 0, minlength=n_texts).astype(np.int64)


def _judge(texts: pa.Array) -> pa.Array:
    n = len(texts)
    data, bounds = words.text_bytes(texts)
    found = words.words_of(texts, words.NOT_SPACE)
    inside = words.NOT_SPACE[data]
    codes, _ = words.codes(words.strings(data[inside], found.end - found.start))

    def per_text(marks: np.ndarray) -> np.ndarray:
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(marks, out=upto[1:])
        return upto[bounds[1:]] - upto[bounds[:-1]]

    # Code points begin at every byte that continues no other.
    chars = inside & ((data & 0xC0) != 0x80)
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True

    breaks = data == 10
    n_lines = per_text(breaks) + 1
    of = np.repeat(np.arange(n), n_lines)
    first = np.cumsum(n_lines) - n_lines
    # A line ends at a line break or at the end of its text.
    ends = np.zeros(len(of), np.int64)
    last = np.zeros(len(of), bool)
    last[first + n_lines - 1] = True
    ends[last], ends[~last] = bounds[1:], np.flatnonzero(breaks)
    starts = np.empty_like(ends)
    starts[first] = bounds[:-1]
    starts[~np.isin(np.arange(len(of)), first)] = ends[~last] + 1
    lines = words.strings(data[~breaks], ends - starts)
    line_code, distinct = words.codes(lines)
    upto = np.zeros(len(data) + 1, np.int64)
    np.cumsum(chars, out=upto[1:])
    line_chars = upto[ends] - upto[starts]
    worded = line_chars > 0
    keys = of[worded] * (len(distinct) + 1) + line_code[worded]
    _, kept_first = np.unique(keys, return_index=True)
    dup = np.bincount(of[worded], minlength=n) - np.bincount(of[worded][kept_first], minlength=n)

    bad = failing(distinct)[line_code] & worded if len(distinct) else np.zeros(0, bool)
    cleaned = _rest(texts, lines, of, bad, first, n_lines)
    columns = [np.diff(found.first), per_text(chars), per_text(is_symbol[data]), dup,
               _repeated_words(codes, found.text, n), np.bincount(of, weights=bad, minlength=n),
               np.bincount(of, weights=bad * line_chars, minlength=n)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "lost_chars"]
    return pa.StructArray.from_arrays(
        [pa.array(c.astype(np.int64)) for c in columns] + [cleaned], [*names, "text"])


def _rest(texts, lines, of, bad, first, n_lines) -> pa.Array:
    """Texts without their failing lines; a text that loses none is as it was."""
    touched = np.bincount(of, weights=bad, minlength=len(texts)) > 0
    if not touched.any():
        return texts.cast(pa.string())
    out = texts.to_pylist()
    for i in np.flatnonzero(touched):
        at = slice(first[i], first[i] + n_lines[i])
        out[i] = "\n".join(lines[at].filter(pa.array(~bad[at])).to_pylist())
    return pa.array(out, pa.string())


def _blocks(texts: pa.Array) -> pa.Array:
    parts = [_judge(texts[a:b]) for a, b in vocab.byte_blocks(texts)]
    if parts:
        return pa.concat_arrays(parts)
    return pa.array([], pa.struct([(n, pa.int64()) for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "lost_chars")]
        + [("text", pa.string())]))


def judge(docs: DataFrame, text: str = "text", into: str = "quality", most_lost: int = MOST_LOST,
          fewest_words: int = FEWEST_WORDS, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """Add the struct ``into``: counts over the whole text, the text without failing lines
    (``text``), ``base_failed`` and ``kept``.

    A document is kept if it has enough words, few of them in repeated windows, and its failing
    lines hold at most ``most_lost`` percent of the characters of its words. Lines without
    words are neither judged nor removed. Null and empty texts have no words and are not
    kept; their text stays as it was. Other columns are kept, one of the name ``into`` is
    replaced. One row out per row in, repeated rows included, without a shuffle; texts are taken
    in blocks of 1 MB, a longer one by itself.
    """
    found = F.arrow_udf(lambda texts: _blocks(texts), FOUND)
    out = docs.withColumn(into, found(F.col(f"`{text}`")))

    def part(name):
        return F.col(f"`{into}`.{name}")

    failed = (part("n_words") < fewest_words) | (
        F.lit(100) * part("n_repeat_words") > F.lit(most_repeated) * part("n_words"))
    kept = ~failed & (F.lit(100) * part("lost_chars") <= F.lit(most_lost) * part("word_chars"))
    return out.withColumn(into, F.col(f"`{into}`").withField("base_failed", failed).withField("kept", kept))


def clean(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents kept, with their failing lines taken out of ``text`` and all columns as they were."""
    mark = words.free_name(docs.columns, "_quality")
    found = judge(docs, text, mark, **options).filter(F.col(f"{mark}.kept"))
    return found.withColumn(text, F.col(f"{mark}.text")).drop(mark)
