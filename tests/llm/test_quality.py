import collections
import re

import pyarrow as pa
import pytest

from framelake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    tokens = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(tokens[i:i + 5]) for i in range(len(tokens) - 4)]
    often = collections.Counter(windows)
    places = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return (len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places))


TEXTS = [None, "", "\n\n \n", "one two", "A b c d e a B c d e A b c d e", "x y x y x y x y x y",
         "Same line.\nSame line.\n Same line.\n\n\nSame line.", "# a | b <c> &%$*", "é日本 ñ x y\u0085z", "a\x0bb\x1cc\x1fd",
         "tab\tand\rreturn\x0cpage", "end of one.\n", "w1 w2 w3 w4 w5 w6\nw1 w2 w3 w4 w5 w7", "a" * 70 + " " + "a" * 70]


@pytest.mark.parametrize("together", [True, False])
def test_counts_equal_brute_force(together):
    parts = [TEXTS] if together else [[t] for t in TEXTS]
    got = [row for p in parts for row in quality._blocks(pa.array(p, pa.string())).to_pylist()]
    assert [tuple(r[c] for c in COUNTS) for r in got] == [brute(t) for t in TEXTS]


@pytest.mark.parametrize("line, bad", [
    ("The house stands on a hill.", False), ("Who is there?", False), ("He said \"no.\"", False), ("Of.", False),
    ("Ends like this …", False), ("好的。", False), ("trailing space. \t", False),
    ("No end", True), ("Home | About | Contact.", True), ("Home > Shop > Shoes.", True),
    ("One long line of prose may hold | one sign.", False), ("BUY!! NOW!! CHEAP!!", True), ("the*** thing%%% is&&&.", True),
    ("This site uses cookies.", True), ("All Rights Reserved.", True), ("Please enable JavaScript.", True)])
def test_rules_of_lines(line, bad):
    assert quality.failing(pa.array([line], pa.large_string())).tolist() == [bad]


PROSE = "The first line of this text tells a story about a house.\nThe second line goes on with other words.\n"


def test_lines_go_and_documents_that_lose_too_much_are_rejected(spark):
    rows = [(1, PROSE + "Home | About | Contact"), (2, PROSE + " ".join(f"entry{i}" for i in range(60))), (3, "too short."),
            (4, "again and again and " * 30 + "."), (5, None), (6, PROSE), (6, PROSE)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    found = {r.doc_id: r.quality for r in quality.judge(df).collect()}
    assert {i: q.kept for i, q in found.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    assert {i for i, q in found.items() if q.base_failed} == {3, 4, 5}
    assert found[1].text == PROSE.rstrip("\n") and found[1].n_lines_removed == 1 and found[6].text == PROSE
    assert found[5].text is None
    kept = quality.clean(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 6, 6]


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(PROSE, {"a": 1}, 2, 3)], "text string, _quality map<string,int>, kept int, quality int")
    kept = quality.clean(df)
    assert kept.columns == df.columns and kept.collect() == df.collect()
    assert quality.judge(df).columns == df.columns
    assert quality.judge(df.limit(0)).count() == 0 and quality.clean(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "\n".join(f"Line number {i} of a long text, with word w{i}." for i in range(60_000))
    found = quality.judge(spark.createDataFrame([(text,), ("short",)], "text string")).collect()
    assert tuple(found[0].quality[c] for c in COUNTS) == brute(text) and found[0].quality.n_lines_removed == 0
