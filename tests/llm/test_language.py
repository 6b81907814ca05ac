import math
import random
import zlib

import numpy as np

from framelake.llm import language

WORDS = {"aa": "ka lomi tura ben solo mika dar".split(), "bb": "schli grunt pforz wend acht".split()}


def text(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(WORDS[lang], k=rng.randrange(1, 3))) for _ in range(n))


def rows():
    out = [(i, text(lang, 30, i), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    # A tenth of the labels are wrong.
    return [(i, t, "aa" if i % 20 == 1 else lang) for i, t, lang in out]


ODD = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? 34", "bb"), (1003, text("aa", 30, 9), None),
       (1004, "日本語の文章です" * 20, None), (1005, text("bb", 4000, 3), "bb"), (None, text("aa", 30, 1), "aa")]


def test_held_out_accuracy_despite_wrong_labels(spark):
    docs = spark.createDataFrame([(*r, 0.5) for r in rows() + ODD], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(got) == len(rows() + ODD) and got[0].score == 0.5
    for i, t, _ in rows():
        found = got[i].language
        assert found.lang_pred == ("aa", "bb")[i % 2] and 0 <= found.score <= 1 and not found.rejected
    for i in (1000, 1001, 1002):
        assert tuple(got[i].language) == ("und", 0.0, True)
    assert got[1003].language.lang_pred == "aa" and got[1005].language.lang_pred == "bb"
    assert got[1004].language.rejected and got[1004].language.lang_pred in ("aa", "bb")


def test_held_out_rows_and_their_labels_do_not_matter(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    held = {i for i, _, _ in rows() if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {r.doc_id for r in docs.filter(language.held_out(docs.doc_id)).collect()} == held
    other = spark.createDataFrame([(i, t, "zz" if i in held else lang) for i, t, lang in rows()],
                                  "doc_id long, text string, lang string")
    key = lambda r: r.doc_id
    a, b = (sorted(language.identify(d).collect(), key=key) for d in (docs, other))
    assert [r.language for r in a] == [r.language for r in b]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r.language) for r in language.identify(docs).collect()] == [("und", 0.0, True)]
    assert language.identify(docs.limit(0)).count() == 0


def test_clusters():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(c, 0.05, (40, 3)) for c in ([1, 0, 0], [0, 1, 0], [0, 0, 1])])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres = language.cluster(rows, 3)
    assert sorted(centres.argmax(1)) == [0, 1, 2]


def plain_grams(text):
    """Bigrams and trigrams of the words of a text, a space before and after each, in one line."""
    line, inside = " ", False
    for c in text.lower():
        letter = ord(c) < 0x30000 and c.isalpha()
        if letter or inside:
            line += c if letter else " "
        inside = letter
    line += " "
    return [line[i:i + 2] for i in range(len(line) - 1)] + [line[i:i + 3] for i in range(len(line) - 2)]


def place(gram):
    """The place of one gram by itself: the last bigram or trigram of a line that is just it."""
    points = [ord(c) for c in gram]
    mask = (1 << 32) - 1
    a, b, c = int(language._A), int(language._B), int(language._C)
    second = points[1] * b & mask
    two = ((points[0] * a + second) & mask) ^ (second >> 15)
    if len(gram) == 2:
        return (two * b & mask) >> int(language._SHIFT)
    three = (two * c & mask) ^ (points[2] * a & mask)
    three ^= three >> 13
    return (three * c & mask) >> int(language._SHIFT)


def brute(text, model):
    """Prediction by dictionaries and sums over them."""
    found, letters = {}, sum(ord(c) < 0x30000 and c.isalpha() for c in text.lower())
    if not letters:
        return "und", 0.0, True
    for gram in plain_grams(text):
        found[place(gram)] = found.get(place(gram), 0) + 1
    weights = {p: math.log1p(n) * float(model.idf[p]) for p, n in found.items()}
    length = math.sqrt(sum(w * w for w in weights.values()))
    cosines = [sum(w * float(centroid[p]) for p, w in weights.items()) / length for centroid in model.centroids]
    best = max(range(len(cosines)), key=lambda i: cosines[i])
    limit = model.limits[min(31, int(math.log2(letters)))]
    return model.languages[best], cosines[best], cosines[best] < limit


def test_predictions_equal_brute_force_on_the_given_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.learn(docs.filter(~language.held_out(docs.doc_id)))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    texts |= {-1 - i: t for i, t in enumerate(["", "12 34", "a", "İstanbul ŞİŞE", "日本語の文章です" * 9, "ΑΣ α", "x\ny\tz", "\U00020000 \U00030000"])}
    got = dict(zip(texts, model.predict(list(texts.values()))))
    for i, text in texts.items():
        lang, score, rejected = brute(text, model)
        assert abs(got[i][1] - max(0.0, min(1.0, score))) < 1e-4, text[:50]
        # Rounding may tip what is all but equal.
        if abs(score - model.limits[min(31, int(math.log2(max(1, len(text)))))]) > 1e-4:
            assert got[i][0] == lang and got[i][2] == rejected, text[:50]
