import hashlib
import random
import re
import string

from framelake.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PLAIN = [(ASSIGN, lambda m: len(m[2]) >= 6), (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
         (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
RANDOM = "q7Zx0Lr2Vw9Kd4Tn8Bs6Hy3Jf"
TEXTS = [None, "", "password=abc password=abcdef", "PassWord : 'hunter2000' token=secret=abcdef", "paſſword=abcdef ToKen=kkkkkkk",
         "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "C" * 20, "0" * 23 + " " + "f" * 24 + "g" + "ab" * 20 + "é" + "1" * 30,
         f"é🙂 use {RANDOM} here", "commit 3f786850e387550fdab836ed7e6dc881de23001b x",
         "id 123e4567-e89b-12d3-a456-426614174000 and internationalization_of_words_2020", f"token={RANDOM} {RANDOM}",
         "sha256-" + RANDOM + RANDOM, "x" * 200_000 + " password: abcdefgh", "api_key=abcdef apikey=abcdef api__key=abcdef"]


def base(text):
    out = []
    for k, (pattern, ok) in enumerate(PLAIN):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if ok(m)]
    return sorted(out)


def stated(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_scan(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id int, text string, spans string")
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, text in enumerate(TEXTS):
        want, found = base(text), got[i].found
        assert [found.n_assign, found.n_access, found.n_hex] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert found.base_sha256 == hashlib.sha256(stated(want).encode()).hexdigest()
        every = found.spans.split(",") if found.spans else []
        assert [s for s in every if not s.startswith("random")] == (stated(want).split(",") if want else [])
        assert got[i].spans == "x"
    assert got[7].found.spans == f"random:7:{7 + len(RANDOM)}"
    assert got[9].found.n_random == got[8].found.n_random == got[11].found.n_random == 0
    assert got[10].found.n_random == 1
    assert secrets.scan(docs.limit(0)).count() == 0


def test_redact(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    got = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert got[0] is None and got[1] == "" and got[7] == "é🙂 use [SECRET] here"
    assert got[2] == "password=abc [SECRET]" and got[9] == TEXTS[9]


KEY = "q7Zx0Lr2Vw9Kd4Tn8Bs6Hy3J"


def random_strings(text):
    found = secrets.scan_text(text)
    return [text[int(s):int(e)] for k, s, e in (p.split(":") for p in found["spans"].split(",") if p) if k == "random"]


def test_keys_without_digits():
    letters = "qZxLrVwKdTnBsHyJfMgPcRtW"
    assert random_strings(f"use {letters} here") == [letters]
    assert random_strings("see internationalization_of_words and the-quick-brown-fox/jumps") == []


def test_keys_glued_to_words():
    rng = random.Random(5)
    for before in ("/home/user/project/config/", "services/hooks/incoming/", "Authorization-Bearer-"):
        for _ in range(200):
            key = "".join(rng.choices(string.ascii_letters + string.digits, k=24))
            found = random_strings(f"a {before}{key}/settings/production/database b")
            assert len(found) == 1 and key in found[0]
    # A key that holds a separator itself.
    secret = "wJalrXUtnFzMI/K7MDxNG/bPxRfiCYqXkMPq"
    assert random_strings("/home/user/project/configuration/settings/database/" + secret) == [secret]


def test_digests_and_numbers_in_longer_strings():
    for text in ("/objects/database/123e4567-e89b-12d3-a456-426614174000/settings",
                 "photograph_12345678901234567890_large_landscape", "sha256 47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
                 "commit 3F786850E387550FDAB836ED7E6DC881DE23001"):
        assert random_strings(text) == []
    # What an announcement of a digest stands before must look like one.
    assert random_strings(f"commit {KEY} and md5: {KEY}x") == [KEY, KEY + "x"]
    assert KEY in random_strings(f"sha1-services/hooks/incoming/messages/{KEY}")[0]
    assert random_strings("sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=") == []


def test_beyond_base_spans():
    assert random_strings(f"{KEY}/token=abcdef") == [f"{KEY}/token=abcdef"]
    assert random_strings(f"{KEY}AKIA" + "A" * 16) == [f"{KEY}AKIA" + "A" * 16]
    assert random_strings(f"token={KEY} access_token={KEY}") == []
    text = f"x {KEY}/token=abcdef y"
    found = secrets.scan_text(text)
    assert secrets._cut(text, found["starts"], found["ends"], "[SECRET]") == "x [SECRET] y"


def test_stretches():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.randrange(-6, 7) for _ in range(rng.randrange(12))]

        def plain(a, b):
            # The definition: the greatest sum first, then what is left on both sides.
            best = max(((sum(scores[i:j]), i - j, -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] <= 0:
                return []
            first, end = -best[2], -best[2] - best[1]
            return plain(a, first) + [(first, end)] + plain(end, b)

        got = secrets._stretches(scores)
        assert [sum(scores[i:j]) for i, j in got] == [sum(scores[i:j]) for i, j in plain(0, len(scores))]
        assert all(any(i <= k < j for i, j in got) for k, s in enumerate(scores) if s > 0)
