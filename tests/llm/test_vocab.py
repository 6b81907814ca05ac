"""Pieces and cache against the libraries on whole texts."""

import random

import public_tokenizers
import pytest

from framelake.llm import vocab

ODD = ["", " ", "\n", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n", "a\n\nb", "x\ty \t z",
       "don't 'll we've", "12 345 6", "ﬁ ² Ⅷ", "a b 　c", "é é ́", "ΑΣ ΣΑΣ",
       "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b", "<s> </s>", "▁ a▁ ▁b", "日本語 テキスト",
       "🙂 🙂\n🙂", "a\x1cb \x1c !\x1c", "!!! ???\n...", "\r\n x\r\n", "a b", "x" * 300]


def texts():
    rng = random.Random(5)
    parts = ["foo", "Bar,", "'s", " ", "  ", "\n", "\t", "é", "12", "-", "<|endoftext|>", "日本", "\x1c"]
    latin = [chr(c) for c in range(0x21, 0x250) if chr(c).isprintable()] + [" "] * 150
    return (ODD + ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(400)]
            + ["".join(rng.choices(latin, k=rng.randrange(200))) for _ in range(300)])


@pytest.mark.parametrize("name, layout", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_ids(name, layout):
    path = public_tokenizers.path(name)
    whole = vocab._library(path)
    kind = vocab.id_type(whole.get_vocab_size())
    cache = vocab.ids_of(path, layout)
    given = texts()
    for text, found in zip(given, cache.each(given)):
        assert b"".join(found) == vocab.np.array(
            whole.encode(text, add_special_tokens=False).ids, kind).tobytes(), repr(text)


@pytest.mark.parametrize("name, layout", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_every_letter_before_a_full_stop_or_comma(name, layout):
    path = public_tokenizers.path(name)
    whole = vocab._library(path)
    kind = vocab.id_type(whole.get_vocab_size())
    letters = [chr(c) for c in range(0x30000) if chr(c).isalpha()]
    given = [f"ab {letter}{tail} {letter}x{letter}{tail}" for letter in letters for tail in ".,"]
    want = [vocab.np.array(e.ids, kind).tobytes() for e in whole.encode_batch_fast(given, add_special_tokens=False)]
    cache = vocab.ids_of(path, layout)
    found = [b"".join(f) for at in range(0, len(given), 5000) for f in cache.each(given[at:at + 5000])]
    assert [g for g, w, f in zip(given, want, found) if w != f] == []


def test_lengths():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    whole = sentencepiece.SentencePieceProcessor(model_file=path)
    given = texts()
    for text, found in zip(given, vocab.lengths_of(path).each(given)):
        assert sum(found) == len(whole.encode(text)), repr(text)


def test_windows_join_to_the_text():
    for text in texts():
        parts = list(vocab.windows(text, 7))
        assert "".join(parts) == text
        assert all(p[0] == " " and p[1] != " " for p in parts[1:])
