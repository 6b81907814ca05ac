import sentencepiece

from framelake.llm import token_counts, vocab


def test_counts(spark, monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)
    texts = [None, "", "hello  world", "a b\nc " * 3000, "same", "same", "<s> ▁x", "日本 " * 50]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id int, text string, n_tokens int")
    got = {r.doc_id: r for r in token_counts.count_tokens(docs).collect()}
    for i, t in enumerate(texts):
        n = len(model.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 4096)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_long_texts_in_parts(monkeypatch):
    import pyarrow as pa

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.MODEL)
    texts = ["one two  three\nfour five " * 40, "x" * 300, " lead and  trail ", None]
    plain = vocab.windows
    monkeypatch.setattr(vocab, "windows", lambda t: plain(t, 50))
    monkeypatch.setattr(vocab, "byte_blocks", lambda t: ((i, i + 1) for i in range(len(t))))
    assert token_counts._counts(pa.array(texts), token_counts.MODEL).to_pylist() == [len(model.encode(t or "")) for t in texts]
