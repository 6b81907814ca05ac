"""Each stage against plain Python on what the stage before it kept."""

import collections

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framelake.llm import language, packing, secrets
from test_decontaminate import brute as hits
from test_minhash import brute as groups


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn(
        "text", F.when(F.col("doc_id") == 7, None).when(F.col("doc_id") == 8, "12 34").otherwise(F.col("text")))
    docs = docs.union(docs.filter("doc_id = 3"))
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.session.stored(stage(spark, docs, sf), "test")
        out.append((name, docs.collect()))
    return out


def test_language(spark, stages):
    before, after = stages[0][1], stages[1][1]
    model = language.learn(spark.createDataFrame(before).filter(~language.held_out(F.col("doc_id"))))
    keep = [r for r, (_, _, rejected) in zip(before, model.predict([r.text or "" for r in before])) if not rejected]
    assert sorted(after) == sorted(keep)
    assert {7, 8}.isdisjoint(r.doc_id for r in after)


def test_near_duplicates(stages):
    before, after = stages[1][1], stages[2][1]
    kept = {i for i, _, _, keep in groups(sorted({(r.doc_id, r.text) for r in before})) if keep}
    assert sorted(r.doc_id for r in after) == sorted(kept)
    assert set(after) <= set(before)


def test_decontamination(spark, sf, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = stages[2][1], stages[3][1]
    assert sorted(after) == sorted(r for r in before if not hits(r.text, items)[1])


def test_secrets(stages):
    before, after = ({r.doc_id: r for r in stages[i][1]} for i in (3, 4))
    assert before.keys() == after.keys()
    for i, row in before.items():
        found = secrets.scan_text(row.text)
        assert after[i].text == secrets._cut(row.text, found["starts"], found["ends"], "[SECRET]")
        assert after[i].n_chars == len(after[i].text)


def test_packing(stages):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(whole.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[4][1]}
    sequences, lengths = collections.defaultdict(list), collections.Counter()
    for r in stages[5][1]:
        sequences[r.sequence_id].append((r.offset, r.length))
        lengths[r.doc_id] += r.length
    assert lengths == want
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_no_stage_reads_past_its_input(stages):
    names = [name for name, _ in stages]
    assert names == ["documents", "language_id", "minhash_near_dedup", "decontamination", "secret_scan",
                     "best_fit_packing"]
    assert [len(rows) for _, rows in stages[:4]] == sorted((len(rows) for _, rows in stages[:4]), reverse=True)


def test_columns_of_any_name_and_type_stay(spark, sf):
    extra = {"language": F.lit("x"), "_language": F.lit(1), "_before": F.lit("b"), "_gone": F.lit(True), "_Contamination": F.lit(2),
             "a.b": F.lit(3), "tags": F.create_map(F.lit("k"), F.col("source"))}
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.union(docs.limit(1)).withColumns(extra)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.session.stored(stage(spark, kept, sf), "test")
        assert kept.columns == docs.columns, name
    rows = kept.collect()
    assert rows and all((r["language"], r["_language"], r["_before"], r["_gone"], r["_Contamination"], r["a.b"], r["tags"])
                        == ("x", 1, "b", True, 2, 3, {"k": r["source"]}) for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)
