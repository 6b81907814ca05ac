import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from framelake.llm import records

TEXTS = [(5, "Hello World, hello"), (1, None), (3, ""), (2, "x " * 5000), (None, "no id"), (9, "same"), (9, "same"),
         (7, "<|endoftext|> \n ok")]


def expected():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, out = 0, []
    for doc, text in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("file_bytes", [1 << 20, 1])
def test_round_trip(spark, file_bytes):
    docs = spark.createDataFrame([(d, t, "x") for d, t in TEXTS], "doc_id long, text string, file string")
    got = sorted(records.round_trip(docs, file_bytes=file_bytes).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == expected()


def test_shuffled_read(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    folder = records.scratch(spark, "test")
    records.write(docs, f"{folder}/files", f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    every = {r.doc_id: r.ids for r in records.read(index).collect()}
    some = records.read(index.filter("doc_id % 7 = 3").orderBy("ids") if "ids" in index.columns
                        else index.filter("doc_id % 7 = 3").orderBy(index.doc_id.desc())).collect()
    assert len(every) == 50 and all(r.ids == every[r.doc_id] for r in some) and len(some) == 7


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert records.round_trip(docs).count() == 0


def test_damage_is_refused():
    record = records.frame(np.arange(5, dtype="<u2").tobytes(), 2)
    assert list(records.unframe(record)) == [0, 1, 2, 3, 4]
    for i in range(len(record)):
        with pytest.raises(ValueError):
            records.unframe(record[:i] + bytes([record[i] ^ 1]) + record[i + 1:])
    with pytest.raises(ValueError):
        records.unframe(record[:-1])


def test_a_run_of_records_is_copied_once(monkeypatch):
    """Taking the records out of what was read costs their own bytes, not the rest of the run each."""
    sliced = []

    class Counted(bytes):
        def __getitem__(self, key):
            found = bytes(self)[key]
            sliced.append(len(found))
            return found

    class Read:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def seek(self, _):
            pass

        def read(self, _):
            return Counted(raw)

        open_input_file = lambda self, _: self

    parts = [records.frame(np.arange(i + 1, dtype="<u2").tobytes(), 2) for i in range(40)]
    raw = b"".join(parts)
    at = [sum(map(len, parts[:i])) for i in range(40)]
    batch = pa.RecordBatch.from_pylist([
        {"file": "f", "record": i, "at": at[i], "length": len(parts[i]), "n_tokens": i + 1} for i in range(40)])
    monkeypatch.setattr(records, "resolve", lambda name: (Read(), name))
    ((run, ids),) = records._fetched([batch])
    assert len(run) == 40 and all(found.tolist() == list(range(i + 1)) for i, found in enumerate(ids))
    assert sum(sliced) == len(raw)
