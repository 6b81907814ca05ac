"""Token ids in files of length-delimited records, with an index for shuffled reads.

A record is ``length (u64) | masked checksum of those 8 bytes (u32) | data | masked
checksum of the data (u32)``, all little-endian. Checksums are CRC-32, masked by rotation
and addition so that the checksum of data which holds checksums stays meaningful. The data
is ``width (u8) | number of ids (u32) | ids``, with 2-byte ids where the vocabulary
allows, deflated by zstd. A file holds the records of one range of document ids in
ascending order; the index is a table next to the files.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm import vocab, workers
from framelake.operators.joins import attach_bounded
from framelake.session import scratch
from framelake.sources.recording import resolve

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
# A file is closed and the next begun beyond this size.
FILE_BYTES = 128 << 20
# Neighbouring records are read together up to this size.
RUN_BYTES = 8 << 20

# Fixed value: what masking adds after rotating by 15 bits.
MASK = 0xA282EAD8
FRAME = 16

INDEX = "doc_id long, file string, record int, at long, length long, first_token long, n_tokens long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


@functools.lru_cache(maxsize=1)
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def frame(ids: bytes, width: int) -> bytes:
    """One record of ids given as little-endian bytes of ``width`` each."""
    data = struct.pack("<BI", width, len(ids) // width) + _zstd()[0].compress(ids)
    head = struct.pack("<Q", len(data))
    return b"".join([head, struct.pack("<I", masked(head)), data, struct.pack("<I", masked(data))])


def unframe(record: bytes) -> np.ndarray:
    """Ids of one record, as unsigned 32-bit integers; a damaged record is refused."""
    if len(record) < FRAME or struct.unpack_from("<I", record, 8)[0] != masked(record[:8]):
        raise ValueError("damaged record length")
    (length,) = struct.unpack_from("<Q", record)
    data = record[12:12 + length]
    if len(record) != length + FRAME or struct.unpack_from("<I", record, 12 + length)[0] != masked(data):
        raise ValueError("damaged record")
    width, n = struct.unpack_from("<BI", data)
    ids = np.frombuffer(_zstd()[1].decompress(data[5:], max_output_size=max(1, n * width)), f"<u{width}")
    return ids.astype("<u4")


def encode(texts: pa.Array, tokenizer: str, layout: str, end_id: int | None,
           entries: int = vocab.CACHE_ENTRIES):
    """Id bytes of each text (null as empty), with the end id appended."""
    workers.begin("tokens")
    cache = vocab.ids_of(tokenizer, layout, entries)
    kind = vocab.id_type(max(cache.vocabulary, (end_id or 0) + 1))
    tail = b"" if end_id is None else np.array([end_id], kind).tobytes()
    for start, stop in vocab.byte_blocks(texts):
        block = [t or "" for t in texts[start:stop].to_pylist()]
        if len(block) > 1:
            for parts in cache.each(block):
                yield b"".join(parts) + tail
            continue
        whole = []
        for part in vocab.windows(block[0]):
            whole += [b"".join(v) for v in cache.each([part])]
        yield b"".join(whole) + tail


def write(docs: DataFrame, folder: str, index: str, text: str = "text", id: str = "doc_id",
          tokenizer: str = TOKENIZER, layout: str = "word", end_id: int | None = END_ID,
          file_bytes: int = FILE_BYTES) -> None:
    """Encode, and write record files below ``folder`` and their index to ``index``.

    Documents are dealt out by ranges of their id (ties by text, null ids first), so files
    follow each other in ascending order. File names are unique for each attempt, and only
    files named in the index count: a task that runs twice leaves nothing behind twice.
    ``first_token`` counts the ids before a record in its own file.
    """
    width = vocab.id_type(max(vocab.vocabulary_size(tokenizer), (end_id or 0) + 1)).itemsize

    def pack(batches):
        shape = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("record", pa.int32()),
                           ("at", pa.int64()), ("length", pa.int64()), ("first_token", pa.int64()),
                           ("n_tokens", pa.int64())])
        out, name, at, n, tokens = None, None, 0, 0, 0
        try:
            for batch in batches:
                rows = {c: [] for c in shape.names}
                ids = batch.column("doc_id").to_pylist()
                for doc, raw in zip(ids, encode(batch.column("text"), tokenizer, layout, end_id)):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at, n, tokens = f"{folder}/{uuid.uuid4().hex}.rec", 0, 0, 0
                        system, path = resolve(name)
                        out = system.open_output_stream(path)
                    record = frame(raw, width)
                    out.write(record)
                    for c, v in zip(shape.names, (doc, name, n, at, len(record), tokens, len(raw) // width)):
                        rows[c].append(v)
                    at, n, tokens = at + len(record), n + 1, tokens + len(raw) // width
                yield pa.RecordBatch.from_pydict(rows, schema=shape)
        finally:
            if out is not None:
                out.close()

    system, path = resolve(folder)
    system.create_dir(path, recursive=True)
    picked = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    (picked.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(pack, INDEX).write.option("compression", "zstd").parquet(index))


def _fetched(batches):
    """Runs of neighbouring records of an index, with the ids of each; one range read a run."""
    for batch in batches:
        for run in _runs(batch.to_pylist()):
            system, path = resolve(run[0]["file"])
            with system.open_input_file(path) as src:
                src.seek(run[0]["at"])
                data = src.read(run[-1]["at"] + run[-1]["length"] - run[0]["at"])
            places = [(r["at"] - run[0]["at"], r["length"]) for r in run]
            ids = [unframe(data[at:at + length]) for at, length in places]
            for row, found in zip(run, ids):
                if len(found) != row["n_tokens"]:
                    raise ValueError(f"{row['file']} record {row['record']} does not match its index")
            yield run, ids


def _reader(places: DataFrame, field: str, kind: str, arrow_kind: pa.DataType, value) -> DataFrame:
    kept = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("first_token", pa.int64()),
                      ("n_tokens", pa.int64())])

    def rows(batches):
        for run, ids in _fetched(batches):
            yield pa.RecordBatch.from_pydict(
                {**{c: [r[c] for r in run] for c in kept.names}, field: [value(i) for i in ids]},
                schema=kept.append(pa.field(field, arrow_kind)))

    return places.mapInArrow(
        rows, f"doc_id long, file string, first_token long, n_tokens long, {field} {kind}")


def read(places: DataFrame) -> DataFrame:
    """``ids`` of the records at the given places of an index, in any order and number."""
    return _reader(places, "ids", "array<int>", pa.list_(pa.int32()), lambda i: i.astype(np.int32))


def read_digests(places: DataFrame) -> DataFrame:
    """Like ``read``, with the CRC-32 of the ids as unsigned 32-bit integers in their place."""
    return _reader(places, "ids_crc32", "long", pa.int64(), lambda i: zlib.crc32(i.tobytes()))


def _runs(rows):
    run = []
    for row in rows:
        if run and (row["file"] != run[0]["file"] or row["at"] != run[-1]["at"] + run[-1]["length"]
                    or row["at"] + row["length"] - run[0]["at"] > RUN_BYTES):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def starts(index: DataFrame) -> DataFrame:
    """Ids before each file, over all files in document order: one row for each file."""
    files = index.groupBy("file").agg(F.min(F.struct("doc_id", "at")).alias("_first"),
                                      F.max(F.struct("doc_id", "at")).alias("_last"),
                                      F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_first", "_last", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents to record files on shared storage and read them back: ``doc_id``,
    ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    spark: SparkSession = docs.sparkSession
    folder = scratch(spark, "records")
    write(docs, f"{folder}/files", f"{folder}/index", **options)
    index = spark.read.parquet(f"{folder}/index")
    found = attach_bounded(read_digests(index), starts(index), ["file"])
    return found.select("doc_id", (F.col("_before") + F.col("first_token")).alias("start"),
                        "n_tokens", "ids_crc32")
