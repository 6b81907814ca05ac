"""Web archives in ZIP packages.

A package is a ZIP file whose members are stored, not deflated: ``archive/data.warc.gz``
holds the WARC records, each a gzip member of its own, and ``indexes/index.cdxj`` one line
per record with its place in the archive. A reader needs the end of the package (its
central directory), the index, and the bytes of the records it wants; nothing is
extracted. Sizes beyond 4 GiB go to ZIP64 fields.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.operators.joins import attach
from framelake.session import scratch
from framelake.sources.recording import resolve

# Fixed values of the ZIP format: signatures and sizes of the records used.
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
END_SIZE, LOCATOR_SIZE, END64_SIZE, CENTRAL_SIZE, LOCAL_SIZE = 22, 20, 56, 46, 30
FULL32, FULL16, ZIP64_EXTRA = 0xFFFFFFFF, 0xFFFF, 1

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
WARC_DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are never written as a revisit.
REVISIT_BYTES = 100
# Records are read back in runs of about this many bytes.
RUN_BYTES = 8 << 20

RECORDS = T.StructType([
    T.StructField("package", T.StringType()), T.StructField("record", T.LongType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


# -- writing ---------------------------------------------------------------------------

def _header(fields) -> bytes:
    """Header lines; a line break inside a value would end it, so it becomes a space."""
    lines = [f"{k}: {' '.join(str(v).splitlines())}" for k, v in fields if v is not None]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member with a response record, or a revisit without its payload."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\n" + _header([
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    block = http + (payload if refers_to is None else b"")
    head = b"WARC/1.1\r\n" + _header([
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, repr(page_id))}>"),
        ("WARC-Date", WARC_DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("X-Page-Id", page_id), ("X-Refers-To-Page", refers_to),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))])
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


class Package:
    """Writes one package front to back; a stream that only appends is enough."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes):
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str):
        """A stored member whose size and checksum follow its data."""
        self.members.append([name.encode(), self.at, 0, 0])
        raw = name.encode()
        # Bit 3: a data descriptor follows. ZIP64 extra with zero sizes makes it a wide one.
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, FULL32, FULL32,
                                      len(raw), len(extra)) + raw + extra)

    def add(self, data: bytes) -> int:
        """Append to the member; returns the offset within it."""
        member = self.members[-1]
        offset = member[2]
        member[2] += len(data)
        member[3] = zlib.crc32(data, member[3])
        self._put(data)
        return offset

    def end(self):
        _, _, size, crc = self.members[-1]
        self._put(b"PK\x07\x08" + struct.pack("<IQQ", crc, size, size))

    def close(self):
        start = self.at
        for name, offset, size, crc in self.members:
            wide = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, size, size, offset)
            self._put(CENTRAL + struct.pack(
                "<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 33, crc, FULL32, FULL32, len(name), len(wide),
                0, 0, 0, 0, FULL32) + name + wide)
        size, n = self.at - start, len(self.members)
        end64 = self.at
        self._put(END64 + struct.pack("<QHHIIQQQQ", END64_SIZE - 12, 45, 45, 0, 0, n, n, size, start))
        self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        self._put(END + struct.pack("<HHHHIIH", FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))


# -- directory -------------------------------------------------------------------------

def members(src, size: int) -> dict[str, tuple[int, int, int]]:
    """Name to (offset of the local header, size, method), from the central directory.

    ``src`` is an open random-access file of ``size`` bytes; only its end is read.
    """
    tail_at = max(0, size - (END_SIZE + LOCATOR_SIZE + END64_SIZE + 0xFFFF))
    src.seek(tail_at)
    tail = src.read(size - tail_at)
    end = tail.rfind(END)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file, or cut off")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if tail[max(0, end - LOCATOR_SIZE):end][:4] == LOCATOR64:
        (end64,) = struct.unpack_from("<Q", tail, end - LOCATOR_SIZE + 8)
        src.seek(end64)
        wide = src.read(END64_SIZE)
        if wide[:4] != END64:
            raise ValueError("ZIP64 locator points elsewhere")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    src.seek(start)
    table, at, found = src.read(length), 0, {}
    for _ in range(count):
        if table[at:at + 4] != CENTRAL:
            raise ValueError("damaged central directory")
        (method,) = struct.unpack_from("<H", table, at + 10)
        packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", table, at + 20)
        (offset,) = struct.unpack_from("<I", table, at + 42)
        name = table[at + CENTRAL_SIZE:at + CENTRAL_SIZE + n_name].decode()
        extra = table[at + CENTRAL_SIZE + n_name:at + CENTRAL_SIZE + n_name + n_extra]
        packed, offset = _wide(extra, plain, packed, offset)
        found[name] = (offset, packed, method)
        at += CENTRAL_SIZE + n_name + n_extra + n_note
    return found


def _wide(extra: bytes, plain: int, packed: int, offset: int) -> tuple[int, int]:
    """Size and offset, from the ZIP64 field where the narrow ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == ZIP64_EXTRA:
            at += 4
            values = []
            for narrow in (plain, packed, offset):
                if narrow == FULL32:
                    (narrow,) = struct.unpack_from("<Q", extra, at)
                    at += 8
                values.append(narrow)
            return values[1], values[2]
        at += 4 + length
    return packed, offset


def member_data(src, offset: int) -> int:
    """Where the data of the member begins, from its local header."""
    src.seek(offset)
    head = src.read(LOCAL_SIZE)
    if head[:4] != LOCAL:
        raise ValueError("no local header where the directory points")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return offset + LOCAL_SIZE + n_name + n_extra


def stored_members(src, size: int) -> dict[str, tuple[int, int]]:
    """Name to (start of the data, size) of the members that can be read in place."""
    return {name: (member_data(src, offset), length)
            for name, (offset, length, method) in members(src, size).items() if method == 0}


# -- records ---------------------------------------------------------------------------

def parse_record(member: bytes) -> dict:
    """Headers and payload of one gzip member; the digest of a response is verified."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    number = {k: None if v == "None" else int(v) for k, v in fields.items()
              if k in ("X-Page-Id", "X-Refers-To-Page")}
    return {"page_id": number.get("X-Page-Id"), "url": fields.get("WARC-Target-URI"),
            "record_type": kind, "refers_to": number.get("X-Refers-To-Page"),
            "payload_bytes": length, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def with_revisits(pages: DataFrame, id: str = "page_id", payload: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``payload`` (UTF-8, null as empty), ``digest`` and
    ``refers_to``: the smallest id with the same payload of ``REVISIT_BYTES`` or more, null
    for that page itself and for smaller payloads. A page without an id refers to others
    but others never refer to it."""
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit("").cast("binary"))
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col(f"`{id}`").cast("long").alias("page_id"), url.cast("string").alias("url"),
                        body.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Only repeated digests matter; one row for each, so a very common page is one row.
    groups = (rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("digest", "first_id"))
    joined = attach(rows, groups, ["digest"], spread_by=["page_id"])
    return joined.withColumn("refers_to", F.when(
        F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id")),
        F.col("first_id"))).drop("first_id")


def write(pages: DataFrame, folder: str, id: str = "page_id", payload: str = "html",
          manifest: str | None = None) -> DataFrame:
    """Write the pages into packages below ``folder``, one for each task that has rows, and
    return the manifest (``package``, ``n_records``, ``package_bytes``), itself stored.

    Package names are unique for each attempt and count only once they stand in the
    manifest, so a task that is lost or run twice leaves no record behind twice.
    """
    def build(batches):
        name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip"
        out, package, lines = None, None, []
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        system, path = resolve(name)
                        out = system.open_output_stream(path)
                        package = Package(out)
                        package.begin(ARCHIVE)
                    data = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"],
                                        row["refers_to"])
                    lines.append(json.dumps({
                        "offset": package.add(data), "length": len(data), "page_id": row["page_id"]}))
            if out is not None:
                package.end()
                package.begin(INDEX)
                package.add("\n".join(lines).encode())
                package.end()
                package.close()
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({
                "package": [name], "n_records": [len(lines)], "package_bytes": [package.at]})

    spark = pages.sparkSession
    manifest = manifest or f"{scratch(spark, 'packages')}/manifest"
    ready = with_revisits(pages, id, payload)
    system, path = resolve(folder)
    system.create_dir(path, recursive=True)
    ready.mapInArrow(build, "package string, n_records long, package_bytes long").write.parquet(manifest)
    return spark.read.parquet(manifest)


def index(manifest: DataFrame) -> DataFrame:
    """Place of every record: ``package``, ``record``, ``at`` (in the package), ``length``.

    Reads the end of each package and its index member only.
    """
    def look(batches):
        for batch in batches:
            for name in batch.column("package").to_pylist():
                system, path = resolve(name)
                with system.open_input_file(path) as src:
                    found = stored_members(src, src.size())
                    start, length = found[INDEX]
                    src.seek(start)
                    lines = [json.loads(x) for x in src.read(length).splitlines()]
                base = found[ARCHIVE][0]
                yield pa.RecordBatch.from_pydict({
                    "package": [name] * len(lines), "record": list(range(len(lines))),
                    "at": [base + x["offset"] for x in lines], "length": [x["length"] for x in lines]},
                    schema=pa.schema([("package", pa.string()), ("record", pa.int64()),
                                      ("at", pa.int64()), ("length", pa.int64())]))

    return manifest.select("package").mapInArrow(
        look, "package string, record long, at long, length long")


def _runs(rows, limit: int):
    """Neighbouring records of a package, read together."""
    run = []
    for row in rows:
        if run and (row["package"] != run[0]["package"] or row["at"] != run[-1]["at"] + run[-1]["length"]
                    or row["at"] + row["length"] - run[0]["at"] > limit):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read(places: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records at the given places, by range reads."""
    fields = RECORDS if keep_payload else T.StructType([f for f in RECORDS if f.name != "payload"])

    def fetch(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(fields)
        for batch in batches:
            for run in _runs(batch.to_pylist(), RUN_BYTES):
                system, path = resolve(run[0]["package"])
                with system.open_input_file(path) as src:
                    src.seek(run[0]["at"])
                    data = src.read(run[-1]["at"] + run[-1]["length"] - run[0]["at"])
                out = []
                for row in run:
                    begin = row["at"] - run[0]["at"]
                    out.append({"package": row["package"], "record": row["record"],
                                **parse_record(data[begin:begin + row["length"]])})
                yield pa.RecordBatch.from_pylist(out, schema=shape)

    return places.mapInArrow(fetch, fields)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages into packages on shared storage and read their records back."""
    folder = scratch(spark, "warc")
    manifest = write(pages, f"{folder}/packages")
    return read(index(manifest), keep_payload=False)
