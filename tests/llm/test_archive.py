import hashlib
import io
import zipfile

import pytest

from framelake.llm import archive

BIG = "<html>" + "é" * 60 + "</html>"
PAGES = [(3, "http://a/\r\nx", BIG), (1, None, BIG), (2, "http://b", BIG), (4, "u", None), (5, "u", ""), (6, "u", "tiny"),
         (7, "u", "tiny"), (None, "u", BIG), (8, "u", "x" * 100), (9, "u", "x" * 100), (10, "u", "y" * 99),
         (11, "u", "y" * 99), (12, "u", "a\r\n\r\nb" * 40000)]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, digest string")
    folder = archive.scratch(spark, "test")
    manifest = archive.write(pages, f"{folder}/packages")
    rows = archive.read(archive.index(manifest)).collect()
    assert len(rows) == len(PAGES)
    by_id = {r.page_id: r for r in rows}
    for i, _, html in PAGES:
        body = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "").encode() == body and j is not None]
        first = min(same, default=None)
        r = by_id[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        again = len(body) >= 100 and first is not None and first != i
        assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
        assert r.payload == (None if again else body)
    # Any ZIP reader finds the members, stored as they are.
    with zipfile.ZipFile(archive.resolve(rows[0].package)[1]) as z:
        assert z.testzip() is None
        assert {m.filename for m in z.infolist()} == {archive.ARCHIVE, archive.INDEX}
        assert all(m.compress_type == zipfile.ZIP_STORED for m in z.infolist())
    assert archive.round_trip(spark, pages.limit(0)).count() == 0


def test_single_records(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    places = archive.index(archive.write(pages, f"{archive.scratch(spark, 'test')}/p"))
    some = archive.read(places.filter("record % 2 = 0").orderBy("at", ascending=False)).collect()
    assert len(some) == places.filter("record % 2 = 0").count()


def test_directory_of_other_writers():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("plain.txt", b"stored")
        z.writestr("packed.txt", b"deflated" * 50, zipfile.ZIP_DEFLATED)
        z.comment = b"note"
    data = out.getvalue()
    found = archive.stored_members(io.BytesIO(data), len(data))
    start, size = found.pop("plain.txt")
    assert data[start:start + size] == b"stored" and not found
    with pytest.raises(ValueError):
        archive.members(io.BytesIO(data[:-30]), len(data) - 30)


def test_damaged_payload_is_refused():
    record = archive.gzip.decompress(archive.record_bytes(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None))
    with pytest.raises(ValueError):
        archive.parse_record(archive.gzip.compress(record.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n")))
