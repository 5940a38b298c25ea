import hashlib
import io
import struct
import zipfile

from llm_data import SF
from oracle_compare import compare, duck
from pyarrow import BufferReader

from duelframe.llm import queries
from duelframe.llm import warc_zip as Z

SCHEMA = "page_id long, url string, html string, digest string"


def test_own_archives_read_by_zipfile():
    sink = io.BytesIO()
    keep = sink.close
    sink.close = lambda: None
    z = Z.StoredZip(sink)
    for name, parts in (("archive/a", [b"abc", b"", b"d" * 5000]), ("indexes/é", [b"x"])):
        z.begin(name)
        for p in parts:
            z.write(p)
        z.end()
    z.close()
    data = sink.getvalue()
    with zipfile.ZipFile(io.BytesIO(data)) as f:
        assert f.testzip() is None
        assert f.read("archive/a") == b"abc" + b"d" * 5000 and f.read("indexes/é") == b"x"
    for m in Z.directory(BufferReader(data), len(data)):
        assert data[m.offset:m.offset + m.size] == {"archive/a": b"abc" + b"d" * 5000, "indexes/é": b"x"}[m.name]
    keep()


def test_directory_of_zipfile_archives():
    for comment in (b"", b"PK\x05\x06 in a comment"):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as f:
            f.writestr("one", b"1" * 100)
            with f.open("two", "w", force_zip64=True) as m:
                m.write(b"22")
            f.comment = comment
        data = b"lead" * 0 + out.getvalue()
        if not comment:
            got = Z.directory(BufferReader(data), len(data))
            assert [(m.name, data[m.offset:m.offset + m.size]) for m in got] == [("one", b"1" * 100), ("two", b"22")]
        else:
            names = [m.name for m in Z.directory(BufferReader(data), len(data))]
            assert names == ["one", "two"]


def test_zip64_offsets_beyond_four_gigabytes():
    """A sparse source: the member and the directory lie behind 5 GB that are never read."""
    hole = 5 << 30
    name, body = b"archive/far", b"payload"
    local = Z.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 33, 0, len(body), len(body), len(name), 0) + name + body
    extra = struct.pack("<HHQ", 1, 8, hole)
    central = Z.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 33, 0, len(body), len(body), len(name),
                                      len(extra), 0, 0, 0, 0, Z.FULL32) + name + extra
    first = hole + len(local)
    end64 = Z.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), first)
    tail = local + central + end64 + Z.LOCATOR64 + struct.pack("<IQI", 0, first + len(central), 1) + Z.END + struct.pack(
        "<HHHHIIH", 0, 0, Z.FULL16, Z.FULL16, Z.FULL32, Z.FULL32, 0)

    class Sparse:
        def read_at(self, n, at):
            head = max(0, min(n, hole - at))
            return b"\0" * head + tail[max(0, at - hole):max(0, at + n - hole)]

    member, = Z.directory(Sparse(), hole + len(tail))
    assert member.offset == hole + 30 + len(name) and Sparse().read_at(member.size, member.offset) == body


def test_query_matches_sql(spark):
    assert not compare(queries.op6_warc_zip(spark, SF), duck(SF), queries.SQL["op6_warc_zip"])


def test_round_trip_of_odd_pages(spark):
    big = "x" * 999 + "é"
    rows = [(1, "http://a/\r\nX: y", big, "d"), (2, None, big, None), (3, "u", big, "d"), (3, "u", big, "d"),
            (4, "u", "short", "d"), (5, "u", "short", "d"), (6, None, None, None), (None, "u", big, "d"),
            (None, "u", "lone" * 500, "d"), (7, "", "", "d"), (8, "u", "WARC/1.1\r\n\r\n" * 300, "d"), (9, "ü漢", "a" * 3_000_000, "")]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    manifest = Z.write_archives(pages, archive_bytes=300)
    assert manifest.count() > 3  # full archives are followed by new ones
    records = Z.read_records(Z.record_ranges(manifest, range_bytes=500))
    got = Z.resolved(records).collect()
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        refers = 3 if data == big.encode() and page != 3 else None
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers else "response", refers, True))
    assert sorted(map(str, map(tuple, got))) == sorted(str(w) for w in want)
    stored = [bytes(r["payload"]) for r in records.where("record_type = 'response'").collect()]
    assert sorted(stored) == sorted((h or "").encode() for (p, _, h, _) in rows if h != big or p == 3)
    empty = Z.write_archives(spark.createDataFrame([], SCHEMA))
    assert Z.resolved(Z.read_records(Z.record_ranges(empty))).count() == 0
