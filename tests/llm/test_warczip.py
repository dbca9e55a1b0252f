import io
import struct
import zipfile

import pytest

from slabworks.llm import warczip
from tests.conftest import SF
from tests.llm.oracle import compare


def package(raw):
    return warczip.Package(lambda at, n: raw[at : at + n], len(raw))


def test_sql_agrees(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        assert compare(warczip.op9_warc_zip(spark, sf), warczip.OP9_SQL, sf) >= 50


@pytest.mark.parametrize("force", [False, True])
def test_directory_of_another_writer(force):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for i in range(30):
            with z.open(f"m{i}/é", "w", force_zip64=force) as f:
                f.write(b"%d" % i * 50)
        z.writestr("packed", "x" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it" + b" " * 40
    p = package(buf.getvalue())
    assert len(p.members) == 31 and p.read("m7/é", 10, 5) == b"77777"
    with pytest.raises(ValueError):
        p.read("packed", 0, 1)
    with pytest.raises(ValueError):
        p.read("m7/é", 40, 20)
    with pytest.raises(ValueError):
        package(b"no package at all" * 10)


def test_zip64_directory():
    """Every field that can overflow does."""
    data, name = b"hello range", b"archive/big"
    local = warczip.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    pad = b"\0" * 100
    extra = struct.pack("<HHB", 9, 1, 0) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), len(pad))
    central = warczip.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(pad) + len(local)
    end64 = warczip.EOCD64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = warczip.LOCATOR64 + struct.pack("<IQI", 0, at + len(central), 1)
    end = warczip.EOCD + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    p = package(pad + local + central + end64 + locator + end)
    assert p.read("archive/big", 6, 5) == b"range"


def test_many_members_need_zip64():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for i in range(70_000):
            z.writestr(str(i), b"")
    assert len(package(buf.getvalue()).members) == 70_000


def test_records_round_trip():
    h, body = warczip.parse_record(warczip.warc_record(5, "http://a/\r\nWARC-Type: x", b"a\r\n\r\nb", "00", None))
    assert body == b"a\r\n\r\nb" and h["warc-type"] == "response" and h["warc-target-uri"] == "http://a/%0D%0AWARC-Type: x"
    h, body = warczip.parse_record(warczip.warc_record(6, None, b"a" * 200, "00", 5))
    assert body == b"" and h["x-refers-to-page-id"] == "5" and h["x-payload-length"] == "200"
    with pytest.raises(ValueError):
        warczip.parse_record(warczip.warc_record(1, None, b"", "0", None) * 2)


def test_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warczip, "PACKAGE", 2000)
    same = "s" * 150
    rows = [(3, "u", same, 1), (9, None, same, 1), (3, "u", same, 1), (None, "u", same, 1), (4, "u", "short", 1), (5, "u", "short", 1), (6, "u", None, 1), (None, None, "n" * 120, 1), (None, None, "n" * 120, 1), (7, "é\n", "ü" * 50, 1), (8, "x", "y" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    folder = f"file://{tmp_path}/a"
    got = [tuple(r) for r in warczip.read_packages(warczip.write_packages(pages, folder), folder).select("page_id", "payload_bytes", "record_type", "refers_to").collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = [(3, 150, "response", None)] * 2 + [(9, 150, "revisit", 3), (None, 150, "revisit", 3), (4, 5, "response", None), (5, 5, "response", None), (6, 0, "response", None)]
    want += [(None, 120, "response", None)] * 2 + [(7, 100, "response", None), (8, 3_000_000, "response", None)]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert warczip.read_packages(warczip.write_packages(pages.limit(0), folder), folder).count() == 0
