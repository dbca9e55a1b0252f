"""WARC records in ZIP packages.

A package is a ZIP of stored members: ``archive/data.warc.gz`` (one gzip member a record, so that a record can be
inflated alone) and ``indexes/index.cdx`` (a line a record: offset, length).  The reader parses the ZIP's central
directory, its ZIP64 forms included, locates the members and reads records by byte range; nothing is extracted.
Packages lie in the shared folder and are reached through Arrow's file systems by URI.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.llm.common import arrow_map, run_dir, table, written

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Payloads below this many bytes are never revisits.
LEAST_SHARED = 100
#: Bytes read at once when neighbouring records are wanted, and bytes of records in a package before the next begins.
RANGE = 4 << 20
PACKAGE = 256 << 20

# Fixed values of the ZIP format.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF

# ---------------------------------------------------------------- ZIP


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    stored_bytes: int
    header_at: int


class Package:
    """Directory and byte ranges of a ZIP, from ``read_at(offset, n)`` and its size."""

    def __init__(self, read_at: Callable[[int, int], bytes], size: int):
        self._read, self.size = read_at, size
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - (22 + MAX16))
        tail = self._read(tail_at, self.size - tail_at)
        at = tail.rfind(EOCD)
        while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(EOCD, 0, at)  # these bytes stood in the comment
        if at < 0:
            raise ValueError("not a ZIP package")
        n, length, start = struct.unpack_from("<HII", tail, at + 10)
        if n == MAX16 or length == MAX32 or start == MAX32:
            locator = self._read(tail_at + at - 20, 20)
            if locator[:4] != LOCATOR64:
                raise ValueError("the ZIP64 locator is missing")
            end = self._read(struct.unpack_from("<Q", locator, 8)[0], 56)
            if end[:4] != EOCD64:
                raise ValueError("the ZIP64 directory end is missing")
            n, length, start = struct.unpack_from("<QQQ", end, 32)
        raw, p = self._read(start, length), 0
        for _ in range(n):
            if raw[p : p + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            (method,) = struct.unpack_from("<H", raw, p + 10)
            packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, p + 20)
            (header_at,) = struct.unpack_from("<I", raw, p + 42)
            name = raw[p + 46 : p + 46 + n_name].decode()
            q, stop = p + 46 + n_name, p + 46 + n_name + n_extra
            while q + 4 <= stop:
                tag, k = struct.unpack_from("<HH", raw, q)
                if tag == 1:  # only the fields that overflowed, in this order
                    r = q + 4
                    if plain == MAX32:
                        r += 8
                    if packed == MAX32:
                        (packed,) = struct.unpack_from("<Q", raw, r)
                        r += 8
                    if header_at == MAX32:
                        (header_at,) = struct.unpack_from("<Q", raw, r)
                q += 4 + k
            yield Member(name, method, packed, header_at)
            p = stop + n_comment

    def data_at(self, name: str) -> tuple[int, int]:
        """First byte and length of a stored member's data."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self._read(m.header_at, 30)
        if head[:4] != LOCAL:
            raise ValueError("a local header is damaged")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return m.header_at + 30 + n_name + n_extra, m.stored_bytes

    def read(self, name: str, offset: int, length: int) -> bytes:
        first, size = self.data_at(name)
        if offset < 0 or offset + length > size:
            raise ValueError("the range isn't inside the member")
        return self._read(first + offset, length)


# ---------------------------------------------------------------- WARC


def _field(value: str) -> str:
    """A header's value on one line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c == "\x7f" else c for c in value)


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A gzip member with a response, or a revisit of the response of page ``refers_to``, which has no payload."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one gzip member."""
    z = zlib.decompressobj(31)
    raw = z.decompress(member) + z.flush()
    if not z.eof or z.unused_data:
        raise ValueError("the range isn't one gzip member")
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    n = int(headers["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return headers, rest[:n]


# ---------------------------------------------------------------- Spark

RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def classified(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to.

    Only digests are grouped; the payloads go to their digest's partition, and a hot digest's can be split.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    firsts = rows.where(F.octet_length("payload") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    refers = F.when(~F.coalesce(F.col("page_id") == F.col("first_id"), F.col("first_id").isNull()), F.col("first_id"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for each page; returns (path, records) of the packages.

    Payloads are html in UTF-8 (null: empty).  Of equal payloads of at least LEAST_SHARED bytes that with the
    smallest page_id is the response and the others revisit it; rows tied at that page_id are all responses, and a
    null page_id is never the smallest unless all are null, when all are responses.  Each attempt of a task writes
    files of its own, and the list, kept in the shared folder, names those of the attempts that ended.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        done: list[tuple[str, int]] = []
        out = None

        def close() -> None:
            nonlocal out
            data.close()
            with z.open(INDEX, "w", force_zip64=True) as f:
                f.write("".join(f"{o} {n}\n" for o, n in index).encode())
            z.close()
            out.close()
            done.append((name, len(index)))
            out = None

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.zip"
                    out = io.BufferedWriter(_Stream(fs.open_output_stream(f"{root}/{name}")), 1 << 20)
                    z = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
                    data = z.open(DATA, "w", force_zip64=True)
                    index, at = [], 0
                record = warc_record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                data.write(record)
                index.append((at, len(record)))
                at += len(record)
                if at >= PACKAGE:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["name", "records"])

    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)
    return written(arrow_map(classified(pages), run, "name string, records long"), "warc-packages")


class _Stream(io.RawIOBase):
    """An Arrow output stream as a plain unseekable one."""

    def __init__(self, stream):
        self._stream = stream

    def writable(self) -> bool:
        return True

    def write(self, b) -> int:
        self._stream.write(bytes(b))
        return len(b)

    def close(self) -> None:
        if not self.closed:
            self._stream.close()
        super().close()


def _ranges(index: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring records whose ranges are read at once."""
    own: list[tuple[int, int]] = []
    for offset, length in index:
        if own and (own[-1][0] + own[-1][1] != offset or offset + length - own[0][0] > RANGE):
            yield own
            own = []
        own.append((offset, length))
    if own:
        yield own


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the packages: RECORD_SCHEMA.

    payload_bytes and payload_digest of a response are taken from the bytes read, which must agree with its
    headers; those of a revisit are its headers', as its payload stands in the response that it refers to.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{name}") as f:
                    z = Package(lambda at, n, f=f: f.read_at(n, at), f.size())
                    lines = z.read(INDEX, 0, z.data_at(INDEX)[1]).decode().splitlines()
                    for group in _ranges([tuple(map(int, x.split())) for x in lines]):
                        first = group[0][0]
                        raw = z.read(DATA, first, group[-1][0] + group[-1][1] - first)
                        yield _rows(parse_record(raw[o - first : o - first + n]) for o, n in group)

    return arrow_map(packages.select("name").repartition(max(1, packages.count())), run, RECORD_SCHEMA)


def _rows(records) -> pa.RecordBatch:
    ids, sizes, digests, kinds, refers = [], [], [], [], []
    for h, body in records:
        size, digest = int(h["x-payload-length"]), h["warc-payload-digest"].removeprefix("sha256:")
        if h["warc-type"] == "response" and (size, digest) != (len(body), hashlib.sha256(body).hexdigest()):
            raise ValueError("a payload doesn't agree with its headers")
        ids.append(int(h["x-page-id"]) if "x-page-id" in h else None)
        sizes.append(size)
        digests.append(digest)
        kinds.append(h["warc-type"])
        refers.append(int(h["x-refers-to-page-id"]) if "x-refers-to-page-id" in h else None)
    columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(kinds, pa.string()), pa.array(refers, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{run_dir(spark)}/warc-{uuid.uuid4().hex}"
    return read_packages(write_packages(table(spark, sf_dir, "pages"), folder), folder)


OP9_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= {LEAST_SHARED} GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op9_warc_zip": op9_warc_zip}
ORACLE: dict[str, str] = {"op9_warc_zip": OP9_SQL}
