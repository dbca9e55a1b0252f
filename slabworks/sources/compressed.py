"""Compressed sparse matrices (by row or by column) as parts of three arrays each, and a data source that reads only wanted lines.

A matrix is a folder of parts.  A part holds a range of its major lines: ``indptr.npy`` (where each line begins),
``indices.npy`` (minor positions) and ``data.npy``, the usual three arrays, and ``part.json`` (its first major line).
Arrays are plain NPY files of little-endian numbers and are read by byte range through Arrow's file systems.

Reading plans from the pointers: the wanted lines' runs of entries are joined where little lies between them, cut
where they are long, and each piece is a partition of Spark's, which reads its bytes of the two other arrays and nothing else.
"""

from __future__ import annotations

import ast
import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from slabworks.session import ship

#: Entries of a partition at most (a longer line is cut), and unwanted entries that are read over rather than leave a gap.
PIECE, GAP = 4_000_000, 16_384


@dataclass
class Array:
    """A one-dimensional NPY file, of which ranges are read."""

    fs: pafs.FileSystem
    path: str

    def __post_init__(self):
        with self.fs.open_input_file(self.path) as f:
            head = f.read(10)
            if head[:6] != b"\x93NUMPY":
                raise ValueError(f"{self.path} isn't an NPY file")
            n = struct.unpack("<H", head[8:10])[0] if head[6] == 1 else struct.unpack("<I", head[8:10] + f.read(2))[0]
            about = ast.literal_eval(f.read(n).decode("latin-1"))
            self.at, self.dtype = f.tell(), np.dtype(about["descr"])
        if len(about["shape"]) != 1 or self.dtype.hasobject:
            raise ValueError(f"{self.path} isn't an array of numbers in one dimension")
        self.size = about["shape"][0]

    def read(self, first: int, end: int) -> np.ndarray:
        with self.fs.open_input_file(self.path) as f:
            f.seek(self.at + first * self.dtype.itemsize)
            got = f.read((end - first) * self.dtype.itemsize)
        if len(got) != (end - first) * self.dtype.itemsize:
            raise ValueError(f"{self.path} is cut short")
        return np.frombuffer(got, self.dtype)


@dataclass
class Piece(InputPartition):
    """Entries first to end of a part, and the wanted lines among them with where each begins and ends."""

    part: str
    first: int
    end: int
    lines: list[int]
    starts: list[int]
    ends: list[int]


def pieces(part: str, base: int, indptr: np.ndarray, wanted: np.ndarray | None) -> Iterator[Piece]:
    """The pieces of one part: runs of its wanted lines (all, if None)."""
    own = np.arange(len(indptr) - 1) if wanted is None else np.unique(wanted[(wanted >= base) & (wanted < base + len(indptr) - 1)]) - base
    own = own[indptr[own] < indptr[own + 1]]
    lines, starts, ends = [], [], []
    for line in own:
        at, end = int(indptr[line]), int(indptr[line + 1])
        while at < end:
            if lines and (at - ends[-1] > GAP or at - starts[0] >= PIECE):
                yield Piece(part, starts[0], ends[-1], lines, starts, ends)
                lines, starts, ends = [], [], []
            room = PIECE if not lines else PIECE - (at - starts[0])
            step = min(end, at + room)
            lines.append(base + int(line))
            starts.append(at)
            ends.append(step)
            at = step
    if lines:
        yield Piece(part, starts[0], ends[-1], lines, starts, ends)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = np.array(json.loads(options["wanted"]), np.int64) if options.get("wanted") is not None else None

    def partitions(self) -> list[Piece]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        out = []
        for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda i: i.path):
            if info.type == pafs.FileType.Directory:
                with fs.open_input_file(f"{info.path}/part.json") as f:
                    base = json.loads(f.read())["first"]
                pointers = Array(fs, f"{info.path}/indptr.npy")
                if self.wanted is not None and not ((self.wanted >= base) & (self.wanted < base + pointers.size - 1)).any():
                    continue
                indptr = pointers.read(0, pointers.size).astype(np.int64)
                values, places = (Array(fs, f"{info.path}/{n}.npy") for n in ("data", "indices"))
                if not len(indptr) or indptr[0] != 0 or (np.diff(indptr) < 0).any() or indptr[-1] != values.size or places.size != values.size:
                    raise ValueError(f"{info.path} has pointers that don't fit its entries")
                out += pieces(info.path, base, indptr, self.wanted)
        return out or [Piece("", 0, 0, [], [], [])]  # no partition at all isn't allowed

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        if not piece.lines:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        minor, value = (Array(fs, f"{piece.part}/{n}.npy").read(piece.first, piece.end) for n in ("indices", "data"))
        starts, ends = np.array(piece.starts) - piece.first, np.array(piece.ends) - piece.first
        take = np.repeat(starts - np.concatenate([[0], np.cumsum(ends - starts)[:-1]]), ends - starts) + np.arange((ends - starts).sum())
        major = np.repeat(np.array(piece.lines, np.int64), ends - starts)
        yield pa.RecordBatch.from_arrays([pa.array(major), pa.array(minor[take].astype(np.int64)), pa.array(value[take].astype(np.float64))], names=["major", "minor", "value"])


class CompressedMatrix(DataSource):
    """Options: path (a URI), and wanted, a JSON list of major lines; none reads all of them."""

    @classmethod
    def name(cls) -> str:
        return "compressed_matrix"

    def schema(self) -> str:
        return "major long, minor long, value double"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_compressed(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """(major, minor, value) of a compressed matrix, of the wanted major lines only: lines that aren't there have no rows, repeated ones count once."""
    ship(spark)
    spark.dataSource.register(CompressedMatrix)
    out = spark.read.format("compressed_matrix").option("path", path)
    return (out if wanted is None else out.option("wanted", json.dumps(sorted({int(w) for w in wanted})))).load()


def write_compressed(entries: DataFrame, path: str, lines: int, parts: int) -> None:
    """Writes entries(major, minor, value) with major lines 0 to ``lines`` - 1 in parts of equal numbers of lines, a task each.

    A line's entries stand in the order of minor; repeated entries are an error, and so are lines outside the range.  A part that is written
    again, because its task was, is the same file again.
    """
    spark = entries.sparkSession
    ship(spark)
    each = max(1, -(-lines // parts))
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)

    def write(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fs, root = pafs.FileSystem.from_uri(path)
        base = int(key[0]) * each
        n = min(each, lines - base)
        pdf = pdf[pdf["major"] >= 0].sort_values(["major", "minor"])
        if pdf.duplicated(["major", "minor"]).any():
            raise ValueError("an entry stands twice")
        indptr = np.concatenate([[0], np.cumsum(np.bincount((pdf["major"] - base).to_numpy(), minlength=n))]).astype("<i8")
        folder = f"{root}/part-{int(key[0]):05d}"
        fs.create_dir(folder, recursive=True)
        for name, array in (("indptr", indptr), ("indices", pdf["minor"].to_numpy("<i8")), ("data", pdf["value"].to_numpy("<f8"))):
            with fs.open_output_stream(f"{folder}/{name}.npy") as f:
                np.lib.format.write_array_header_1_0(f, np.lib.format.header_data_from_array_1_0(array))
                f.write(np.ascontiguousarray(array).tobytes())
        with fs.open_output_stream(f"{folder}/part.json") as f:
            f.write(json.dumps({"first": base}).encode())
        return pd.DataFrame({"part": [int(key[0])], "entries": [len(pdf)]})

    inside = F.when((F.col("major") >= 0) & (F.col("major") < lines), F.col("major")).otherwise(F.raise_error(F.lit("a line is outside the matrix")).cast("long"))
    rows = entries.select(inside.cast("long").alias("major"), F.col("minor").cast("long").alias("minor"), F.col("value").cast("double").alias("value"))
    empty = spark.range(-(-lines // each)).select(F.lit(-1).cast("long").alias("major"), F.lit(0).cast("long").alias("minor"), F.lit(0.0).alias("value"), F.col("id").alias("part"))
    rows.withColumn("part", F.floor(F.col("major") / each)).unionByName(empty).groupBy("part").applyInPandas(write, "part int, entries long").count()
