"""Readers of platform files into long tables, and checked sinks."""

from __future__ import annotations

import base64
import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.session import ship

POINT_FIELDS = ("cell_id", "slice_id", "x", "y")
#: Names under which a coordinate or label may stand, in order of preference.
ALIASES = {
    "cell_id": ("cell_id", "cell", "barcode", "CellID", "obs_index"),
    "x": ("x", "X", "center_x", "x_coord", "xcoord"),
    "y": ("y", "Y", "center_y", "y_coord", "ycoord"),
    "celltype": ("celltype", "annotation", "anno", "lineage", "cluster"),
}


def first_present(columns: list[str], field: str) -> str | None:
    return next((c for c in ALIASES[field] if c in columns), None)


def read_points(spark: SparkSession, path: str, required: tuple[str, ...] = POINT_FIELDS) -> DataFrame:
    """A CSV of points; fails before reading on if a required column is missing."""
    df = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    number = [c for c in ("x", "y", "z") if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in number})


def read_exchange_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """A matrix-market trio (matrix.mtx, features.tsv, barcodes.tsv) as barcode, gene, value; duplicates summed, zeros dropped.

    The size line is the first line that is neither a comment nor blank, found by its place in the file.  A file whose
    lines, sizes or names don't agree with it is an error: before anything is returned for sizes and counts, while
    rows are read for a line that isn't an entry.
    """
    lines = spark.read.text(f"{folder}/matrix.mtx").select("value", F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i")).alias("at"))
    lines = lines.where(~F.col("value").startswith("%") & (F.trim("value") != ""))
    first = lines.agg(F.min("at").alias("at"), F.min_by("value", "at").alias("value"), F.count("*").alias("n")).first()
    size = [int(x) for x in (first.value or "").split()] if (first.value or "").replace(" ", "").replace("\t", "").isdigit() else []
    if len(size) != 3:
        raise ValueError("the matrix has no size line")
    if first.n - 1 != size[2]:
        raise ValueError(f"the matrix has {first.n - 1} entries instead of {size[2]}")
    part = F.split(F.trim("value"), r"\s+")
    entries = lines.where((F.col("at.block") != first["at"].block) | (F.col("at.i") != first["at"].i)).select("value", part.alias("p"))
    bad = lambda text: F.raise_error(F.lit(text))
    row, col, value = F.get("p", F.lit(0)).try_cast("long"), F.get("p", F.lit(1)).try_cast("long"), F.get("p", F.lit(2)).try_cast("double")
    good = (F.size("p") == 3) & row.between(1, size[0]) & col.between(1, size[1]) & value.isNotNull()
    rows = entries.select(F.when(F.coalesce(good, F.lit(False)), row).otherwise(bad("a line of the matrix is not an entry").cast("long")).alias("row"), col.alias("col"), value.alias("value"))

    def named(name: str, index: str, out: str, want: int) -> DataFrame:
        text = spark.read.text(f"{folder}/{name}", wholetext=True)
        line = text.select(F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), r"\r?\n")).alias("i", "line"))
        found = line.select((F.col("i") + 1).cast("long").alias(index), F.get(F.split("line", "\t"), F.lit(0)).alias(out))
        if (n := found.count()) != want:
            raise ValueError(f"{name} has {n} names instead of {want}")
        return found

    joined = rows.join(named("features.tsv", "row", "gene", size[0]), "row").join(named("barcodes.tsv", "col", "barcode", size[1]), "col")
    return joined.groupBy("barcode", "gene").agg(F.sum("value").alias("value")).where("value <> 0")


def read_wide_counts(spark: SparkSession, path: str, id_column: str) -> DataFrame:
    """A CSV with a column a gene as cell_id, gene, value without zeros."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    genes = [c for c in df.columns if c != id_column]
    long = df.select(F.col(id_column).cast("string").alias("cell_id"), *[F.col(f"`{g}`").cast("double").alias(g) for g in genes]).unpivot("cell_id", [F.col(f"`{g}`") for g in genes], "gene", "value")
    return long.where("value <> 0")


def positioned(counts: DataFrame, positions: DataFrame, key: str = "barcode") -> DataFrame:
    """Counts with coordinates by identity; a key without a position is an error, never matched by place."""
    lost = counts.select(key).distinct().join(positions.select(key), key, "left_anti")
    first = lost.limit(1).collect()
    if first:
        raise ValueError(f"{key} without a position: {first[0][0]}")
    return counts.join(positions, key)


def slice_order_from_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """stage, slice number and place within the stage, from names such as CS12_SL3_Y01.Spatial."""
    from pyspark.sql import Window

    pattern = r"(CS\d+)_SL(\d+)_(Y\w+)\.Spatial"
    out = paths.withColumn("stage", F.regexp_extract(column, pattern, 1)).where("stage <> ''").withColumn("sl_number", F.regexp_extract(column, pattern, 2).cast("int"))
    return out.withColumn("place", F.row_number().over(Window.partitionBy("stage").orderBy("sl_number", column)))


def entry_status(entries: DataFrame) -> DataFrame:
    """Per result: ok, pending, partial or failed from its entries' ready, deferred, unresolved, failed."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    total, ready, bad = F.count("*"), n("ready"), n("failed", "unresolved")
    status: Column = F.when(bad == total, "failed").when(bad > 0, "partial").when(ready == total, "ok").otherwise("pending")
    return entries.groupBy("result").agg(status.alias("status"), ready.alias("ready"), bad.alias("bad"), total.alias("entries"))


def publish(df: DataFrame, path: str, sort_by: list[str] | None = None) -> dict[str, int]:
    """Writes a new table and never over an old one: to a staging folder first, read back and compared, then renamed."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(staging)
    back = spark.read.parquet(staging)
    digest = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")).alias("h")).first()
    want, got = digest(df), digest(back)
    if (want.n, want.h) != (got.n, got.h):
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
        raise ValueError("the table read back differs")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), target):
        raise FileExistsError(path)
    return {"rows": got.n}


def append_records(records: DataFrame, path: str) -> None:
    """Adds JSON lines to an append-only history."""
    records.coalesce(1).write.mode("append").json(path)


def publish_json(spark: SparkSession, value: dict, path: str) -> None:
    """Writes a small JSON file that isn't there yet; one that is stays, and that is an error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True, indent=1).encode()))
    finally:
        out.close()


def publish_series(metrics: DataFrame, calls: DataFrame, folder: str) -> dict[str, int]:
    """Metrics, calls, what is withheld, and a summary, each by dataset, in a folder that must be new.

    Dataset ids become folder names, so ids that could lead elsewhere are refused.
    """
    bad = metrics.select("dataset_id").distinct().where(~F.col("dataset_id").rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")).limit(1).collect()
    if bad:
        raise ValueError(f"not a safe id: {bad[0][0]}")
    excluded = calls.where("call = 'exclude'")
    summary = calls.groupBy("dataset_id").agg(F.count("*").alias("slices"), F.count_if(F.col("call") == "exclude").alias("excluded"))
    out = {}
    for name, frame in (("metrics", metrics), ("calls", calls), ("withheld", excluded), ("summary", summary)):
        frame.write.mode("errorifexists").partitionBy("dataset_id").json(f"{folder}/{name}")
        out[name] = frame.sparkSession.read.json(f"{folder}/{name}").count()
    return out


def write_aligned(points: DataFrame, path: str) -> None:
    """Aligned coordinates as compressed CSV with ten decimals."""
    rows = points.select("cell_id", F.col("slice_index").cast("string").alias("slice_id"), F.col("celltype").alias("anno"), *[F.format_string("%.10f", c).alias(f"aligned_{c}") for c in "xy"])
    rows.write.mode("errorifexists").option("header", True).option("compression", "gzip").csv(path)


def publish_model(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Points, faces and other tables of a model; each is read back and compared row by row before the next is written."""
    out = {}
    for name, frame in tables.items():
        frame.write.mode("errorifexists").parquet(f"{folder}/{name}")
        back = frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/{name}")
        if frame.exceptAll(back).limit(1).count() or back.exceptAll(frame).limit(1).count():
            raise ValueError(f"{name} read back differs")
        out[name] = back.count()
    return out


def viewer_payload(points: DataFrame, columns: list[str], by: str = "slice_index") -> DataFrame:
    """(by, n, <column>...): a group's values as base64 of little-endian 32-bit floats, in order of cell_id; missing ones are NaN."""
    schema = f"{by} {points.schema[by].dataType.simpleString()}, n long, " + ", ".join(f"{c} string" for c in columns)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell_id")
        packed = {c: [base64.b64encode(pdf[c].to_numpy("<f4").tobytes()).decode()] for c in columns}
        return pd.DataFrame({by: [key[0]], "n": [len(pdf)]} | packed)

    ship(points.sparkSession)
    return points.select(by, "cell_id", *[F.col(c).cast("double").alias(c) for c in columns]).groupBy(by).applyInPandas(one, schema)
