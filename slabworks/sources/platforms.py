"""Readers of platform bundles: a point table and a long count table from each platform's text files, joined by id only.

A platform is a row in PLATFORMS: where its cells are, what their columns are called, and how its counts are laid out.
Bundles in HDF5 need a reader that isn't installed; they are found and reported as unresolved.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.sources.files import positioned, read_exchange_matrix, read_wide_counts


@dataclass(frozen=True)
class Platform:
    """cells: the cell file; names: its columns for cell_id, x and y; layout: mex, wide, long or transcripts; counts: the count file or folder."""

    cells: str | None
    names: tuple[str, str, str]
    layout: str
    counts: str
    columns: tuple[str, ...] = ()
    header: bool = True
    separator: str = ","


_POSITIONS = ("barcode", "in_tissue", "array_row", "array_col", "pxl_row_in_fullres", "pxl_col_in_fullres")

#: File and column names of the platforms' public formats.
PLATFORMS: dict[str, Platform] = {
    "10x_mtx": Platform(None, ("", "", ""), "mex", "."),
    "visium": Platform("spatial/tissue_positions.csv", ("barcode", "pxl_col_in_fullres", "pxl_row_in_fullres"), "mex", "filtered_feature_bc_matrix"),
    "visium_list": Platform("spatial/tissue_positions_list.csv", ("barcode", "pxl_col_in_fullres", "pxl_row_in_fullres"), "mex", "filtered_feature_bc_matrix", _POSITIONS, False),
    "xenium": Platform("cells.csv", ("cell_id", "x_centroid", "y_centroid"), "mex", "cell_feature_matrix"),
    "merfish": Platform("cell_metadata.csv", ("cell", "center_x", "center_y"), "wide", "cell_by_gene.csv", ("cell",)),
    "seqfish": Platform("cell_coordinates.csv", ("cell", "x", "y"), "wide", "counts.csv", ("cell",)),
    "nanostring": Platform("metadata_file.csv", ("cell_ID", "CenterX_global_px", "CenterY_global_px"), "wide", "exprMat_file.csv", ("cell_ID",)),
    "slideseq": Platform("bead_locations.csv", ("barcode", "xcoord", "ycoord"), "wide", "expression.csv", ("barcode",)),
    "starmap_plus": Platform("spatial.csv", ("NAME", "X", "Y"), "long", "counts.csv", ("NAME", "GENE", "COUNT")),
    "bgi": Platform(None, ("", "x", "y"), "transcripts", "matrix.gem", ("geneID", "x", "y", "MIDCount"), True, "\t"),
    "stereoseq": Platform(None, ("", "x", "y"), "transcripts", "stereo.gem", ("geneID", "x", "y", "MIDCount"), True, "\t"),
    "salus": Platform("barcodes_pos.tsv", ("barcode", "x", "y"), "mex", "matrix", ("barcode", "x", "y"), False, "\t"),
    "bmkmanu": Platform("barcodes_pos.tsv", ("barcode", "x", "y"), "mex", "L13_heAuto", ("barcode", "x", "y"), False, "\t"),
    "seekspace": Platform("cell_locations.tsv", ("barcode", "x", "y"), "mex", "filtered_feature_bc_matrix", (), True, "\t"),
    "singleron": Platform("spatial/tissue_positions.csv", ("barcode", "pxl_col_in_fullres", "pxl_row_in_fullres"), "mex", "filtered"),
}
#: Platforms whose public form is HDF5: named, so that a bundle of theirs is told apart from an unknown one.
CLOSED = {"h5ad": ".h5ad", "10x_h5": "filtered_feature_bc_matrix.h5", "visium_hd": "binned_outputs/", "atera": "atera.h5", "bgi_agg": ".gef", "seqscope": "seqscope.h5"}


def read_platform(spark: SparkSession, name: str, folder: str, bin_size: int = 50) -> tuple[DataFrame | None, DataFrame]:
    """(points, counts): points(cell_id, x, y), None for platforms without places, and counts(cell_id, gene, value).

    Transcripts are gathered into square bins of ``bin_size``.  A cell of the counts that has no place is an error.
    """
    if name not in PLATFORMS:
        raise ValueError(f"no text reader for {name}")
    p = PLATFORMS[name]
    reader = spark.read.option("header", p.header).option("sep", p.separator).option("comment", "#")
    if p.layout == "transcripts":
        t = reader.csv(f"{folder}/{p.counts}")
        missing = [c for c in p.columns if c not in t.columns]
        if missing:
            raise ValueError(f"missing columns: {', '.join(missing)}")
        gene, x, y, n = p.columns
        at = lambda c: F.floor(F.col(c).cast("double") / bin_size).cast("long")
        t = t.select(at(x).alias("gx"), at(y).alias("gy"), F.col(gene).alias("gene"), F.col(n).cast("long").alias("value"))
        t = t.withColumn("cell_id", F.concat_ws("_", "gx", "gy"))
        points = t.select("cell_id", ((F.col("gx") + 0.5) * bin_size).alias("x"), ((F.col("gy") + 0.5) * bin_size).alias("y")).distinct()
        return points, t.groupBy("cell_id", "gene").agg(F.sum("value").cast("double").alias("value"))
    if p.layout == "mex":
        counts = read_exchange_matrix(spark, f"{folder}/{p.counts}").select(F.col("barcode").alias("cell_id"), "gene", "value")
    elif p.layout == "wide":
        counts = read_wide_counts(spark, f"{folder}/{p.counts}", p.columns[0])
    else:
        cell, gene, n = p.columns
        counts = reader.csv(f"{folder}/{p.counts}").select(F.col(cell).alias("cell_id"), F.col(gene).alias("gene"), F.col(n).cast("double").alias("value")).where("value <> 0")
    if p.cells is None:
        return None, counts
    cells = reader.csv(f"{folder}/{p.cells}")
    if not p.header:
        cells = cells.toDF(*p.columns)
    missing = [c for c in p.names if c not in cells.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    own, x, y = p.names
    points = cells.select(F.col(own).cast("string").alias("cell_id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    positioned(counts.select("cell_id"), points, "cell_id")  # raises for a cell without a place
    return points, counts


def discover(spark: SparkSession, root: str, most_files: int = 100_000, most_bytes: int | None = None) -> DataFrame:
    """(result, entry, status, files, bytes) of the bundles below a folder, from a listing alone: nothing is opened.

    An entry is a folder that has all files of a platform.  It is deferred (readable when asked for), unresolved (a
    closed format), or failed if it is beyond the bounds on files or bytes.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length")
    base = listing.select(F.regexp_replace("path", r"^file:/+", "/").alias("path"), "length")
    rows = []
    for name, p in PLATFORMS.items():
        wanted = [f for f in (p.cells, f"{p.counts}/matrix.mtx" if p.layout == "mex" else p.counts) if f]
        wanted = [f.removeprefix("./") for f in wanted]
        rows += [(name, f, len(wanted)) for f in wanted]
    table = F.broadcast(spark.createDataFrame(rows, "platform string, tail string, need int"))  # a row a file of a platform
    hits = base.join(table, F.expr("endswith(path, concat('/', tail))")).withColumn("result", F.expr("substring(path, 1, length(path) - length(tail) - 1)"))
    found = hits.groupBy("result", F.col("platform").alias("entry")).agg(F.countDistinct("tail").alias("have"), F.first("need").alias("need"), F.count("*").alias("files"), F.sum("length").alias("bytes")).where("have = need")
    bounded = (F.col("files") > most_files) | (F.col("bytes") > (most_bytes if most_bytes is not None else 1 << 62))
    found = found.select("result", "entry", F.when(bounded, "failed").otherwise("deferred").alias("status"), "files", "bytes")
    closed = F.coalesce(*[F.when(F.col("path").endswith(t) | F.col("path").contains(f"/{t}"), n) for n, t in CLOSED.items()])
    other = base.withColumn("entry", closed).where("entry is not null").groupBy(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("result"), "entry").agg(F.lit("unresolved").alias("status"), F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return found.unionByName(other)


def convert(spark: SparkSession, kind: str, path: str, allowed: dict[str, type], **options) -> DataFrame:
    """A table by an explicit reader; options that aren't known, or of the wrong kind, are refused before anything is read."""
    for k, v in options.items():
        if k not in allowed:
            raise ValueError(f"unknown option: {k}")
        if not isinstance(v, allowed[k]):
            raise ValueError(f"{k}: wrong kind")
    return spark.read.format(kind).options(**options).load(path)


def scanned_columns(frame: DataFrame) -> dict[str, list[str]]:
    """Columns that a query reads of each file scan, from its plan: what it costs to run it."""
    out: dict[str, list[str]] = {}
    plan = frame._jdf.queryExecution().sparkPlan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        names = [leaf.output().apply(j).name() for j in range(leaf.output().size())]
        out.setdefault(leaf.nodeName() + f" {i}", []).extend(names)
    return out


