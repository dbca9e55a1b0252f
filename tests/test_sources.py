import base64

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabworks.sources import files, platforms

MATRIX = "%%MatrixMarket matrix coordinate integer general\n2 2 3\n1 1 3\n2 1 1\n2 2 5\n"


def mex(folder):
    folder.mkdir(parents=True)
    (folder / "matrix.mtx").write_text(MATRIX)
    (folder / "features.tsv").write_text("G1\tone\nG2\ttwo\n")
    (folder / "barcodes.tsv").write_text("AA\nBB\n")


def test_visium_and_a_barcode_without_a_place(spark, tmp_path):
    mex(tmp_path / "v" / "filtered_feature_bc_matrix")
    (tmp_path / "v" / "spatial").mkdir()
    place = tmp_path / "v" / "spatial" / "tissue_positions.csv"
    place.write_text("barcode,in_tissue,array_row,array_col,pxl_row_in_fullres,pxl_col_in_fullres\nAA,1,0,0,10,20\nBB,1,0,1,30,40\n")
    points, counts = platforms.read_platform(spark, "visium", str(tmp_path / "v"))
    assert sorted(map(tuple, points.collect())) == [("AA", 20.0, 10.0), ("BB", 40.0, 30.0)]
    assert sorted(map(tuple, counts.collect())) == [("AA", "G1", 3.0), ("AA", "G2", 1.0), ("BB", "G2", 5.0)]
    place.write_text("barcode,in_tissue,array_row,array_col,pxl_row_in_fullres,pxl_col_in_fullres\nAA,1,0,0,10,20\n")
    with pytest.raises(ValueError, match="without a position"):
        platforms.read_platform(spark, "visium", str(tmp_path / "v"))
    with pytest.raises(ValueError):
        platforms.read_platform(spark, "h5ad", str(tmp_path))


def test_wide_long_and_transcript_formats(spark, tmp_path):
    m = tmp_path / "m"
    m.mkdir()
    (m / "cell_metadata.csv").write_text("cell,center_x,center_y\nc1,1,2\nc2,3,4\n")
    (m / "cell_by_gene.csv").write_text("cell,g1,g2\nc1,0,2\nc2,1,0\n")
    points, counts = platforms.read_platform(spark, "merfish", str(m))
    assert points.count() == 2 and sorted(map(tuple, counts.collect())) == [("c1", "g2", 2.0), ("c2", "g1", 1.0)]
    s = tmp_path / "s"
    s.mkdir()
    (s / "spatial.csv").write_text("NAME,X,Y\na,0,1\n")
    (s / "counts.csv").write_text("NAME,GENE,COUNT\na,g,4\na,h,0\n")
    assert [tuple(r) for r in platforms.read_platform(spark, "starmap_plus", str(s))[1].collect()] == [("a", "g", 4.0)]
    b = tmp_path / "b"
    b.mkdir()
    (b / "matrix.gem").write_text("#comment\ngeneID\tx\ty\tMIDCount\ng\t1\t2\t3\ng\t49\t10\t1\nh\t51\t0\t2\n")
    points, counts = platforms.read_platform(spark, "bgi", str(b))
    assert sorted(map(tuple, counts.collect())) == [("0_0", "g", 4.0), ("1_0", "h", 2.0)] and sorted(map(tuple, points.collect())) == [("0_0", 25.0, 25.0), ("1_0", 75.0, 25.0)]


def test_discovery_opens_nothing(spark, tmp_path):
    mex(tmp_path / "one" / "filtered_feature_bc_matrix")
    (tmp_path / "one" / "spatial").mkdir()
    (tmp_path / "one" / "spatial" / "tissue_positions.csv").write_text("barcode\n")
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "x.h5ad").write_text("closed")
    found = {(r.result.split("/")[-1], r.entry, r.status) for r in platforms.discover(spark, str(tmp_path)).collect()}
    assert ("one", "visium", "deferred") in found and ("two", "h5ad", "unresolved") in found
    bounded = platforms.discover(spark, str(tmp_path), most_bytes=3).where("entry = 'visium'").first()
    assert bounded.status == "failed"
    status = files.entry_status(platforms.discover(spark, str(tmp_path)).withColumn("status", F.when(F.col("status") == "deferred", "deferred").otherwise(F.col("status"))))
    assert {r.status for r in status.where("result like '%two'").collect()} == {"failed"}


def test_convert_checks_its_options(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\n")
    got = platforms.convert(spark, "csv", f"{tmp_path}/t.csv", {"sep": str, "header": bool}, sep=";", header=True)
    assert got.columns == ["a", "b"]
    for bad in ({"other": 1}, {"sep": 3}):
        with pytest.raises(ValueError):
            platforms.convert(spark, "csv", f"{tmp_path}/t.csv", {"sep": str}, **bad)
    spark.range(5).selectExpr("id", "id as b", "id as c").write.parquet(f"{tmp_path}/p")
    assert list(platforms.scanned_columns(spark.read.parquet(f"{tmp_path}/p").where("b > 1").select("id")).values()) == [["id", "b"]]


def test_sinks_never_overwrite(spark, tmp_path):
    path = f"file://{tmp_path}/a.json"
    files.publish_json(spark, {"a": 1}, path)
    assert (tmp_path / "a.json").read_text().strip().startswith("{")
    with pytest.raises(FileExistsError):
        files.publish_json(spark, {}, path)
    metrics = spark.createDataFrame([("d1", 1, 2.0), ("d2", 1, 3.0)], "dataset_id string, slice_index int, n double")
    calls = spark.createDataFrame([("d1", 1, "exclude"), ("d2", 1, "keep")], "dataset_id string, slice_index int, call string")
    assert files.publish_series(metrics, calls, f"{tmp_path}/s") == {"metrics": 2, "calls": 2, "withheld": 1, "summary": 2}
    with pytest.raises(Exception, match="exists"):
        files.publish_series(metrics, calls, f"{tmp_path}/s")
    with pytest.raises(ValueError, match="safe"):
        files.publish_series(metrics.withColumn("dataset_id", F.lit("../x")), calls, f"{tmp_path}/t")
    assert files.publish_model({"vertices": metrics, "faces": calls}, f"{tmp_path}/m") == {"vertices": 2, "faces": 2}


def test_aligned_rows_and_payload(spark, tmp_path):
    p = spark.createDataFrame([(2, 1, "k", 0.1, 2.0), (1, 1, None, None, 5.0)], "cell_id long, slice_index int, celltype string, x double, y double")
    files.write_aligned(p.where("x is not null"), f"{tmp_path}/a")
    assert spark.read.option("header", True).csv(f"{tmp_path}/a").first().aligned_x == "0.1000000000"
    r = files.viewer_payload(p, ["x", "y"]).first()
    assert r.n == 2 and np.isnan(np.frombuffer(base64.b64decode(r.x), "<f4")[0]) and np.frombuffer(base64.b64decode(r.y), "<f4").tolist() == [5.0, 2.0]
