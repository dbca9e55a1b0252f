import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabworks.functions import columns as C
from slabworks.operators import geometry, morphology, nearness, neighbours, registration, relational, review, windows
from slabworks.plans import dag
from slabworks.sources import files


def series(spark, values):
    return spark.createDataFrame([("d", i, "m", v) for i, v in enumerate(values)], "dataset_id string, slice_index int, metric string, value double")


def test_natural_keys_and_numbers(spark):
    df = spark.createDataFrame([("s10",), ("S2",), ("s2b",), ("none",)], "t string")
    assert [r.t for r in df.orderBy(C.natural_key(F.col("t"))).collect()] == ["none", "S2", "s2b", "s10"]
    assert {r.t: r.n for r in df.select("t", C.slice_number(F.col("t")).alias("n")).collect()} == {"s10": 10, "S2": 2, "s2b": 2, "none": None}


def test_local_expectation_by_hand(spark):
    got = {r.slice_index: r for r in windows.local_expected(series(spark, [1.0, 2.0, 50.0, 4.0, 5.0, None, 7.0]), 5).collect()}
    assert got[2].expected == pytest.approx(3.0) and got[2].two_sided and got[2].disagreement == pytest.approx(3.0)
    assert got[0].expected == pytest.approx(26.0) and not got[0].two_sided
    assert got[5].expected == pytest.approx(6.0)


def test_bilateral_loss_by_hand(spark):
    got = {r.slice_index: r.loss for r in windows.bilateral_loss(series(spark, [10.0, 12.0, 3.0, 8.0, 10.0, 0.0]), 5).collect()}
    assert got[2] == pytest.approx(1 - 3 / 9) and got[0] is None and got[5] is None and got[1] == 0


def test_anomaly_ignores_scale(spark):
    values = [100.0, 98.0, 103.0, 20.0, 101.0, 97.0, 102.0, 99.0]
    one, two = ({r.slice_index: r.score for r in windows.metric_anomaly(series(spark, [v * k for v in values]), 5, True, 0.25, 0.62).collect()} for k in (1, 7.5))
    assert one[3] > 0.8 and all(abs(one[i] - two[i]) < 1e-9 for i in one) and max(v for i, v in one.items() if i != 3) < 0.3


@pytest.mark.parametrize("theta", [0.3, -2.5, 3.0])
def test_rigid_fit_recovers(spark, theta):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 2))
    b = registration.turned(a, theta) + [9.0, -4.0]
    rows = [("g", *map(float, (*p, *q))) for p, q in zip(a, b)]
    r = geometry.rigid_fit(spark.createDataFrame(rows, "g string, x1 double, y1 double, x2 double, y2 double"), ["g"]).first()
    assert r.theta == pytest.approx(theta, abs=1e-9) and (r.tx, r.ty) == pytest.approx((9.0, -4.0)) and r.rmse < 1e-9


def two_blobs():
    rng = np.random.default_rng(5)
    return np.vstack([rng.normal(size=(160, 2)) * [1, 3], rng.normal(size=(100, 2)) * 0.7 + [6, 4]])


def frame(spark, slices, labels=None):
    rows = [("d", i, 10_000 * i + j, float(p[0]), float(p[1]), None if labels is None else labels[i][j]) for i, xy in enumerate(slices) for j, p in enumerate(xy)]
    return spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double, celltype string")


def test_series_is_composed_from_the_middle(spark):
    blob = two_blobs()
    angles = [0.5, 0.3, 0.0, 0.2, 0.4]  # steps from which closest points settle exactly
    slices = [registration.turned(blob, a) + [3 * i, -i] for i, a in enumerate(angles)]
    got = {r.slice_index: r for r in registration.register_series(frame(spark, slices)).collect()}
    assert [got[i].place for i in range(5)] == [-2, -1, 0, 1, 2] and [got[i].parent for i in range(5)] == [1, 2, None, 2, 3]
    for i, r in got.items():
        back = registration.turned(slices[i], r.theta) + [r.tx, r.ty]
        assert np.abs(back - slices[2]).max() < 0.05
        assert r.status == ("reference" if i == 2 else "estimated") and not r.warnings and r.frame_id.startswith("display:d:")
    assert got[0].two_step_residual < 0.02 and got[1].two_step_residual is None
    again = registration.register_series(frame(spark, slices).repartition(7)).select("frame_id").first()
    assert again.frame_id == got[0].frame_id


def test_failures_and_doubts_are_passed_on(spark):
    blob = two_blobs()
    line = np.column_stack([np.arange(60.0), np.zeros(60)])
    wide = registration.turned(blob, 0.4) * 2.5
    bad = {r.slice_index: r for r in registration.register_series(frame(spark, [blob, line, blob, blob, blob, wide, blob])).collect()}
    assert bad[3].status == "reference" and bad[2].status == "estimated"
    assert bad[1].status == "failed" and "fit_failed" in bad[1].warnings
    assert bad[0].status == "blocked" and "failed_reference_chain" in bad[0].warnings
    assert bad[5].status == "warning" and "low_geometric_overlap" in bad[5].warnings
    assert bad[6].status == "warning" and "uncertain_reference_chain" in bad[6].warnings
    lost = registration.register_series(frame(spark, [blob, line, blob])).collect()
    assert {r.slice_index: r.status for r in lost} == {0: "blocked", 1: "failed", 2: "blocked"}


def test_registration_warns_of_doubtful_fits():
    rng = np.random.default_rng(8)
    half = rng.normal(size=(80, 2)) * [3, 1]
    even = np.vstack([half, -half])  # looks the same after half a turn
    turned = registration.register(registration.turned(even, 0.4), even)
    assert turned["ambiguity"] < 1.05 and turned["residual"] < 0.08 and turned["warnings"] == ["orientation_ambiguous"]
    side = np.array(["l"] * 80 + ["r"] * 80)
    named = registration.register(registration.turned(even, 0.4), even, side, side, registration.Fit(annotation=0.5))
    assert named["status"] == "estimated" and named["theta"] == pytest.approx(-0.4, abs=0.02) and named["annotation"] < 0.01
    plain = registration.register(even, even, None, None, registration.Fit(annotation=0.5))
    assert "annotation_support_unavailable" in plain["warnings"]
    loose = registration.register(half * 4, half)
    assert loose["residual"] > 0.08 and "low_geometric_overlap" in loose["warnings"]
    assert registration.register(half[:19], half)["status"] == "failed"
    blob = np.vstack([half, rng.normal(size=(60, 2)) * 0.5 + [6, 4]])
    assert registration.register(registration.turned(blob, 0.4), blob)["status"] == "estimated"


@pytest.mark.parametrize("kind", ["even", "lumps", "line", "same", "far"])
def test_grid_neighbours_are_exact(kind):
    rng = np.random.default_rng(3)
    p = {"even": rng.uniform(size=(300, 2)), "lumps": np.vstack([rng.normal(size=(150, 2)) * 1e-3, rng.normal(size=(150, 2)) * 5]), "line": np.column_stack([np.arange(90.0), np.zeros(90)]), "same": np.ones((40, 2)), "far": np.vstack([rng.uniform(size=(80, 2)), [[1e6, -1e6]]])}[kind]
    q = np.vstack([p[::7], p.min(axis=0) - 3, p.max(axis=0) + 50])
    for own, x in ((True, p), (False, q)):
        at, far = nearness.Grid(p).nearest(x, 5, own=own)
        d = np.sqrt(((x[:, None] - p[None]) ** 2).sum(axis=2))
        if own:
            d[np.arange(len(p)), np.arange(len(p))] = np.inf
        assert np.allclose(far, np.sort(d, axis=1)[:, :5])
        assert np.allclose(far, np.take_along_axis(d, at, axis=1)) and all(len(set(r)) == 5 for r in at.tolist())


def test_nearest_between_is_exact_where_density_varies(spark):
    rng = np.random.default_rng(6)
    xy = np.vstack([rng.normal(size=(60, 2)) * 0.01, rng.uniform(-50, 50, size=(40, 2))])
    rows = [("a", i, *map(float, p)) for i, p in enumerate(xy)] + [("b", 500, 0.0, 0.0), ("b", 501, 1.0, 1.0), ("c", 600, 0.0, 0.0), ("b", 502, None, 1.0)]
    df = spark.createDataFrame(rows, "s string, cell_id long, x double, y double")
    got = {}
    for r in relational.nearest(df, 4, ["s"]).collect():
        got.setdefault(r.cell_id, []).append((r.rank, r.other))
    d = ((xy[:, None] - xy[None]) ** 2).sum(axis=2)
    for i in range(100):
        want = sorted((d[i, j], j) for j in range(100) if j != i)[:4]
        assert [o for _, o in sorted(got[i])] == [j for _, j in want]
    assert got[500] == [(1, 501)] and got[501] == [(1, 500)] and 600 not in got and 502 not in got


@pytest.mark.parametrize("whole", [0, 16_384])
@pytest.mark.parametrize("own", [True, False])
def test_nearest_between_outliers_copies_and_lines(spark, monkeypatch, whole, own):
    monkeypatch.setattr(neighbours, "WHOLE", whole)
    monkeypatch.setattr(neighbours, "TILE", 8)
    monkeypatch.setattr(neighbours, "PROBES", 20)
    rng = np.random.default_rng(11)
    shapes = {"far": np.vstack([rng.normal(size=(150, 2)), [[1e7, -1e7], [-1e9, 3.0]]]), "copies": np.vstack([np.repeat([[1.0, 2.0]], 120, axis=0), rng.normal(size=(40, 2))]), "line": np.column_stack([np.zeros(130), np.round(rng.normal(size=130), 1)]), "grid": np.array([(i % 12, i // 12) for i in range(144)], float), "few": rng.normal(size=(3, 2)), 'a"|b': rng.normal(size=(30, 2))}
    rows, i = [], 0
    for g, xy in shapes.items():
        for p in xy:
            rows.append((g, 7, i, *map(float, p)))
            i += 1
    df = spark.createDataFrame([*rows, (None, 7, 9000, 0.0, 0.0), ("few", None, 9001, 0.0, 0.0), ("far", 7, 9002, math.nan, 0.0)], "s string, c int, cell_id long, x double, y double").repartition(3)
    probes = df
    if not own:
        rows_p = [(g, 7, 10_000 + j, *map(float, p)) for g, xy in shapes.items() for j, p in enumerate(np.vstack([xy[::3] + 0.05, [[50.0, 50.0], [0.0, -1e6]]]))]
        probes = spark.createDataFrame([*rows_p, ("nowhere", 7, 1, 0.0, 0.0)], "s string, c int, cell_id long, x double, y double")
    got = sorted((r.s, r.cell_id, r["rank"], r.other, r.d2) for r in relational.nearest_between(probes, df, 5, ["s", "c"], own=own).collect())
    want = []
    for g, _, c, x, y in rows if own else rows_p:
        near = sorted(((x - u) ** 2 + (y - v) ** 2, o) for h, _, o, u, v in rows if h == g and not (own and o == c))[:5]
        want += [(g, c, r, o, d) for r, (d, o) in enumerate(near, 1)]
    assert [x[:4] for x in got] == [x[:4] for x in sorted(want)] and [x[4] for x in got] == pytest.approx([x[4] for x in sorted(want)], rel=1e-12)


def test_low_depth():
    xy = np.array([(i, j) for i in range(20) for j in range(20)], float)
    counts = np.full(400, 200.0)
    patch = (np.abs(xy - 5) <= 2).all(axis=1)
    assert morphology.low_depth(xy, counts, 1.0) == (0.0, 0.0)
    counts[patch] = 10
    share, cluster = morphology.low_depth(xy, counts, 1.0)
    assert share == cluster == 25 / 400
    counts[-1] = 3
    assert morphology.low_depth(xy, counts, 1.0) == (26 / 400, 25 / 400)
    assert morphology.low_depth(xy[:13], counts[:13], 1.0) == (0.0, 0.0)


def test_even_sample_without_one_task(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 as v").repartition(5)
    got = sorted(r.v for r in relational.even_sample(df, ["v"], 13).collect())
    assert got == sorted({i * 999 // 12 for i in range(13)})
    assert relational.even_sample(df, ["v"], 1).first().v == 0 and relational.even_sample(df.limit(5), ["v"], 9).count() == 5 and relational.even_sample(df.limit(0), ["v"], 9).count() == 0
    assert sorted((r.v, r.i) for r in relational.numbered(df, ["v"], "i").collect()) == [(i, i) for i in range(1000)]


def test_components_and_hull():
    square = np.array([[0, 0], [0, 4], [4, 0], [4, 4], [1, 1], [2, 2]], float)
    assert morphology.hull_area(square) == 16 and morphology.hull_area(square[:2]) is None and morphology.hull_area(np.array([[0, 0], [1, 1], [2, 2.0]])) is None
    rng = np.random.default_rng(2)
    xy = rng.uniform(size=(200, 2))
    a, b = morphology.grid_neighbours(xy, 0.07)
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if d[i, j] <= 0.07}
    assert {(min(i, j), max(i, j)) for i, j in zip(a.tolist(), b.tolist())} == want and len(a) == len(want)
    label = morphology.components(200, a, b)
    parent = list(range(200))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in want:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    assert label.tolist() == [find(i) for i in range(200)]


def test_holes():
    grid = np.array([(i, j) for i in range(31) for j in range(31)], float)
    assert morphology.hole_fraction(grid, 1.0) == 0
    ring = grid[(np.abs(grid - 15) > 8).any(axis=1)]
    assert 0.05 < morphology.hole_fraction(ring, 1.0) < 0.3


def test_slice_components(spark):
    rows = [("d", 1, i, float(i % 10), float(i // 10)) for i in range(100)] + [("d", 1, 500 + i, 60.0 + i % 5, float(i // 5)) for i in range(25)] + [("d", 2, 900, None, 1.0)]
    got = {r.cell_id: r.rank for r in registration.slice_components(spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double"), 1.0, 50).collect()}
    assert {got[i] for i in range(100)} == {1} and {got[500 + i] for i in range(25)} == {0} and 900 not in got


def test_radius_pairs_with_edges_of_the_grid(spark):
    rng = np.random.default_rng(4)
    xy = np.round(rng.uniform(-2, 2, size=(150, 2)), 1)
    df = spark.createDataFrame([("s", i, *map(float, p)) for i, p in enumerate(xy)], "s string, cell_id long, x double, y double")
    got = {(r.a, r.b) for r in relational.radius_pairs(df, 0.3, ["s"]).collect()}
    assert got == {(i, j) for i in range(150) for j in range(i + 1, 150) if (xy[i][0] - xy[j][0]) ** 2 + (xy[i][1] - xy[j][1]) ** 2 <= 0.3 * 0.3}


def test_sampling_targets(spark):
    def targets(total, counts, **kw):
        rows = review.sampling_targets(spark.createDataFrame(list(counts.items()), "group string, n long"), total, **kw)
        return {r.group: r.target for r in rows.collect()}

    counts = {"a": 100, "b": 5000, "c": 20000, "d": 90}
    got = targets(3000, counts)
    # by hand: bases 100, 80, 80, 90 leave 2650, dealt as the roots of 4920 and 19920
    share = 2650 * math.sqrt(4920) / (math.sqrt(4920) + math.sqrt(19920))
    assert got == {"a": 100, "d": 90, "b": 80 + math.floor(share) + (share % 1 > 0.5), "c": 80 + math.floor(2650 - share) + (share % 1 < 0.5)}
    assert targets(10**6, counts) == counts
    assert targets(3000, counts, most=500) == {"a": 100, "b": 500, "c": 500, "d": 90}
    assert targets(100, counts) == {"a": 100, "b": 80, "c": 80, "d": 90}  # the least of each group goes first
    assert sum(targets(4000, {f"g{i}": 310 + 37 * i for i in range(30)}).values()) == 4000
    assert targets(5, {}) == {}


def test_recipe_is_replayed_in_order(spark):
    df = spark.createDataFrame([(1, 1, "k", 1.0, 0.0), (2, 2, None, 1.0, 0.0)], "cell_id long, slice_index int, celltype string, x double, y double")
    steps = [{"op": "rotate", "degrees": 90.0, "slices": [1]}, {"op": "translate", "dx": 1.0, "dy": 0.0}, {"op": "scale", "factor": 2.0, "celltypes": ["k"]}]
    got = {r.cell_id: (r.x, r.y) for r in geometry.apply_recipe(df, steps).collect()}
    assert got[1] == pytest.approx((2.0, 2.0)) and got[2] == pytest.approx((2.0, 0.0))
    with pytest.raises(ValueError):
        geometry.apply_recipe(df, [{"op": "shear"}])


def test_rigid_matrix_rules(spark):
    c, s = math.cos(0.4), math.sin(0.4)
    df = spark.createDataFrame([(c, -s, 1.0, s, c, 2.0), (c, s, 0.0, s, -c, 0.0), (2.0, 0.0, 0.0, 0.0, 2.0, 0.0), (None, 0.0, 0.0, 0.0, 1.0, 0.0)], "m00 double, m01 double, m02 double, m10 double, m11 double, m12 double")
    got = {r.rule: r.failed for r in relational.rule_table(df, geometry.rigid_matrix_rules()).collect()}
    assert got == {"finite": 1, "orthonormal": 2, "no_reflection": 3}


def test_expression_components_equal_svd(spark):
    rng = np.random.default_rng(8)
    x = rng.poisson(1.2, size=(30, 6)).astype(float)
    rows = [(i, f"g{j}", float(x[i, j])) for i in range(30) for j in range(6) if x[i, j]]
    scores, load = morphology.expression_components(spark.createDataFrame(rows, "cell_id long, gene string, value double"), 30, 3)
    centred = x - x.mean(axis=0)
    u, sv, vt = np.linalg.svd(centred, full_matrices=False)
    for r in scores.collect():
        assert np.allclose(np.abs(r.scores), np.abs((centred @ vt[:3].T)[r.cell_id]), atol=1e-8)


def test_matrix_market_trio(spark, tmp_path):
    (tmp_path / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%c\n2 2 4\n1 1 3\n2 1 1\n2 1 2\n1 2 0\n")
    (tmp_path / "features.tsv").write_text("G1\tone\tGene\nG2\ttwo\tGene\n")
    (tmp_path / "barcodes.tsv").write_text("AA\nBB\n")
    counts = files.read_exchange_matrix(spark, str(tmp_path))
    assert sorted(map(tuple, counts.collect())) == [("AA", "G1", 3.0), ("AA", "G2", 3.0)]
    at = spark.createDataFrame([("AA", 1.0, 2.0)], "barcode string, x double, y double")
    assert files.positioned(counts, at).count() == 2
    with pytest.raises(ValueError):
        files.positioned(counts, at.where("barcode = 'BB'"))


def test_damaged_matrices_are_errors(spark, tmp_path):
    def read(name, matrix, features="G1\n", barcodes="AA\n"):
        folder = tmp_path / name
        folder.mkdir()
        for file, text in (("matrix.mtx", matrix), ("features.tsv", features), ("barcodes.tsv", barcodes)):
            (folder / file).write_text(text)
        return files.read_exchange_matrix(spark, str(folder)).collect()

    assert [tuple(r) for r in read("one", "%%MatrixMarket\n1 1 1\n1 1 1\n")] == [("AA", "G1", 1.0)]
    assert len(read("same", "2 2 2\n2 2 2\n1 1 5\n", "G1\nG2\n", "AA\nBB\n")) == 2  # an entry that equals the size line
    for name, matrix in (("short", "1 1 2\n1 1 1\n"), ("empty", ""), ("torn", "1 1 1\n1 1\n"), ("outside", "1 1 1\n1 2 4\n"), ("words", "1 1 1\n1 1 x\n")):
        with pytest.raises(Exception, match="matrix"):
            read(name, matrix)
    with pytest.raises(ValueError, match="names"):
        read("names", "2 1 1\n1 1 1\n")


def test_points_and_wide_counts(spark, tmp_path):
    (tmp_path / "p.csv").write_text("cell_id,slice_id,x,y\nc1,s1,1.5,2\nc2,s1,bad,3\n")
    assert [(r.cell_id, r.x) for r in files.read_points(spark, f"{tmp_path}/p.csv").orderBy("cell_id").collect()] == [("c1", 1.5), ("c2", None)]
    with pytest.raises(ValueError):
        files.read_points(spark, f"{tmp_path}/p.csv", ("cell_id", "z"))
    (tmp_path / "w.csv").write_text("cell,g.1,g2\na,0,2\nb,1,0\n")
    assert sorted(map(tuple, files.read_wide_counts(spark, f"{tmp_path}/w.csv", "cell").collect())) == [("a", "g2", 2.0), ("b", "g.1", 1.0)]
    order = files.slice_order_from_paths(spark.createDataFrame([("x/CS12_SL10_Y1.Spatial.h5",), ("x/CS12_SL2_Y1.Spatial.h5",), ("x/other",)], "path string"))
    assert [(r.sl_number, r.place) for r in order.orderBy("place").collect()] == [(2, 1), (10, 2)]


def test_publish_never_overwrites(spark, tmp_path):
    df = spark.range(20)
    path = f"file://{tmp_path}/t"
    assert files.publish(df, path) == {"rows": 20} and spark.read.parquet(path).count() == 20
    with pytest.raises(FileExistsError):
        files.publish(df, path)
    files.append_records(df.limit(2), f"{tmp_path}/h")
    files.append_records(df.limit(1), f"{tmp_path}/h")
    assert spark.read.json(f"{tmp_path}/h").count() == 3


def test_dag_reuses_recomputes_and_blocks(spark, tmp_path):
    runs = []

    def build(name, fail=False):
        def f(df, **kw):
            runs.append(name)
            if fail:
                raise RuntimeError("no")
            return df.withColumn(name, F.lit(kw.get("k", 0)))

        return f

    def stages(k):
        return [dag.Stage("a", build("a"), ("in",)), dag.Stage("b", build("b"), ("a",), {"k": k}), dag.Stage("c", build("c"), ("b",)), dag.Stage("bad", build("bad", True), ("a",)), dag.Stage("after", build("after"), ("bad",))]

    store = f"file://{tmp_path}/store"
    first = dag.execute(spark, stages(1), {"in": spark.range(3)}, store)
    assert [first[s]["state"] for s in ("a", "b", "c", "bad", "after")] == ["computed", "computed", "computed", "failed", "blocked"]
    again = dag.execute(spark, stages(1), {"in": spark.range(3)}, store)
    assert [again[s]["state"] for s in ("a", "b", "c")] == ["reused"] * 3
    other = dag.execute(spark, stages(2), {"in": spark.range(3)}, store)
    assert [other[s]["state"] for s in ("a", "b", "c")] == ["reused", "computed", "computed"] and other["c"]["table"].first().b == 2
    moved = dag.execute(spark, stages(1)[:1], {"in": spark.range(4)}, store)
    assert moved["a"]["state"] == "computed"
    with pytest.raises(ValueError):
        dag.plan([dag.Stage("x", build("x"), ("nowhere",))], {})
