import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabworks.operators import assembly, continuity, density, registration, resolvers, samples, simulation, statistics, validators, volume, workflow


def test_tier_problems():
    low = {"name": "low", "low": 0.129, "high": 0.54, "domains": 2, "severity": 0.65, "stability": 1.0, "confidence": 0.9, "detector": "candidate"}
    high = low | {"name": "high", "low": 0.54, "high": None, "severity": 0.6}
    assert validators.tier_problems([low, high], 0.129) == []
    assert validators.tier_problems([low, high | {"low": 0.6}], 0.129) == ["bands must be contiguous"]
    assert validators.tier_problems([low, high | {"severity": 0.65}], 0.129) == ["low: a lower band must ask for strictly more"]
    assert validators.tier_problems([low | {"severity": 0.5}, high], 0.129) == ["low: a lower band must ask for strictly more"]
    assert "names must be there and differ" in validators.tier_problems([low, high | {"name": "low"}], 0.129)
    assert "only the last band is open" in validators.tier_problems([low | {"high": None}, high], 0.129)
    assert "low: two to four domains" in validators.tier_problems([low | {"domains": 1}, high], 0.129) and "high: unknown detector mode" in validators.tier_problems([low, high | {"detector": "x"}], 0.129)


def test_settings_manifests_and_layouts():
    known = {"k": (int, 1, 9), "rate": (float, 0, 1), "on": bool, "name": str}
    assert validators.config_problems({"k": 3, "rate": 0.5, "on": True, "name": "x"}, known) == []
    assert validators.config_problems({"k": 30, "rate": "x", "on": 1, "other": 2}, known) == ["unknown key: other", "k: out of range", "on: wrong kind", "rate: wrong kind"]
    good = [{"slice": s, "basis": "b", "sha256": "0" * 64} for s in "ab"]
    assert validators.manifest_problems({"a", "b"}, good) == []
    assert validators.manifest_problems({"a", "b", "c"}, [*good, good[0] | {"basis": "c", "sha256": ""}]) == ["missing slice: c", "slice stands twice: a", "slices don't share a basis", "no digest: a"]
    assert validators.layout_problems({"a/b.txt", "c"}, ("a/", "c", "d/")) == ["d/"]
    assert validators.clean_table_problems(list(validators.CLEAN_HEADER)) == [] and len(validators.clean_table_problems(["x", "gene_a"])) == 2


def test_column_choices(spark):
    assert resolvers.count_layer(["raw", "counts"]) == "counts" and resolvers.count_layer(["z"]) == "X" and resolvers.count_layer(["z"], "z") == "z"
    with pytest.raises(ValueError):
        resolvers.count_layer(["z"], "y")
    assert resolvers.label_column(["cluster", "anno"]) == "anno" and resolvers.label_column(["q"]) is None
    assert resolvers.coordinate_columns(["x", "y", "raw_x", "raw_y"]) == ("raw_x", "raw_y") and resolvers.coordinate_columns(["a", "b", "x", "y"], ("a", "b")) == ("a", "b")
    with pytest.raises(ValueError):
        resolvers.coordinate_columns(["x"])
    df = spark.createDataFrame([(None, "x", float("nan")), (None, "y", 2.0)], "a double, b string, c double")
    assert resolvers.first_finite(df, ["q", "a", "b", "c"]) == "c" and resolvers.first_finite(df, ["q"]) is None
    assert resolvers.colour_kind(df, "b") == "categorical" and resolvers.colour_kind(spark.range(500), "id") == "numeric" and resolvers.colour_kind(spark.range(50), "id") == "categorical"
    with pytest.raises(ValueError):
        resolvers.colour_kind(df, "a")
    with pytest.raises(ValueError):
        resolvers.group_subset(df, "b", ["x", "nowhere"])
    for bad in (["a=x", "A=y"], ["a"]):
        with pytest.raises(ValueError):
            resolvers.category_selections(df, "b", bad, 1)


def test_paths_in_settings():
    assert resolvers.set_path({"a": {"b": 1}}, "a.c.d", 2) == {"a": {"b": 1, "c": {"d": 2}}}
    assert resolvers.set_path({"a": {"b": 1}}, "a.b", delete=True) == {"a": {}}
    before = {"a": {"b": 1}}
    resolvers.set_path(before, "a.b", 9)
    assert before == {"a": {"b": 1}}
    with pytest.raises(KeyError):
        resolvers.set_path({}, "a", delete=True)
    with pytest.raises(ValueError):
        resolvers.set_path({"a": 1}, "a.b", 2)


def test_rules_that_fail(spark):
    cells = spark.createDataFrame([("d", 1, 1, 0.0, 0.0, 0.0), ("d", 1, 1, 1.0, float("nan"), 0.5), ("d", 2, 3, 1.0, 1.0, 0.0), ("e", 1, None, 1.0, 1.0, 1.0)], "dataset_id string, slice_index int, cell_id long, x double, y double, z double")
    got = {(r.dataset_id, r.rule): r.failed for r in validators.alignment_preflight(cells).collect()}
    assert got == {("d", "two_slices"): 0, ("d", "unique_ids"): 1, ("d", "finite_xy"): 1, ("d", "constant_z"): 1, ("d", "rising_z"): 1, ("e", "two_slices"): 1, ("e", "unique_ids"): 1, ("e", "finite_xy"): 0, ("e", "constant_z"): 0, ("e", "rising_z"): 0}
    hot = spark.createDataFrame([(i, f"g{i % 3}", 1.0) for i in range(6)], "cell_id long, gene string, value double")
    assert {r.rule for r in validators.matrix_rules(hot, hot.select("cell_id")).where("not ok").collect()} == {"not_one_hot"}
    odd = spark.createDataFrame([(1, "a", -1.0), (2, "b", 0.5)], "cell_id long, gene string, value double")
    assert {r.rule for r in validators.matrix_rules(odd, odd.select("cell_id").union(spark.range(9, 10))).where("not ok").collect()} == {"large_enough", "non_negative", "whole_numbers", "positive_totals"}
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(5)], "p0 double, p1 double")
    assert {r.rule for r in validators.score_rules(line).where("not ok").collect()} == {"no_zero_rows", "rank_two"}
    plane = cells.where("dataset_id = 'd' and not isnan(y)").withColumn("z", F.lit(0.0))
    assert {r.rule for r in validators.cloud_rules(plane).where("not ok").collect()} == {"volume"} and validators.cloud_rules(plane, True).where("not ok").count() == 0
    plan = spark.createDataFrame([(0, 0, 0.5), (1, 1, 0.5)], "i int, j int, w double")
    assert validators.marginal_rules(plan, 2, 2).where("not ok").count() == 0 and validators.marginal_rules(plan, 3, 2).where("not ok").count() == 1
    rules, renamed = validators.feature_ids(spark.createDataFrame([("a", "E1"), ("b", "E1"), ("c", "")], "gene string, new_id string"))
    assert rules.first().failed == 2 and [tuple(r) for r in renamed.orderBy("symbol").collect()] == [("E1", "a"), ("E1", "b"), ("", "c")]


def test_missing_ids_are_errors(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    ids = spark.createDataFrame([(1, "a")], "k long, name string")
    with pytest.raises(Exception, match="not exactly one name"):
        workflow.mapped(rows, ids, "k", "name").collect()
    with pytest.raises(Exception, match="not exactly one name"):
        workflow.mapped(rows.where("k = 1"), ids.union(ids), "k", "name").collect()


def two_slices(spark, shift):
    rng = np.random.default_rng(4)
    xy = rng.uniform(size=(150, 2)) * [10, 3]
    rows = [("d", 0, i, *map(float, p + shift), "ab"[i % 2]) for i, p in enumerate(xy)] + [("d", 1, 1000 + i, *map(float, p), "ab"[i % 2]) for i, p in enumerate(xy)]
    return continuity.adjacent_pairs(spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double, celltype string"))


def test_block_translation_mends_a_shift(spark):
    r = continuity.block_translations(two_slices(spark, np.array([1.5, -0.4])), ["dataset_id", "boundary"]).first()
    assert r.accepted and r.multiplier == 1.0 and (r.dx, r.dy) == pytest.approx((-1.5, 0.4)) and r.score_after == pytest.approx(0, abs=1e-9)
    still = continuity.block_translations(two_slices(spark, np.zeros(2)), ["dataset_id", "boundary"]).first()
    assert not still.accepted and still.dx == 0 and still.score_after == still.score_before
    spread = continuity.cumulative_shifts(spark.createDataFrame([("d", 0, True, 1.0, 0.0), ("d", 2, True, 10.0, 1.0), ("d", 1, False, 5.0, 5.0)], "dataset_id string, boundary int, accepted boolean, dx double, dy double"))
    assert {r.place: (r.dx, r.dy) for r in spread.collect()} == {0: (11.0, 1.0), 1: (10.0, 1.0), 2: (10.0, 1.0)}


def test_terminal_score(spark):
    scores = spark.createDataFrame([("d", 0, 0.2), ("d", 1, 0.4)], "dataset_id string, boundary int, v2 double")
    lineage = spark.createDataFrame([("d", 0, "k", 0.5), ("d", 1, "q", 0.1)], "dataset_id string, boundary int, label string, distance double")
    r = continuity.terminal_scores(scores, lineage, ["dataset_id", "boundary"], ["dataset_id"], "k").first()
    assert r.score == pytest.approx(0.52 * 0.3 + 0.48 * 0.5)
    assert continuity.terminal_scores(scores, lineage, ["dataset_id", "boundary"], ["dataset_id"], "none").first().score == pytest.approx(0.3)
    assert continuity.mean_objective(scores, ["dataset_id"]).first().objective == pytest.approx(0.3)


def test_density_deficit(spark):
    grid = np.array([(i, j) for i in range(24) for j in range(24)], float)
    hole = grid[~((grid[:, 0] > 4) & (grid[:, 0] < 14) & (grid[:, 1] > 4) & (grid[:, 1] < 14))]
    found = density.largest_deficit(hole, [grid, grid], 1.5)
    assert 3 < found["x0"] < 8 and 10 < found["x1"] < 15 and found["ratio"] < 0.48 and density.largest_deficit(grid, [grid, grid], 1.5) is None and density.largest_deficit(grid, [grid], 1.5) is None
    rows = [("d", s, i, *map(float, p)) for s, xy in enumerate((grid, grid, hole, grid)) for i, p in enumerate(xy)]
    got = density.density_deficits(spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double"), 1.5).collect()
    assert [r.slice_index for r in got] == [2] and got[0].x0 == pytest.approx(found["x0"]) and got[0].deficit == pytest.approx(found["deficit"])


def test_voxel_parts_and_levels(spark):
    rng = random.Random(2)
    keys = np.array(sorted({(rng.randint(0, 6), rng.randint(0, 6), rng.randint(0, 6)) for _ in range(90)}))
    label = volume.connected(keys)
    at = {tuple(k): i for i, k in enumerate(keys.tolist())}
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, i in at.items():
        for axis in range(3):
            other = at.get(tuple(v + (j == axis) for j, v in enumerate(k)))
            if other is not None:
                parent[max(find(i), find(other))] = min(find(i), find(other))
    assert label.tolist() == [find(i) for i in range(len(keys))]
    ball = [p for p in np.random.default_rng(3).uniform(-1, 1, size=(1500, 3)) if np.linalg.norm(p) < 1]
    rows = [("a", *map(float, p)) for p in ball] + [("b", *map(float, p * 0.3)) for p in ball] + [("b", 5.0, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    got = {r.g: r for r in volume.levels(df, 0.15, 1.2, ["g"]).collect()}
    assert got["a"].met and got["a"].kept == 1 and got["a"].coverage >= 0.97 and got["b"].met and got["b"].coverage < 1
    with pytest.raises(ValueError, match="voxels"):
        volume.levels(df, 0.001, 1.2, ["g"])


def test_defects_that_are_unknown(spark):
    cells = spark.createDataFrame([("d", 1, i, float(i), float(i % 7)) for i in range(30)], "dataset_id string, slice_index int, cell_id long, x double, y double")
    counts = cells.select("cell_id", F.lit("g").alias("gene"), F.lit(10).cast("long").alias("value"))
    plan = spark.createDataFrame([("d", 1, "quake", 0.5, 0.5)], "dataset_id string, slice_index int, kind string, rate double, quantile double")
    with pytest.raises(Exception, match="unknown defect"):
        simulation.simulated(cells, counts, plan)[0].collect()
    thin = simulation.simulated(cells, counts, plan.withColumn("kind", F.lit("depth")))[1].agg(F.sum("value")).first()[0]
    assert 100 < thin < 200  # 300 counts at a rate of one half


def test_calls_must_pair(spark):
    a = spark.createDataFrame([("d", 1, 0.1, "keep")], "dataset_id string, slice_index int, score double, recommendation string")
    with pytest.raises(Exception, match="don't pair"):
        statistics.paired_calls(a, a.withColumn("slice_index", F.lit(2)), a.limit(0)).collect()


def test_root_stratified_takes_from_the_largest(spark):
    rows = spark.createDataFrame([(i, f"g{0 if i < 400 else i}") for i in range(430)], "cell_id long, g string")
    got = samples.root_stratified(rows, "g", 40, 3).groupBy("g").count().collect()
    assert sum(r["count"] for r in got) == 40 and len(got) == 31
    assert samples.root_stratified(rows.limit(20), "g", 40, 3).count() == 20 and samples.root_stratified(rows.limit(0), "g", 40, 3).count() == 0


def test_discovery_rates_by_hand(spark):
    df = spark.createDataFrame([("f", "a", 0.01), ("f", "b", 0.04), ("f", "c", 0.03), ("f", "d", None)], "family string, gene string, p double")
    got = {r.gene: r.q for r in statistics.benjamini_hochberg(df, ["family"]).collect()}
    assert got["a"] == pytest.approx(0.04) and got["c"] == pytest.approx(0.04 * 4 / 3) and got["b"] == pytest.approx(0.04 * 4 / 3) and got["d"] == 1
    tied = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0), (2.0, 9.0), (4.0, 9.0)], "x double, y double").withColumn("k", F.lit(1))
    x, y = [1.5, 1.5, 3, 4], [1, 2, 3.5, 3.5]
    assert statistics.spearman(tied, ["k"], "x", "y").first().rho == pytest.approx(float(np.corrcoef(x, y)[0, 1]))
    assert statistics.spearman(tied.withColumn("x", F.lit(1.0)), ["k"], "x", "y").first().rho is None


def test_settings_round_trip():
    value = {"a": (1, 2.5, "x"), "b": {"c": {3, 1}, "d": b"\x00\xff"}, "e": [None, True, {"f": float("nan")}]}
    back = assembly.unpacked_settings(assembly.packed_settings(value))
    assert back["a"] == value["a"] and back["b"] == value["b"] and back["e"][:2] == value["e"][:2] and back["e"][2]["f"] != back["e"][2]["f"]


def test_operations_get_ids_and_order():
    got = assembly.normalized_operations([{"op": "b", "order": 5}, {"op": "a", "operation_id": "mine"}])
    assert [(o["operation_id"], o["op"], o["order"]) for o in got] == [("mine", "a", 1), ("op_002", "b", 2)]
    with pytest.raises(ValueError):
        assembly.normalized_operations([{"operation_id": "x"}, {"operation_id": "x"}])


def test_group_alignment_and_repairs(spark):
    rng = np.random.default_rng(4)
    xy = rng.uniform(size=(150, 2)) * [10, 3]
    rows = [("d", s, 1000 * s + i, *map(float, p + [0.0 if s else 2.0, 0.0]), "k") for s in range(4) for i, p in enumerate(xy)]
    points = spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double, celltype string")
    fixed, log = assembly.repaired_in_passes(points)
    assert {r.boundary for r in log.collect() if r.accepted} == {0}
    assert fixed.groupBy("slice_index").agg(F.round(F.min("x"), 6).alias("m")).select("m").distinct().count() == 1
    better = assembly.before_and_after(points, fixed).collect()
    assert {r.boundary: r.improved for r in better} == {0: True, 1: False, 2: False}
    shifted = spark.createDataFrame([("g", s, float(a + (0.05 if s == "m" else 0)), float(b)) for s in "mf" for a, b in xy], "g string, side string, x double, y double")
    r = assembly.align_groups(shifted, ["g"]).first()
    assert r.status == "aligned" and r.tx == pytest.approx(-0.05, abs=1e-6) and r.after < 1e-9 < r.before
    with pytest.raises(ValueError, match="pairs"):
        assembly.pair_costs(points, points, 1000)


@pytest.mark.parametrize("seed", range(4))
def test_components_by_sets_and_far_points(seed):
    rng = np.random.default_rng(seed)
    xy = np.vstack([rng.normal(size=(60, 2)) * 3 + c for c in rng.uniform(-60, 60, (5, 2))] + [rng.uniform(-80, 80, (30, 2))])
    disc = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if i * i + j * j <= 4]
    cells = [tuple(c) for c in np.floor((xy - xy.min(axis=0)) / 2.0).astype(int)]
    wide = {(x + i, y + j) for x, y in cells for i, j in disc}
    mask = {c for c in wide if all((c[0] + i, c[1] + j) in wide for i, j in disc)}
    part = {}
    for start in sorted(mask):
        todo = [start] if start not in part else []
        while todo:
            c = todo.pop()
            if c in mask and c not in part:
                part[c] = start
                todo += [(c[0] + i, c[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    got = registration.detect(xy, 2.0)
    want = [part[c] for c in cells]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want)) and len(set(got)) > 3
    first = {}
    for g, w in zip(got, want):
        first[w] = g
    assert sorted(first) == sorted(first, key=first.get)  # numbered by their first bin
    far = registration.detect(np.vstack([xy, [[4e8, 9e8]]]), 2.0)
    assert (far[:-1] == got).all() and far[-1] not in got
    with pytest.raises(ValueError, match="too wide"):
        registration.detect(np.vstack([xy, [[1e18, 1e18]]]), 1e-3)


def test_densities_over_tiles_and_far_points(spark):
    rng = np.random.default_rng(5)
    xy = np.vstack([rng.normal(size=(300, 2)), rng.uniform(-30, 30, (200, 2)), [[1e6, -1e6]], [[0.0, 0.0]] * 5])
    rows = [("a", 1, i, float(x), float(y)) for i, (x, y) in enumerate(xy)] + [("a", 2, 900, 0.0, 0.0), ("a", 1, 901, None, 0.0), ("b", 1, 902, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double").repartition(3)
    got = {r.cell_id: r.density for r in density.point_densities(df, 0.3).collect()}
    assert len(got) == len(xy) + 2 and 901 not in got
    want = np.exp(-0.5 * ((xy[:, None] - xy[None]) ** 2).sum(axis=2) / 0.09).sum(axis=1) / (2 * np.pi * 0.09)
    assert np.allclose([got[i] for i in range(len(xy))], want, rtol=1e-9) and got[902] == got[900] == pytest.approx(1 / (2 * np.pi * 0.09))
    at = rng.uniform(-40, 40, (90, 2))
    near = np.exp(-0.5 * ((at[:, None] - xy[None]) ** 2).sum(axis=2) / 4).sum(axis=1) / (8 * np.pi)
    assert np.allclose(density.kernel_density(xy, at, 2.0), near, rtol=1e-9, atol=1e-15)
