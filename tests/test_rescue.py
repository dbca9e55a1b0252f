import math

import numpy as np
import pytest

from slabworks.operators import rescue as S


def series(spark, slices, labels=None, name="d"):
    rows = [(name, k, 10_000 * k + i, float(x), float(y), "a" if labels is None else labels[k][i]) for k, xy in enumerate(slices) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(rows, "dataset_id string, slice_index int, cell_id long, x double, y double, celltype string")


def moves(spark, rows, name="d"):
    return spark.createDataFrame([(name, p, float(t), float(x), float(y)) for p, t, x, y in rows], "dataset_id string, place int, theta double, tx double, ty double")


def tissue(n=120, seed=2):
    rng = np.random.default_rng(seed)
    return np.column_stack([rng.uniform(-10, 10, n), rng.uniform(-4, 4, n) * (1 + 0.05 * rng.normal(size=n))])


def test_the_smallest_share_that_passes_is_taken(spark):
    base = tissue()
    slices = [base, base + [3.0, 0], base, base]
    got = {r.place: r for r in S.fractional_rescues(series(spark, slices), moves(spark, [(1, 0, -3, 0), (2, 0, 4, 3), (3, 0, 1, 0), (9, 0, 1, 0)])).collect()}
    assert set(got) == {1, 2}  # the last slice has no next one, and there is no tenth
    one = got[1]
    assert one.accepted and one.share == 0.25 and one.best_share == 1.0 and one.tx == pytest.approx(-0.75) and one.score_after < one.score_before
    assert not got[2].accepted and got[2].share == 0 and got[2].score_after == got[2].score_before and got[2].gain == 0


def test_sparse_ends(spark):
    base = tissue(200)
    thin, away = base[:60], np.array([4.0, 0.0])
    cases = {
        "mended": ([base, base, base, base, thin + away], [(4, 0, -4, 0)], (True, True)),
        "many": ([base, base, base, base, base[:150] + away], [(4, 0, -4, 0)], (False, False)),
        "good": ([base, base, base, base, thin], [(4, 0, -1, 0)], (True, False)),
        "far": ([base, base, base, base, thin + away * 3], [(4, 0, -12, 0)], (True, False)),
        "turned": ([thin @ np.array([[0, -1], [1, 0]]), base, base, base, base], [(0, -math.pi / 2, 0, 0)], (True, None)),
        "inner": ([base, thin + away, base], [(1, 0, -4, 0)], None),
    }
    points = proposals = None
    for name, (slices, rows, _) in cases.items():
        p, m = series(spark, slices, name=name), moves(spark, rows, name)
        points, proposals = (p, m) if points is None else (points.unionByName(p), proposals.unionByName(m))
    got = {r.dataset_id: r for r in S.sparse_end_rescues(points, proposals).collect()}
    assert set(got) == set(cases) - {"inner"}
    for name, (_, _, want) in cases.items():
        if want:
            assert got[name].triggered == want[0] and (want[1] is None or got[name].accepted == want[1]), (name, got[name])
    assert got["mended"].share > 0 and got["mended"].ratio <= 0.25 and got["mended"].count_ratio == pytest.approx(0.3)
    t = got["turned"]
    assert not t.accepted or t.turn <= 20


def test_lineage_ends(spark):
    rng = np.random.default_rng(6)
    base = tissue(200)
    labels = [["core" if np.hypot(*p) < 4 else "rim" for p in base] for _ in range(5)]
    small = [list(x) for x in labels]
    small[4] = ["rare" if i < 5 else x for i, x in enumerate(small[4])]
    away = np.array([1.5, 0])
    good = series(spark, [base, base, base, base + away, base], labels, "good")
    none = series(spark, [base[:30]] * 5, [x[:30] for x in labels], "none")
    wild = series(spark, [base, base, base, base + away, base + rng.normal(size=base.shape) * 0.01], small, "wild")
    points = good.unionByName(none).unionByName(wild)
    proposals = moves(spark, [(3, 0, -1.5, 0), (4, 0, 5, 5)], "good").unionByName(moves(spark, [(3, 0.5, -1.5, 0)], "wild")).unionByName(moves(spark, [(3, 0, 0, 0)], "none"))
    got = {r.dataset_id: r for r in S.lineage_end_rescues(points, proposals).collect()}
    assert set(got) == {"good", "wild"}
    assert got["good"].label == "core" and got["good"].accepted and got["good"].lineage_after < 0.2 * got["good"].lineage_before and got["good"].turn == 0
    assert not got["wild"].accepted and got["wild"].turn == pytest.approx(math.degrees(0.5))
    assert {r.dataset_id: r.label for r in S.lineage_labels(points, 3, "rim").collect()} == {"good": "rim", "wild": "rim"}
    assert {r.dataset_id: r.label for r in S.lineage_labels(points, 3, "absent").collect()} == {"good": "core", "wild": "core"}


def test_chains_stop_at_gaps(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for name, edges in (("whole", range(2, 40)), ("gap", [1, 2, 3, 5, 6])):
        m = np.eye(3)
        for e in edges:
            t = rng.uniform(-1, 1)
            own = np.array([[math.cos(t), -math.sin(t), rng.normal()], [math.sin(t), math.cos(t), rng.normal()], [0, 0, 1]])
            m = m @ own
            rows.append((name, e, *own[:2].ravel().tolist()))
            want[name, e] = m[:2].ravel() if name == "whole" or e < 4 else None
    df = spark.createDataFrame(rows, "dataset_id string, edge int, " + ", ".join(f"m{i}{j} double" for i in (0, 1) for j in (0, 1, 2)))
    got = {(r.dataset_id, r.edge): r[2:] for r in S.chained_edges(df).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        assert (w is None and got[k][0] is None) or np.allclose(np.array(got[k], float), w)
