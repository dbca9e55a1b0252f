"""Slices whose points share places: results of single points, memory of different places."""

import resource

import numpy as np
import pytest

from slabworks.operators import morphology, nearness
from slabworks.operators.morphology import geometry_of, slice_geometry


def brute(xy, counts):
    """Neighbours by distance and then by order, from a full matrix."""
    n = len(xy)
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    positive = d.min(axis=1)[d.min(axis=1) > 0]
    mid = np.median(positive)

    def largest(d):
        label = np.arange(len(d))
        for _ in range(len(d)):
            label = np.minimum(label, np.where(d, label[None], len(d)).min(axis=1)).astype(int)
        return np.unique(label, return_counts=True)[1]

    parts = largest(d <= 3.25 * mid)
    depth = np.log1p(counts)
    off = depth - np.median(depth[np.argsort(d, axis=1, kind="stable")[:, :12]], axis=1)
    spread = 1.4826 * np.median(np.abs(off - np.median(off)))
    low = ((off - np.median(off)) / spread < -2.75) | (depth < np.median(depth) - np.log(2.5))
    return {"n": n, "nn_median": mid, "n_components": len(parts), "largest_component_fraction": parts.max() / n, "local_low_depth_fraction": low.mean(), "regional_low_depth_cluster_fraction": largest(d[low][:, low] <= 2.75 * mid).max() / n}


@pytest.mark.parametrize("blocks", [None, 64])
def test_shared_places_equal_single_points(spark, monkeypatch, blocks):
    rng = np.random.default_rng(4)
    xy = np.vstack([rng.integers(0, 14, (420, 2)) + rng.choice([0.0, 0.125], (420, 1), p=[0.9, 0.1]), np.repeat([[3.0, 3.0], [40.0, 40.0]], [30, 16], axis=0)])
    xy = xy[rng.permutation(len(xy))].astype(float)
    counts = np.where((xy < 4).all(axis=1) & (rng.random(len(xy)) < 0.8), 3.0, rng.integers(80, 120, len(xy)))
    if blocks:  # blocks of every kind are cut
        for name in ("PAIRS", "QUERIES", "HULL"):
            monkeypatch.setattr(morphology, name, blocks)
        monkeypatch.setattr(nearness, "BLOCK", 1_000)
        assert geometry_of(xy, counts) == pytest.approx(geometry_of(xy, counts) | brute(xy, counts), rel=1e-12)
        return
    frame = spark.createDataFrame([("a", 1, i, *map(float, p), float(c)) for i, (p, c) in enumerate(zip(xy, counts))] + [("a", 2, 7, None, 1.0, 1.0)], "dataset_id string, slice_index int, cell_id long, x double, y double, total_counts double")
    got = {r.slice_index: r.asDict() for r in slice_geometry(frame.repartition(3)).collect()}
    want = brute(xy, counts)
    assert 0 < want["local_low_depth_fraction"] < 1 and got[2]["n"] == 0 and got[2]["hull_area"] is None
    assert {k: got[1][k] for k in want} == pytest.approx(want, rel=1e-12)
    plain = slice_geometry(frame.drop("total_counts")).where("slice_index = 1").first().asDict()
    assert plain | {k: got[1][k] for k in got[1] if "depth" in k} == got[1] and plain["local_low_depth_fraction"] is None


def test_a_place_of_many_points_is_one_row(spark):
    points = spark.range(40_000).selectExpr("'a' as dataset_id", "1 as slice_index", "id as cell_id", "double(id % 4) as x", "double(id % 8 div 4) as y", "double(id % 2) as total_counts")
    assert morphology.kinds_of_points(points).count() == 8 * (13 + 1)
    assert morphology.kinds_of_points(points.drop("total_counts")).count() == 8
    row = slice_geometry(points).first()
    assert (row.n, row.hull_area, row.nn_median) == (40_000, 3.0, None)


def test_crowded_cells_are_compared_in_blocks():
    xy = np.vstack([np.zeros((6_000, 2)), [[1.0, 0.0], [1e3, 1e3]]])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    d = nearness.Grid(xy).nearest(xy, 1, own=True)[1][:, 0]
    assert (d[:6_000] == 0).all() and d[6_000] == 1.0
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300  # MB; 36 million distances are some gigabytes
