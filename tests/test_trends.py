import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabworks.operators import statistics as S
from slabworks.operators import trends as D


def by_hand(x, y):
    """Log-likelihood of the spline by Newton's method on another basis of the same functions, and of the constant."""
    k = [x.min(), np.median(np.unique(x)), x.max()]
    d = lambda i: (np.maximum(x - k[i], 0) ** 3 - np.maximum(x - k[2], 0) ** 3) / (k[2] - k[i])
    b = np.column_stack([np.ones(len(x)), x, d(0) - d(1)])
    b = np.linalg.qr(b)[0]
    ll = lambda c: (y * (b @ c) - (y + 1) * np.logaddexp(0, b @ c)).sum()
    c = np.linalg.lstsq(b, np.full(len(x), math.log(y.mean())), rcond=None)[0]
    for _ in range(200):
        m = np.exp(b @ c)
        step = np.linalg.solve(b.T @ (b * ((y + 1) * m / (1 + m) ** 2)[:, None]), b.T @ ((y - m) / (1 + m)))
        while ll(c + step) < ll(c) - 1e-12:
            step = step / 2
        c = c + step
        if np.abs(step).max() < 1e-9 * np.abs(c).max():
            break
    m = y.mean()
    return ll(c), (y * math.log(m / (1 + m)) - math.log(1 + m)).sum()


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    x = np.round(rng.gamma(2, 2, 300), 2)
    y = {"flat": rng.poisson(3, 300), "rising": rng.poisson(np.exp(0.4 * x)), "hump": rng.poisson(8 * np.exp(-((x - 4) ** 2))), "rare": (np.arange(300) % 97 == 7) * 5, "scaled": rng.poisson(2, 300) * 1.7}
    return x, {g: v.astype(float) for g, v in y.items()}


@pytest.mark.parametrize("block", [64, 4096])
def test_trends_equal_newton_by_hand(spark, data, monkeypatch, block):
    x, y = data
    monkeypatch.setattr(D, "CELLS", block)
    cells = spark.createDataFrame([(i, float(v), "c") for i, v in enumerate(x)] + [(1000, None, "c"), (1001, math.nan, "c")], "cell_id long, t double, gene string")
    rows = [(i, g, float(v)) for g, vs in y.items() for i, v in enumerate(vs)]
    rows += [(1000, "flat", 50.0), (1001, "flat", 50.0), (5000, "flat", 9.0), (1000, "ghost", 1.0)]
    twice = [r for r in rows if r[1] != "hump"] + [(i, "hump", v / 2) for i, g, v in rows if g == "hump" for _ in range(2)]
    got = {r.gene: r for r in D.spline_trends(cells, spark.createDataFrame(twice, "cell_id long, gene string, value double"), "t").collect()}
    assert set(got) == set(y)
    for g, v in y.items():
        full, null = by_hand(x, v)
        assert got[g].status == "ok" and got[g].cells == (v > 0).sum() and got[g].mean == pytest.approx(v.mean())
        assert got[g].llf_null == pytest.approx(null, abs=1e-6) and got[g].llf_full == pytest.approx(full, abs=1e-4)
        assert got[g].p == pytest.approx(math.exp(-max(0, full - null)), rel=1e-3)
    assert got["rising"].q < 1e-6 and got["hump"].q < 1e-6 and got["flat"].p > 0.01
    order = sorted(got.values(), key=lambda r: (r.p, r.gene))
    want, low = {}, 1.0
    for i, r in reversed(list(enumerate(order, 1))):
        low = min(low, r.p * 5 / i)
        want[r.gene] = low
    assert all(got[g].q == pytest.approx(want[g]) for g in got)
    assert set(r.gene for r in D.spline_trends(cells, spark.createDataFrame(rows, "cell_id long, gene string, value double"), "t", least_cells=5).collect()) == set(y) - {"rare"}


def test_curves_follow_the_fit(spark, data):
    x, y = data
    cells = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "cell_id long, t double")
    counts = spark.createDataFrame([(i, "hump", float(v)) for i, v in enumerate(y["hump"])], "cell_id long, gene string, value double")
    t = D.spline_trends(cells, counts, "t")
    knots = (float(x.min()), float(np.median(np.unique(x))), float(x.max()))
    c = sorted((r.x, r.mean) for r in D.fitted_curves(t, knots, 30).collect())
    b = t.first()
    assert len(c) == 30 and c[0][0] == knots[0] and c[-1][0] == pytest.approx(knots[2])
    assert np.allclose([m for _, m in c], np.exp(D.basis(np.array([v for v, _ in c]), *knots) @ [b.b0, b.b1, b.b2]))


def test_unfit_features_and_failures(spark, data):
    cells = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "cell_id long, t double")
    counts = spark.createDataFrame([(1, "g", 1.0)], "cell_id long, gene string, value double")
    with pytest.raises(ValueError, match="distinct"):
        D.spline_trends(cells, counts, "t")
    cells = cells.withColumn("t", F.col("cell_id").cast("double"))
    assert D.spline_trends(cells, counts.limit(0), "t").count() == 0
    r = D.spline_trends(cells, counts, "t", rounds=1).first()
    assert (r.status, r.p, r.q) == ("fail", 1.0, 1.0) and r.ratio is None


def test_ranks_over_stretches(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(S, "STRETCH", 7)
    rows = [(f"g{i:03d}", "ab"[i % 2], None if i == 5 else float(rng.choice([0.001, 0.02, 0.5, 0.9])), float(rng.integers(0, 5))) for i in range(120)]
    df = spark.createDataFrame(rows, "gene string, family string, p double, v double").repartition(4)
    got = {r.gene: r.q for r in S.benjamini_hochberg(df, ["family"]).collect()}
    for f in "ab":
        own = sorted(((1.0 if p is None else p, g) for g, k, p, _ in rows if k == f), reverse=True)
        low = 1.0
        for i, (p, g) in enumerate(own):
            low = min(low, p * 60 / (60 - i))
            assert got[g] == pytest.approx(low)
    rank = lambda xs: np.array([(np.array(xs) < v).sum() + ((np.array(xs) == v).sum() + 1) / 2 for v in xs])
    for r in S.spearman(df, ["family"], "p", "v").collect():
        own = [(p, v) for _, k, p, v in rows if k == r.family and p is not None]
        assert r.n == len(own) and r.rho == pytest.approx(np.corrcoef(rank([a for a, _ in own]), rank([b for _, b in own]))[0, 1])
