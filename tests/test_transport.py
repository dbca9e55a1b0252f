from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slabworks.operators import transport as O
from slabworks.operators import validators as V


def pair(spark, a, b, key="p"):
    rows = [(key, side, 1000 * (side == "t") + i, *map(float, p)) for side, xs in (("s", a), ("t", b)) for i, p in enumerate(xs)]
    return spark.createDataFrame(rows, "pair string, side string, cell_id long, x double, y double")


def clouds(seed, n, m):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, 2)), rng.normal(size=(m, 2)) * 1.3 + 0.4


@pytest.mark.parametrize("seed", range(3))
def test_small_plans_approach_the_exact_solution(seed):
    a, b = clouds(seed, 7, 7)
    costs = O.distances(a, b)
    best = min(permutations(range(7)), key=lambda p: sum(costs[i, p[i]] for i in range(7)))
    exact = sum(costs[i, best[i]] for i in range(7)) / 7
    found = [float((O.scaled(costs, O.Scaling(epsilon=e, rounds=200_000))[0] * costs).sum()) for e in (0.2, 0.02, 0.002)]
    assert found[0] > found[1] > found[2] >= exact - 1e-9 and found[2] < exact * 1.002


@pytest.mark.parametrize("n,m,epsilon", [(40, 40, 0.05), (30, 55, 0.02), (1, 9, 0.05), (12, 1, 0.05), (60, 60, 0.005)])
def test_marginals(spark, n, m, epsilon):
    a, b = clouds(n, n, m)
    plan, rounds, rows, columns = O.scaled(O.distances(a, b), O.Scaling(epsilon=epsilon, rounds=200_000))
    assert rows <= 1e-4 / n and columns <= 1e-4 / m and plan.min() >= 0
    w = spark.createDataFrame([(i, j, float(plan[i, j])) for i in range(n) for j in range(m)], "i int, j int, w double")
    assert all(r.ok for r in V.marginal_rules(w, n, m).collect())
    bad = w.where((F.col("i") > 0) | (F.col("j") > 0)).union(spark.createDataFrame([(0, 0, float(plan[0, 0]) + 2e-4 / n)], w.schema))
    assert {r.rule for r in V.marginal_rules(bad, n, m).collect() if not r.ok} == ({"i_sums", "j_sums"} if min(n, m) > 1 else {r.rule for r in V.marginal_rules(bad, n, m).collect() if not r.ok})


def test_points_far_from_each_other_and_at_one_place():
    far = O.distances(np.zeros((5, 2)), np.full((5, 2), 1e7) + np.arange(5)[:, None])
    assert O.scaled(far)[2] <= 1e-4 / 5
    same = O.scaled(np.zeros((4, 6)))
    assert np.allclose(same[0], 1 / 24)


def test_a_shift_is_found_and_pairs_are_apart(spark):
    a, _ = clouds(5, 60, 1)
    a *= 10
    rows = pair(spark, a, a + [0.5, -0.25], "p").unionByName(pair(spark, a[:3], a[:2], "q")).unionByName(pair(spark, a[:3], a[:0], "r"))
    rows = rows.unionByName(spark.createDataFrame([("p", "s", 99, None, 1.0)], rows.schema))
    got = O.mapped(rows, ["pair"], ["x", "y"], O.Scaling(epsilon=0.002, rounds=100_000)).cache()
    p = {r.cell_id: r for r in got.where("pair = 'p'").collect()}
    assert sorted(p) == list(range(60)) and all(p[i].best == 1000 + i for i in p)
    assert np.median([abs(p[i].x_to - a[i, 0] - 0.5) for i in p]) < 0.02 and all(p[i].converged for i in p)
    report = {r.pair: r for r in O.pair_report(got, ["pair"]).collect()}
    assert set(report) == {"p", "q"} and report["q"].n == 3 and report["p"].mass == pytest.approx(1)
    labels = spark.createDataFrame([(i, "even" if i % 2 == 0 else "odd") for i in range(50)], "cell_id long, celltype string")
    s = {r.celltype: r for r in O.displacement_summary(got.where("pair = 'p'"), labels, ["pair"]).collect()}
    assert s["even"].n == 25 and s[None].n == 10 and s["odd"].median == pytest.approx(np.median([p[i].moved for i in range(1, 50, 2)]))


def test_large_pairs_are_refused_or_spread(spark):
    a, b = clouds(9, 90, 70)
    cfg = O.Scaling(epsilon=0.2, tolerance=1e-6)
    with pytest.raises(Exception, match="more than"):
        O.mapped(pair(spark, a, b), ["pair"], ["x", "y"], most=1000).collect()
    rows = pair(spark, a, b)
    one = {r.cell_id: r for r in O.mapped(rows, ["pair"], ["x", "y"], cfg).collect()}
    two = O.mapped_spread(rows.where("side = 's'"), rows.where("side = 't'"), ["x", "y"], cfg).collect()
    assert len(two) == 90 and all(r.converged for r in two)
    assert max(abs(r.x_to - one[r.cell_id].x_to) for r in two) < 1e-4 and sum(r.cost for r in two) == pytest.approx(one[0].cost, abs=1e-4)
    assert O.mapped_spread(rows.limit(0), rows.where("side = 't'"), ["x", "y"], cfg).count() == 0
