import math

import numpy as np
import pytest

from slabworks.llm import annforest
from tests.conftest import SF


def brute(rows, k, is_query):
    """(query, rank, vec_id, score) by a plain loop in double precision."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q in sorted({i for i, _ in ok if is_query(i)}):
        best = {}
        for i, v in ok:
            for j, w in ok:
                if i == q and j != q and len(v) == len(w):
                    a, b = np.array(v, float), np.array(w, float)
                    c = float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
                    best[j] = max(best.get(j, -2), c)
        out += [(q, r, j, c) for r, (j, c) in enumerate(sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k], 1)]
    return out


def rows_of(frame):
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in frame.orderBy("query_id", "rank").collect()]


def same(got, want):
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=0, atol=1e-12)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, dim int, shard string").withColumnRenamed("dim", "ids")


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(rows_of(annforest.op11_nearest_neighbours(spark, SF)), brute(rows, 5, lambda i: i % 50 == 0))


def test_odd_vectors_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 0.0, 0.0]) for i in range(40)] + rows[:5]
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [1.0, None, 0.0, 0.0]), (204, [math.nan] * 4), (205, [math.inf, 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    rows += [(206, [2.0**-100, 2.0**-99, 0.0, 0.0]), (207, [2.0**1000, 2.0**1001, 0.0, 0.0]), (210, [1.0, 0.0]), (211, [1.0, 1.0]), (220, [3.0]), (0, [9.0, 9.0, 9.0, 1.0])]
    df = frame(spark, [(i, v, 1, "x") for i, v in rows], "double")
    asked = df.where("vec_id % 10 = 0")
    got = rows_of(annforest.nearest(df, asked, k=7, shard_rows=20))
    plain = [r for r in rows if r[0] != 207] + [(207, [1.0, 2.0, 0.0, 0.0])]  # whose square would overflow
    same(got, brute(plain, 7, lambda i: i % 10 == 0))
    assert not [x for x in got if x[0] == 220]


def test_empty_tables(spark):
    none = frame(spark, [])
    some = frame(spark, [(1, [1.0, 0.0], 1, "x"), (2, [0.5, 0.5], 1, "x")])
    assert annforest.nearest(none, none).count() == annforest.nearest(none, some).count() == annforest.nearest(some, none).count() == 0
    assert rows_of(annforest.nearest(some, some.where("vec_id = 2")))[0][:3] == (2, 1, 1)


@pytest.mark.parametrize("spread_out", [True, False])
def test_recall_and_work(spread_out):
    rng = np.random.default_rng(5)
    if spread_out:
        v = rng.standard_normal((6000, 64))
    else:
        v = np.repeat(rng.standard_normal((600, 64)), 10, axis=0) + 0.1 * rng.standard_normal((6000, 64))
    forest = annforest.Forest(v)
    found = looked = 0
    for i in range(0, 6000, 50):
        q = annforest.scaled(v[i : i + 1])
        rows, cosines, n = forest.search(q[0], annforest.hash_strings(forest.units[i : i + 1], annforest.TREES)[0], 6)
        best = set(np.argsort(-(forest.units @ forest.units[i]), kind="stable")[:6])
        found += len(best & set(rows[np.argsort(-cosines)[:6]]))
        looked += n
    assert found >= 0.95 * 6 * 120
    if not spread_out:
        assert looked < 0.1 * 6000 * 120  # neighbours are found among few candidates


def test_prefixes_are_prefixes():
    v = np.random.default_rng(1).standard_normal((300, 16))
    forest = annforest.Forest(v, trees=3)
    own = annforest.hash_strings(forest.units, 3)
    for t in range(3):
        assert (np.diff(forest.strings[t].astype(object)) >= 0).all()
        assert (own[forest.order[t], t] == forest.strings[t]).all()
    side = forest.units @ annforest.planes(16, 3) > 0
    assert [int("".join("01"[int(b)] for b in side[7, :64]), 2)] == [int(own[7, 0])]
