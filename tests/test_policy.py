import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from slabworks.plans import catalog, quality
from tests.conftest import SF
from tests.quality_brute import score

LOW = {"density": 0.7, "expression": 0.5, "damage": 0.0, "continuity": 0.0}
CALM = {"density": 0.2, "expression": 0.1, "damage": 0.0, "continuity": 0.0}


def look(score=0.4, call="review", domains=LOW, internal=True, protected=False, geometry=False, capture=False):
    return {
        **domains, "quality_anomaly_score": score, "recommendation": call, "n_strong": sum(v >= 0.45 for v in domains.values()), "severity": max(domains.values()),
        "internal": internal, "score_confidence": 1.0 if internal else 0.72, "protected": protected, "geometry_loss_candidate": geometry, "capture_loss_candidate": capture,
    }


#: The looks of a slice under windows 3, 5 (the primary one) and 7.
SLICES = {
    "steady": (look(), look(), look()),
    "fades in 7": (look(), look(), look(score=0.1)),
    "one domain in 3": (look(domains={**LOW, "expression": 0.1}), look(), look()),
    "mild in 3": (look(domains={**LOW, "density": 0.6}), look(), look()),
    "kept by a detector": (look(), look(call="keep"), look()),
    "kept in 7": (look(), look(), look(call="keep")),
    "upper tier": (look(0.6, domains={**LOW, "density": 0.62}),) * 3,
    "protected": (look(), look(protected=True), look()),
    "endpoint": (look(internal=False),) * 3,
    "high, called": (look(0.2, "keep"), look(0.9, "exclude"), look(0.2, "keep")),
    "high, not called, steady": (look(0.8), look(0.8), look(0.8)),
    "high, not called": (look(0.8), look(0.8), look(0.1)),
    "loss in 5": (look(0.1), look(0.3, domains=CALM, geometry=True), look(0.1)),
    "loss in 5 and 7": (look(0.1), look(0.3, domains=CALM, geometry=True), look(0.1, geometry=True)),
    "loss in 3 and 7": (look(0.1, capture=True), look(0.3, domains=CALM), look(0.1, capture=True)),
    "two routes, one window each": (look(0.1, geometry=True), look(0.3, domains=CALM, capture=True), look(0.1)),
    "loss below the bands": (look(0.1, domains=CALM, capture=True),) * 3,
    "loss of a protected one": (look(0.3, domains=CALM, protected=True, capture=True),) * 3,
    "calm": (look(0.05, "keep", CALM),) * 3,
}


def brute(views):
    own, q = views[1], views[1]["quality_anomaly_score"]
    whole = lambda v: v["internal"] and not v["protected"]
    if any(own[k] and sum(v[k] for v in views) >= 2 for k in ("geometry_loss_candidate", "capture_loss_candidate")):
        return "exclude"
    if q >= 0.7 and own["recommendation"] == "exclude" and whole(own):
        return "exclude"
    low, severe = (0.129, 0.65) if q < 0.54 else (0.54, 0.6)
    ok = lambda v: v["quality_anomaly_score"] >= low and v["recommendation"] != "keep" and whole(v) and v["n_strong"] >= 2 and v["severity"] >= severe
    return "exclude" if q > 0.129 and own["score_confidence"] >= 0.9 and ok(own) and all(map(ok, views)) else "keep"


def test_policy_asks_all_windows(spark):
    frames = [spark.createDataFrame([{"dataset_id": "d", "slice_index": i, "window": w, **views[at]} for i, views in enumerate(SLICES.values())]) for at, w in enumerate((3, 5, 7))]
    scored = reduce(lambda a, b: a.unionByName(b), frames)
    calls = quality.two_stage_policy(scored.where("window = 5"), quality.window_evidence(scored))
    got = {r.slice_index: r.call for r in calls.collect()}
    total = quality.call_summary(calls).first()
    assert total.slices == len(SLICES) and total.excluded == quality.withheld(calls).count() == total.by_score + total.by_tier + total.by_loss
    assert {name: got[i] for i, name in enumerate(SLICES)} == {name: brute(views) for name, views in SLICES.items()}
    excluded = {name for i, name in enumerate(SLICES) if got[i] == "exclude"}
    assert excluded == {"steady", "upper tier", "high, called", "high, not called, steady", "loss in 5 and 7", "loss below the bands", "loss of a protected one"}


def test_windows_wider_than_the_series_are_left_out(spark):
    frame = spark.createDataFrame([{"dataset_id": "d", "slice_index": i, "window": w, **look(geometry=True)} for i in range(5) for w in (3, 5, 7)])
    rows = quality.window_evidence(frame).select(F.col("details.window").alias("w")).collect()
    assert [list(r.w) for r in rows] == [[3, 5]] * 5


def made_up(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        r = {"n_locations": 900.0 + rng.randint(-60, 60), "hull_area": 100 + rng.random() * 4, "cell_density": 9 + rng.random(), "median_total_counts": 100 + 8 * rng.random(), "median_n_genes": 50.0 + rng.randint(-2, 2),
             "zero_fraction": 0.5 + 0.02 * rng.random(), "hole_fraction": 0.01 * rng.random(), "fragmentation": 0.02 * rng.random(), "coordinate_valid_fraction": 1.0}
        rows.append(r)
    for i in rng.sample(range(n), max(1, n // 3)):
        kind = rng.choice(["capture", "geometry", "hole", "missing", "taper", "bad xy"])
        if kind == "capture":
            rows[i].update(median_total_counts=2.0, median_n_genes=2.0, zero_fraction=0.98)
        elif kind == "geometry":
            rows[i].update(n_locations=200.0, hull_area=40.0, cell_density=5.0)
        elif kind == "hole":
            rows[i].update(hole_fraction=0.4, cell_density=4.0)
        elif kind == "missing":
            rows[i].update(median_total_counts=None, cell_density=None)
        elif kind == "taper":
            for k, j in enumerate(range(i, n)):
                rows[j].update(n_locations=880.0 * 0.7**k, hull_area=95 * 0.72**k)
        else:
            rows[i].update(coordinate_valid_fraction=0.5, n_locations=100.0)
    return rows, [(rng.choice([0.01, 0.02, 0.3, None]), rng.choice([0.9, 0.4, None]), rng.choice([0.02, 0.3, None])) for _ in range(n)]


@pytest.mark.parametrize("names", [("n_locations", "hull_area", "cell_density", "median_total_counts", "median_n_genes", "zero_fraction", "hole_fraction", "fragmentation", "coordinate_valid_fraction"), ("n_locations", "median_total_counts")])
def test_scores_equal_their_formulas(spark, names):
    series = {f"d{n}": made_up(n, n) for n in (1, 2, 3, 4, 6, 9, 14)}
    flat = made_up(1, 9)[0][0] | {"median_total_counts": 100.0, "median_n_genes": 50.0, "zero_fraction": 0.5}
    series["x"] = [flat | ({"median_total_counts": 2.0, "median_n_genes": 2.0, "zero_fraction": 0.98} if i == 4 else {}) for i in range(9)], [(0.02, 0.9, 0.02)] * 9
    rows = [{"dataset_id": k, "slice_index": 3 * i, **{m: r[m] for m in names}} for k, (rs, _) in series.items() for i, r in enumerate(rs)]
    schema = "dataset_id string, slice_index int, " + ", ".join(f"{m} double" for m in names)
    links = [(k, 3 * i, w, *c) for k, (_, cs) in series.items() for i, c in enumerate(cs) for w in (3, 5, 7)]
    continuity = spark.createDataFrame(links, "dataset_id string, slice_index int, window int, divergence double, similarity double, js double")
    got = {(r.dataset_id, r.window, r.slice_index): r for r in quality.score_windows(spark.createDataFrame(rows, schema), continuity=continuity).collect()}
    calls = set()
    for k, (rs, cs) in series.items():
        for w in (3, 5, 7):
            for i, want in enumerate(score([{m: r[m] for m in names} for r in rs], w, cs)):
                have = got[k, w, 3 * i]
                for name, value in want.items():
                    assert have[name] == pytest.approx(value, abs=1e-9), (k, w, i, name)
                calls.add(want["recommendation"])
    assert calls == {"keep", "review", "exclude"} or len(names) == 2


def test_registered_scores_equal_their_formulas(spark):
    metrics = quality.held(quality.series_metrics(spark, SF))
    links = {(r.slice_index): (r.divergence, r.similarity, r.js) for r in quality.series_continuity(spark, SF, (5,)).collect()}
    rows = sorted((r.asDict() for r in metrics.collect()), key=lambda r: r["slice_index"])
    want = score(rows, 5, [links[r["slice_index"]] for r in rows])
    got = {r.slice_index: r for r in quality.score_windows(metrics, (5,), quality.series_continuity(spark, SF, (5,))).collect()}
    for r, w in zip(rows, want):
        assert all(got[r["slice_index"]][k] == pytest.approx(v, abs=1e-9) for k, v in w.items())


def basis_of(views):
    """The route that decides, asked in turn: the score, the tier of the score, a loss seen twice."""
    own, q = views[1], views[1]["quality_anomaly_score"]
    whole = lambda v: v["internal"] and not v["protected"]
    if q >= 0.7 and own["recommendation"] == "exclude" and whole(own):
        return "standard"
    name, low, severe = ("low", 0.129, 0.65) if q < 0.54 else ("high", 0.54, 0.6)
    ok = lambda v: v["quality_anomaly_score"] >= low and v["recommendation"] != "keep" and whole(v) and v["n_strong"] >= 2 and v["severity"] >= severe
    if q > 0.129 and own["internal"] and ok(own) and all(map(ok, views)):
        return f"tier_{name}"
    return next((f"{k}_loss" for k in ("geometry", "capture") if own[f"{k}_loss_candidate"] and sum(v[f"{k}_loss_candidate"] for v in views) >= 2), "none")


def test_policy_over_made_up_defects(spark):
    large = SF.replace("0.001", "0.01")
    slices, continuity = quality.with_defects(quality.held(quality.series_metrics(spark, large)), quality.series_continuity(spark, large))
    series, links = {}, {}
    for r in slices.collect():
        series.setdefault(r.dataset_id, []).append(r.asDict())
    for r in continuity.collect():
        links[r.dataset_id, r.slice_index, r.window] = r.divergence, r.similarity, r.js
    got = {(r.dataset_id, r.slice_index): (r.basis, r.call) for r in catalog.QUERIES["defect_policy"](spark, large).collect()}
    want = {}
    for name, rows in series.items():
        rows.sort(key=lambda r: r["slice_index"])
        seen = [score(rows, w, [links[name, r["slice_index"], w] for r in rows]) for w in (3, 5, 7)]
        for i, r in enumerate(rows):
            domains = ("density", "expression", "damage", "continuity")
            views = [s[i] | {"severity": max(s[i][k] for k in domains)} for s in seen]
            want[name, r["slice_index"]] = basis_of(views)
    assert {k: b for k, (b, _) in got.items()} == {k: want[k] for k in got} and all((c == "exclude") == (b != "none") for b, c in got.values())
    assert all(b == "none" for k, b in want.items() if k not in got)
    assert set(want.values()) == {"standard", "tier_low", "tier_high", "geometry_loss", "capture_loss", "none"}
    assert {k for k, b in want.items() if b != "none"} <= {(n, i) for n in series for i in (10, 20)}
    audit = catalog.QUERIES["review_audit"](spark, large).collect()
    assert {(r.dataset_id, r.slice_index) for r in audit} >= {k for k, b in want.items() if b.startswith("tier")} and any(r.reasons for r in audit)
    assert all(not r.reasons for r in audit if want[r.dataset_id, r.slice_index] == "tier_low")


def test_window_choice(spark):
    rows, _ = made_up(5, 11)
    frame = spark.createDataFrame([{"dataset_id": "a", "slice_index": i, **r} for i, r in enumerate(rows)] + [{"dataset_id": "b", "slice_index": i, **r} for i, r in enumerate(rows[:2])])
    got = {(r.dataset_id, r.window): r for r in quality.choose_window(frame).collect()}
    quiet = [(None, None, None)] * 11
    for w in (3, 5, 7):
        base = score(rows, w, quiet)
        inner = list(range(max(w // 2, 1), max(11 - w // 2, 1)))
        spots = inner if len(inner) <= 8 else [inner[int(j * (len(inner) - 1) / 7)] for j in range(8)]
        hits, gains = [], []
        for t in spots:
            hurt = [dict(r) for r in rows]
            for k in quality.DEFECT_COLUMNS:
                if hurt[t].get(k) is not None:
                    hurt[t][k] *= 0.24
            hurt[t]["zero_fraction"] = min(0.999, hurt[t]["zero_fraction"] + 0.35)
            s = score(hurt, w, quiet)[t]
            hits.append(s["recommendation"] != "keep")
            gains.append(s["quality_anomaly_score"] - base[t]["quality_anomaly_score"])
        flagged = sum(b["recommendation"] != "keep" for b in base) / 11
        utility = sum(hits) / len(hits) + 0.35 * sum(gains) / len(gains) - 0.35 * flagged - 0.012 * (w - 3)
        assert got["a", w].utility == pytest.approx(utility, abs=1e-9)
    assert sum(r.chosen for k, r in got.items() if k[0] == "a") == 1 and [k[1] for k in got if k[0] == "b"] == [3]
