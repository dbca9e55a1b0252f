"""Putting tables together: labels of components, guarded pair costs, repairs in passes, group alignment, manifests, payload checks."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slabworks.functions.columns import lit
from slabworks.operators import continuity as K
from slabworks.operators.nearness import Grid, symmetric_median
from slabworks.operators.registration import Fit, _settled, turned
from slabworks.operators.windows import robust_threshold
from slabworks.session import held, ship

#: Pairs that a cost table may have: a fixed value.
MOST_PAIRS = 25_000_000


def pair_costs(a: DataFrame, b: DataFrame, most: int = MOST_PAIRS) -> DataFrame:
    """(a, b, cost): distance of every point of one small set to every one of another; more than ``most`` pairs are refused before anything is joined.

    This is the cost table of a transport problem, all pairs by its nature.
    """
    n, m = a.count(), b.count()
    if n * m > most:
        raise ValueError(f"{n} x {m} pairs are more than {most}")
    left = a.select(F.col("cell_id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    right = b.select(F.col("cell_id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("b_y"))
    return left.crossJoin(right).select("a", "b", F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("b_y")).alias("cost"))


def with_components(points: DataFrame, components: DataFrame) -> DataFrame:
    """Points with the rank of their component, 0 for those that the detection left out; a point with two ranks is an error when it is read."""
    one = components.groupBy("cell_id", "slice_index").agg(F.min("rank").alias("rank"), F.count("*").alias("_n"))
    rank = F.when(F.col("_n").isNull(), F.lit(0)).when(F.col("_n") == 1, F.col("rank")).otherwise(F.raise_error(F.lit("a point has two components")).cast("int"))
    return points.join(one, ["cell_id", "slice_index"], "left").withColumn("rank", rank).drop("_n")


def payload_agrees(payload: DataFrame, reference: DataFrame, key: str = "cell_id", tolerance: float = 1e-5) -> DataFrame:
    """One row: ids of a payload that the reference lacks, and points of it that lie elsewhere."""
    both = payload.select(key, F.col("x").alias("px"), F.col("y").alias("py")).join(reference.select(key, "x", "y"), key, "left")
    far = F.greatest(F.abs(F.col("px") - F.col("x")), F.abs(F.col("py") - F.col("y"))) > tolerance
    return both.agg(F.count_if(F.col("x").isNull()).alias("unknown"), F.count_if(far).alias("elsewhere"))


def repaired_in_passes(points: DataFrame, passes: int = 2, ratio: float = 1.5, k: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(points, log): blocks before boundaries that score badly for their series are shifted, in at most ``passes`` passes.

    A boundary is bad if its v2 is above the series' robust threshold; repairs that bring too little are left out, and
    a pass without an accepted one is the last.  log has a row for each boundary tried: pass, boundary, accepted and scores.
    """
    pair = ["dataset_id", "boundary"]
    log, now = None, points
    for i in range(1, passes + 1):
        rows = held(K.adjacent_pairs(now))
        scores = K.alignment_scores(rows, pair).select(*pair, "v2")
        bad = robust_threshold(scores, "v2", ["dataset_id"], ratio, k).where("v2 > threshold").select(*pair)
        tried = held(K.block_translations(rows.join(bad, pair, "left_semi"), pair).withColumn("pass", F.lit(i)))
        log = tried if log is None else log.unionByName(tried)
        if tried.where("accepted").limit(1).count() == 0:
            break
        places = now.select("dataset_id", "slice_index").distinct().withColumn("place", F.row_number().over(Window.partitionBy("dataset_id").orderBy("slice_index")) - 1)
        shift = K.cumulative_shifts(tried).join(places, ["dataset_id", "place"]).drop("place")
        moved = now.join(shift, ["dataset_id", "slice_index"], "left")
        now = held(moved.withColumns({"x": F.col("x") + F.coalesce("dx", lit(0)), "y": F.col("y") + F.coalesce("dy", lit(0))}).drop("dx", "dy"))
    return now, log


def align_groups(rows: DataFrame, by: list[str], cfg: Fit = Fit(starts=1, rounds=60, trim=0.9)) -> DataFrame:
    """(by, status, theta, tx, ty, before, after): trimmed closest points from where a group's moving points lie, with the symmetric distance before and after.

    rows(by, side, x, y) with side 'm' and 'f'.  A group that gets no closer keeps its place.
    """
    schema = ", ".join([*[f"{c} {rows.schema[c].dataType.simpleString()}" for c in by], "status string", "theta double", "tx double", "ty double", "before double", "after double"])

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        m, f = (pdf.loc[pdf["side"] == s, ["x", "y"]].dropna().to_numpy(float) for s in "mf")
        out = dict(zip(by, key)) | {"status": "failed", "theta": 0.0, "tx": 0.0, "ty": 0.0, "before": None, "after": None}
        if min(len(m), len(f)) >= 3:
            before = symmetric_median(m, f)
            theta, shift = _settled(m, Grid(f), float(np.ptp(f, axis=0).max()) or 1.0, cfg)
            after = symmetric_median(turned(m, float(theta[0])) + shift[0], f)
            better = after < before
            out |= {"status": "aligned" if better else "kept", "before": before, "after": min(before, after)}
            if better:
                out |= {"theta": float(np.angle(np.exp(1j * theta[0]))), "tx": float(shift[0, 0]), "ty": float(shift[0, 1])}
        return pd.DataFrame([out])

    ship(rows.sparkSession)
    return rows.select(*by, "side", "x", "y").groupBy(*by).applyInPandas(one, schema)


def before_and_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """(dataset_id, boundary, nearest_before, nearest_after, agreement_before, agreement_after, improved) of a series' boundaries."""
    side = lambda d, t: K.registration_report(d).where("label is null").select("dataset_id", "boundary", F.col("nearest_mean").alias(f"nearest_{t}"), F.col("agreement").alias(f"agreement_{t}"))
    out = side(before, "before").join(side(after, "after"), ["dataset_id", "boundary"])
    return out.withColumn("improved", F.col("nearest_after") < F.col("nearest_before"))


def residual_summary(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, median, p95, most) of the distances between paired points x1, y1 and x2, y2."""
    d = F.hypot(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2"))
    return pairs.groupBy(*by).agg(F.count("*").alias("n"), F.percentile(d, lit(0.5)).alias("median"), F.percentile(d, lit(0.95)).alias("p95"), F.max(d).alias("most"))


def edge_transforms(files: DataFrame, text: str = "text") -> DataFrame:
    """(edge_id, fixed, moving, m00..m12, sigma2) from edge records in JSON; a record without a full matrix has NULLs."""
    kind = "edge_id string, fixed_slice string, moving_slice string, sigma2 double, matrix array<array<double>>"
    e = files.select(F.from_json(text, kind).alias("e")).select("e.*")
    cell = lambda i, j: F.get(F.get("matrix", F.lit(i)), F.lit(j)).alias(f"m{i}{j}")
    return e.select("edge_id", F.col("fixed_slice").alias("fixed"), F.col("moving_slice").alias("moving"), *[cell(i, j) for i in (0, 1) for j in (0, 1, 2)], "sigma2")


def component_manifest(scores: DataFrame, loadings: np.ndarray, genes: list[str]) -> dict:
    """What a basis of components is known by: its genes, size, and digests of the loadings and of all scores, whatever their order."""
    import hashlib

    n = scores.agg(F.count("*").alias("n"), F.sum(F.xxhash64("cell_id", "scores").cast("decimal(38,0)")).alias("h")).first()
    return {"cells": n.n, "components": int(loadings.shape[1]), "genes": len(genes), "gene_digest": hashlib.sha256(json.dumps(sorted(genes)).encode()).hexdigest(), "loading_digest": hashlib.sha256(np.ascontiguousarray(loadings, "<f8").tobytes()).hexdigest(), "score_digest": str(n.h)}


def acceptance(reviews: DataFrame, coverage: float = 0.8, least_region: float = 0.5) -> DataFrame:
    """Adds accepted and reason to reviews(coverage, region_coverage, watertight): the first gate that a candidate fails."""
    reason = F.when(~F.coalesce("watertight", F.lit(False)), "not_watertight").when(F.coalesce(F.col("coverage") < coverage, F.lit(True)), "low_coverage").when(F.coalesce(F.col("region_coverage") < least_region, F.lit(True)), "low_regional_coverage")
    return reviews.withColumn("reason", reason).withColumn("accepted", reason.isNull())


def plain_value(c: Column) -> Column:
    """Non-finite numbers become NULL, as they can't stand in JSON."""
    return F.when(~F.isnan(c) & (F.abs(c) < lit(float("inf"))), c)


def packed_settings(value) -> str:
    """Nested settings as JSON that gives back their kinds: tuples, sets, bytes and missing values are marked."""
    if isinstance(value, dict):
        return json.dumps({k: json.loads(packed_settings(v)) for k, v in value.items()}, sort_keys=True)
    if isinstance(value, list):
        return json.dumps([json.loads(packed_settings(v)) for v in value])
    if isinstance(value, (tuple, set)):
        items = sorted(value) if isinstance(value, set) else value
        return json.dumps({"__kind__": type(value).__name__, "items": [json.loads(packed_settings(v)) for v in items]})
    if isinstance(value, bytes):
        return json.dumps({"__kind__": "bytes", "hex": value.hex()})
    if isinstance(value, float) and value != value:
        return json.dumps({"__kind__": "nan"})
    return json.dumps(value)


def unpacked_settings(text: str):
    def back(v):
        if isinstance(v, list):
            return [back(x) for x in v]
        if isinstance(v, dict):
            kind = v.get("__kind__")
            if kind in ("tuple", "set"):
                return (tuple if kind == "tuple" else set)(back(x) for x in v["items"])
            if kind == "bytes":
                return bytes.fromhex(v["hex"])
            return float("nan") if kind == "nan" else {k: back(x) for k, x in v.items()}
        return v

    return back(json.loads(text))


def normalized_operations(steps: list[dict]) -> list[dict]:
    """Steps with ids, an order and defaults; a step that has an id keeps it, and ids differ."""
    out = []
    for i, s in enumerate(sorted(enumerate(steps), key=lambda e: (e[1].get("order", e[0]), e[0])), 1):
        step = s[1]
        out.append({"operation_id": step.get("operation_id", f"op_{i:03d}"), "order": i, "mode": step.get("mode", "normal"), "scope": step.get("scope", {})} | {k: v for k, v in step.items() if k not in ("operation_id", "order", "mode", "scope")})
    ids = [o["operation_id"] for o in out]
    if len(set(ids)) < len(ids):
        raise ValueError("operation ids differ")
    return out
