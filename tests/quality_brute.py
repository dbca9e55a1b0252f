"""Slice scores straight from their formulas, in plain Python over one series, to hold the engine against."""

import math
from statistics import median

import numpy as np

from slabworks.operators.windows import HIGH_IS_BAD, LOW_IS_BAD

EPS = 2.220446049250313e-16


def clip(x, lo=0.0, hi=1.0):
    return min(max(x, lo), hi)


def sides(values, i, window):
    half = max(window // 2, 1)
    pick = lambda js: [(float(j), values[j]) for j in js if 0 <= j < len(values) and values[j] is not None]
    return pick(range(i - half, i)), pick(range(i + 1, i + half + 1))


def expected(values, i, window):
    left, right = sides(values, i, window)
    both = left + right
    if left and right:
        slope = median([(b[1] - a[1]) / (b[0] - a[0]) for k, a in enumerate(both) for b in both[k + 1 :]])
        return median([v - slope * p for p, v in both]) + slope * i, True, abs(median([v for _, v in left]) - median([v for _, v in right]))
    return (median([v for _, v in both]) if both else None), False, 0.0


def scale(values):
    known = [v for v in values if v is not None]
    if not known:
        return 0.0, 1.0
    mid = median(known)
    mad, sd = 1.4826 * median([abs(v - mid) for v in known]), float(np.std(known))
    return mid, mad if mad > EPS else sd if sd > EPS else 1.0


def anomaly(values, window, low, mild, severe):
    exp = [expected(values, i, window) for i in range(len(values))]
    res = [None if v is None or e[0] is None else (e[0] - v if low else v - e[0]) for v, e in zip(values, exp)]
    (mid, rs), (_, gs) = scale(res), scale(values)
    out = []
    for v, r, (e, two, gap) in zip(values, res, exp):
        if r is None:
            out.append((0.0, e, two))
            continue
        size = max(r / max(abs(e), EPS), 0.0) if low else max(r, 0.0)
        steep = clip((max((r - mid) / max(rs, EPS), 0.0) - 1.5) / 3)
        if not low:
            steep *= clip(size / max(mild, EPS))
        calm = clip(math.exp(-gap / max(2.5 * gs, EPS)), 0.35)
        out.append((max(clip((size - mild) / max(severe - mild, EPS)), steep) * (1 if two else 0.72) * calm, e, two))
    return out


def loss(values, i, window):
    left, right = ([v for _, v in s if v > 0] for s in sides(values, i, window))
    v = values[i]
    if v is None or v < 0 or not left or not right:
        return None, None
    ref = min(median(left), median(right))
    return ref, clip(1 - v / max(ref, EPS))


def score(rows, window, continuity):
    """rows: the series' metrics in order; continuity: (divergence, similarity, js) in order."""
    n = len(rows)
    support = max(window, 3, min(9, n if n % 2 else n - 1))
    col = lambda m: [r.get(m) for r in rows]
    found, internal = {}, [False] * n
    for rules, low in ((LOW_IS_BAD, True), (HIGH_IS_BAD, False)):
        for m, (mild, severe) in rules.items():
            if m not in rows[0]:
                continue
            own, wide = (anomaly(col(m), w, low, mild, severe) for w in (window, support))
            internal = [a or o[2] for a, o in zip(internal, own)]
            best = [max(o[0], w[0]) for o, w in zip(own, wide)]
            if m in ("median_total_counts", "median_n_genes"):
                for i, v in enumerate(col(m)):
                    drop = max([max((e - v) / max(abs(e), EPS), 0.0) for e in (own[i][1], wide[i][1]) if e is not None and v is not None], default=0.0)
                    best[i] = max(best[i], clip((drop - mild) / (severe - mild)) * (1 if own[i][2] else 0.72))
            found[m] = best
    div = anomaly([c[0] for c in continuity], window, False, 0.03, 0.18)
    found["expression_profile"] = [max(d[0], clip(((c[0] or 0) - 0.06) / 0.24)) * clip(((0.5 if c[1] is None else c[1]) - 0.25) / 0.6, 0.25) for d, c in zip(div, continuity)]
    found["celltype_composition"] = [clip(((c[2] or 0) - 0.08) / 0.32) for c in continuity]
    weights = {
        "density": {"cell_density": 0.28, "n_locations": 0.10, "hole_fraction": 0.27, "knn_tail_ratio": 0.13, "fragmentation": 0.12, "largest_component_fraction": 0.10},
        "expression": {"median_total_counts": 0.27, "median_n_genes": 0.24, "zero_fraction": 0.14, "library_complexity": 0.11, "detected_gene_fraction": 0.08, "local_low_depth_fraction": 0.08, "regional_low_depth_cluster_fraction": 0.08},
        "damage": {"median_pct_mito": 0.65, "fragmentation": 0.35},
        "continuity": {"expression_profile": 0.58, "celltype_composition": 0.22, "hole_fraction": 0.20},
    }
    out = []
    for i in range(n):
        dom = {}
        for name, ws in weights.items():
            have = {m: w for m, w in ws.items() if m in found}
            dom[name] = sum(found[m][i] * w for m, w in have.items()) / sum(have.values()) if have else 0.0
            if name in ("density", "expression"):
                top = sorted([found[m][i] for m in have] + [0.0, 0.0], reverse=True)
                dom[name] = max(dom[name], 0.65 * top[0] + 0.35 * top[1])
        d, e, m, c = (dom[k] for k in ("density", "expression", "damage", "continuity"))
        raw = max(0.31 * d + 0.39 * e + 0.12 * m + 0.18 * c, clip((max(dom.values()) - 0.68) * 0.78 + 0.48))
        trusted = [None if (r.get("coordinate_valid_fraction") or 1) < 0.99 else r for r in rows]
        seen = lambda k: [None if t is None else t.get(k) for t in trusted]  # noqa: E731, B023
        ref, points = loss(seen("n_locations"), i, window)
        area, density = loss(seen("hull_area"), i, window)[1], loss(seen("cell_density"), i, window)[1]
        geometry = ref is not None and ref >= 20 and points >= 0.5 and max(area or 0, density or 0) >= 0.35
        counts, genes = (loss(col(k), i, window)[1] for k in ("median_total_counts", "median_n_genes"))
        capture = (counts or 0) >= 0.5 and (genes or 0) >= 0.3
        taper = 0 < i < n - 1
        for k in ("n_locations", "hull_area"):
            three = seen(k)[i - 1 : i + 2] if taper else []
            taper = taper and all(v is not None and v > 0 for v in three) and min(three[0], three[2]) <= three[1] <= max(three[0], three[2])
        f = lambda k: found[k][i] if k in found else 0.0  # noqa: E731, B023
        calm = e < 0.32 and m < 0.38 and c < 0.45
        tapering = f("n_locations") >= 0.45 and f("cell_density") < 0.3 and f("hole_fraction") < 0.3 and e < 0.35
        protected = ((d >= 0.48 and calm) or tapering) and taper and calm and not geometry and not capture
        q = clip((min(raw, 0.62) if protected else raw) * (1 if internal[i] else 0.82))
        strong = sum(v >= 0.45 for v in dom.values())
        if internal[i] and not protected and ((q >= 0.64 and strong >= 2) or e >= 0.78 or (d >= 0.82 and f("hole_fraction") >= 0.55 and c >= 0.42)):
            call = "exclude"
        else:
            call = "review" if q >= 0.38 or strong or max(v[i] for v in found.values()) >= 0.75 or protected or geometry or capture else "keep"
        out.append({"quality_anomaly_score": q, "recommendation": call, "internal": internal[i], "protected": protected, "n_strong": strong, "geometry_loss_candidate": geometry, "capture_loss_candidate": capture, **dom})
    return out
