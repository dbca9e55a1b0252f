"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from slabworks.plans import catalog
from slabworks.session import build_session

HEADLINE = [
    "slice_quality_overview", "slice_expression_metrics", "label_centres", "edge_celltype_table", "variable_genes", "radius_pairs", "nearest_neighbours", "label_agreement",
    "grid_balanced_sample", "local_expectation", "metric_anomaly", "profile_divergence", "composition_divergence", "rigid_fit", "recipe_replay", "quality_scores", "quality_policy", "slice_geometry", "expression_pca",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES[HEADLINE[0]](spark, sf_dir).collect()  # the session's first query also starts it
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
