"""Work on labels is done on a row a label, not on all rows."""

import datetime

import pyarrow as pa
import pyarrow.parquet as pq

from slabworks.plans import catalog
from tests.support import compare


def events(folder, rows):
    """rows of (day, label, value, k), k None for a missing y."""
    when = [datetime.datetime(2024, 1, 1) + datetime.timedelta(days=d) for d, *_ in rows]
    props = ["{}" if k is None else f'{{"k": {k}}}' for *_, k in rows]
    table = {"event_id": list(range(len(rows))), "ts": pa.array(when, pa.timestamp("us")), "user_id": [1] * len(rows), "event_type": pa.array([r[1] for r in rows], pa.string()), "value": pa.array([r[2] for r in rows], pa.float64()), "props": props}
    pq.write_table(pa.table(table), f"{folder}/events.parquet")


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_sets_are_compared_without_a_join(spark, tmp_path):
    events(tmp_path, [(1, c, 1.0, 1) for c in ["click", "click", "error", None, "view"]])
    got = catalog.QUERIES["set_equality"](spark, str(tmp_path))
    assert tuple(got.first()) == (0, 2)  # neither error nor a missing label is left on the right
    compare(got, catalog.SQL["set_equality"], tmp_path)
    assert "Join" not in plan_of(got)


def test_candidates_are_tried_on_centres(spark, tmp_path):
    labels = ["click", "view", "error"]
    rows = [(6 + i % 2, labels[i % 3], (i * 37 % 101) / 3 + (i % 2) * 9, None if i % 29 == 0 else i * 53 % 97) for i in range(400)]
    events(tmp_path, [(d, c, None if i % 31 == 0 else x, k) for i, (d, c, x, k) in enumerate(rows)])
    got = catalog.QUERIES["refine_candidates"](spark, str(tmp_path))
    assert compare(got, catalog.SQL["refine_candidates"], tmp_path) == 20
    plan = plan_of(got)
    assert plan.rindex("Join Cross") < plan.index("percentile(")  # plans are written from the top
