"""Queries that once did less than their whole job, on rows that the part left out decides."""

import pyarrow as pa
import pyarrow.parquet as pq

from slabworks.plans import catalog
from tests.support import compare


def test_length_takes_the_whole_vector(spark, tmp_path):
    vectors = [[0.0] * 15 + [3.0], [1.0] * 16, [2.0]]
    pq.write_table(pa.table({"vec_id": [0, 1, 2], "embedding": pa.array(vectors, pa.list_(pa.float32()))}), f"{tmp_path}/embeddings.parquet")
    got = catalog.QUERIES["displacement_feature"](spark, str(tmp_path))
    assert {r.cell_id: r.length for r in got.collect()} == {0: 3.0, 1: 4.0, 2: 2.0}
    compare(got.where("cell_id < 2"), catalog.SQL["displacement_feature"] + " WHERE vec_id < 2", tmp_path)


def test_lookup_takes_every_order(spark, tmp_path):
    pq.write_table(pa.table({"c_custkey": [1, 2, 3]}), f"{tmp_path}/customer.parquet")
    orders = {"o_orderkey": [10, 11, 12], "o_custkey": [1, 1, 2], "o_orderstatus": ["F", "O", "O"], "o_orderpriority": ["1-URGENT", "5-LOW", "1-URGENT"]}
    pq.write_table(pa.table(orders), f"{tmp_path}/orders.parquet")
    got = catalog.QUERIES["refine_lookup"](spark, str(tmp_path))
    assert {tuple(r) for r in got.select("candidate_id", "job", "found").collect()} == {(1, 11, True), (2, 12, True), (3, None, False)}
    compare(got, catalog.SQL["refine_lookup"], tmp_path)
