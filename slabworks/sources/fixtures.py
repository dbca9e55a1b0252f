"""Domain tables built from generic ones: points of slices, geometry cells, long counts and slice profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice series of one specimen: a slice a day, x the value, y the number in props."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.lit("ev").alias("dataset_id"),
        F.col("event_id").alias("cell_id"),
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("slice_index"),
        F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"),
        F.col("value").alias("total_counts"),
        F.col("event_type").alias("celltype"),
        "user_id",
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled points in space, fifty to a slice."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(
        F.lit("emb").alias("dataset_id"),
        F.col("vec_id").alias("cell_id"),
        F.floor(F.col("vec_id") / 50).cast("int").alias("slice_index"),
        *[F.get("embedding", F.lit(i)).cast("double").alias(a) for i, a in enumerate("xyz")],
        F.col("label").cast("string").alias("celltype"),
    )


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long counts without zeros: cell, gene, value."""
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("cell_id"), F.col("event_type").alias("gene")).agg(F.count("*").alias("value"))


def slice_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudobulk profiles: slice (month number), gene, value."""
    joined = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("slice_index")
    return joined.groupBy(month, F.col("p_type").alias("gene")).agg(F.sum("l_quantity").alias("value"))


#: The same tables in SQL, as common table expressions.
SQL = {
    "points": """points AS (SELECT 'ev' AS dataset_id, event_id AS cell_id, date_diff('day', DATE '2024-01-01', ts::DATE) AS slice_index, value AS x,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, value AS total_counts, event_type AS celltype, user_id FROM events)""",
    "cells": """cells AS (SELECT 'emb' AS dataset_id, vec_id AS cell_id, CAST(vec_id // 50 AS INTEGER) AS slice_index, CAST(embedding[1] AS DOUBLE) AS x,
        CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(label AS VARCHAR) AS celltype FROM embeddings)""",
    "expression": "expression AS (SELECT user_id AS cell_id, event_type AS gene, count(*) AS value FROM events GROUP BY ALL)",
    "slice_genes": """slice_genes AS (SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS slice_index, p_type AS gene, sum(l_quantity) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)""",
}
