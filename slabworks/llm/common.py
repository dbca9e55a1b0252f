"""Tables, shared scratch folders and text identity, used by every operator of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slabworks.session import cleaning, held, run_dir, ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows in a batch that goes to a Python worker, where the session doesn't say otherwise: texts are long.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


#: A table written to the shared folder: see ``held``.
written = held


def dropped(table: DataFrame) -> None:
    """Deletes a written table that nothing that is still to run reads."""
    spark = table.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def packed(df: DataFrame, **added: Column) -> DataFrame:
    """Column row, a struct of all columns, and the added ones: no column of the caller's can clash with those."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(name) for name, c in added.items()])


def arrow_map(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` on workers that may not have this package installed.

    A session that has Spark's default batch size gets a smaller one: a batch of whole texts is held several times
    over, by the task and by its worker.
    """
    spark = df.sparkSession
    ship(spark)
    name, default, smaller = BATCH_ROWS
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, smaller)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _released()

    return df.mapInArrow(run, schema)


def _released() -> None:
    """Gives memory that a task has freed back to the system: its worker lives on and waits for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


@contextmanager
def bucketed(df: DataFrame, key: str, name: str) -> Iterator[DataFrame]:
    """As ``written``, in buckets of a key, so that joins by it don't shuffle this side; the table is gone afterwards."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = f"{name}_{uuid.uuid4().hex}"
    path = f"{run_dir(spark)}/{own}"
    with cleaning(spark):
        df.write.bucketBy(parts, key).sortBy(key).format("parquet").option("path", path).saveAsTable(own)
    try:
        yield spark.table(own)
    finally:
        spark.sql(f"DROP TABLE {own}")
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once a row.

    A column used inside a lambda is computed anew for each element once the optimizer has merged projections or
    pushed a filter through them; a lambda's own variable isn't.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def text_key(text: Column) -> Column:
    """SHA-256 of a text; null stays null."""
    return F.sha2(text.cast("binary"), 256)
