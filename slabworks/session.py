"""Sessions, and getting this package to Python workers that don't have it on their path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_folders: set[str] = set()


def build_session(master: str = "local[*]", **conf: str) -> SparkSession:
    """A local session with the settings that this library is tested with."""
    builder = SparkSession.builder.master(master).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Adds this package to the session's Python files, once; call it before functions of it run on workers."""
    app = spark.sparkContext.applicationId
    root = Path(__file__).resolve().parent
    if app in _shipped or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="slabworks-ship-")
    path = os.path.join(folder, "slabworks_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(path)  # Spark copies it to its own folder for the workers
    _shipped.add(app)
    atexit.register(shutil.rmtree, folder, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests, a laptop) gets a temporary folder; a cluster has no other folder
    that all executors see, so that is an error there.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="slabworks-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one; it is removed when the driver's Python ends.

    Not before that: a result may still be computed from its tables, again if an executor is lost.
    """
    path = f"{shared_dir(spark)}/slabworks/{spark.sparkContext.applicationId}"
    if path not in _folders:
        _folders.add(path)
        atexit.register(_deleted, path)
    return path


def _deleted(path: str) -> None:
    jvm = SparkContext._jvm
    try:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
    except Exception:  # noqa: BLE001  the JVM may have ended before; nothing but disk is at stake
        pass


#: Spark deletes a query's shuffle files when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside are deleted as soon as each has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def held(frame: DataFrame, name: str = "held") -> DataFrame:
    """``frame`` as a Parquet table in the shared folder: cuts lineage, survives lost executors, is computed once."""
    spark = frame.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with cleaning(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """``frame`` dealt by keys to as many tasks as the session shuffles to, however small it is.

    Left to itself Spark puts small shuffles together by their bytes; groups that are heavy to work on stay apart here.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(parts, *keys)
