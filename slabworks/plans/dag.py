"""Content-hashed pipeline runs: a stage is computed again only if it or something before it has changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Stage:
    name: str
    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    config: dict = field(default_factory=dict)
    version: str = "1"


def table_hash(df: DataFrame) -> str:
    """A digest of a table's rows that doesn't depend on their order."""
    r = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.bit_xor(F.xxhash64(*df.columns))).first()
    return hashlib.sha256(json.dumps([df.schema.json(), *map(str, r)]).encode()).hexdigest()


def plan(stages: list[Stage], inputs: dict[str, str]) -> dict[str, str]:
    """A fingerprint of each stage from its own settings and those of all before it; stages must come in order."""
    known = dict(inputs)
    for s in stages:
        if missing := [n for n in s.needs if n not in known]:
            raise ValueError(f"{s.name} needs {', '.join(missing)}")
        if s.name in known:
            raise ValueError(f"{s.name} stands twice")
        known[s.name] = hashlib.sha256(json.dumps([s.name, s.version, s.config, [known[n] for n in s.needs]], sort_keys=True).encode()).hexdigest()
    return {s.name: known[s.name] for s in stages}


def execute(spark: SparkSession, stages: list[Stage], inputs: dict[str, DataFrame], store: str) -> dict[str, dict]:
    """Runs or reuses each stage; the table of a stage is kept under its fingerprint in ``store``.

    Returns state (reused, computed, failed, blocked), fingerprint and table or error by stage.  A failed stage blocks
    those that need it, and nothing else.
    """
    marks = plan(stages, {k: table_hash(v) for k, v in inputs.items()})
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    tables, out = dict(inputs), {}
    for s in stages:
        path = f"{store}/{s.name}/{marks[s.name]}"
        done = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if any(n not in tables for n in s.needs):
            out[s.name] = {"state": "blocked", "fingerprint": marks[s.name]}
            continue
        state = "reused"
        if not done.getFileSystem(conf).exists(done):
            state = "computed"
            try:
                s.build(*[tables[n] for n in s.needs], **s.config).write.mode("overwrite").parquet(path)
            except Exception as e:  # noqa: BLE001  a stage is the caller's code
                out[s.name] = {"state": "failed", "fingerprint": marks[s.name], "error": f"{type(e).__name__}: {e}"[:500]}
                continue
        tables[s.name] = spark.read.parquet(path)
        out[s.name] = {"state": state, "fingerprint": marks[s.name], "table": tables[s.name]}
    return out
