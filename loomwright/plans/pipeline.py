"""Stages of DataFrame functions with a manifest, resume, and a ledger of what became of every row."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Task:
    name: str
    run: Callable[..., DataFrame]
    requires: list[str] = field(default_factory=list)

    def signature(self, settings: dict) -> str:
        return hashlib.sha256(json.dumps([self.name, inspect.getsource(self.run), self.requires, settings], sort_keys=True, default=str).encode()).hexdigest()


def check(tasks: list[Task], given: list[str] = ()) -> list[str]:
    """What a plan lacks: inputs that nothing before makes, and names used twice."""
    made, bad = set(given), []
    for t in tasks:
        bad += [f"{t.name} needs {r}" for r in t.requires if r not in made]
        bad += [f"{t.name} is made twice"] if t.name in made else []
        made.add(t.name)
    return bad


def _text(spark: SparkSession, path: str) -> str | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def run(spark: SparkSession, tasks: list[Task], root: str, inputs: dict[str, DataFrame], settings: dict | None = None) -> dict[str, DataFrame]:
    """Run tasks in order, each written under ``root``. A task whose signature, and those of all it needs, match what its
    folder notes is read instead of run again; a half-written one is run again (its note is written last)."""
    if bad := check(tasks, list(inputs)):
        raise ValueError("; ".join(bad))
    out, signs = dict(inputs), {k: k for k in inputs}
    for t in tasks:
        sign = hashlib.sha256((t.signature(settings or {}) + "".join(signs[r] for r in t.requires)).encode()).hexdigest()
        if _text(spark, f"{root}/{t.name}.note") != sign:
            t.run(*[out[r] for r in t.requires]).write.mode("overwrite").parquet(f"{root}/{t.name}")
            spark.createDataFrame([(sign,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{t.name}.note")
        out[t.name] = spark.read.parquet(f"{root}/{t.name}")
        signs[t.name] = sign
    return out


def ledger(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``disposition``: the first stage whose condition holds, or ``kept``."""
    out = None
    for name, cond in stages:
        c = F.coalesce(cond, F.lit(False))
        out = F.when(c, name) if out is None else out.when(c, name)
    return df.withColumn("disposition", out.otherwise("kept"))
