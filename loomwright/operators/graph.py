"""Scratch tables and connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Up to so many edges (16 bytes each) are united by one task; beyond it, star steps run over all tasks.
ONE_TASK_EDGES = 100_000
_made: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names. Only a local master, whose tasks all run on this
    machine, may leave that unset."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"/tmp/loomwright-{spark.sparkContext.applicationId}"
    return f"{base.rstrip('/')}/lw-{uuid.uuid4().hex[:16]}"


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def temporary(spark: SparkSession) -> str:
    """A scratch path that goes when the session ends, or when ``alone`` clears up."""
    path = scratch(spark)
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    _made.append(path)
    return path


def written(df: DataFrame, fmt: str = "parquet", **options: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again, so lost executors cost nothing upstream."""
    spark, path, schema = df.sparkSession, temporary(df.sparkSession), df.schema
    writer = df.write.format(fmt).options(**options)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    writer.save(path)
    return spark.read.schema(schema).format(fmt).load(path)


def alone(spark: SparkSession, build: Callable[[], DataFrame], last: DataFrame | None = None) -> DataFrame:
    """What ``build`` gives, written; every other table that it wrote meanwhile is deleted, and so is ``last`` if it is one
    that ``alone`` gave."""
    before = len(_made)
    out = written(build())
    old = [p for p in _made if last is not None and getattr(last, "_alone", None) == p]
    out._alone = _made[-1]
    for path in [*_made[before:-1], *old]:
        fs, at = _file_system(spark, path)
        fs.delete(at, True)
        _made.remove(path)
    return out


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of all edges in: each node but the smallest of its component, and that one."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    low = [(x, find(x)) for x in root]
    low = [p for p in low if p[0] != p[1]]
    yield pa.record_batch([pa.array([p[k] for p in low], pa.int64()) for k in (0, 1)], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)``, longs; a component is named by its smallest node.

    Alternating large-star and small-star steps: each only needs a minimum per node (pre-aggregated before the shuffle) and
    a join that can be split, so a hub with very many neighbours never meets one task. What shows that nothing changed any
    more is observed while a step is written. Once no more than ONE_TASK_EDGES edges are left, one task unites them.
    """
    e = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).where("u <> v").distinct()
    before = None
    for k in range(max_rounds):
        if k:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
            e = small.where("u <> v").distinct()
        seen = Observation()
        e = written(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        now = seen.get
        if now["n"] <= ONE_TASK_EDGES:
            e = written(e.coalesce(1).mapInArrow(_united, "u long, v long")) if now["n"] else e
            break
        if before == now:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
