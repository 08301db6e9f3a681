"""Structured Streaming: incremental scans, idempotent upserts with a policy version, event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def upsert(spark: SparkSession, path: str, rows: DataFrame, key: str, batch_id: int) -> None:
    """Append the rows of a batch under its number; the same batch written again replaces itself."""
    rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def latest(spark: SparkSession, path: str, key: str, policy: str | None = None) -> DataFrame:
    """The last row of each key over all batches, of the current policy only."""
    d = spark.read.parquet(path)
    d = d.where(F.col("policy_version") == policy) if policy is not None else d
    return d.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(F.col("batch").desc()))).where("_r = 1").drop("_r")


def process(spark: SparkSession, source: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str, policy: str) -> None:
    """Run ``work`` over what is new in a stream and keep its rows under a policy version; a batch that is repeated after a
    failure replaces itself, so every row is kept once."""
    def each(batch: DataFrame, number: int) -> None:
        upsert(spark, out, work(batch).withColumn("policy_version", F.lit(policy)), key, number)

    source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def resume(spark: SparkSession, rows: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, key: str, policy: str, number: int) -> None:
    """Do what is missing: rows whose key has no result under this policy version. After a change of policy that is all of
    them; the older results stay in their batches and ``latest`` passes them over. ``number``: the batch to write."""
    try:
        done = latest(spark, out, key, policy).select(key)
    except AnalysisException:  # nothing written yet
        done = rows.limit(0).select(key)
    upsert(spark, out, work(rows.join(done, key, "left_anti")).withColumn("policy_version", F.lit(policy)), key, number)


def event_counts(events: DataFrame, at: str, kind: str, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts per window and kind of a stream of events, late ones up to ``late``."""
    return events.withWatermark(at, late).groupBy(F.window(at, window), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def shard_reports(parts: DataFrame, key: str) -> DataFrame:
    """Per-shard counters (shard, key, n) summed."""
    return parts.groupBy(key).agg(F.sum("n").alias("n"), F.count_distinct("shard").alias("shards"))
