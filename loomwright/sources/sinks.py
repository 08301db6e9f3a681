"""Sinks: plain files, routed outputs, partitions with their empty members, reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Keys that one JSON report may have.
MOST_KEYS = 10_000


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Text columns with a header; only ``columns``. Spark's commit makes it all or nothing."""
    cols = columns or df.columns
    df.select(*[F.col(c).cast("string").alias(c) for c in cols]).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def routed(df: DataFrame, path: str, route: Column) -> DataFrame:
    """One pass writes one folder per route; gives (route, n) of what was written."""
    df.withColumn("route", route).write.mode("overwrite").partitionBy("route").parquet(path)
    return df.sparkSession.read.parquet(path).groupBy("route").agg(F.count("*").alias("n"))


def partitioned(df: DataFrame, path: str, first: str, second: str, firsts: list[str], seconds: list[str]) -> DataFrame:
    """A folder for every combination of two enums, empty ones too; fails if a row fits none. Gives counts with zeros."""
    bad = df.where(~F.col(first).isin(firsts) | ~F.col(second).isin(seconds) | F.col(first).isNull() | F.col(second).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"row outside all outputs: {bad[0]}")
    df.write.mode("overwrite").partitionBy(first, second).parquet(path)
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for a in firsts:
        for b in seconds:
            fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{first}={a}/{second}={b}"))
    n = spark.read.schema(df.schema).parquet(path).groupBy(first, second).count()
    every = spark.createDataFrame([(a, b) for a in firsts for b in seconds], f"{first} string, {second} string")
    return every.join(n, [first, second], "left").select(first, second, F.coalesce("count", F.lit(0)).cast("long").alias("n"))


def head(df: DataFrame, position: str, n: int) -> DataFrame:
    return df.orderBy(position).limit(n)


def report(df: DataFrame, metrics: list[str]) -> DataFrame:
    """(metric, key, n, place): frequencies of several columns, most frequent first."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("key")) for m in metrics])).alias("p")
    g = df.select(pairs).groupBy("p.metric", "p.key").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.row_number().over(W.partitionBy("metric").orderBy(F.col("n").desc(), "key")))


def report_json(df: DataFrame, metrics: list[str], **settings) -> str:
    """The report as one JSON text of at most MOST_KEYS keys; more are an error, and belong in a table (``report``)."""
    out: dict = {"settings": settings}
    rows = report(df, metrics).orderBy("metric", "place").limit(MOST_KEYS + 1).collect()
    if len(rows) > MOST_KEYS:
        raise ValueError(f"over {MOST_KEYS} keys: write report() as a table")
    for r in rows:
        out.setdefault(r.metric, {})[r.key] = r.n
    return json.dumps(out, ensure_ascii=False)
