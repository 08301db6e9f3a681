"""Shards, deterministic samples and top-n."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import written


def shard(df: DataFrame, position: str, index: int, count: int) -> DataFrame:
    """The rows of 1-based positions that fall to one of ``count`` shards."""
    return df.where(F.pmod(F.col(position) - 1, count) == index)


def concat_shards(parts: list[DataFrame]) -> DataFrame:
    """All parts, which must have the same columns."""
    if any(p.columns != parts[0].columns for p in parts):
        raise ValueError("parts have different columns")
    return reduce(DataFrame.unionByName, parts)


def hashed(key: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")), 256)


def bottom_k(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """The k rows of smallest seeded hash, ties by key: a top-k per partition and one merge, no full sort."""
    return df.orderBy(hashed(key, seed), key).limit(k)


def numbered(df: DataFrame, order: list, name: str = "place") -> DataFrame:
    """Places in an order. For results that are already small: it needs all rows together."""
    return df.withColumn(name, F.row_number().over(W.orderBy(*order)))


def ranked(df: DataFrame, key: str, seed: int) -> DataFrame:
    return numbered(df, [hashed(key, seed), key])


def stratified(df: DataFrame, stratum: str, key: str, total: int, seed: int) -> DataFrame:
    """Rows by seeded hash, as many per stratum as its share of ``total`` (largest remainders, ties by name), however many
    strata there are. Only each stratum's first rows are sought, so a large stratum is cut down in every partition before
    the shuffle."""
    n = written(df.groupBy(F.col(stratum).alias("_g")).agg(F.count("*").alias("_n")))
    every = n.agg(F.sum("_n")).first()[0] or 0
    if total >= every:
        return df
    exact = F.lit(float(total)) * F.col("_n") / F.lit(every)
    n = n.withColumn("_q", F.floor(exact)).withColumn("_left", F.round(exact - F.floor(exact), 9))
    seats = total - (n.agg(F.sum("_q")).first()[0] or 0)  # fewer than there are strata
    more = n.orderBy(F.desc("_left"), "_g").limit(seats).select(F.col("_g").alias("_m"), F.lit(1).alias("_one"))
    q = n.join(more, F.col("_g").eqNullSafe(F.col("_m")), "left").select("_g", (F.col("_q") + F.coalesce("_one", F.lit(0))).alias("_q"))
    w = W.partitionBy(stratum).orderBy(hashed(key, seed), key)
    ranked_ = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= total)
    return ranked_.join(q, F.col(stratum).eqNullSafe(F.col("_g"))).where("_rn <= _q").drop("_rn", "_g", "_q")


def modulo(df: DataFrame, key: Column, percent: int) -> DataFrame:
    """Rows whose key's hash (its first 48 bits) modulo 100 is below ``percent``."""
    return df.where(F.conv(F.substring(F.sha2(key, 256), 1, 12), 16, 10).cast("long") % 100 < percent)


def top_n(df: DataFrame, part: str, order: list, n: int) -> DataFrame:
    return df.withColumn("rn", F.row_number().over(W.partitionBy(part).orderBy(*order))).where(F.col("rn") <= n)
