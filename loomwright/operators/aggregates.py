"""Audit aggregates: counts with zeros, grouping sets, quantiles of three kinds, roll-ups, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_counts(df: DataFrame, row: str, col: str, rows: list[str], cols: list[str]) -> DataFrame:
    """Counts of two enums, zeros included."""
    have = df.groupBy(row).pivot(col, cols).count()
    every = df.sparkSession.createDataFrame([(r,) for r in rows], f"{row} string")
    return every.join(have, row, "left").na.fill(0, cols)


def single_key_sets(df: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    """One result for several single-key groupings: (dimension, key, measures), in one pass."""
    sets = df.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(*[F.grouping(k).alias(f"_g{i}") for i, k in enumerate(keys)], *[c.alias(n) for n, c in sums.items()])
    dim, val = None, None
    for i, k in enumerate(keys):
        on = F.col(f"_g{i}") == 0
        dim = F.when(on, k) if dim is None else dim.when(on, k)
        val = F.when(on, F.col(k).cast("string")) if val is None else val.when(on, F.col(k).cast("string"))
    return sets.select(dim.alias("dimension"), val.alias("key"), *sums)


def bins(df: DataFrame, value: Column, width: float = 0.1) -> DataFrame:
    """Counts per bin, a bin named by its lower bound; values are cut off towards zero."""
    n = round(1 / width)
    return df.where(value.isNotNull()).groupBy(((value * n).cast("long") / n).alias("bin")).count()


def nearest_rank(value: str, p: float) -> Column:
    """The smallest value with at least a share ``p`` at or below it."""
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {value})")


def floor_rank(df: DataFrame, part: str, value: str, p: float, name: str) -> DataFrame:
    """ordered[int((n - 1) * p)] of each part, by counting equal values first: no list of a part is made."""
    from pyspark.sql import Window as W

    n = df.where(F.col(value).isNotNull()).groupBy(part, value).agg(F.count("*").alias("_n"))
    w = W.partitionBy(part).orderBy(value)
    c = n.withColumn("_upto", F.sum("_n").over(w)).join(n.groupBy(part).agg(F.sum("_n").alias("_all")), part)
    at = F.floor((F.col("_all") - 1) * F.lit(p))
    return c.where((F.col("_upto") > at) & (F.col("_upto") - F.col("_n") <= at)).select(part, F.col(value).alias(name))


def known_sum(value: Column, name: str) -> list[Column]:
    """The sum of what is known (null if nothing is) and how much is missing."""
    return [F.sum(value).alias(name), F.count_if(value.isNull()).alias(f"{name}_missing")]


def weighted_mode(df: DataFrame, part: str, value: str, weight: Column) -> DataFrame:
    """The value of most weight in each part; of equals the smallest."""
    g = df.groupBy(part, value).agg(F.sum(weight).alias("weight"))
    return g.groupBy(part).agg(F.min_by(F.struct(value, "weight"), F.struct((-F.col("weight")).alias("w"), value)).alias("m")).select(part, f"m.{value}", "m.weight")


def conflicting(df: DataFrame, key: str) -> DataFrame:
    """Keys whose repeated rows are not identical."""
    rest = [c for c in df.columns if c != key]
    h = F.xxhash64(*rest)
    return df.groupBy(key).agg(F.min(h).alias("a"), F.max(h).alias("b"), F.count("*").alias("n")).where("a <> b").select(key, "n")


def distinct_rows(df: DataFrame, key: str) -> DataFrame:
    """One row per key; fails where rows of a key differ."""
    bad = conflicting(df, key).limit(1).collect()
    if bad:
        raise ValueError(f"rows of {key} {bad[0][0]} differ")
    return df.dropDuplicates([key])


def conserved(n_input: int, **parts: int) -> None:
    """Fail unless the parts add up to the input."""
    if n_input != sum(parts.values()):
        raise ValueError(f"{n_input} rows in, {parts} out")


def budgeted(lines: list[str], most: int, sep: int = 1) -> list[str]:
    """Lines in order while they fit a character budget; one that doesn't fit is left out and the next is tried. For a
    taxonomy's summary: a short list, on the driver."""
    out, used = [], 0
    for x in lines:
        need = len(x) + (sep if out else 0)
        if used + need <= most:
            out.append(x)
            used += need
    return out


def ancestor_coverage(counts: DataFrame, closure: DataFrame, record: str, node: str, least: int) -> DataFrame:
    """Distinct records at or below each node, and whether they reach ``least``. closure: ancestor, node."""
    j = closure.join(counts.select(record, F.col(node).alias("node")).distinct(), "node", "left")
    return j.groupBy("ancestor").agg(F.count_distinct(record).alias("n_records")).withColumn("covered", F.col("n_records") >= least)
