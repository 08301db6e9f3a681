"""Positional operators: neighbours, islands, stacks of headings, interval unions, evenly spread samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lines(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, line_no from 1, line)"""
    return docs.select(ident, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("k", "line")).select(ident, (F.col("k") + 1).alias("line_no"), "line")


def neighbours(df: DataFrame, part: str, order: str, value: str) -> DataFrame:
    w = W.partitionBy(part).orderBy(order)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


def islands(df: DataFrame, part: str, order: str, most_gap: int, least: int) -> DataFrame:
    """Runs of rows whose places are at most ``most_gap`` apart, of ``least`` rows or more: (part, first, last, n)."""
    w = W.partitionBy(part).orderBy(order)
    new = (F.col(order) - F.lag(order).over(w) > most_gap).cast("int")
    g = df.withColumn("_new", F.coalesce(new, F.lit(0))).withColumn("_run", F.sum("_new").over(w))
    return g.groupBy(part, "_run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).where(F.col("n") >= least).drop("_run")


def heading_paths(heads: DataFrame, part: str, order: str, level: str, title: str, levels: int | None = None) -> DataFrame:
    """Adds ``parents``: the titles of the open headings above each one. For each level its last heading so far, left out
    if a heading of a smaller level has come since: one window, no stack. Levels go from 1 to ``levels``, else to the
    deepest there is."""
    levels = levels or heads.agg(F.max(level)).first()[0] or 1
    w = W.partitionBy(part).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    d = heads
    for k in range(1, levels):
        d = d.withColumn(f"_at{k}", F.max(F.when(F.col(level) == k, F.struct(F.col(order).alias("o"), F.col(title).alias("t")))).over(w))
    open_ = []
    for k in range(1, levels):
        later = [F.coalesce(F.col(f"_at{j}.o"), F.lit(-1)) for j in range(1, k)]
        shut = F.greatest(F.lit(-1), F.lit(-1), *later) > F.col(f"_at{k}.o")
        open_.append(F.when((F.col(level) > k) & F.col(f"_at{k}").isNotNull() & ~shut, F.col(f"_at{k}.t")))
    return d.withColumn("parents", F.array_compact(F.array(*open_))).drop(*[f"_at{k}" for k in range(1, levels)])


def level_jumps(df: DataFrame, part: str, order: str, level: str) -> DataFrame:
    """Adds ``jump``: a level more than one below the one before."""
    return df.withColumn("jump", F.coalesce(F.col(level) > F.lag(level).over(W.partitionBy(part).orderBy(order)) + 1, F.lit(False)))


def number_breaks(df: DataFrame, part: list[str], order: str, number: str) -> DataFrame:
    """Adds ``break``: a number that does not follow the one before."""
    return df.withColumn("break", F.coalesce(F.col(number) != F.lag(number).over(W.partitionBy(*part).orderBy(order)) + 1, F.lit(False)))


def active_time(df: DataFrame, part: str, start: str, end: str) -> DataFrame:
    """Length of the union of each part's intervals, the sum of their lengths, and the span."""
    w = W.partitionBy(part).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    own = F.greatest(F.lit(0), F.col(end) - F.greatest(F.col(start), F.coalesce(before, F.col(start))))
    return df.withColumn("_own", own).groupBy(part).agg(F.sum("_own").alias("active"), F.sum(F.col(end) - F.col(start)).alias("work"), (F.max(end) - F.min(start)).alias("span"))


def paired(events: DataFrame, keys: list[str], order: list[str], kind: str, start: str, finish: str, at: str) -> DataFrame:
    """Starts and finishes of a key matched first in, first out; an unfinished start has a null end."""
    w = W.partitionBy(*keys).orderBy(*order)
    a = events.where(F.col(kind) == start).withColumn("n", F.row_number().over(w)).select(*keys, "n", F.col(at).alias("start"))
    b = events.where(F.col(kind) == finish).withColumn("n", F.row_number().over(w)).select(*keys, "n", F.col(at).alias("end"))
    return a.join(b, [*keys, "n"], "left")


def spread(size: Column, window: int, count: int) -> Column:
    """Starts of ``count`` windows spread evenly from the beginning to the end of a text."""
    last = F.greatest(size - window, F.lit(0))
    return F.when(size <= window, F.array(F.lit(0))).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.bround(i * last / (count - 1)).cast("int"))))


def spread_samples(docs: DataFrame, ident: str, text: str, window: int, count: int) -> DataFrame:
    """(id, sample_no, start, sample): windows of a text whose starts are moved to the next line where one begins in them."""
    d = docs.withColumn("_s", spread(F.length(text), window, count))
    d = d.select(ident, text, F.posexplode("_s").alias("sample_no", "start"))
    nl = F.expr(f"locate('\\n', {text}, start + 1)")
    moved = F.when((F.col("start") > 0) & (nl > 0) & (nl - F.col("start") < window), nl).otherwise(F.col("start"))
    return d.withColumn("start", moved.cast("int")).withColumn("sample", F.substr(F.col(text), F.col("start") + 1, F.lit(window))).drop(text)


def fractile_windows(rows: DataFrame, part: str, order: str, value: str, shares: list[float], around: int) -> DataFrame:
    """For each share of the non-empty lines: (part, share, line, from, to)."""
    full = rows.where(F.trim(F.col(value)) != "")
    w = W.partitionBy(part)
    d = full.withColumn("_n", F.count("*").over(w)).withColumn("_k", F.row_number().over(w.orderBy(order)))
    hit = None
    for s in shares:
        x = d.where(F.col("_k") == F.floor((F.col("_n") - 1) * s).cast("int") + 1).select(part, F.lit(s).alias("share"), F.col(order).alias("line"))
        hit = x if hit is None else hit.unionByName(x)
    return hit.withColumn("first", F.greatest(F.col("line") - around, F.lit(1))).withColumn("last", F.col("line") + around)


def zone_picks(rows: DataFrame, part: str, order: str, score: str, zones: int) -> DataFrame:
    """The best row of each of ``zones`` equal stretches of a part, the nearest to its middle on ties."""
    n = F.max(order).over(W.partitionBy(part))
    d = rows.withColumn("zone", F.least(F.floor((F.col(order) - 1) * zones / n), F.lit(zones - 1)).cast("int")).withColumn("_mid", F.abs(F.col(order) - (F.col("zone") + 0.5) * n / zones))
    w = W.partitionBy(part, "zone").orderBy(F.col(score).desc(), "_mid", order)
    return d.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_mid")


def nth_place(text: Column, quote: Column, n: int) -> Column:
    """1-based place of the n-th literal occurrence, without overlap; 0 if there are fewer. Cut at the quote, the parts
    before it tell the place."""
    parts = F.split(text, F.concat(F.lit(r"\Q"), quote, F.lit(r"\E")))
    before = F.aggregate(F.slice(parts, 1, n), F.lit(0), lambda a, p: a + F.length(p))
    return F.when((F.size(parts) > n) & (quote != ""), before + (n - 1) * F.length(quote) + 1).otherwise(0)


def failure_rate(events: DataFrame, part: str, order: list[str], failed: Column, last: int) -> DataFrame:
    """Adds ``rate``: the share of failures among the last ``last`` events of a part, once there are so many."""
    w = W.partitionBy(part).orderBy(*order)
    frame = w.rowsBetween(-(last - 1), 0)
    return events.withColumn("rate", F.when(F.count("*").over(frame) == last, F.sum(failed.cast("int")).over(frame) / last))


def quiet_runs(rows: DataFrame, part: str, order: list[str], busy: Column, least: int) -> DataFrame:
    """Rows that are the ``least``-th or later of a run without activity."""
    w = W.partitionBy(part).orderBy(*order)
    d = rows.withColumn("_busy", busy.cast("int")).withColumn("_run", F.sum("_busy").over(w))
    d = d.withColumn("_k", F.sum(1 - F.col("_busy")).over(W.partitionBy(part, "_run").orderBy(*order)))
    return d.where((F.col("_busy") == 0) & (F.col("_k") >= least)).drop("_busy", "_run", "_k")
