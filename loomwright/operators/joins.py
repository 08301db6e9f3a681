"""Joins with the guarantees that the pipelines need: coverage, defaults, overlays, intervals, as-of, prefixes, terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, problem): what keeps a join from being one to one and complete; no rows if nothing does."""
    a = left.groupBy(key).agg(F.count("*").alias("n_left"))
    b = right.groupBy(key).agg(F.count("*").alias("n_right"))
    j = a.join(b, key, "full_outer")
    p = F.when(F.col("n_right").isNull(), "missing").when(F.col("n_left").isNull(), "extra").when((F.col("n_left") > 1) | (F.col("n_right") > 1), "duplicate")
    return j.select(key, p.alias("problem")).where("problem is not null")


def covered_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails unless both sides have each key exactly once."""
    bad = coverage(left, right, key).limit(1).collect()
    if bad:
        raise ValueError(f"join on {key} is not complete: {bad[0]}")
    return left.join(right, key)


def with_default(left: DataFrame, right: DataFrame, key: str, **defaults) -> DataFrame:
    """Left join in which rows without a match get defaults."""
    marked = right.withColumn("_found", F.lit(True))
    j = left.join(marked, key, "left")
    for name, value in defaults.items():
        j = j.withColumn(name, F.when(F.col("_found"), F.col(name)).otherwise(F.lit(value)))
    return j.drop("_found")


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def overlay(base: DataFrame, layers: list[DataFrame], key: str, value: str) -> DataFrame:
    """Keyed updates in order: the last layer that has a key wins; ``trace`` lists the layers that touched it."""
    every = [base.select(key, value, F.lit(0).alias("step"))] + [d.select(key, value, F.lit(k + 1).alias("step")) for k, d in enumerate(layers)]
    u = reduce(DataFrame.unionByName, every)
    g = u.groupBy(key).agg(F.max_by(value, "step").alias(value), F.array_sort(F.collect_set("step")).alias("trace"), F.min("step").alias("first"))
    return g.where("first = 0").drop("first")  # a layer may only change what the base has


def transitions(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """How many keys went from which value to which."""
    a, b = before.select(key, F.col(value).alias("before")), after.select(key, F.col(value).alias("after"))
    return a.join(b, key).groupBy("before", "after").count()


def overlapping(intervals: DataFrame, part: str, start: str, end: str, ident: str) -> DataFrame:
    """Intervals (half-open) that meet an earlier one of their part, by a sweep: no pair is made."""
    w = W.partitionBy(part).orderBy(start, ident)
    before = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    return intervals.withColumn("overlaps", F.coalesce(F.col(start) < before, F.lit(False)))


def range_join(left: DataFrame, right: DataFrame, part: str, width: int) -> DataFrame:
    """Pairs of ``left(a, s, e)`` and ``right(b, s2, e2)`` of one part whose half-open integer intervals meet. Both sides are
    cut into bins of ``width``, and a pair is given in the bin of its later start only, so a join key is one bin of one part."""
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.greatest(F.col(e), F.col(s) + 1) - 1) / width)))
    x, y = left.withColumn("bin", bins("s", "e")), right.withColumn("bin", bins("s2", "e2"))
    return x.join(y, [part, "bin"]).where((F.col("s") < F.col("e2")) & (F.col("s2") < F.col("e")) & (F.floor(F.greatest("s", "s2") / width) == F.col("bin")))


def as_of(rows: DataFrame, events: DataFrame, part: str, pos: str, value: str) -> DataFrame:
    """Each row with the last event value at or before its place: one union, one window, no join."""
    u = rows.select(part, pos, F.lit(1).alias("kind"), F.lit(None).cast(events.schema[value].dataType).alias("_v"))
    u = u.unionByName(events.select(part, pos, F.lit(0).alias("kind"), F.col(value).alias("_v")))
    w = W.partitionBy(part).orderBy(pos, "kind").rowsBetween(W.unboundedPreceding, 0)
    return u.withColumn(value, F.last("_v", ignorenulls=True).over(w)).where("kind = 1").drop("kind", "_v")


def longest_prefix(rows: DataFrame, col: str, prefixes: DataFrame, prefix: str, value: str) -> DataFrame:
    """Each row with the value of the longest prefix of its text. Every prefix length of the text is looked up by equality,
    so the join is a hash join, not a loop; only lengths that occur are tried (no more than the longest prefix has characters)."""
    lengths = [r[0] for r in prefixes.select(F.length(prefix).alias("n")).where("n is not null").distinct().orderBy("n").collect()]
    if not lengths:
        return rows.withColumn(value, F.lit(None).cast("string"))
    tried = F.from_json(F.lit(str(lengths)), "array<int>")
    keyed = rows.select(col).distinct().withColumn("_n", F.explode(F.filter(tried, lambda n: n <= F.length(col))))
    keyed = keyed.withColumn("_p", F.substr(F.col(col), F.lit(1), F.col("_n")))
    hit = keyed.join(prefixes.select(F.col(prefix).alias("_p"), F.col(value).alias("_v")), "_p").groupBy(col).agg(F.max_by("_v", "_n").alias(value))
    return rows.join(hit, col, "left")


def matched_terms(rows: DataFrame, col: str, terms: list[str]) -> DataFrame:
    """Adds ``terms``: the distinct terms in the text, ASCII terms as whole words, overlapping ones too. The term list is a
    setting; it becomes one pattern, so there is no loop join."""
    return rows.withColumn("terms", T.term_hits(F.lower(F.col(col)), terms))


def mentions(docs: DataFrame, names: DataFrame, ident: str, text: str, name: str, most: int = 8, word: str = r"(?U)\w+") -> DataFrame:
    """Multi-pattern join of names and texts at word boundaries: (name, id, place), the first ``most`` per name. Word n-grams
    of the texts, of the lengths that names have, meet the names by equality."""
    low = F.lower(F.col(text))
    own = F.regexp_extract_all(F.lower(F.col(name)), F.lit(word), F.lit(0))
    n = names.select(F.col(name).alias("name"), F.array_join(own, " ").alias("key"), F.size(own).alias("words")).where("key <> ''").distinct()
    sizes = [r.words for r in n.select("words").distinct().orderBy("words").collect()]  # as many as names differ in length
    if not sizes:
        return docs.limit(0).select(F.lit("").alias("name"), ident, F.lit(0).alias("place"), F.lit(0).alias("hit"))
    d = docs.select(ident, F.regexp_extract_all(low, F.lit(word), F.lit(0)).alias("w")).select(ident, "w", F.posexplode("w").alias("place", "_")).drop("_")
    d = d.select(ident, "place", F.explode(F.array(*[F.when(F.col("place") + k <= F.size("w"), F.array_join(F.slice("w", F.col("place") + 1, k), " ")) for k in sizes])).alias("key")).where("key is not null")
    n = n.drop("words")
    w = W.partitionBy("name").orderBy(ident, "place")
    return d.join(n, "key").withColumn("hit", F.row_number().over(w)).where(F.col("hit") <= most).select("name", ident, "place", "hit")


def unique_line_match(a: DataFrame, b: DataFrame, key: Column) -> DataFrame:
    """Lines of two renderings of a document that are unique in both: (doc, line, other_line)."""
    x = a.withColumn("_k", key).groupBy("doc_id", "_k").agg(F.count("*").alias("n"), F.min("line_no").alias("line"))
    y = b.withColumn("_k", key).groupBy("doc_id", "_k").agg(F.count("*").alias("m"), F.min("line_no").alias("other_line"))
    return x.join(y, ["doc_id", "_k"]).where((F.col("n") == 1) & (F.col("m") == 1)).select("doc_id", "line", "other_line")
