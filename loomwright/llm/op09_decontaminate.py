"""Benchmark decontamination by a broadcast hash set of benchmark word windows. DataFrame functions only.

Words are runs of digits, A-Z (lower-cased), a-z and all characters from U+0080. A window is WINDOW consecutive words
of an item; an item with fewer words, but not none, is one window. Windows are hashed with xxhash64, the hashes of all
document windows are looked up in the broadcast benchmark windows, and a match counts only if the words agree too.

Null or word-less texts have no words and are clean; items without words have no windows. Each input row gives one row,
so repeated rows repeat; other columns pass by. The benchmark is broadcast only up to BROADCAST_WINDOWS windows; beyond
that the same lookup runs as a shuffled join of (row, place, hash), and words are compared where hashes agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import without, written

WINDOW = 10
#: Up to so many distinct benchmark windows (about 150 bytes each) are broadcast.
BROADCAST_WINDOWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else: lower() does just that on ASCII texts."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    low = F.regexp_replace(lowered(F.coalesce(text, F.lit(""))), rf"^{GAP}|{GAP}\z", "")
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, GAP))


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, words, items): the distinct windows with the sorted ids (strings) of their items."""
    w = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where("size(w) > 0 and item is not null")
    w = w.select("item", "w", F.least(F.size("w"), F.lit(WINDOW)).alias("size"))
    w = w.select("item", "size", "w", F.explode(F.sequence(F.lit(1), F.expr("size(w) - size + 1"))).alias("k"))
    w = w.select("item", "size", F.array_join(F.expr("slice(w, k, size)"), " ").alias("words")).distinct()
    return w.groupBy("size", "words").agg(F.array_sort(F.collect_list("item")).alias("items"))


def _hashed(words_: str, at: str, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.expr(f"get({words_}, {at} + {k})") for k in range(size)])


def hits(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_words: bool = False) -> DataFrame:
    """One row per input row: id, n_words, spans (sorted distinct struct<pos,size> of windows, from word 0), items, and with
    ``with_words`` the words ``w``."""
    spark, win = docs.sparkSession, written(benchmark_windows(benchmark))
    sizes = {r["size"]: r["n"] for r in win.groupBy("size").agg(F.count("*").alias("n")).collect()}  # WINDOW rows at most
    d = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), words(F.col(text_col)).alias("w"))
    small = sum(sizes.values()) <= BROADCAST_WINDOWS
    if not small:  # the row numbers have to agree when words are met again
        d = written(d)
    b = win.withColumn("bw", F.split("words", " "))
    of_size = F.lit(None).cast("long")
    for size in sizes:
        of_size = F.when(F.col("size") == size, _hashed("bw", "0", size)).otherwise(of_size)
    b = b.select(of_size.alias("k2"), F.col("size").alias("size2"), F.col("words").alias("bwords"), "items")
    # a row per word, and one for a text without words
    at = d.withColumn("n_words", F.size("w")).withColumn("pos", F.explode_outer(F.expr("if(size(w) > 0, sequence(0, size(w) - 1), null)")))
    if small:  # one broadcast lookup a size, all at the same row
        x, found = at, []
        for size in sorted(sizes):
            own = b.where(F.col("size2") == size).select(F.col("k2").alias(f"key{size}"), F.col("bwords").alias(f"words{size}"), F.col("items").alias(f"items{size}"))
            here = F.when(F.expr(f"pos + {size} <= n_words"), _hashed("w", "pos", size))
            same = F.array_join(F.expr(f"slice(w, pos + 1, {size})"), " ") == F.col(f"words{size}")
            x = x.join(F.broadcast(own), (here == F.col(f"key{size}")) & same, "left")
            found.append(size)
        met = [F.col(f"items{size}").isNotNull() for size in found]
        x = x.where(reduce(Column.__or__, met, F.coalesce("pos", F.lit(0)) == 0))  # one row at least of each document stays
        spans = F.array(*[F.when(m, F.struct("pos", F.lit(size).alias("size"))) for m, size in zip(met, found, strict=True)]) if found else F.array().cast("array<struct<pos:int,size:int>>")
        items = F.concat(F.array().cast("array<string>"), *[F.coalesce(f"items{size}", F.array().cast("array<string>")) for size in found])
        first_words = [F.first(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("w")), ignorenulls=True).alias("w")] if with_words else []
        g = x.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").cast("long").alias("n_words"), F.array_distinct(F.flatten(F.collect_set(F.array_compact(spans)))).alias("spans"), F.flatten(F.collect_set(items)).alias("items"), *first_words)
    else:  # only numbers are shuffled; words are compared where keys agree
        keys = F.array(*[F.struct(F.lit(size).alias("size"), F.when(F.expr(f"pos + {size} <= n_words"), _hashed("w", "pos", size)).alias("key")) for size in sorted(sizes)])
        window, span = F.array_join(F.expr("slice(w, pos + 1, size)"), " "), F.struct("pos", "size")
        x = at.select("row", "pos", F.explode(keys).alias("k")).select("row", "pos", "k.size", "k.key").where("key is not null")
        x = x.join(b, (F.col("key") == F.col("k2")) & (F.col("size") == F.col("size2"))).select(F.col("row").alias("r"), "pos", "size", "bwords", "items")
        x = x.join(d.select("row", "w"), F.col("r") == F.col("row")).where(window == F.col("bwords"))
        x = x.groupBy("r").agg(F.collect_set(span).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
        none = [F.coalesce("spans", F.array().cast("array<struct<pos:int,size:int>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")]
        g = d.join(x, F.col("row") == F.col("r"), "left").select("id", F.size("w").cast("long").alias("n_words"), *none, *(["w"] if with_words else []))
    return g.select(F.col("id").alias(id_col), "n_words", F.array_sort("spans").alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"), *(["w"] if with_words else []))


def covered() -> Column:
    """Words inside any span; spans are sorted."""
    return F.expr("aggregate(spans, struct(0L as n, 0L as until), (a, s) -> struct(a.n + greatest(0L, s.pos + s.size - greatest(a.until, cast(s.pos as long))) as n, greatest(a.until, cast(s.pos + s.size as long)) as until)).n")


def report(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    h = hits(docs, benchmark, id_col=id_col, text_col=text_col)
    return h.select(id_col, "n_words", covered().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of documents without any hit, all columns. Rows that share an id go together; rows without an id stay."""
    bad = report(docs, benchmark, id_col=id_col, text_col=text_col).where("contaminated").where(F.col(id_col).isNotNull())
    return without(docs, id_col, written(bad.select(id_col).distinct()))


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, kept_words): the normalised words outside all hits, joined by spaces."""
    h = hits(docs, benchmark, id_col=id_col, text_col=text_col, with_words=True)
    keep = F.expr("array_join(filter(w, (x, i) -> not exists(spans, s -> i >= s.pos and i < s.pos + s.size)), ' ')")
    return h.select(id_col, "n_words", covered().alias("n_hit"), F.when(F.size("spans") == 0, F.array_join("w", " ")).otherwise(keep).alias("kept_words"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM bs)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
h AS (SELECT doc_id, dw.n, k, item FROM dw JOIN bw USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM (SELECT DISTINCT doc_id, n, k FROM h)) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
"""
