"""URL filters: fixed host-and-path rules, then association rules mined from labels. DataFrame functions throughout.

A fixed rule ``host/path`` fits its host and all subdomains if the url's path starts with the rule's path; the longest
rule wins (ties: the longer host, then the rule's text). For urls that no fixed rule fits, Spark's FP-growth mines
combinations of url tokens and verdicts from labelled urls; rules below the least support or confidence, and rules with a
more general one of no less confidence, are pruned. Tokens below the least support are left out before, as no rule can hold
them, and of tokens that stand in exactly the same labelled urls only the first is mined, as any set with one of the others
has the same support. Where a url has more than MOST_TOKENS
such tokens, for which all frequent sets may be too many, sets are grown item by item instead, and only from those that
pruning leaves something of; the rules are the same. A url is matched through an inverted index, each rule posted under
the rarest of its tokens; the rule of highest confidence (then support, then most tokens, then its text) decides. Where
none fits, the verdict is ``allow``.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there to ``?``, ``#`` or
the end. A null url or one without ``://`` has neither and no tokens. Equal urls are judged once; repeated rows repeat;
empty tables give empty results; without labels nothing is mined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
LEAST_SUPPORT, LEAST_CONFIDENCE = 0.005, 0.6
#: Tokens of a url up to which all its sets, at most 2 ** MOST_TOKENS, are mined by FP-growth.
MOST_TOKENS = 12
#: Up to so many mined rules (a few hundred bytes each) are broadcast.
BROADCAST_RULES = 50_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"\A[\s\S]*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"\A[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(url: Column, rules: list[tuple[str, str]]) -> Column:
    """The rule (text) that decides, or null. Rules are a short list of settings."""
    table = F.array(*[F.struct(F.lit(r.partition("/")[0]).alias("host"), F.lit("/" + r.partition("/")[2]).alias("path"), F.lit(r).alias("rule")) for r, _ in rules]) if rules else None
    if table is None:
        return F.lit(None).cast("string")
    h, p = host(url), path(url)
    fit = F.filter(table, lambda r: ((h == r["host"]) | F.endswith(h, F.concat(F.lit("."), r["host"]))) & F.startswith(p, r["path"]))
    best = F.array_max(F.transform(fit, lambda r: F.struct(F.length(r["rule"]).alias("n"), F.length(r["host"]).alias("h"), r["rule"].alias("rule"))))
    return best["rule"]


def tokens(url: Column) -> Column:
    """Sorted distinct tokens: scheme, host labels, path segments (numbers as #), file endings and query names."""
    scheme = F.regexp_extract(url, r"\A([\s\S]*?)://", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = lambda text, cut, tag: F.transform(F.filter(F.split(text, cut), lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))
    every = F.concat(F.array(F.concat(F.lit("s:"), scheme)), parts(host(url), r"\.", "h:"), parts(F.regexp_replace(path(url), r"\d+", "#"), r"[/.]", "p:"), parts(F.regexp_replace(query, r"=[^&]*", ""), "&", "q:"))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


def _all_sets(baskets: DataFrame, support: float) -> DataFrame:
    """(items, verdict, hits, seen) of all frequent sets of ``baskets(kept, verdict, n)``, by FP-growth."""
    rows = baskets.select(F.explode(F.expr("sequence(1L, n)")), F.concat(F.array(F.concat(F.lit("verdict="), "verdict")), "kept").alias("items")).select("items")
    sets = written(FPGrowth(itemsCol="items", minSupport=support).fit(rows).freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    whole = F.filter("items", lambda x: x.startswith("verdict="))
    both = sets.where(F.size(whole) == 1).select(F.filter("items", lambda x: ~x.startswith("verdict=")).alias("items"), F.expr("substring(filter(items, x -> startswith(x, 'verdict='))[0], 9)").alias("verdict"), F.col("freq").alias("hits")).where(F.size("items") > 0)
    return both.join(sets.withColumnRenamed("freq", "seen"), "items")


def _telling_sets(baskets: DataFrame, verdicts: list[str], least: float) -> DataFrame:
    """The same, but only of the sets that rules can be left of: those whose parts with one item less are met more often than
    they and with several verdicts. A set that is met as often as a part of it says no more than that part, nor does one with
    a part that is always of one verdict; nor do larger ones that hold such a set. So sets grow by an item at a time from those
    that are left, each kept with the baskets that hold it."""
    of = F.array(*[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)) for v in verdicts])
    total, parts = F.expr("aggregate(hits, 0L, (a, x) -> a + x)"), []
    held = written(baskets.withColumn("basket", F.monotonically_increasing_id()))
    occ = held.select("basket", "verdict", "n", F.explode("kept").alias("token")).select(F.array("token").alias("items"), "basket", "verdict", "n")
    good = None
    while True:
        sets = occ.groupBy("items").agg(of.alias("hits")).withColumn("seen", total).where(F.array_max("hits") >= least)
        if good is not None:  # all parts are among the good ones and are met more often
            out = sets.select("items", "hits", "seen", F.explode("items").alias("out")).select("items", "hits", "seen", F.array_remove("items", F.col("out")).alias("part"))
            out = out.join(good.select(F.col("items").alias("part"), F.col("seen").alias("part_seen")), "part").where("part_seen > seen")
            sets = out.groupBy("items").agg(F.first("hits").alias("hits"), F.first("seen").alias("seen"), F.count("*").alias("parts")).where("parts = size(items)").drop("parts")
        sets = written(sets)
        if sets.isEmpty():
            break
        parts.append(sets)
        good = sets.where(F.array_max("hits") < F.col("seen"))
        occ = written(occ.join(good.select("items"), "items", "left_semi"))
        head = lambda a: F.slice(a, 1, F.size(a) - 1)
        x = occ.select("basket", "verdict", "n", F.col("items").alias("x"), head(F.col("items")).alias("head"))
        y = occ.select("basket", F.col("items").alias("y"), head(F.col("items")).alias("head"))
        occ = written(x.join(y, ["basket", "head"]).where("element_at(x, -1) < element_at(y, -1)").select(F.expr("concat(x, slice(y, -1, 1))").alias("items"), "basket", "verdict", "n"))
    every = reduce(DataFrame.unionByName, parts) if parts else baskets.sparkSession.createDataFrame([], "items array<string>, hits array<long>, seen long")
    one = every.select("items", "seen", F.posexplode("hits").alias("at", "hits"))
    return one.where(F.col("hits") >= least).select("items", F.element_at(F.array(*[F.lit(v) for v in verdicts]), F.col("at") + 1).alias("verdict"), "hits", "seen")


def mine(labelled: DataFrame, *, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """Rules from ``labelled(url, verdict)``: (rule_id, items, verdict, support, confidence)."""
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule_id string, items array<string>, verdict string, support double, confidence double")
    rows = labelled.where("url is not null and verdict is not null").select("url", "verdict").groupBy("url", "verdict").agg(F.count("*").alias("n"))
    rows = written(rows.select(F.xxhash64("url", "verdict").alias("row"), "verdict", "n", tokens(F.col("url")).alias("items")))
    shares = {r.verdict: r.n for r in rows.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}  # a row per verdict
    n = sum(shares.values())
    if not n:
        return empty
    held = rows.select("row", "verdict", "n", F.explode("items").alias("token"))
    seen = held.groupBy("token").agg(F.sum("n").alias("hits"), F.sum(F.col("row").cast("decimal(38,0)")).alias("where"))
    # one token for all that stand in the same urls; at most 1 / support tokens of a kind are left for each place in a url
    mined = seen.where(F.col("hits") >= support * n).groupBy("hits", "where").agg(F.min("token").alias("token")).select("token")
    best = held.join(mined, "token").groupBy("row").agg(F.array_sort(F.collect_set("token")).alias("kept")).withColumnRenamed("row", "r")
    whole_row = rows.join(best, F.col("row") == F.col("r"), "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<string>")))
    baskets = written(whole_row.groupBy("kept", "verdict").agg(F.sum("n").alias("n")))
    longest = baskets.agg(F.max(F.size("kept"))).first()[0] or 0
    sets = _all_sets(baskets, support) if longest <= MOST_TOKENS else _telling_sets(baskets, sorted(shares), support * n)
    rules = sets.select("items", "verdict", (F.col("hits") / n).alias("support"), (F.col("hits") / F.col("seen")).alias("confidence")).where(F.col("confidence") >= confidence)
    # a rule goes if one with a part of its items and the same verdict is no less sure
    part = rules.select("items", "verdict", "confidence", F.explode("items").alias("out")).select("verdict", "confidence", F.col("items").alias("long"), F.array_remove("items", F.col("out")).alias("items"))
    worse = part.join(rules.select("items", "verdict", F.col("confidence").alias("short_c")), ["items", "verdict"]).where("short_c >= confidence").select(F.col("long").alias("items"), "verdict").distinct()
    kept = rules.join(worse, ["items", "verdict"], "left_anti")
    return kept.select(F.concat_ws(" ", "items").alias("rule_id"), "items", "verdict", "support", "confidence")


def mined_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, mined, mined_rule) for the distinct urls of ``urls`` that a mined rule fits."""
    rules = written(rules)
    small = rules.count() <= BROADCAST_RULES
    common = rules.select(F.explode("items").alias("token")).groupBy("token").count()  # how many rules hold a token
    post = rules.select("rule_id", F.explode("items").alias("token")).join(common, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    index = rules.join(post, "rule_id")
    u = urls.where("url is not null").select("url").distinct().withColumn("all", tokens(F.col("url")))
    u = u.select("url", "all", F.explode("all").alias("token")).join(F.broadcast(index) if small else index, "token").where(F.size(F.array_except("items", "all")) == 0)
    rank = F.struct("confidence", "support", F.size("items").alias("n"), "rule_id")
    return u.groupBy("url").agg(F.max_by("verdict", rank).alias("mined"), F.max_by("rule_id", rank).alias("mined_rule"))


def judge(pages: DataFrame, labelled: DataFrame, *, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    d = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    m = mined_verdicts(d, mine(labelled)).withColumnRenamed("url", "u")
    j = d.join(m, F.col("url") == F.col("u"), "left").withColumn("rule", fitting_rule(F.col("url"), rules))
    fixed = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in r]), F.col("rule")) if rules else F.lit(None)
    return j.select(id_col, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "rule", F.coalesce(fixed, "mined", F.lit("allow")).alias("verdict"), F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: a page counts as blocked if the label of its number is toxic or of no quality. The labels are of documents, so
    that says nothing true of the pages: it only gives the miner something to learn; pass labels of urls to ``judge``."""
    pages, labels = spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.select(F.col("doc_id").alias("page_id"), F.when((F.col("toxic") == 1) | (F.col("quality") == 0), "block").otherwise("allow").alias("verdict"))
    return judge(pages, pages.select("page_id", "url").join(known, "page_id").select("url", "verdict"))
