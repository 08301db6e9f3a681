"""Aggregates over the driver's tables."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import sampling as S
from .registry import query, table


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2")
def counts_by_key(s, d):
    return table(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))


@query("""
WITH o AS (SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
SELECT 'o_orderpriority' AS dimension, o_orderpriority AS key, count(*) AS n, CAST(sum(c) AS BIGINT) AS cents FROM o GROUP BY 2 UNION ALL
SELECT 'o_orderstatus', o_orderstatus, count(*), CAST(sum(c) AS BIGINT) FROM o GROUP BY 2 UNION ALL SELECT 'y', y, count(*), CAST(sum(c) AS BIGINT) FROM o GROUP BY 2""")
def grouping_sets_usage(s, d):
    o = table(s, d, "orders").select("o_orderpriority", "o_orderstatus", F.year("o_orderdate").cast("string").alias("y"), F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    return A.single_key_sets(o, ["o_orderpriority", "o_orderstatus", "y"], n=F.count("*"), cents=F.sum("c"))


@query("""
WITH o AS (SELECT o_orderpriority AS track, CASE o_orderstatus WHEN 'F' THEN 'KEEP' WHEN 'O' THEN 'REVIEW' ELSE 'DROP' END AS dec FROM orders),
t AS (SELECT DISTINCT o_orderpriority AS track FROM orders UNION SELECT '9-NONE')
SELECT t.track, count(*) FILTER (dec = 'KEEP') AS KEEP, count(*) FILTER (dec = 'REVIEW') AS REVIEW, count(*) FILTER (dec = 'DROP') AS DROP FROM t LEFT JOIN o USING (track) GROUP BY 1""")
def track_decision_pivot(s, d):
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("track"), F.when(F.col("o_orderstatus") == "F", "KEEP").when(F.col("o_orderstatus") == "O", "REVIEW").otherwise("DROP").alias("dec"))
    tracks = [r[0] for r in o.select("track").distinct().collect()] + ["9-NONE"]  # an enum
    return A.pivot_counts(o, "track", "dec", sorted(tracks), ["KEEP", "REVIEW", "DROP"])


@query("SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def shard_union_equivalence(s, d):
    """Per-shard results merged again are the whole result: shards by position modulo, checked for equal columns."""
    rows = table(s, d, "lineitem").withColumn("n", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    shards = [S.shard(rows, "n", k, 3).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity")) for k in range(3)]
    return S.concat_shards(shards).groupBy("l_returnflag").agg(F.sum("n").alias("n"), F.sum("quantity").cast("long").alias("quantity"))


@query("SELECT CAST(floor(l_discount * 100 + 0.5) AS BIGINT) // 10 / 10.0::DOUBLE AS bin, count(*) AS count FROM lineitem GROUP BY 1")
def confidence_bins(s, d):
    return A.bins(table(s, d, "lineitem"), F.floor(F.col("l_discount") * 100 + 0.5) / 100)


@query("SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, count(*) AS n FROM events GROUP BY 1")
def quantiles_nearest_rank(s, d):
    return table(s, d, "events").groupBy("event_type").agg(A.nearest_rank("value", 0.5).alias("p50"), A.nearest_rank("value", 0.95).alias("p95"), F.count("*").alias("n"))


@query("SELECT event_type, min(value) AS lo, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS hi FROM events GROUP BY 1")
def quantiles_linear(s, d):
    q = F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    g = table(s, d, "events").groupBy("event_type").agg(F.min("value").alias("lo"), q.alias("q"), F.max("value").alias("hi"))
    return g.select("event_type", "lo", *[F.round(F.col("q")[k], 6).alias(n) for k, n in enumerate(("p25", "p50", "p75"))], "hi")


@query("SELECT source, list_sort(list(n_chars))[CAST(floor((count(*) - 1) * 0.9) AS BIGINT) + 1] AS p90 FROM documents GROUP BY 1")
def quantile_floor_index(s, d):
    return A.floor_rank(table(s, d, "documents"), "source", "n_chars", 0.9, "p90")


@query("""
WITH e AS (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) END AS k FROM events)
SELECT event_type, CAST(sum(k) AS BIGINT) AS k, count(*) FILTER (k IS NULL) AS k_missing FROM e GROUP BY 1""")
def null_aware_sum(s, d):
    e = table(s, d, "events").withColumn("v", F.when(F.col("event_id") % 3 != 0, F.get_json_object("props", "$.k").cast("long")))
    return e.groupBy("event_type").agg(*A.known_sum(F.col("v"), "k"))


@query("""
WITH g AS (SELECT source, lang, CAST(sum(n_chars) AS BIGINT) AS weight FROM documents GROUP BY 1, 2)
SELECT source, lang, weight FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY weight DESC, lang) AS r FROM g) WHERE r = 1""")
def mode_weighted(s, d):
    return A.weighted_mode(table(s, d, "documents"), "source", "lang", F.col("n_chars"))


@query("""
WITH e AS (SELECT event_id % 700 AS k, event_type, user_id % 3 AS u FROM events)
SELECT k, count(*) AS n FROM e GROUP BY k HAVING count(DISTINCT event_type || u) > 1""")
def event_conflicts(s, d):
    return A.conflicting(table(s, d, "events").select((F.col("event_id") % 700).alias("k"), "event_type", (F.col("user_id") % 3).alias("u")), "k")


@query("""
WITH c AS (SELECT doc_id, unnest(['short','long','labelled']) AS flag, unnest([n_chars < 500, n_chars >= 5000, doc_id IN (SELECT doc_id FROM labels)]) AS on_ FROM documents)
SELECT flag, count(*) AS n FROM c WHERE on_ GROUP BY 1""")
def rule_flag_counts(s, d):
    """Frequencies of multi-valued flags."""
    from ..functions import text as T

    x = table(s, d, "documents").join(table(s, d, "labels").select("doc_id", F.lit(True).alias("l")), "doc_id", "left")
    flags = T.reasons((F.col("n_chars") < 500, "short"), (F.col("n_chars") >= 5000, "long"), (F.col("l"), "labelled"))
    return x.select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT 'source' AS metric, source AS key, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY 2)
SELECT metric, key, n, CAST(row_number() OVER (PARTITION BY metric ORDER BY n DESC, key) AS INT) AS place FROM r""")
def report_counts(s, d):
    """What a report sink writes: ordered frequencies per metric."""
    from ..sources.sinks import report

    return report(table(s, d, "documents"), ["source", "lang"])


@query("""
WITH b AS (SELECT n_chars < 500 AS a, n_chars BETWEEN 500 AND 4999 AS b, n_chars > 4999 AS c FROM documents)
SELECT count(*) AS n_input, count(*) FILTER (a) AS short, count(*) FILTER (b) AS middle, count(*) FILTER (c) AS long, count(*) = count(*) FILTER (a) + count(*) FILTER (b) + count(*) FILTER (c) AS conserved FROM b""")
def conservation_check(s, d):
    """Fails if the parts don't add up to the input."""
    n = F.col("n_chars")
    g = table(s, d, "documents").agg(F.count("*").alias("n_input"), F.count_if(n < 500).alias("short"), F.count_if(n.between(500, 4999)).alias("middle"), F.count_if(n > 4999).alias("long"))
    r = g.first()
    A.conserved(r.n_input, short=r.short, middle=r.middle, long=r.long)
    return s.createDataFrame([(*r, True)], "n_input long, short long, middle long, long long, conserved boolean")


@query("SELECT c_custkey, c_name FROM customer ORDER BY sha256('7|' || c_custkey), c_custkey LIMIT 25")
def bottomk_hash_sample(s, d):
    return S.bottom_k(table(s, d, "customer").select("c_custkey", "c_name"), "c_custkey", 25, seed=7)


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY sha256('3|' || c_custkey), c_custkey) AS INT) AS place FROM customer ORDER BY place LIMIT 40")
def hash_ranked_sample(s, d):
    return S.ranked(S.bottom_k(table(s, d, "customer").select("c_custkey"), "c_custkey", 40, seed=3), "c_custkey", seed=3)


@query("""
WITH n AS (SELECT c_mktsegment AS g, count(*) AS n FROM customer GROUP BY 1), q AS (SELECT g, n, 100.0 * n / sum(n) OVER () AS x FROM n),
r AS (SELECT g, n, CAST(floor(x) AS BIGINT) AS base, x - floor(x) AS rest FROM q),
a AS (SELECT g, base + CASE WHEN row_number() OVER (ORDER BY round(rest, 9) DESC, g) <= 100 - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM r),
k AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('5|' || c_custkey), c_custkey) AS rn FROM customer)
SELECT c_custkey, c_mktsegment FROM k JOIN a ON g = c_mktsegment WHERE rn <= quota""")
def stratified_quota_sample(s, d):
    return S.stratified(table(s, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "c_custkey", 100, seed=5)


@query("SELECT o_orderkey FROM orders WHERE CAST('0x' || substr(sha256('v|' || o_orderkey), 1, 12) AS BIGINT) % 100 < 10")
def modulo_hash_sample(s, d):
    return S.modulo(table(s, d, "orders").select("o_orderkey"), F.concat(F.lit("v|"), F.col("o_orderkey").cast("string")), 10)


@query("SELECT o_orderkey, o_custkey, CAST(rn AS INT) AS rn FROM (SELECT o_orderkey, o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey, o_orderkey) AS rn FROM orders) WHERE rn <= 5")
def top_n_per_group(s, d):
    return S.top_n(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_orderpriority", ["o_custkey", "o_orderkey"], 5).select("o_orderkey", "o_custkey", "rn")


@query("SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_mktsegment, length(c_name) DESC, c_custkey) AS INT) AS place FROM customer ORDER BY place LIMIT 200")
def stable_sort_head(s, d):
    """A stable multi-key order, ties by position, its first 200."""
    c = table(s, d, "customer").orderBy("c_mktsegment", F.length("c_name").desc(), "c_custkey").limit(200)
    return S.numbered(c, ["c_mktsegment", F.length("c_name").desc(), "c_custkey"]).select("c_custkey", "c_name", "place")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def limit_skip(s, d):
    return table(s, d, "orders").select("o_orderkey").orderBy("o_orderkey").offset(100).limit(50)


@query("""
WITH w AS (SELECT conv_id, turn, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS w FROM (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z]+') AS l FROM conversations)),
f AS (SELECT conv_id, turn, w, min(k) AS k FROM w GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY k) AS rn FROM f)
SELECT conv_id, turn, string_agg(w, ' ' ORDER BY k) AS evidence FROM r WHERE rn <= 6 GROUP BY 1, 2""")
def evidence_cap(s, d):
    """The first six different words of each turn."""
    return table(s, d, "conversations").select("conv_id", "turn", F.array_join(F.slice(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))), 1, 6), " ").alias("evidence")).where("evidence <> ''")
