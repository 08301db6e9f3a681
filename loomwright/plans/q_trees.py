"""Trees and recall over the driver's tables: region > nation > customers and suppliers."""

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import trees as H
from .registry import query, table

TREE_SQL = """t AS (SELECT 'world' AS code, CAST(NULL AS VARCHAR) AS parent, 0 AS depth UNION ALL SELECT 'r' || r_regionkey, 'world', 1 FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 2 FROM nation)"""


def tree(s, d):
    r = table(s, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("code"), F.col("r_name").alias("name"), F.lit("world").alias("parent"), F.lit(1).alias("depth"), F.col("r_name").alias("path"))
    n = table(s, d, "nation").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    n = n.select(F.concat(F.lit("n"), "n_nationkey").alias("code"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.lit(2).alias("depth"), F.concat_ws("/", "r_name", "n_name").alias("path"))
    return s.createDataFrame([("world", "world", None, 0, "")], "code string, name string, parent string, depth int, path string").unionByName(r).unionByName(n)


@query(f"""WITH RECURSIVE {TREE_SQL}, c AS (SELECT code AS ancestor, code AS node, 0 AS distance FROM t UNION ALL SELECT t.parent, c.node, c.distance + 1 FROM c JOIN t ON t.code = c.ancestor WHERE t.parent IS NOT NULL) SELECT * FROM c""")
def taxonomy_closure(s, d):
    return H.closure(tree(s, d))


@query(f"WITH {TREE_SQL} SELECT code FROM t WHERE code NOT IN (SELECT parent FROM t WHERE parent IS NOT NULL)")
def taxonomy_leaves(s, d):
    return H.leaves(tree(s, d)).select("code")


@query("SELECT 'n' || n_nationkey AS node, 'r' || n_regionkey AS ancestor FROM nation UNION ALL SELECT 'r' || r_regionkey, 'r' || r_regionkey FROM region")
def ancestor_at_depth(s, d):
    t = tree(s, d)
    return H.ancestor_at(H.closure(t), t, 1)


@query("""
WITH m AS (SELECT c_custkey AS id, 'n' || c_nationkey AS node FROM customer), u AS (SELECT node AS ancestor, id FROM m UNION ALL SELECT 'r' || n_regionkey, id FROM m JOIN nation ON node = 'n' || n_nationkey UNION ALL SELECT 'world', id FROM m),
a AS (SELECT 'world' AS ancestor UNION ALL SELECT 'r' || r_regionkey FROM region UNION ALL SELECT 'n' || n_nationkey FROM nation)
SELECT ancestor, count(DISTINCT id) AS n_records, count(DISTINCT id) >= 60 AS covered FROM a LEFT JOIN u USING (ancestor) GROUP BY 1""")
def ancestor_rollup_coverage(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("at"))
    return A.ancestor_coverage(c, H.closure(tree(s, d)), "id", "at", 60)


@query(f"""WITH {TREE_SQL}, g AS (SELECT parent, code, (row_number() OVER (PARTITION BY parent ORDER BY code) - 1) // 3 AS group_no FROM t WHERE parent IS NOT NULL)
SELECT parent, CAST(group_no AS INT) AS group_no, string_agg(code, ',' ORDER BY code) AS codes FROM g GROUP BY 1, 2""")
def sibling_card_groups(s, d):
    return H.sibling_groups(tree(s, d)).select("parent", "group_no", F.array_join("codes", ",").alias("codes"))


@query("""
WITH x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'nowhere' ELSE r_name || '/' || n_name END AS p FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT s_suppkey, p, CASE WHEN p <> 'nowhere' THEN 2 END AS depth, p <> 'nowhere' AS path_exists FROM x""")
def path_context_join(s, d):
    x = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    x = x.select("s_suppkey", F.when(F.col("s_suppkey") % 10 == 0, "nowhere").otherwise(F.concat_ws("/", "r_name", "n_name")).alias("p"))
    return H.path_context(x, tree(s, d), "p").select("s_suppkey", "p", "depth", "path_exists")


CONFIG = {"direct": ["src3", "de"], "adjacent": ["src5", "fr"], "strong": ["the the"], "weak": ["than", "with", "der", "la"], "exclude": ["password"], "groups": [["and", "token"]]}


@query("""
WITH x AS (SELECT doc_id, lower(lang || chr(10) || source) AS s, lower(string_split(text, chr(10))[1]) AS t, lower(text) AS o FROM documents),
h AS (SELECT doc_id, """ + ", ".join(f"regexp_matches({c}, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS {c}_{n}" for c in "sto" for n, term in {"src3": "src3", "de": "de", "src5": "src5", "fr": "fr", "tt": "the the", "than": "than", "with": "with", "der": "der", "la": "la", "pw": "password", "and_": "and", "tok": "token"}.items()) + """ FROM x),
f AS (SELECT *, (s_pw OR t_pw OR o_pw) AS ex, (s_than OR t_than OR o_than)::INT + (s_with OR t_with OR o_with)::INT + (s_der OR t_der OR o_der)::INT + (s_la OR t_la OR o_la)::INT AS weak FROM h)
SELECT doc_id, CASE WHEN s_src3 OR s_de THEN 'direct_subject' WHEN t_tt THEN 'title_strong_term' WHEN (t_than OR t_with OR t_der OR t_la) AND NOT ex THEN 'title_domain_term'
 WHEN (s_tt OR o_tt) AND NOT ex THEN 'metadata_strong_term' WHEN (s_and_ OR t_and_ OR o_and_) AND (s_tok OR t_tok OR o_tok) AND NOT ex THEN 'cooccurrence_group'
 WHEN (s_src5 OR s_fr) AND weak > 0 AND NOT ex THEN 'adjacent_plus_domain' WHEN weak >= 2 AND NOT ex THEN 'multiple_weak_terms' END AS channel FROM f""")
def recall_channels(s, d):
    x = table(s, d, "documents").select("doc_id", "lang", "source", F.split("text", "\n")[0].alias("title"), "text")
    return H.recall(x, ["lang", "source"], "title", ["text"], CONFIG).select("doc_id", F.col("recall.channel").alias("channel"))


@query()
def beam_route(s, d):
    """Customers routed down region > nation by a deterministic scorer."""
    rec = table(s, d, "customer").select(F.col("c_custkey").alias("record"))

    def score(x):
        h = F.pmod(F.xxhash64("record", "child"), F.lit(1000)) / 1000.0
        return x.withColumn("p", F.greatest(h, F.lit(0.001))).withColumn("stop", (F.size("path") == 1) & (F.col("record") % 7 == 0))

    return H.beam_route(rec, tree(s, d), score, width=2, threshold=0.3).select("record", F.array_join("path", "/").alias("path"), "path_score", "decision")


@query("""
WITH c AS (SELECT s_suppkey, ['r' || n_regionkey, 'n' || s_nationkey] AS best FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t AS (SELECT s_suppkey, best, unnest(range(0, 6)) AS i FROM c),
u AS (SELECT s_suppkey, best, i, [best, ['r' || s_suppkey % 5], ['r' || s_suppkey % 5, 'n' || i], ['r9', 'n' || s_suppkey], ['r9', 'n' || s_suppkey], list_concat(best, ['x'])][i + 1] AS codes, ((s_suppkey * 7 + i * 31) % 120) / 100.0 AS score, CASE WHEN (s_suppkey + i) % 5 = 0 THEN NULL ELSE (s_suppkey + i) % 4 = 0 END AS cut FROM t),
k AS (SELECT s_suppkey, i, array_to_string(codes, '/') AS p FROM u WHERE score >= 0.5 AND score <= 1.0 AND NOT coalesce(cut, false) AND codes[1:len(best)] <> best AND best[1:len(codes)] <> codes),
f AS (SELECT s_suppkey, p, row_number() OVER (PARTITION BY s_suppkey ORDER BY min(i)) AS n FROM k GROUP BY 1, 2)
SELECT c.s_suppkey, array_to_string(best, '/') AS "primary", coalesce((SELECT string_agg(p, ',' ORDER BY n) FROM f WHERE f.s_suppkey = c.s_suppkey AND n <= 2), '') AS related FROM c""")
def route_acceptance(s, d):
    """Related paths: good enough, not truncated, new, neither above nor below the primary, two at most."""
    x = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    best = F.array(F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "s_nationkey"))
    five, own = F.concat(F.lit("r"), (k % 5).cast("string")), F.concat(F.lit("n"), k.cast("string"))
    codes = [best, F.array(five), F.array(five, F.lit("n2")), F.array(F.lit("r9"), own), F.array(F.lit("r9"), own), F.concat(best, F.array(F.lit("x")))]
    tops = F.array(*[F.struct(c.alias("codes"), (((k * 7 + i * 31) % 120) / 100.0).alias("score"), F.when((k + i) % 5 != 0, (k + i) % 4 == 0).alias("truncated")) for i, c in enumerate(codes)])
    return H.accepted_candidates(x.select("s_suppkey", best.alias("best"), tops.alias("tops")), "tops", "best", 0.5, 2).select("s_suppkey", "primary", F.array_join("related", ",").alias("related"))


@query("""
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN 'accepted_parent' WHEN l_linenumber % 3 = 1 THEN 'accepted_leaf' ELSE 'needs_review' END AS dec, CAST(l_linenumber % 5 AS INT) + 1 AS depth, 0.6 + floor(l_quantity) / 125.0 AS ps,
 0.5 + floor(l_quantity) / 100.0 AS c1, 0.95 - floor(l_quantity) / 200.0 AS c2, 0.7 AS c4, floor(l_discount * 100 + 0.5) / 100.0 AS gap, CASE WHEN l_returnflag = 'A' THEN 'recall_with_risk' WHEN l_returnflag = 'R' THEN 'needs_review' ELSE 'keep' END AS clean, l_linestatus = 'F' AS warn FROM lineitem),
y AS (SELECT *, pow(ps, 1.0 / depth) AS nn, 0.6 * least(c1, c2) + 0.4 * (c1 + c2) / 2 AS dir FROM x),
z AS (SELECT *, least(0.6, CASE WHEN warn THEN 0.04 ELSE 0 END + CASE clean WHEN 'recall_with_risk' THEN 0.06 WHEN 'needs_review' THEN 0.14 ELSE 0 END + CASE WHEN ps < 0.72 THEN 0.08 ELSE 0 END + CASE WHEN nn < 0.88 THEN 0.06 ELSE 0 END
 + CASE WHEN dec = 'accepted_parent' AND depth <= 2 THEN 0.08 ELSE 0 END + CASE WHEN gap < 0.025 THEN 0.10 WHEN gap < 0.075 THEN 0.05 ELSE 0 END) AS pen FROM y),
o AS (SELECT *, greatest(0, least(1, CASE WHEN dec = 'accepted_parent' THEN 0.75 * dir + 0.15 * nn + 0.10 * 0.7 - pen ELSE 0.55 * dir + 0.35 * 0.7 + 0.10 * nn - pen END)) AS overall FROM z)
SELECT l_orderkey, l_linenumber, CASE WHEN dec = 'needs_review' THEN 'not_accepted' WHEN overall >= 0.82 AND dir >= CASE WHEN dec = 'accepted_parent' THEN 0.86 ELSE 0.85 END AND NOT warn AND NOT (clean = 'needs_review' OR (clean = 'recall_with_risk' AND dec = 'accepted_parent')) THEN 'high_confidence'
 WHEN overall >= 0.70 AND dir >= 0.78 THEN 'medium_confidence' ELSE 'low_confidence' END AS tier, CASE WHEN dec = 'needs_review' THEN 0 ELSE round(overall::DOUBLE, 6) END AS overall FROM o""")
def calibrate_confidence(s, d):
    q = F.floor("l_quantity")
    x = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 0, "accepted_parent").when(F.col("l_linenumber") % 3 == 1, "accepted_leaf").otherwise("needs_review").alias("dec"), (F.col("l_linenumber") % 5 + 1).alias("depth"), (0.6 + q / 125.0).alias("ps"),
        F.array(*[F.struct(F.lit(k).alias("level"), c.alias("conf")) for k, c in ((1, 0.5 + q / 100.0), (2, 0.95 - q / 200.0), (4, F.lit(0.7)))]).alias("levels"), F.array(F.lit(0.9) + F.floor(F.col("l_discount") * 100 + 0.5) / 100 + 0.005, F.lit(0.9)).alias("tops"),
        F.when(F.col("l_returnflag") == "A", "recall_with_risk").when(F.col("l_returnflag") == "R", "needs_review").otherwise("keep").alias("clean"), F.when(F.col("l_linestatus") == "F", F.array(F.lit("ambiguous"))).otherwise(F.array(F.lit("root_type_forced"))).alias("warnings"))
    c = H.calibrated(x, decision="dec", depth="depth", path_score="ps", levels="levels", tops="tops", clean="clean", warnings="warnings")
    return c.select("l_orderkey", "l_linenumber", "cal.tier", F.col("cal.overall").alias("overall"))
