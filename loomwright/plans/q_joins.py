"""Joins and set operations over the driver's tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J
from .registry import query, seconds, table


@query("""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'duplicate' END AS problem
FROM (SELECT doc_id, count(*) n FROM documents GROUP BY 1) a FULL JOIN (SELECT doc_id, count(*) n FROM labels GROUP BY 1) b USING (doc_id)
WHERE a.n IS NULL OR b.n IS NULL OR a.n > 1 OR b.n > 1""")
def coverage_join(s: SparkSession, d: str) -> DataFrame:
    return J.coverage(table(s, d, "documents"), table(s, d, "labels"), "doc_id")


@query("SELECT o_orderkey, o_custkey, CAST(n AS BIGINT) AS n_lines FROM orders JOIN (SELECT l_orderkey, count(*) n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def covered_one_to_one(s, d):
    """Rows joined with decisions that must cover each of them once (here: orders that have lines)."""
    lines = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))
    o = table(s, d, "orders").select("o_orderkey", "o_custkey").join(lines.select("o_orderkey"), "o_orderkey", "left_semi")
    return J.covered_join(o, lines, "o_orderkey")


@query("SELECT d.doc_id, coalesce(quality, -1) AS quality, CASE WHEN l.doc_id IS NULL THEN 'REVIEW' WHEN quality = 1 AND toxic = 0 THEN 'KEEP' ELSE 'DROP' END AS decision FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_default(s, d):
    lab = table(s, d, "labels").select("doc_id", "quality", F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "KEEP").otherwise("DROP").alias("decision"))
    return J.with_default(table(s, d, "documents").select("doc_id"), lab, "doc_id", quality=-1, decision="REVIEW")


@query("SELECT l.doc_id, d.lang, d.source, l.quality FROM labels l JOIN documents d USING (doc_id)")
def trace_restore(s, d):
    """Judged rows get back what their trace holds; a judged row without a trace would fail."""
    j = table(s, d, "labels").select("doc_id", "quality").join(table(s, d, "documents").select("doc_id", "lang", "source"), "doc_id", "left")
    return j.withColumn("lang", F.when(F.assert_true(F.col("source").isNotNull(), "missing trace").isNull(), F.col("lang")))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_pending(s, d):
    return J.pending(table(s, d, "documents").select("doc_id", "n_chars"), table(s, d, "labels"), ["doc_id"])


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def semi_review(s, d):
    return table(s, d, "documents").select("doc_id", "lang").join(table(s, d, "labels").where("quality = 0"), "doc_id", "left_semi")


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def dimension_join(s, d):
    """A fact with two small dimensions; their sizes are in the files, so the optimiser broadcasts them by itself."""
    c, n, r = table(s, d, "customer"), table(s, d, "nation"), table(s, d, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "n_name", "r_name")


TERMS = ["the", "and", "password", "token", "license", "der", "la", "est", "in the", "mit license", "gnu"]


@query("""
WITH t AS (SELECT unnest(['the','and','password','token','license','der','la','est','in the','mit license','gnu']) AS term)
SELECT doc_id, term FROM documents, t WHERE regexp_matches(lower(text), '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)')""")
def theta_contains_terms(s, d):
    m = J.matched_terms(table(s, d, "documents").select("doc_id", "text"), "text", TERMS)
    # the outer form, as the other has Catalyst compute the terms twice, once in a filter before it
    return m.select("doc_id", F.explode_outer("terms").alias("term")).where("term is not null")


@query("""
WITH b AS (SELECT item_id, array_to_string(regexp_extract_all(lower(text), '[a-z0-9]+')[1:2], ' ') AS name FROM benchmark),
n AS (SELECT DISTINCT name FROM b WHERE name <> ''),
w AS (SELECT item_id AS id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
p AS (SELECT id, k - 1 AS place, array_to_string(w[k:k], ' ') k1, CASE WHEN k + 1 <= len(w) THEN array_to_string(w[k:k+1], ' ') END k2, CASE WHEN k + 2 <= len(w) THEN array_to_string(w[k:k+2], ' ') END k3 FROM (SELECT id, w, unnest(range(1, len(w) + 1)) AS k FROM w)),
h AS (SELECT name, id, place, row_number() OVER (PARTITION BY name ORDER BY id, place) AS hit FROM n JOIN p ON name = k1 OR name = k2 OR name = k3)
SELECT name, id AS item_id, CAST(place AS INT) AS place, CAST(hit AS INT) AS hit FROM h WHERE hit <= 8""")
def multi_pattern_mentions(s, d):
    """Names (the first two words of benchmark items) found in the items' texts, the first eight hits of each."""
    b = table(s, d, "benchmark")
    names = b.select(F.array_join(F.slice(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0)), 1, 2), " ").alias("name"))
    return J.mentions(b, names, "item_id", "text", "name", word="[a-z0-9]+")


@query("""
WITH i AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) % 5000 + 1 AS e FROM events),
w AS (SELECT event_id, user_id, s, max(e) OVER (PARTITION BY user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM i)
SELECT event_id, user_id, coalesce(s < m, false) AS overlaps FROM w""")
def interval_sweep(s, d):
    e = table(s, d, "events").select("event_id", "user_id", seconds(F.col("ts")).alias("s"), F.col("value"))
    e = e.withColumn("e", F.col("s") + F.floor(F.abs("value")) % 5000 + 1)
    return J.overlapping(e, "user_id", "s", "e", "event_id").select("event_id", "user_id", "overlaps")


@query("""
WITH i AS (SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) % 5000 + 1 AS e FROM events)
SELECT a.event_id AS a, b.event_id AS b FROM i a JOIN i b ON a.user_id = b.user_id AND a.s < b.e AND b.s < a.e WHERE a.event_type < b.event_type""")
def interval_overlap(s, d):
    e = table(s, d, "events").select("event_id", "user_id", "event_type", seconds(F.col("ts")).alias("s"), F.col("value"))
    e = e.withColumn("e", F.col("s") + F.floor(F.abs("value")) % 5000 + 1)
    left = e.select("user_id", "s", "e", F.col("event_id").alias("a"), F.col("event_type").alias("ta"))
    right = e.select("user_id", F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("event_id").alias("b"), F.col("event_type").alias("tb"))
    return J.range_join(left, right, "user_id", 5000).where("ta < tb").select("a", "b")


@query("""
WITH h AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')
SELECT c.conv_id, c.turn, (SELECT sha256(h.text) FROM h WHERE h.conv_id = c.conv_id AND h.turn <= c.turn ORDER BY h.turn DESC LIMIT 1) AS heading FROM conversations c""")
def asof_last_heading(s, d):
    """The last user turn at or before each turn."""
    c = table(s, d, "conversations")
    events = c.where("role = 'user'").select("conv_id", "turn", F.sha2("text", 256).alias("heading"))
    return J.as_of(c, events, "conv_id", "turn", "heading")


PREFIXES = [("http://", "plain"), ("https://", "secure"), ("https://www.", "www"), ("https://blog.", "blog"), ("http://m.", "mobile")]


@query("""
WITH p AS (SELECT * FROM (VALUES ('http://','plain'), ('https://','secure'), ('https://www.','www'), ('https://blog.','blog'), ('http://m.','mobile')) t(prefix, root))
SELECT page_id, (SELECT root FROM p WHERE starts_with(url, prefix) ORDER BY length(prefix) DESC LIMIT 1) AS root FROM pages""")
def longest_prefix_map(s, d):
    return J.longest_prefix(table(s, d, "pages").select("page_id", "url"), "url", s.createDataFrame(PREFIXES, "prefix string, root string"), "prefix", "root").select("page_id", "root")


@query("""
WITH u AS (SELECT doc_id, 'base' || quality AS v, 0 AS step FROM labels UNION ALL SELECT doc_id, 'retry', 1 FROM labels WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, 'final', 2 FROM labels WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id + 1000000000, 'stray', 2 FROM labels)
SELECT doc_id, arg_max(v, step) AS review, array_to_string(list_sort(list(DISTINCT step)), ',') AS trace FROM u GROUP BY doc_id HAVING min(step) = 0""")
def overlay_merge(s, d):
    lab = table(s, d, "labels").select("doc_id", F.concat(F.lit("base"), F.col("quality").cast("string")).alias("review"))
    one = lab.where("doc_id % 3 = 0").withColumn("review", F.lit("retry"))
    two = lab.where("doc_id % 5 = 0").withColumn("review", F.lit("final")).unionByName(lab.select((F.col("doc_id") + 1000000000).alias("doc_id"), F.lit("stray").alias("review")))
    return J.overlay(lab, [one, two], "doc_id", "review").select("doc_id", "review", F.array_join("trace", ",").alias("trace"))


@query("SELECT CAST(quality AS VARCHAR) AS before, CASE WHEN toxic = 1 THEN 'drop' WHEN doc_id % 4 = 0 THEN 'review' ELSE 'keep' END AS after, count(*) AS count FROM labels GROUP BY 1, 2")
def run_transitions(s, d):
    lab = table(s, d, "labels")
    before = lab.select("doc_id", F.col("quality").cast("string").alias("v"))
    return J.transitions(before, lab.select("doc_id", F.when(F.col("toxic") == 1, "drop").when(F.col("doc_id") % 4 == 0, "review").otherwise("keep").alias("v")), "doc_id", "v")


@query("SELECT 'customer' AS track, c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier")
def union_tracks(s, d):
    c = table(s, d, "customer").select(F.lit("customer").alias("track"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(table(s, d, "supplier").select(F.lit("supplier").alias("track"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("""
SELECT 'both' AS side, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL
SELECT 'only_documents', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL
SELECT 'only_labels', count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def id_set_checks(s, d):
    a, b = table(s, d, "documents").select("doc_id"), table(s, d, "labels").select("doc_id")
    j = a.distinct().withColumn("x", F.lit(1)).join(b.distinct().withColumn("y", F.lit(1)), "doc_id", "full_outer")  # one shuffle for all three
    side = F.when(F.col("y").isNull(), "only_documents").when(F.col("x").isNull(), "only_labels").otherwise("both")
    n = j.groupBy(side.alias("side")).agg(F.count("*").alias("n"))
    every = s.createDataFrame([("both",), ("only_documents",), ("only_labels",)], "side string")
    return every.join(n, "side", "left").select("side", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""
WITH k AS (SELECT doc_id FROM labels WHERE quality = 1), r AS (SELECT doc_id FROM labels WHERE quality <> 1)
SELECT (SELECT count(*) FROM labels) AS n_input, (SELECT count(*) FROM k) AS n_kept, (SELECT count(*) FROM r) AS n_removed,
 (SELECT count(*) FROM (SELECT * FROM k INTERSECT SELECT * FROM r)) = 0 AND (SELECT count(*) FROM k) + (SELECT count(*) FROM r) = (SELECT count(*) FROM labels) AS is_partition""")
def set_partition_check(s, d):
    x = table(s, d, "labels").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("k"), F.max((F.col("quality") != 1).cast("int")).alias("r"), F.count("*").alias("n"))
    return x.agg(F.sum("n").alias("n_input"), F.sum("k").alias("n_kept"), F.sum("r").alias("n_removed"), (F.max(F.col("k") + F.col("r")) == 1).alias("is_partition"))


@query(r"""
WITH a AS (SELECT doc_id, k AS line, l AS t FROM (SELECT doc_id, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)) WHERE trim(l) <> ''),
b AS (SELECT doc_id, k AS line, l AS t FROM (SELECT doc_id, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS l FROM (SELECT doc_id, string_split(source || chr(10) || replace(replace(text, '. ', '.' || chr(10)), 'e', 'E'), chr(10)) AS x FROM documents)) WHERE trim(l) <> ''),
u AS (SELECT doc_id, lower(trim(t)) AS t, min(line) AS line FROM a GROUP BY 1, 2 HAVING count(*) = 1), v AS (SELECT doc_id, lower(trim(t)) AS t, min(line) AS line FROM b GROUP BY 1, 2 HAVING count(*) = 1)
SELECT doc_id, CAST(u.line AS INT) AS line, CAST(v.line AS INT) AS other_line FROM u JOIN v USING (doc_id, t)""")
def unique_line_alignment(s, d):
    """Lines of two renderings of a document aligned where they are unique in both: the text, and below a title the text
    in other case, with a line for each sentence."""
    docs = table(s, d, "documents")
    rows = lambda x, c: x.select("doc_id", F.posexplode(F.split(c, "\n")).alias("k", "t")).select("doc_id", (F.col("k") + 1).alias("line_no"), "t").where("trim(t) <> ''")
    other = F.concat("source", F.lit("\n"), F.replace(F.replace("text", F.lit(". "), F.lit(".\n")), F.lit("e"), F.lit("E")))
    return J.unique_line_match(rows(docs, F.col("text")), rows(docs, other), F.lower(F.trim("t")))
