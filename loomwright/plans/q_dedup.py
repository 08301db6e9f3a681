"""Deduplication over documents as records: name = first line, knowledge point = last line, definition = text, branch =
language and source."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup as D
from .registry import query, table

FOLD = "replace(lower(regexp_replace({}, '^\\s+|\\s+$', '', 'g')), 'ß', 'ss')"
REC = f"""r AS (SELECT doc_id AS pos, lang || '/' || source AS branch, text, lang, {FOLD.format("string_split(text, chr(10))[1]")} AS name, {FOLD.format("string_split(text, chr(10))[-1]")} AS point, length(text) AS n FROM documents)"""


def greedy_sql(rows):
    """SQL for the greedy rule, row by row: ``g(pos, kept, kept_by)`` from ``rows``, a CTE named o with pos, i (1, 2, ... in
    order of rank) and keys."""
    return rows + """, g AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS pos, CAST([] AS VARCHAR[]) AS claimed, CAST([] AS BIGINT[]) AS owners, true AS kept, CAST(NULL AS BIGINT) AS kept_by
 UNION ALL SELECT o.i, o.pos, CASE WHEN hit IS NULL THEN list_concat(claimed, o.keys) ELSE claimed END, CASE WHEN hit IS NULL THEN list_concat(owners, list_transform(o.keys, lambda v: o.pos)) ELSE owners END, hit IS NULL, CASE WHEN hit IS NULL THEN o.pos ELSE owners[list_position(claimed, hit)] END
 FROM (SELECT g.*, o.i AS j, list_filter(o.keys, lambda v: list_contains(g.claimed, v))[1] AS hit FROM g JOIN o ON o.i = g.i + 1) q JOIN o ON o.i = q.j)"""


#: Rows of a branch with their keys, in the order of the greedy rule.
KEYED_SQL = "k AS (SELECT *, list_filter([CASE WHEN name <> '' THEN lang || '|n|' || name END, CASE WHEN point <> '' THEN lang || '|p|' || point END], lambda v: v IS NOT NULL) AS keys FROM r)"


def records(s, d):
    x = table(s, d, "documents").select(F.col("doc_id").alias("pos"), F.concat_ws("/", "lang", "source").alias("branch"), "text", "lang", T.name_key(T.first_line(F.col("text"))).alias("name"), T.name_key(F.element_at(F.split("text", "\n"), -1)).alias("point"), F.length("text").alias("n"))
    return x


def keyed(s, d, path="branch"):
    return records(s, d).withColumn("keys", D.branch_keys(F.col(path), name=F.col("name"), point=F.col("point")))


@query("WITH RECURSIVE " + REC + ", " + KEYED_SQL + ", " + greedy_sql("o AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, pos) AS BIGINT) AS i, pos, keys FROM k)") + " SELECT pos AS doc_id, kept, kept_by FROM g WHERE pos IS NOT NULL")
def dedup_branch_length(s, d):
    """Greedy same-branch dedup: the longer definition first, rows dropped by a kept row's name or knowledge point."""
    x = keyed(s, d, "lang")
    g = D.greedy(x, F.struct((-F.col("n")).alias("a"), F.lit(0).alias("b")))
    return g.select(F.col("pos").alias("doc_id"), "kept", "kept_by")


@query(f"WITH {REC}, k AS (SELECT pos, row_number() OVER (PARTITION BY lang, name ORDER BY n DESC, pos) AS rn FROM r WHERE name <> '') SELECT pos AS doc_id FROM k WHERE rn = 1")
def dedup_single_key_length(s, d):
    x = records(s, d).where("name <> ''")
    return D.first_per_key(x, F.struct("lang", "name"), [F.col("n").desc(), F.col("pos")]).where("rn = 1").select(F.col("pos").alias("doc_id"))


@query(f"""
WITH RECURSIVE {REC}, k AS (SELECT pos, lang || '|n|' || name AS key FROM r WHERE name <> '' UNION ALL SELECT pos, lang || '|p|' || point FROM r WHERE point <> ''),
e AS (SELECT DISTINCT a.pos AS x, b.pos AS y FROM k a JOIN k b USING (key)), c AS (SELECT pos AS x, pos AS y FROM r UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x)
SELECT x AS doc_id, min(y) AS component FROM c GROUP BY 1""")
def candidate_components(s, d):
    return D.key_components(keyed(s, d, "lang")).select(F.col("pos").alias("doc_id"), "component")


#: Components of rows that share keys.
COMPONENT_SQL = "e AS (SELECT DISTINCT a.pos AS x, b.pos AS y FROM (SELECT pos, unnest(keys) AS key FROM k) a JOIN (SELECT pos, unnest(keys) AS key FROM k) b USING (key)), c AS (SELECT pos AS x, pos AS y FROM k UNION SELECT c.x, e.y FROM c JOIN e ON c.y = e.x), m AS (SELECT x AS pos, min(y) AS component FROM c GROUP BY 1)"


@query("WITH RECURSIVE " + REC + ", " + KEYED_SQL + ", " + COMPONENT_SQL + """, j AS (SELECT component, list(CAST(pos AS VARCHAR) ORDER BY pos) AS ids, arg_min(lang, pos) AS tags FROM k JOIN m USING (pos) GROUP BY 1 HAVING count(*) > 1)
SELECT 'g_' || substr(sha256('["subject","' || tags || '",["' || array_to_string(ids, '","') || '"]]'), 1, 32) AS group_id, tags AS main_tags, array_to_string(ids, ',') AS members FROM j""")
def candidate_groups(s, d):
    x = keyed(s, d, "lang").withColumn("id", F.col("pos").cast("string"))
    return D.candidate_groups(x, "subject", F.col("lang")).select("group_id", "main_tags", F.array_join("member_ids", ",").alias("members"))


@query("WITH RECURSIVE " + REC + ", " + KEYED_SQL + ", " + COMPONENT_SQL + """, j AS (SELECT k.*, component FROM k JOIN m USING (pos)),
w AS (SELECT component, pos AS wp, name AS wn, point AS wq, branch AS wb, lang AS wl FROM j QUALIFY row_number() OVER (PARTITION BY component ORDER BY branch LIKE '%src0' DESC, n DESC, pos) = 1),
t AS (SELECT component, list_distinct(list(tag)) AS tags FROM (SELECT component, unnest([branch, lang]) AS tag, pos FROM j) JOIN w USING (component) WHERE pos <> wp GROUP BY 1)
SELECT pos AS doc_id, wp AS winner, CASE WHEN pos <> wp THEN CASE WHEN name <> '' AND name = wn THEN 'same_leaf_name' WHEN point <> '' AND point = wq THEN 'same_leaf_english' ELSE 'same_leaf_transitive' END END AS reason,
 CASE WHEN pos = wp THEN array_to_string(list_sort(list_distinct(list_concat([wl], list_filter(coalesce(tags, []), lambda v: v <> wb)))), ',') END AS tags FROM j JOIN w USING (component) LEFT JOIN t USING (component)""")
def leaf_dedup_merge_tags(s, d):
    x = keyed(s, d, "lang").withColumn("main_tags", F.col("branch")).withColumn("related_tags", F.array("lang")).withColumn("name_k", F.col("name")).withColumn("english_k", F.col("point"))
    m = D.leaf_merge(x, F.col("branch").endswith("src0"), F.col("n"))
    return m.select(F.col("pos").alias("doc_id"), "winner", "reason", F.array_join(F.array_sort("related_tags"), ",").alias("tags"))


@query(f"""WITH {REC}, k AS (SELECT lang, point, pos, row_number() OVER (PARTITION BY lang, point ORDER BY n DESC, pos) AS rn FROM r WHERE trim(point) <> '') SELECT pos AS doc_id, rn = 1 AS kept FROM k""")
def same_node_dedup(s, d):
    """One exact key a row: the greedy rule on it."""
    x = records(s, d).where(F.trim("point") != "").withColumn("keys", F.array(F.concat_ws("\u001f", "lang", "point")))
    return D.greedy(x, -F.col("n")).select(F.col("pos").alias("doc_id"), "kept")


@query("WITH RECURSIVE " + REC + ", " + KEYED_SQL + ", " + greedy_sql("o AS (SELECT CAST(row_number() OVER (ORDER BY pos % 2, n DESC, pos) AS BIGINT) AS i, pos, keys FROM k)") + """,
w AS (SELECT pos, kept, CAST(pos % 2 AS INT) AS origin, CAST(pos // 2 AS VARCHAR) AS id FROM g WHERE pos IS NOT NULL)
SELECT origin, pos, id AS old_id, CASE WHEN kept AND origin = 1 AND id IN (SELECT id FROM w WHERE kept AND origin = 0) THEN 'sub_non_dictionary_' || id ELSE id END AS id, kept FROM w""")
def two_origin_merge(s, d):
    """All documents, even ids before odd ones; neighbours 2i and 2i + 1 have the same id, so ids clash over the whole table."""
    x = keyed(s, d, "lang").withColumn("id", F.floor(F.col("pos") / 2).cast("string")).withColumn("rank", -F.col("n")).select("pos", "id", "keys", "rank")
    first, second = x.where("pos % 2 = 0"), x.where("pos % 2 <> 0")
    return D.two_origin_merge(first, second, "sub").select("origin", "pos", "old_id", "id", "kept")


@query(f"""WITH {REC}, k AS (SELECT lang || '|n|' || name AS key FROM r WHERE name <> '' UNION ALL SELECT lang || '|p|' || point FROM r WHERE point <> '') SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM (SELECT key, count(*) AS n FROM k GROUP BY 1) WHERE n > 1""")
def residual_duplicates(s, d):
    return D.duplicate_excess(keyed(s, d, "lang"))


@query("SELECT r_name, substr(c_mktsegment, 1, 4) AS seg, count(*) AS n, min(c_custkey) AS first FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2 HAVING count(*) > 1")
def dup_groups_by_ancestor(s, d):
    x = table(s, d, "customer").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return x.groupBy("r_name", F.substring("c_mktsegment", 1, 4).alias("seg")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first")).where("n > 1")


@query(f"""
WITH {REC}, x AS (SELECT string_split(text, chr(10))[1] AS raw, name, branch FROM r JOIN documents ON doc_id = pos)
SELECT name, count(*) AS n, count(DISTINCT branch) AS branches, count(DISTINCT raw) AS forms, count(DISTINCT raw) > 1 AS normalized_only FROM (SELECT name, branch, string_split(text, chr(10))[1] AS raw FROM r) WHERE name <> '' GROUP BY 1 HAVING count(*) > 1""")
def raw_vs_normalized_duplicates(s, d):
    x = records(s, d).where("name <> ''").withColumn("raw", T.first_line(F.col("text")))
    g = x.groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("branch").alias("branches"), F.count_distinct("raw").alias("forms")).where("n > 1")
    return g.withColumn("normalized_only", F.col("forms") > 1)


@query(f"""
WITH {REC}, a AS (SELECT DISTINCT lang, name, point FROM r WHERE pos % 2 = 0), b AS (SELECT DISTINCT lang, name, point FROM r WHERE pos % 2 = 1)
SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS both""")
def branch_fingerprint_overlap(s, d):
    x = records(s, d).select("lang", "name", "point", (F.col("pos") % 2 == 0).alias("even"))
    g = x.groupBy("lang", "name", "point").agg(F.max(F.col("even").cast("int")).alias("a"), F.max((~F.col("even")).cast("int")).alias("b"))
    return g.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum(F.col("a") * F.col("b")).alias("both"))


@query("SELECT doc_id, CASE lang WHEN 'de' THEN 'germanic' WHEN 'en' THEN 'germanic' WHEN 'fr' THEN 'romance' ELSE lang END AS path FROM documents")
def path_alias_canonical(s, d):
    return table(s, d, "documents").select("doc_id", D.canonical_path(F.col("lang"), {"de": "en", "en": "germanic", "fr": "romance"}).alias("path"))


@query(f"""
WITH {REC}, g AS (SELECT name AS group_id, pos, min(pos) OVER (PARTITION BY name) AS keeper FROM r WHERE name <> ''), n AS (SELECT *, count(*) OVER (PARTITION BY group_id) AS c FROM g)
SELECT group_id, pos AS member, CASE WHEN pos % 5 = 0 AND pos <> keeper THEN NULL ELSE keeper END AS keeper, CASE WHEN pos % 5 = 0 AND pos <> keeper THEN 'not_covered' END AS problem FROM n WHERE c > 1""")
def partition_application(s, d):
    from pyspark.sql import Window as W

    x = records(s, d).where("name <> ''").withColumn("c", F.count("*").over(W.partitionBy("name"))).withColumn("keeper", F.min("pos").over(W.partitionBy("name"))).where("c > 1")
    groups = x.select(F.col("name").alias("group_id"), F.col("pos").alias("member"), F.array("name").alias("keys"))
    clusters = x.where("pos % 5 <> 0 or pos = keeper").select(F.col("name").alias("group_id"), "keeper", F.col("pos").alias("member"))
    return D.apply_partition(groups, clusters).select("group_id", "member", "keeper", "problem")


@query("WITH RECURSIVE " + REC + ", k AS (SELECT *, list_filter(['i' || n, CASE WHEN regexp_replace(name, '[^\\p{L}\\p{N}_]+', '', 'g') <> '' THEN 't' || regexp_replace(name, '[^\\p{L}\\p{N}_]+', '', 'g') END], lambda v: v IS NOT NULL) AS keys FROM r), " + greedy_sql("o AS (SELECT CAST(row_number() OVER (ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, pos) AS BIGINT) AS i, pos, keys FROM k)") + " SELECT pos AS doc_id, NOT kept AS duplicate, CASE WHEN NOT kept THEN kept_by END AS duplicate_of FROM g WHERE pos IS NOT NULL")
def reference_duplicates(s, d):
    """Identifier or title already claimed by a kept row, strict rows before review rows."""
    x = records(s, d).withColumn("keys", F.array_compact(F.array(F.concat(F.lit("i"), F.col("n").cast("string")), F.when(T.title_key(F.col("name")) != "", F.concat(F.lit("t"), T.title_key(F.col("name")))))))
    g = D.greedy(x, F.when(F.col("lang") == "en", 0).otherwise(1))
    return g.select(F.col("pos").alias("doc_id"), (~F.col("kept")).alias("duplicate"), F.when(~F.col("kept"), F.col("kept_by")).alias("duplicate_of"))


@query("WITH RECURSIVE " + REC + ", " + KEYED_SQL + ", " + greedy_sql("o AS (SELECT CAST(row_number() OVER (ORDER BY pos) AS BIGINT) AS i, pos, keys FROM k)") + """,
h AS (SELECT pos AS head, unnest(keys) AS key FROM k WHERE pos IN (SELECT pos FROM g WHERE kept)), m AS (SELECT pos, min(head) AS bucket FROM (SELECT pos, unnest(keys) AS key FROM k) JOIN h USING (key) GROUP BY 1)
SELECT pos AS doc_id, coalesce(bucket, pos) AS bucket FROM k LEFT JOIN m USING (pos)""")
def name_alias_buckets(s, d):
    return D.claim_buckets(keyed(s, d, "lang")).select(F.col("pos").alias("doc_id"), "bucket")


@query(f"""WITH {REC} SELECT lang, name AS term, count(*) AS occurrences, min(pos) AS first FROM r WHERE name <> '' GROUP BY 1, 2""")
def term_occurrences(s, d):
    """Identical terms of a branch: the first stands, the others are its occurrences."""
    return records(s, d).where("name <> ''").groupBy("lang", F.col("name").alias("term")).agg(F.count("*").alias("occurrences"), F.min("pos").alias("first"))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN doc_id % 3 = 0 THEN 'id' || n_chars ELSE 'row' || doc_id END ORDER BY CASE lang WHEN 'de' THEN 0 ELSE 1 END, doc_id) AS rn FROM documents) WHERE rn = 1")
def distinct_keep_first(s, d):
    """One row per identifier over two tracks, one track first; rows without an identifier are their own."""
    x = table(s, d, "documents").withColumn("key", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("id"), "n_chars")).otherwise(F.concat(F.lit("row"), "doc_id")))
    return D.first_per_key(x, F.col("key"), [F.when(F.col("lang") == "de", 0).otherwise(1), F.col("doc_id")]).where("rn = 1").select("doc_id", "lang", "source")
