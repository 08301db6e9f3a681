"""Lists, indexes, regions, layout, constraints and queues over the driver's tables."""

from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import rules as R
from ..operators import score as C
from ..operators import segment as G
from ..operators import trees as B
from ..operators import windows as X
from .registry import query, table

ITEMS = "1. Step one if wet, then dry\n   go on unless told\n\n- All except the last\nnext\n\n"
INDEX = "Alpha, 3, 5-7\n  beta, 9\nGamma, see Alpha\n"
PAIRS = "Apple pie 苹果派\nBanana\n香蕉\n\nCherry 樱桃\n"
IMPRINT = "Copyright 1999\nISBN 1\nPublished by X\n"


def lined(head: str) -> str:
    """SQL of a table l: the lines of all documents below some of a known kind."""
    return f"""
WITH t AS (SELECT doc_id, string_split('{head.replace(chr(10), "' || chr(10) || '")}' || coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS line_no FROM t)"""


def lines(s, d, head):
    return X.lines(table(s, d, "documents").select("doc_id", F.concat(F.lit(head), F.coalesce("text", F.lit(""))).alias("text")))


@query(lined(ITEMS) + r""",
f AS (SELECT *, regexp_matches(line, '^ *([0-9]+[.)]|[-*]) +[^ ]')::int AS st, (trim(line) = '')::int AS sp FROM l),
w AS (SELECT *, sum(st) OVER p AS item, sum(sp) OVER p AS gap FROM f WINDOW p AS (PARTITION BY doc_id ORDER BY line_no)),
g AS (SELECT *, max(CASE WHEN st = 1 THEN gap END) OVER (PARTITION BY doc_id ORDER BY line_no) AS g0 FROM w),
i AS (SELECT doc_id, min(line_no) AS first_line, max(line_no) AS last_line, string_agg(trim(line), ' ' ORDER BY line_no) AS text FROM g WHERE item > 0 AND gap = g0 GROUP BY doc_id, item)
SELECT doc_id, first_line, last_line, length(text) AS chars, len(regexp_extract_all(lower(text), '\b(?:if|when|unless|provided that)\b[^,.;]*')) AS conditions, len(regexp_extract_all(lower(text), '\b(?:except|unless|other than)\b[^,.;]*')) AS exceptions FROM i""")
def list_rules(s, d):
    x = G.items_with_body(lines(s, d, ITEMS)).withColumn("c", G.constraints(F.col("text")))
    return x.select("doc_id", F.col("first").alias("first_line"), F.col("last").alias("last_line"), F.length("text").alias("chars"), F.size("c.conditions").alias("conditions"), F.size("c.exceptions").alias("exceptions"))


@query(lined(INDEX) + r""",
d AS (SELECT * FROM l WHERE regexp_matches(line, ',\s*[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\s*$') OR regexp_matches(lower(line), '\bsee(?: also)?\b')),
e AS (SELECT *, trim(regexp_replace(regexp_replace(line, '[.,]?\s*see(?: also)? .*$', '', 'i'), '(?:,\s*[0-9]+(?:[-–][0-9]+)?)+\s*$', '')) AS term, regexp_matches(line, '^\s+\S') AS indented FROM d)
SELECT doc_id, line_no, term, CASE WHEN indented THEN last_value(CASE WHEN NOT indented THEN term END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent,
  array_to_string(regexp_extract_all(regexp_replace(line, '^[^,]*', ''), '[0-9]+(?:[-–][0-9]+)?'), ',') AS pages FROM e""")
def back_of_book_index(s, d):
    return G.index_entries(lines(s, d, INDEX)).select("doc_id", "line_no", "term", "parent", F.array_join("pages", ",").alias("pages"))


@query(lined(PAIRS) + r""",
d AS (SELECT doc_id, line_no, trim(line) AS t, lead(trim(line)) OVER (PARTITION BY doc_id ORDER BY line_no) AS nx FROM l WHERE trim(line) <> ''),
p AS (SELECT *, regexp_extract(t, '^([A-Za-z][A-Za-z ,.''()/-]{1,80})\s+([一-鿿][一-鿿，、（）()·]{0,40})$', 1) AS e1, regexp_extract(t, '^([A-Za-z][A-Za-z ,.''()/-]{1,80})\s+([一-鿿][一-鿿，、（）()·]{0,40})$', 2) AS z1 FROM d),
q AS (SELECT doc_id, line_no, CASE WHEN e1 <> '' THEN trim(e1) ELSE t END AS en, CASE WHEN e1 <> '' THEN z1 ELSE nx END AS zh FROM p WHERE e1 <> '' OR (regexp_full_match(t, '[A-Za-z][A-Za-z ,.''()/-]{1,80}') AND regexp_full_match(nx, '[一-鿿][一-鿿，、（）()·]{0,40}')))
SELECT doc_id, line_no, en, zh, count(*) OVER (PARTITION BY doc_id ORDER BY line_no RANGE BETWEEN 60 PRECEDING AND 1 PRECEDING) AS n_before, count(*) OVER (PARTITION BY doc_id ORDER BY line_no RANGE BETWEEN 1 FOLLOWING AND 60 FOLLOWING) AS n_after FROM q""")
def bilingual_line_pairs(s, d):
    from ..operators import books

    return books.bilingual_pairs(lines(s, d, PAIRS)).withColumnRenamed("before", "n_before").withColumnRenamed("after", "n_after")


@query(lined(IMPRINT) + r""",
f AS (SELECT * FROM l WHERE trim(line) <> ''),
w AS (SELECT doc_id, line_no, lower(concat_ws(chr(10), lag(line) OVER p, line, lead(line) OVER p)) AS near, row_number() OVER p AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM f WINDOW p AS (PARTITION BY doc_id ORDER BY line_no)),
g AS (SELECT *, regexp_matches(near, 'isbn')::int + regexp_matches(near, 'copyright|©')::int + regexp_matches(near, 'all rights reserved')::int + regexp_matches(near, 'published by|publisher')::int + regexp_matches(near, '\b(?:19|20)[0-9]{2}\b')::int + regexp_matches(near, 'references|bibliography')::int + regexp_matches(near, 'doi\.org|https?://')::int AS signals FROM w)
SELECT doc_id, line_no AS unit_no, signals FROM g WHERE (k <= ceil(n / 20) OR k > n - ceil(n / 20)) AND signals >= 2""")
def region_nomination(s, d):
    u = lines(s, d, IMPRINT).select("doc_id", F.col("line_no").alias("unit_no"), F.col("line").alias("text"))
    return G.bibliographic_regions(u).select("doc_id", "unit_no", "signals")


@query("""
SELECT conv_id, turn, "right"(lag(text) OVER w, 40) AS text_before, "left"(lead(text) OVER w, 40) AS text_after FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def payload_neighbours(s, d):
    return G.with_context(table(s, d, "conversations"), "conv_id", "turn", "text", 80).select("conv_id", "turn", F.col("before").alias("text_before"), F.col("after").alias("text_after"))


@query("""
SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN 'retain' ELSE 'default_retain' END AS why FROM conversations WHERE turn % 3 <> 0""")
def range_projection(s, d):
    u = table(s, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("unit_no"))
    acts = u.where("unit_no % 3 < 2").withColumn("action", F.when(F.col("unit_no") % 3 == 0, "exclude").otherwise("retain"))
    return E.retained_units(u, acts).select(F.col("doc_id").alias("conv_id"), F.col("unit_no").alias("turn"), "why")


@query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS turn FROM orders""")
def fair_request_queue(s, d):
    return C.fair_order(table(s, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey").select("o_orderkey", "turn")


@query("""
SELECT l_orderkey, list_sort(list(l_linenumber)) = range(1, count(*) + 1) AS covers FROM lineitem GROUP BY l_orderkey""")
def label_set_coverage(s, d):
    g = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").cast("int").alias("no"))).alias("labels"), F.count("*").cast("int").alias("n"))
    return g.select("l_orderkey", R.label_coverage(F.col("labels"), F.col("n")).alias("covers"))


@query(r"""
WITH t AS (SELECT conv_id, turn, regexp_extract(coalesce(text, ''), '^[^ ]+( [^ ]+)?') AS term FROM conversations)
SELECT conv_id, turn, length(term) BETWEEN 2 AND 20 AND NOT regexp_matches(term, '[。！？；：:;!?0-9]') AND regexp_full_match(term, '[A-Za-z]+([ -][A-Za-z]+){0,5}') AND NOT regexp_matches(term, '(?i)\b(is|are|has|to|and then|before|after)\b') AS noun FROM t""")
def noun_names(s, d):
    term = F.regexp_extract(F.coalesce("text", F.lit("")), r"^[^ ]+( [^ ]+)?", 0)
    return table(s, d, "conversations").select("conv_id", "turn", E.noun_name(term).alias("noun"))


@query(r"""
SELECT p_partkey, CASE WHEN p_size % 3 < 2 AND regexp_matches(lower(p_name || ' ' || p_type), '\b(cold|economy)\b') THEN substr(p_name || ' ' || p_type, 1, 240) END AS against FROM part""")
def negative_evidence_veto(s, d):
    k = F.col("p_size") % 3
    rule = F.when(k == 0, "taxonomy_leaf").when(k == 1, "p2_forced").otherwise("scored")
    return table(s, d, "part").select("p_partkey", E.negative_evidence(rule, F.array("p_name", "p_type"), ["cold", "economy"]).alias("against"))


@query("""
WITH e AS (SELECT l_orderkey AS book, l_linenumber AS line_id, l_linenumber % 2 AS win, l_returnflag || l_linestatus AS text, CASE WHEN l_returnflag = 'R' THEN 'X' ELSE l_linestatus END AS quote, CASE WHEN l_orderkey % 2 = 1 THEN CASE WHEN l_linestatus = 'O' THEN 'step' ELSE 'rule' END WHEN l_linenumber = 1 THEN 'heading' ELSE 'prose' END AS role FROM lineitem),
j AS (SELECT a.book, a.line_id, a.role, b.win FROM e a JOIN e b USING (book, line_id) WHERE contains(b.text, a.quote))
SELECT book, CASE WHEN book % 2 = 1 THEN 'N3' ELSE 'N1' END AS layout, CASE WHEN book % 2 = 1 THEN count(DISTINCT line_id) >= 2 ELSE bool_or(role = 'heading') AND bool_or(role = 'prose') END AS roles_ok, count(DISTINCT win) >= 2 AS windows_ok FROM j GROUP BY book""")
def layout_verdicts(s, d):
    no, odd = F.col("l_linenumber"), F.col("l_orderkey") % 2 == 1
    x = table(s, d, "lineitem").select(F.col("l_orderkey").alias("book"), no.alias("line_id"), (no % 2).alias("window"), F.concat("l_returnflag", "l_linestatus").alias("text"), F.when(odd, "N3").otherwise("N1").alias("class"), F.when(F.col("l_returnflag") == "R", "X").otherwise(F.col("l_linestatus")).alias("quote"), F.when(odd, F.when(F.col("l_linestatus") == "O", "step").otherwise("rule")).when(no == 1, "heading").otherwise("prose").alias("role"))
    v = E.layout_verdict(x.select("book", "class", "line_id", "quote", "role"), x.select("book", "window", "line_id", "text"))
    return v.select("book", F.col("class").alias("layout"), "roles_ok", "windows_ok")


@query("""
WITH t AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderstatus) ELSE lower(o_orderstatus) END AS term FROM orders)
SELECT o_custkey, lower(term) AS key, arg_min(term, o_orderkey) AS name, string_agg(o_orderkey::varchar, ',' ORDER BY o_orderkey) AS places FROM t GROUP BY o_custkey, lower(term)""")
def name_grouping(s, d):
    status = F.when(F.col("o_orderkey") % 2 == 0, F.upper("o_orderstatus")).otherwise(F.lower("o_orderstatus"))
    g = G.grouped_names(table(s, d, "orders").select("o_custkey", "o_orderkey", status.alias("term")), "o_custkey", "term", "o_orderkey")
    return g.withColumn("places", F.array_join(F.col("places").cast("array<string>"), ","))


@query("""
SELECT l_orderkey, count(*) FILTER (WHERE l_quantity <= 40 AND l_linenumber % 2 = 1) AS kept, CASE WHEN bool_or(l_quantity > 40) THEN 'size' ELSE '' END || CASE WHEN bool_or(l_quantity > 40) AND bool_or(l_linenumber % 2 = 0) THEN ',' ELSE '' END || CASE WHEN bool_or(l_linenumber % 2 = 0) THEN 'parity' ELSE '' END AS vetoes FROM lineitem GROUP BY l_orderkey""")
def post_route_constraints(s, d):
    g = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("no"), F.col("l_quantity").alias("q"))).alias("tops"))
    x = B.constrained(g, "tops", {"size": lambda c: c["q"] <= 40, "parity": lambda c: c["no"] % 2 == 1})
    return x.select("l_orderkey", F.size("tops").cast("long").alias("kept"), F.array_join("vetoes", ",").alias("vetoes"))
