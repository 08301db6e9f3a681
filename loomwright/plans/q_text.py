"""Text normalisation and records over the driver's tables."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import rules as R
from ..operators import segment as G
from .registry import query, table

ONE = "string_split(text, chr(10))[1]"


@query(f"""
WITH x AS (SELECT doc_id, {ONE} AS l FROM documents)
SELECT doc_id, trim(regexp_replace(l, '\\s+', ' ', 'g')) AS compact, lower(regexp_replace(l, '[^A-Za-z0-9㐀-鿿]+', '', 'g')) AS compact_key, replace(lower(trim(l)), 'ß', 'ss') AS name_key,
 CASE WHEN regexp_matches(l, '[㐀-鿿]') AND regexp_matches(l, '[A-Za-z]') THEN 'mixed' WHEN regexp_matches(l, '[㐀-鿿]') THEN 'cjk' WHEN regexp_matches(l, '[A-Za-z]') THEN 'latin' ELSE 'none' END AS script,
 CASE WHEN regexp_replace(l, '\\s+', '', 'g') = '' THEN 1.0::DOUBLE ELSE round(1.0::DOUBLE - length(regexp_replace(l, '[^A-Za-z0-9㐀-鿿]+', '', 'g'))::DOUBLE / length(regexp_replace(l, '\\s+', '', 'g')), 6) END AS symbols FROM x""")
def text_keys(s, d):
    x = table(s, d, "documents").select("doc_id", T.first_line(F.col("text")).alias("l"))
    return x.select("doc_id", T.compact(F.col("l")).alias("compact"), T.compact_key(F.col("l")).alias("compact_key"), T.name_key(F.col("l")).alias("name_key"), T.script_class(F.col("l")).alias("script"), F.round(T.symbol_ratio(F.col("l")), 6).alias("symbols"))


@query(r"""
WITH x AS (SELECT doc_id, ['ab中文cd文' || lang, '', '中-x-中', lang || '、文' || source, source][doc_id % 5 + 1] || '文' || text AS t FROM documents),
y AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[^A-Za-z㐀-䶿一-鿿豈-﫿]+', '', 'g'), '[A-Za-z]+', 'L', 'g'), '[㐀-䶿一-鿿豈-﫿]+', 'C', 'g') AS t FROM x)
SELECT doc_id, CAST(greatest(length(t) - 1, 0) AS INT) AS switches FROM y""")
def script_switches(s, d):
    k = F.col("doc_id") % 5
    t = F.when(k == 0, F.concat(F.lit("ab中文cd文"), "lang")).when(k == 1, "").when(k == 2, "中-x-中").when(k == 3, F.concat("lang", F.lit("、文"), "source")).otherwise(F.col("source"))
    return table(s, d, "documents").select("doc_id", T.script_switches(F.concat(t, F.lit("文"), "text")).alias("switches"))


@query(f"""
SELECT doc_id, sha1(doc_id || chr(31) || source || chr(31) || doc_id || chr(31) || {ONE} || chr(31)) AS record_key,
 lang || ':important:' || substr(sha256('["' || lang || '", "important", ' || doc_id || ']'), 1, 24) AS namespaced FROM documents""")
def record_keys(s, d):
    x = table(s, d, "documents")
    key = F.sha1(F.concat_ws("\u001f", F.col("doc_id").cast("string"), T.blank(F.col("source")), F.col("doc_id").cast("string"), T.first_line(F.col("text")), F.lit("")))
    seed = F.concat(F.lit('["'), "lang", F.lit('", "important", '), F.col("doc_id").cast("string"), F.lit("]"))
    return x.select("doc_id", key.alias("record_key"), F.concat("lang", F.lit(":important:"), F.substring(F.sha2(seed, 256), 1, 24)).alias("namespaced"))


@query("SELECT doc_id, CASE WHEN lang = source THEN lang WHEN n_chars % 2 = 0 THEN lang || chr(10) || source ELSE lang || chr(10) || source || chr(10) || 'odd' END AS context FROM documents")
def context_assembly(s, d):
    x = table(s, d, "documents")
    return x.select("doc_id", T.join_unique([F.col("lang"), F.col("source"), F.lit(""), F.col("lang"), F.when(F.col("n_chars") % 2 == 0, "").otherwise("odd")]).alias("context"))


@query("""
WITH x AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), '\\s+([,.!?;:])', '\\1', 'g') AS t FROM documents),
y AS (SELECT doc_id, t, length(regexp_extract(left(t, 600), '(?s)^(.*[。！？；.!?;])', 1)) AS e FROM x)
SELECT doc_id, sha256(CASE WHEN length(t) <= 600 THEN t WHEN e - 1 >= 300 THEN left(t, e) ELSE regexp_replace(left(t, 600), '\\s+$', '') || '…' END) AS h, length(t) > 600 AS cut FROM y""")
def clean_context(s, d):
    x = table(s, d, "documents").select("doc_id", T.normalize_text(F.col("text")).alias("t")).select("doc_id", R.clean_context(F.col("t"), 600).alias("c"))
    return x.select("doc_id", F.sha2("c.text", 256).alias("h"), F.array_contains("c.flags", "context_truncated").alias("cut"))


#: Names in and out of their language's field.
NAMES = ["English name", "中文", "", "12", "Mixed 中文"]


@query("""
WITH x AS (SELECT doc_id, ['English name', '中文', '', '12', 'Mixed 中文', lang, source][doc_id % 7 + 1] AS zh, ['', 'point', '中文', '12', '中文 ' || lang, source][doc_id % 6 + 1] AS en FROM documents),
f AS (SELECT *, regexp_matches(zh, '[A-Za-z]') AND NOT regexp_matches(zh, '[㐀-䶿一-鿿豈-﫿]') AS z_en, regexp_matches(en, '[㐀-䶿一-鿿豈-﫿]') AND NOT regexp_matches(en, '[A-Za-z]') AS e_zh FROM x),
m AS (SELECT *, CASE WHEN z_en AND en = '' THEN 'zh->en' WHEN zh = '' AND e_zh THEN 'en->zh' WHEN z_en AND e_zh THEN 'swap:zh,en' ELSE '' END AS move FROM f)
SELECT doc_id, CASE move WHEN 'zh->en' THEN '' WHEN '' THEN zh ELSE en END AS zh, CASE move WHEN 'en->zh' THEN '' WHEN '' THEN en ELSE zh END AS en, move, z_en AND e_zh AS reversed FROM m""")
def language_routing(s, d):
    of = lambda k, *values: F.element_at(F.array(*[F.lit(v) if not hasattr(v, "alias") else v for v in values]), (k + 1).cast("int"))
    k = F.col("doc_id")
    x = table(s, d, "documents").select("doc_id", of(k % 7, *NAMES, F.col("lang"), F.col("source")).alias("zh"), of(k % 6, "", "point", "中文", "12", F.concat(F.lit("中文 "), "lang"), F.col("source")).alias("en"))
    m = R.language_move(F.col("zh"), F.col("en"))
    return x.select("doc_id", m["zh"].alias("zh"), m["en"].alias("en"), m["move"].alias("move"), R.language_reversed(F.col("zh"), F.col("en")).alias("reversed"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END AS name, CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'k' || doc_id END AS id, lang || '/' || source AS main_tags FROM documents")
def field_fallback(s, d):
    x = table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("name"), F.col("source").alias("key_zh"), F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).alias("id"), F.concat(F.lit("k"), "doc_id").alias("record_id"), F.concat_ws("/", "lang", "source").alias("main_tags"))
    r = R.standard_record(x, {"name": ["name", "key_zh"], "id": ["id", "record_id"], "main_tags": ["main_tags"]})
    return r.select(F.col("doc_id"), "name", "id", "main_tags")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 1999 END AS other FROM orders")
def publication_year(s, d):
    x = table(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "'ed.' yyyy-MM-dd").alias("a"), F.when(F.col("o_orderkey") % 2 == 0, "isbn 120000").otherwise("ca.1999, repr").alias("b"))
    return x.select("o_orderkey", T.publication_year(F.col("a")).alias("year"), T.publication_year(F.col("b")).alias("other"))


@query("""
WITH u AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z][a-z0-9_-]+|[0-9]+(?:[.][0-9]+)?')) AS u FROM benchmark)
SELECT a.item_id, round_even(CASE WHEN len(a.u) = 0 THEN 1.0 ELSE len(list_intersect(a.u, b.u))::DOUBLE / len(a.u) END, 4) AS overlap FROM u a JOIN u b ON b.item_id = a.item_id + 1""")
def content_grounding(s, d):
    b = table(s, d, "benchmark").select("item_id", T.compact(F.col("text")).alias("t"))
    j = b.join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("t").alias("src")), "item_id")
    return j.select("item_id", T.grounding(F.col("t"), F.col("src"), 0.72)["overlap"].alias("overlap"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<img')) AS BIGINT) AS n_images, regexp_matches(html, '(?i)<table') AS has_table FROM pages")
def html_structure(s, d):
    x = table(s, d, "pages").select("page_id", G.without_embedded_images(F.col("html")).alias("html"))
    return x.select("page_id", F.regexp_count("html", F.lit("<img")).cast("long").alias("n_images"), F.col("html").rlike("(?i)<table").alias("has_table"))


@query()
def html_table_integrity(s, d):
    return table(s, d, "pages").select("page_id", G.intact_table(F.col("html")).alias("intact"))


@query(r"""
WITH x AS (SELECT doc_id, text || repeat('=', CAST(doc_id % 20 AS INT)) || repeat(['ab', 'é', '7', ' '][doc_id % 4 + 1], 9) || repeat('Qz+', CAST(60 + doc_id % 20 AS INT)) || '==' AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(t, '[A-Za-z0-9+/]{200,}={0,2}', '[]', 'g') AS t, list_sum(list_transform(regexp_extract_all(t, '[A-Za-z0-9+/]{200,}={0,2}'), lambda m: length(CAST(length(m) AS VARCHAR)) + 7)) AS more FROM x),
c AS (SELECT doc_id, unnest(range(1, length(t) + 1)) AS k, t FROM b), s AS (SELECT doc_id, k, t[k] AS ch, k - row_number() OVER (PARTITION BY doc_id, t[k] ORDER BY k) AS g FROM c),
r AS (SELECT doc_id, ch, g, count(*) AS n FROM s GROUP BY 1, 2, 3), z AS (SELECT doc_id, sum(CASE WHEN n >= 8 AND NOT regexp_matches(ch, '\s|\d') THEN 4 + length(CAST(n AS VARCHAR)) ELSE n END) AS n FROM r GROUP BY 1)
SELECT doc_id, CAST(coalesce(z.n, 0) + coalesce(more, 0) AS INT) AS n FROM b LEFT JOIN z USING (doc_id)""")
def repetition_compaction(s, d):
    k = F.col("doc_id")
    some = F.when(k % 4 == 0, "ab").when(k % 4 == 1, "é").when(k % 4 == 2, "7").otherwise(" ")
    t = F.concat("text", F.repeat(F.lit("="), (k % 20).cast("int")), F.repeat(some, F.lit(9)), F.repeat(F.lit("Qz+"), (60 + k % 20).cast("int")), F.lit("=="))
    return table(s, d, "documents").select("doc_id", F.length(T.cap_repeats(t)).alias("n"))


@query(f"""
WITH x AS (SELECT doc_id, {ONE} AS l FROM documents),
t AS (SELECT doc_id, CASE doc_id % 9 WHEN 0 THEN '# ' || l WHEN 1 THEN '1.2. ' || l WHEN 2 THEN '"' || l || '"' WHEN 3 THEN 'Table 3' WHEN 4 THEN 'contents' WHEN 5 THEN 'a' WHEN 6 THEN 'https://example.com' WHEN 7 THEN '-12.5' ELSE l END AS raw FROM x),
n AS (SELECT doc_id, trim(regexp_replace(raw, '[ \\t]+', ' ', 'g')) AS raw FROM t),
p AS (SELECT doc_id, raw, regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '^\\s*#{{1,6}}\\s*', ''), '^\\s*(?:[0-9]+(?:\\.[0-9]+){{0,5}}[.):]|[0-9]+\\s+|[A-Za-z][.)]\\s+)\\s*', ''), '^\\s*(?:[0-9]+(?:\\.[0-9]+){{0,5}}[.):]|[0-9]+\\s+|[A-Za-z][.)]\\s+)\\s*', ''), '^[ \\t\\r\\n:：、—-]+|[ \\t\\r\\n:：、—-]+$', '', 'g') AS v FROM n),
q AS (SELECT doc_id, v <> raw AS prefix, CASE WHEN length(v) >= 2 AND v[1] = '"' AND v[-1] = '"' AND NOT contains(v[2:-2], '"') AND trim(v[2:-2]) <> '' THEN trim(v[2:-2]) ELSE v END AS w, v FROM p),
c AS (SELECT doc_id, prefix, w <> v AS unquoted, w, length(regexp_replace(w, '[^A-Za-z0-9㐀-鿿]+', '', 'g')) AS tech, 1.0 - length(regexp_replace(w, '[^A-Za-z0-9㐀-鿿]+', '', 'g'))::DOUBLE / greatest(1, length(regexp_replace(w, '\\s+', '', 'g'))) AS sym FROM q)
SELECT doc_id, sha256(w) AS h, CASE WHEN w = '' THEN 'empty_title' WHEN regexp_matches(w, '(?i)^(?:https?://|www\\.|ftp://|[a-z0-9.-]+\\.(?:com|org|net|cn|edu))$') THEN 'url_or_email_title' WHEN lower(w) IN ('contents', 'index', 'table', 'figure', 'preface', 'references') THEN 'structural_or_metadata_title'
 WHEN regexp_matches(w, '(?i)^(?:fig(?:ure)?|table|plate|photo)\\s*[A-Za-z]?[0-9]+(?:\\s|[：:].*)?$') THEN 'figure_or_table_title' WHEN regexp_matches(w, '(?i)^[+-]?(?:[0-9]+(?:\\.[0-9]+)?|[IVXLCDM]{{1,10}})$') THEN 'bare_number_or_date' WHEN regexp_matches(w, '^[A-Za-z]$') THEN 'single_latin_letter'
 WHEN length(w) > 640 THEN 'extremely_overlong_title' WHEN tech = 0 THEN 'no_usable_title_characters' WHEN sym > 0.62 AND tech < 5 AND NOT regexp_matches(w, '[$_^]') THEN 'symbol_dominated_title' END AS reason, prefix, unquoted FROM c""")
def rule_gate_titles(s, d):
    l, k = T.first_line(F.col("text")), F.col("doc_id") % 9
    raw = F.when(k == 0, F.concat(F.lit("# "), l)).when(k == 1, F.concat(F.lit("1.2. "), l)).when(k == 2, F.concat(F.lit('"'), l, F.lit('"'))).when(k == 3, "Table 3").when(k == 4, "contents").when(k == 5, "a").when(k == 6, "https://example.com").when(k == 7, "-12.5").otherwise(l)
    x = table(s, d, "documents").select("doc_id", T.normalize_text(raw).alias("t")).select("doc_id", R.clean_title(F.col("t")).alias("c"))
    return x.select("doc_id", F.sha2("c.text", 256).alias("h"), "c.reason", F.array_contains("c.flags", "title_prefix_removed").alias("prefix"), F.array_contains("c.flags", "outer_quotes_removed").alias("unquoted"))


@query(r"""
WITH x AS (SELECT doc_id, ['contents', '', lang || ' ' || source || ' name', 'Table 3', 'x', '2020', 'www.' || lang || '.com', '???? ' || source, 'Example 3'][doc_id % 9 + 1] AS a, ['q', '', 'some point', 'index', '12.5', 'a@b.org', '······'][doc_id // 9 % 7 + 1] AS b FROM documents),
r AS (SELECT doc_id, t, i, CASE WHEN t = '' THEN 'empty_title' WHEN contains(t, '????') THEN 'garbled_title' WHEN regexp_full_match(t, '(?i)(?:https?://|www\.|ftp://|[a-z0-9.-]+\.(?:com|org|net|cn|edu))') OR regexp_full_match(t, '[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}') THEN 'url_or_email_title' WHEN regexp_full_match(t, '(?i)contents|index|preface|references') THEN 'structural_or_metadata_title'
 WHEN regexp_full_match(t, '(?i)table\s+\d+') THEN 'figure_or_table_title' WHEN regexp_full_match(t, '(?i)example\s*\d+') THEN 'worked_example_title' WHEN regexp_full_match(t, '[+-]?\d+(?:\.\d+)?|(?i:[IVXLCDM]{1,10})') THEN 'bare_number_or_date' WHEN regexp_full_match(t, '[A-Za-z]') THEN 'single_latin_letter' END AS reason
 FROM (SELECT doc_id, CASE WHEN regexp_full_match(a, '·+') THEN '' ELSE a END AS t, 1 AS i FROM x UNION ALL SELECT doc_id, CASE WHEN regexp_full_match(b, '·+') THEN '' ELSE b END, 2 FROM x)),
y AS (SELECT doc_id, max(CASE WHEN i = 1 THEN reason END) AS ra, max(CASE WHEN i = 2 THEN reason END) AS rb, max(a) AS a, max(b) AS b FROM r JOIN x USING (doc_id) GROUP BY 1),
w AS (SELECT doc_id, ra IS NULL AS ka, rb IS NULL AS kb, list_distinct(list_filter([CASE WHEN a <> '' THEN ra END, CASE WHEN b <> '' THEN rb END], lambda v: v IS NOT NULL)) AS why FROM y)
SELECT doc_id, CASE WHEN ka OR kb THEN 'pass' ELSE 'rejected' END AS status, CASE WHEN ka OR kb THEN 'rule_pass' WHEN len(why) = 1 THEN why[1] ELSE 'no_valid_title_after_rule_cleanup' END AS reason FROM w""")
def record_rule_gate(s, d):
    of = lambda k, *values: F.element_at(F.array(*[F.lit(v) if not hasattr(v, "alias") else v for v in values]), (k + 1).cast("int"))
    k = F.col("doc_id")
    a = of(k % 9, "contents", "", F.concat_ws(" ", "lang", "source", F.lit("name")), "Table 3", "x", "2020", F.concat(F.lit("www."), "lang", F.lit(".com")), F.concat(F.lit("???? "), "source"), "Example 3")
    x = table(s, d, "documents").select("doc_id", a.alias("a"), of(F.floor(k / 9) % 7, "q", "", "some point", "index", "12.5", "a@b.org", "······").alias("b"))
    return R.record_gate(x, "a", "b").select("doc_id", "rule.status", "rule.reason")
