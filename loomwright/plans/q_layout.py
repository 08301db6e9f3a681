"""Layout, readers, checks and streams over the driver's tables."""

import json

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import books as B
from ..operators import evidence as E
from ..operators import layout as L
from ..operators import rules as R
from ..operators import score as C
from ..operators import segment as G
from ..operators import trees as H
from ..operators import windows as X
from ..operators.graph import temporary
from ..sources import readers, sinks
from ..streaming import checkpoints
from .registry import query, table

#: A book around each document's own values: (kind, text) with {s} for its source, {l} its language, {t} its text.
BOOK = [("heading", "# Intro {s}"), ("text", "{t}"), ("heading", "## Appendix: abbreviations"), ("text", "{l}"), ("heading", "### Part {l}"), ("text", "x"), ("heading", "## Next"), ("text", "![a](b.png)"), ("text", "Intro {s} - Fig. 3"), ("heading", "# Contents"), ("text", "{s} 12"), ("heading", "## Deep"), ("heading", "# Appendix B"), ("text", "{l} end"), ("table", "| a |"), ("heading", "## Next"), ("heading", "# Index"), ("text", "{s}, 5")]
BOOK_SQL = "b AS (SELECT doc_id, unnest(range(1, " + str(len(BOOK) + 1) + ")) AS unit_no, unnest([" + ", ".join(f"'{k}'" for k, _ in BOOK) + "]) AS kind, unnest([" + ", ".join("'" + t.replace("{s}", "' || source || '").replace("{l}", "' || lang || '").replace("{t}", "' || text || '") + "'" for _, t in BOOK) + "]) AS text FROM documents)"


def book(s, d):
    def one(kind, t):
        v = F.lit(t)
        for mark, col in (("{s}", "source"), ("{l}", "lang"), ("{t}", "text")):
            v = F.replace(v, F.lit(mark), F.col(col)) if mark in t else v
        return F.struct(F.lit(kind).alias("kind"), v.alias("text"))

    x = table(s, d, "documents").select("doc_id", F.posexplode(F.array(*[one(k, t) for k, t in BOOK])).alias("k", "u"))
    return x.select("doc_id", (F.col("k") + 1).alias("unit_no"), "u.kind", "u.text")


@query("WITH RECURSIVE " + BOOK_SQL + r""", h AS (SELECT *, trim(regexp_replace(text, '^\s*#+\s*', '')) AS head, CASE WHEN kind = 'heading' THEN length(regexp_extract(text, '^\s*(#{1,6})\s', 1)) END AS level FROM b),
o AS (SELECT *, CASE WHEN kind = 'heading' AND regexp_matches(head, '(?i)^(附录|appendix\b)') THEN CASE WHEN regexp_matches(head, '(?i)缩略|abbreviat|acronym') THEN 'abbreviation_appendix' ELSE '-' END WHEN kind = 'heading' AND regexp_full_match(head, '(?i)(?:table of )?contents|index|目录|索引') THEN 'contents_or_index' END AS opens FROM h),
z AS (SELECT doc_id, unit_no, CASE WHEN opens <> '-' THEN opens END AS zone, level AS zl FROM o WHERE unit_no = 1
 UNION ALL SELECT o.doc_id, o.unit_no, CASE WHEN o.opens IS NOT NULL THEN nullif(o.opens, '-') WHEN o.level <= z.zl THEN NULL ELSE z.zone END, CASE WHEN o.opens IS NOT NULL THEN o.level ELSE z.zl END FROM z JOIN o ON o.doc_id = z.doc_id AND o.unit_no = z.unit_no + 1),
k AS (SELECT *, lower(regexp_replace(head, '[^\p{L}\p{N}_]+', '', 'g')) AS key, lower(regexp_replace(regexp_split_to_array(head, '(?i)[—–-]\s*(?:Fig\.?|Figure)\s*\d+')[1], '[^\p{L}\p{N}_]+', '', 'g')) AS base, coalesce(regexp_full_match(lag(trim(text)) OVER w, '!\[[^\]]*\]\([^\n]+\)') OR lag(kind) OVER w = 'table', false) AS behind FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY unit_no)),
c AS (SELECT doc_id, unit_no, base, behind AND EXISTS (SELECT 1 FROM k p WHERE p.doc_id = k.doc_id AND p.unit_no < k.unit_no AND p.kind = 'heading' AND p.key = k.base) AS caption FROM k)
SELECT doc_id, CAST(unit_no AS INT) AS unit_no, zone, CASE WHEN caption THEN 'caption' END AS head_role, CASE WHEN caption THEN base END AS caption_for FROM z JOIN c USING (doc_id, unit_no)""")
def unit_zones(s, d):
    """Excluded zones and captions of a book around each document."""
    return L.annotated(book(s, d)).select("doc_id", "unit_no", "zone", "head_role", "caption_for")


@query("WITH " + BOOK_SQL + r""", h AS (SELECT doc_id, unit_no AS o FROM b WHERE kind = 'heading'), p AS (SELECT b.doc_id, unit_no, text, length(text) AS n, max(o) AS heading_no FROM b JOIN h ON h.doc_id = b.doc_id AND o <= unit_no WHERE kind <> 'heading' GROUP BY 1, 2, 3, 4),
u AS (SELECT *, CAST(400 - coalesce(sum(n) OVER (PARTITION BY doc_id, heading_no ORDER BY unit_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS room FROM p),
e AS (SELECT *, CASE WHEN n <= room THEN n WHEN regexp_matches(substr(text, 1, room), '(?s)^.*([。！？；]|[.!?;](\s|$))') THEN length(rtrim(regexp_extract(substr(text, 1, room), '(?s)^(.*(?:[。！？；]|[.!?;](?:\s|$)))', 1), chr(10) || ' ')) ELSE length(regexp_extract(substr(text, 1, room), '(?s)^(.*?)\s+\S*$', 1)) END AS e FROM u WHERE room > 0)
SELECT doc_id, CAST(heading_no AS INT) AS heading_no, CAST(unit_no AS INT) AS unit_no, CAST(e AS INT) AS "end", e < n AS cut FROM e WHERE e > 0""")
def heading_evidence(s, d):
    """Text behind each heading, 400 characters at most, cut at a sentence."""
    return L.heading_bodies(book(s, d), 400).select("doc_id", "heading_no", "unit_no", "end", "cut")


#: Lines with images and what may be their captions.
PICTURED = "![p](1.png)\n\nFigure of {s}\nplain line\n![q](2.png)\nA short line\n{l} map\n\n![r](3.png)\nNot one. Figure of it\nnothing\nsee ![s](4.png) \nthe long sentence of the Plate\n"


@query(r"""
WITH t AS (SELECT doc_id, string_split('""" + PICTURED.replace("{s}", "' || source || '").replace("{l}", "' || lang || '") + r"""' || text, chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(a) + 1)) AS k, unnest(a) AS line FROM t),
n AS (SELECT *, lead(k) OVER w AS k1, trim(lead(line) OVER w) AS a, lead(k, 2) OVER w AS k2, trim(lead(line, 2) OVER w) AS b FROM l WHERE trim(line) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
c AS (SELECT *, coalesce(length(a) <= 160 AND NOT regexp_matches(a, '[.!?。！？；;：:]') AND regexp_matches(a, '(?i)(?:figure|fig\.?|table|plate|image|photo|map)\b'), false) AS c1, coalesce(length(b) <= 160 AND NOT regexp_matches(b, '[.!?。！？；;：:]') AND regexp_matches(b, '(?i)(?:figure|fig\.?|table|plate|image|photo|map)\b'), false) AS c2 FROM n WHERE regexp_matches(line, '!\[[^\]]*\]\([^\n]+\)[ \t]*$'))
SELECT doc_id, CAST(k AS INT) AS line_no, CAST(CASE WHEN c2 AND length(a) <= 80 AND NOT regexp_matches(a, '[.!?。！？；;：:]') THEN k2 ELSE k1 END AS INT) AS last_line FROM c WHERE c1 OR c2""")
def caption_lines(s, d):
    x = F.concat(F.replace(F.replace(F.lit(PICTURED), F.lit("{s}"), F.col("source")), F.lit("{l}"), F.col("lang")), "text")
    return L.attached_captions(X.lines(table(s, d, "documents").select("doc_id", x.alias("text"))))


@query(r"""
WITH x AS (SELECT doc_id, '| name | n |' || chr(10) || '|:---|---:|' || chr(10) || string_agg('| ' || event_type || ' ' || event_id || ' | ' || user_id || ' |', chr(10) ORDER BY event_id) AS t, 60 + user_id * 7 % 300 AS p FROM (SELECT user_id AS doc_id, * FROM events) GROUP BY doc_id, user_id),
y AS (SELECT *, length(t) AS n, length(t[:p]) - length(regexp_extract(t[:p], '([^\n]*)$', 1)) AS a, CASE WHEN strpos(substr(t, p + 1), chr(10)) > 0 THEN p + strpos(substr(t, p + 1), chr(10)) ELSE length(t) END AS e FROM x)
SELECT doc_id, CASE WHEN n <= 400 THEN '0-' || n ELSE '0-25,' || a || '-' || e END AS spans FROM y""")
def table_evidence(s, d):
    """A Markdown table of each user's events: whole if small, else its head and the row at a place."""
    e = table(s, d, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("event_id", F.concat(F.lit("| "), "event_type", F.lit(" "), "event_id", F.lit(" | "), "user_id", F.lit(" |")).alias("r")))).alias("r"))
    t = F.concat(F.lit("| name | n |\n|:---|---:|\n"), F.array_join(F.transform("r", lambda x: x["r"]), "\n"))
    w = L.table_window(t, (F.col("doc_id") * 7 % 300 + 60).cast("int"))
    return e.select("doc_id", F.array_join(F.transform(w, lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("spans"))


@query(r"""
WITH f AS (SELECT doc_id, lang AS name, CASE WHEN doc_id % 4 = 0 THEN substr(text, 3, 40) WHEN doc_id % 4 = 1 THEN text WHEN doc_id % 4 = 2 THEN substr(text, 1, 1) END AS part, text, source FROM documents),
p AS (SELECT *, CASE WHEN part IS NULL THEN 'not_read' WHEN strpos(text, part) = 0 OR (part <> '' AND strpos(substr(text, strpos(text, part) + 1), part) > 0) OR part = '' THEN 'missing_or_ambiguous' END AS problem, strpos(text, part) - 1 AS st FROM f)
SELECT doc_id, name, problem, CASE WHEN problem IS NULL THEN st || '-' || (st + length(part)) END AS span, CASE WHEN problem IS NULL AND (st > 0 OR st + length(part) < length(text)) THEN 'source_unit_split' ELSE '' END AS issues, source AS scope FROM p""")
def candidate_construction(s, d):
    """Names with slices of documents that stand there once, everywhere, often, or were not read."""
    k, x = F.col("doc_id"), table(s, d, "documents")
    unit, chunk = k.cast("string"), F.concat(F.lit("c"), k)
    findings = x.select(chunk.alias("chunk_id"), F.col("lang").alias("name"), F.array(unit).alias("evidence_ids"), F.lit(False).alias("needs_context"))
    part = F.when(k % 4 == 0, F.substring("text", 3, 40)).when(k % 4 == 1, F.col("text")).otherwise(F.substring("text", 1, 1))
    parts = x.where("doc_id % 4 <> 3").select(chunk.alias("chunk_id"), unit.alias("unit_id"), part.alias("text"), F.lit(None).cast("int").alias("start"))
    c = L.made_candidates(findings, parts, x.select(unit.alias("unit_id"), "text", F.array("source").alias("headings")))
    span = F.get("spans", F.lit(0))
    at = F.when(F.col("problem").isNull(), F.concat_ws("-", span["start"], span["end"]))
    return c.select(F.substring("chunk_id", 2, 20).cast("long").alias("doc_id"), "name", "problem", at.alias("span"), F.array_join("issues", ",").alias("issues"), F.array_join("scope", ",").alias("scope"))


@query()
def navigation_regions(s, d):
    """Contents and index of a book around each document; tests hold it against a walk through the units."""
    return L.navigation_regions(book(s, d)).select("doc_id", "unit_no", "region")


@query(r"""
WITH x AS (SELECT doc_id, '# One ' || source || chr(10) || text || chr(10) || '## Two' || chr(10) || lang || ' head' AS t FROM documents),
y AS (SELECT doc_id, t, length(t) - length(lang_) - 5 AS st FROM (SELECT x.*, lang AS lang_ FROM x JOIN documents USING (doc_id)))
SELECT doc_id, CAST(len(regexp_extract_all(substr(t, greatest(st - 30000, 0) + 1, st - greatest(st - 30000, 0)), '(?m)^#{1,6}[ \t]+[^\n]+')) AS INT) AS n_heads, sha256(substr(t, greatest(st - 2000, 0) + 1, st + 3 + 1400 - greatest(st - 2000, 0))) AS h FROM y""")
def source_enrichment(s, d):
    """Headings before an entry at a text's end, and the text around its head."""
    x = table(s, d, "documents").select("doc_id", F.concat(F.lit("# One "), "source", F.lit("\n"), "text", F.lit("\n## Two\n"), "lang", F.lit(" head")).alias("text"), F.length("lang").alias("n"))
    start = (F.length("text") - F.col("n") - 5).cast("int")
    e = x.select("doc_id", F.lit(1).alias("entry_no"), start.alias("start"), (start + 3).alias("end"))
    r = L.enriched(e, x.select("doc_id", "text"))
    return r.select("doc_id", F.size("history").alias("n_heads"), F.sha2("window", 256).alias("h"))


@query(r"""
WITH x AS (SELECT doc_id, ['12. ' || source, '见图3-2 ' || source || '；', ': ' || lang || ' ; ', '(2) ' || lang || ' name'][doc_id % 4 + 1] AS t FROM documents)
SELECT doc_id, substr(trim(CASE doc_id % 4 WHEN 0 THEN t[5:] WHEN 1 THEN replace(replace(t, '见图3-2 ', ''), '；', '') WHEN 2 THEN replace(replace(t, ':', ''), ';', '') ELSE t[5:] END), 1, 8) AS name FROM x""")
def clean_model_texts(s, d):
    k = F.col("doc_id") % 4
    t = F.when(k == 0, F.concat(F.lit("12. "), "source")).when(k == 1, F.concat(F.lit("见图3-2 "), "source", F.lit("；"))).when(k == 2, F.concat(F.lit(": "), "lang", F.lit(" ; "))).otherwise(F.concat(F.lit("(2) "), "lang", F.lit(" name")))
    return table(s, d, "documents").select("doc_id", R.clean_model_text(t, 8).alias("name"))


@query(r"""
WITH x AS (SELECT doc_id, source || ' ' || lang AS o, [source || '  ' || lang, '中文 ' || source || ' ' || lang || '!', source || ' ' || lang || ' (' || doc_id || ')', text][doc_id % 4 + 1] AS s FROM documents), k AS (SELECT *, lower(regexp_replace(o, '[^A-Za-z0-9]+', '', 'g')) AS a, lower(regexp_replace(s, '[^A-Za-z0-9㐀-䶿一-鿿豈-﫿]+', '', 'g')) AS b FROM x)
SELECT doc_id, CASE WHEN a = b THEN 'exact_or_safe_normalization' WHEN regexp_matches(s, '[㐀-䶿一-鿿豈-﫿]') AND regexp_matches(s, '[A-Za-z]') AND contains(b, a) THEN 'bilingual_field_split' WHEN regexp_matches(s, '^(.*?)\s*\([^()]*\)\s*$') AND lower(regexp_replace(regexp_extract(s, '^(.*?)\s*\([^()]*\)\s*$', 1), '[^A-Za-z0-9]+', '', 'g')) = a THEN 'parenthetical_removed' ELSE 'unsupported_title_rewrite' END AS rule FROM k""")
def title_grounding(s, d):
    k = F.col("doc_id")
    src = F.when(k % 4 == 0, F.concat("source", F.lit("  "), "lang")).when(k % 4 == 1, F.concat(F.lit("中文 "), "source", F.lit(" "), "lang", F.lit("!"))).when(k % 4 == 2, F.concat("source", F.lit(" "), "lang", F.lit(" ("), k, F.lit(")"))).otherwise(F.col("text"))
    return table(s, d, "documents").select("doc_id", R.title_grounding(F.concat("source", F.lit(" "), "lang"), [src]).alias("rule"))


@query(r"""
WITH x AS (SELECT doc_id, ['XIV', 'Alpha', 'ab��', source][doc_id % 4 + 1] AS h, ['XIV. Also the ' || source, 'Alpha. See ' || source, 'x', source][doc_id % 4 + 1] AS line, ['b', 'See ' || source || chr(10) || lang, 'c', text][doc_id % 4 + 1] AS body FROM documents)
SELECT doc_id, CASE WHEN regexp_full_match(h, '[IVXLCDM]{2,9}') AND starts_with(line, h) AND regexp_matches(substr(line, length(h) + 1), '(?i)^[.)]\s+(Also|Whereas|It is)\b') THEN 'numbered_source_passage' WHEN starts_with(lower(line), lower(h || '.')) AND regexp_extract(line, '(?i)\.\s+(See\s+\S.+)$', 1) <> '' AND string_split(body, chr(10))[1] = regexp_extract(line, '(?i)\.\s+(See\s+\S.+)$', 1) AND len(string_split(body, chr(10))) > 1 THEN 'index_see_only'
 WHEN length(h) - length(replace(h, '�', '')) >= greatest(2, length(h) // 4) THEN 'unreadable_head' END AS why FROM x""")
def structural_rejects(s, d):
    k = F.col("doc_id") % 4
    of = lambda *v: F.when(k == 0, v[0]).when(k == 1, v[1]).when(k == 2, v[2]).otherwise(v[3])
    cat = lambda *v: F.concat(*[F.lit(x) if x not in ("source", "lang") else F.col(x) for x in v])
    why = E.structural_reject(of("XIV", "Alpha", "ab��", F.col("source")), of(cat("XIV. Also the ", "source"), cat("Alpha. See ", "source"), "x", F.col("source")), of("b", cat("See ", "source", "\n", "lang"), "c", F.col("text")))
    return table(s, d, "documents").select("doc_id", why.alias("why"))


@query(r"""
SELECT doc_id, sha256(array_to_string(list_transform([0, 1, 2], lambda i: substr(text, CAST(i * 50 + doc_id % 7 + 1 AS INT), 20)), chr(10) || chr(10))) AS h FROM documents""")
def span_render(s, d):
    at = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((i * 50 + F.col("doc_id") % 7).cast("int").alias("start"), (i * 50 + F.col("doc_id") % 7 + 20).cast("int").alias("end")))
    return table(s, d, "documents").select("doc_id", F.sha2(E.render(F.col("text"), at), 256).alias("h"))


@query(r"""
WITH x AS (SELECT doc_id, source || ' is it. ' || ['It ends', 'Ask Dr.', 'Whole (yes!)', 'So?'][doc_id % 4 + 1] AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(t, '[.!?][")\]]*$') AND NOT regexp_matches(t, '\bDr\.$') THEN t ELSE regexp_extract(t, '^(.*?[.!?])\s', 1) END AS body FROM x""")
def tail_trimming(s, d):
    k = F.col("doc_id") % 4
    t = F.concat("source", F.lit(" is it. "), F.when(k == 0, "It ends").when(k == 1, "Ask Dr.").when(k == 2, "Whole (yes!)").otherwise("So?"))
    return table(s, d, "documents").select("doc_id", G.trimmed_tail(t).alias("body"))


@query("SELECT n_nationkey, n_name FROM nation")
def strict_json_scan(s, d):
    p = temporary(s)
    sinks.write_jsonl(table(s, d, "nation").select("n_nationkey", "n_name"), p)
    return readers.read_many(s, [p], "n_nationkey int, n_name string", "n_nationkey").select("n_nationkey", "n_name")


@query("SELECT n_name AS text FROM nation")
def markdown_scan(s, d):
    p = temporary(s)
    table(s, d, "nation").select(F.concat(F.lit("﻿"), "n_name", F.lit("  ")).alias("value")).repartition(25, "value").write.option("lineSep", "\n").text(p)
    r = readers.read_markdown(s, f"{p}/*.txt")
    return r.select(F.explode(F.split("text", "\n")).alias("text")).select(F.regexp_replace("text", "﻿", "").alias("text")).where("text <> ''")


@query(r"""
WITH l AS (SELECT doc_id, k, line FROM (SELECT doc_id, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
f AS (SELECT *, regexp_replace(lower(regexp_replace(line, '^[#>*\-\s]+', '')), '\s+', '', 'g') AS key FROM l), u AS (SELECT doc_id, key, min(k) AS k FROM f GROUP BY 1, 2 HAVING count(*) = 1),
z AS (SELECT doc_id, CASE WHEN k % 5 = 0 THEN 14.0 ELSE 10.0 END AS size, sum(length(line)) AS w FROM l GROUP BY 1, 2), m AS (SELECT doc_id, arg_max(size, w * 1000 - size) AS body FROM z GROUP BY 1)
SELECT f.doc_id, CAST(f.k AS INT) AS line_no, CAST(CASE WHEN u.key <> '' THEN f.k // 40 END AS INT) AS page, CASE WHEN u.key <> '' THEN round(CASE WHEN f.k % 5 = 0 THEN 14.0 ELSE 10.0 END / body, 3)::DOUBLE END AS size_ratio FROM f JOIN m USING (doc_id) LEFT JOIN u ON u.doc_id = f.doc_id AND u.key = f.key""")
def pdf_side_input(s, d):
    """Pages and type sizes of a second rendering's lines, where a line is unique in both."""
    x = X.lines(table(s, d, "documents"))
    pdf = x.select("doc_id", "line_no", "line", F.floor(F.col("line_no") / 40).cast("int").alias("page"), F.when(F.col("line_no") % 5 == 0, 14.0).otherwise(10.0).alias("size"), F.lit(False).alias("bold"), F.lit(False).alias("italic"))
    return readers.with_pdf_format(x, pdf).select("doc_id", "line_no", "page", "size_ratio")


@query("SELECT CAST(doc_id AS VARCHAR) AS key FROM labels WHERE quality = 1")
def sqlite_checkpoint(s, d):
    """Keys done under the current policy in an SQLite checkpoint, written here from the labels."""
    import sqlite3

    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE done (key TEXT, policy_version TEXT)")
    db.executemany("INSERT INTO done VALUES (?, ?)", ((str(r.doc_id), f"v{r.quality}") for r in table(s, d, "labels").select("doc_id", "quality").toLocalIterator()))
    db.commit()
    p, raw = temporary(s), db.serialize()
    at = s._jvm.org.apache.hadoop.fs.Path(f"{p}/done.sqlite")
    out = at.getFileSystem(s._jsc.hadoopConfiguration()).create(at)
    out.write(raw)
    out.close()
    return readers.completed_sqlite(s, p, "done", "v1")[0]


@query("SELECT doc_id, 'v2' AS policy_version, quality AS result FROM labels")
def stream_resume(s, d):
    """A change of policy does all rows again; the last results stand."""
    p, rows = temporary(s), table(s, d, "labels").select("doc_id", "quality")
    done = lambda x: x.select("doc_id", F.col("quality").alias("result"))
    checkpoints.resume(s, rows.where("doc_id % 2 = 0"), done, p, "doc_id", "v1", 1)
    checkpoints.resume(s, rows.where("doc_id % 3 = 0"), done, p, "doc_id", "v2", 2)
    checkpoints.resume(s, rows, done, p, "doc_id", "v2", 3)
    return checkpoints.latest(s, p, "doc_id", "v2").select("doc_id", "policy_version", "result")


@query()
def request_tokens(s, d):
    """Exact token counts of whole conversations by a public tokenizer; tests hold them against the library."""
    import public_tokenizers

    return C.request_tokens(table(s, d, "conversations"), public_tokenizers.path("word_bpe_49k.json"), "conv_id", "turn", "role", "text")


@query("SELECT doc_id, CASE WHEN quality = 1 THEN 'rows' ELSE 'other' END AS track FROM labels")
def track_split(s, d):
    x = table(s, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "rows").otherwise("other").alias("track"))
    parts = E.split_tracks(x, "track", ["rows", "other"])
    return parts["rows"].unionByName(parts["other"])


@query("""
WITH x AS (SELECT doc_id, ['heading', 'text', 'text', 'heading'][doc_id % 4 + 1] AS kind, CASE WHEN quality = 0 THEN 'contents_or_index' END AS zone, CASE WHEN toxic = 1 THEN 'caption' END AS role, ['', '', 'x '][doc_id % 3 + 1] || source AS text, source || ['', '.'][doc_id % 5 // 4 + 1] AS quote, doc_id % 7 = 0 AS inline FROM labels JOIN documents USING (doc_id))
SELECT doc_id, zone IS NULL AND role IS NULL AND (kind = 'heading' OR inline OR (trim(text) = trim(quote) AND quote NOT LIKE '%.')) AS independent FROM x""")
def independent_heads(s, d):
    k = F.col("doc_id")
    x = table(s, d, "labels").join(table(s, d, "documents"), "doc_id")
    v = L.independent_head(F.when((k % 4).isin(0, 3), "heading").otherwise("text"), F.when(F.col("quality") == 0, "contents_or_index"), F.when(F.col("toxic") == 1, "caption"), F.lit(None).cast("boolean"), F.concat(F.when(k % 3 == 2, "x ").otherwise(""), "source"), F.concat("source", F.when(k % 5 == 4, ".").otherwise("")), k % 7 == 0)
    return x.select("doc_id", v.alias("independent"))


@query("SELECT 'r' || n_regionkey || '/' || n_name AS path, 2 AS depth FROM nation UNION ALL SELECT 'r' || r_regionkey, 1 FROM region")
def taxonomy_normalization(s, d):
    """A nested tree of regions and nations, a setting of few nodes, as a table of nodes."""
    rows = table(s, d, "nation").select("n_regionkey", "n_name").collect()
    tree = [{"name": f"r{r.r_regionkey}", "children": [{"name": n.n_name} for n in rows if n.n_regionkey == r.r_regionkey]} for r in table(s, d, "region").select("r_regionkey").collect()]
    nodes = H.flatten(json.loads(json.dumps(tree)))
    return s.createDataFrame([(n["path"], n["depth"]) for n in nodes], "path string, depth int")


@query("""
WITH RECURSIVE l AS (SELECT row_number() OVER (ORDER BY n_name) AS k, n_name AS x FROM nation), b AS (SELECT CAST(0 AS BIGINT) AS k, 0 AS used, '' AS x, false AS kept UNION ALL SELECT l.k, CASE WHEN used + length(l.x) + (used > 0)::INT <= 60 THEN used + length(l.x) + (used > 0)::INT ELSE used END, l.x, used + length(l.x) + (used > 0)::INT <= 60 FROM b JOIN l ON l.k = b.k + 1)
SELECT string_agg(x, ' ' ORDER BY k) AS summary FROM b WHERE kept""")
def taxonomy_summary(s, d):
    names = [r.n_name for r in table(s, d, "nation").select("n_name").orderBy("n_name").collect()]
    return s.createDataFrame([(" ".join(A.budgeted(names, 60)),)], "summary string")


@query("""
WITH x AS (SELECT doc_id, doc_id % 12 + 1 AS n FROM documents), r AS (SELECT doc_id, n, list_filter([doc_id % 5 + 1, doc_id % 3 + 4, doc_id % 7], lambda v: v BETWEEN 1 AND n) AS f FROM x), u AS (SELECT doc_id, n, len(list_distinct(f)) AS k FROM r)
SELECT doc_id, CAST(least(n, 8) AS INT) AS n_samples, CAST(k AS INT) AS n_first FROM u""")
def challenge_samples(s, d):
    """Samples with problems, long ones and examples first, then evenly spread others, eight at most."""
    k, n = F.col("doc_id"), (F.col("doc_id") % 12 + 1).cast("int")
    labels = F.array(F.struct((k % 3 + 4).cast("int").alias("no"), F.lit("long_article").alias("structure")))
    first = F.size(F.array_distinct(F.filter(F.array(k % 5 + 1, k % 3 + 4, k % 7), lambda v: v.between(1, n))))
    v = B.challenge_samples(F.array((k % 5 + 1).cast("int")), labels, F.array((k % 7).cast("int")), n)
    return table(s, d, "documents").select("doc_id", F.size(F.array_distinct(v)).alias("n_samples"), first.alias("n_first"))
