"""Positional operators over the driver's tables."""

from pyspark.sql import functions as F

from ..operators import segment as G
from ..operators import windows as X
from .registry import query, seconds, table

LINES = "l AS (SELECT doc_id, CAST(k AS INT) AS line_no, line FROM (SELECT doc_id, unnest(range(1, len(x) + 1)) AS k, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)))"


@query(f"WITH {LINES} SELECT doc_id, line_no, sha256(line) AS h FROM l")
def source_lines(s, d):
    return X.lines(table(s, d, "documents")).select("doc_id", "line_no", F.sha2("line", 256).alias("h"))


@query("SELECT conv_id, turn, role, lag(role) OVER w AS previous, lead(role) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def lag_lead_turns(s, d):
    return X.neighbours(table(s, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", "role")


@query("""
WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events), g AS (SELECT user_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > 3600 THEN 1 ELSE 0 END AS b FROM (SELECT DISTINCT user_id, t FROM e)),
r AS (SELECT user_id, t, sum(b) OVER (PARTITION BY user_id ORDER BY t) AS run FROM g)
SELECT user_id, min(t) AS first, max(t) AS last, count(*) AS n FROM r GROUP BY user_id, run HAVING count(*) >= 3""")
def event_islands(s, d):
    e = table(s, d, "events").select("user_id", seconds(F.col("ts")).alias("t")).distinct()
    return X.islands(e, "user_id", "t", 3600, 3)


@query(f"""
WITH {LINES}, p AS (SELECT doc_id, line_no FROM l WHERE length(line) BETWEEN 1 AND 120), g AS (SELECT doc_id, line_no, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) > 5 THEN 1 ELSE 0 END AS b FROM p),
r AS (SELECT doc_id, line_no, sum(b) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM g)
SELECT doc_id, min(line_no) AS first, max(line_no) AS last, count(*) AS n FROM r GROUP BY doc_id, run HAVING count(*) >= 3""")
def toc_islands(s, d):
    """Runs of three or more short lines at most five apart, as tables of contents are found."""
    x = X.lines(table(s, d, "documents")).where(F.length("line").between(1, 120))
    return X.islands(x, "doc_id", "line_no", 5, 3)


@query("""
WITH i AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) % 50000 + 1 AS e FROM events),
w AS (SELECT user_id, s, e, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM i)
SELECT user_id, CAST(sum(greatest(0, e - greatest(s, coalesce(m, s)))) AS BIGINT) AS active, CAST(sum(e - s) AS BIGINT) AS work, max(e) - min(s) AS span FROM w GROUP BY 1""")
def interval_union(s, d):
    e = table(s, d, "events").select("user_id", seconds(F.col("ts")).alias("s"), F.col("value")).withColumn("e", F.col("s") + F.floor(F.abs("value")) % 50000 + 1)
    return X.active_time(e, "user_id", "s", "e")


@query("""
WITH k AS (SELECT conv_id, turn, CAST(length(text) % 4 AS INT) + 1 AS level FROM conversations)
SELECT conv_id, turn, level, coalesce(level > lag(level) OVER (PARTITION BY conv_id ORDER BY turn) + 1, false) AS jump FROM k""")
def level_jump_warnings(s, d):
    c = table(s, d, "conversations").select("conv_id", "turn", (F.length("text") % 4 + 1).alias("level"))
    return X.level_jumps(c, "conv_id", "turn", "level")


@query("SELECT conv_id, turn, coalesce(turn <> lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) + 1, false) AS break FROM conversations")
def number_discontinuities(s, d):
    return X.number_breaks(table(s, d, "conversations").select("conv_id", "turn"), ["conv_id"], "turn", "turn")


@query("""
WITH h AS (SELECT conv_id, turn, CAST(length(text) % 4 AS INT) + 1 AS level, 't' || turn AS title FROM conversations)
SELECT a.conv_id, a.turn, a.level, coalesce((SELECT string_agg(b.title, '/' ORDER BY b.turn) FROM h b WHERE b.conv_id = a.conv_id AND b.turn < a.turn AND b.level < a.level
  AND NOT EXISTS (SELECT 1 FROM h c WHERE c.conv_id = a.conv_id AND c.turn > b.turn AND c.turn < a.turn AND c.level <= b.level)), '') AS path FROM h a""")
def heading_stack_paths(s, d):
    h = table(s, d, "conversations").select("conv_id", "turn", (F.length("text") % 4 + 1).alias("level"), F.concat(F.lit("t"), F.col("turn")).alias("title"))
    return X.heading_paths(h, "conv_id", "turn", "level", "title", 5).select("conv_id", "turn", "level", F.array_join("parents", "/").alias("path"))


@query("""
SELECT doc_id, CASE WHEN len(p) > 3 THEN length(p[1]) + length(p[2]) + length(p[3]) + 2 * 2 + 1 ELSE 0 END AS place FROM (SELECT doc_id, string_split(text, 'th') AS p FROM documents)""")
def numbered_occurrence(s, d):
    return table(s, d, "documents").select("doc_id", X.nth_place(F.col("text"), F.lit("th"), 3).cast("long").alias("place"))


@query("""
WITH x AS (SELECT doc_id, text, length(text) AS n FROM documents), p AS (SELECT doc_id, text, n, unnest(range(0, 5)) AS i FROM x WHERE n > 300 UNION ALL SELECT doc_id, text, n, 0 FROM x WHERE n <= 300),
s AS (SELECT DISTINCT doc_id, text, CAST(CASE WHEN n <= 300 THEN 0 ELSE round_even(i * (n - 300) / 4.0, 0) END AS BIGINT) AS start FROM p),
m AS (SELECT doc_id, text, start, CASE WHEN strpos(substr(text, start + 1), chr(10)) = 0 THEN 0 ELSE strpos(substr(text, start + 1), chr(10)) + start END AS nl, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS k FROM s)
SELECT doc_id, CAST(k AS INT) AS sample_no, CAST(CASE WHEN start > 0 AND nl > 0 AND nl - start < 300 THEN nl ELSE start END AS INT) AS start,
 sha256(substr(text, CASE WHEN start > 0 AND nl > 0 AND nl - start < 300 THEN nl ELSE start END + 1, 300)) AS h FROM m""")
def distributed_samples(s, d):
    x = X.spread_samples(table(s, d, "documents").select("doc_id", "text"), "doc_id", "text", 300, 5)
    return x.select("doc_id", "sample_no", "start", F.sha2("sample", 256).alias("h"))


@query(f"""
WITH {LINES}, f AS (SELECT doc_id, line_no, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM l WHERE trim(line) <> ''),
q AS (SELECT doc_id, line_no, unnest([0.1, 0.5, 0.9]) AS share, n, k FROM f)
SELECT doc_id, share::DOUBLE AS share, line_no AS line, greatest(line_no - 24, 1) AS first, line_no + 24 AS last FROM q WHERE k = floor((n - 1) * share) + 1""")
def fractile_samples(s, d):
    return X.fractile_windows(X.lines(table(s, d, "documents")), "doc_id", "line_no", "line", [0.1, 0.5, 0.9], 24)


@query(f"""
WITH {LINES}, z AS (SELECT doc_id, line_no, length(line) AS score, max(line_no) OVER (PARTITION BY doc_id) AS n FROM l),
y AS (SELECT *, CAST(least(floor((line_no - 1) * 6.0 / n), 5) AS INT) AS zone FROM z), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, zone ORDER BY score DESC, abs(line_no - (zone + 0.5) * n / 6), line_no) AS r FROM y)
SELECT doc_id, line_no, score, zone FROM r WHERE r = 1""")
def zoned_samples(s, d):
    return X.zone_picks(X.lines(table(s, d, "documents")).select("doc_id", "line_no", F.length("line").cast("long").alias("score")), "doc_id", "line_no", "score", 6)


@query(f"WITH {LINES} SELECT doc_id, min(line_no) FILTER (length(line) > 200) AS body_start, min(line_no) AS first_line FROM l GROUP BY 1")
def first_line_filters(s, d):
    return X.lines(table(s, d, "documents")).groupBy("doc_id").agg(F.min(F.when(F.length("line") > 200, F.col("line_no"))).alias("body_start"), F.min("line_no").alias("first_line"))


@query("""
SELECT event_id, event_type, CASE WHEN count(*) OVER w = 20 THEN sum((value > 60)::INT) OVER w / 20.0::DOUBLE END AS rate FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def circuit_breaker_window(s, d):
    return X.failure_rate(table(s, d, "events"), "event_type", ["ts", "event_id"], F.col("value") > 60, 20).select("event_id", "event_type", "rate")


@query("""
WITH b AS (SELECT event_id, user_id, ts, (value > 20)::INT AS busy FROM events), r AS (SELECT *, sum(busy) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM b),
k AS (SELECT *, sum(1 - busy) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS k FROM r)
SELECT event_id, user_id FROM k WHERE busy = 0 AND k >= 2""")
def idle_gate(s, d):
    return X.quiet_runs(table(s, d, "events").select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], F.col("value") > 20, 2).select("event_id", "user_id")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS n FROM events GROUP BY 1")
def latest_per_key(s, d):
    g = table(s, d, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id")).alias("m"), F.count("*").alias("n"))
    return g.select("user_id", "m.event_id", "m.event_type", "n")


@query("""
WITH t AS (SELECT min(event_type) AS a, max(event_type) AS b FROM events), s AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events)
SELECT x.user_id, CAST(x.n AS INT) AS n, x.t AS start, y.t AS end FROM (SELECT * FROM s, t WHERE event_type = a) x LEFT JOIN (SELECT * FROM s, t WHERE event_type = b) y ON x.user_id = y.user_id AND x.n = y.n""")
def start_finish_pairs(s, d):
    """Two event types taken as starts and finishes, paired first in, first out."""
    e = table(s, d, "events").withColumn("t", seconds(F.col("ts")))
    ends = e.agg(F.min("event_type").alias("a"), F.max("event_type").alias("b")).first()
    return X.paired(e, ["user_id"], ["ts", "event_id"], "event_type", ends.a, ends.b, "t")


@query("""
WITH e AS (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, event_type FROM events)
SELECT user_id, count(*) AS records, max(t) - min(t) AS seconds, CASE WHEN max(t) > min(t) THEN round(count(*) / (max(t) - min(t))::DOUBLE, 9) END AS per_second FROM e GROUP BY 1""")
def throughput_per_run(s, d):
    g = table(s, d, "events").withColumn("t", seconds(F.col("ts"))).groupBy("user_id").agg(F.count("*").alias("records"), (F.max("t") - F.min("t")).alias("seconds"))
    return g.withColumn("per_second", F.when(F.col("seconds") > 0, F.round(F.col("records") / F.col("seconds"), 9)))


#: A Markdown document around each document's own text: head, list, code and table.
MARKED = ["# ", "\n\n", "\n- one\n  more\n- two\n\n\n## Part\n```\n# no heading\n\n- no list\n```\n| a | b |\n|---|---|\n| ", " | 2 |\nlast"]
MARKED_SQL = "(SELECT doc_id, '" + MARKED[0] + "' || source || '" + MARKED[1] + "' || text || '" + MARKED[2] + "' || lang || '" + MARKED[3] + "' AS text FROM documents)"


def marked(s, d):
    return table(s, d, "documents").select("doc_id", F.concat(F.lit(MARKED[0]), "source", F.lit(MARKED[1]), "text", F.lit(MARKED[2]), "lang", F.lit(MARKED[3])).alias("text"))


@query(r"""
WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM """ + MARKED_SQL + r"""), l AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS k, unnest(l) AS line FROM x),
f AS (SELECT *, regexp_matches(line, '^ {0,3}```') AS fence, count(*) FILTER (regexp_matches(line, '^ {0,3}```')) OVER (PARTITION BY doc_id ORDER BY k) AS n FROM l),
c AS (SELECT *, CASE WHEN n % 2 = 1 OR fence THEN 'code' WHEN regexp_matches(line, '^ {0,3}#{1,6}([ \t]|$)') THEN 'heading' WHEN regexp_matches(line, '^\s*\|') THEN 'table' WHEN regexp_matches(line, '^ *([-*+]|\d{1,9}[.)])[ \t]+\S') THEN 'list' WHEN trim(line) = '' THEN 'blank' ELSE 'text' END AS kind0 FROM f),
e AS (SELECT *, CASE WHEN kind0 = 'text' AND line LIKE '  %' AND lag(kind0) OVER w = 'list' THEN 'list' ELSE kind0 END AS kind FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
b AS (SELECT *, CASE WHEN kind IN ('text', 'heading') OR kind <> coalesce(lag(kind) OVER w, '') THEN 1 ELSE 0 END AS new FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
u AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS unit FROM b)
SELECT doc_id, CAST(unit - 1 AS INT) AS unit_no, min(kind) AS kind, CAST(min(k) AS INT) AS start_line, CAST(max(k) AS INT) AS end_line, sha256(string_agg(line, chr(10) ORDER BY k)) AS h FROM u GROUP BY doc_id, unit""")
def markdown_units(s, d):
    """Units of Markdown, with the lines that they hold."""
    u = G.units(marked(s, d))
    return u.select("doc_id", "unit_no", "kind", "start_line", "end_line", F.sha2(F.regexp_replace("text", r"\n\z", ""), 256).alias("h"))


@query(r"""
WITH RECURSIVE x AS (SELECT doc_id, regexp_replace(text, '((?:[^ ]+ ){7}[^ ]+) ', '\1' || chr(10), 'g') || chr(10) AS t FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(v))) AS k, unnest(v[1:len(v) - 1]) AS line FROM (SELECT doc_id, string_split(t, chr(10)) AS v FROM x)),
r AS (SELECT doc_id, k, length(line) + 1 AS n, line FROM l),
g AS (SELECT doc_id, k, n AS used, 0 AS chunk FROM r WHERE k = 1 UNION ALL SELECT r.doc_id, r.k, CASE WHEN used + r.n <= 3000 THEN used + r.n ELSE r.n END, CASE WHEN used + r.n <= 3000 THEN chunk ELSE chunk + 1 END FROM g JOIN r ON r.doc_id = g.doc_id AND r.k = g.k + 1)
SELECT doc_id, CAST(chunk AS INT) AS chunk_no, CAST(sum(r.n) AS INT) AS n, sha256(string_agg(line || chr(10), '' ORDER BY k)) AS h FROM g JOIN r USING (doc_id, k) GROUP BY doc_id, chunk""")
def chunk_pack(s, d):
    """Chunks of at most 3,000 characters of texts cut to lines of eight words: whole lines, as many as fit."""
    x = table(s, d, "documents").select("doc_id", F.concat(F.regexp_replace("text", "((?:[^ ]+ ){7}[^ ]+) ", "$1\n"), F.lit("\n")).alias("text"))
    return G.chunks(x, budget=3000).select("doc_id", "chunk_no", F.length("text").alias("n"), F.sha2("text", 256).alias("h"))


#: Lines of every kind of heading, and lines that look like one, around each document's own text.
HEADED = ["# ", "\n## 1.2 of ", "\n第三章 总论\n第2节 ", "\n1.2.3 Results of ", "\n4) Also\n1. Ends with a stop.\n2 lower\n（一）小题\n(3) item\n#no heading\n", "\n第十篇"]
HEADED_SQL = "SELECT doc_id, '" + HEADED[0] + "' || source || '" + HEADED[1] + "' || lang || '" + HEADED[2] + "' || lang || '" + HEADED[3] + "' || source || '" + HEADED[4] + "' || text || '" + HEADED[5] + "' AS text FROM documents"


def headed(s, d):
    parts = [F.lit(HEADED[0]), "source", F.lit(HEADED[1]), "lang", F.lit(HEADED[2]), "lang", F.lit(HEADED[3]), "source", F.lit(HEADED[4]), "text", F.lit(HEADED[5])]
    return table(s, d, "documents").select("doc_id", F.concat(*parts).alias("text"))


HEADING_SQL = r"""x AS (SELECT doc_id, string_split(text, chr(10)) AS v FROM (""" + HEADED_SQL + r""")), l AS (SELECT doc_id, unnest(range(1, len(v) + 1)) AS line_no, unnest(v) AS t FROM x),
m AS (SELECT *, CASE WHEN regexp_matches(t, '^#{1,6} +\S') THEN 'markdown' WHEN regexp_matches(t, '^\s*第\s*[一二三四五六七八九十百零〇0-9]+\s*(?:章|节|篇|部分)') THEN 'chinese' WHEN regexp_matches(t, '^ *[0-9]+(?:\.[0-9]+)*[.)]? +[A-Z㐀-鿿]') AND length(t) <= 120 AND NOT regexp_matches(t, '[.;:] *$') THEN 'numbered'
 WHEN regexp_matches(t, '^\s*[（(][一二三四五六七八九十0-9]+[）)]\s*\S') AND length(t) <= 60 THEN 'parenthesis' END AS method FROM l),
h AS (SELECT *, CASE method WHEN 'markdown' THEN length(regexp_extract(t, '^(#+)', 1)) WHEN 'chinese' THEN CASE WHEN regexp_matches(t, '章|篇|部分') THEN 1 ELSE 2 END WHEN 'numbered' THEN len(string_split(regexp_extract(t, '^ *([0-9]+(?:\.[0-9]+)*)', 1), '.')) ELSE 3 END AS level, trim(regexp_replace(t, '^\s*(?:#{1,6}|[0-9]+(?:\.[0-9]+)*[.)]?)\s*', '')) AS title FROM m WHERE method IS NOT NULL)"""


@query("WITH " + HEADING_SQL + " SELECT doc_id, CAST(line_no AS INT) AS line_no, method, CAST(level AS INT) AS level, title FROM h")
def heading_extract(s, d):
    return G.headings(X.lines(headed(s, d))).select("doc_id", "line_no", "method", "level", "title")


@query("WITH " + HEADING_SQL + r""", q AS (SELECT doc_id, line_no, lower(['', 'Contents', title || ' ....... 12', 'Figure 3 ' || title, title || '?', repeat(title || ' ', 12)][line_no % 6 + 1]) AS u FROM h),
w AS (SELECT doc_id, line_no, CASE WHEN u = 'contents' THEN 'contents_or_index' WHEN regexp_matches(u, '\.{4,}\s*[0-9]+$') THEN 'page_leader' WHEN regexp_matches(u, '^(?:figure|table|fig\.)\s*[0-9]') THEN 'caption' WHEN trim(u) = '' THEN 'empty' WHEN regexp_matches(u, '\?$') THEN 'question' WHEN length(trim(u)) > 100 THEN 'long' END AS why FROM q)
SELECT doc_id, CAST(line_no AS INT) AS line_no, why, CASE WHEN why IN ('question', 'long') THEN 'review' WHEN why IS NOT NULL THEN 'exclude' ELSE 'keep' END AS decision FROM w""")
def heading_filter(s, d):
    """Titles turned into what the filter is for: contents, leaders, captions, questions, very long ones."""
    t, k = F.col("title"), F.col("line_no") % 6
    new = F.when(k == 0, "").when(k == 1, "Contents").when(k == 2, F.concat(t, F.lit(" ....... 12"))).when(k == 3, F.concat(F.lit("Figure 3 "), t)).when(k == 4, F.concat(t, F.lit("?"))).otherwise(F.repeat(F.concat(t, F.lit(" ")), 12))
    return G.heading_filter(G.headings(X.lines(headed(s, d))).withColumn("title", new)).select("doc_id", "line_no", "why", "decision")


@query(r"""
WITH x AS (SELECT doc_id, string_split('1. ' || source || chr(10) || '  - ' || lang || chr(10) || '2) Step one' || chr(10) || '-no item' || chr(10) || '    * deep ' || source || chr(10) || '3.no' || chr(10) || text, chr(10)) AS v FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(v) + 1)) AS line_no, unnest(v) AS t FROM x)
SELECT doc_id, CAST(line_no AS INT) AS line_no, CASE WHEN regexp_matches(t, '(?i)^ *[0-9]+[.)] +step\b') THEN 'step' WHEN regexp_matches(t, '^ *[0-9]') THEN 'numbered' ELSE 'bullet' END AS kind, CAST(length(regexp_extract(t, '^( *)', 1)) // 2 AS INT) AS depth, regexp_extract(t, '^ *(?:[0-9]+[.)]|[-*]) +(.*)$', 1) AS item FROM l WHERE regexp_matches(t, '^ *(?:[0-9]+[.)]|[-*]) +[^ ]')""")
def list_items_extract(s, d):
    x = F.concat(F.lit("1. "), "source", F.lit("\n  - "), "lang", F.lit("\n2) Step one\n-no item\n    * deep "), "source", F.lit("\n3.no\n"), "text")
    return G.list_items(X.lines(table(s, d, "documents").select("doc_id", x.alias("text")))).select("doc_id", "line_no", "kind", "depth", "item")


#: The classes of ``prose_units`` in SQL: white space, word characters, marks that pair.
WS, WORD = r"[\s\x0b\x1c-\x1f\x85\p{Z}]", r"\p{L}\p{N}_"
OPEN, CLOSE = "([{（【\"''“‘「『《", ")]}）】\"''”’」』》"
MARKS = r"(){}\[\]（）【】\"''“”‘’「」『』《》"
ENDS = r")}\]）】\"''”’」』》"
APOSTROPHE_SQL = r"regexp_replace(regexp_replace(regexp_replace(substr(t, p + 2), '\\[''‘’]', '~', 'g'), '([\p{L}\p{N}])[''‘’]([\p{L}\p{N}])', '\1~\2', 'g'), '([\p{L}\p{N}])[''‘’]([\p{L}\p{N}])', '\1~\2', 'g')"


def _paired_sql(n, src):
    """CTEs s{n}(id, i, p, st, b0, q): state after each paired mark of the texts of ``src(id, t)``, the first before any."""
    return rf"""d{n} AS (SELECT id, t, regexp_extract_all(t, '(?s)[{MARKS}][^{MARKS}]*|[^{MARKS}]+') AS l FROM {src} WHERE regexp_matches(t, '[{MARKS}]')),
u{n} AS (SELECT id, unnest(l) AS tok, generate_subscripts(l, 1) AS k FROM d{n}),
v{n} AS (SELECT id, left(tok, 1) AS c, CAST(sum(length(tok)) OVER o - length(tok) AS BIGINT) AS p, coalesce(lag(right(tok, 1)) OVER o, '') AS bef, CASE WHEN length(tok) > 1 THEN substr(tok, 2, 1) ELSE coalesce(lead(left(tok, 1)) OVER o, '') END AS aft, coalesce(lag(length(regexp_extract(tok, '\\*$'))) OVER o, 0) % 2 = 1 AS esc FROM u{n} WINDOW o AS (PARTITION BY id ORDER BY k)),
e{n} AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY p) AS i, p, c, esc, regexp_matches(bef, '[\p{{L}}\p{{N}}]') AS wb, c IN ('''', '‘', '’') AND regexp_matches(bef, '[\p{{L}}\p{{N}}]') AND regexp_matches(aft, '[\p{{L}}\p{{N}}]') AS inner0, coalesce(poss, false) AS poss FROM v{n}
 LEFT JOIN (SELECT id, p, regexp_matches(substr(t, p + 2), '^{WS}+[\p{{Ll}}ªº]') AND regexp_matches({APOSTROPHE_SQL}, '^[^''‘’]*[.!?。！？]' || c) AS poss FROM v{n} JOIN d{n} USING (id) WHERE c IN ('''', '’') AND lower(bef) = 's' AND regexp_matches(aft, '{WS}')) USING (id, p) WHERE regexp_matches(c, '[{MARKS}]')),
s{n} AS (SELECT id, CAST(0 AS BIGINT) AS i, CAST(-1 AS BIGINT) AS p, '' AS st, CAST(NULL AS BIGINT) AS b0, false AS q FROM d{n}
 UNION ALL SELECT id, i, p, CASE WHEN pop THEN left(st, length(st) - 1) WHEN push THEN st || c ELSE st END, CASE WHEN pop AND NOT regexp_matches(left(st, length(st) - 1), '[(（\[【{{]') THEN NULL WHEN push AND b0 IS NULL AND regexp_matches(c, '[(（\[【{{]') THEN p ELSE b0 END, pop AND NOT regexp_matches(right(st, 1), '[(（\[【{{]')
 FROM (SELECT *, act AND c = top AS pop, act AND c <> top AND contains('{OPEN}', c) AND NOT (c IN ('''', '‘') AND wb) AS push FROM (SELECT id, e.i, e.p, c, wb, st, b0, translate(right(st, 1), '{OPEN}', '{CLOSE}') AS top, NOT esc AND NOT inner0 AND NOT (poss AND c = translate(right(st, 1), '{OPEN}', '{CLOSE}')) AS act FROM s{n} s JOIN e{n} e USING (id) WHERE e.i = s.i + 1)))"""


#: Sentences and notes of sources as ``prose_units`` has them: notes first, then the prose between them.
PROSE_SQL = rf"""w AS (SELECT row_number() OVER () AS id, doc_id, text AS t FROM documents),
na AS (SELECT id, t, regexp_extract_all(t, '(?s)\([^()（）\r\n]*\)|（[^()（）\r\n]*）|[^(（]+|.') AS l FROM w WHERE regexp_matches(t, '[(（]')),
nb AS (SELECT id, unnest(l) AS tok, generate_subscripts(l, 1) AS k FROM na),
nc AS (SELECT id, tok, CAST(sum(length(tok)) OVER (PARTITION BY id ORDER BY k) - length(tok) AS BIGINT) AS a, regexp_replace(substr(tok, 2, greatest(length(tok) - 2, 0)), '^{WS}+|{WS}+$', '', 'g') AS body FROM nb),
nd AS (SELECT id, t, a, a + length(tok) AS b FROM nc JOIN w USING (id) WHERE regexp_matches(tok, '^[(（].*[)）]$') AND (regexp_full_match(body, '(?i)pp?\.{WS}*\p{{Nd}}+(?:{WS}*[-–—]{WS}*\p{{Nd}}+)?\.?') OR regexp_full_match(body, '[㐀-鿿]{{2,16}}(?:网|报|通讯社|杂志){WS}*[,，:：]?{WS}*(?:\p{{Nd}}{{4}}年\p{{Nd}}{{1,2}}月\p{{Nd}}{{1,2}}日|\p{{Nd}}{{4}}[-/.]\p{{Nd}}{{1,2}}[-/.]\p{{Nd}}{{1,2}})')
 OR (regexp_full_match(body, '[㐀-鿿]{{2,4}}{WS}*[:：]?{WS}*《[^《》\r\n]+》') AND NOT regexp_matches(body, '^(?:参见|详见|例如|比如|阅读|关于|包括|研究|使用|所谓|即|见|如)')))),
ne AS (SELECT DISTINCT id, t FROM nd),
{_paired_sql(1, "ne")},
nf AS (SELECT nd.id, nd.t, nd.a, nd.b FROM nd ASOF JOIN s1 ON nd.id = s1.id AND nd.a > s1.p WHERE s1.st = ''),
ng AS (SELECT *, regexp_full_match(regexp_extract(left(t, a), '[^\n]*$') || regexp_extract(substr(t, b + 1), '^[^\n]*'), '{WS}*') OR regexp_matches(left(t, a), '[.!?。！？][{ENDS}]*{WS}*$') AS base, lag(b) OVER o IS NOT NULL AND regexp_full_match(substr(t, lag(b) OVER o + 1, a - lag(b) OVER o), '{WS}*') AS adj FROM nf WINDOW o AS (PARTITION BY id ORDER BY a)),
nh AS (SELECT *, sum(CASE WHEN adj THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY a) AS run FROM ng),
ni AS (SELECT id, t, a, b FROM (SELECT *, bool_or(base) OVER (PARTITION BY id, run ORDER BY a) AS ok FROM nh) WHERE ok),
pa AS (SELECT id, t, coalesce(lag(b) OVER (PARTITION BY id ORDER BY a), 0) AS a, a AS b FROM ni UNION ALL SELECT id, t, max(b), length(t) FROM ni GROUP BY 1, 2 UNION ALL SELECT id, t, 0, length(t) FROM w WHERE id NOT IN (SELECT id FROM ni)),
pb AS (SELECT row_number() OVER () AS id, id AS doc, substr(t, a + 1, b - a) AS t FROM pa WHERE t IS NOT NULL),
{_paired_sql(2, "pb")},
ta AS (SELECT id, regexp_extract_all(t, '(?s)[^.!?。！？]+|[。！？]+[{ENDS}]*|[.!?]+[{ENDS}]*') AS l FROM pb),
tb AS (SELECT id, unnest(l) AS tok, generate_subscripts(l, 1) AS k FROM ta),
tc AS (SELECT id, k, length(tok) AS len, right(tok, 8) AS r, left(regexp_replace(tok, '^{WS}+', ''), 4) AS h, regexp_matches(tok, '^{WS}') AS ws, CASE WHEN regexp_matches(tok, '^[.!?。！？]') THEN tok END AS tok FROM tb),
td AS (SELECT id, k, tok, CAST(sum(len) OVER o AS BIGINT) AS e, regexp_replace(tok, '[{ENDS}]+$', '') AS marks, concat({", ".join(f"lag(r, {k}) OVER o" for k in range(7, 0, -1))}) AS prev, (CASE WHEN lag(h) OVER o = '' THEN lag(r, 2) OVER o ELSE lag(r) OVER o END) LIKE '%.' AS dotted, coalesce(lead(ws) OVER o, true) AS ends, coalesce(CASE WHEN lead(h) OVER o = '' THEN lead(h, 2) OVER o ELSE lead(h) OVER o END, '') AS nxt FROM tc WINDOW o AS (PARTITION BY id ORDER BY k)),
te AS (SELECT id, k, e, e - length(tok) AS a, nxt FROM (SELECT *, lower(regexp_extract(prev, '[A-Za-z.]*$')) AS word FROM td WHERE tok IS NOT NULL AND (regexp_matches(tok, '^[。！？]') OR ends)) WHERE NOT (marks LIKE '%.' AND (length(marks) > 1 OR coalesce(dotted, false) OR nxt LIKE '.%' OR word IN ('dr', 'mr', 'mrs', 'ms', 'prof', 'st', 'vs', 'e.g', 'i.e', 'etc', 'fig', 'vol', 'no', 'pp', 'ed', 'eds', 'bst', 'skt', 'lit') OR (word IN ('sk', 'bsm') AND regexp_matches(nxt, '^[a-z]')) OR regexp_matches(prev, '(?:^|[^{WORD}])(?:[A-Za-z]\.[A-Za-z]|[A-Z])$')))),
tf AS (SELECT te.*, s2.st FROM te ASOF LEFT JOIN s2 ON te.id = s2.id AND te.e > s2.p),
tg AS (SELECT tf.* EXCLUDE (st), s2.b0 FROM tf ASOF LEFT JOIN s2 ON tf.id = s2.id AND tf.a > s2.p WHERE coalesce(tf.st, '') = ''),
th AS (SELECT DISTINCT tg.id, tg.k FROM tg JOIN s2 ON tg.id = s2.id AND s2.q AND s2.p >= tg.a AND s2.p < tg.e),
ti AS (SELECT tg.id, tg.e, CASE WHEN b0 IS NOT NULL THEN length(regexp_replace(left(t, b0), '{WS}+$', '')) END AS need FROM tg JOIN pb ON tg.id = pb.id LEFT JOIN th ON tg.id = th.id AND tg.k = th.k WHERE NOT ((b0 IS NOT NULL OR th.k IS NOT NULL) AND regexp_matches(nxt, '^(?:[\p{{Ll}}ªº]|(?i:or|and)(?:$|[^{WORD}]))'))),
tj AS (SELECT id, e FROM ti WHERE need IS NULL OR need = 0 UNION ALL SELECT ti.id, ti.e FROM ti JOIN tj ON ti.id = tj.id AND ti.need = tj.e WHERE ti.need > 0),
tk AS (SELECT id, count(*) AS n, max(e) AS e FROM tj GROUP BY 1),
pc AS (SELECT doc, sum(coalesce(n, 0) + CASE WHEN regexp_full_match(substr(t, coalesce(tk.e, 0) + 1), '{WS}*') THEN 0 ELSE 1 END) AS n FROM pb LEFT JOIN tk USING (id) GROUP BY 1),
nn AS (SELECT id, count(*) AS n FROM ni GROUP BY 1)"""


@query("WITH RECURSIVE " + PROSE_SQL + " SELECT doc_id, CAST(CASE WHEN t IS NOT NULL THEN coalesce(pc.n, 0) + coalesce(nn.n, 0) END AS BIGINT) AS n FROM w LEFT JOIN pc ON w.id = pc.doc LEFT JOIN nn ON w.id = nn.id")
def sentence_units(s, d):
    """One row a document, also where it has no sentence (0) or no text (null)."""
    return table(s, d, "documents").select("doc_id", G.sentence_count(F.col("text")).alias("n"))


@query(f"""
WITH {LINES}, m AS (SELECT doc_id, line_no, line, max(line_no) OVER (PARTITION BY doc_id) AS n FROM l)
SELECT doc_id, CAST(least(floor((line_no - 1) * 12.0 / n), 11) AS INT) AS region, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars, count(*) FILTER (regexp_matches(line, '[0-9]')) AS n_digits FROM m GROUP BY 1, 2""")
def structure_metrics(s, d):
    return G.region_metrics(X.lines(table(s, d, "documents")), 12)


@query("""
WITH x AS (SELECT doc_id, text, length(text) AS n FROM documents), p AS (SELECT DISTINCT doc_id, text, CAST(floor(i * (n - 1000) / 6) AS BIGINT) AS st FROM (SELECT *, unnest(range(0, 7)) AS i FROM x WHERE n > 7000))
SELECT doc_id, CAST(count(DISTINCT substr(text, st + 1, 1000)) AS BIGINT) AS n_samples FROM p GROUP BY 1 UNION ALL SELECT doc_id, 1 FROM x WHERE n <= 7000""")
def language_samples(s, d):
    x = table(s, d, "documents").select("doc_id", G.language_samples(F.col("text")).alias("samples"))
    return x.select("doc_id", F.size("samples").cast("long").alias("n_samples"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS n_links, length(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>[^<]*</(script|style)>', '', 'g'), '<[^>]*>', '', 'g')) AS n_text FROM pages")
def html_format_cleanup(s, d):
    return table(s, d, "pages").select("page_id", F.regexp_count("html", F.lit("<a href=")).cast("long").alias("n_links"), F.length(G.plain_html(F.col("html"))).cast("long").alias("n_text"))


@query(r"""
WITH x AS (SELECT doc_id, source, ['# ' || source || ' title' || chr(10), 'https://' || source || chr(10) || '- ' || lang || ' name' || chr(10), 'x' || chr(10) || chr(10), '', repeat('.' || chr(10), 90)][doc_id % 5 + 1] || text AS t FROM documents),
l AS (SELECT doc_id, source, list_transform(string_split(t, chr(10))[1:80], lambda v: trim(regexp_replace(v, '^\s*(?:#{1,6}|[-*])\s*', ''))) AS v FROM x)
SELECT doc_id, coalesce(list_filter(v, lambda e: length(e) BETWEEN 2 AND 100 AND NOT regexp_matches(e, '(?i)^(?:https?:|www\.)'))[1], source) AS title FROM l""")
def title_guess(s, d):
    k = F.col("doc_id") % 5
    head = F.when(k == 0, F.concat(F.lit("# "), "source", F.lit(" title\n"))).when(k == 1, F.concat(F.lit("https://"), "source", F.lit("\n- "), "lang", F.lit(" name\n"))).when(k == 2, "x\n\n").when(k == 3, "").otherwise(".\n" * 90)
    return table(s, d, "documents").select("doc_id", G.title_guess(F.concat(head, "text"), F.col("source")).alias("title"))


@query(r"""
WITH x AS (SELECT doc_id, '![a](b.png)' || text || chr(10) || ' Next ' || chr(10) || 'Figure 12. ' || source || chr(10) || '$$x' || chr(10) || 'y$$ hy-' || chr(10) || 'phen' || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || lang AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(regexp_replace(t, '!\[[^\]]*\]\([^)]*\)', '', 'g'), '(?s)\$\$.*?\$\$', '', 'g') AS t FROM x),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?im)^[ \t]*(?:next|previous|back to top|home)[ \t]*$', '', 'g'), '(?im)^[ \t]*(?:figure|fig\.|table)[ \t]*[0-9]+[.:].*$', '', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '([a-z])-\n([a-z])', '\1\2', 'g') AS t FROM b)
SELECT doc_id, sha256(regexp_replace(t, '\n{4,}', chr(10) || chr(10) || chr(10), 'g')) AS h FROM c""")
def format_cleanup(s, d):
    x = F.concat(F.lit("![a](b.png)"), "text", F.lit("\n Next \nFigure 12. "), "source", F.lit("\n$$x\ny$$ hy-\nphen\n\n\n\n\n"), "lang")
    return table(s, d, "documents").select("doc_id", F.sha2(G.format_cleanup(x), 256).alias("h"))
