"""Layout of whole books: excluded zones, roles of heads, captions, navigation regions, evidence windows, candidates.

Units are rows (doc_id, unit_no, kind, text) in order; state that runs through a book is the last unit that set it and what
has come since, so each operator is a few windows over one book, and no book is held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

IMAGE_ONLY = r"(?s)\A\s*!\[[^\]]*\]\([^\n]+\)\s*\z"
#: What opens a zone, and a caption's words.
APPENDIX, ABBREVIATIONS, CONTENTS = r"(?i)\A(?:附录|appendix\b)", r"(?i)缩略|abbreviat|acronym", r"(?i)\A(?:(?:table of )?contents|index|目录|索引)\z"
CAPTION_WORDS = r"(?i)(?:figure|fig\.?|table|plate|image|photo|map)\b|(?:像|图|表|照片|插图|照|封面|曲线|形制|肖像|示意图|流程图|结构图|分布图)\s*\z"
SENTENCE_MARK = r"[.!?。！？；;：:]"
#: Names of navigation regions, and a page number at the end of a line.
REGIONS = {"contents": "toc", "table of contents": "toc", "目录": "toc", "目次": "toc", "index": "index", "subject index": "index", "索引": "index", "glossary": "glossary", "术语表": "glossary", "词汇表": "glossary"}
PAGES = r"(?:\d+|[ivxlcdm]+)(?:\s*[-–—,，、]\s*(?:\d+|[ivxlcdm]+))*"
PAGE_SUFFIX = rf"(?i)(?:\s*[.．·…]{{2,}}\s*|\s+)(?:[（(]{PAGES}[)）]|{PAGES})\s*\z"


def _order() -> W:
    return W.partitionBy("doc_id").orderBy("unit_no")


def folded(c: Column) -> Column:
    """Letters, digits and CJK only, small."""
    return F.regexp_replace(T.casefold(c), r"(?U)[^\w]+", "")


def _since(units: DataFrame, opens: Column, state: Column) -> DataFrame:
    """Adds ``_at``, the number of the last unit at or before each that opens a state, and ``_state``, what it set."""
    d = units.withColumn("_set", F.when(opens, F.struct(F.col("unit_no").alias("at"), state.alias("state"))))
    d = d.withColumn("_last", F.last("_set", ignorenulls=True).over(_order()))
    return d.withColumn("_at", F.col("_last.at")).withColumn("_state", F.col("_last.state")).drop("_set", "_last")


def annotated(units: DataFrame) -> DataFrame:
    """Adds ``zone``, ``head_role`` and ``caption_for`` (the folded head that a caption repeats).

    A zone (abbreviations' appendix, contents or index) begins at its heading and ends before the next one of no lower
    level. Where a fifth of a hundred or more headings, and 45 %, are capitals, those are the main style, and all others
    behind one are secondary. A line behind an image or a table that repeats an earlier head is a caption.
    """
    text = F.col("text")
    head = F.trim(F.regexp_replace(text, r"^\s*#+\s*", ""))
    marks = F.length(F.regexp_extract(text, r"^\s*(#{1,6})\s", 1))
    level = F.when(F.col("kind") == "heading", F.when(marks > 0, marks).when(text.rlike(r"\n=+"), 1).otherwise(2))
    d = units.withColumn("_head", head).withColumn("_level", level).withColumn("_h", F.col("kind") == "heading")
    appendix, contents = F.col("_h") & F.col("_head").rlike(APPENDIX), F.col("_h") & F.col("_head").rlike(CONTENTS)
    zone = F.when(appendix, F.when(F.col("_head").rlike(ABBREVIATIONS), "abbreviation_appendix")).otherwise("contents_or_index")
    d = d.withColumn("_opens", appendix | contents)
    d = _since(d, F.col("_opens"), F.struct(zone.alias("zone"), F.col("_level").alias("level")))
    closing = F.min(F.when(F.col("_h") & ~F.col("_opens"), F.col("_level"))).over(W.partitionBy("doc_id", "_at").orderBy("unit_no"))
    d = d.withColumn("_close", closing)
    d = d.withColumn("zone", F.when(F.col("_at").isNotNull() & F.coalesce(F.col("_close") > F.col("_state.level"), F.lit(True)), F.col("_state.zone")))
    latin = F.regexp_replace("_head", "[^A-Za-z]", "")
    strong = F.col("_h") & (F.length(latin) >= 3) & (latin == F.upper(latin)) & ~F.col("_head").rlike("[㐀-鿿]")
    book = W.partitionBy("doc_id")
    d = d.withColumn("_strong", strong).withColumn("_n", F.count_if(strong).over(book)).withColumn("_all", F.count_if(F.col("_h")).over(book))
    style = (F.col("_n") >= 20) & (F.col("_n") >= 0.45 * F.col("_all"))
    role = F.when(style & F.col("_strong"), "main_style").when(style & F.col("_h") & (F.count_if(F.col("_strong")).over(_order()) > 0), "secondary_style")
    before = F.last(F.when(F.trim("text") != "", F.struct("kind", "text")), ignorenulls=True).over(_order().rowsBetween(W.unboundedPreceding, -1))
    d = d.withColumn("_role", role).withColumn("_before", before)
    object_ = F.col("_before.text").rlike(IMAGE_ONLY) | (F.col("_before.kind") == "table") | F.startswith(F.ltrim("_before.text"), F.lit("<table"))
    base = folded(F.split("_head", r"(?i)[—–-]\s*(?:Fig\.?|Figure)\s*\d+", 2)[0])
    d = d.withColumn("_object", F.coalesce(object_, F.lit(False))).withColumn("_base", base).withColumn("_key", folded(F.col("_head")))
    seen = d.where(F.col("_h") & ~(F.col("_object") & (F.col("_base") != F.col("_key")))).groupBy(F.col("doc_id").alias("_d"), F.col("_key").alias("_k")).agg(F.min("unit_no").alias("_first"))
    d = d.join(seen, (F.col("doc_id") == F.col("_d")) & (F.col("_base") == F.col("_k")), "left")
    caption = F.col("_object") & F.coalesce(F.col("_first") < F.col("unit_no"), F.lit(False))
    return d.select(*units.columns, "zone", F.when(caption, "caption").otherwise(F.col("_role")).alias("head_role"), F.when(caption, F.col("_base")).alias("caption_for"))


def attached_captions(lines: DataFrame) -> DataFrame:
    """(doc_id, line_no, last_line) of images (a line of their own end) with one or two short caption lines behind them;
    lines: doc_id, line_no, line."""
    full = lines.where(F.trim("line") != "")
    w = W.partitionBy("doc_id").orderBy("line_no")
    at = lambda k: F.lead(F.struct(F.col("line_no").alias("no"), F.trim("line").alias("t")), k).over(w)
    d = full.withColumn("_a", at(1)).withColumn("_b", at(2)).where(F.col("line").rlike(r"!\[[^\]]*\]\([^\n]+\)[ \t]*\z"))
    short = lambda c: F.coalesce((F.length(c) <= 160) & ~c.rlike(SENTENCE_MARK) & c.rlike(CAPTION_WORDS), F.lit(False))
    one, two = short(F.col("_a.t")), short(F.col("_b.t"))
    both = two & (F.length("_a.t") <= 80) & ~F.col("_a.t").rlike(SENTENCE_MARK)
    return d.where(one | two).select("doc_id", "line_no", F.when(both, F.col("_b.no")).otherwise(F.col("_a.no")).alias("last_line"))


def font_breaks(lines: DataFrame) -> DataFrame:
    """Lines (doc_id, line_no, line, size_ratio) whose type changes while the sentence before is unfinished."""
    w = W.partitionBy("doc_id").orderBy("line_no")
    d = lines.where(F.trim("line") != "").withColumn("_p", F.lag(F.struct("line", "size_ratio")).over(w))
    return d.where(~F.col("_p.line").rlike(r"[.!?。！？;；:：]\s*\z") & (F.abs(F.col("size_ratio") - F.col("_p.size_ratio")) >= 0.15)).drop("_p")


def navigation_regions(units: DataFrame) -> DataFrame:
    """Adds ``region`` (toc, index, glossary): from a heading of that name on, over entries, single index letters and headings
    with a page number, until a heading or a sentence of the book's own text. Indented code in a region is passed over."""
    d = units.where(F.trim("text") != "")
    h, text = F.col("kind") == "heading", F.col("text")
    label = F.trim(F.regexp_replace(text, r"^\s*#+\s*", ""))
    name = F.regexp_replace(F.lower(F.trim(F.regexp_replace(label, r"^[#*：:—–\-\s]+|[#*：:—–\-\s]+$", ""))), r"^(?:\d+|[ivxlcdm]+)\s+(?=index$|contents$)", "")
    origin = F.when(h, F.element_at(F.create_map(*[F.lit(x) for kv in REGIONS.items() for x in kv]), name))
    rows = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    indented = (F.col("kind") == "code") & ~F.exists(F.split(text, "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(r"^(?: {4}|\t)"))
    paged = label.rlike(PAGE_SUFFIX)
    block = F.col("kind").isin("code", "table", "math")
    prose_toc = F.exists(rows, lambda x: (F.length(x) > 180) | x.rlike(r"[。！？;；]|!\[") | (~x.rlike(PAGE_SUFFIX) & x.rlike(r"[.!?](?:\s|\z)")))
    prose_index = F.exists(rows, lambda x: ~x.rlike(PAGE_SUFFIX) & ~x.rlike(r"(?i)[.,]\s+See(?: also)?\s+\S") & ((F.length(x) > 180) | x.rlike(r"[。！？;；]|!\[|[.!?](?:\s|\z)")))
    d = d.withColumn("_origin", origin).withColumn("_paged", paged | F.exists(rows, lambda x: x.rlike(PAGE_SUFFIX))).withColumn("_skip", indented & ~h)
    d = _since(d, F.col("_origin").isNotNull(), F.col("_origin"))
    part = W.partitionBy("doc_id", "_at").orderBy("unit_no")
    started = F.coalesce(F.max((F.col("_paged") & F.col("_origin").isNull()).cast("int")).over(part.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) == 1
    d = d.withColumn("_started", started)
    single = label.rlike(r"\A[A-Za-z]\z")
    shut = F.when(F.col("_origin").isNotNull(), False).when(h, F.when(F.col("_state") == "index", ~single & ~paged).when(F.col("_state") == "toc", ~paged).otherwise(True)).when(F.col("_skip") & F.col("_state").isin("toc", "index"), False).when(F.col("_state") == "toc", block | prose_toc).when(F.col("_state") == "index", block | (F.col("_started") & prose_index)).otherwise(False)
    d = d.withColumn("_shut", F.max(shut.cast("int")).over(part))
    skipped = F.col("_skip") & F.col("_state").isin("toc", "index")
    return d.select(*units.columns, F.when((F.col("_shut") == 0) & ~skipped, F.col("_state")).alias("region"))


def table_window(text: Column, position: Column, most: int = 400) -> Column:
    """array<struct<start,end>>: a small table whole, of a large Markdown table its head and the row at a position (0-based),
    nothing where the head or the row is too long or there is none."""
    lines = F.split(text, "\n")
    rule = F.trim(F.regexp_replace(F.trim(F.coalesce(F.get(lines, F.lit(1)), F.lit(""))), r"^\||\|$", ""))
    span = lambda a, b: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"))
    first = F.length(F.get(lines, F.lit(0))) + F.length(F.get(lines, F.lit(1))) + 2
    before = F.substr(text, F.lit(1), position)
    start = F.length(before) - F.length(F.regexp_extract(before, r"([^\n]*)\z", 1))
    tail = F.substr(text, position + 1, F.length(text))
    end = F.when(F.contains(tail, F.lit("\n")), position + F.position(F.lit("\n"), tail)).otherwise(F.length(text))
    ok = (F.size(lines) >= 2) & F.contains(F.get(lines, F.lit(0)), F.lit("|")) & rule.rlike(r"\A\s*:?-+:?\s*(?:\|\s*:?-+:?\s*)*\z") & (first <= most) & (end - start <= most)
    return F.when(F.length(text) <= most, F.array(span(F.lit(0), F.length(text)))).when(ok, F.array(span(F.lit(0), first), span(start, end))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def whole_sentences(text: Column, budget: Column) -> Column:
    """The longest beginning within a budget of characters that ends with a sentence, else with a word; 0 for none."""
    head = F.substr(text, F.lit(1), F.greatest(budget, F.lit(0)))
    sentence = F.length(F.regexp_extract(head, r"(?s)\A(.*(?:[。！？；]|[.!?;](?=\s|\z)))", 1))
    word = F.length(F.regexp_extract(head, r"(?s)\A(.*?)\s+\S*\z", 1))
    return F.when(F.length(text) <= budget, F.length(text)).when(budget <= 0, 0).when(sentence > 0, sentence).otherwise(word)


def heading_bodies(units: DataFrame, budget: int) -> DataFrame:
    """What stands behind each heading up to the next one, within a budget of characters: (doc_id, heading_no, unit_no, start,
    end, cut). Units that fit are taken whole; the first that doesn't is cut at a sentence, and nothing follows it."""
    d = _since(units.where(F.trim("text") != ""), F.col("kind") == "heading", F.col("unit_no"))
    d = d.where("_at is not null and kind <> 'heading'").withColumn("_n", F.length("text"))
    used = F.coalesce(F.sum("_n").over(W.partitionBy("doc_id", "_at").orderBy("unit_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    d = d.withColumn("_left", F.lit(budget) - used).where("_left > 0").withColumn("_end", whole_sentences(F.col("text"), F.col("_left")).cast("int"))
    return d.where("_end > 0").select("doc_id", F.col("_at").alias("heading_no"), "unit_no", F.lit(0).alias("start"), F.col("_end").alias("end"), (F.col("_end") < F.col("_n")).alias("cut"))


def enriched(entries: DataFrame, docs: DataFrame, most: int = 24) -> DataFrame:
    """entries(doc_id, entry_no, start, end) with ``history``: the last ``most`` headings of the 30,000 characters before the
    entry's head, and ``window``: its text from 2,000 characters before to 1,400 behind."""
    j = entries.join(docs.select("doc_id", F.col("text").alias("_t")), "doc_id")
    low = F.greatest(F.col("start") - 30_000, F.lit(0))
    before = F.substr("_t", low + 1, F.col("start") - low)
    heads = F.regexp_extract_all(before, F.lit(r"(?m)^#{1,6}[ \t]+[^\n]+"), F.lit(0))
    from_ = F.greatest(F.col("start") - 2000, F.lit(0))
    j = j.withColumn("history", F.slice(heads, F.greatest(F.size(heads) - most + 1, F.lit(1)), F.lit(most)))
    return j.withColumn("window", F.substr("_t", from_ + 1, F.col("end") + 1400 - from_)).drop("_t")


def independent_head(kind: Column, zone: Column, role: Column, subtitle: Column, text: Column, quote: Column, inline: Column) -> Column:
    """Whether an entry's head stands for itself: a heading, an inline head, or a line of its own without a sentence's end; not
    in an excluded zone, a caption or a repeated subtitle."""
    own = (F.trim(text) == F.trim(quote)) & ~quote.rlike(r"[.!?。！？]\s*\z")
    blocked = zone.isNotNull() | F.coalesce(role == "caption", F.lit(False)) | F.coalesce(subtitle, F.lit(False))
    return ~blocked & F.coalesce((kind == "heading") | inline | own, F.lit(False))


def made_candidates(findings: DataFrame, parts: DataFrame, units: DataFrame) -> DataFrame:
    """Candidates of names that were found: findings(chunk_id, name, evidence_ids, needs_context), parts(chunk_id, unit_id,
    text, start), what was read; units(unit_id, text, headings).

    Evidence is a slice of its unit: where ``start`` is null the slice's text must stand in the unit exactly once. Gives
    candidate_id (chunk and a hash of the contents), name, evidence_ids, spans, issues, scope and ``problem``: not_read,
    missing_or_ambiguous, or slice_differs, for the first piece of evidence that has one."""
    f = findings.withColumn("_f", F.xxhash64("chunk_id", "name", "evidence_ids")).select("*", F.posexplode_outer("evidence_ids").alias("_k", "unit_id"))
    u = units.select("unit_id", F.col("text").alias("_whole"), F.col("headings").alias("_heads"))
    j = f.join(parts.select("chunk_id", "unit_id", F.col("text").alias("_part"), F.col("start").alias("_s")), ["chunk_id", "unit_id"], "left").join(u, "unit_id", "left")
    n = F.size(F.split("_whole", F.concat(F.lit(r"\Q"), F.col("_part"), F.lit(r"\E")))) - 1
    again = F.position(F.col("_part"), F.substr("_whole", F.position(F.col("_part"), F.col("_whole")) + 1, F.length("_whole"))) > 0
    start = F.coalesce(F.col("_s"), F.when((n >= 1) & ~again, F.position(F.col("_part"), F.col("_whole")) - 1))
    j = j.withColumn("_start", start.cast("int"))
    end = F.col("_start") + F.length("_part")
    problem = F.when(F.col("_part").isNull() | F.col("_whole").isNull(), "not_read").when(F.col("_start").isNull(), "missing_or_ambiguous").when(F.substr("_whole", F.col("_start") + 1, F.length("_part")) != F.col("_part"), "slice_differs")
    j = j.withColumn("_problem", problem).withColumn("_split", (F.col("_start") > 0) | (end < F.length("_whole")))
    span = F.struct("_k", F.col("_start").alias("start"), end.cast("int").alias("end"), "unit_id", "_heads")
    g = j.groupBy("chunk_id", "name", "evidence_ids", "needs_context", "_f").agg(F.array_sort(F.collect_set(span)).alias("_s"), F.bool_or("_split").alias("_split"), F.min_by("_problem", F.when(F.col("_problem").isNotNull(), F.col("_k"))).alias("problem"))
    spans = F.transform("_s", lambda x: F.struct(x["unit_id"].alias("unit_id"), x["start"].alias("start"), x["end"].alias("end")))
    issues = T.reasons((F.col("needs_context"), "context_incomplete"), (F.coalesce(F.col("_split"), F.lit(False)), "source_unit_split"))
    g = g.withColumn("spans", spans).withColumn("issues", issues).withColumn("scope", F.array_distinct(F.flatten(F.transform("_s", lambda x: F.coalesce(x["_heads"], F.array().cast("array<string>"))))))
    key = F.to_json(F.struct("name", "evidence_ids", "spans", "issues"))
    return g.select(F.concat_ws("-", "chunk_id", F.substring(F.sha2(key, 256), 1, 20)).alias("candidate_id"), "chunk_id", "name", "evidence_ids", "spans", "issues", "scope", "problem").dropDuplicates(["candidate_id"])
