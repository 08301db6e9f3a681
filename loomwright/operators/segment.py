"""Segmentation of texts: Markdown units, chunks, headings, lists, sentences, regions, samples.

State machines that SQL cannot say run per document in Arrow batches; what lines and windows can say stays in the JVM.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})")
HEAD = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+|$)(.*?)(?:[ \t]+#+)?[ \t]*$")
LIST = re.compile(r"^ *(?:[-*+]|\d{1,9}[.)])[ \t]+\S")


def split_units(text: str) -> list[tuple[str, str, int, int, list[str]]]:
    """(kind, text, first line, last line, headings above) of the blocks of a Markdown text. Nothing is lost: the texts put
    together are the input."""
    lines = text.split("\n")
    ends = [ln + "\n" for ln in lines[:-1]] + [lines[-1]]
    out: list[tuple[str, str, int, int, list[str]]] = []
    stack: list[tuple[int, str]] = []
    k, n = 0, len(lines)

    def add(kind: str, a: int, b: int) -> None:
        out.append((kind, "".join(ends[a:b]), a + 1, b, [t for _, t in stack]))

    while k < n:
        a, line = k, lines[k]
        if m := FENCE.match(line):
            k += 1
            while k < n and not (lines[k].strip().startswith(m.group(1)[0] * 3) and not lines[k].strip().strip(m.group(1)[0])):
                k += 1
            k = min(k + 1, n)
            add("code", a, k)
        elif line.strip() == "$$":
            k += 1
            while k < n and lines[k].strip() != "$$":
                k += 1
            k = min(k + 1, n)
            add("math", a, k)
        elif m := HEAD.match(line):
            level = len(m.group(1))
            while stack and stack[-1][0] >= level:
                stack.pop()
            k += 1
            add("heading", a, k)
            stack.append((level, m.group(2).strip()))
        elif k + 1 < n and line.strip() and re.match(r"^ {0,3}(=+|-+)[ \t]*$", lines[k + 1]) and not LIST.match(line) and "|" not in line:
            level = 1 if "=" in lines[k + 1] else 2
            while stack and stack[-1][0] >= level:
                stack.pop()
            k += 2
            add("heading", a, k)
            stack.append((level, line.strip()))
        elif line.lstrip().startswith("|") or (k + 1 < n and "|" in line and re.match(r"^[ \t|:-]*-{2,}[ \t|:-]*$", lines[k + 1])):
            while k < n and "|" in lines[k]:
                k += 1
            add("table", a, k)
        elif re.match(r"^ {0,3}<[A-Za-z!/]", line):
            while k < n and lines[k].strip():
                k += 1
            add("html", a, k)
        elif LIST.match(line):
            k += 1
            while k < n and (LIST.match(lines[k]) or (lines[k].startswith(("  ", "\t")) and lines[k].strip())):
                k += 1
            add("list", a, k)
        elif not line.strip():
            while k < n and not lines[k].strip():
                k += 1
            add("blank", a, k)
        else:
            k += 1
            add("text", a, k)
    return out


def units(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, unit_no, kind, text, start_line, end_line, headings)"""
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [(i, k, *u) for i, t in zip(pdf[ident], pdf[text], strict=True) for k, u in enumerate(split_units(t or ""))]
            yield pd.DataFrame(rows, columns=[ident, "unit_no", "kind", "text", "start_line", "end_line", "headings"])

    return docs.select(ident, text).mapInPandas(run, f"{ident} {kind}, unit_no int, kind string, text string, start_line int, end_line int, headings array<string>")


def pack(text: str, budget: int) -> list[str]:
    """Pieces of at most ``budget`` characters: paragraphs, else lines, sentences, words, and halves at last; neighbours
    are put together while they fit. Together they are the text."""
    def cut(t: str, how: int) -> list[str]:
        if len(t) <= budget:
            return [t] if t else []
        if how == len(CUTS):
            half = len(t) // 2
            return cut(t[:half], how) + cut(t[half:], how)
        parts = [p for p in CUTS[how].split(t) if p]
        return [x for p in parts for x in cut(p, how + 1)] if len(parts) > 1 else cut(t, how + 1)

    out: list[str] = []
    for p in cut(text, 0):
        if out and len(out[-1]) + len(p) <= budget:
            out[-1] += p
        else:
            out.append(p)
    return out


CUTS = [re.compile(r"(?<=\n\n)(?!\n)"), re.compile(r"(?<=\n)"), re.compile(r"(?<=[.!?。！？])(?=\s|[^\x00-\x7F])"), re.compile(r"(?<=\s)")]


def chunks(docs: DataFrame, budget: int, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, chunk_no, text)"""
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [(i, k, c) for i, t in zip(pdf[ident], pdf[text], strict=True) for k, c in enumerate(pack(t or "", budget))]
            yield pd.DataFrame(rows, columns=[ident, "chunk_no", "text"])

    return docs.select(ident, text).mapInPandas(run, f"{ident} {kind}, chunk_no int, text string")


def with_context(parts: DataFrame, ident: str, order: str, text: str, budget: int) -> DataFrame:
    """Adds the tail of the part before and the head of the part after, half the budget each."""
    w = W.partitionBy(ident).orderBy(order)
    half = budget // 2
    before = F.lag(text).over(w)
    return parts.withColumn("before", F.substr(before, F.greatest(F.length(before) - half + 1, F.lit(1)), F.lit(half))).withColumn("after", F.substring(F.lead(text).over(w), 1, half))


def headings(lines: DataFrame) -> DataFrame:
    """Lines that are headings: adds method, level and title."""
    t = F.col("line")
    md = t.rlike(r"^#{1,6} +\S")
    zh = t.rlike(r"^\s*第\s*[一二三四五六七八九十百零〇0-9]+\s*(?:章|节|篇|部分)")
    num = t.rlike(r"^ *[0-9]+(?:\.[0-9]+)*[.)]? +[A-Z㐀-鿿]") & (F.length(t) <= 120) & ~t.rlike(r"[.;:] *\z")
    paren = t.rlike(r"^\s*[（(][一二三四五六七八九十0-9]+[）)]\s*\S") & (F.length(t) <= 60)
    method = F.when(md, "markdown").when(zh, "chinese").when(num, "numbered").when(paren, "parenthesis")
    level = F.when(md, F.length(F.regexp_extract(t, "^(#+)", 1))).when(zh, F.when(t.rlike("章|篇|部分"), 1).otherwise(2)).when(num, F.size(F.split(F.regexp_extract(t, r"^ *([0-9.]+?)[.)]? ", 1), r"\."))).when(paren, 3)
    title = F.trim(F.regexp_replace(t, r"^\s*(?:#{1,6}|[0-9]+(?:\.[0-9]+)*[.)]?)\s*", ""))
    return lines.withColumn("method", method).where("method is not null").withColumn("level", level).withColumn("title", title)


NOISE = ["contents", "index", "references", "bibliography", "目录", "索引", "参考文献"]


def heading_filter(heads: DataFrame) -> DataFrame:
    """Adds ``decision`` and ``why``: contents, index and page-leader lines go; questions and very long titles are reviewed."""
    t = F.lower(F.trim("title"))
    why = F.when(t.isin(NOISE), "contents_or_index").when(t.rlike(r"\.{4,}\s*[0-9]+\z|…+\s*[0-9]+\z"), "page_leader").when(t.rlike(r"^(?:figure|table|fig\.)\s*[0-9]"), "caption").when(t == "", "empty").when(t.rlike(r"[?？]\z"), "question").when(F.length(t) > 100, "long")
    return heads.withColumn("why", why).withColumn("decision", F.when(why.isin("question", "long"), "review").when(why.isNotNull(), "exclude").otherwise("keep"))


def list_items(lines: DataFrame) -> DataFrame:
    """List items: marker, kind, depth and first line's text."""
    t = F.col("line")
    hit = lines.where(t.rlike(r"^ *(?:[0-9]+[.)]|[-*]) +[^ ]"))
    kind = F.when(t.rlike(r"^ *[0-9]"), F.when(F.lower(t).rlike(r"^ *[0-9]+[.)] +step\b"), "step").otherwise("numbered")).otherwise("bullet")
    return hit.withColumn("kind", kind).withColumn("depth", F.floor(F.length(F.regexp_extract(t, "^( *)", 1)) / 2).cast("int")).withColumn("item", F.regexp_extract(t, r"^ *(?:[0-9]+[.)]|[-*]) +(.*)\z", 1))


def items_with_body(lines: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Items with their continuation lines (indented or non-empty lines up to a blank one): (id, first, last, text)."""
    t = F.col("line")
    start = t.rlike(r"^ *(?:[0-9]+[.)]|[-*]) +[^ ]")
    w = W.partitionBy(ident).orderBy("line_no")
    d = lines.withColumn("_start", start.cast("int")).withColumn("_stop", (F.trim(t) == "").cast("int"))
    d = d.withColumn("_item", F.sum("_start").over(w)).withColumn("_gap", F.sum("_stop").over(w))
    d = d.withColumn("_g0", F.max(F.when(F.col("_start") == 1, F.col("_gap"))).over(w)).where((F.col("_item") > 0) & (F.col("_gap") == F.col("_g0")))
    g = d.groupBy(ident, "_item").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"), F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"))
    return g.select(ident, "first", "last", F.array_join(F.transform("l", lambda x: F.trim(x["line"])), " ").alias("text"))


def constraints(text: Column) -> Column:
    """struct<conditions, exceptions> of an item's text."""
    return F.struct(F.regexp_extract_all(F.lower(text), F.lit(r"\b(?:if|when|unless|provided that)\b[^,.;]*"), F.lit(0)).alias("conditions"), F.regexp_extract_all(F.lower(text), F.lit(r"\b(?:except|unless|other than)\b[^,.;]*"), F.lit(0)).alias("exceptions"))


def index_entries(lines: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Back-of-book index lines: term, parent (the last unindented term), pages, see-references."""
    t = F.col("line")
    d = lines.where(t.rlike(r",\s*[0-9]+(?:[-–][0-9]+)?(?:\s*,\s*[0-9]+(?:[-–][0-9]+)?)*\s*\z") | F.lower(t).rlike(r"\bsee(?: also)?\b"))
    term = F.trim(F.regexp_replace(F.regexp_replace(t, r"(?i)[.,]?\s*see(?: also)? .*\z", ""), r"(?:,\s*[0-9]+(?:[-–][0-9]+)?)+\s*\z", ""))
    d = d.withColumn("term", term).withColumn("indented", t.rlike(r"^\s+\S"))
    w = W.partitionBy(ident).orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    parent = F.last(F.when(~F.col("indented"), F.col("term")), ignorenulls=True).over(w)
    return d.withColumn("parent", F.when(F.col("indented"), parent)).withColumn("pages", F.regexp_extract_all(F.regexp_replace(t, r"\A[^,]*", ""), F.lit(r"[0-9]+(?:[-–][0-9]+)?"), F.lit(0))).withColumn("see", F.regexp_extract(t, r"(?i)\bsee(?: also)? (.*)\z", 1))


ABBREVIATIONS = {"e.g", "i.e", "etc", "fig", "dr", "mr", "mrs", "ms", "prof", "vol", "no", "cf", "al", "vs", "st", "approx", "eq"}
PAIRS = {"(": ")", "[": "]", "（": "）", "【": "】", "“": "”", "《": "》"}


def split_sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences: no cut inside brackets or quotes that close in the same line, after abbreviations, or in numbers."""
    out, start, stack = [], 0, []
    for k, c in enumerate(text):
        if c in PAIRS and text.find(PAIRS[c], k, (text.find("\n", k) + 1 or len(text) + 1) - 1 if "\n" in text[k:] else len(text)) > 0:
            stack.append(PAIRS[c])
        elif stack and c == stack[-1]:
            stack.pop()
        if c == "\n":
            stack.clear()
        last = c in "。！？!?\n" or (c == "." and (k + 1 == len(text) or text[k + 1].isspace()))
        if not last or stack:
            continue
        if c == ".":
            word = re.search(r"[\w.]*$", text[start:k]).group().lower()
            if word in ABBREVIATIONS or (len(word) == 1 and word.isalpha()):
                continue
        if text[start : k + 1].strip():
            out.append((start, k + 1))
            start = k + 1
    if text[start:].strip():
        out.append((start, len(text)))
    return out


#: Prose units: marks that pair, abbreviations, notes of a source in parentheses.
BRACKET_PAIRS = {"(": ")", "（": "）", "[": "]", "【": "】", "{": "}"}
QUOTE_PAIRS = {'"': '"', "'": "'", "“": "”", "‘": "’", "「": "」", "『": "』", "《": "》"}
OPENERS = BRACKET_PAIRS | QUOTE_PAIRS
CLOSERS = "".join(dict.fromkeys(OPENERS.values()))
PAIRED = re.compile("[" + re.escape("".join(dict.fromkeys([*OPENERS, *CLOSERS]))) + "]")
TERMINALS = re.compile(rf"[。！？]+[{re.escape(CLOSERS)}]*|[.!?]+[{re.escape(CLOSERS)}]*(?=\s|$)")
PARENTHESES = re.compile(r"\([^()（）\r\n]*\)|（[^()（）\r\n]*）")
PAGE = re.compile(r"pp?\.\s*\d+(?:\s*[-–—]\s*\d+)?\.?", re.I)
DATED_SOURCE = re.compile(r"[㐀-鿿]{2,16}(?:网|报|通讯社|杂志)\s*[,，:：]?\s*(?:\d{4}年\d{1,2}月\d{1,2}日|\d{4}[-/.]\d{1,2}[-/.]\d{1,2})")
AUTHOR_BOOK = re.compile(r"([㐀-鿿]{2,4})\s*[:：]?\s*《[^《》\r\n]+》")
EXPLAINS = re.compile("参见|详见|例如|比如|阅读|关于|包括|研究|使用|所谓|即|见|如")
PROSE_ABBREVIATIONS = {"dr", "mr", "mrs", "ms", "prof", "st", "vs", "e.g", "i.e", "etc", "fig", "vol", "no", "pp", "ed", "eds", "bst", "skt", "lit"}
SMALL_FOLLOWS = {"sk", "bsm"}  # abbreviations only before a small letter
SPACE, SMALL_NEXT, JOINING, INITIALS, RUN = re.compile(r"\s*"), re.compile(r"\s+[a-z]"), re.compile(r"(?:or|and)\b", re.I), re.compile(r"(?:(?<!\w)[A-Za-z]\.[A-Za-z]|(?<!\w)[A-Z])\.\Z"), re.compile(r"[A-Za-z.]+\Z")
APOSTROPHES = re.compile("['‘’]")


def _possessive(raw: str, k: int) -> bool:
    """Whether the mark at k, after an s and before a small word, leaves its quotation open: the next mark that stands in no
    word closes it after a sentence."""
    nxt = SPACE.match(raw, k + 1).end()
    if raw[k - 1].lower() != "s" or nxt == len(raw) or not raw[nxt].islower():
        return False
    for m in APOSTROPHES.finditer(raw, k + 1):
        p = m.start()
        before, after = raw[p - 1], raw[p + 1 : p + 2]
        if before != "\\" and not (before.isalnum() and after.isalnum()):
            return m.group() == raw[k] and before in ".!?。！？"
    return False


def _paired(raw: str) -> tuple[list[int], list[int], list[int | None], set[int]]:
    """Places of paired marks; after each the depth and where the outermost open bracket is; ends of quotations."""
    places, depths, outer, ends = [], [0], [None], set()
    stack: list[tuple[str, int]] = []
    for m in PAIRED.finditer(raw):
        k, c = m.start(), m.group()
        slashes = k
        while slashes and raw[slashes - 1] == "\\":
            slashes -= 1
        before, after = raw[k - 1] if k else "", raw[k + 1 : k + 2]
        top = OPENERS[stack[-1][0]] if stack else None
        inner = c in "'‘’" and before.isalnum() and after.isalnum()
        if not inner and c in "'’" and k and c == top and after.isspace():
            inner = _possessive(raw, k)
        if (k - slashes) % 2 == 0 and not inner:
            if c == top:
                if stack.pop()[0] in QUOTE_PAIRS:
                    ends.add(k + 1)
            elif c in OPENERS and not (c in "'‘" and before.isalnum()):
                stack.append((c, k))
        places.append(k)
        depths.append(len(stack))
        outer.append(next((at for o, at in stack if o in BRACKET_PAIRS), None))
    return places, depths, outer, ends


def _source_note(text: str) -> bool:
    body = text[1:-1].strip()
    author = AUTHOR_BOOK.fullmatch(body)
    return bool(PAGE.fullmatch(body) or DATED_SOURCE.fullmatch(body) or (author and not EXPLAINS.match(author.group(1))))


def source_notes(raw: str) -> list[tuple[int, int]]:
    """Spans of parentheses outside others that name a source, on a line of their own, after a sentence or another note."""
    found = [m.span() for m in PARENTHESES.finditer(raw) if _source_note(m.group())]
    if not found:
        return []
    places, depths, _, _ = _paired(raw)
    out: list[tuple[int, int]] = []
    for start, end in found:
        if depths[bisect_left(places, start)]:
            continue
        line_end = raw.find("\n", end)
        own_line = not (raw[raw.rfind("\n", 0, start) + 1 : start].strip() or raw[end : line_end if line_end >= 0 else len(raw)].strip())
        k = start
        while k and raw[k - 1].isspace():
            k -= 1
        while k and raw[k - 1] in CLOSERS:
            k -= 1
        if own_line or (k and raw[k - 1] in ".!?。！？") or (out and SPACE.match(raw, out[-1][1]).end() == start):
            out.append((start, end))
    return out


def _prose(raw: str) -> list[tuple[int, int]]:
    places, depths, outer, quote_ends = _paired(raw)
    out, start = [], 0
    for m in TERMINALS.finditer(raw):
        a, end = m.span()
        if depths[bisect_left(places, end)]:
            continue
        bracket, nxt = outer[bisect_left(places, a)], SPACE.match(raw, end).end()
        if bracket is not None and SPACE.match(raw, start).end() < bracket:
            continue
        if (bracket is not None or any(k in quote_ends for k in range(a + 1, end + 1))) and (raw[nxt : nxt + 1].islower() or JOINING.match(raw, nxt)):
            continue
        marks = m.group().rstrip(CLOSERS)
        if marks.endswith("."):
            k = a
            while k and raw[k - 1].isspace():
                k -= 1
            if len(marks) > 1 or (k and raw[k - 1] == ".") or raw[nxt : nxt + 1] == ".":
                continue
            run = RUN.search(raw[max(a - 8, 0) : a])
            word = run.group().lower() if run else ""
            if word in PROSE_ABBREVIATIONS or (word in SMALL_FOLLOWS and SMALL_NEXT.match(raw, end)) or INITIALS.search(raw[max(a - 5, 0) : a + 1]):
                continue
        out.append((start, end))
        start = end
    if raw[start:].strip():
        out.append((start, len(raw)))
    return out


def prose_units(raw: str) -> list[tuple[int, int, bool]]:
    """(start, end, note) of the sentences of a text and of the notes of sources between them. No sentence ends inside paired
    brackets or quotes, after an abbreviation or an initial, in an ellipsis, or at a closed quotation that goes on small."""
    out, at = [], 0
    for a, b in [*source_notes(raw), (len(raw), len(raw))]:
        out += [(at + x, at + y, False) for x, y in _prose(raw[at:a])]
        if a < b:
            out.append((a, b, True))
        at = b
    return out


def sentences(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, k, sentence, start, end, note): the ``prose_units`` of texts."""
    kind = docs.schema[ident].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = [(i, k, t[a:b], a, b, n) for i, t in zip(pdf[ident], pdf[text], strict=True) if t for k, (a, b, n) in enumerate(prose_units(t))]
            yield pd.DataFrame(rows, columns=[ident, "k", "sentence", "start", "end", "note"])

    return docs.select(ident, text).mapInPandas(run, f"{ident} {kind}, k int, sentence string, start int, end int, note boolean")


def sentence_count(text: Column) -> Column:
    """How many ``prose_units`` a text has; null for null."""
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(prose_units(t)) for t in s], dtype="Int64")

    return F.pandas_udf(run, "long")(text)


def region_metrics(lines: DataFrame, regions: int, ident: str = "doc_id") -> DataFrame:
    n = F.max("line_no").over(W.partitionBy(ident))
    d = lines.withColumn("region", F.least(F.floor((F.col("line_no") - 1) * regions / n), F.lit(regions - 1)).cast("int"))
    return d.groupBy(ident, "region").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"), F.count_if(F.col("line").rlike("[0-9]")).alias("n_digits"))


def language_samples(text: Column, size: int = 1000, count: int = 7) -> Column:
    """Evenly spread slices, equal ones once; a text up to their total size whole."""
    n = F.length(text)
    return F.when(n <= size * count, F.array(text)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.substr(text, F.floor(i * (n - size) / (count - 1)).cast("int") + 1, F.lit(size)))))


def plain_html(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, r"<(script|style)[^>]*>[^<]*</(script|style)>", ""), r"<[^>]*>", "")


def without_embedded_images(text: Column) -> Column:
    """Data-URI images in HTML, escaped HTML and Markdown as a marker."""
    t = F.regexp_replace(text, r"(?is)<img\b[^>]*\bsrc\s*=\s*([\"'])data:image/.*?\1[^>]*>", "[image]")
    t = F.regexp_replace(t, r"(?is)&lt;img\b(?:(?!&gt;).)*data:image/(?:(?!&gt;).)*&gt;", "[image]")
    return F.regexp_replace(t, r"(?is)!\[[^\]]*\]\(\s*data:image/[^)]*\)", "[image]")


def format_cleanup(text: Column) -> Column:
    """Images, display formulas, navigation lines and captions off; words broken at line ends joined."""
    t = F.regexp_replace(text, r"!\[[^\]]*\]\([^)]*\)", "")
    t = F.regexp_replace(t, r"(?s)\$\$.*?\$\$", "")
    t = F.regexp_replace(t, r"(?im)^[ \t]*(?:next|previous|back to top|home)[ \t]*$", "")
    t = F.regexp_replace(t, r"(?im)^[ \t]*(?:figure|fig\.|table)[ \t]*[0-9]+[.:].*$", "")
    t = F.regexp_replace(t, r"(?<=[a-z])-\n(?=[a-z])", "")
    return F.regexp_replace(t, r"\n{4,}", "\n\n\n")


def title_guess(text: Column, stem: Column) -> Column:
    """The first of 80 lines with 2 to 100 characters, marks off, that is no address; else the file's stem."""
    clean = F.transform(F.slice(F.split(text, "\n"), 1, 80), lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:#{1,6}|[-*])\s*", "")))
    good = F.filter(clean, lambda x: F.length(x).between(2, 100) & ~x.rlike(r"(?i)^(?:https?:|www\.)"))
    return F.coalesce(F.get(good, F.lit(0)), stem)


def intact_table(html: Column) -> Column:
    """Whether table, row and cell tags nest and close, with a table and two cells at least."""
    from html.parser import HTMLParser

    def check(v) -> bool:
        if v is None:
            return False
        stack, seen, good = [], {"table": 0, "td": 0}, [True]
        inside = {"tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr"}, "th": {"tr"}}

        class P(HTMLParser):
            def handle_starttag(self, tag, attrs):
                if tag in ("table", "tr", "td", "th", "thead", "tbody", "tfoot"):
                    if tag in inside and (not stack or stack[-1] not in inside[tag]):
                        good[0] = False
                    stack.append(tag)
                    if tag in ("table", "td", "th"):
                        seen["table" if tag == "table" else "td"] += 1

            def handle_endtag(self, tag):
                if tag in ("table", "tr", "td", "th", "thead", "tbody", "tfoot"):
                    if stack and stack[-1] == tag:
                        stack.pop()
                    else:
                        good[0] = False

        P().feed(v)
        return good[0] and not stack and seen["table"] >= 1 and seen["td"] >= 2

    def run(s: pd.Series) -> pd.Series:
        return s.map(check)

    return F.pandas_udf(run, "boolean")(html)


def bibliographic_regions(units_: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Units of the first and last twentieth with two or more bibliographic signals in them and their neighbours."""
    full = units_.where(F.trim("text") != "")
    w = W.partitionBy(ident).orderBy("unit_no")
    near = F.lower(F.concat_ws("\n", F.lag("text").over(w), F.col("text"), F.lead("text").over(w)))
    signals = [r"isbn", r"copyright|©", r"all rights reserved", r"published by|publisher", r"\b(?:19|20)[0-9]{2}\b", r"references|bibliography", r"doi\.org|https?://"]
    n = sum((near.rlike(p).cast("int") for p in signals[1:]), near.rlike(signals[0]).cast("int"))
    k, all_ = F.row_number().over(w), F.count("*").over(W.partitionBy(ident))
    return full.withColumn("signals", n).withColumn("_k", k).withColumn("_n", all_).where(((F.col("_k") <= F.ceil(F.col("_n") / 20)) | (F.col("_k") > F.col("_n") - F.ceil(F.col("_n") / 20))) & (F.col("signals") >= 2)).drop("_k", "_n")


def grouped_names(items: DataFrame, ident: str, term: str, order: str) -> DataFrame:
    """Terms that differ only in case as one: the first spelling and the ascending places of all. A blank term names nothing."""
    key = F.lower(F.trim(term))
    g = items.where(F.trim(term) != "").groupBy(ident, key.alias("key"))
    return g.agg(F.min_by(term, order).alias("name"), F.array_sort(F.collect_list(order)).alias("places"))


ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "St", "No", "Fig", "Vol", "pp", "cf", "vs", "etc", "e.g", "i.e")


def trimmed_tail(body: Column) -> Column:
    """A body cut after its last whole sentence, if it breaks off: its last line ends without a sentence mark, in a hyphen, or
    in an abbreviation's dot. A body without any whole sentence stays as it is; null stays null."""
    short = "|".join(re.escape(a) for a in ABBREVIATIONS)
    end = rf"(?:(?<!\b(?:{short}))\.|[!?。！？])[\"'”’)\]]*"
    t = F.rtrim(F.regexp_replace(body, r"\s+\z", ""))
    whole = t.rlike(rf"(?s){end}\z")
    cut = F.regexp_extract(t, rf"(?s)\A(.*{end})(?=\s|(?<=[。！？”’]))", 1)
    return F.when(whole | (cut == ""), t).otherwise(cut)
