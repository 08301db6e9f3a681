"""Signals in whole books: periodicals, collections, full-text risks, dictionary gates, verdict gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T

#: What an issue of a periodical is called.
ISSUE = r"第\s*\d+\s*(?:卷|期)|总第\s*\d+\s*期|月刊|双月刊|季刊"
ISSUE_LATIN = r"No\.?\s*\d+\s*\(\s*Total\s+No|Vol\.?\s*\d+\s*,?\s*No\.?\s*\d+|Monthly|Bimonthly|Quarterly"
#: Characters of a book that each signal reads: fixed values of the feature, not a sample.
FRONT_PERIODICAL, FRONT_EDITORS, FRONT_AUTHORS, FRONT_YEAR, FRONT_MARKET, FRONT_ARTICLE, FRONT_LINES = 12_000, 80_000, 120_000, 120_000, 30_000, 60_000, 800


def periodical_signals(title: Column, publisher: Column, metadata: Column, text: Column, reference_title: Column) -> Column:
    """Careful signals that a row is an issue of a periodical; ``reference_title``: the title has a reference term."""
    ident = lambda c: F.regexp_replace(F.lower(T.blank(c)), r"[^0-9a-z一-鿿]+", "")
    pub, head = T.blank(publisher), F.substring(T.blank(text), 1, FRONT_PERIODICAL)
    editorial = F.contains(pub, F.lit("编辑部")) & (ident(title) != "") & F.contains(ident(pub), ident(title)) & ~reference_title
    meta = T.blank(metadata).rlike(rf"(?is)(?:本刊|本期期刊|该期刊|杂志).{{0,40}}(?:{ISSUE})")
    issn = head.rlike(r"(?i)\bISSN\s*\d{4}\s*[-–]\s*\d{3}[\dXx]\b")
    issue = head.rlike(rf"(?i)(?:{ISSUE}|{ISSUE_LATIN})")
    chinese = head.rlike(r"(?is)(?:19|20)\d{2}\s*年\s*第\s*\d+\s*期.{0,80}(?:总\s*第\s*\d+\s*期|第\s*\d+\s*卷)")
    return T.reasons((pub.rlike("杂志社|期刊社"), "publisher_periodical"), (editorial, "publisher_editorial_issue"), (meta, "metadata_periodical"), (chinese, "md_chinese_issue"), (issn & issue, "md_issn_issue"))


#: Phrases that tell a collection (fixed values); the second to fifth tell research authorship.
PHRASES = ["contributors to this volume", "first authors in chapters", "applied research conducted by the authors", "collection of selected topics", "individually important contributions", "section editors"]
#: The head of a section and a chapter's name.
SECTION = r"(?im)^\s*#{0,6}\s*(?:\d+(?:\.\d+)*\.?\s*)?"
CHAPTER = r"(?:chapter\s+\d+|第[一二三四五六七八九十百0-9]+章)"


def collection_signals(text: Column) -> Column:
    """struct of section counts, phrases and a confidence that a book is an edited collection."""
    t = T.blank(text)
    n = lambda p, c=t: F.regexp_count(c, F.lit(p))
    editors = n(r"(?i)\b(?:editors?|edited\s+by)\b|主编|编者", F.substring(t, 1, FRONT_EDITORS))
    refs, ends = n(SECTION + r"(?:references|bibliography|参考文献)[ \t]*$"), n(SECTION + r"(?:conclusions?(?:\s+and\s+[^\n]+)?|discussion\s+and\s+conclusion|结论|小结)[ \t]*$")
    abstracts, chapters = n(SECTION + r"(?:abstract|摘要)[ \t]*$"), n(rf"(?im)^\s*#{{0,6}}\s*{CHAPTER}")
    author = lambda x: (F.length(x) <= 180) & ~x.rlike(r"(?U)\d") & x.rlike(r"(?i)\b(?:and|&)\b|,") & (F.regexp_count(x, F.lit(r"\p{Lu}")) >= 6)
    behind = lambda ls, i: F.slice(F.filter(F.transform(F.slice(ls, i + 1, 5), F.trim), lambda x: x != ""), 1, 2)
    authored = T.let(F.split(F.substring(t, 1, FRONT_AUTHORS), "\n"), lambda ls: F.size(F.filter(F.sequence(F.lit(1), F.size(ls)), lambda i: F.get(ls, i - 1).rlike(r"(?i)\bchapter\s+\d+\b|第[一二三四五六七八九十百0-9]+章") & F.exists(behind(ls, i), author))))
    found = F.array_compact(F.array(*[F.when(F.contains(F.lower(t), F.lit(p)), F.lit(p)) for p in PHRASES]))
    s = F.struct(editors.alias("editors"), refs.alias("references"), ends.alias("conclusions"), abstracts.alias("abstracts"), chapters.alias("chapters"), authored.alias("authors"), found.alias("phrases"))

    def judge(v: Column) -> Column:
        research = F.arrays_overlap(v["phrases"], F.array(*map(F.lit, PHRASES[1:5])))
        repeated = (v["chapters"] >= 4) & (v["references"] >= 4) & (v["conclusions"] >= 3) & (v["authors"] >= 3)
        edited = v["editors"] > 0
        high = edited & ((research & (v["references"] >= 3)) | repeated)
        listed = F.array_contains(v["phrases"], PHRASES[0]) & (v["references"] >= 3) & (v["chapters"] >= 5)
        some = (v["chapters"] >= 4) & (v["references"] >= 3) & (v["conclusions"] >= 2) & (v["authors"] >= 2)
        conf = F.when(high, "high").when(edited & (listed | research | some), "medium").otherwise("low")
        return F.struct(*[v[k].alias(k) for k in ("editors", "references", "conclusions", "abstracts", "chapters", "authors", "phrases")], conf.alias("confidence"))

    return T.let(s, judge)


#: What tells a year of first publication.
YEARS = r"(?i)\b(?:(?:originally|first)\s+published|original\s+edition\s+(?:was\s+)?published)[^\n]{0,120}?(?<!\d)((?:18|19|20)\d{2})(?!\d)|(?:原版|初版|首次|最初)[^\n]{0,50}?(?:出版|发行)[^\n]{0,50}?((?:18|19|20)\d{2})"


def original_year(text: Column) -> Column:
    """The earliest year of first publication that the front of a text tells, electronic editions aside."""
    front = F.substring(F.array_join(F.slice(F.split(T.blank(text), "\n"), 1, FRONT_LINES), "\n"), 1, FRONT_YEAR)
    lines = F.filter(F.regexp_extract_all(front, F.lit(r"(?im)^[^\n]*(?:published|出版|发行)[^\n]*$"), F.lit(0)), lambda x: x.rlike(YEARS) & ~F.lower(x).rlike("ebook|electronic|digitized|电子版|数字版") & ~x.rlike(r"(?i)\b(?:standard|code|equation|formula|model|paper|article|study|method|process|algorithm|magazine|journal|classification\s+system)\b[^.\n]{0,100}\b(?:originally|first|original)\b"))
    return F.array_min(F.transform(lines, lambda x: F.greatest(F.coalesce(F.nullif(F.regexp_extract(x, YEARS, 1), F.lit("")), F.lit("0")), F.coalesce(F.nullif(F.regexp_extract(x, YEARS, 2), F.lit("")), F.lit("0"))).cast("int")))


def full_text_risks(text: Column, title: Column, genre: Column) -> Column:
    """array of hard reasons against a book: an original before 2000, answers that dominate, a single article."""
    t, g = T.blank(text), F.upper(F.trim(T.blank(genre)))
    year = original_year(text)
    answers = F.regexp_count(t, F.lit(r"(?im)^\s*(?:#{1,6}\s*)?(?:solution|answer|解答|答案)\s*[:：]?"))
    exam = (g == "EXAM_PREP") | T.blank(title).rlike(r"(?i)\bGATE\b|exam|practice\s+questions?|solved\s+problems?|习题集|题库|试题|考试|考研|考级|题解")
    market = F.substring(t, 1, FRONT_MARKET).rlike(r"(?i)solved\s+problems?|practice\s+questions?|question\s+bank|历年.{0,12}(?:试题|真题)|题库|习题集")
    article = (F.regexp_count(t, F.lit("\n")) < 1200) & t.rlike(SECTION + r"(?:abstract|摘要)[ \t]*$") & t.rlike(SECTION + r"(?:references|bibliography|参考文献)[ \t]*$") & t.rlike(r"(?i)\bthis\s+paper\b|本文(?:提出|研究|介绍|分析|探讨)") & F.substring(t, 1, FRONT_ARTICLE).rlike(r"(?i)\bproceedings\b|conference\s+paper|journal\s+article|会议论文|期刊论文")
    return T.reasons((F.coalesce(year < 2000, F.lit(False)), "original_publication_year_before_2000"), (exam & (answers >= 50) & market, "exam_question_answer_dominated"), (article, "single_article_or_conference_paper"))


def place_of(text: Column, pattern: str) -> Column:
    """struct<line, anchor> of a pattern's first match: the number of the line where it begins, and 240 characters of its
    lines from 80 before the match, white space as one blank."""
    t = T.blank(text)

    def found(v: Column) -> Column:
        head = F.regexp_extract(v["before"], r"([^\n]*)\z", 1)
        raw = F.concat(head, v["hit"], F.regexp_extract(F.substr(t, F.length(v["before"]) + F.length(v["hit"]) + 1, F.length(t)), r"\A([^\n]*)", 1))
        anchor = F.substr(raw, F.greatest(F.length(head) - 80, F.lit(0)) + 1, F.lit(240))
        return F.struct((F.regexp_count(v["before"], F.lit("\n")) + 1).alias("line"), F.trim(F.regexp_replace(anchor, r"(?U)\s+", " ")).alias("anchor"))

    return F.when(t.rlike(pattern), T.let(F.struct(F.split(t, pattern, 2)[0].alias("before"), F.regexp_extract(t, f"({pattern})", 1).alias("hit")), found))


#: Languages of dictionaries other than Chinese and English.
PAIRS = ["德汉", "汉德", "法汉", "汉法", "俄汉", "汉俄", "日汉", "汉日", "韩汉", "汉韩", "意汉", "汉意", "葡汉", "汉葡", "阿汉", "汉阿", "german-chinese", "chinese-german", "french-chinese", "chinese-french", "russian-chinese", "chinese-russian", "japanese-chinese", "chinese-japanese", "korean-chinese", "chinese-korean"]


def foreign_dictionary_title(title: Column) -> Column:
    t = F.lower(F.trim(T.blank(title)))
    return t.rlike("词典|辞典|字典|术语|词汇|对照|双解|dictionary|glossary|lexicon") & t.rlike("|".join(PAIRS))


def traditional_ratio(text: Column, traditional: str) -> Column:
    """struct<chars, variants, body>: how many CJK characters there are and how many of them are in ``traditional``, a
    table of variant characters that the caller gives (no converter comes with this library)."""
    han = F.regexp_replace(T.blank(text), "[^一-鿿]+", "")
    n, v = F.length(han), F.length(han) - F.length(F.translate(han, traditional, ""))
    return F.struct(n.alias("chars"), v.alias("variants"), ((n >= 500) & (v >= 500) & (v / n >= 0.05)).alias("body"))


def foreign_headings(text: Column) -> Column:
    """struct<count, chars, signal>: headings in other scripts, and capital lists of aliases with foreign letters."""
    heads = F.transform(F.regexp_extract_all(T.blank(text), F.lit(r"(?m)^\s*#{1,6}\s+(.+?)\s*$"), F.lit(1)), lambda h: F.trim(h))
    marks = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØŒÙÚÛÜÝŸßàáâãäåæçèéêëìíîïñòóôõöøœùúûüýÿ"
    script = "[Ͱ-ԯ֐-ࣿऀ-෿฀-๿぀-ヿㇰ-ㇿ가-힯]"
    count = lambda h, p: F.regexp_count(h, F.lit(p))
    alias = lambda h: (F.size(F.split(h, ",")) >= 3) & (F.length(h) <= 140) & ~h.rlike("[0-9]") & (count(h, r"\p{Lu}") >= 0.85 * count(h, r"\p{L}")) & (count(h, r"\p{L}") > 0)
    named, other = F.size(F.filter(heads, lambda h: alias(h) & h.rlike(f"[{marks}]"))), F.size(F.filter(heads, lambda h: h.rlike(script)))
    chars = F.aggregate(heads, F.lit(0), lambda a, h: a + count(h, f"[{marks}]") + count(h, script))

    def judge(v: Column) -> Column:
        n = F.when(v["a"] >= 5, v["a"]).otherwise(0) + F.when((v["b"] >= 5) & (v["c"] >= 20), v["b"]).otherwise(0)
        return F.struct(n.alias("count"), v["c"].alias("chars"), (n >= 5).alias("signal"))

    return T.let(F.struct(named.alias("a"), other.alias("b"), chars.alias("c")), judge)


def document_gates(decision: Column, traditional: Column, headings: Column) -> Column:
    """struct<decision, adjusted>: a traditional body or many foreign headings drop a dictionary."""
    from .rules import votes

    return votes(decision, (traditional, "DROP", "traditional"), (headings, "DROP", "heading_language"))


def qualitative_gate(decision: Column, *, usability: Column, dominant: Column, body: Column, other: Column, damaged: Column, examples: Column) -> Column:
    """The decision after what a document's samples hold: counts of body, other-language and damaged samples and of samples
    with verified examples."""
    drop = (other > 0) | (usability == "low") | dominant.isin("general_language_practice", "name_list") | (damaged >= F.greatest(F.lit(2), F.ceil(body / 4)))
    weak = (decision == "PASS") & ((usability != "high") | (body < 4) | (examples < 2) | (damaged > 0))
    return F.when(drop, "DROP").when(weak, "REVIEW").otherwise(decision)


def pass_challenge(decision: Column, risky_title: Column, long_samples: Column, recommendation: Column, payload_ok: Column, evidence: Column) -> Column:
    """struct<decision, reasons, supported>: a pass under suspicion needs three strong verified quotes (struct<sample, strong,
    verified>) from three samples; a challenge never drops."""
    why = F.when(decision == "PASS", T.reasons((risky_title, "risky_title"), (long_samples >= 2, "long_article_samples"))).otherwise(F.array().cast("array<string>"))
    strong = F.filter(evidence, lambda e: e["strong"] & e["verified"])
    ok = (recommendation == "PASS") & payload_ok & (F.size(strong) >= 3) & (F.size(F.array_distinct(F.transform(strong, lambda e: e["sample"]))) >= 3)
    return F.struct(F.when((F.size(why) > 0) & ~F.coalesce(ok, F.lit(False)), "REVIEW").otherwise(decision).alias("decision"), why.alias("reasons"), ok.alias("supported"))


def challenge_samples(problems: Column, labels: Column, examples: Column, n: int, most: int = 8) -> Column:
    """Numbers of samples to challenge with: those with problems, long or unclear structure (struct<no, structure>), and
    examples first, each once, then evenly spread others up to ``most``; ``n``: there are samples 1..n."""
    risky = F.transform(F.filter(labels, lambda x: x["structure"].isin("long_article", "unclear")), lambda x: x["no"])
    first = F.slice(F.array_distinct(F.filter(F.concat(problems, risky, examples), lambda k: k.between(1, n))), 1, most)

    def fill(v: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(1), F.lit(n)), v)
        want = F.least(F.lit(most), F.lit(n)) - F.size(v)
        even = F.transform(F.sequence(F.lit(0), F.greatest(want - 1, F.lit(0))), lambda i: F.get(left, F.bround(i * (F.size(left) - 1) / F.greatest(want - 1, F.lit(1))).cast("int")))
        return F.concat(v, F.when(want <= 0, F.array().cast("array<int>")).when(want >= F.size(left), left).when(want == 1, F.array(F.get(left, F.floor(F.size(left) / 2).cast("int")))).otherwise(even))

    return T.let(first, fill)


def scope_verdict(scope: Column, confidence: Column, reason: Column, matched: Column, known: list[str]) -> Column:
    """struct<scope, decision, errors>: enums and topics checked; doubtful exclusions become uncertain."""
    s, c = F.lower(F.trim(T.blank(scope))), F.lower(F.trim(T.blank(confidence)))
    m = F.array_distinct(F.filter(F.transform(F.coalesce(matched, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))
    good = F.array_intersect(m, F.array(*map(F.lit, known)))
    unknown = F.size(F.array_except(m, F.array(*map(F.lit, known)))) > 0
    errors = T.reasons((~s.isin("in_scope", "out_of_scope", "uncertain"), "scope_decision"), (~c.isin("high", "medium", "low"), "confidence"), (F.trim(T.blank(reason)) == "", "reason"), (unknown & F.when(s == "in_scope", F.size(good) == 0).otherwise(True), "matched_l1_unknown"), ((s == "in_scope") & (F.size(m) == 0), "matched_l1_required"), ((s == "out_of_scope") & (F.size(m) > 0), "matched_l1_must_be_empty"))
    hedged = (s == "out_of_scope") & ((c != "high") | reason.rlike("(?i)可能|也许|或许|一定程度|部分|maybe|perhaps|possibly"))
    final = F.when(F.size(errors) > 0, "invalid").when(hedged, "uncertain").otherwise(s)
    return F.struct(final.alias("scope"), F.when(final == "in_scope", "keep").when(final == "out_of_scope", "drop").otherwise("review").alias("decision"), errors.alias("errors"))


def dictionary_disposition(status: Column, routing: Column, family: Column, head: Column, quality: Column, fit: Column, families: list[str]) -> Column:
    """What happens to a classified dictionary: the first rule that holds."""
    ok = "sample_supported"
    return F.when(status == "technical_failed", "technical_failed").when((status == "other") & (routing == "other"), "other").when(F.coalesce((status != ok) | (routing != ok), F.lit(True)), "review").when(~F.coalesce(family.isin(families), F.lit(False)), "review").when(~F.coalesce(head.isin("inline", "standalone", "both"), F.lit(False)), "review").when(F.coalesce(quality != "no_problem_reported_in_samples", F.lit(True)), "review").when(F.coalesce(fit != "model_considered_compatible", F.lit(True)), "review").otherwise("approved")


def title_repairs(title: Column) -> Column:
    """struct<title, repairs>: index numerals in front, "also known as", and a lone edge parenthesis off, in this order."""
    steps = [("structured_roman_index_prefix", lambda t: F.regexp_extract(t, r"\A[IVXLC]+(?:[-.]\d+)+[.)]?\s+(.+)\z", 1)), ("known_as_prefix", lambda t: F.regexp_extract(t, r"(?i)\A(?:also\s+)?(?:known|referred\s+to)\s+as\s+(.+)\z", 1)), ("unmatched_edge_parenthesis", lambda t: F.when(t.rlike(r"\A[^(]*\)\z"), F.regexp_extract(t, r"\A(.*)\)\z", 1)).when(t.rlike(r"\A\([^)]*\z"), F.regexp_extract(t, r"\A\((.*)\z", 1)).otherwise(""))]
    state = F.struct(F.trim(T.blank(title)).alias("title"), F.array().cast("array<struct<kind:string,original:string,repaired:string>>").alias("repairs"))
    for kind, fn in steps:
        def step(v: Column, kind: str = kind, fn=fn) -> Column:
            new = F.trim(fn(v["title"]))
            hit = (new != "") & (new != v["title"])
            return F.struct(F.when(hit, new).otherwise(v["title"]).alias("title"), F.when(hit, F.concat(v["repairs"], F.array(F.struct(F.lit(kind).alias("kind"), v["title"].alias("original"), new.alias("repaired"))))).otherwise(v["repairs"]).alias("repairs"))

        state = T.let(state, _once(step))
    return state


def _once(step):
    return lambda v: step(v)


def append_note(text: Column, note: Column) -> Column:
    """The note behind the text, unless it is empty or in it already."""
    t, n = F.trim(T.blank(text)), F.trim(F.regexp_replace(T.blank(note), r"(?U)\s+", " "))
    return F.when((n == "") | F.contains(t, n), t).otherwise(F.trim(F.concat(t, F.lit(" "), n)))


def bilingual_pairs(lines: DataFrame, ident: str = "doc_id") -> DataFrame:
    """English and Chinese of one line, or of two lines on end: (id, line_no, en, zh, before, after), with how many other
    pairs stand within 60 lines on either side; a field is moved only with two on each."""
    t = F.trim("line")
    en, zh = r"[A-Za-z][A-Za-z ,.'()/-]{1,80}", r"[一-鿿][一-鿿，、（）()·]{0,40}"
    w = W.partitionBy(ident).orderBy("line_no")
    d = lines.where(t != "").withColumn("_t", t).withColumn("_next", F.lead(t).over(w))
    inline, two = F.col("_t").rlike(rf"\A{en}\s+{zh}\z"), F.col("_t").rlike(rf"\A{en}\z") & F.col("_next").rlike(rf"\A{zh}\z")
    p = d.where(inline | two).withColumn("en", F.when(inline, F.trim(F.regexp_extract("_t", rf"\A({en})\s+{zh}\z", 1))).otherwise(F.col("_t"))).withColumn("zh", F.when(inline, F.regexp_extract("_t", rf"\A{en}\s+({zh})\z", 1)).otherwise(F.col("_next")))
    near = W.partitionBy(ident).orderBy("line_no")
    return p.select(ident, "line_no", "en", "zh", F.count("*").over(near.rangeBetween(-60, -1)).alias("before"), F.count("*").over(near.rangeBetween(1, 60)).alias("after"))


def entry_candidates(lines: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Lines that may be dictionary entries: family, score, and enough text behind those that stand alone."""
    t = F.trim("line")
    clean = F.trim(F.regexp_replace(t, r"^#{1,6}\s*|\*\*", ""))
    w = W.partitionBy(ident).orderBy("line_no")
    prev, nxt = F.trim(F.coalesce(F.lag("line").over(w), F.lit(""))), F.trim(F.coalesce(F.lead("line").over(w), F.lit("")))
    behind = F.length(F.concat(*[F.coalesce(F.lead("line", k).over(w), F.lit("")) for k in range(1, 9)]))
    skip = (F.length(clean) < 2) | clean.rlike(r"(?i)^(?:contents|table of contents|references|bibliography|further reading|see also|index|目录|参考文献|索引|目次|作者简介)\b") | clean.rlike(r"\.{3,}|…{2,}") | clean.isin("原文", "鉴赏", "赏析", "注释", "参考文献")
    head = t.rlike(r"^#{1,6}\s+\S") & (F.length(clean) < 220)
    family = F.when(head, "heading").when(t.rlike(r"^\*\*[^*]{2,140}\*\*"), "bold_inline").when(t.rlike(r"^[A-Z][A-Z ,()\-’‘]{2,110}[.:] ?\S"), "capital_inline").when(t.rlike(r"^[一-鿿]{2,18}\s+\S") & (F.length(t) > 50), "chinese_inline").when(F.length(clean).between(3, 99) & (F.col("line_no") > 1) & (prev == "") & (nxt == "") & ~clean.rlike(r"[.!?。！？;；]\z"), "plain_short")
    score = F.when(head, 3 + F.when((F.length(clean) > 4) & (clean == F.upper(clean)) & clean.rlike("[A-Z]"), 2).otherwise(0) + F.when(clean.rlike(r"^\d+(?:\.\d+){2,}\s"), 2).otherwise(0)).when(family.isin("bold_inline", "capital_inline"), 4).when(family == "chinese_inline", 2).otherwise(1)
    d = lines.withColumn("family", F.when(~skip, family)).withColumn("score", score).withColumn("_behind", behind)
    return d.where(F.col("family").isNotNull() & (F.col("family").endswith("inline") | (F.col("_behind") > 30))).drop("_behind")
