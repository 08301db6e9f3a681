"""Rule gates: ordered decisions with reasons and flags, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import text as T

URL = r"(?i)(?:https?://|www\.|ftp://|\b[a-z0-9.-]+\.(?:com|org|net|cn|edu)\b)"
EMAIL = r"\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b"
IMAGE, LINK, TAG = r"!\[[^\]]*]\([^)]*\)", r"\[([^\]]+)]\([^)]*\)", r"</?[A-Za-z][^>]*>"
GARBLED = r"�|锟斤拷|烫烫烫|屯屯屯|ï¿½|Ã.|Â.|â€|\?{4,}"
BULLETS = "·•▪◦◆◇■□●○▲▶▼◀►◄▸▹"
NUMERALS = "一二三四五六七八九十"
ENUMERATION = rf"^\s*(?:[①-⑳]+|[（(](?:\d+|[{NUMERALS}]+|[A-Za-z])[）)]|第\s*[{NUMERALS}百千万零〇0-9]+\s*(?:章|节|篇|部分)[、:：.]?|\d+(?:\.\d+){{0,5}}[、.)）:：]|\d+\s+|[A-Za-z][.)、]\s+|[{NUMERALS}][、.．])\s*"
SCAFFOLD = r"^\s*[【\[]\s*(?:任务引入|任务描述|项目引入|知识准备|学习目标|任务实施|相关知识|案例导入|问题导入)\s*[】\]]\s*[：:]?\s*"
STRUCTURAL = r"(?i)\A(?:目录|前言|序言|绪论|内容简介|参考文献|附录|索引|本章小结|小结|思考题|习题|练习题|复习题|作业题|测试题|词条结构和安排|SEE WEB LINKS|Figure|Table|contents|preface|references|index|exercises?|chapter\s+[A-Z0-9IVXLCDM]+)\z"
LABEL = r"(?i)\A(?:英译|含义|词条\s*\d+(?:\.\d+)*(?:[-—]\d+)?)\z"
FIGURE = rf"(?i)\A(?:(?:图|表)\s*[A-Za-z0-9{NUMERALS}]+(?:[-—.·]\d+)*|(?:fig(?:ure)?|table|plate|photo)\s*[A-Za-z]?\d+)(?:\s|[：:].*)?\z"
EXAMPLE = r"(?i)\A(?:例|例题|example)\s*\d+(?:[-—.]\d+)*\s*\z"
NUMBER = r"(?i)\A[+-]?(?:\d+(?:\.\d+)?|[IVXLCDM]{1,10})\z"
DATE = r"\A(?:18|19|20)\d{2}(?:年|[-/.])?(?:\d{1,2}(?:月|[-/.])?)?(?:\d{1,2}日?)?\z"
COMMAND = r"^(?:请|试|讨论|回答|思考|分析|说明|证明|计算|求解|比较|简述|为什么|为何|如何)"
LAYOUT_REFERENCE = rf"(?i)[（(]?\s*(?:(?:如|见|参见|由|从)\s*)?(?:(?:图|表)\s*[A-Za-z]?[0-9{NUMERALS}]+[A-Za-z]?|\b(?:fig(?:ure)?|table)\b\.?\s*[A-Za-z]?\d+[A-Za-z]?)(?:\s*[-—−.·]\s*[A-Za-z0-9]+)*(?:\s*(?:中|所示|可知))?\s*[）)]?"
TOC_TRAILER = r"(?i)\s*\\\(\s*(?:\\(?:ldots|cdots|dots)\s*)+\\\)\s*\d{1,5}\s*$"


def clean_title(title: Column, max_chars: int = 160, keep_single_letter: bool = False) -> Column:
    """struct<text, flags, reason> of a normalised title: prefixes and markup off, then the first of the rejections that
    holds is the reason, else flags for review."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(title, IMAGE, ""), TAG, ""), LINK, "$1")

    def cut(v: Column) -> Column:
        t = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, r"^\s*#{1,6}\s*", ""), SCAFFOLD, ""), rf"^\s*[{BULLETS}]+\s*", "")
        t = F.regexp_replace(F.regexp_replace(t, ENUMERATION, ""), ENUMERATION, "")
        return F.struct(v.alias("bare"), t.rlike(TOC_TRAILER).alias("toc"), F.regexp_replace(F.regexp_replace(t, TOC_TRAILER, ""), r"^[ \t\r\n:：、\-—]+|[ \t\r\n:：、\-—]+\z", "").alias("t"))

    quoted = T.let(T.let(bare, cut), lambda v: F.struct(v["toc"].alias("toc"), (v["t"] != v["bare"]).alias("prefix"), v["t"].alias("t"), T.outer_quotes_off(v["t"]).alias("q")))
    inner = T.let(quoted, lambda v: F.struct(v["toc"].alias("toc"), v["prefix"].alias("prefix"), (v["q"] != T.strip(v["t"])).alias("unquoted"), v["q"].alias("q"), T.loose_brackets_off(v["q"]).alias("i")))
    parts = T.let(inner, lambda v: F.struct(T.tidy(v["i"]).alias("x"), v["toc"].alias("toc"), v["prefix"].alias("prefix"), v["unquoted"].alias("unquoted"), (v["i"] != v["q"]).alias("unbracketed")))

    def judge(v: Column) -> Column:
        s = v["x"]
        n, tech = F.length(s), T.usable(s)
        label, symbols = s.rlike(LABEL), (T.symbol_ratio(s) > 0.62) & (T.usable(s) < 5)
        formula = s.rlike(r"[$\\_^]")
        sentence = (s.rlike(r"[。！？!?；;]\z") & (n >= 12)) | (s.endswith(".") & (n >= 20) & (F.size(F.split(T.strip(s), r"\s+")) >= 4))
        refers = s.rlike(r"(?i)\b(?:see|refer\s+to)\b")
        overlong, extreme = n > max_chars, n > max(max_chars * 4, 640)
        switches = T.script_switches(s)
        reason = T.first_reason(
            (s == "", "empty_title"), (s.rlike(GARBLED) | s.rlike(rf"([^\w\s{T.CJK}])\1{{4,}}"), "garbled_title"), (s.rlike(rf"\A(?:{URL})\z") | s.rlike(rf"\A(?:{EMAIL})\z"), "url_or_email_title"),
            (~label & s.rlike(STRUCTURAL), "structural_or_metadata_title"), (s.rlike(FIGURE), "figure_or_table_title"), (s.rlike(EXAMPLE), "worked_example_title"), (s.rlike(NUMBER) | s.rlike(DATE), "bare_number_or_date"),
            *(() if keep_single_letter else ((s.rlike(r"\A[A-Za-z]\z"), "single_latin_letter"),)), (extreme, "extremely_overlong_title"), (tech == 0, "no_usable_title_characters"), (symbols & ~formula, "symbol_dominated_title"),
        )
        early = [(v["toc"], "latex_toc_leader_and_page_removed"), (v["prefix"], "title_prefix_removed"), (v["unquoted"], "outer_quotes_removed"), (v["unbracketed"], "unmatched_edge_bracket_removed")]
        late = [
            (label, "extraction_label_requires_model_review"), (overlong & ~extreme, "overlong_title_requires_model_review"), (symbols & formula, "formula_or_symbol_title_requires_model_review"),
            (sentence & refers, "cross_reference_entry_requires_model_review"), (sentence & ~refers, "sentence_like_title_requires_model_review"), (s.rlike(COMMAND) & (n >= 8), "question_or_procedure_title_requires_model_review"),
            (switches >= 4, "mixed_script_requires_model_review"), ((switches >= 8) & (n >= 20), "severely_mixed_script_title_requires_model_review"), (tech <= 1, "very_short_title_requires_model_review"), (s.rlike("[：:].+[：:]"), "multiple_colon_segments_requires_model_review"),
        ]
        # a rejection keeps the flags that were set before it
        after_label = reason.isin("figure_or_table_title", "worked_example_title", "bare_number_or_date", "single_latin_letter", "extremely_overlong_title", "no_usable_title_characters", "symbol_dominated_title")
        after_length = reason.isin("no_usable_title_characters", "symbol_dominated_title")
        kept = T.reasons((label & after_label, late[0][1]), (overlong & ~extreme & after_length, late[1][1]))
        flags = F.concat(T.reasons(*early), F.when(reason.isNull(), T.reasons(*late)).otherwise(kept))
        return F.struct(s.alias("text"), flags.alias("flags"), reason.alias("reason"))

    return T.let(parts, judge)


def record_gate(df: DataFrame, name: str, point: str, max_chars: int = 160) -> DataFrame:
    """Adds ``rule``: struct<status, reason, name, knowledge_point, removed_fields, flags>. A record passes if one of its
    titles does."""
    a, b = T.normalize_text(F.col(name)), T.normalize_text(F.col(point))
    d = df.withColumn("_a", a).withColumn("_b", b)
    d = d.withColumn("_ca", clean_title(F.col("_a"), max_chars)).withColumn("_cb", clean_title(F.col("_b"), max_chars))
    na, nb = F.when(F.col("_ca.reason").isNull(), F.col("_ca.text")).otherwise(""), F.when(F.col("_cb.reason").isNull(), F.col("_cb.text")).otherwise("")
    bad_a, bad_b = (F.col("_a") != "") & F.col("_ca.reason").isNotNull(), (F.col("_b") != "") & F.col("_cb.reason").isNotNull()
    why = F.array_distinct(F.array_compact(F.array(F.when(bad_a, F.col("_ca.reason")), F.when(bad_b, F.col("_cb.reason")))))
    lost = (na == "") & (nb == "")
    reason = F.when(~lost, "rule_pass").when(F.size(why) == 1, F.get(why, F.lit(0))).otherwise("no_valid_title_after_rule_cleanup")
    rule = F.struct(F.when(lost, "rejected").otherwise("pass").alias("status"), reason.alias("reason"), na.alias("name"), nb.alias("knowledge_point"), T.reasons((bad_a, "name"), (bad_b, "knowledge_point")).alias("removed_fields"), F.array_sort(F.array_distinct(F.concat("_ca.flags", "_cb.flags"))).alias("flags"))
    return d.withColumn("rule", rule).drop("_a", "_b", "_ca", "_cb")


def clean_context(c: Column, max_chars: int) -> Column:
    """struct<text, flags> of normalised text: markup and layout references off, cut at a sentence end in the budget's
    second half, else with an ellipsis."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, IMAGE, ""), TAG, ""), LINK, "$1")
    t = T.tidy(F.regexp_replace(F.regexp_replace(t, "[▲▶▼◀►◄▸▹▪◦◆◇■□●○•]", "。"), LAYOUT_REFERENCE, ""))
    t = F.regexp_replace(t, r"(?U)\s+([，。；：！？,.!?;:])", "$1")
    t = T.strip(F.regexp_replace(t, r"(?U)(?:。\s*){2,}", "。"))

    def cut(v: Column) -> Column:
        head = F.substring(v, 1, max_chars)
        end = F.length(F.regexp_extract(head, r"(?s)\A(.*[。！？；.!?;])", 1))
        short = F.when(end - 1 >= max_chars // 2, F.substr(head, F.lit(1), end)).otherwise(F.concat(F.regexp_replace(head, r"(?U)\s+\z", ""), F.lit("…")))
        over = F.length(v) > max_chars if max_chars else F.lit(False)
        return F.struct(F.when(over, short).otherwise(v).alias("text"), T.reasons((v != c, "context_markup_or_layout_reference_removed"), (over, "context_truncated")).alias("flags"))

    return T.let(t, cut)


def clean_model_text(c: Column, max_chars: int = 0) -> Column:
    """A model's title: prefixes and layout references off, marks at the edges off, cut to a number of characters."""
    t = T.compact(F.regexp_replace(F.regexp_replace(T.compact(c), ENUMERATION, ""), LAYOUT_REFERENCE, ""))
    t = F.regexp_replace(t, r"^[ ，。;；:：]+|[ ，。;；:：]+\z", "")
    return F.substring(t, 1, max_chars) if max_chars else t


def metadata_gate(year: Column, file_detail: Column, file_format: Column, language: Column, path: Column, periodical: Column) -> Column:
    """struct<decision, reasons> of a catalogue row."""
    y, lang = T.publication_year(year), F.lower(F.trim(T.blank(language)))
    detail = F.trim(T.blank(file_detail))
    supported = (detail == "非影印版PDF") | ((detail == "") & (F.lower(F.trim(T.blank(file_format))) == "epub"))
    r = T.reasons((y.isNull(), "missing_publicationyear"), (y < 2000, "publicationyear_before_2000"), (~supported, "unsupported_file_type"), (~lang.isin("zh", "en"), "unsupported_metadata_language"), (F.trim(T.blank(path)) == "", "missing_parsed_path"), (periodical, "periodical_source"))
    return F.struct(F.when(F.size(r) > 0, "DROP").otherwise("KEEP").alias("decision"), r.alias("reasons"))


def book_track(title: Column, terms: dict[str, list[str]], masks: list[str], review_terms: list[str]) -> Column:
    """struct<track, decision, kind, evidence>: reference titles by terms (kind -> terms, in order), hits that only stand
    in a masked phrase being false."""
    flat = [(k, term) for k, ts in terms.items() for term in ts]
    pat = lambda term: (rf"\b{term}\b" if term.isascii() else term)
    # a plain search tells most titles off; only where it finds a term its pattern is looked for
    hits = lambda x: F.array_compact(F.array(*[F.when((F.contains(x, F.lit(term)) if term.isalnum() else F.lit(True)) & x.rlike(pat(term)), F.struct(F.lit(k).alias("kind"), F.lit(term).alias("term"))) for k, term in flat]))

    def masked(t: Column) -> Column:
        for m in masks:
            t = F.regexp_replace(t, m, "")
        return t

    def judged(h: Column) -> Column:
        raw, real = h["raw"], h["real"]
        decision = F.when(F.size(raw) == 0, "no_hit").when(F.size(real) == 0, "false_positive").when(h["review"], "review").otherwise("strict_keep")
        none = F.size(real) == 0
        shown = F.when(none, raw).otherwise(real)
        return F.struct(F.when(none, "other").otherwise("reference").alias("track"), decision.alias("decision"), F.when(none, "").otherwise(F.get(real, F.lit(0))["kind"]).alias("kind"), F.array_distinct(F.transform(shown, lambda x: x["term"])).alias("evidence"))

    def found(t: Column) -> Column:
        raw = hits(t)
        review = F.lit(False)
        for term in review_terms:
            review |= F.contains(t, F.lit(term))
        return T.let(raw, lambda raw: F.struct(raw.alias("raw"), F.when(F.size(raw) == 0, raw).otherwise(T.let(masked(t), hits)).alias("real"), ((F.size(raw) > 0) & review).alias("review")))

    return T.let(T.let(F.lower(F.trim(T.blank(title))), found), judged)


def important_book(genre: Column, category: Column, usage: Column, audience: Column, priority: list[str], review: list[str]) -> Column:
    g, c, u, a = (F.upper(F.trim(T.blank(x))) for x in (genre, category, usage, audience))
    return F.when(g.isin(priority), "strict_keep").when((c == "KNOWLEDGE_EXPOSITION") & ~g.isin(review), "strict_keep").when(a.isin("ACADEMIC", "PROFESSIONAL") & (F.contains(u, F.lit("PROFESSIONAL_USE")) | F.contains(u, F.lit("TEACHING"))) & ~g.isin(review), "strict_keep").otherwise("review")


def votes(decision: Column, *gates: tuple[Column, str, str]) -> Column:
    """struct<decision, adjusted>: gates (condition, decision it sets, name) in order; a gate that does not change the
    decision, and any after DROP, leaves no mark."""
    state = F.struct(decision.alias("decision"), F.array().cast("array<string>").alias("adjusted"))
    steps = F.array(*[F.struct(c.alias("c"), F.lit(d).alias("d"), F.lit(n).alias("n")) for c, d, n in gates])

    def step(acc: Column, g: Column) -> Column:
        hit = F.coalesce(g["c"], F.lit(False)) & (acc["decision"] != g["d"]) & (acc["decision"] != "DROP")
        return F.struct(F.when(hit, g["d"]).otherwise(acc["decision"]).alias("decision"), F.when(hit, F.concat(acc["adjusted"], F.array(g["n"]))).otherwise(acc["adjusted"]).alias("adjusted"))

    return F.aggregate(steps, state, step)


def name_checks(name: Column) -> Column:
    """array<struct<level, code>>: errors and suspicions of a stored name."""
    n = T.blank(name)
    level = lambda cond, lv, code: F.when(cond, F.struct(F.lit(lv).alias("level"), F.lit(code).alias("code")))
    pairs = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】"}
    closing = {b: a for a, b in pairs.items()}

    def fold(acc: Column, ch: Column) -> Column:
        opened = F.when(ch.isin(*pairs), F.concat(acc, ch))
        last = F.when(F.length(acc) > 0, F.substr(acc, F.length(acc), F.lit(1))).otherwise(F.lit(""))
        match = F.element_at(F.create_map(*[F.lit(x) for kv in closing.items() for x in kv]), ch)
        return opened.when(ch.isin(*closing), F.when(last == match, F.substr(acc, F.lit(1), F.length(acc) - 1)).otherwise(F.concat(acc, F.lit("!")))).otherwise(acc)

    stack = F.aggregate(F.split(n, ""), F.lit(""), fold)
    return F.array_compact(F.array(
        level(n.rlike(r"(?U)^\s|\s\z"), "error", "edge_whitespace"), level(n.rlike(r"(?U)\s{2,}"), "error", "repeated_whitespace"), level(n.rlike(r"[\x00-\x1f\x7f]"), "error", "control_character"),
        level(stack != "", "error", "unbalanced_brackets"), level(F.contains(n, F.lit("�")), "error", "replacement_character"), level(n.rlike(r"^\s*\d+(?:\.\d+)*[.、)）]\s*\S"), "suspect", "number_prefix"), level(n.rlike(r"[,，。;；:：]\s*\z"), "suspect", "trailing_punctuation"),
    ))


def evidence_gate(verdict: Column, evidence: Column, fields: Column, sound: Column) -> Column:
    """The verdict, or ``uncertain`` unless every quote (struct<field, text>) is a literal part of its field and the case
    is sound."""
    literal = F.forall(evidence, lambda e: F.coalesce(F.contains(F.element_at(fields, e["field"]), e["text"]), F.lit(False)) & (e["text"] != ""))
    return F.when(sound & (F.size(evidence) > 0) & literal, verdict).otherwise("uncertain")


def _holding(needle: str):
    return lambda f: F.contains(f, F.lit(needle))


def review_cause(decision: Column, flags: Column, order: list[tuple[str, str]]) -> Column:
    """The label of the first needle, in order, that a flag contains."""
    out = F.when(~decision.isin("review", "error"), "").when(decision == "error", "api_error_after_retries")
    for needle, label in order:
        out = out.when(F.exists(flags, _holding(needle)), label)
    return out.otherwise("model_review_uncertain")


def normalized_result(decision: Column, confidence: Column, relevant: Column, *, field_drop: Column, pair: Column, reversed_: Column, empty: Column, titles_ok: Column, content_ok: Column, odd_name: Column, contract_ok: Column, threshold: float) -> Column:
    """struct<decision, confidence, flags>: the lattice keep > review > drop, each step noted."""
    d = F.when(F.lower(F.trim(decision)).isin("keep", "drop", "review"), F.lower(F.trim(decision))).otherwise("review")
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(confidence.try_cast("double"), F.lit(0.0))))
    start = F.struct(F.when(~F.coalesce(relevant, F.lit(True)), "drop").otherwise(d).alias("decision"), F.array().cast("array<string>").alias("flags"))
    gates = [
        (reversed_, "any", "review", "language_assignment_swapped_by_model"), (field_drop | (pair == "inconsistent"), "force", "drop", "field_drop_or_pair_inconsistent"), (empty, "keep", "drop", "empty_standardized_names"),
        (c < threshold, "keep", "review", "below_confidence_threshold"), (~titles_ok, "keep", "review", "standardized_name_not_grounded_in_source_titles"), (~content_ok, "keep", "review", "standardized_content_not_sufficiently_grounded"),
        (odd_name, "keep", "review", "invalid_name_after_model"), (~contract_ok | ~F.coalesce(relevant, F.lit(False)), "keep", "review", "incomplete_review_contract"),
    ]
    steps = F.array(*[F.struct(F.coalesce(g, F.lit(False)).alias("g"), F.lit(m).alias("m"), F.lit(t).alias("t"), F.lit(n).alias("n")) for g, m, t, n in gates])

    def step(acc: Column, s: Column) -> Column:
        keep = acc["decision"] == "keep"
        noted = s["g"] & ((s["m"] != "keep") | keep)
        moved = s["g"] & ((s["m"] == "force") | keep)
        return F.struct(F.when(moved, s["t"]).otherwise(acc["decision"]).alias("decision"), F.when(noted, F.concat(acc["flags"], F.array(s["n"]))).otherwise(acc["flags"]).alias("flags"))

    return F.aggregate(steps, start, step, lambda a: F.struct(a["decision"].alias("decision"), c.alias("confidence"), F.array_sort(F.array_distinct(a["flags"])).alias("flags")))


def manifest_status(df: DataFrame, ident: str, decision: str, track: str, path: str, subjects: list[str], subject: str) -> DataFrame:
    """Adds ``status`` (accepted, excluded, unresolved) and ``why``: the first rule that holds."""
    n = F.count("*").over(W.partitionBy(ident))
    i = F.trim(T.blank(F.col(ident)))
    why = T.first_reason((i == "", "missing_identifier"), (~i.rlike(r"\A[A-Za-z0-9_-]+\z"), "invalid_identifier"), (n > 1, "duplicate_identifier"), (F.col(decision) == "DROP", "decision_drop"), (F.col(decision) == "REVIEW", "decision_review"), (~F.col(subject).isin(subjects), "unknown_subject"), (F.trim(T.blank(F.col(track))) == "", "missing_track"), (F.trim(T.blank(F.col(path))) == "", "path_not_found"), otherwise="accepted")
    status = F.when(why == "accepted", "accepted").when(why.isin("decision_drop"), "excluded").otherwise("unresolved")
    return df.withColumn("why", why).withColumn("status", status)


def combine_votes(first: Column, second: Column) -> Column:
    """Two reviews: the second only counts where the first is unreasonable; disagreement is uncertain."""
    return F.when(first == "reasonable", "reasonable").when(second.isNull(), "pending").when(first == second, first).otherwise("uncertain")


def language_move(zh: Column, en: Column) -> Column:
    """struct<zh, en, move>: a text in the wrong language's field moves to an empty one, or both change places."""
    cjk, latin = f"[{T.CJK}]", "[A-Za-z]"
    z, e = T.blank(zh), T.blank(en)
    z_en, e_zh = z.rlike(latin) & ~z.rlike(cjk), e.rlike(cjk) & ~e.rlike(latin)
    out = lambda a, b, m: F.struct(a.alias("zh"), b.alias("en"), F.lit(m).alias("move"))
    return F.when(z_en & (e == ""), out(F.lit(""), z, "zh->en")).when((z == "") & e_zh, out(e, F.lit(""), "en->zh")).when(z_en & e_zh, out(e, z, "swap:zh,en")).otherwise(out(z, e, ""))


def language_reversed(name: Column, point: Column) -> Column:
    return (T.script_class(T.blank(name)) == "latin") & (T.script_class(T.blank(point)) == "cjk")


def standard_record(df: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Each field from the first of its columns that is there and not empty; all other columns stay."""
    new = {f: F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in cols if c in df.columns], F.lit("")) for f, cols in fields.items()}
    return df.withColumns(new)


def schema_problems(df: DataFrame, ident: str, required: dict[str, Column]) -> DataFrame:
    """(id, problems): missing or unsuitable fields, and repeated ids."""
    n = F.count("*").over(W.partitionBy(ident))
    p = T.reasons((F.col(ident).isNull(), f"missing:{ident}"), *[(F.col(f).isNull(), f"missing:{f}") for f in required], *[(~F.coalesce(ok, F.lit(True)), f"invalid:{f}") for f, ok in required.items()], (n > 1, f"duplicate:{ident}"))
    return df.withColumn("problems", p).where(F.size("problems") > 0).select(ident, "problems")


def title_grounding(out: Column, sources: list[Column]) -> Column:
    """How an output title follows from its sources: the first source that supports it."""
    k = T.compact_key(out)
    rule = None
    for src in sources:
        mixed = src.rlike(f"[{T.CJK}]") & src.rlike("[A-Za-z]")
        base = F.regexp_extract(src, r"\A(.*?)\s*[（(][^（）()]*[）)]\s*\z", 1)
        for cond, name in ((k == T.compact_key(src), "exact_or_safe_normalization"), ((k != "") & mixed & F.contains(T.compact_key(src), k), "bilingual_field_split"), ((base != "") & (k == T.compact_key(base)), "parenthetical_removed")):
            rule = F.when(cond, name) if rule is None else rule.when(cond, name)
    return F.when(T.blank(out) == "", "empty").otherwise(rule.otherwise("unsupported_title_rewrite"))


def restorable(*, relevant: Column, language_flag: Column, other_flags: Column, pair: Column, confidence: Column, field_ok: Column, reason_ok: Column, other_problem: Column, name: Column, point: Column, tag: Column) -> Column:
    """Why a dropped record cannot be restored as a mere language case; null if it can."""
    n = F.trim(T.blank(name))
    english = n.rlike("[A-Za-z]") & ~n.rlike(f"[{T.CJK}]")
    count = lambda ch: F.length(n) - F.length(F.replace(n, F.lit(ch), F.lit("")))
    return T.first_reason(
        (~F.coalesce(relevant, F.lit(False)), "subject_not_confirmed"), (~language_flag, "not_language_candidate"), (other_flags, "additional_or_unrecognized_flags"), (pair != "not_applicable", "pair_not_confirmed"), (F.coalesce(confidence, F.lit(0.0)) < 0.8, "confidence_below_existing_threshold"),
        (~field_ok, "field_contract_not_confirmed"), (~reason_ok, "language_only_reason_not_confirmed"), (other_problem, "other_problem_in_reason"), (~english | (F.trim(T.blank(point)) != ""), "cannot_move_name_without_conflict"),
        ((F.length(n) == 1) | (F.length(n) > 160) | n.rlike(r"(?i)https?://|www\.|@|[�\x00-\x08]"), "invalid_title_format"), ((count("(") != count(")")) | (count("[") != count("]")) | (count("{") != count("}")), "unbalanced_title_brackets"), (T.blank(tag) == "", "missing_subject_tag"),
    )


def delivery_exclusions(records: DataFrame, errors: DataFrame, incomplete: list[str]) -> DataFrame:
    """Adds ``reasons``: no definition, incomplete issue codes, and errors linked by record, candidate or chunk prefix.

    records: record_id, definition, issues (array), candidate_ids (array); errors: record_id, candidate_ids, chunk_id, issue."""
    codes = F.transform("issues", lambda i: F.trim(F.split(i, ":")[0]))
    own = F.array_union(F.when(F.trim(T.blank(F.col("definition"))) == "", F.array(F.lit("definition_missing"))).otherwise(F.array().cast("array<string>")), F.filter(codes, lambda c: c.isin(incomplete) | c.rlike("_(failed|unreviewed|deferred)$")))
    keys = records.select("record_id", F.explode_outer("candidate_ids").alias("cand"))
    by_record = errors.where("record_id is not null").select("record_id", "issue")
    by_cand = keys.join(errors.select(F.explode("candidate_ids").alias("cand"), "issue"), "cand").select("record_id", "issue")
    chunk = keys.withColumn("chunk_id", F.regexp_extract("cand", r"\A(.*)-[^-]*\z", 1)).where("chunk_id <> ''")
    by_chunk = chunk.join(errors.where("chunk_id is not null").select("chunk_id", "issue"), "chunk_id").select("record_id", "issue")
    linked = by_record.unionByName(by_cand).unionByName(by_chunk).groupBy("record_id").agg(F.collect_set(F.concat(F.lit("linked_pipeline_error:"), "issue")).alias("_linked"))
    return records.join(linked, "record_id", "left").withColumn("reasons", F.array_sort(F.array_distinct(F.concat(own, F.coalesce("_linked", F.array().cast("array<string>")))))).drop("_linked")


def label_coverage(labels: Column, n: int) -> Column:
    """Whether labels (array<struct<no, ...>>) cover 1..n exactly once."""
    return F.array_sort(F.transform(labels, lambda x: x["no"])) == F.sequence(F.lit(1), F.lit(n))


def ordered_parts(text: Column, anchor: Column) -> Column:
    """Whether the parts of an anchor (cut at ellipses) stand in the text in order, white space aside."""
    t = F.regexp_replace(T.blank(text), r"(?U)\s+", "")
    parts = F.filter(F.split(F.regexp_replace(T.blank(anchor), r"(?U)\s+", ""), r"…+|\.{3,}"), lambda p: p != "")
    rest = lambda pos: F.substr(t, pos, F.length(t))
    end = F.aggregate(parts, F.lit(1), lambda pos, p: F.when((pos > 0) & (F.position(p, rest(pos)) > 0), pos - 1 + F.position(p, rest(pos)) + F.length(p)).otherwise(F.lit(0)))
    return (F.size(parts) > 0) & (end > 0)


def agreement(df: DataFrame, part: str, machine: str, human: str) -> DataFrame:
    """Per part and overall: of the machine's passes how many people approve, of people's how many it passes, and how many
    approved ones it does not drop, in percent."""
    m, h = F.col(machine) == "PASS", F.col(human) == "PASS"
    g = df.withColumn("_p", F.explode(F.array(F.col(part), F.lit("overall")))).groupBy(F.col("_p").alias(part)).agg(F.count("*").alias("n"), F.count_if(m & h).alias("both"), F.count_if(m).alias("machine_pass"), F.count_if(h).alias("human_pass"), F.count_if(h & (F.col(machine) != "DROP")).alias("not_dropped"))
    rate = lambda a, b: F.when(F.col(b) > 0, F.bround(100.0 * F.col(a) / F.col(b), 2))
    return g.select(part, "n", rate("both", "machine_pass").alias("approval"), rate("both", "human_pass").alias("recall"), rate("not_dropped", "human_pass").alias("not_drop"))


def family_vote(entries: DataFrame, ident: str, family: str, zone: str, anchor: str, share: float = 0.7) -> DataFrame:
    """The family that has at least ``share`` of a book's entries, in two zones and with two anchors at least; else null."""
    g = entries.groupBy(ident, family).agg(F.count("*").alias("n"), F.count_distinct(zone).alias("zones"), F.count_distinct(anchor).alias("anchors"))
    t = g.groupBy(ident).agg(F.sum("n").alias("all"), F.max_by(F.struct(family, "n", "zones", "anchors"), F.struct("n", family)).alias("m"))
    ok = (F.col("m.n") >= share * F.col("all")) & (F.col("m.zones") >= 2) & (F.col("m.anchors") >= 2)
    return t.select(ident, F.when(ok, F.col(f"m.{family}")).alias(family), "all")


def shared_budget(fields: list[Column], total: int) -> Column:
    """struct<parts, truncated>: fields in order take from one character budget."""
    left, parts, cut = F.lit(total), [], F.lit(False)
    for f in fields:
        v = T.blank(f)
        take = F.substr(v, F.lit(1), F.greatest(left, F.lit(0)))
        parts.append(take)
        cut |= F.length(v) > F.length(take)
        left = left - F.length(take)
    return F.struct(F.array(*parts).alias("parts"), cut.alias("truncated"))
