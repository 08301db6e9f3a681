"""Spans, evidence and records: interval arithmetic, literal checks, candidates, records, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

SPANS = "array<struct<start:int,end:int>>"


def render(text: Column, spans: Column, joiner: str = "\n\n") -> Column:
    """The text of half-open spans, joined; with the spans it can be made again, so no place per character is kept."""
    return F.array_join(F.transform(spans, lambda s: F.substr(text, s["start"] + 1, s["end"] - s["start"])), joiner)


def subtract(spans: Column, removals: Column) -> Column:
    """Ordered spans less others."""
    def cut(pieces: Column, r: Column) -> Column:
        parts = F.transform(pieces, lambda p: F.filter(F.array(F.struct(p["start"].alias("start"), F.least(p["end"], r["start"]).alias("end")), F.struct(F.greatest(p["start"], r["end"]).alias("start"), p["end"].alias("end"))), lambda x: x["start"] < x["end"]))
        whole = F.transform(pieces, lambda p: F.array(F.struct(p["start"].alias("start"), p["end"].alias("end"))))
        met = F.transform(F.arrays_zip(pieces.alias("p"), parts.alias("a"), whole.alias("b")), lambda z: F.when((r["end"] <= z["p"]["start"]) | (r["start"] >= z["p"]["end"]), z["b"]).otherwise(z["a"]))
        return F.flatten(met).cast(SPANS)

    return F.aggregate(removals, spans.cast(SPANS), cut)


def literal_places(text: Column, quote: Column) -> Column:
    """How often a quote stands literally in a text, without overlap, and where it first does (0-based; -1 for nowhere)."""
    n = F.size(F.split(text, F.concat(F.lit(r"\Q"), quote, F.lit(r"\E")))) - 1
    return F.struct(F.when(quote == "", 0).otherwise(n).alias("n"), (F.position(quote, text) - 1).alias("first"))


def anchored(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """entries(doc_id, entry_no, quote, nth) with start, end and a problem: not_found, or ambiguous where the quote stands in
    its text several times and no number says which."""
    j = entries.join(docs.select("doc_id", F.col("text").alias("_text")), "doc_id")
    at = literal_places(F.col("_text"), F.col("quote"))
    j = j.withColumn("_at", at)
    place = F.when(F.col("nth").isNull(), F.col("_at.first")).otherwise(_nth(F.col("_text"), F.col("quote"), F.col("nth")))
    problem = F.when((F.col("_at.n") == 0) | (place < 0), "not_found").when(F.col("nth").isNull() & (F.col("_at.n") > 1), "ambiguous")
    return j.withColumn("start", F.when(problem.isNull(), place)).withColumn("end", F.when(problem.isNull(), place + F.length("quote"))).withColumn("problem", problem).drop("_text", "_at")


def _nth(text: Column, quote: Column, n: Column) -> Column:
    parts = F.split(text, F.concat(F.lit(r"\Q"), quote, F.lit(r"\E")))
    before = F.aggregate(F.slice(parts, F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda a, p: a + F.length(p))
    return F.when((n >= 1) & (F.size(parts) > n), before + (n - 1) * F.length(quote)).otherwise(-1)


def ordered_entries(entries: DataFrame) -> DataFrame:
    """Adds ``problem``: entries (doc_id, entry_no, start, end, name_start, name_end) that go back in the text, overlap one
    before, or whose name lies outside; and ``body_end``: the start of the next entry's head."""
    w = W.partitionBy("doc_id").orderBy("entry_no")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    p = F.when(F.col("start") < F.max("start").over(before), "out_of_order").when(F.col("start") < F.max("end").over(before), "overlap").when((F.col("name_start") < F.col("start")) | (F.col("name_end") > F.col("end")), "name_outside_head")
    return entries.withColumn("problem", p).withColumn("body_end", F.lead("start").over(w))


def definition_guard(keep: Column, text: Column, role: Column, needs_prior: Column, evidence: Column, dependent: str = r"(?i)\A(?:it|this|these|those|they|such|其|此|该|这|上述)\b") -> Column:
    """Whether a definition may stay: its role, no need of what came before, a literal quote, no dependent opening."""
    ok = (role == "definition") & ~F.coalesce(needs_prior, F.lit(True)) & (F.trim(T.blank(evidence)) != "") & F.contains(T.blank(text), T.blank(evidence)) & ~T.blank(text).rlike(dependent)
    return keep & F.coalesce(ok, F.lit(False))


def entry_vote(decision: Column, kind: Column, complete: Column, evidence_found: Column) -> Column:
    """A kept entry needs verified evidence and must be independent with a complete name."""
    kinds = ["independent", "subsection", "index", "resource_directory", "running_header", "uncertain"]
    keep = decision == "keep"
    return F.when(keep & (~evidence_found | ~F.coalesce(kind.isin(kinds), F.lit(False))), "review").when(keep & ((kind == "uncertain") | complete.isNull()), "review").when(keep & ((kind != "independent") | ~complete), "drop").otherwise(decision)


def structural_reject(head: Column, heading: Column, body: Column) -> Column:
    """Entries that are none: numbered passages, bare see-references, unreadable heads."""
    h, line = F.trim(T.blank(head)), F.trim(T.blank(heading))
    see = F.regexp_extract(line, r"(?i)\.\s+(See\s+\S.+)\z", 1)
    lines = F.filter(F.transform(F.split(T.blank(body), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    bad = F.length(h) - F.length(F.replace(h, F.lit("�"), F.lit("")))
    return T.first_reason((h.rlike(r"\A[IVXLCDM]{2,9}\z") & F.startswith(line, h) & F.substr(line, F.length(h) + 1, F.length(line)).rlike(r"(?i)\A[.)]\s+(?:Also|Whereas|It is)\b"), "numbered_source_passage"), (F.startswith(F.lower(line), F.lower(F.concat(h, F.lit(".")))) & (see != "") & (F.get(lines, F.lit(0)) == see) & (F.size(lines) > 1), "index_see_only"), ((bad > 0) & (bad >= F.greatest(F.lit(2), F.floor(F.length(h) / 4))), "unreadable_head"))


def dependent_subheading(head: Column, heading: Column, previous: Column, body: Column) -> Column:
    """A sub-heading below long prose whose text does not name it."""
    h = F.trim(T.blank(head))
    marked = F.lower(F.regexp_replace(F.trim(T.blank(heading)), r"\A#{2,6}\s+", "")) == F.lower(h)
    return (h != "") & marked & T.blank(heading).rlike(r"\A\s*#{2,6}\s") & (F.length(F.trim(T.blank(previous))) >= 120) & ~T.blank(previous).rlike(r"\A\s*#") & (F.trim(T.blank(body)) != "") & ~F.contains(F.lower(F.substring(F.trim(T.blank(body)), 1, 300)), F.lower(h))


def noun_name(term: Column, generic: list[str] = ("方法", "内容", "步骤", "问题")) -> Column:
    """Whether a list item's opening can be a name: length, no verbs of telling, no sentence marks. Without a part-of-speech
    tagger at hand, Chinese terms are judged by these signs alone."""
    t = F.trim(T.blank(term))
    return F.length(t).between(2, 20) & ~t.isin(*generic) & ~t.rlike(r"[。！？；：:;!?\d]|是指|指的是|包括|应当|必须|不得|可以|能够") & F.when(t.rlike("[一-鿿]"), ~t.rlike("^(?:进行|开展|做好|加强|提高|确保|使用|采用)")).otherwise(t.rlike(r"\A[A-Za-z]+(?:[ -][A-Za-z]+){0,5}\z") & ~t.rlike(r"(?i)\b(?:is|are|has|to|and then|before|after)\b"))


def layout_verdict(evidence: DataFrame, lines: DataFrame) -> DataFrame:
    """(book, class, valid): evidence(book, class, line_id, quote, role) checked against lines(book, window, line_id, text):
    quotes literal, the roles that the class needs, and for the main class two windows that share no line."""
    e = evidence.join(lines, ["book", "line_id"]).where(F.contains("text", F.col("quote")) & (F.trim("quote") != ""))
    has = lambda *r: [F.coalesce(F.bool_or(F.col("role").isin(*r)), F.lit(False)).alias("_" + r[0])]
    two = lambda c: F.coalesce(F.min(c) != F.max(c), F.lit(False))
    roles = [x for r in (["heading"], ["prose"], ["table_header"], ["table_row"], ["image"], ["caption", "image_reference"]) for x in has(*r)]
    g = e.groupBy("book", "class").agg(*roles, two(F.when(F.col("role") == "prose", F.col("line_id"))).alias("_proses"), two(F.when(F.col("role").isin("step", "rule"), F.col("line_id"))).alias("_steps"), two(F.col("window")).alias("windows_ok"))
    ok = F.when(F.col("class") == "N1", F.col("_heading") & F.col("_prose")).when(F.col("class") == "N2", F.col("_proses")).when(F.col("class") == "N3", F.col("_steps")).when(F.col("class") == "N4", F.col("_table_header") & F.col("_table_row")).when(F.col("class") == "N5", F.col("_image") & F.col("_caption"))
    return g.select("book", "class", F.coalesce(ok, F.lit(False)).alias("roles_ok"), "windows_ok")


def source_language_kept(output: Column, evidence: Column) -> Column:
    """False where the evidence has Latin prose and no CJK, but the output has CJK."""
    prose = F.regexp_replace(T.blank(evidence), r"<[^>]*>|\$[^$]*\$|`[^`]*`", " ")
    latin = (F.regexp_count(prose, F.lit(r"(?U)\b[A-Za-z]{2,}\b")) >= 3) & ~T.blank(evidence).rlike(f"[{T.CJK}]")
    return ~(latin & T.blank(output).rlike(f"[{T.CJK}]"))


def aliases_supported(aliases: Column, evidence: Column) -> Column:
    """Every alias literally in the evidence, white space, case and single-letter subscripts in formulas aside."""
    form = lambda c: F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(T.blank(c), r"\$\s*([A-Za-z])_\s*\{([A-Za-z0-9]+)\}\s*\$\s*,?", "$1$2 "), r"\$\s*([A-Za-z])_\s*([A-Za-z0-9])\s*\$\s*,?", "$1$2 "), r"(?U)\s+", ""))
    return F.forall(aliases, lambda a: (F.trim(a) != "") & F.contains(form(evidence), form(a)))


def ids_in_prose(prose: Column, known: Column, source: Column) -> Column:
    """Internal unit ids (u and six digits) in prose that the source itself does not hold."""
    return F.filter(F.array_distinct(F.regexp_extract_all(T.blank(prose), F.lit(r"\bu[0-9]{6}\b"), F.lit(0))), lambda i: F.array_contains(known, i) & ~F.contains(T.blank(source), i))


def owned_evidence(spans: DataFrame) -> DataFrame:
    """Equal spans once, with all candidates that own them: (unit_id, start, end, owners)."""
    return spans.groupBy("unit_id", "start", "end").agg(F.array_sort(F.collect_set("candidate_id")).alias("owners"))


def records(members: DataFrame) -> DataFrame:
    """Records of groups: members(book_id, run_id, group_id, pos, candidate_id, scope, issues, definition). The id is a hash of
    book, run and sorted members; scopes and issues once each in order; ``definition_missing`` goes where one is defined."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "candidate_id", "scope", "issues")))
    g = members.groupBy("book_id", "run_id", "group_id").agg(rows.alias("m"), F.max("definition").alias("definition"))
    ids = F.transform("m", lambda x: x["candidate_id"])
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    seed = F.concat(F.lit("["), q(F.col("book_id")), F.lit(","), q(F.col("run_id")), F.lit(",["), F.array_join(F.transform(F.array_sort(ids), q), ","), F.lit("]]"))
    issues = F.array_distinct(F.flatten(F.transform("m", lambda x: x["issues"])))
    return g.select(F.concat(F.lit("r"), F.substring(F.sha2(seed, 256), 1, 20)).alias("record_id"), "book_id", "run_id", "group_id", ids.alias("candidate_ids"), F.array_distinct(F.flatten(F.transform("m", lambda x: x["scope"]))).alias("scope"), F.when(F.col("definition").isNotNull(), F.filter(issues, lambda i: F.trim(F.split(i, ":")[0]) != "definition_missing")).otherwise(issues).alias("issues"), "definition")


def verification_reason(definition: Column, confidence: Column, identity: Column, percent: int = 10) -> Column:
    """Why a record is checked again: a confidence below high, or a stable sample of the high ones (of the first 48 bits of a
    hash, where a 256-bit remainder would need Python)."""
    rank = F.conv(F.substring(F.sha2(identity, 256), 1, 12), 16, 10).cast("long") % 100
    return F.when(definition.isNull(), None).when(F.coalesce(confidence != "high", F.lit(True)), F.concat(F.lit("confidence_"), F.coalesce(confidence, F.lit("unknown")))).when(rank < percent, "high_confidence_sample")


def group_audit(rows: DataFrame, groups: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """rows(candidate_id, members, reviewed) whose members are not exactly one group's of groups(member, group_id, members,
    status); an unreviewed row may only stand alone.

    Lists that many rows share are given once, as lists(list_id, member), with ``list_id`` instead of ``members`` in rows and
    no ``members`` in groups: no row then carries a list, and lists are held against groups member by member."""
    if lists is None:
        named = lambda d, n: d.withColumn(n, F.sha2(F.to_json(F.array_sort("members"), {"ignoreNullFields": "false"}), 256))
        rows, own = named(rows, "list_id"), named(groups, "group_id")
        spread = lambda d, n: d.select(n, "members").dropDuplicates([n]).select(n, F.explode("members").alias("member"))
        lists, sets = spread(rows, "list_id"), spread(own, "group_id")
    else:
        own, sets = groups, groups
    times = lambda d, n: d.groupBy(n, "member").agg(F.count("*").alias("times"))
    asked, known = times(lists, "list_id"), times(sets, "group_id")
    sizes = lambda d, n, size: d.groupBy(n).agg(F.sum("times").alias(size))
    common = asked.join(known, ["member", "times"]).groupBy("list_id", "group_id").agg(F.sum("times").alias("common"))
    equal = common.join(sizes(known, "group_id", "own_size"), "group_id").where("common = own_size").drop("own_size")

    of = own.select(F.col("member").alias("candidate_id"), "group_id", "status")
    j = rows.join(of, "candidate_id", "left").withColumn("_n", F.count("*").over(W.partitionBy("candidate_id")))
    j = j.join(asked.select("list_id", F.col("member").alias("candidate_id"), F.lit(True).alias("listed")), ["list_id", "candidate_id"], "left")
    j = j.join(sizes(asked, "list_id", "size"), "list_id", "left").join(equal, ["list_id", "group_id"], "left")
    alone, same = F.coalesce("size", F.lit(0)) == 1, F.coalesce(F.col("common") == F.col("size"), F.lit(False))
    p = T.first_reason((F.col("listed").isNull(), "not_a_member"), (~F.col("reviewed") & ~alone, "unconfirmed_group"), (F.col("reviewed") & F.col("group_id").isNull(), "missing_group"), (F.col("reviewed") & (F.col("_n") > 1), "several_groups"), (F.col("reviewed") & ~same, "other_members"), (F.col("reviewed") & (F.col("status") != "same") & ~alone, "uncertain_group_expanded"))
    return j.withColumn("problem", p).where("problem is not null").select("candidate_id", "problem")


def retained_units(units: DataFrame, actions: DataFrame) -> DataFrame:
    """Units less those that an action excludes; units without one are kept by default: (doc_id, unit_no, why)."""
    a = actions.select("doc_id", "unit_no", "action").distinct()
    j = units.join(a, ["doc_id", "unit_no"], "left")
    return j.where(F.coalesce("action", F.lit("retain")) != "exclude").select("doc_id", "unit_no", F.coalesce("action", F.lit("default_retain")).alias("why"))


def rule_only_units(units: DataFrame, parsed: DataFrame, names: DataFrame) -> DataFrame:
    """Units whose every non-blank line was parsed to an entry of a nominated name: they need no further reading.

    units: doc_id, unit_no, line_no, line; parsed: doc_id, line_no, name; names: name."""
    good = parsed.join(names.select("name").distinct(), "name", "left_semi").select("doc_id", "line_no").distinct().withColumn("_ok", F.lit(1))
    j = units.where(F.trim("line") != "").join(good, ["doc_id", "line_no"], "left")
    return j.groupBy("doc_id", "unit_no").agg(F.count("*").alias("lines"), F.count("_ok").alias("parsed")).where("lines = parsed")


def negative_evidence(rule: Column, evidence: Column, terms: list[str]) -> Column:
    """The evidence (240 characters) that speaks against a leaf that a rule forced; else null."""
    text = F.array_join(evidence, " ")
    hit = F.coalesce(rule, F.lit("")).rlike(r"\A(?:p2_|taxonomy)") & F.lower(text).rlike("|".join(T.term_pattern([t]) for t in terms))
    return F.when(hit, F.substring(text, 1, 240))


def frozen(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows whose content hash changed, or that are on one side only."""
    h = lambda d, n: d.select(key, F.sha2(F.to_json(F.struct(*[F.col(c) for c in d.columns if c != key])), 256).alias(n))
    return h(before, "a").join(h(after, "b"), key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))


def routed_extractors(books: DataFrame, extractors: dict[str, str], cls: str = "class", status: str = "status") -> DataFrame:
    """Adds ``extractor``: by class for classified books; others say why not."""
    m = F.create_map(*[F.lit(x) for kv in extractors.items() for x in kv])
    return books.withColumn("extractor", F.when(F.col(status) == "classified", F.coalesce(F.element_at(m, F.col(cls)), F.lit("no_extractor"))).otherwise(F.concat(F.lit("skipped:"), F.col(status))))


def persistent_failures(failed: DataFrame, recovered: DataFrame, key: str) -> DataFrame:
    """Failures that no retry recovered, to be dropped with their evidence."""
    return failed.join(recovered.select(key).distinct(), key, "left_anti").withColumn("decision", F.lit("DROP")).withColumn("why", F.lit("technical_failure_after_final_retry"))


def split_tracks(df: DataFrame, col: str, tracks: list[str]) -> dict[str, DataFrame]:
    """One frame per track; a row of any other track is an error."""
    bad = df.where(~F.coalesce(F.col(col).isin(tracks), F.lit(False))).limit(1).collect()
    if bad:
        raise ValueError(f"unknown track: {bad[0][col]}")
    return {t: df.where(F.col(col) == t) for t in tracks}


def qa(df: DataFrame, ident: str, name: str, path: str, required: dict[str, Column]) -> DataFrame:
    """(check, n) of a delivery: schema problems, name errors and suspicions, duplicate names of one node."""
    from .rules import name_checks, schema_problems

    a = schema_problems(df, ident, required).select(F.explode("problems").alias("check"))
    b = df.select(F.explode(F.transform(name_checks(F.col(name)), lambda c: F.concat_ws(":", c["level"], c["code"]))).alias("check"))
    c = df.where(F.trim(T.blank(F.col(name))) != "").groupBy(path, name).count().where("count > 1").select(F.lit("duplicate:name").alias("check"))
    return a.unionByName(b).unionByName(c).groupBy("check").agg(F.count("*").alias("n"))
