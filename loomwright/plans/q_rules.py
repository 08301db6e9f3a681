"""Rule gates and verdicts over the driver's tables."""

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import rules as R
from .registry import query, table


@query("""
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 1990 ELSE year(o_orderdate) + 20 END AS y, o_orderstatus = 'F' AS pdf, o_orderstatus = 'O' AND o_orderkey % 2 = 0 AS epub, ['zh','en','fr'][o_custkey % 3 + 1] AS lang, o_orderkey % 7 = 0 AS nopath, o_orderpriority LIKE '1%' AS per FROM orders)
SELECT o_orderkey, CASE WHEN r = '' THEN 'KEEP' ELSE 'DROP' END AS decision, r AS reasons FROM (SELECT o_orderkey, array_to_string(list_filter([CASE WHEN y IS NULL THEN 'missing_publicationyear' END, CASE WHEN y < 2000 THEN 'publicationyear_before_2000' END, CASE WHEN NOT (pdf OR epub) THEN 'unsupported_file_type' END,
 CASE WHEN lang = 'fr' THEN 'unsupported_metadata_language' END, CASE WHEN nopath THEN 'missing_parsed_path' END, CASE WHEN per THEN 'periodical_source' END], lambda v: v IS NOT NULL), '|') AS r FROM x)""")
def metadata_hard_gate(s, d):
    k = F.col("o_orderkey")
    year = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "c1990").otherwise((F.year("o_orderdate") + 20).cast("string"))
    lang = F.element_at(F.array(F.lit("zh"), F.lit("EN "), F.lit("fr")), (F.col("o_custkey") % 3 + 1).cast("int"))
    g = R.metadata_gate(year, F.when(F.col("o_orderstatus") == "F", "非影印版PDF").otherwise(""), F.when((F.col("o_orderstatus") == "O") & (k % 2 == 0), "EPUB").otherwise("mobi"), lang, F.when(k % 7 == 0, " ").otherwise("p"), F.col("o_orderpriority").startswith("1"))
    return table(s, d, "orders").select("o_orderkey", g.alias("g")).select("o_orderkey", "g.decision", F.array_join("g.reasons", "|").alias("reasons"))


#: Terms of reference titles, by kind (fixed values).
TERMS = {"辞海": ["辞海"], "词典/辞典": ["词典", "辞典", "大词典", "大辞典", "dictionary", "lexicon"], "百科全书": ["百科全书", "大百科全书", "百科", "encyclopedia", "encyclopaedia"], "图典/辞书": ["图典", "辞书", "glossary"], "术语/名词/词汇": ["术语", "名词", "词汇", "terminology", "vocabulary", "nomenclature"]}
MASKS = ["图典型", r"\bdictionary\s+learning\b"]
REVIEW = ["习题", "试题", "练习", "考试", "考研", "学习指导", "复习", "题解", "名词解释", "翻译研究", "术语研究", "词典研究", "辞典研究", "编纂研究", "小百科", "普及读物", "绘本", "宝宝", "少儿", "儿童", "青少年", "漫画", "常识", "图鉴", "magazine", "stories"]
PRIORITY = ["HIGHER_EDU_TEXTBOOK", "STANDARD", "HANDBOOK"]
REVIEWED = ["COURSEWARE", "POPULAR_SCIENCE", "SOCIAL_COMMENTARY", "K12_TEXTBOOK", "BUSINESS_INSIGHT", "GUIDE", "EXAM_PREP", "BIOGRAPHY", "SELF_HELP", "HISTORY"]


#: Endings that make titles of reference books, of others, and of both kinds.
ENDINGS = [" Dictionary of terms", " dictionary learning", " encyclopedia stories", " a Glossary", " dictionaryx", "", " dictionary learning and vocabulary", "百科全书", "图典型", "术语词典"]


def _term_sql(column):
    """(kind, term) pairs of the terms that a title has, in their order."""
    one = lambda k, t: f"CASE WHEN regexp_matches({column}, '" + (rf"\b{t}\b" if t.isascii() else t) + f"') THEN {{'kind': '{k}', 'term': '{t}'}} END"
    return "list_filter([" + ", ".join(one(k, t) for k, ts in TERMS.items() for t in ts) + "], lambda v: v IS NOT NULL)"


@query(r"""
WITH x AS (SELECT p_partkey, lower(p_name || ['""" + "','".join(ENDINGS) + r"""'][p_partkey % 10 + 1]) AS t FROM part),
m AS (SELECT *, regexp_replace(regexp_replace(t, '图典型', '', 'g'), '\bdictionary\s+learning\b', '', 'g') AS u FROM x),
h AS (SELECT *, """ + _term_sql("t") + " AS raw, " + _term_sql("u") + """ AS hits FROM m)
SELECT p_partkey, CASE WHEN len(raw) = 0 THEN 'no_hit' WHEN len(hits) = 0 THEN 'false_positive' WHEN regexp_matches(t, '""" + "|".join(REVIEW) + """') THEN 'review' ELSE 'strict_keep' END AS decision,
 CASE WHEN len(hits) = 0 THEN '' ELSE hits[1].kind END AS kind, array_to_string(list_transform(CASE WHEN len(hits) = 0 THEN raw ELSE hits END, lambda v: v.term), ',') AS evidence FROM h""")
def track_classifier(s, d):
    title = F.concat("p_name", F.element_at(F.array(*map(F.lit, ENDINGS)), (F.col("p_partkey") % 10 + 1).cast("int")))
    x = table(s, d, "part").select("p_partkey", R.book_track(title, TERMS, MASKS, REVIEW).alias("t"))
    return x.select("p_partkey", "t.decision", "t.kind", F.array_join("t.evidence", ",").alias("evidence"))


GENRES = ["handbook", "guide", "novel", " Standard", "", "history"]


@query("""
WITH x AS (SELECT p_partkey, upper(trim(['""" + "','".join(GENRES) + """'][p_size % 6 + 1])) AS g, upper(['', 'Knowledge_Exposition', 'fiction'][p_partkey % 3 + 1]) AS c, upper(['leisure', 'self; teaching', 'professional_use'][p_partkey // 3 % 3 + 1]) AS u, upper(['public', 'academic', 'Professional '][p_partkey // 9 % 3 + 1]) AS a FROM part)
SELECT p_partkey, CASE WHEN g IN ('""" + "','".join(PRIORITY) + """') OR (g NOT IN ('""" + "','".join(REVIEWED) + """') AND (c = 'KNOWLEDGE_EXPOSITION' OR (trim(a) IN ('ACADEMIC', 'PROFESSIONAL') AND (contains(u, 'PROFESSIONAL_USE') OR contains(u, 'TEACHING'))))) THEN 'strict_keep' ELSE 'review' END AS decision FROM x""")
def important_books(s, d):
    of = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))
    k = F.col("p_partkey")
    g = R.important_book(of(GENRES, F.col("p_size") % 6), of(["", "Knowledge_Exposition", "fiction"], k % 3), of(["leisure", "self; teaching", "professional_use"], F.floor(k / 3) % 3), of(["public", "academic", "Professional "], F.floor(k / 9) % 3), PRIORITY, REVIEWED)
    return table(s, d, "part").select("p_partkey", g.alias("decision"))


@query("""
SELECT doc_id, CASE WHEN toxic = 1 THEN 'DROP' WHEN quality = 0 AND doc_id % 3 = 0 THEN 'DROP' WHEN quality = 0 THEN 'REVIEW' WHEN doc_id % 3 = 0 THEN 'DROP' ELSE 'KEEP' END AS decision,
 CASE WHEN toxic = 1 THEN 'safety' WHEN quality = 0 AND doc_id % 3 = 0 THEN 'structure,subject' WHEN quality = 0 THEN 'structure' WHEN doc_id % 3 = 0 THEN 'subject' ELSE '' END AS adjusted FROM labels""")
def vote_gate_stack(s, d):
    v = R.votes(F.lit("KEEP"), (F.col("toxic") == 1, "DROP", "safety"), (F.col("quality") == 0, "REVIEW", "structure"), (F.col("doc_id") % 3 == 0, "DROP", "subject"))
    return table(s, d, "labels").select("doc_id", v.alias("v")).select("doc_id", "v.decision", F.array_join("v.adjusted", ",").alias("adjusted"))


@query(r"""
WITH RECURSIVE x AS (SELECT p_partkey, [' ', 'a  b ', '', '12. ', '(', ''][p_partkey % 6 + 1] || p_name || ['', ' (x [y)]', ' (ok [fine])', ',', ' '][p_partkey % 5 + 1] AS n FROM part),
b AS (SELECT p_partkey, regexp_replace(n, '[^()\[\]{}]', '', 'g') AS r FROM x UNION ALL SELECT p_partkey, regexp_replace(r, '\(\)|\[\]|\{\}', '', 'g') FROM b WHERE regexp_matches(r, '\(\)|\[\]|\{\}')),
z AS (SELECT p_partkey, min(length(r)) > 0 AS odd FROM b GROUP BY 1)
SELECT p_partkey, array_to_string(list_filter([CASE WHEN regexp_matches(n, '^\s|\s$') THEN 'error:edge_whitespace' END, CASE WHEN regexp_matches(n, '\s{2,}') THEN 'error:repeated_whitespace' END, CASE WHEN odd THEN 'error:unbalanced_brackets' END,
 CASE WHEN regexp_matches(n, '^\s*\d+(?:\.\d+)*[.)]\s*\S') THEN 'suspect:number_prefix' END, CASE WHEN regexp_matches(n, '[,;:]\s*$') THEN 'suspect:trailing_punctuation' END], lambda v: v IS NOT NULL), ',') AS checks FROM x JOIN z USING (p_partkey)""")
def name_rule_checks(s, d):
    of = lambda k, *values: F.element_at(F.array(*map(F.lit, values)), (k + 1).cast("int"))
    k = F.col("p_partkey")
    n = F.concat(of(k % 6, " ", "a  b ", "", "12. ", "(", ""), "p_name", of(k % 5, "", " (x [y)]", " (ok [fine])", ",", " "))
    return table(s, d, "part").select("p_partkey", F.array_join(F.transform(R.name_checks(n), lambda c: F.concat_ws(":", c["level"], c["code"])), ",").alias("checks"))


@query("""
WITH x AS (SELECT doc_id % 300 AS id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE quality END AS quality, toxic + CASE WHEN doc_id % 13 = 0 THEN 5 ELSE 0 END AS toxic FROM labels)
SELECT id, p AS problems FROM (SELECT id, array_to_string(list_filter([CASE WHEN quality IS NULL THEN 'missing:quality' END, CASE WHEN toxic > 1 THEN 'invalid:toxic' END, CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate:id' END], lambda v: v IS NOT NULL), ',') AS p FROM x) WHERE p <> ''""")
def schema_check(s, d):
    k = F.col("doc_id")
    x = table(s, d, "labels").select((k % 300).alias("id"), F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("quality")).alias("quality"), (F.col("toxic") + F.when(k % 13 == 0, 5).otherwise(0)).alias("toxic"))
    return R.schema_problems(x, "id", {"quality": F.col("quality").isin(0, 1), "toxic": F.col("toxic").isin(0, 1)}).select("id", F.array_join("problems", ",").alias("problems"))


@query("""
WITH a AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'drop' WHEN doc_id % 4 = 3 THEN 'review' ELSE 'keep' END AS d0, (doc_id % 100) / 100.0 AS c, toxic = 0 AS rel, doc_id % 17 = 0 AS rev, doc_id % 11 = 0 AS fd, doc_id % 7 = 0 AS bt, doc_id % 5 = 0 AS bc, quality = 1 AS con FROM labels),
b AS (SELECT *, CASE WHEN fd THEN 'drop' WHEN rev AND d0 = 'keep' THEN 'review' ELSE d0 END AS d1 FROM a), e AS (SELECT *, CASE WHEN d1 = 'keep' AND c < 0.5 THEN 'review' ELSE d1 END AS d2 FROM b), f AS (SELECT *, CASE WHEN d2 = 'keep' AND bt THEN 'review' ELSE d2 END AS d3 FROM e),
g AS (SELECT *, CASE WHEN d3 = 'keep' AND bc THEN 'review' ELSE d3 END AS d4 FROM f)
SELECT doc_id, CASE WHEN d4 = 'keep' AND (NOT con OR NOT rel) THEN 'review' ELSE d4 END AS decision, array_to_string(list_sort(list_filter([CASE WHEN rev THEN 'language_assignment_swapped_by_model' END, CASE WHEN fd THEN 'field_drop_or_pair_inconsistent' END, CASE WHEN d1 = 'keep' AND c < 0.5 THEN 'below_confidence_threshold' END,
 CASE WHEN d2 = 'keep' AND bt THEN 'standardized_name_not_grounded_in_source_titles' END, CASE WHEN d3 = 'keep' AND bc THEN 'standardized_content_not_sufficiently_grounded' END, CASE WHEN d4 = 'keep' AND (NOT con OR NOT rel) THEN 'incomplete_review_contract' END], lambda v: v IS NOT NULL)), ',') AS flags FROM g""")
def result_normalization(s, d):
    k = F.col("doc_id")
    r = R.normalized_result(F.when(k % 4 == 3, "Unsure").otherwise(" KEEP "), ((k % 100) / 100.0).cast("string"), F.col("toxic") == 0, field_drop=k % 11 == 0, pair=F.lit("consistent"), reversed_=k % 17 == 0, empty=F.lit(False), titles_ok=k % 7 != 0, content_ok=k % 5 != 0, odd_name=F.lit(False), contract_ok=F.col("quality") == 1, threshold=0.5)
    return table(s, d, "labels").select("doc_id", r.alias("r")).select("doc_id", "r.decision", F.array_join("r.flags", ",").alias("flags"))


CAUSES = [("invalid_field_result", "local_field_result_invalid"), ("below_confidence_threshold", "local_low_confidence"), ("incomplete_review_contract", "local_contract_missing_field_results")]


@query("""
SELECT doc_id, CASE WHEN quality = 1 THEN '' WHEN doc_id % 9 = 0 THEN 'api_error_after_retries' WHEN doc_id % 2 = 0 THEN 'local_field_result_invalid' WHEN doc_id % 3 = 0 THEN 'local_low_confidence' ELSE 'model_review_uncertain' END AS cause FROM labels""")
def review_causes(s, d):
    k = F.col("doc_id")
    flags = T.reasons((k % 3 == 0, "below_confidence_threshold"), (k % 2 == 0, "invalid_field_result_name"), (k % 5 == 0, "other"))
    dec = F.when(F.col("quality") == 1, "keep").when(k % 9 == 0, "error").otherwise("review")
    return table(s, d, "labels").select("doc_id", R.review_cause(dec, flags, CAUSES).alias("cause"))


@query("""
WITH x AS (SELECT doc_id, text, n_chars, list_filter([[coalesce(string_split(text, ' ')[3], ''), 'definition'], [lang, 'definition'], [source, 'source'], ['', 'definition']], lambda v: doc_id % 7 <> 0 AND (v[1] <> lang OR doc_id % 2 = 0) AND (v[1] <> '' OR doc_id % 5 = 0)) AS ev, source FROM documents)
SELECT doc_id, CASE WHEN n_chars % 6 <> 0 AND len(ev) > 0 AND len(list_filter(ev, lambda v: v[1] = '' OR NOT contains(CASE v[2] WHEN 'source' THEN source ELSE text END, v[1]))) = 0 THEN 'reasonable' ELSE 'uncertain' END AS verdict FROM x""")
def evidence_substring_gate(s, d):
    """Quotes that are in their field, that may not be, that are empty, and none at all."""
    k = F.col("doc_id")
    quote = lambda text, field: F.struct(F.lit(field).alias("field"), text.alias("text"))
    ev = F.array(quote(F.coalesce(F.get(F.split("text", " "), F.lit(2)), F.lit("")), "definition"), quote(F.col("lang"), "definition"), quote(F.col("source"), "source"), quote(F.lit(""), "definition"))
    ev = F.filter(ev, lambda e: (k % 7 != 0) & ((e["text"] != F.col("lang")) | (k % 2 == 0)) & ((e["text"] != "") | (k % 5 == 0)))
    return table(s, d, "documents").select("doc_id", R.evidence_gate(F.lit("reasonable"), ev, F.create_map(F.lit("definition"), "text", F.lit("source"), "source"), F.col("n_chars") % 6 != 0).alias("verdict"))


@query("""
WITH x AS (SELECT doc_id, CASE WHEN doc_id % 8 = 0 THEN '' WHEN doc_id % 8 = 1 THEN 'bad id!' ELSE 'b' || (doc_id - doc_id % 16 % 2) END AS i, ['KEEP','KEEP','DROP','REVIEW'][doc_id // 8 % 4 + 1] AS dec, lang FROM documents),
y AS (SELECT *, count(*) OVER (PARTITION BY i) AS n FROM x)
SELECT doc_id, CASE WHEN i = '' THEN 'missing_identifier' WHEN i = 'bad id!' THEN 'invalid_identifier' WHEN n > 1 THEN 'duplicate_identifier' WHEN dec = 'DROP' THEN 'decision_drop' WHEN dec = 'REVIEW' THEN 'decision_review' WHEN lang NOT IN ('en', 'de') THEN 'unknown_subject' ELSE 'accepted' END AS why FROM y""")
def manifest_conversion(s, d):
    k = F.col("doc_id")
    i = F.when(k % 8 == 0, "").when(k % 8 == 1, "bad id!").otherwise(F.concat(F.lit("b"), (k - k % 16 % 2).cast("string")))
    x = table(s, d, "documents").select("doc_id", i.alias("i"), F.element_at(F.array(*map(F.lit, ["KEEP", "KEEP", "DROP", "REVIEW"])), (F.floor(k / 8) % 4 + 1).cast("int")).alias("dec"), F.lit("t").alias("track"), F.lit("p").alias("path"), "lang")
    return R.manifest_status(x, "i", "dec", "track", "path", ["en", "de"], "lang").select("doc_id", "why")


@query("""
SELECT doc_id, CASE WHEN quality = 1 THEN 'reasonable' WHEN doc_id % 3 = 0 THEN 'pending' WHEN toxic = 1 THEN 'unreasonable' ELSE 'uncertain' END AS verdict FROM labels""")
def two_vote_combine(s, d):
    first = F.when(F.col("quality") == 1, "reasonable").otherwise("unreasonable")
    second = F.when(F.col("doc_id") % 3 != 0, F.when(F.col("toxic") == 1, "unreasonable").otherwise("reasonable"))
    return table(s, d, "labels").select("doc_id", R.combine_votes(first, second).alias("verdict"))


@query(r"""
WITH x AS (SELECT doc_id, quality, toxic, lang, trim(['plain name', '中文 ' || source, 'open (' || lang, source || ' [x]', 'a', 'www.' || source, '中文'][doc_id % 7 + 1]) AS n, ['', '', lang][doc_id // 7 % 3 + 1] AS point, [0.9, 0.8, 0.5, NULL][doc_id // 21 % 4 + 1] AS conf FROM labels JOIN documents USING (doc_id))
SELECT doc_id, CASE WHEN quality = 0 AND doc_id % 2 = 0 THEN 'subject_not_confirmed' WHEN doc_id % 9 = 0 THEN 'not_language_candidate' WHEN toxic = 1 THEN 'additional_or_unrecognized_flags' WHEN doc_id % 11 = 0 THEN 'pair_not_confirmed' WHEN coalesce(conf, 0) < 0.8 THEN 'confidence_below_existing_threshold' WHEN doc_id % 13 = 0 THEN 'field_contract_not_confirmed'
 WHEN NOT (regexp_matches(n, '[A-Za-z]') AND NOT regexp_matches(n, '[㐀-䶿一-鿿豈-﫿]')) OR point <> '' THEN 'cannot_move_name_without_conflict' WHEN length(n) = 1 OR length(n) > 160 OR regexp_matches(n, '(?i)https?://|www\.|@') THEN 'invalid_title_format'
 WHEN length(replace(n, '(', '')) <> length(replace(n, ')', '')) OR length(replace(n, '[', '')) <> length(replace(n, ']', '')) THEN 'unbalanced_title_brackets' WHEN lang = 'es' THEN 'missing_subject_tag' END AS why FROM x""")
def restore_language_only(s, d):
    of = lambda k, *values: F.element_at(F.array(*[F.lit(v) if not hasattr(v, "alias") else v for v in values]), (k + 1).cast("int"))
    k = F.col("doc_id")
    name = of(k % 7, "plain name", F.concat(F.lit("中文 "), "source"), F.concat(F.lit("open ("), "lang"), F.concat("source", F.lit(" [x]")), "a", F.concat(F.lit("www."), "source"), "中文")
    w = R.restorable(relevant=~((F.col("quality") == 0) & (k % 2 == 0)), language_flag=k % 9 != 0, other_flags=F.col("toxic") == 1, pair=F.when(k % 11 == 0, "inconsistent").otherwise("not_applicable"), confidence=of(F.floor(k / 21) % 4, 0.9, 0.8, 0.5, F.lit(None).cast("double")), field_ok=k % 13 != 0, reason_ok=F.lit(True), other_problem=F.lit(False), name=name, point=of(F.floor(k / 7) % 3, "", "", F.col("lang")), tag=F.when(F.col("lang") == "es", "").otherwise(F.col("source")))
    return table(s, d, "labels").join(table(s, d, "documents"), "doc_id").select("doc_id", w.alias("why"))


@query("""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([CASE WHEN n_chars % 2 = 0 THEN 'definition_missing' END, CASE WHEN doc_id % 3 = 0 THEN 'review_failed' END, CASE WHEN doc_id % 5 = 0 THEN 'linked_pipeline_error:broken' END, CASE WHEN doc_id % 7 = 0 THEN 'linked_pipeline_error:lost' END], lambda v: v IS NOT NULL))), ',') AS reasons FROM documents""")
def delivery_exclusion(s, d):
    k = F.col("doc_id")
    docs = table(s, d, "documents")
    rec = docs.select(k.cast("string").alias("record_id"), F.when(F.col("n_chars") % 2 == 0, " ").otherwise("d").alias("definition"), F.when(k % 3 == 0, F.array(F.lit("review_failed: x"))).otherwise(F.array(F.lit("fine"))).alias("issues"), F.array(F.concat(F.lit("c"), k, F.lit("-1"))).alias("candidate_ids"))
    none = F.lit(None).cast("string")
    a = docs.where("doc_id % 5 = 0").select(k.cast("string").alias("record_id"), F.array().cast("array<string>").alias("candidate_ids"), none.alias("chunk_id"), F.lit("broken").alias("issue"))
    b = docs.where("doc_id % 7 = 0").select(none.alias("record_id"), F.array().cast("array<string>").alias("candidate_ids"), F.concat(F.lit("c"), k).alias("chunk_id"), F.lit("lost").alias("issue"))
    x = R.delivery_exclusions(rec, a.unionByName(b), ["incomplete"])
    return x.select(F.col("record_id").cast("long").alias("doc_id"), F.array_join("reasons", ",").alias("reasons"))


@query("""
WITH x AS (SELECT lang, CASE WHEN quality = 1 THEN 'PASS' WHEN doc_id % 2 = 0 THEN 'REVIEW' ELSE 'DROP' END AS m, CASE WHEN toxic = 0 THEN 'PASS' ELSE 'DROP' END AS h FROM labels JOIN documents USING (doc_id)), y AS (SELECT * FROM x UNION ALL SELECT 'overall', m, h FROM x)
SELECT lang, count(*) AS n, round_even(100.0 * count(*) FILTER (m = 'PASS' AND h = 'PASS') / nullif(count(*) FILTER (m = 'PASS'), 0), 2) AS approval, round_even(100.0 * count(*) FILTER (m = 'PASS' AND h = 'PASS') / nullif(count(*) FILTER (h = 'PASS'), 0), 2) AS recall, round_even(100.0 * count(*) FILTER (h = 'PASS' AND m <> 'DROP') / nullif(count(*) FILTER (h = 'PASS'), 0), 2) AS not_drop FROM y GROUP BY 1""")
def human_label_evaluation(s, d):
    x = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "lang"), "doc_id")
    x = x.select("lang", F.when(F.col("quality") == 1, "PASS").when(F.col("doc_id") % 2 == 0, "REVIEW").otherwise("DROP").alias("m"), F.when(F.col("toxic") == 0, "PASS").otherwise("DROP").alias("h"))
    return R.agreement(x, "lang", "m", "h")


@query("""
WITH e AS (SELECT source, lang, doc_id % 3 AS zone, doc_id AS anchor FROM documents), g AS (SELECT source, lang, count(*) AS n, count(DISTINCT zone) AS z, count(DISTINCT anchor) AS a FROM e GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY source) AS t, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang DESC) AS rn FROM g)
SELECT source, CASE WHEN n >= 0.6 * t AND z >= 2 AND a >= 2 THEN lang END AS lang, CAST(t AS BIGINT) AS "all" FROM r WHERE rn = 1""")
def structure_routing_vote(s, d):
    x = table(s, d, "documents").select("source", "lang", (F.col("doc_id") % 3).alias("zone"), F.col("doc_id").alias("anchor"))
    return R.family_vote(x, "source", "lang", "zone", "anchor", 0.6)


@query("SELECT doc_id, length(text) > 0 AND (length(text) > 100) AS truncated, CAST(least(length(text), 100) AS INT) AS a, CAST(least(length(lang), greatest(0, 100 - length(text))) AS INT) AS b FROM documents")
def bounded_context_sharing(s, d):
    x = table(s, d, "documents").select("doc_id", R.shared_budget([F.col("text"), F.col("lang")], 100).alias("b"), F.length("text").alias("n"))
    return x.select("doc_id", (F.col("n") > 100).alias("truncated"), F.length(F.col("b.parts")[0]).alias("a"), F.length(F.col("b.parts")[1]).alias("b"))


@query(r"""
WITH x AS (SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS t, list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '') AS w, doc_id % 3 AS k FROM documents),
a AS (SELECT doc_id, t, list_filter(regexp_split_to_array(CASE WHEN len(w) = 0 THEN '' WHEN k = 0 THEN w[1] || '…' || w[len(w)] WHEN k = 1 THEN w[len(w)] || '......' || w[1] || '…' || w[len(w)] ELSE w[1] || '...§§…' || w[len(w)] END, '…+|\.{3,}'), lambda v: v <> '') AS p FROM x),
s1 AS (SELECT *, strpos(t, p[1]) AS at1 FROM a), s2 AS (SELECT *, CASE WHEN at1 > 0 THEN substr(t, at1 + length(p[1])) END AS r1 FROM s1),
s3 AS (SELECT *, CASE WHEN len(p) >= 2 THEN strpos(r1, p[2]) END AS at2 FROM s2), s4 AS (SELECT *, CASE WHEN at2 > 0 THEN substr(r1, at2 + length(p[2])) END AS r2 FROM s3)
SELECT doc_id, len(p) > 0 AND coalesce(at1 > 0, false) AND (len(p) < 2 OR coalesce(at2 > 0, false)) AND (len(p) < 3 OR coalesce(strpos(r2, p[3]) > 0, false)) AS matched FROM s4""")
def ordered_anchor_matching(s, d):
    """Anchors of a text's first and last words: in order, turned round, and with a part that no text has; whole texts."""
    w = F.filter(F.split("text", r"(?U)\s+"), lambda x: x != "")
    first, last = F.get(w, F.lit(0)), F.element_at(w, -1)
    k = F.col("doc_id") % 3
    anchor = F.when(F.size(w) == 0, "").when(k == 0, F.concat(first, F.lit("…"), last)).when(k == 1, F.concat(last, F.lit("......"), first, F.lit("…"), last)).otherwise(F.concat(first, F.lit("...§§…"), last))
    return table(s, d, "documents").select("doc_id", R.ordered_parts(F.col("text"), anchor).alias("matched"))


@query("SELECT doc_id, lang, CASE WHEN n_chars < 200 THEN 'name' WHEN lang NOT IN ('en', 'de') THEN 'scope' WHEN quality = 0 THEN 'content' WHEN l.doc_id IS NULL THEN 'pending' ELSE 'kept' END AS disposition FROM documents d LEFT JOIN labels l USING (doc_id)")
def ledger_chain(s, d):
    """Staged filters, one ledger row per input with the first stage that stopped it."""
    from .pipeline import ledger

    x = table(s, d, "documents").join(table(s, d, "labels").withColumn("known", F.lit(True)), "doc_id", "left")
    return ledger(x, [("name", F.col("n_chars") < 200), ("scope", ~F.col("lang").isin("en", "de")), ("content", F.col("quality") == 0), ("pending", F.col("known").isNull())]).select("doc_id", "lang", "disposition")
