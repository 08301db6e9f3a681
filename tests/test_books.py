"""Book signals, spans, evidence and records."""
import pytest
from pyspark.sql import functions as F

from loomwright.operators import books as B
from loomwright.operators import evidence as E
from loomwright.operators import rules as R
from loomwright.operators import windows as X


def ev(spark, expr):
    return spark.range(1).select(expr.alias("y")).first().y


L = F.lit


def test_periodicals(spark):
    got = lambda **k: ev(spark, B.periodical_signals(*[L(k.get(n, "")) for n in ("title", "publisher", "metadata", "text")], L(False)))
    assert got(publisher="某某杂志社") == ["publisher_periodical"]
    assert got(title="力学", publisher="力学编辑部") == ["publisher_editorial_issue"]
    assert got(metadata="本刊为双月刊") == ["metadata_periodical"]
    assert got(text="ISSN 1234-567X Vol. 3, No. 2") == ["md_issn_issue"]
    assert got(text="2020年第3期 （总第 55 期）") == ["md_chinese_issue"]
    assert got(title="Handbook", publisher="Press") == []


def test_collections_and_risks(spark):
    chapters = "".join(f"Chapter {k}\nJOHN A. DOE and MARY B. ROE\ntext\nConclusions\nReferences\nx\n" for k in range(1, 6))
    c = ev(spark, B.collection_signals(L("Edited by X\n" + chapters)))
    assert (c.chapters, c.references, c.conclusions, c.authors, c.confidence) == (5, 5, 5, 5, "high")
    assert ev(spark, B.collection_signals(L(chapters))).confidence == "low"
    assert ev(spark, B.full_text_risks(L("Originally published in 1987 by X"), L("t"), L(""))) == ["original_publication_year_before_2000"]
    assert ev(spark, B.full_text_risks(L("ebook originally published 1987\nThis journal was first published in 1950"), L("t"), L(""))) == []
    assert ev(spark, B.full_text_risks(L("question bank\n" + "Answer: x\n" * 50), L("exam guide"), L(""))) == ["exam_question_answer_dominated"]
    assert ev(spark, B.full_text_risks(L("Proceedings\nAbstract\nIn this paper\nReferences\n"), L("t"), L(""))) == ["single_article_or_conference_paper"]
    p = ev(spark, B.place_of(L("a\nb Answer: x\nc"), "Answer"))
    assert (p.line, p.anchor) == (2, "b Answer: x")


def test_dictionary_gates(spark):
    assert ev(spark, B.foreign_dictionary_title(L("德汉机械词典"))) and not ev(spark, B.foreign_dictionary_title(L("英汉词典")))
    h = ev(spark, B.foreign_headings(L("\n".join(f"# ΑΒΓΔ{k}" for k in range(6)))))
    assert h.signal and h["count"] == 6
    t = ev(spark, B.traditional_ratio(L("體" * 600 + "中" * 600), "體"))
    assert (t.chars, t.variants, t.body) == (1200, 600, True)
    g = ev(spark, B.document_gates(L("PASS"), L(False), L(True)))
    assert (g.decision, g.adjusted) == ("DROP", ["heading_language"])
    q = lambda dec, **k: ev(spark, B.qualitative_gate(L(dec), **{n: L(k.get(n, v)) for n, v in dict(usability="high", dominant="", body=8, other=0, damaged=0, examples=3).items()}))
    assert [q("PASS"), q("PASS", other=1), q("PASS", damaged=1), q("PASS", damaged=2), q("REVIEW", usability="medium"), q("PASS", examples=1)] == ["PASS", "DROP", "REVIEW", "DROP", "REVIEW", "REVIEW"]
    three = F.array(*[F.struct(L(k).alias("sample"), L(True).alias("strong"), L(True).alias("verified")) for k in (1, 2, 3)])
    p = lambda e, risky=True: ev(spark, B.pass_challenge(L("PASS"), L(risky), L(0), L("PASS"), L(True), e)).decision
    assert [p(three), p(F.slice(three, 1, 2)), p(F.slice(three, 1, 2), False)] == ["PASS", "REVIEW", "PASS"]
    none = F.array().cast("array<struct<no:int,structure:string>>")
    assert ev(spark, B.challenge_samples(F.array(L(3), L(99)), none, F.array(L(5), L(3)), 12, 4)) == [3, 5, 1, 12]


def test_verdicts(spark):
    s = lambda *a: ev(spark, B.scope_verdict(*[L(x) for x in a[:3]], F.array(*map(L, a[3])).cast("array<string>"), ["力学", "热学"]))
    assert s("in_scope", "high", "r", ["力学", "外"]).decision == "keep"
    assert s("in_scope", "high", "r", ["外"]).errors == ["matched_l1_unknown"]
    assert s("out_of_scope", "medium", "r", []).scope == "uncertain" and s("out_of_scope", "high", "无关", []).decision == "drop"
    d = lambda *a: ev(spark, B.dictionary_disposition(*[L(x) for x in a], ["entry"]))
    ok = ("sample_supported", "sample_supported", "entry", "inline", "no_problem_reported_in_samples", "model_considered_compatible")
    assert [d(*ok), d(*ok[:2], "odd", *ok[3:]), d("other", "other", *ok[2:]), d("technical_failed", *ok[1:])] == ["approved", "review", "other", "technical_failed"]


def test_title_repairs(spark):
    r = ev(spark, B.title_repairs(L("IV-2.1 also known as stress)")))
    assert r.title == "stress" and [x.kind for x in r.repairs] == ["structured_roman_index_prefix", "known_as_prefix", "unmatched_edge_parenthesis"]
    assert ev(spark, B.append_note(L("a b"), L("b"))) == "a b" and ev(spark, B.append_note(L("a"), L(" x  y"))) == "a x y"


def test_bilingual_and_entries(spark):
    text = "stress 应力\nstrain 应变\nlone\nbeam\n梁\ncolumn 柱\ntruss 桁架\n"
    got = [(r.en, r.zh, r.before, r.after) for r in B.bilingual_pairs(X.lines(spark.createDataFrame([(1, text)], "doc_id long, text string"))).orderBy("line_no").collect()]
    assert got == [("stress", "应力", 0, 4), ("strain", "应变", 1, 3), ("beam", "梁", 2, 2), ("column", "柱", 3, 1), ("truss", "桁架", 4, 0)]
    doc = "# HEADWORD\nlong text that follows the heading of this entry\n\nplain name\n\nand its definition, long enough to count as text\nABACUS: a frame\n# Index\nx"
    c = [(r.family, r.score) for r in B.entry_candidates(X.lines(spark.createDataFrame([(1, doc)], "doc_id long, text string"))).orderBy("line_no").collect()]
    assert c == [("heading", 5), ("plain_short", 1), ("capital_inline", 4)]


def test_spans(spark):
    sp = lambda *xs: F.array(*[F.struct(L(a).alias("start"), L(b).alias("end")) for a, b in xs])
    got = ev(spark, E.subtract(sp((0, 10), (20, 30)), sp((3, 5), (8, 22), (29, 40))))
    assert [(x.start, x.end) for x in got] == [(0, 3), (5, 8), (22, 29)]
    assert ev(spark, E.render(L("abcdef"), sp((0, 2), (4, 6)), "|")) == "ab|ef"
    docs = spark.createDataFrame([(1, "one two one")], "doc_id long, text string")
    e = spark.createDataFrame([(1, 1, "one", None), (1, 2, "one", 2), (1, 3, "two", None), (1, 4, "six", None), (1, 5, "one", 3)], "doc_id long, entry_no int, quote string, nth int")
    assert [(r.start, r.end, r.problem) for r in E.anchored(e, docs).orderBy("entry_no").collect()] == [(None, None, "ambiguous"), (8, 11, None), (4, 7, None), (None, None, "not_found"), (None, None, "not_found")]
    o = spark.createDataFrame([(1, 1, 0, 5, 0, 3), (1, 2, 4, 9, 5, 6), (1, 3, 10, 12, 9, 11), (1, 4, 2, 3, 2, 3)], "doc_id long, entry_no int, start int, end int, name_start int, name_end int")
    assert [(r.problem, r.body_end) for r in E.ordered_entries(o).orderBy("entry_no").collect()] == [(None, 4), ("overlap", 10), ("name_outside_head", 2), ("out_of_order", None)]


def test_guards(spark):
    g = lambda *a: ev(spark, E.definition_guard(L(True), *[L(x) for x in a]))
    assert g("Stress is force per area", "definition", False, "force per area") and not g("It is force", "definition", False, "force") and not g("Stress", "background", False, "Stress") and not g("Stress", "definition", False, "zz")
    v = lambda *a: ev(spark, E.entry_vote(L("keep"), *[L(x).cast("boolean") if x is None else L(x) for x in a]))
    assert [v("independent", True, True), v("independent", True, False), v("uncertain", True, True), v("index", True, True)] == ["keep", "review", "review", "drop"]
    r = lambda *a: ev(spark, E.structural_reject(*[L(x) for x in a]))
    assert [r("IV", "IV. Whereas it", "b"), r("Foo", "Foo. See bar", "See bar\nmore"), r("a��", "x", ""), r("ok", "ok", "b")] == ["numbered_source_passage", "index_see_only", "unreadable_head", None]
    assert ev(spark, E.dependent_subheading(L("Uses"), L("## Uses"), L("p" * 130), L("Many things"))) and not ev(spark, E.dependent_subheading(L("Uses"), L("## Uses"), L("short"), L("Many")))
    assert [ev(spark, E.noun_name(L(x))) for x in ("弹性模量", "必须检查", "heat transfer", "it is hot")] == [True, False, True, False]
    assert not ev(spark, E.source_language_kept(L("应力"), L("stress is a force"))) and ev(spark, E.source_language_kept(L("应力"), L("应力 stress is force")))
    assert ev(spark, E.aliases_supported(F.array(L("T2 relaxation")), L("the $ T_{2} $ , relaxation time"))) and not ev(spark, E.aliases_supported(F.array(L("invented")), L("text")))
    assert ev(spark, E.ids_in_prose(L("see u000001 and u000009"), F.array(L("u000001")), L("text"))) == ["u000001"]
    assert ev(spark, E.negative_evidence(L("p2_x"), F.array(L("does not belong here")), ["not belong"])) == "does not belong here"


def test_layout_and_records(spark):
    lines = spark.createDataFrame([("b", "w1", "l1", "Title"), ("b", "w1", "l2", "prose one"), ("b", "w2", "l9", "Other")], "book string, window string, line_id string, text string")
    e = spark.createDataFrame([("b", "N1", "l1", "Title", "heading"), ("b", "N1", "l2", "prose", "prose"), ("b", "N1", "l9", "Other", "heading"), ("b", "N3", "l2", "nope", "step")], "book string, class string, line_id string, quote string, role string")
    assert [tuple(r) for r in E.layout_verdict(e, lines).collect()] == [("b", "N1", True, True)]
    m = spark.createDataFrame([("b", "r", 1, 1, "c2", ["s"], ["x"], None), ("b", "r", 1, 0, "c1", ["s", "t"], ["definition_missing: y", "x"], "d")], "book_id string, run_id string, group_id int, pos int, candidate_id string, scope array<string>, issues array<string>, definition string")
    import hashlib

    r = E.records(m).first()
    assert r.record_id == "r" + hashlib.sha256(b'["b","r",["c1","c2"]]').hexdigest()[:20]
    assert (r.candidate_ids, r.scope, r.issues) == (["c1", "c2"], ["s", "t"], ["x"])
    a = spark.createDataFrame([("c1", ["c1", "c2"], True), ("c2", ["c2"], True), ("c3", ["c3", "c4"], False), ("c4", ["c4"], False)], "candidate_id string, members array<string>, reviewed boolean")
    g = spark.createDataFrame([("c1", 1, ["c2", "c1"], "same"), ("c2", 1, ["c2", "c1"], "same")], "member string, group_id int, members array<string>, status string")
    assert {x.candidate_id: x.problem for x in E.group_audit(a, g).collect()} == {"c2": "other_members", "c3": "unconfirmed_group"}
    s = spark.createDataFrame([("u", 0, 1, "a"), ("u", 0, 1, "b"), ("u", 2, 3, "a")], "unit_id string, start int, end int, candidate_id string")
    assert {(x.start, tuple(x.owners)) for x in E.owned_evidence(s).collect()} == {(0, ("a", "b")), (2, ("a",))}


def test_frames(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, "q")], "k int, v string")
    assert {r.k for r in E.frozen(a, b, "k").collect()} == {2, 3}
    assert [r.k for r in E.persistent_failures(b, a, "k").collect()] == [3]
    with pytest.raises(ValueError):
        E.split_tracks(a, "v", ["x"])
    assert {k: d.count() for k, d in E.split_tracks(a, "v", ["x", "y"]).items()} == {"x": 1, "y": 1}
    books = spark.createDataFrame([("N1", "classified"), ("N4", "classified"), (None, "needs_review")], "class string, status string")
    assert [r.extractor for r in E.routed_extractors(books, {"N1": "headings", "N3": "lists"}).collect()] == ["headings", "no_extractor", "skipped:needs_review"]
    u = spark.createDataFrame([(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 2, 3, "c")], "doc_id int, unit_no int, line_no int, line string")
    p = spark.createDataFrame([(1, 1, "n"), (1, 2, "n"), (1, 3, "zz")], "doc_id int, line_no int, name string")
    assert [r.unit_no for r in E.rule_only_units(u, p, p.where("name = 'n'")).collect()] == [1]
    acts = spark.createDataFrame([(1, 2, "exclude")], "doc_id int, unit_no int, action string")
    assert {(r.unit_no, r.why) for r in E.retained_units(u.select("doc_id", "unit_no").distinct(), acts).collect()} == {(1, "default_retain")}
    q = spark.createDataFrame([(1, "a ", "p"), (1, "b", "p"), (2, "b", "p")], "id int, name string, path string")
    assert {r.check: r.n for r in E.qa(q, "id", "name", "path", {"path": F.lit(True)}).collect()} == {"duplicate:id": 2, "error:edge_whitespace": 1, "duplicate:name": 1}
    assert ev(spark, R.title_grounding(L("应力"), [L("应力 stress")])) == "bilingual_field_split"
    assert ev(spark, R.label_coverage(F.array(F.struct(L(2).alias("no")), F.struct(L(1).alias("no"))), 2))


def test_chapter_authors_and_places(spark):
    """The first two lines with words of the five behind a chapter's head may name its authors."""
    body = "Edited by X\n" + "\n".join(f"# Chapter {k}: on things\n\nA Subtitle without names here\nJOHN A. DOE and MARY B. ROE\nx\nConclusions\nReferences" for k in range(1, 5))
    late = "Chapter 1\none\ntwo\nJOHN A. DOE and MARY B. ROE"
    far = "Chapter 1\n\n\n\n\n\nJOHN A. DOE and MARY B. ROE"
    got = [r.n for r in spark.createDataFrame([(1, body), (2, late), (3, far)], "k int, x string").orderBy("k").select(B.collection_signals(F.col("x"))["authors"].alias("n")).collect()]
    assert got == [4, 0, 0]
    text = "first\n" + "a" * 100 + " key  word " + "b" * 300 + "\nlast"
    got = spark.createDataFrame([(text,)], "x string").select(B.place_of(F.col("x"), r"key\s+word").alias("p")).first().p
    assert got.line == 2 and got.anchor == ("a" * 79 + " key word " + "b" * 300)[: 79 + len(" key word ") + 150] and "  " not in got.anchor


def test_year_only_in_the_front(spark):
    late = "x\n" * 800 + "First published 1950"
    front = "x\n" * 700 + "First published 1950"
    got = [r.y for r in spark.createDataFrame([(1, late), (2, front)], "k int, x string").orderBy("k").select(B.original_year(F.col("x")).alias("y")).collect()]
    assert got == [None, 1950]
