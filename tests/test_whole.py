"""Queries on odd tables against their SQL, and operators on what larger tables hold."""
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomwright.functions import text as T
from loomwright.operators import evidence as E
from loomwright.operators import rules as R
from loomwright.operators import segment as G


def against_sql(spark, tmp_path, name, **tables):
    """The rows of a query over ``tables`` (name -> (rows, schema)) and those of its SQL, sorted, columns by name."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        path = f"{tmp_path}/{table}.parquet"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/*.parquet'")
    got = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    order = sorted(names)
    assert sorted(got.columns) == order
    return sorted((tuple(r) for r in got.select(*order).collect()), key=repr), sorted((tuple(r[names.index(c)] for c in order) for r in want.fetchall()), key=repr)


def test_group_audit_of_shared_lists(spark):
    """Lists of one length that differ in members or in how often one is there, and a candidate of two groups."""
    groups = spark.createDataFrame([(m, g, "same") for m, g in (("a", 1), ("b", 1), ("b2", 1), ("c", 2), ("d", 2), ("e", 3), ("e", 4))] + [("f", 5, "unsure"), ("g", 5, "unsure")], "member string, group_id int, status string")
    lists = spark.createDataFrame([(n, m) for n, ms in {"whole": ["b2", "a", "b"], "twice": ["a", "b", "b"], "other": ["c", "a"], "cd": ["d", "c"], "e": ["e"], "fg": ["f", "g"], "x": ["x"]}.items() for m in ms], "list_id string, member string")
    rows = spark.createDataFrame([("a", "whole", True), ("b", "twice", True), ("b2", "whole", False), ("c", "other", True), ("d", "cd", True), ("e", "e", True), ("f", "fg", True), ("x", "x", True), ("y", "cd", True)], "candidate_id string, list_id string, reviewed boolean")
    want = {("b", "other_members"), ("b2", "unconfirmed_group"), ("c", "other_members"), ("e", "several_groups"), ("f", "uncertain_group_expanded"), ("x", "missing_group"), ("y", "not_a_member")}
    assert {tuple(r) for r in E.group_audit(rows, groups, lists).collect()} == want
    arrays = lambda d, n: d.groupBy(n).agg(F.collect_list("member").alias("members"))
    old = E.group_audit(rows.join(arrays(lists, "list_id"), "list_id"), groups.join(arrays(groups, "group_id"), "group_id"))
    assert {tuple(r) for r in old.collect()} == want


def test_group_audits_carry_no_lists(spark, tmp_path):
    """Each row holds one key of its list; with lists in rows a table of one nation grew with its square."""
    rows = [(k, k % 2) for k in range(1, 200)]
    got, want = against_sql(spark, tmp_path, "group_audits", customer=(rows, "c_custkey long, c_nationkey int"))
    assert got == want and len(got) == 19
    plan = entry.queries()["group_audits"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_sentence_units_of_odd_documents(spark, tmp_path):
    """Documents without a sentence or a text, and ids that are there twice, keep their rows."""
    rows = [(1, "One. Two!"), (2, ""), (3, None), (4, "..."), (5, "\n"), (6, "a"), (6, "b. c"), (7, "x\n\ny")]
    got, want = against_sql(spark, tmp_path, "sentence_units", documents=(rows, "doc_id long, text string"))
    assert got == want and len(got) == 8


def test_prose_units():
    t = 'See e.g. this one. It costs 3.5 (about 3. Really.). He said "No." and left. "Stop!" She did. A. B. Smith and Dr. Lee came.\n(p. 12)\nNext one... goes\non. 中文。（人民日报，2020年1月2日）好 (see p. 3). The boys\' hats.'
    got = G.prose_units(t)
    assert [t[a:b].strip() for a, b, _ in got] == ["See e.g. this one.", "It costs 3.5 (about 3. Really.).", 'He said "No." and left.', '"Stop!"', "She did.", "A. B. Smith and Dr. Lee came.", "(p. 12)", "Next one... goes\non.", "中文。", "（人民日报，2020年1月2日）", "好 (see p. 3).", "The boys' hats."]
    assert [t[a:b] for a, b, note in got if note] == ["(p. 12)", "（人民日报，2020年1月2日）"]


def test_sentence_units_of_paired_marks(spark, tmp_path):
    r = random.Random(3)
    parts = ["Word", "word ", " and ", "s", " ", "\n", ". ", ".", "! ", "。", "！", "(", ")", "（", "）", "[", "]", '"', "'", "’", "“", "”", "《", "》", "e.g. ", "A. B. ", "sk. x", "\\", "(p. 12)", "（人民日报，2020年1月2日）", "(王小明：《书》)", "é", "...", "cats' ", "don't ", "x.) (Y.) (Z.) ", '." ']
    rows = [(k, "".join(r.choices(parts, k=r.randrange(0, 30)))) for k in range(600)]
    got, want = against_sql(spark, tmp_path, "sentence_units", documents=(rows, "doc_id long, text string"))
    assert got == want
    whole = {r.doc_id: r.n for r in G.sentences(spark.createDataFrame(rows, "doc_id long, text string")).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert whole == {i: n for i, n in got if n}


def test_layout_verdict_counts_in_one_pass(spark):
    """The same verdicts as by sets of roles, lines and windows, without a row for each of them."""
    r = random.Random(5)
    classes, roles = ["N1", "N2", "N3", "N4", "N5", "N6"], ["heading", "prose", "step", "rule", "table_header", "table_row", "image", "caption", "image_reference", None]
    ev = [(b, r.choice(classes), r.randrange(3), r.choice(["a", "x", " "]), r.choice(roles)) for b in range(150) for _ in range(r.randrange(1, 6))]
    at = [(b, r.choice([1, 2, None]), k, r.choice(["a b", "x a"])) for b in range(150) for k in range(3) for _ in range(r.randrange(1, 3))]
    want = {}
    for b, c, line, q, role in ev:
        for b2, w, k, text in at:
            if (b, line) == (b2, k) and q in text and q.strip():
                want.setdefault((b, c), []).append((role, line, w))
    need = {"N1": lambda h, p, s: {"heading", "prose"} <= h, "N2": lambda h, p, s: len(p) >= 2, "N3": lambda h, p, s: len(s) >= 2, "N4": lambda h, p, s: {"table_header", "table_row"} <= h, "N5": lambda h, p, s: "image" in h and bool(h & {"caption", "image_reference"}), "N6": lambda h, p, s: False}
    want = {(b, c, need[c]({x for x, _, _ in v}, {k for x, k, _ in v if x == "prose"}, {k for x, k, _ in v if x in ("step", "rule")}), len({w for _, _, w in v if w is not None}) >= 2) for (b, c), v in want.items()}
    out = E.layout_verdict(spark.createDataFrame(ev, "book int, class string, line_id int, quote string, role string"), spark.createDataFrame(at, "book int, window int, line_id int, text string"))
    assert {tuple(x) for x in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "collect_set" not in plan


def test_book_track_looks_once(spark):
    """Each term's pattern stands in the plan once for the title and once for the masked one, each mask once."""
    title = ["Dictionary of x", "dictionary learning", "a (b) dictionary learning glossary stories", "图典型", "图典型 词典", "dictionaryx", None, " "]
    df = spark.createDataFrame([(t,) for t in title], "t string").select(R.book_track(F.col("t"), {"d": ["词典", "dictionary", "图典"], "g": ["glossary", r"\(b\)"]}, ["图典型", r"\bdictionary\s+learning\b"], ["stories"]).alias("v"))
    got = [(r.v.track, r.v.decision, r.v.kind, r.v.evidence) for r in df.collect()]
    assert got == [("reference", "strict_keep", "d", ["dictionary"]), ("other", "false_positive", "", ["dictionary"]), ("reference", "review", "g", ["glossary"]), ("other", "false_positive", "", ["图典"]), ("reference", "strict_keep", "d", ["词典"]), ("other", "no_hit", "", []), ("other", "no_hit", "", []), ("other", "no_hit", "", [])]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("learning") == 1 and plan.count("bglossary") == 2


def test_cap_repeats_stays_in_the_jvm(spark):
    r = random.Random(7)
    parts = ["a", "é" * 9, "=" * 8, "x" * 7, "🙂" * 10, "٣" * 9, "\x1c" * 9, "　" * 9, "7" * 12, "Qz+" * 70, "ab/" * 66, "==", "=", "\n", " ", "b" * 300, "\\" * 9, "$" * 8, "中"]
    rows = [(k, "".join(r.choices(parts, k=r.randrange(0, 9)))) for k in range(400)] + [(400, None), (401, "")]
    again, b64 = re.compile(r"([^\s\d])\1{7,}"), re.compile(r"[A-Za-z0-9+/]{200,}={0,2}")
    want = {k: None if t is None else again.sub(lambda m: f"{m.group(1)}[x{len(m.group())}]", b64.sub(lambda m: f"[base64:{len(m.group())}]", t)) for k, t in rows}
    df = spark.createDataFrame(rows, "k int, t string").select("k", T.cap_repeats(F.col("t")).alias("u"))
    assert {x.k: x.u for x in df.collect()} == want
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
