"""General operators against plain Python."""
import json
import random

import pytest
from pyspark.sql import functions as F

from loomwright.functions import text as T
from loomwright.operators import aggregates as A
from loomwright.operators import dedup as D
from loomwright.operators import graph
from loomwright.operators import joins as J
from loomwright.operators import rules as R
from loomwright.operators import sampling as S
from loomwright.operators import score as C
from loomwright.operators import segment as G
from loomwright.operators import trees as H
from loomwright.operators import windows as X
from loomwright.plans import pipeline as P
from loomwright.sources import readers, sinks
from loomwright.streaming import checkpoints


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("seed", range(3))
def test_greedy_equals_sequential(spark, seed):
    r = random.Random(seed)
    rows = [(k, r.choice("ab"), r.choice(["", "n1", "n2", "n3", "n4", "n5"]), r.choice(["", "k1", "k2", "k3", "k4"]), r.randrange(5)) for k in range(80)]
    claimed, want = {}, {}
    for pos, path, name, point, n in sorted(rows, key=lambda x: (-x[4], x[0])):
        keys = [(path, f, v) for f, v in (("name", name), ("point", point)) if v]
        hit = next((claimed[k] for k in keys if k in claimed), None)
        want[pos] = (hit is None, pos if hit is None else hit)
        if hit is None:
            claimed |= {k: pos for k in keys}
    df = spark.createDataFrame(rows, "pos long, path string, name string, point string, n int").withColumn("keys", D.branch_keys(F.col("path"), name=F.col("name"), point=F.col("point")))
    assert {g.pos: (g.kept, g.kept_by) for g in D.greedy(df, -F.col("n")).collect()} == want


def test_greedy_on_a_long_chain(spark):
    """Each row shares a key with the next; the greedy rule keeps every other row, whatever the chain's length."""
    n = 5000
    df = spark.range(n).selectExpr("id as pos", "array(string(id), string(id + 1)) as keys")
    got = {r.pos: r.kept for r in D.greedy(df, F.col("pos")).collect()}
    assert got == {k: k % 2 == 0 for k in range(n)}


@pytest.mark.parametrize("rows", [0, 3, 40])
def test_greedy_by_components(spark, monkeypatch, rows):
    """With little room in one task, small components are walked and large ones go on in rounds: the same rows stay."""
    monkeypatch.setattr(D, "ROUNDS", 1)
    monkeypatch.setattr(D, "ONE_TASK_ROWS", rows)
    data = [(k, [f"a{k // 2}", f"b{(k + 1) // 2}"]) for k in range(12)] + [(100 + k, [f"c{k // 30}", f"d{k}"]) for k in range(60)] + [(300, ["e"]), (301, ["e", "f"]), (302, ["f"])]
    df = spark.createDataFrame(data, "pos int, keys array<string>")
    claimed, want = set(), {}
    for p, keys in data:
        want[p] = claimed.isdisjoint(keys)
        if want[p]:
            claimed.update(keys)
    assert {r.pos: r.kept for r in D.greedy(df, F.col("pos")).collect()} == want


@pytest.mark.parametrize("limit", [0, 10**6])
def test_components_by_steps_and_in_one_task(spark, monkeypatch, limit):
    monkeypatch.setattr(graph, "ONE_TASK_EDGES", limit)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (5, 5)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_alone_clears_up(spark):
    import os

    there = lambda: {p for p in os.listdir(spark.sparkContext.getConf().get("spark.checkpoint.dir")) if p.startswith("lw-")}
    before = there()
    out = graph.alone(spark, lambda: graph.written(graph.written(spark.range(3)).selectExpr("id + 1 as id")).selectExpr("id * 2 as id"))
    assert sorted(r.id for r in out.collect()) == [2, 4, 6]
    assert len(there() - before) == 1


def test_naive_window_differs(spark):
    df = spark.createDataFrame([(0, ["x", "p"], 3), (1, ["x", "q"], 2), (2, ["y", "q"], 1)], "pos long, keys array<string>, n int")
    assert {g.pos for g in D.greedy(df, -F.col("n")).where("kept").collect()} == {0, 2}


def test_leaf_merge(spark):
    rows = [(0, "p", ["r1"], "a", "e1", 5, 1), (1, "p", None, "a", "e2", 9, 0), (2, "p", ["r2", "r1"], "b", "e2", 1, 0), (3, "q", [], "z", "", 1, 0)]
    df = spark.createDataFrame(rows, "pos long, main_tags string, related_tags array<string>, name_k string, english_k string, n int, dict int").withColumn("keys", D.branch_keys(F.col("main_tags"), n=F.col("name_k"), e=F.col("english_k")))
    got = {r.pos: (r.winner, r.reason, r.related_tags) for r in D.leaf_merge(df, F.col("dict"), F.col("n")).collect()}
    assert got == {0: (0, None, ["r1", "r2"]), 1: (0, "same_leaf_name", None), 2: (0, "same_leaf_transitive", None), 3: (3, None, [])}


def test_aliases():
    assert D.resolved_aliases({"a": "b", "b": "c"}) == {"a": "c", "b": "c"}
    for bad in ({"a": "b", "b": "a"}, {"a": " "}):
        with pytest.raises(ValueError):
            D.resolved_aliases(bad)


def test_two_origins_rename(spark):
    a = spark.createDataFrame([(0, "1", ["k1"], 0)], "pos long, id string, keys array<string>, rank int")
    b = spark.createDataFrame([(0, "1", ["k2"], 0), (1, "2", ["k1"], 0)], "pos long, id string, keys array<string>, rank int")
    got = {(r.origin, r.pos): (r.id, r.kept) for r in D.two_origin_merge(a, b, "s").collect()}
    assert got == {(0, 0): ("1", True), (1, 0): ("s_non_dictionary_1", True), (1, 1): ("2", False)}


def test_loose_brackets_off_whole_runs(spark):
    raw = ["(((((name", "name)))))", "((((((( [ [{ name", "(((((a)", "]]]]]] name ]]]]]] )", "(a) b)))))", "((((((", "", "（（（（（ 名 】】】】】", None]
    want = ["name", "name", "name", "(((((a)", "]]]]]] name", "(a) b)))))", "", "", "名", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").withColumn("x", T.loose_brackets_off(F.col("x"))).orderBy("i")
    assert [r.x for r in df.collect()] == want


@pytest.mark.parametrize("raw,text,reason", [("## 3.1 弹性模量", "弹性模量", None), ("“应力”", "应力", None), ("(open", "open", None), ("图 2-1", "图 2-1", "figure_or_table_title"), ("例 3", "例 3", "worked_example_title"), ("目录", "目录", "structural_or_metadata_title"), ("2020年5月", "2020年5月", "bare_number_or_date"), ("A", "A", "single_latin_letter"), ("", "", "empty_title"), ("a@b.com", "a@b.com", "url_or_email_title"), ("锟斤拷锟", "锟斤拷锟", "garbled_title"), ("【学习目标】 力", "力", None), ("&lt;偏移&gt; 命令", "<偏移> 命令", None)])
def test_clean_title(spark, raw, text, reason):
    df = spark.createDataFrame([(raw,)], "x string").withColumn("t", T.normalize_text(F.col("x"))).select(R.clean_title(F.col("t")).alias("c"))
    c = df.first().c
    assert (c.text, c.reason) == (text, reason)


@pytest.mark.parametrize("text,want", [("Stable angina", "Stable angina"), ("table tennis", "table tennis"), ("(Fig. 2-1)", ""), ("(Table 3)", ""), ("(图 2-2)", "")])
def test_layout_references(spark, text, want):
    assert one(spark, text, lambda c: R.clean_context(c, 0)["text"]) == want


def test_two_origins_take_every_document(spark):
    from loomwright.plans.q_dedup import two_origin_merge

    d = "/root/testdata/sf0.01"
    rows = two_origin_merge(spark, d).collect()
    want = {(r.doc_id % 2, r.doc_id) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id").collect()}
    assert len(rows) == len(want) and {(r.origin, r.pos) for r in rows} == want
    ids = [r.id for r in rows if r.kept]
    assert len(ids) == len(set(ids)) and any("non_dictionary" in x for x in ids)


def test_units_are_lossless(spark):
    r = random.Random(1)
    pieces = ["# A\n", "## B ##\n", "text\n", "\n", "```\ncode\n# no\n```\n", "| a | b |\n|---|---|\n| 1 | 2 |\n", "- x\n  more\n", "$$\nx\n$$\n", "Head\n====\n", "<div>\nx\n</div>\n", "1. one\n2. two\n"]
    for _ in range(60):
        t = "".join(r.choices(pieces, k=r.randrange(1, 12)))
        u = G.split_units(t)
        assert "".join(x[1] for x in u) == t
        assert all(a[3] < b[2] for a, b in zip(u, u[1:]))
    kinds = [(k, h) for k, _, _, _, h in G.split_units("# A\nx\n## B\n```\n# c\n```\n# D\ny")]
    assert kinds == [("heading", []), ("text", ["A"]), ("heading", ["A"]), ("code", ["A", "B"]), ("heading", []), ("text", ["D"])]


def test_chunks_fit_and_are_whole():
    r = random.Random(2)
    for _ in range(50):
        t = "".join(r.choices(["word ", "a. ", "\n", "\n\n", "长句。", "x" * 70], k=60))
        c = G.pack(t, 64)
        assert "".join(c) == t and max(map(len, c)) <= 64


def test_sentences():
    t = "See e.g. this one. It costs 3.5 dollars (about 3. Really.). New line\nhere! 中文。好"
    assert [t[a:b].strip() for a, b in G.split_sentences(t)] == ["See e.g. this one.", "It costs 3.5 dollars (about 3. Really.).", "New line", "here!", "中文。", "好"]


def test_items_and_index(spark):
    text = "intro\n1. first\n   goes on\n2. second if x, except y\n\nafter\nalpha, 3, 5-7\n  beta, 9\ngamma, see alpha"
    lines = X.lines(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    got = [(r.first, r.last, r.text) for r in G.items_with_body(lines).orderBy("first").collect()]
    assert got == [(2, 3, "1. first goes on"), (4, 4, "2. second if x, except y")]
    idx = [(r.term, r.parent, r.pages, r.see) for r in G.index_entries(lines).orderBy("line_no").collect()]
    assert idx == [("alpha", None, ["3", "5-7"], ""), ("beta", "alpha", ["9"], ""), ("gamma", None, [], "alpha")]
    c = one(spark, "stop when hot, unless told", G.constraints)
    assert c.conditions and c.exceptions == ["unless told"]


def test_heading_filter(spark):
    lines = X.lines(spark.createDataFrame([(1, "# Contents\n1 Intro ..... 3\n第一章 力学\n1.2 Stress\n# What is it?")], "doc_id long, text string"))
    got = [(r.method, r.level, r.decision) for r in G.heading_filter(G.headings(lines)).orderBy("line_no").collect()]
    assert got == [("markdown", 1, "exclude"), ("numbered", 1, "exclude"), ("chinese", 1, "keep"), ("numbered", 2, "keep"), ("markdown", 1, "review")]


def test_html(spark):
    assert one(spark, "<table><tr><td>1</td><td>2</td></tr></table>", G.intact_table)
    assert not one(spark, "<table><tr><td>1<td>2</tr></table>", G.intact_table)
    assert one(spark, 'a <img src="data:image/png;base64,xx"> ![i](data:image/png;base64,yy) b', G.without_embedded_images) == "a [image] [image] b"
    assert one(spark, "keep-\nit\n![x](y)\nFigure 3: cap\nNext\nend", G.format_cleanup).replace("\n", "|") == "keepit|||end"


def test_taxonomies(spark):
    nested = {"name": "root", "children": [{"name": "a", "children": [{"name": "b"}]}, {"name": "c/d"}]}
    assert {n["path"]: n["depth"] for n in H.flatten(nested)} == {"root": 1, "root/a": 2, "root/a/b": 3, "root/c/d": 2}
    flat = {"nodes": [{"node_code": "1", "name": "x", "parent_code": None}, {"node_code": "2", "name": "y", "parent_code": "1"}]}
    assert [n["path"] for n in H.flatten(flat)] == ["x", "x/y"]
    assert len(H.flatten({"hierarchy": [{"name": "p", "l2_nodes": [{"name": "q", "l3_nodes": ["r"]}]}]})) == 3
    for bad in ({"nodes": [{"node_code": "1", "name": "x", "parent_code": "1"}]}, {"nodes": [{"node_code": "1", "name": "x", "parent_code": "9"}]}, [{"name": "a"}, {"name": "a"}]):
        with pytest.raises(ValueError):
            H.flatten(bad)
    t = H.nodes(spark, nested)
    assert H.closure(t).count() == 4 + 3 + 1 and {r.name for r in H.leaves(t).collect()} == {"b", "c/d"}


def test_recall_exclusions(spark):
    cfg = {"direct": ["力学"], "adjacent": ["物理"], "strong": ["弹性"], "weak": ["应力", "应变"], "exclude": ["小说"], "groups": [["桁架", "节点"]]}
    rows = [("力学", "小说", ""), ("", "弹性小说", ""), ("", "应力", "小说"), ("物理", "书", "应变"), ("", "书", "应力 应变"), ("", "书", "桁架 节点"), ("", "书", "弹性"), ("", "书", "应力")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, s string, t string, o string")
    got = [r.recall and r.recall.channel for r in H.recall(df, ["s"], "t", ["o"], cfg).orderBy("k").collect()]
    assert got == ["direct_subject", "title_strong_term", None, "adjacent_plus_domain", "multiple_weak_terms", "cooccurrence_group", "metadata_strong_term", None]


def test_scorer_splits_bad_batches(spark):
    def scorer(rows):
        if len(rows) > 2 or any(r["id"] == 7 for r in rows) and len(rows) > 1:
            raise ValueError("malformed")
        if rows[0]["id"] == 7:
            return []
        return [{"id": r["id"], "decision": "keep", "confidence": 0.9} for r in rows]

    got = {r.id: r.decision for r in C.judged(spark.range(10), scorer, 8).collect()}
    assert got == {k: "error" if k == 7 else "keep" for k in range(10)}
    assert C.first_object('<think>{"no":1}</think> ```json\n{"a": {"b": 1}} tail') == {"a": {"b": 1}}
    assert C.salvaged([{"field": "d", "text": "bc"}, {"field": "d", "text": "zz"}], {"d": "abcd"}, ["req-1234", "other"], "req-1243") == ([{"field": "d", "text": "bc"}], "req-1234")
    assert C.retryable(503) and not C.retryable(404) and C.retryable(429)
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate([5, 5, 5, 20, 1, 1])], "p int, o int, s int")
    assert [r.batch for r in C.packed_batches(df, "p", "o", F.col("s"), 10, 3).orderBy("o").collect()] == [0, 0, 1, 2, 3, 3]


def test_joins_fail_on_gaps(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(ValueError):
        J.covered_join(a, b, "k")
    assert J.covered_join(a.where("k = 1"), b, "k").count() == 1


def test_aggregate_helpers(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert A.distinct_rows(df, "k").count() == 2
    with pytest.raises(ValueError):
        A.distinct_rows(df.unionByName(spark.createDataFrame([(2, "c")], "k int, v string")), "k")
    with pytest.raises(ValueError):
        A.conserved(3, kept=1, removed=1)
    assert A.budgeted(["aaa", "bbbbbbbb", "cc"], 6) == ["aaa", "cc"]


def test_readers_and_sinks(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("﻿id,text\n1,\"x\ny\"\n2,a\x00b\n".encode())
    rows = readers.read_csv(spark, str(p), ["id"]).orderBy("id").collect()
    assert [(r.id, r.text) for r in rows] == [("1", "x\ny"), ("2", "ab")]
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(p), ["nope"])
    j = tmp_path / "a.jsonl"
    j.write_text('{"id": 1}\n\n{"id": 2}\n')
    assert [(r.line_no, r.id) for r in readers.read_jsonl(spark, str(j), "id int").orderBy("line_no").collect()] == [(1, 1), (3, 2)]
    (tmp_path / "bad.jsonl").write_text("[1]\n")
    with pytest.raises(Exception, match="no JSON object"):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id int").collect()
    u = tmp_path / "u"
    u.mkdir()
    (u / "1.json").write_text('{"data": [{"id": 1}, {"id": 2}]}')
    (u / "2.json").write_text('[{"id": 3}]')
    (u / "3.json").write_text('{"id": 4}\n{"id": 5}')
    assert sorted(r.id for r in readers.read_json_union(spark, str(u), "id int").collect()) == [1, 2, 3, 4, 5]
    (tmp_path / "dup.json").write_text('{"a": 1, "a": 2}')
    with pytest.raises(Exception, match="repeated key"):
        readers.read_strict_json(spark, str(tmp_path / "dup.json")).collect()
    (tmp_path / "m.md").write_bytes(b"\xef\xbb\xbfa  \n\n\n\n\n\xffb\x00")
    assert readers.read_markdown(spark, str(tmp_path / "m.md")).first().text == "a\n\n\n�b"
    df = spark.createDataFrame([(1, "x", "KEEP"), (2, "y", "DROP")], "id int, track string, decision string")
    sinks.write_csv(df, str(tmp_path / "out.csv"), ["id", "track"])
    assert readers.read_csv(spark, str(tmp_path / "out.csv")).count() == 2
    n = sinks.partitioned(df, str(tmp_path / "parts"), "track", "decision", ["x", "y"], ["KEEP", "REVIEW", "DROP"])
    assert {(r.track, r.decision): r.n for r in n.collect()} == {("x", "KEEP"): 1, ("x", "REVIEW"): 0, ("x", "DROP"): 0, ("y", "KEEP"): 0, ("y", "REVIEW"): 0, ("y", "DROP"): 1}
    assert (tmp_path / "parts" / "track=x" / "decision=DROP").is_dir()
    with pytest.raises(ValueError):
        sinks.partitioned(df, str(tmp_path / "p2"), "track", "decision", ["x"], ["KEEP", "DROP"])
    assert json.loads(sinks.report_json(df, ["track"], a=1))["track"] == {"x": 1, "y": 1}
    assert {r.route: r.n for r in sinks.routed(df, str(tmp_path / "r"), F.col("decision")).collect()} == {"KEEP": 1, "DROP": 1}


def test_path_resolution(spark):
    rows = spark.createDataFrame([("/a/x.md",), ("oss://b/c/y.md",), ("/old/z.md",), ("/old/w.md",), ("/gone",)], "p string")
    known = spark.createDataFrame([("/a/x.md",), ("/m/c/y.md",), ("/k/z.md",), ("/k/w.md",), ("/l/w.md",)], "path string")
    maps = spark.createDataFrame([("oss://b/", "/m/"), ("oss://", "/n/")], "prefix string, root string")
    got = {r.p: (r.resolved, r.how) for r in readers.resolve_paths(rows, "p", maps, known).collect()}
    assert got == {"/a/x.md": ("/a/x.md", "own"), "oss://b/c/y.md": ("/m/c/y.md", "mapped"), "/old/z.md": ("/k/z.md", "name"), "/old/w.md": (None, "ambiguous"), "/gone": (None, "missing")}


def test_stream_resume(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    spark.range(5).selectExpr("id as key").write.parquet(src)
    stream = lambda: spark.readStream.schema("key long").parquet(src)
    checkpoints.process(spark, stream(), lambda d: d.selectExpr("key", "key * 2 as v"), out, ck, "key", "p1")
    spark.range(3, 8).selectExpr("id as key").write.mode("append").parquet(src)
    checkpoints.process(spark, stream(), lambda d: d.selectExpr("key", "key * 3 as v"), out, ck, "key", "p1")
    got = {r.key: r.v for r in checkpoints.latest(spark, out, "key", "p1").collect()}
    assert got == {0: 0, 1: 2, 2: 4, 3: 9, 4: 12, 5: 15, 6: 18, 7: 21}
    done, other = readers.completed(spark, out, "p0")
    assert done.count() == 0 and other == 10


def test_task_resume(spark, tmp_path):
    calls = []

    def double(d):
        calls.append(1)
        return d.selectExpr("id * 2 as id")

    tasks = [P.Task("a", double, ["x"])]
    for _ in range(2):
        out = P.run(spark, tasks, str(tmp_path), {"x": spark.range(3)})
    assert len(calls) == 1 and sorted(r.id for r in out["a"].collect()) == [0, 2, 4]
    assert P.check([P.Task("b", double, ["missing"])]) == ["b needs missing"]


def test_restore_and_language(spark):
    df = spark.createDataFrame([("Stress", ""), ("", "应力"), ("Stress", "应力"), ("应力", "stress")], "z string, e string")
    got = [(r.m.zh, r.m.en, r.m.move) for r in df.select(R.language_move(F.col("z"), F.col("e")).alias("m")).collect()]
    assert got == [("", "Stress", "zh->en"), ("应力", "", "en->zh"), ("应力", "Stress", "swap:zh,en"), ("应力", "stress", "")]


def test_without_llm(tmp_path):
    """The rest works where the training-data folders are gone."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for n in ("loomwright", "__spark_entry__.py"):
        (shutil.copytree if os.path.isdir(f"{root}/{n}") else shutil.copy)(f"{root}/{n}", tmp_path / n)
    shutil.rmtree(tmp_path / "loomwright" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert q and not [k for k in q if k.startswith('op') or k == 'pipeline'] and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_many_strata_and_prefix_lengths(spark):
    df = spark.range(150_000).selectExpr("id as k", "concat('s', id % 120000) as g")
    got = S.stratified(df, "g", "k", 130_000, 1)
    assert got.count() == 130_000 and got.select("g").distinct().count() == 120_000
    small = spark.createDataFrame([("a", k) for k in range(5)] + [("b", 10 + k) for k in range(3)] + [(None, 20), (None, 21)], "g string, k long")
    assert {r.g: r.n for r in S.stratified(small, "g", "k", 5, 1).groupBy("g").agg(F.count("*").alias("n")).collect()} == {"a": 3, "b": 1, None: 1}
    text = "x" * 2500
    prefixes = spark.createDataFrame([("x" * n, str(n)) for n in range(1, 2001)] + [("y", "y")], "p string, v string")
    rows = spark.createDataFrame([(text,), ("xx",), ("z",), ("y",), (None,)], "t string")
    assert {r.t: r.v for r in J.longest_prefix(rows, "t", prefixes, "p", "v").collect()} == {text: "2000", "xx": "2", "z": None, "y": "y", None: None}


def test_names_of_any_length(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "five")], "doc_id long, text string")
    names = spark.createDataFrame([("Two three four five SIX",), ("five",), ("six one",)], "name string")
    got = sorted((r.name, r.doc_id, r.place) for r in J.mentions(docs, names, "doc_id", "text", "name").collect())
    assert got == [("Two three four five SIX", 1, 1), ("five", 1, 4), ("five", 2, 0)]
    assert J.mentions(docs, names.limit(0), "doc_id", "text", "name").count() == 0


def test_beams_start_from_every_root(spark):
    tree = spark.createDataFrame([("A", None), ("A1", "A"), ("B", None), ("B1", "B"), *[(f"B{k + 1}", f"B{k}") for k in range(1, 12)]], "code string, parent string")
    records = spark.createDataFrame([(1, "A1"), (2, "B")], "record long, want string")
    score = lambda d: d.withColumn("p", F.when(F.startswith("child", "want"), 0.9).otherwise(0.2)).withColumn("stop", F.lit(False))
    got = {r.record: (r.path, r.decision) for r in H.beam_route(records, tree, score, width=2, threshold=0.5).collect()}
    assert got == {1: (["A1"], "accepted_leaf"), 2: ([f"B{k}" for k in range(1, 13)], "accepted_leaf")}


def test_deep_heading_parents(spark):
    heads = spark.createDataFrame([(1, k, k, f"h{k}") for k in range(1, 9)] + [(1, 9, 2, "x")], "doc_id long, line_no int, level int, title string")
    got = {r.line_no: r.parents for r in X.heading_paths(heads, "doc_id", "line_no", "level", "title").collect()}
    assert got[8] == [f"h{k}" for k in range(1, 8)] and got[9] == ["h1"]


def test_rejections_keep_earlier_flags(spark):
    got = one(spark, "~=" * 150, lambda c: R.clean_title(c))
    assert got.reason in ("symbol_dominated_title", "no_usable_title_characters", "garbled_title")
    got = one(spark, "。," * 90, lambda c: R.clean_title(c))
    assert got.reason == "no_usable_title_characters" and got.flags == ["overlong_title_requires_model_review"]


def test_report_refuses_many_keys(spark, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_KEYS", 3)
    df = spark.createDataFrame([(str(k),) for k in range(4)], "a string")
    with pytest.raises(ValueError, match="over 3 keys"):
        sinks.report_json(df, ["a"])
    assert json.loads(sinks.report_json(df.limit(2), ["a"], x=1))["settings"] == {"x": 1}


def test_term_hits_against_one_pattern(spark):
    """The same terms as one pattern finds that is tried at every place, the longest first."""
    import re

    terms = ["data", "data mining", "mining", "c++", "机器", "机器学习", "学习", "a.b", "in the", "the"]
    texts = ["data mining in the mine", "big data, and data mining", "mydata mining", "c++ and c+", "机器学习", "机器 学习", "a.b axb", "bin then in the", "", None, "data data-mining"]
    p = re.compile(f"(?=({T.term_pattern(terms)}))")
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(T.term_hits(F.col("x"), terms).alias("y")).collect()
    assert [sorted(r.y) for r in got] == [sorted({m.group(1) for m in p.finditer(t or "")}) for t in texts]
