"""Layout operators against walks through the units, and token counts against the library."""
import re

import pytest
from pyspark.sql import functions as F

from loomwright.operators import layout as L
from loomwright.operators import score as C
from loomwright.sources import readers

UNITS = [("heading", "# Contents"), ("text", "Alpha ..... 3\nBeta 12"), ("code", "    indented 5"), ("heading", "## One 7"), ("text", "Gamma (iv)"), ("text", "A sentence of the book. And more."), ("text", "Delta 9"), ("heading", "# Index"), ("text", "No pages yet. But index"), ("heading", "A"), ("text", "apple, 3"), ("text", "Pear. See apple"), ("heading", "## 4 Text"), ("text", "z"), ("heading", "# Glossary"), ("text", "Term: meaning. Whole sentences."), ("table", "| a |"), ("heading", "# Two"), ("text", "x"), ("heading", "392 Index"), ("text", "b, 5"), ("text", "then prose. It ends."), ("text", "c, 6")]


def walk(units):
    out, active, started = [], None, False
    for kind, text in units:
        label = re.sub(r"^\s*#+\s*", "", text).strip()
        lines = [x.strip() for x in text.split("\n") if x.strip()]
        page = lambda x: bool(re.search(L.PAGE_SUFFIX.replace(r"\z", r"\Z"), x))
        if kind == "heading":
            name = re.sub(r"^(?:\d+|[ivxlcdm]+)\s+(?=index$|contents$)", "", label.lower())
            if name in L.REGIONS:
                active, started = L.REGIONS[name], False
            elif active == "index" and re.fullmatch("[A-Za-z]", label):
                pass
            elif active in ("toc", "index") and page(label):
                started = active == "index"
            else:
                active = None
            out.append(active)
            continue
        if active in ("toc", "index"):
            if kind == "code" and all(x.startswith(("    ", "\t")) for x in text.split("\n") if x.strip()):
                out.append(None)
                continue
            toc = any(len(x) > 180 or re.search(r"[。！？;；]|!\[", x) or (not page(x) and re.search(r"[.!?](?:\s|$)", x)) for x in lines)
            index = started and any(not page(x) and not re.search(r"(?i)[.,]\s+See(?: also)?\s+\S", x) and (len(x) > 180 or re.search(r"[。！？;；]|!\[|[.!?](?:\s|$)", x)) for x in lines)
            if kind in ("code", "table", "math") or (active == "toc" and toc) or (active == "index" and index):
                active = None
            elif active == "index" and any(map(page, lines)):
                started = True
        out.append(active)
    return out


def test_regions(spark):
    df = spark.createDataFrame([(1, k, *u) for k, u in enumerate(UNITS)] + [(2, 0, "text", "x 1")], "doc_id int, unit_no int, kind string, text string")
    got = {(r.doc_id, r.unit_no): r.region for r in L.navigation_regions(df).collect()}
    want = walk(UNITS)
    assert {"toc", "index", "glossary", None} == set(want)
    assert [got[1, k] for k in range(len(UNITS))] == want and got[2, 0] is None


def test_capitals_are_the_main_style(spark):
    rows = [(1, 2 * k, "heading", f"# HEAD NO {chr(65 + k)}") for k in range(22)] + [(1, 2 * k + 1, "heading", "## lower") for k in range(5)] + [(2, 0, "heading", "# ONE"), (2, 1, "heading", "# two")]
    got = {(r.doc_id, r.unit_no): r.head_role for r in L.annotated(spark.createDataFrame(rows, "doc_id int, unit_no int, kind string, text string")).collect()}
    assert got[1, 0] == "main_style" and got[1, 1] == "secondary_style" and got[2, 0] is None and got[2, 1] is None


def test_font_breaks(spark):
    rows = [(1, 1, "It begins", 1.0), (1, 2, "SMALL", 0.7), (1, 3, "and ends.", 1.0), (1, 4, "New", 1.4)]
    got = L.font_breaks(spark.createDataFrame(rows, "doc_id int, line_no int, line string, size_ratio double")).collect()
    assert [r.line_no for r in got] == [2, 3]


@pytest.mark.parametrize("text,budget,want", [("One. Two three", 9, 4), ("abc def ghi", 8, 7), ("abcdefgh", 4, 0), ("ab", 5, 2), ("x", 0, 0)])
def test_whole_sentences(spark, text, budget, want):
    assert spark.range(1).select(L.whole_sentences(F.lit(text), F.lit(budget)).alias("y")).first().y == want


def test_candidate_ids(spark):
    findings = spark.createDataFrame([("c", "n", ["u", "v"], True), ("c", "n", ["u", "v"], True)], "chunk_id string, name string, evidence_ids array<string>, needs_context boolean")
    parts = spark.createDataFrame([("c", "u", "bc", None), ("c", "v", "xx", 1)], "chunk_id string, unit_id string, text string, start int")
    units = spark.createDataFrame([("u", "abcd", ["h1"]), ("v", "xxx", ["h1", "h2"])], "unit_id string, text string, headings array<string>")
    r = L.made_candidates(findings, parts, units).collect()
    assert len(r) == 1 and r[0].problem is None and [tuple(x) for x in r[0].spans] == [("u", 1, 3), ("v", 1, 3)]
    assert r[0].issues == ["context_incomplete", "source_unit_split"] and r[0].scope == ["h1", "h2"] and re.fullmatch("c-[0-9a-f]{20}", r[0].candidate_id)
    wrong = L.made_candidates(findings, parts.withColumn("start", F.lit(0)), units).collect()
    assert [x.problem for x in wrong] == ["slice_differs"]


def test_request_tokens(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = [(1, 2, "assistant", "hi there"), (1, 1, "user", "What is it?"), (2, 1, None, None)]
    got = {r.c: r.n_tokens for r in C.request_tokens(spark.createDataFrame(rows, "c int, t int, r string, x string"), path, "c", "t", "r", "x").collect()}
    texts = {1: "<|user|>\nWhat is it?\n<|assistant|>\nhi there\n<|assistant|>\n", 2: "<||>\n\n<|assistant|>\n"}
    assert got == {k: len(tok.encode(t, add_special_tokens=False).ids) for k, t in texts.items()}


def test_sqlite(spark, tmp_path):
    import sqlite3

    for k in range(2):
        db = sqlite3.connect(tmp_path / f"{k}.sqlite")
        db.execute("CREATE TABLE done (key TEXT, policy_version TEXT)")
        db.executemany("INSERT INTO done VALUES (?, ?)", [(f"a{k}", "v1"), (f"b{k}", "v2"), ("same", "v1")])
        db.commit()
        db.close()
    done, other = readers.completed_sqlite(spark, str(tmp_path), "done", "v1")
    assert sorted(r.key for r in done.collect()) == ["a0", "a1", "same"] and other == 2
