import hashlib
import re

from loomwright.llm import op09_decontaminate as op9

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = low(t)
        if w:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                wins.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = low(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if x := wins.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= x
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


LONG = "Alpha beta GAMMA delta épsilon zeta eta theta iota kappa lambda mu nu"
ITEMS = [(1, LONG), (2, "short Item"), (30, "beta gamma delta épsilon zeta eta theta iota kappa lambda"), (4, None), (5, "... !"), (6, "x1"), (7, "short item"), (1, LONG)]
DOCS = [(1, None), (2, ""), (3, "!!!"), (4, LONG + " xx " + LONG.upper().replace("É", "é")), (5, "a short-item b shortitem short  ITEM"), (6, "x1 x1"), (7, "ÀÉ x " * 5), (8, LONG[:40]), (8, LONG), (9, "kappa lambda " * 30000), (None, "short item")]


def test_against_brute_force(spark):
    d, b = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as items", "2 as w", "3 as row", "4 as _bad", "5 as gone", "6 as sift", "7 as id"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(map(tuple, op9.report(d, b).collect()), key=repr)
    assert got == brute(DOCS, ITEMS)
    kept = {r.doc_id for r in op9.drop_contaminated(d, b).collect()}
    assert op9.drop_contaminated(d, b).columns == d.columns
    assert kept == {1, 2, 3, 7, 9, None}
    spans = {r.doc_id: r.kept_words for r in op9.remove_spans(d, b).where("doc_id in (4, 5)").collect()}
    assert spans == {4: "xx", 5: "a b shortitem"}


def test_shuffled_lookup_and_empty(spark, monkeypatch):
    d, b = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(op9, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, op9.report(d, b).collect()), key=repr) == brute(DOCS, ITEMS)
    spans = {r.doc_id: r.kept_words for r in op9.remove_spans(d, b).where("doc_id in (4, 5)").collect()}
    assert spans == {4: "xx", 5: "a b shortitem"}
    assert op9.report(d.limit(0), b).count() == 0
    assert sorted(map(tuple, op9.report(d, b.limit(0)).collect()), key=repr) == brute(DOCS, [])


def test_native(spark):
    d, b = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = op9.report(d, b)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
