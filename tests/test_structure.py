"""Name grouping, routing constraints, body tails, label coverage, regions and indexes on small tables."""
import pytest
from pyspark.sql import functions as F

from loomwright.operators import rules as R
from loomwright.operators import segment as G
from loomwright.operators import trees as B
from loomwright.operators import windows as X

L = F.lit


def test_names_of_one_spelling(spark):
    d = spark.createDataFrame([(1, "Heat", 3), (1, "heat", 1), (1, "HEAT ", 2), (2, "Heat", 9), (2, None, 1), (2, " ", 2)], "doc long, term string, k long")
    got = {(r.doc, r.key): (r.name, r.places) for r in G.grouped_names(d, "doc", "term", "k").collect()}
    assert got == {(1, "heat"): ("heat", [1, 2, 3]), (2, "heat"): ("Heat", [9])}
    assert G.grouped_names(d.limit(0), "doc", "term", "k").count() == 0


def test_constraints_take_candidates_away(spark):
    d = spark.createDataFrame([(1, [("a", 0.9), ("b", 0.2), ("c", None)]), (2, []), (3, None)], "id int, tops array<struct<path string, score double>>")
    rules = {"score": lambda c: c["score"] >= 0.5, "not_a": lambda c: c["path"] != "a"}
    got = {r.id: ([t.path for t in r.tops] if r.tops is not None else None, r.vetoes) for r in B.constrained(d, "tops", rules).collect()}
    assert got == {1: (["c"], ["score", "not_a"]), 2: ([], []), 3: (None, [])}
    assert B.constrained(d, "tops", {}).where("id = 1").first().vetoes == []


@pytest.mark.parametrize("body, want", [
    ("Heat flows. It stops.", "Heat flows. It stops."),
    ("Heat flows. It sto-", "Heat flows."),
    ("Heat flows! As Dr. Roe", "Heat flows!"),
    ("Heat flows. See Fig.", "Heat flows."),
    ("热会流动。然后", "热会流动。"),
    ("no sentence here", "no sentence here"),
    ("", ""),
    (None, None),
])
def test_tails(spark, body, want):
    assert spark.range(1).select(G.trimmed_tail(L(body).cast("string")).alias("y")).first().y == want


def test_long_tail(spark):
    body = "Word goes on. " * 200_000 + "and breaks"
    d = spark.createDataFrame([(body,)], "t string")
    assert d.select(F.length(G.trimmed_tail(F.col("t")))).first()[0] == len(body) - len(" and breaks")


def test_labels_cover_once(spark):
    d = spark.createDataFrame([(1, [(2,), (1,)]), (2, [(1,), (1,)]), (3, [(1,), (3,)])], "id int, l array<struct<no int>>")
    assert {r.id: r.y for r in d.select("id", R.label_coverage(F.col("l"), 2).alias("y")).collect()} == {1: True, 2: False, 3: False}


def test_index_parents(spark):
    d = spark.createDataFrame([(1, "Heat, 3, 5-7\n  flow, 9\nWork, see Heat\nplain")], "doc_id long, text string")
    got = [(r.term, r.parent, r.pages) for r in G.index_entries(X.lines(d)).orderBy("line_no").collect()]
    assert got == [("Heat", None, ["3", "5-7"]), ("flow", "Heat", ["9"]), ("Work", None, [])]
