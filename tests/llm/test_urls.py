import itertools
import re
from collections import Counter

from loomwright.llm import op06_urls as op6


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    h = re.match(r"[^/?#]*", rest).group()
    return "".join(c.lower() if c.isascii() else c for c in h), re.match(r"[^?#]*", rest[len(h) :]).group()


def fixed(url):
    h, p = parts(url)
    fits = [(len(r), len(r.split("/")[0]), r, v) for r, v in op6.RULES for rh, rp in [r.split("/", 1)] if (h == rh or h.endswith("." + rh)) and p.startswith("/" + rp)]
    return max(fits)[2:] if fits else (None, None)


URLS = ["https://a.example.net/en/x", "https://example.net/en/", "https://example.net/fr", "http://NET/", "http://net", "http://xnet/", "http://b.org/fr/1", "http://org/fr", "x://shop.example.com/de/1?a=/b", "http://spam-farm.io/win/12", "http://q.spam-farm.io/lose/3#x", "http://ok.io/win/9", "http://z.io?u=http://net/", "nothing", "", None, "http://É.net/x", "http://ok.io/" + "a/" * 20000]


def labelled():
    rows = []
    for k in range(40):
        rows += [(f"http://h{k}.spam-farm.io/win/{k}", "block"), (f"http://h{k}.ok.io/win/{k}", "allow"), (f"https://h{k}.ok.io/lose/{k}", "allow" if k % 4 else "block")]
    return [*rows, (None, "block"), ("x", None)]


def brute_rules(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[0] and r[1]], "url string, verdict string").select(op6.tokens(op6.F.col("url")).alias("t"), "verdict").collect()
    where = {}
    for k, r in enumerate(df):
        for t in r.t:
            where.setdefault(t, []).append(k)
    first = {min(t for t in where if where[t] == where[u]) for u in where}  # of tokens in the same urls
    seen, hits = Counter(), Counter()
    for r in df:
        own = sorted(first.intersection(r.t))
        for n in range(1, len(own) + 1):
            for c in itertools.combinations(own, n):
                seen[c] += 1
                hits[c, r.verdict] += 1
    n = len(df)
    good = {(c, v): (hits[c, v] / n, hits[c, v] / seen[c]) for c, v in hits if hits[c, v] / n >= op6.LEAST_SUPPORT * 10 and hits[c, v] / seen[c] >= op6.LEAST_CONFIDENCE}
    return {k: x for k, x in good.items() if not any((tuple(i for i in k[0] if i != o), k[1]) in good and good[tuple(i for i in k[0] if i != o), k[1]][1] >= x[1] for o in k[0])}


def test_fixed_rules_and_mined(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(0, URLS[0]), (None, None)], "page_id long, url string").selectExpr("*", "'h' as host", "1 as token")
    lab = spark.createDataFrame(labelled(), "url string, verdict string")
    rules = op6.mine(lab, support=op6.LEAST_SUPPORT * 10)
    want = brute_rules(spark, labelled())
    assert {(tuple(r["items"]), r.verdict): (round(r.support, 9), round(r.confidence, 9)) for r in rules.collect()} == {k: (round(a, 9), round(b, 9)) for k, (a, b) in want.items()}
    got = op6.judge(pages, lab).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[r.page_id] if r.page_id is not None else None
        rule, verdict = fixed(url)
        assert (r.host, r.path, r.rule) == (*parts(url), rule)
        if rule:
            assert r.verdict == verdict
    by = {URLS[r.page_id]: r.verdict for r in got if r.page_id is not None}
    assert by["http://spam-farm.io/win/12"] == "block" and by["http://ok.io/win/9"] == "allow" and by["nothing"] == "allow"


def test_matching_against_brute_force(spark):
    lab = spark.createDataFrame(labelled(), "url string, verdict string")
    rules = [(set(r["items"]), r.confidence, r.support, len(r["items"]), r.rule_id, r.verdict) for r in op6.mine(lab).collect()]
    urls = spark.createDataFrame([(u,) for u in URLS], "url string")
    tok = {r.url: set(r.t) for r in urls.select("url", op6.tokens(op6.F.col("url")).alias("t")).collect()}
    want = {}
    for u, t in tok.items():
        fits = [r[1:] for r in rules if r[0] <= t]
        if fits and u is not None:
            want[u] = (max(fits)[4], max(fits)[3])
    assert {r.url: (r.mined, r.mined_rule) for r in op6.mined_verdicts(urls, op6.mine(lab)).collect()} == want


def test_without_labels_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://ok.io/")], "page_id long, url string")
    none = spark.createDataFrame([], "url string, verdict string")
    assert [r.verdict for r in op6.judge(pages, none).collect()] == ["allow"]
    assert op6.judge(pages.limit(0), none).count() == 0


def test_long_urls_of_one_template(spark):
    """Forty tokens that always come together, and twenty that come almost always, are no forty-fold doubling."""
    rows = [("http://t.io/" + "/".join(f"a{k}" for k in range(40)) + "/" + "/".join(f"b{k}" for k in range(20) if (k * 7 + j) % 11) + f"/{'x' if j % 2 else 'y'}", "block" if j % 2 else "allow") for j in range(60)]
    lab = spark.createDataFrame(rows, "url string, verdict string")
    rules = op6.mine(lab).collect()
    assert {(tuple(r["items"]), r.verdict) for r in rules} >= {(("p:x",), "block"), (("p:y",), "allow")}
    assert all(r.confidence == 1.0 for r in rules if r["items"] in (["p:x"], ["p:y"]))


def test_urls_of_many_tokens(spark):
    """More tokens in a url than FP-growth is given: rules over any of them are found, as brute force finds them."""
    import random

    r = random.Random(4)
    rows = []
    for _ in range(60):
        own = sorted(r.sample(range(17), 13))
        rows.append(("http://t.io/" + "/".join(f"a{k}" for k in own), "block" if {3, 5} <= set(own) or r.random() < 0.2 else "allow"))
    lab = spark.createDataFrame(rows, "url string, verdict string")
    want = brute_rules(spark, rows)
    got = {(tuple(x["items"]), x.verdict): (round(x.support, 9), round(x.confidence, 9)) for x in op6.mine(lab, support=op6.LEAST_SUPPORT * 10).collect()}
    assert got == {k: (round(a, 9), round(b, 9)) for k, (a, b) in want.items()}


def test_grown_sets_give_the_same_rules(spark, monkeypatch):
    """Urls without tokens count for the support."""
    lab = spark.createDataFrame([*labelled(), *((f"plain{k}", "allow") for k in range(100))], "url string, verdict string")
    a = {(tuple(x["items"]), x.verdict, x.support, x.confidence) for x in op6.mine(lab).collect()}
    monkeypatch.setattr(op6, "MOST_TOKENS", 0)
    assert a and a == {(tuple(x["items"]), x.verdict, x.support, x.confidence) for x in op6.mine(lab).collect()}
