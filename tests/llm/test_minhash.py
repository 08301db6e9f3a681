import itertools
import random

import pytest

from loomwright.llm import op03_minhash as op3
from loomwright.llm.common import components


def brute(rows, size, percent):
    sets = {i: op3.exact_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def near_copies():
    """A chain of edits, whose ends are far apart, star copies, and groups that share a passage."""
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(4000)]
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append((n * 7 % 1009, " ".join(words)))
        n += 1

    base = r.choices(vocab, k=200)
    for _ in range(40):
        add(base)
        base = list(base)
        base[r.randrange(200)] = r.choice(vocab)
        base[r.randrange(200)] = r.choice(vocab)
    star = r.choices(vocab, k=150)
    for _ in range(80):
        x = list(star)
        for k in range(r.randrange(5)):
            x[r.randrange(150)] = r.choice(vocab)
        add(x)
    passage = r.choices(vocab, k=60)
    for _ in range(60):
        add(passage + r.choices(vocab, k=r.randrange(5, 40)))
    for _ in range(30):
        add(r.choices(vocab, k=r.randrange(0, 6)))
    return rows


ODD = [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "one two"), (2007, "Été x y"), (2008, "été x y"), (2009, "a b " * 20000), (2010, "b a " * 20000), (2011, "x\x1fy z")]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, size, percent):
    rows = near_copies() + ODD + [(3000 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).selectExpr("*", "'z' as bits", "1 as id", "2 as component_id")
    assert sorted(map(tuple, op3.near_duplicates(df, size=size, percent=percent).collect())) == brute(rows, size, percent)


def test_repeats_null_ids_and_empty(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (5, "a b c d"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, op3.near_duplicates(df, size=3, percent=85).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (5, 2, 1, False), (None, 2, None, True), (None, 0, None, True)], key=repr)
    assert op3.near_duplicates(df.limit(0)).count() == 0
    assert op3.keep_first(df.limit(0)).count() == 0


def test_ids_of_several_texts(spark):
    """An id's text is the one of least hash that has words, in every run and whatever the order of rows."""
    from pyspark.sql import functions as F

    rows = [(1, "a b c d"), (1, "q r s t"), (1, ""), (2, "a b c d"), (3, "q r s t"), (4, None), (4, "x y z"), (5, "x y z")]
    base = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r.text: r.h for r in base.select("text", F.xxhash64("text").alias("h")).collect()}
    first = min("a b c d", "q r s t", key=hashes.__getitem__)
    want = sorted((i, 0 if not t else len(op3.exact_set(t, 3)), {1: 1, 2: 1 if first == "a b c d" else 2, 3: 1 if first == "q r s t" else 3, 4: 4, 5: 4}[i]) for i, t in rows)
    for n in (1, 3):
        df = base.repartition(n, F.rand(n)).selectExpr("*", "'z' as _gone", "1 as gone", "2 as sift", "3 as row", "map('k', 1) as m")
        got = op3.near_duplicates(df, size=3, percent=85)
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want
        kept = op3.keep_first(df, size=3, percent=85)
        assert kept.columns == df.columns
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, first), (2 if first != "a b c d" else 3, "a b c d" if first != "a b c d" else "q r s t"), (4, "x y z")])


def test_large_classes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op3, "HOT", 3)
    monkeypatch.setattr(op3, "BLOCK", 4)
    monkeypatch.setattr(op3, "CENTRES", 1)
    rows = near_copies() + [(5000 + k, "one text of several words that is met often") for k in range(20)] + [(6000 + k, None) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, op3.near_duplicates(df, size=3, percent=85).collect())) == brute(rows, 3, 85)


def test_estimate_is_close(spark):
    import numpy as np

    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = pool[:2700], pool[300:]
    m = op3._pack(np.stack([op3.minima(a, op3.SIGNED), op3.minima(b, op3.SIGNED)]))
    df = spark.createDataFrame([(m[0].tolist(), m[1].tolist())], "a array<long>, b array<long>")
    assert abs(df.select(op3.estimate("a", "b")).first()[0] - 0.8) < 0.06


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_crowd_that_stays_apart(spark):
    """Thousands of different components in one bucket: their millions of pairs are compared within seconds."""
    import time

    import numpy as np

    n, near = 3000, {(k, k + 1500) for k in range(0, 1000, 7)}
    r = np.random.default_rng(3)
    bits = r.integers(-(2**63), 2**63, (n, op3.SIGNED // 32), dtype=np.int64)
    for a, b in near:
        bits[b] = bits[a]
        bits[b, :2] = r.integers(-(2**63), 2**63, 2)
    rows = spark.createDataFrame([(1, k, k if k not in (1507, 1514) else k - 1500, 100 if k != 1521 else 200, bits[k].tolist()) for k in range(n)], "key long, id long, c long, n_shingles long, bits array<long>").repartition(4).localCheckpoint()
    began = time.time()
    got = {tuple(p) for p in op3._near_in_buckets(rows.select("key", "id", "c"), rows.select("id", "n_shingles", "bits"), 85).collect()}
    assert time.time() - began < 20  # as a join on the signatures: a minute
    assert got == {(b, a) for a, b in near if b not in (1507, 1514, 1521)}


def test_crowd_leaves_its_bucket_as_few_links(spark):
    """However many pairs of a group are near, fewer rows than the group has leave it, and they join the same."""
    n = 300
    r = random.Random(11)
    vocab = [f"w{k}" for k in range(3000)]
    base = r.choices(vocab, k=200)
    texts = []
    for k in range(n):  # half a tight group, half near misses of one another, which some are linked in
        x = list(base)
        for _ in range(3 if k % 2 else 7):
            x[r.randrange(200)] = r.choice(vocab)
        texts.append((k, " ".join(x)))
    df = spark.createDataFrame(texts, "id long, text string").repartition(3).localCheckpoint()
    mark = op3.signed(df, 3).localCheckpoint()
    rows = df.selectExpr("explode(array(1L, 2L)) as key", "id", "id as c").localCheckpoint()
    allowed = op3._near_in_buckets(rows, mark, 85)
    assert n / 2 <= allowed.count() < 2 * n  # of 14,024 pairs, each of which left it before
    got = [tuple(p) for p in op3._near_in_buckets(rows, mark, 85, df, 3).collect()]
    sets = {k: op3.exact_set(t, 3) for k, t in texts}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    assert len(got) < 2 * n and all(linked(a, b) for a, b in got)
    assert sum(linked(a, b) for a, b in itertools.combinations(range(n), 2)) > 5 * n
    want = [c for _, _, c, _ in brute(texts, 3, 85)]
    near = dict(map(tuple, components(spark.createDataFrame(got, "a long, b long")).collect()))
    assert [near.get(k, k) for k in range(n)] == want


@pytest.mark.parametrize("size", [1, 3, 5])
def test_sets_as_numbers(size):
    texts = [t for _, t in ODD + near_copies()[-40:]] + ["a b a b a b a", "a b a b", "b a b"]
    flat, off = op3._exact_sets(texts, size)
    sets, numbers = [op3.exact_set(t, size) for t in texts], [set(flat[a:b].tolist()) for a, b in zip(off, off[1:], strict=False)]
    assert [len(s) for s in sets] == [len(s) for s in numbers] == (off[1:] - off[:-1]).tolist()
    assert all(len(a & b) == len(x & y) for a, x in zip(sets, numbers, strict=True) for b, y in zip(sets, numbers, strict=True))
