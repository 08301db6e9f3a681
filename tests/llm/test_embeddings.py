import numpy as np

from loomwright.llm import op10_embeddings as op10


def brute(rows, threshold=0.98):
    good = {}
    for i, e, lab in rows:
        if i is not None and e is not None and lab is not None and len(e) and all(c is not None and np.isfinite(c) for c in e) and any(e):
            good[i] = (lab, np.array(e, np.float64) / np.linalg.norm(np.array(e, np.float64)))
    links, root = {i: 0 for i in good}, {i: i for i in good}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(good)
    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if good[i][0] == good[j][0] and len(good[i][1]) == len(good[j][1]) and good[i][1] @ good[j][1] >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (links.get(i, 0), find(i) if i in good else i) for i, _, _ in rows}


def fixture(n=900, dim=24, seed=3):
    r = np.random.default_rng(seed)
    rows = []
    centres = r.standard_normal((60, dim))
    for k in range(n):
        c = centres[int(abs(r.standard_normal()) * 12) % 60]
        rows.append((k * 3, [float(np.float32(x)) for x in c + r.standard_normal(dim) * r.choice([0.02, 0.1, 0.5])], int(r.integers(0, 3))))
    return rows


ODD = [(9001, None, 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] * 24, 1), (9004, [1.0] * 23 + [None], 1), (9005, [1.0] * 24, None), (9006, [1.0] * 24, 2), (9007, [2.0] * 24, 2), (9008, [1.0] * 24, 2), (9009, [1.0] * 5, 2), (9010, [1.0] * 5, 2), (9011, [], 2), (9012, [1e200] * 24, 2), (9013, [float("inf")] * 24, 2)]


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as id", "2 as tree")
    return {r.vec_id: (r.n_links, r.component_id) for r in op10.near_vectors(df).collect()}


def test_whole_leaves(spark):
    rows = fixture() + ODD
    want = brute([x for x in rows if x[0] != 9012])
    got = run(spark, rows)
    same = {9006, 9007, 9008, 9012}
    assert {k: v for k, v in got.items() if k not in same} == {k: v for k, v in want.items() if k not in same}
    assert all(got[k] == (3, 9006) for k in same)


def test_forest_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op10, "LEAF", 40)
    monkeypatch.setattr(op10, "BLOCK", 50)
    rows = fixture(seed=4)
    want, got = brute(rows), run(spark, rows)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert found <= true and found >= 0.97 * true
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(got[i][1] == want[i][1] for i in got) >= 0.97 * len(got)


def test_driver_rows(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert run(spark, rows) == brute(rows)


def test_empty_and_repeated(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, op10.near_vectors(df).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)], key=repr)


def test_below_the_sample(spark, monkeypatch):
    """Leaves that no sampled vector reaches are split too; memory of a tree goes by the sample."""
    monkeypatch.setattr(op10, "SAMPLE", 30)
    monkeypatch.setattr(op10, "LEAF", 20)
    rows = fixture(seed=6)
    want, got = brute(rows), run(spark, rows)
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.9 * links
    assert all(got[k][0] <= want[k][0] for k in want)
    x = op10._unit([e for _, e, _ in rows[:30]])
    assert len(op10.fit_tree(x, 0, 20, 0.01).nodes) < 30 * 20


def test_codes():
    codes = [[1, 5], [], [1 << 24]]
    assert op10.unpack_codes(op10.pack_codes(codes)) == codes
