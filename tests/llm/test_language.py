import zlib

import numpy as np
import pytest

from loomwright.llm import op07_language as op7


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return op7.train(docs, ~op7.held_out())


def test_held_out_accuracy(spark, docs, model):
    got = op7.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    gap = abs(np.mean([r.score for r in out]) - np.mean([r.lang == r.lang_pred for r in out]))
    assert gap < 0.05
    assert (model.weights == 0).mean() > 0.5  # the penalty leaves a sparse model


def test_awkward_texts(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "der und die " * 100000), (None, "the and of that"), (5, "the and of that"), (5, "the and of that"), (6, "日本語"), (7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "0.5D as score", "1 as id")
    got = op7.identify(df, model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got if r.doc_id in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert len(got) == 9 and [r.lang_pred for r in got if r.doc_id == 4] == ["de"]
    assert op7.identify(df.limit(0), model).count() == 0
    kept = op7.keep_identified(df, model)
    assert kept.columns == df.columns and {1, 2, 3}.isdisjoint({r.doc_id for r in kept.collect()})


def test_pieces_equal_whole(model, monkeypatch):
    texts = ["Straße und Haus 12 " * 50, "a", "la maison est là, " * 9, "x1y2"]
    want = model.logits(texts)
    alone = [model.logits([t])[0] for t in texts]
    monkeypatch.setattr(op7, "STEP", 37)
    for a, b, c in zip(want, model.logits(texts), alone, strict=True):
        assert np.allclose(a, b) and np.allclose(a, c)


def test_without_labels(spark, docs):
    none = op7.train(docs.limit(0))
    assert {r.lang_pred for r in op7.identify(docs.limit(5), none).collect()} == {"und"}


def plain_ngrams(text):
    """Bucket of every n-gram that counts, one by one."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = []
    for w in words:
        w = f" {w} "
        for n in range(1, op7.NGRAMS + 1):
            for k in range(len(w) - n + 1):
                g = w[k : k + n]
                if " " not in g[1:-1] and not (g[0] == " " and g[-1] == " "):
                    h = 0
                    for j, c in enumerate(g):
                        h = ord(c) if j == 0 else (h * 0x9E3779B97F4A7C15 + ord(c)) % 2**64
                    out.append((h + n) * 0xD6E8FEB86659FD93 % 2**64 >> (64 - op7.BITS))
    return out


def test_against_brute_force(spark, docs, model):
    """Logits and probabilities from n-grams taken one by one, over whole texts."""
    rows = [r for r in docs.select("doc_id", "text").collect() if r.text is not None][:150]
    got = {r.doc_id: r for r in op7.identify(docs, model).collect()}
    for r in rows:
        grams = plain_ngrams(r.text)
        if not grams:
            assert got[r.doc_id].lang_pred == "und"
            continue
        z = model.bias + model.SCALE * model.weights[grams].astype(float).mean(axis=0)
        assert np.allclose(z, model.logits([r.text])[0], atol=1e-5)
        p = np.exp((z - z.max()) / model.temperature)
        p /= p.sum()
        assert abs(p.max() - got[r.doc_id].score) < 1e-6 and model.langs[int(p.argmax())] == got[r.doc_id].lang_pred


def test_document_frequencies(spark, docs):
    texts = [t for t in (r.text for r in docs.select("text").collect()[:200])] + [None, "", "12"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    total, seen = op7.document_frequencies(df, np.ones(1 << op7.BITS, bool))
    want = np.zeros(1 << op7.BITS)
    for t in texts:
        want[list(set(plain_ngrams(t or "")))] += 1
    assert total == sum(any(c.isalpha() for c in t or "") for t in texts) and (seen == want).all()


def test_sample_by_language(spark):
    assert op7.quotas({"a": 3, "b": 500, "c": 10**6}, 100) == {"a": 3, "b": 48, "c": 49}
    rows = [(k, f"the and of word{k}", "en") for k in range(3000)] + [(5000 + k, f"der und die wort{k}", "de") for k in range(3)] + [(1, "the and of word1", "en")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = op7.sample(df.withColumnRenamed("doc_id", "id"), 40)
    assert len(got) == len(set(got)) == 40 and sum(lang == "de" for _, lang in got) == 3
    model = op7.train(df, sample_rows=40)
    assert model.predict(["der und die haus"])[0] == ["de"]
