import re

import public_tokenizers
import sentencepiece
from test_decontaminate import brute as contaminated
from test_minhash import brute as near

import corpus_pipeline as pipe
from loomwright.llm import op07_language as op7

DIR = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    model = op7.train(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [r for r, s in zip(rows, model.predict([t for _, t in rows])[1]) if s >= 0.5]
    kept = {i for i, _, _, k in near(rows, 5, 80) if k}
    rows = [r for r in rows if r[0] in kept]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated(rows, items) if r[5]}
    assert bad
    rows = [r for r in rows if r[0] not in bad]
    hide = lambda t: re.sub(r'(?<=token = ")[0-9a-f]{40}|(?<=password=)[0-9a-f]{18}|AKIA[A-Z0-9]{16}', "[SECRET]", t)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: (len(ids := lib.encode(hide(t))), ids, hide(t)) for i, t in rows}
    assert {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in pipe.run(spark, DIR).collect()} == want


def test_columns_and_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "...", "en", "s", 3), (None, "the and of that with from", "en", None, 1), (4, "the and of that with from", None, "s", 2), (4, "the and of that with from", None, "s", 2), (5, "der und die das ein von", "de", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, f in pipe.STAGES[:-1]:
        new = f(spark, docs, DIR)
        assert new.columns == docs.columns and [t for _, t in new.dtypes] == [t for _, t in docs.dtypes], name
        docs = spark.createDataFrame(new.collect(), docs.schema)
    out = pipe.STAGES[-1][1](spark, docs, DIR).collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 4, 5]
    for _, f in pipe.STAGES:
        assert f(spark, docs.limit(0), DIR).count() == 0


def test_workers_keep_one_operators_caches(spark):
    """What a stage keeps in a Python worker is gone when the next one runs there."""
    import pyarrow as pa

    from loomwright.llm import op02_sentencepiece as op2
    from loomwright.llm import op03_minhash as op3
    from loomwright.llm.common import arrow_map

    docs = spark.createDataFrame([(k, f"one two three words w{k}") for k in range(40)], "doc_id long, text string").repartition(4)
    op2.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    op3.banded(docs.selectExpr("doc_id as id", "doc_id as h", "text"), 3, 85).collect()

    def held(batch):
        return pa.record_batch([pa.array([len(op2._encoders)]), pa.array([len(op3._hashes)])], names=["encoders", "hashes"])

    held.__module__ = "another"
    got = arrow_map(docs, held, "encoders long, hashes long").collect()
    assert got and all((r.encoders, r.hashes) == (0, 0) for r in got)
