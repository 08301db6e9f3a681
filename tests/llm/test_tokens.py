"""Exactness against the libraries, on the driver's texts and on awkward ones."""
import hashlib
import zlib

import public_tokenizers as P
import pytest

from loomwright.llm import op02_sentencepiece as op2
from loomwright.llm import op04_token_ids as op4

ODD = ["", None, " ", "  a  b ", "\n", "a\nb\tc", "\n\n x", " \n", "a \n b\n", "▁x ▁▁ y", "é́ \U0001F600 日本語", "a\x00b", "<s>a</s><|endoftext|> <|startoftext|>x", "don't we'll 12345 ...!? a.b,c", "x" * 5000, "İstanbul ΣΑΣ ς ﬁ \xa0　\x85\x1c|", "\r\n a\r\nb"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()] + ODD + ODD[:6]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_encoding_equals_library(spark, docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = {}
    for d, t in docs.collect():
        ids = lib.encode(t or "")
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in op2.digests(docs, P.path("piece_bpe_32k.model")).collect()}
    assert got == want
    full = op2.encode(docs, P.path("piece_bpe_32k.model")).collect()
    assert all(len(r.ids) == want[r.doc_id][0] for r in full)


def test_cache_restart(monkeypatch, docs):
    monkeypatch.setattr(op2, "CACHE_WORDS", 5)
    e = op2.AgendaEncoder(P.path("piece_bpe_32k.model"))
    assert e.encode_batch(["a b c d e f g", "h a b i"]) == e.lib.encode(["a b c d e f g", "h a b i"])


def test_orc_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = str(tmp_path / "ids")
    op4.write_ids(docs, P.path("word_bpe_49k.json"), out, partitions=5)
    start, want = 0, []
    for d, t in sorted(docs.collect()):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(map(tuple, op4.positions(op4.read_ids(spark, out)).collect())) == want
    assert [r.doc_id for r in op4.read_ids(spark, out, [3]).collect()] == [3]
    assert "PushedFilters: [In(doc_id" in op4.read_ids(spark, out, [3, 7])._jdf.queryExecution().toString()


@pytest.mark.parametrize("fn", [lambda s, d, p: op2.digests(d, P.path("piece_bpe_32k.model")), lambda s, d, p: (op4.write_ids(d, P.path("word_bpe_49k.json"), p), op4.positions(op4.read_ids(s, p)))[1]])
def test_empty_repeated_and_extra(spark, tmp_path, fn):
    empty = spark.createDataFrame([], "doc_id long, text string, ids string, start int")
    assert fn(spark, empty, str(tmp_path / "a")).count() == 0
    twice = spark.createDataFrame([(1, "x y", "q", 1), (1, "x y", "q", 1), (None, None, None, None)], "doc_id long, text string, ids string, start int")
    assert fn(spark, twice, str(tmp_path / "b")).count() == 3


def test_small_and_cut_words_equal_library():
    """Any mixture of letters, marks, digits, added tokens and blanks has the library's ids, and words that differ only in
    capitals and marks are encoded once."""
    import random

    r = random.Random(4)
    parts = list("aZéÉßÿ÷×µªœŒİıǰȺΣς'’…_-.,*<|>0½ \n\t\xa0\x85\u0301ﬁ中") + ["'s", "'RE", "'ll ", "don't", "x'", ". ", "***", "<|startoftext|>", "<|STARTOFTEXT|>", "<|endoftext|>", "|>", "Word"]
    texts = ["".join(r.choices(parts if k % 2 else parts[:7] + parts[-14:], k=r.randrange(12))) for k in range(6000)]
    tok = op4.WordTokenizer(P.path("word_bpe_49k.json"))
    assert tok.by_word and tok.together
    for t, got in zip(texts, tok.packed(texts), strict=True):
        assert got == b"".join(i.to_bytes(4, "little") for i in tok.lib.encode(t, add_special_tokens=False).ids), t
    tok.cache.clear()
    tok.packed(["Abc abc aBC, ABC, abc. Abc. abc*** ABC***"])
    assert sorted(tok.cache) == ["***", ",", ".", "abc"]


def test_cache_of_words_restart(monkeypatch):
    monkeypatch.setattr(op4, "CACHE_WORDS", 5)
    monkeypatch.setattr(op4, "STEP_WORDS", 3)
    tok = op4.WordTokenizer(P.path("word_bpe_49k.json"))
    texts = ["a b c d", "a e f", "g a b", "h i, j. K", "a b"]
    assert tok.packed(texts) == [b"".join(i.to_bytes(4, "little") for i in e.ids) for e in tok.lib.encode_batch(texts, add_special_tokens=False)]
