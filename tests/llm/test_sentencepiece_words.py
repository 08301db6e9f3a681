"""Words, marks and tails of the SentencePiece encoder against the library, one text a batch and with a warm cache."""
import os
import random
import subprocess
import sys

import public_tokenizers as P
import pytest

from loomwright.llm import op02_sentencepiece as op2

PATH = P.path("piece_bpe_32k.model")
PARTS = ["the", "cat", "dog,", "end.", "▁", "\t", "  ", "   ", "\n", "\n\n", "é", "漢字", "🙂", "́", "a" * 60, "foo_bar", "x=1", "\r\n", ".", ",", "..", "ß", "\x00", "​", "\xa0", "½", "�", "<s>", "</s>", "<unk>", "<0x0A>"]


def made(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    out = []
    for _ in range(n):
        if r.random() < 0.3:
            out.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(32, 0x500), r.randrange(0x3000, 0xD7FF), r.randrange(0x10000, 0x1FFFF)])) for _ in range(r.randrange(20))))
        else:
            out.append("".join(r.choice(PARTS) + r.choice(["", " ", " ", "  "]) for _ in range(r.randrange(12))))
    return out


@pytest.mark.parametrize("texts", [["the cat", "the cat, the."], ["a   b   c d e  "], [" ", "  ", "   x", "x   "], ["▁", "▁▁ ▁", "a ▁ b"], ["cat.", "cat", "cat,"], [""], ["\n", "\n ", " \n"]])
def test_one_text_a_batch(texts):
    e = op2.AgendaEncoder(PATH)
    for t in texts * 2:
        assert e.encode_batch([t]) == [e.lib.encode(t)]
    assert e.differences == 0


def test_made_texts():
    e = op2.AgendaEncoder(PATH)
    texts = made(1, 5000)
    for t in texts:
        assert e.encode_batch([t]) == [e.lib.encode(t)], t
    assert e.encode_batch(texts) == e.lib.encode(texts)
    assert e.differences == 0


@pytest.mark.parametrize("seed", ["0", "1", "2"])
def test_hash_seeds(seed):
    code = f"import sys; sys.path[:0] = {[(here := os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.dirname(here))]!r}\nimport test_sentencepiece_words as t, loomwright.llm.op02_sentencepiece as o\ne = o.AgendaEncoder(t.PATH); x = t.made(2, 600)\nassert [e.encode_batch([v])[0] for v in x] == e.lib.encode(x) and not e.differences"
    subprocess.run([sys.executable, "-c", code], check=True, env={**os.environ, "PYTHONHASHSEED": seed})


def test_library_holds_where_they_differ():
    """An encoder with a wrong agenda still gives the library's ids, and counts the words."""
    e = op2.AgendaEncoder(PATH)
    e.agenda.rank[:] = op2.NONE
    assert e.encode_batch(["the cat sat"]) == [e.lib.encode("the cat sat")]
    assert e.differences


def test_jobs_that_reuse_a_worker(spark):
    for rows in ([(1, "the cat")], [(1, "the cat, the.")], [(1, "a   b   c d e  ")]):
        got = op2.encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()
        assert [r.ids for r in got] == [op2.encoder(PATH).lib.encode(t) for _, t in rows]
