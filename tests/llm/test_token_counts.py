import random

import public_tokenizers as P

from loomwright.llm import op01_token_counts as op1


def greedy(vocab, word):
    """Longest match from the left, building the pieces."""
    n = at = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocab:
                n, at = n + 1, end
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
    return n


def test_random_vocabularies():
    r = random.Random(2)
    for _ in range(300):
        vocab = {"".join(r.choices("abcé", k=r.randrange(1, 6))) for _ in range(r.randrange(0, 14))}
        a = op1.Automaton(sorted(vocab))
        for _ in range(20):
            w = "".join(r.choices("abcédß", k=r.randrange(0, 14)))
            assert a.count(w) == greedy(vocab, w), (vocab, w)


def test_texts(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    vocab = {lib.id_to_piece(i) for i in range(259, 32000)}
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Ünïcode 日本語 \U0001F600 x" * 3), (5, "longword" * 5000), (6, "a b"), (6, "a b"), (None, "a")]
    rows += [(100 + r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'q' as n_words")
    want = sorted(((d, len((t or "").split()), sum(greedy_fast(vocab, "▁" + w) for w in (t or "").split())) for d, t in rows), key=repr)
    assert sorted(map(tuple, op1.token_counts(df, P.path("piece_bpe_32k.model")).collect()), key=repr) == want
    assert op1.token_counts(df.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def greedy_fast(vocab, word):
    n = at = 0
    while at < len(word):
        for end in range(min(len(word), at + 20), at, -1):
            if word[at:end] in vocab:
                n, at = n + 1, end
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
    return n
