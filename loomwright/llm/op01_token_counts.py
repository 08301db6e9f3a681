"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. A node's failure link leads to the trie place of what is left after its
greedy longest-match pieces are taken off the front; the number of pieces so popped is kept with the link. Reading a word
character by character then gives the number of its greedy longest-match pieces in linear time, without building one.

Words are what white space separates, each with a mark in front (the word-start form of the vocabulary). A character
that no piece begins with counts as its UTF-8 bytes. The count of a text is the sum over its words; each distinct word is
read once per worker.

Null and empty texts have no words and no tokens. Repeated rows repeat; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map

CACHE_WORDS = 500_000
MARK = "▁"


class Automaton:
    """Nodes are numbers; node 0 is the root."""

    def __init__(self, vocabulary: list[str]):
        self.go: list[dict[str, int]] = [{}]
        whole = [False]
        known = {p for p in vocabulary if p}
        # every character that stands anywhere in a piece is one too, weighted by its bytes if the vocabulary lacks it
        self.weight = {c: 1 if c in known else len(c.encode("utf-8", "surrogatepass")) for c in set(chain.from_iterable(known))}
        for piece in sorted(known | set(self.weight)):
            at = 0
            for c in piece:
                if c not in self.go[at]:
                    self.go[at][c] = len(self.go)
                    self.go.append({})
                    whole.append(False)
                at = self.go[at][c]
            whole[at] = True
        n = len(self.go)
        self.link, self.popped = [0] * n, [0] * n
        queue = []
        for c, v in self.go[0].items():
            self.link[v], self.popped[v] = 0, self.weight[c]  # a single character is a piece
            queue.append(v)
        for u in queue:  # breadth first; u's own link is known
            for c, v in self.go[u].items():
                if whole[v]:
                    self.link[v], self.popped[v] = 0, 1
                else:
                    z, n_popped = self.link[u], self.popped[u]
                    while c not in self.go[z]:
                        n_popped += self.popped[z]
                        z = self.link[z]
                    self.link[v], self.popped[v] = self.go[z][c], n_popped
                queue.append(v)
        self.counts: dict[str, int] = {}

    def count(self, word: str) -> int:
        go, link, popped = self.go, self.link, self.popped
        at = total = 0
        for c in word:
            nxt = go[at].get(c)
            while nxt is None:
                if at == 0:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    nxt = 0
                    break
                total += popped[at]
                at = link[at]
                nxt = go[at].get(c)
            at = nxt
        while at:
            total += popped[at]
            at = link[at]
        return total

    def of_text(self, text: str) -> tuple[int, int]:
        """(words, tokens)"""
        words = text.split()
        get = self.counts.get
        found = list(map(get, words))
        if None in found:
            if len(self.counts) > CACHE_WORDS:
                self.counts.clear()
            for w in set(words):
                if w not in self.counts:
                    self.counts[w] = self.count(MARK + w)
            found = map(self.counts.__getitem__, words)
        return len(words), sum(found)


_automata: dict[str, Automaton] = {}


def automaton(model_path: str) -> Automaton:
    """The automaton of a SentencePiece file's ordinary pieces."""
    if model_path not in _automata:
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        _automata[model_path] = Automaton([lib.id_to_piece(i) for i in range(lib.vocab_size()) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))])
    return _automata[model_path]


def token_counts(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    fields = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a = automaton(model_path)
        found = [a.of_text(t or "") for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array([w for w, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], schema=fields)

    out = arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)), run, "id long, n_words long, n_tokens long")
    return out.withColumnRenamed("id", id_col)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
