"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding is our own: a score-ordered agenda of adjacent symbol pairs, merged best score first, leftmost on ties; short
words go through it in lockstep as arrays, long ones one by one through a heap.
No piece of the vocabulary spans a word boundary or a line feed (checked when the model is loaded; other vocabularies
are encoded text by text), so a text is encoded word by word and each distinct word once per worker. Every word that
enters the word cache is checked against the sentencepiece library, in the same Arrow batch; where they differ, the library's ids
are taken and the word is counted.
Not checked are words with a last ``.`` or ``,`` that no piece joins to the letter before it: only the word without the mark
is checked, and the mark's id is appended.
Decoding is the library's ``decode(ids)``.

Null texts count as empty; an empty text has no ids and decodes to the empty string. Other columns are ignored, repeated
rows come back as often as they came, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CACHES, arrow_map

#: Distinct words kept by a worker; the cache starts anew when it is full.
CACHE_WORDS = 300_000
#: Words that are learnt at once, about.
STEP_WORDS = 200_000
#: Longer words go to the heap one by one.
LONG = 48
MARK, TAILS, NONE = "▁", (".", ","), np.iinfo(np.int64).max


class Agenda:
    """Score-ordered agenda of adjacent symbol pairs for many short words at once.

    All words stand in one array of symbols. Each step takes, in every word, the pair of best score (leftmost on ties),
    merges it, and scores only the two pairs beside it anew. Pairs are looked up in an open-addressing hash table.
    """

    def __init__(self, pairs: list[tuple[int, int, int, int]]):
        """pairs: left, right, rank (best first), made."""
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank, self.made = np.full(1 << self.bits, NONE, np.int64), np.zeros(1 << self.bits, np.int64)
        keys = np.array([left << 32 | right for left, right, _, _ in pairs], np.int64)
        for key, at, (_, _, rank, made) in zip(keys.tolist(), self._slot(keys).tolist(), pairs, strict=True):
            while self.keys[at] != -1:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.rank[at], self.made[at] = key, rank, made

    @classmethod
    def of_pieces(cls, ids: dict[str, int], scores: dict[str, float]) -> "Agenda":
        """Every way to make a piece of two symbols; ``of_char`` gives a character's symbol: a piece, or base + its code
        point."""
        base, symbols = max(ids.values()) + 1 if ids else 0, dict(ids)
        for piece in ids:
            for c in piece:
                symbols.setdefault(c, base + ord(c))
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        out = cls([(symbols[p[:k]], symbols[p[k:]], order[scores[p]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols])
        out.base, out.of_char = base, np.arange(base, base + 0x110000, dtype=np.int64)
        for c, k in symbols.items():
            if len(c) == 1:
                out.of_char[ord(c)] = k
        return out

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table places of pairs; an empty place (of rank NONE) where there is none."""
        keys = left << 32 | right
        at = self._slot(keys)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            now = self.keys[at[open_]]
            open_ = open_[(now != keys[open_]) & (now != -1)]
        return at

    def encode(self, words: list[str]) -> list[list[int]]:
        """Symbol ids of words; a character without a piece is base + its code point."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat, ends = self.run(self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)], size)
        flat, out, a = flat.tolist(), [], 0
        for b in ends.tolist():
            out.append(flat[a:b])
            a = b
        return out

    def run(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the symbols of words of these sizes: all symbols that are left, and where each word's end."""
        word = np.repeat(np.arange(len(size)), size)
        done_s, done_w = [], []
        last = np.ones(len(sym), bool)
        last[:-1] = word[1:] != word[:-1]
        at = np.zeros(len(sym), np.int64)
        rank = np.full(len(sym), NONE, np.int64)
        pair = np.flatnonzero(~last)
        at[pair] = self._find(sym[pair], sym[pair + 1])
        rank[pair] = self.rank[at[pair]]
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(sym)))
            over = np.repeat(best == NONE, count)
            if over.any():
                done_s.append(sym[over])
                done_w.append(word[over])
                live = ~over
                sym, word, at, rank = sym[live], word[live], at[live], rank[live]
                if not len(sym):
                    break
                best, count = best[best != NONE], count[best != NONE]
            hit = np.flatnonzero(rank == np.repeat(best, count))
            hit = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))]
            sym[hit] = self.made[at[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            hit = hit - np.arange(len(hit))  # places after the merged neighbours are gone
            sym, word, at, rank = sym[stay], word[stay], at[stay], rank[stay]
            same = np.ones(len(sym), bool)
            same[:-1] = word[1:] == word[:-1]
            same[-1] = False
            left = hit[(hit > 0)] - 1
            left = left[same[left]]
            rank[hit] = NONE
            redo = np.concatenate([left, hit[same[hit]]])
            at[redo] = self._find(sym[redo], sym[redo + 1])
            rank[redo] = self.rank[at[redo]]
        if done_s:
            sym, word = np.concatenate(done_s), np.concatenate(done_w)
            order = np.argsort(word, kind="stable")
            sym, word = sym[order], word[order]
        return sym, np.cumsum(np.bincount(word, minlength=len(size)))


class AgendaEncoder:
    """Encoder for BPE models with the identity normaliser and a dummy prefix."""

    def __init__(self, model_path: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=model_path)
        lib, n = self.lib, self.lib.vocab_size()
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.scores = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.bytes = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.unk = lib.unk_id()
        self.by_word = not any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids)
        #: Adjacent characters of pieces: no merge joins any others.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.agenda = Agenda.of_pieces(self.ids, self.scores)
        self.cache: dict[str, tuple[list[int], str]] = {}
        self.opening = lib.encode("\n")
        #: Words for which the library's ids, not the agenda's, were taken.
        self.differences = 0

    def merge(self, text: str) -> list[int]:
        """Symbol ids of one long normalised text (spaces as marks), by a heap."""
        sym, scores = list(text), self.scores
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            s = scores.get(sym[i] + sym[i + 1])
            if s is not None:
                agenda.append((-s, i, i + 1, len(sym[i]) + len(sym[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if not sym[i] or not sym[j] or len(sym[i]) + len(sym[j]) != size:
                continue  # one side has been merged meanwhile
            sym[i] += sym[j]
            sym[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = scores.get(sym[i] + sym[k])
                if s is not None:
                    heapq.heappush(agenda, (-s, i, k, len(sym[i]) + len(sym[k])))
            h = before[i]
            if h >= 0:
                s = scores.get(sym[h] + sym[i])
                if s is not None:
                    heapq.heappush(agenda, (-s, h, i, len(sym[h]) + len(sym[i])))
        return [self.ids[p] if p in self.ids else self.agenda.base + ord(p) for p in sym if p]

    def spelled(self, symbols: list[int]) -> list[int]:
        """Characters without a piece as their bytes, or as unknown."""
        base = self.agenda.base
        if not symbols or max(symbols) < base:
            return symbols
        out: list[int] = []
        for s in symbols:
            if s < base:
                out.append(s)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(s - base).encode()]
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
        return out

    def words(self, text: str) -> list[str]:
        """Cut a text into parts that are encoded on their own; a part after a line feed begins with it, others stand
        for a mark and the part."""
        if not text:
            return []
        if not self.by_word:
            return [text]
        parts = text.replace("\n", " \n")
        if "  " in parts or parts[0] == " " or MARK in parts:
            marked = (MARK + text).replace(" ", MARK)
            return [w[1:] if w[0] == MARK else w for w in re.findall(rf"\n[^{MARK}\n]*|{MARK}+[^{MARK}\n]*", marked)]
        return parts.split(" ")

    def learn(self, words: set[str]) -> None:
        """Encode new words by the agenda and check them against the library; where they differ, the library's ids hold."""
        todo = words.difference(self.cache)
        if len(self.cache) + len(todo) > CACHE_WORDS:
            self.cache.clear()
            todo = words
        # a full stop or comma that no piece joins to the letter before it is encoded apart
        tails = {w for w in todo if w[-1:] in TAILS and w[-2:-1].isalpha() and w[-2:] not in self.joined} if self.by_word else set()
        base = sorted((todo - tails) | {w[:-1] for w in tails}.difference(self.cache))
        plain = [self._marked(w) for w in base]
        short = [k for k, w in enumerate(plain) if len(w) <= LONG]
        found = dict(zip(short, self.agenda.encode([plain[k] for k in short]), strict=True)) if short else {}
        ours = [self.spelled(found[k] if k in found else self.merge(w)) for k, w in enumerate(plain)]
        # a word of marks alone would run into the next one, so it is checked on its own
        lone = [k for k, w in enumerate(plain) if not self.by_word or not w.strip(MARK)]
        joined = [k for k, w in enumerate(plain) if self.by_word and w.strip(MARK)]
        if joined and list(chain.from_iterable([ours[k] for k in joined])) != self._library("".join([plain[k] for k in joined])):
            lone += joined
        for k in lone:
            theirs = self._library(plain[k]) if self.by_word else self.lib.encode(base[k])
            if ours[k] != theirs:
                ours[k] = theirs
                self.differences += 1
        for w, o in zip(base, ours, strict=True):
            self.cache[w] = o, ",".join(map(str, o))
        for w in tails:
            a, s = self.cache[w[:-1]]
            t = self.ids[w[-1]] if w[-1] in self.ids else self.bytes[ord(w[-1])]
            self.cache[w] = [*a, t], f"{s},{t}"

    def _marked(self, word: str) -> str:
        return word if word[:1] == "\n" and self.by_word else (MARK + word).replace(" ", MARK)

    def _library(self, marked: str) -> list[int]:
        """The library's ids of parts that stand for themselves. It puts a mark before a text, so a line feed, which no
        piece holds, goes first: its two ids are cut off."""
        return self.lib.encode("\n" + marked)[len(self.opening) :]

    def parts(self, texts: list[str]) -> list[list[tuple[list[int], str]]]:
        """For each text its words' (ids, decimal ids)."""
        cut = [self.words(t) for t in texts]
        out, size = [], 0
        for k in range(len(cut)):
            size += len(cut[k])
            if size > STEP_WORDS or k == len(cut) - 1:
                now = cut[len(out) : k + 1]
                self.learn(set(chain.from_iterable(now)))
                get = self.cache.__getitem__
                out += [list(map(get, p)) for p in now]
                size = 0
        return out

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [list(chain.from_iterable(x for x, _ in p)) for p in self.parts(texts)]


_encoders: dict[str, AgendaEncoder] = {}
CACHES[__name__] = _encoders


def encoder(model_path: str) -> AgendaEncoder:
    if model_path not in _encoders:
        _encoders[model_path] = AgendaEncoder(model_path)
    return _encoders[model_path]


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded string) of every row."""
    fields = pa.schema([(id_col, pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model_path)
        ids = enc.encode_batch([t or "" for t in batch.column(1).to_pylist()])
        return pa.record_batch([batch.column(0), pa.array(ids, fields[1].type), pa.array([enc.lib.decode(x) for x in ids], pa.string())], schema=fields)

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, f"{id_col} long, ids array<int>, decoded string")


def digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same encoding and decoding, but only the number of ids and the SHA-256 of ids and decoded text leave Python."""
    fields = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model_path)
        n, a, b = [], [], []
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for words in enc.parts(texts):
            ids = list(chain.from_iterable([x for x, _ in words]))
            n.append(len(ids))
            a.append(hashlib.sha256(",".join([x for _, x in words]).encode()).hexdigest())
            b.append(hashlib.sha256(enc.lib.decode(ids).encode()).hexdigest())
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], schema=fields)

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col)), run, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
