"""Licence scans by a trained paragraph classifier.

Paragraphs are cut at blank lines; the lines of one belong together, however they are wrapped, and marks of comments at
their heads don't count. A paragraph of more than SPAN words is judged in spans of that many, each beginning half a span
after the one before, so that a notice within long prose is not thinned out. The classifier is a sparse multinomial
logistic regression over word 1- to 3-grams that hold a telling word: one that the licence templates use and the background
sample hardly does. It is trained here (follow-the-regularised-leader) on the templates, cut and altered by rule, against an
``unknown`` class of background paragraphs and of sentences that only speak of licences; its temperature is fitted on a
held-out part. A family is accepted if its calibrated probability is at least LEAST_SCORE, it is not ``unknown``, and a
template of that family confirms it: enough of the shorter side's word pairs are found in the other.

A span without any telling word has no features, so its class is the one of the bias alone, ``unknown`` (asserted after
training); such spans are passed over. Whole texts are read. Each (paragraph, family) is one finding, of its best score.

The background is a bounded sample: BACKGROUND_SPANS spans of the BACKGROUND_ROWS documents whose id hashes lowest, those
of least hash.

Null and empty texts have no paragraphs and no licence. Repeated rows repeat; other columns are not read; an empty table
gives an empty result, and without a background sample only the built-in unknown sentences are learnt.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map
from .licence_texts import NOTICES, OTHERS

BACKGROUND_ROWS, BACKGROUND_SPANS, LEAST_SCORE, CONFIRM = 300, 4000, 0.6, 0.5
#: Words that are judged together.
SPAN = 96
UNKNOWN = "unknown"
BITS_ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
WORD = re.compile(r"[^\W_]+")
#: A blank line, one with nothing but a comment's mark included.
BLANK = re.compile(r"\n[ \t\r\f\v]*(?:(?:#+|//+|\*+|;+|--+)[ \t\r]*)?(?=\n)")


def paragraphs(text: str) -> list[str]:
    """Parts between blank lines that hold a word."""
    return [p for p in BLANK.split(text) if WORD.search(p)]


def spans(w: list[str]) -> list[list[str]]:
    if len(w) <= SPAN:
        return [w]
    return [w[k : k + SPAN] for k in range(0, len(w) - SPAN // 2, SPAN // 2)]


def words(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def ngrams(w: list[str]) -> list[tuple[str, ...]]:
    return [tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def pairs(w: list[str]) -> set[tuple[str, ...]]:
    return set(zip(w, w[1:], strict=False)) or {tuple(w)}


class Classifier:
    def __init__(self, background: list[list[str]], templates: dict[str, list[str]] = NOTICES):
        """background: the words of spans without licences, as far as known."""
        rnd = random.Random(11)
        seen = Counter(x for p in background for x in set(p))
        most = max(1, len(background) // 100)
        known = {f: [words(t) for t in ts] for f, ts in templates.items()}
        self.telling = {x for ts in known.values() for t in ts for x in t if seen[x] <= most and not (len(x) < 3 and x not in ("cc", "sa", "nc", "by"))}
        self.classes = [UNKNOWN, *known]
        data: list[tuple[list[str], int]] = []
        others = [n.split() for n in OTHERS]

        def fill() -> list[str]:
            w = rnd.choice(background or others)
            a = rnd.randrange(max(1, len(w) - 11))
            return w[a : a + rnd.randrange(1, 25)]

        for k, ts in enumerate(known.values(), 1):
            for w in ts:
                for _ in range(24):
                    v = [x for x in w if rnd.random() > 0.06] or w
                    if len(v) > 12 and rnd.random() < 0.5:
                        a = rnd.randrange(len(v) // 4 + 1)
                        v = v[a : a + rnd.randrange(len(v) * 2 // 3, len(v) + 1)]
                    data.append(([*(fill() if rnd.random() < 0.3 else []), *v, *(fill() if rnd.random() < 0.3 else [])], k))
                data += [(w, k)] * 6
        data += [(w, 0) for w in background]
        for n in others:
            data += [(n, 0)] * 8
        single = sorted({x for ts in known.values() for t in ts for x in t})
        for _ in range(800):  # telling words in no licence's order
            data.append(([*fill(), rnd.choice(single), *fill(), rnd.choice(single)], 0))
        rnd.shuffle(data)
        held, learn = data[::5], [d for k, d in enumerate(data) if k % 5]
        self.at: dict[tuple[str, ...], int] = {}
        for w, k in learn:
            for g in self.grams(w):
                if k:
                    self.at.setdefault(g, len(self.at))
        n_c, n_f = len(self.classes), len(self.at)
        z, n = np.zeros((n_f + 1, n_c)), np.zeros((n_f + 1, n_c))

        def weights(i):
            return np.where(np.abs(z[i]) <= L1, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / BITS_ALPHA + L2))

        for _ in range(4):
            for w, y in learn:
                i = np.array([*self.ids(w), n_f])
                v = weights(i)
                s = v.sum(axis=0)
                p = np.exp(s - s.max())
                p /= p.sum()
                p[y] -= 1
                g = np.broadcast_to(p, v.shape)
                sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / BITS_ALPHA
                z[i] += g - sigma * v
                n[i] += g * g
        self.weights = weights(np.arange(n_f + 1))
        assert self.weights[-1].argmax() == 0, "a paragraph without features must be unknown"
        scored = [(self.weights[[*self.ids(w), n_f]].sum(axis=0), y) for w, y in held]
        self.temperature = min(np.geomspace(0.25, 8, 41), key=lambda t: sum(np.log(np.exp((s - s.max()) / t).sum()) - (s[y] - s.max()) / t for s, y in scored))
        self.templates = {f: [pairs(t) for t in ts] for f, ts in known.items()}

    def grams(self, w: list[str]) -> list[tuple[str, ...]]:
        return [g for g in ngrams(w) if not self.telling.isdisjoint(g)]

    def ids(self, w: list[str]) -> list[int]:
        return sorted({self.at[g] for g in self.grams(w) if g in self.at})

    def classify(self, w: list[str]) -> tuple[str, float]:
        """(family or unknown, probability) of the words of a span."""
        ids = self.ids(w)
        if not ids:
            return UNKNOWN, 1.0
        s = self.weights[[*ids, len(self.at)]].sum(axis=0) / self.temperature
        p = np.exp(s - s.max())
        p /= p.sum()
        k = int(p.argmax())
        if k == 0 or p[k] < LEAST_SCORE or not self.confirmed(w, self.classes[k]):
            return UNKNOWN, float(p[0])
        return self.classes[k], float(p[k])

    def confirmed(self, w: list[str], family: str) -> bool:
        own = pairs(w)
        return any(len(own & t) >= CONFIRM * min(len(own), len(t)) and len(own & t) >= min(2, len(t)) for t in self.templates[family])

    def scan(self, text: str) -> list[tuple[int, str, float]]:
        """(paragraph number, family, probability) of the licence paragraphs of a text."""
        low = text.lower()
        if self.telling.isdisjoint(WORD.findall(low) if not low.isascii() else low.translate(_CUT).split()):
            return []
        out = []
        for k, p in enumerate(paragraphs(text)):
            best: dict[str, float] = {}
            for w in spans(words(p)):
                if not self.telling.isdisjoint(w):
                    family, score = self.classify(w)
                    if family != UNKNOWN:
                        best[family] = max(score, best.get(family, 0.0))
            out += [(k, f, best[f]) for f in sorted(best)]
        return out


_CUT = str.maketrans({c: " " for c in map(chr, range(128)) if not c.isalnum()})


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = BACKGROUND_ROWS, most: int = BACKGROUND_SPANS) -> Classifier:
    """Fit on ``most`` spans of ``rows`` documents (a bounded sample). Spans that share most of the word pairs of a template
    are left out of the background."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    ids = [r.id for r in d.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(rows).collect()]
    # of rows that share an id, the text that is least
    texts = [r.t for r in d.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("text").alias("t")).orderBy("id").collect()] if ids else []
    templates = [pairs(words(t)) for ts in NOTICES.values() for t in ts]
    found = {tuple(w) for t in texts for p in paragraphs(t) for w in spans(words(p)) if w}
    found = [w for w in found if not any(len(own & t) >= 0.5 * len(t) for own in [pairs(list(w))] for t in templates)]
    return Classifier([list(w) for w in sorted(found, key=lambda w: (zlib.crc32(" ".join(w).encode()), w))[:most]])


def licences(docs: DataFrame, model: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_paragraphs, findings array<struct<paragraph, family, score>>."""
    item = pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("score", pa.float64())])
    fields = pa.schema([("id", pa.int64()), ("n_paragraphs", pa.int64()), ("findings", pa.list_(item))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the n-grams of the templates

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, found = [], []
        for t in batch.column(1).to_pylist():
            n.append(len(paragraphs(t)) if t else 0)
            found.append([{"paragraph": k, "family": f, "score": p} for k, f, p in shared.value.scan(t)] if t else [])
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(found, fields[2].type)], schema=fields)

    out = arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)), run, "id long, n_paragraphs long, findings array<struct<paragraph:int,family:string,score:double>>")
    return out.withColumnRenamed("id", id_col)


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = licences(docs, train(docs))
    family = F.array_sort(F.array_distinct(F.transform("findings", lambda x: x["family"])))
    top = F.coalesce(F.round(F.array_max(F.transform("findings", lambda x: x["score"])), 6), F.lit(0.0))
    return found.select("doc_id", "n_paragraphs", F.size("findings").cast("long").alias("n_licence_paragraphs"), F.array_join(family, ",").alias("families"), top.alias("top_score"))
