"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of lower-cased words with a space at either end (hashed buckets), weighted by relative
frequency in the text times inverse document frequency. Weights are learnt one document at a time by follow-the-regularised-leader with
elastic-net penalties (per-coordinate steps; small sums give exact zeros), then the temperature of the softmax is fitted
on a part of the sample that was not learnt from.

The sample that weights are learnt from is bounded: SAMPLE_ROWS of the rows with a language that ``train`` lets in, whole
texts, shared out evenly among the languages (of a language with fewer, all), those whose id and text hash lowest. With
more than SAMPLE_ROWS languages, that many of the commonest are learnt. Document frequencies are counted over all rows that
``train`` lets in. A text's logits are means over all its n-grams, taken with array operations over many texts at once.

Texts that are null or have no letter get ``und`` with score 0. Without any labelled row all texts are ``und``. Repeated
rows are judged alike; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, begin, give_back, short_batches

SAMPLE_ROWS = 1000
#: N-grams of 1 to so many characters, hashed into 2 ** BITS buckets.
NGRAMS, BITS = 3, 18
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.0005, 0.0005
#: Characters that are scored at once.
STEP = 1 << 19


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000))
    return _letters[0]


def characters(text: str) -> np.ndarray:
    """Code points of the lower-cased text; each run of other characters than letters is one space, as are both ends.
    Empty without letters."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    m = letters()[c]
    if not m.any():
        return c[:0]
    keep = m.copy()
    keep[1:] |= m[:-1]
    keep[0] = m[1]
    out = np.where(m, c, 32)[keep]
    return out if out[0] == 32 else np.concatenate((np.array([32], np.uint32), out))


def buckets(c: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size: the hashed bucket at each place, and whether the n-gram counts. One with a space inside, or
    of spaces alone, doesn't; so texts can stand side by side."""
    h = c.astype(np.uint64)
    space, out = c == 32, []
    for n in range(1, NGRAMS + 1):
        if n > 1:
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1 :]
        ok = ~(space[: len(h)] & space[n - 1 :])
        for k in range(1, n - 1):
            ok &= ~space[k : k + len(h)]
        out.append((((h + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int64), ok))
    return out


class Model:
    """logits(text) = bias + SCALE * mean over its n-grams of idf * weight, over the temperature."""

    SCALE = 20.0

    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float = 1.0):
        #: A last row of zeros stands for n-grams that don't count.
        self.langs, self.bias, self.temperature = langs, bias, temperature
        self.weights = np.concatenate([weights, np.zeros((1, len(langs)))]).astype(np.float32)

    def _sums(self, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        total = np.zeros((len(starts), len(self.langs) + 1))
        for at, ok in buckets(c):
            if len(at) < len(c):  # the last places of the last text
                at, ok = np.append(at, [0] * (len(c) - len(at))), np.append(ok, [False] * (len(c) - len(ok)))
            total[:, :-1] += np.add.reduceat(self.weights[np.where(ok, at, len(self.weights) - 1)], starts, axis=0, dtype=np.float64)
            total[:, -1] += np.add.reduceat(ok, starts, dtype=np.int64)
        return total

    def logits(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """None for texts without letters."""
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if group:
                starts = np.cumsum([0, *(len(c) for _, c in group)])[:-1]
                sums = self._sums(np.concatenate([c for _, c in group]), starts)
                for (k, _), s in zip(group, sums, strict=True):
                    out[k] = self.bias + self.SCALE * s[:-1] / s[-1]
                group.clear()

        size = 0
        for k, t in enumerate(texts):
            c = characters(t or "")
            if len(c) > STEP:  # piece by piece, each overlapping the next by what n-grams reach over
                s = sum(self._piece(c[a : a + STEP + NGRAMS - 1], STEP) for a in range(0, len(c), STEP))
                out[k] = self.bias + self.SCALE * s[:-1] / s[-1]
            elif len(c):
                if size + len(c) > STEP:
                    flush()
                    size = 0
                group.append((k, c))
                size += len(c)
        flush()
        return out

    def _piece(self, c: np.ndarray, own: int) -> np.ndarray:
        total = np.zeros(len(self.langs) + 1)
        for at, ok in buckets(c):
            at, ok = at[:own], ok[:own]
            total[:-1] += self.weights[at[ok]].sum(axis=0, dtype=np.float64)
            total[-1] += ok.sum()
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for z in self.logits(texts) if self.langs else [None] * len(texts):
            if z is None:
                langs.append("und")
                scores.append(0.0)
                continue
            p = softmax(z / self.temperature)
            langs.append(self.langs[int(p.argmax())])
            scores.append(float(p.max()))
        return langs, scores


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def _bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams and how often each is met."""
    c, n = characters(text), np.zeros(1 << BITS, np.int32)
    for a in range(0, len(c), STEP):
        for at, ok in buckets(c[a : a + STEP + NGRAMS - 1]):
            n += np.bincount(at[:STEP][ok[:STEP]], minlength=1 << BITS).astype(np.int32)
    k = np.flatnonzero(n).astype(np.int32)
    return k, n[k]


def document_frequencies(texts: DataFrame, wanted: np.ndarray) -> tuple[int, np.ndarray]:
    """How many texts of the only column have letters, and in how many each bucket is met, for the wanted buckets. Each
    task sums over its texts before anything is shuffled; no more than a row per wanted bucket reaches the driver."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)  # 2 ** BITS flags

    def run(batches):
        begin(__name__)
        n, mark, total = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.bool_), 0
        for batch in batches:
            for t in batch.column(0):
                c = characters(t.as_py() or "")
                total += len(c) > 0
                for a in range(0, len(c), STEP):
                    for at, ok in buckets(c[a : a + STEP + NGRAMS - 1]):
                        mark[at[ok]] = True
                if len(c):
                    k = np.flatnonzero(mark)
                    n[k] += 1
                    mark[k] = False
        k = np.flatnonzero((n > 0) & shared.value)
        yield pa.record_batch([pa.array([-1, *k.tolist()], pa.int32()), pa.array([total, *n[k].tolist()], pa.int64())], names=["bucket", "n"])
        give_back()

    short_batches(texts)
    found = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n, seen = found.column(0).to_numpy(), found.column(1).to_numpy(), np.zeros(1 << BITS)
    seen[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), seen


def fit(rows: list[tuple[str, str]], frequencies: Callable[[np.ndarray], tuple[int, np.ndarray]] | None = None) -> Model:
    """Learn from (text, language) pairs. ``frequencies`` gives document frequencies; without it they are the pairs' own."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return Model([], np.zeros((0, 0)), np.zeros(0))
    docs, size = [], 1 << BITS
    own = np.zeros(size)
    for text, lang in rows:
        k, n = _bucket_counts(text)
        if len(k):
            docs.append((k, n, langs.index(lang)))
            own[k] += 1
    total, seen = frequencies(own > 0) if frequencies else (len(docs), own)
    idf = np.log((1 + total) / (1 + seen)) + 1.0
    data = [(k, (Model.SCALE * n / n.sum() * idf[k]).astype(np.float32), y) for k, n, y in docs]
    docs.clear()
    held = [d for k, d in enumerate(data) if k % 5 == 0]
    learn = [d for k, d in enumerate(data) if k % 5] or data
    n_lang = len(langs)
    z, n = np.zeros((size + 1, n_lang)), np.zeros((size + 1, n_lang))

    def weights(k):
        zk, nk = z[k], n[k]
        return np.where(np.abs(zk) <= L1, 0.0, -(zk - np.sign(zk) * L1) / ((BETA + np.sqrt(nk)) / ALPHA + L2))

    for _ in range(2):
        for k, x, y in learn:
            k1, x1 = np.append(k, size), np.append(x, 1.0)
            w = weights(k1)
            p = softmax(x1 @ w)
            p[y] -= 1.0
            g = x1[:, None] * p[None, :]
            sigma = (np.sqrt(n[k1] + g * g) - np.sqrt(n[k1])) / ALPHA
            z[k1] += g - sigma * w
            n[k1] += g * g
    w = weights(np.arange(size + 1))
    model = Model(langs, w[:-1] * idf[:, None], w[-1])
    model.temperature = temperature([(x @ w[k] + w[-1], y) for k, x, y in held])
    return model


def temperature(scored: list[tuple[np.ndarray, int]]) -> float:
    """The temperature of least log loss on held-out logits, by golden section over its logarithm. Targets are smoothed by
    one case in the held-out number and two, so that a sample without any error doesn't make the model certain."""
    if not scored:
        return 1.0
    z, y = np.stack([a for a, _ in scored]), np.array([b for _, b in scored])
    off = 1 / (len(y) + 2) if z.shape[1] > 1 else 0.0
    target = np.full(z.shape, off / max(1, z.shape[1] - 1))
    target[np.arange(len(y)), y] = 1 - off

    def loss(t: float) -> float:
        s = z / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - (s * target).sum(axis=1)).mean())

    a, b, r = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def quotas(counts: dict[str, int], rows: int) -> dict[str, int]:
    """Rows to take of each language: even shares, what a small language leaves over going to the others."""
    out, left = {}, rows
    for k, lang in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        out[lang] = min(counts[lang], left // (len(counts) - k))
        left -= out[lang]
    return out


def sample(d: DataFrame, rows: int) -> list[tuple[str, str]]:
    """(text, language) of at most ``rows`` rows of ``d(id, text, lang)``, by language, in an order of their hashes."""
    keys = d.select("lang", "id", F.xxhash64("text").alias("t")).distinct()
    counts = {r.lang: r["count"] for r in keys.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    take = quotas(counts, rows)
    if not take:
        return []
    # by hash, a little more than the quota of each language, so that no language is ranked as a whole
    share = {lang: min(1.0, (n + 6 * n**0.5 + 20) / counts[lang]) for lang, n in take.items()}
    lit_map = lambda m: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col("lang"))
    keys = keys.withColumn("h", F.xxhash64("id", "t")).where((F.pmod("h", F.lit(1 << 40)) / float(1 << 40)) < lit_map(share))
    keys = keys.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "id", "t")))
    chosen = {tuple(r) for r in keys.where(F.col("rank") <= lit_map(take)).select("id", "t", "lang").collect()}
    if not chosen:
        return []
    found = d.where(F.col("id").isin(sorted({c[0] for c in chosen}))).select("id", F.xxhash64("text").alias("t"), "lang", "text")
    found = found.where(F.col("t").isin(sorted({c[1] for c in chosen}))).dropDuplicates(["id", "t", "lang"]).collect()
    found = [r for r in found if (r.id, r.t, r.lang) in chosen]
    return [(r.text, r.lang) for r in sorted(found, key=lambda r: (zlib.crc32(f"{r.id} {r.t}".encode()), r.id, r.t, r.lang))]


def train(docs: DataFrame, allowed: Column | None = None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    d = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    d = d.where(allowed) if allowed is not None else d
    d = d.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return fit(sample(d, sample_rows), lambda wanted: document_frequencies(d.select("text"), wanted))


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, lang_pred and score of every row."""
    fields = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS rows

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = shared.value.predict(batch.column(1).to_pylist())
        return pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema=fields)

    out = arrow_map(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)), run, "id long, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.col(id_col).cast("string"), "utf-8")) % 4 == 2


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, ~held_out())
    return identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, *, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text has letters and a language of at least this score."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, scores = shared.value.predict(batch.column(at).to_pylist())
        return batch.filter(pa.array([s >= least for s in scores], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
