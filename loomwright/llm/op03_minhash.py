"""MinHash near-dedup with b-bit signatures.

A document's set is its distinct ``size``-word shingles (a shorter text: its whole word sequence as one). Each document
gets K minima of multiply hashes. Bands of a few minima give bucket keys; they are as wide as leaves a link at the
threshold a chance under MISS to be missed: 32 of 6 at 0.85, 38 of 5 at 0.8. Documents that share a bucket with another
get SIGNED minima, of which the low 2 bits are kept and packed, and the collision-corrected similarity of a candidate
pair is estimated by counting equal bit pairs. Pairs whose estimate is not more than SIGMAS standard deviations below the
threshold are confirmed on the full shingle sets.

Buckets are not expanded into all pairs. Documents of equal word sequences are one class. Each class is first compared
with the least id that shares a bucket with it; links found that way settle nearly all. A second round compares, in
buckets that still hold several components, each class with CENTRES others outside its component; what then remains of
pairs across components in one bucket is compared without exception, so a link between different components is never
skipped; there the full sets are compared where the bucket is, and only links that join components leave it. Components
come from the confirmed links.

Defined results: no words or null text: an empty set, linked with nothing. Repeated rows come back as often as they came;
rows that share an id are one node, whose text is the one of least hash among those with words. A null id is its own
component (null) and is kept. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CACHES, alone, arrow_map, begin, components, free_name, give_back, marked, short_batches, without, written

K, SIGNED, SIGMAS, MISS = 192, 1024, 5.0, 1e-6
#: Other centres that a class is compared with before the exhaustive step.
CENTRES = 3
#: Classes of more copies than this, and at least a HOT_CLASSES-th of all rows, find their component by a broadcast.
HOT, HOT_CLASSES = 1000, 10_000
#: Side of the blocks that a large bucket is compared in, in the exhaustive step.
BLOCK = 2000
#: Shingles of a block at most, about, and bytes that are held at once beside an unfinished group.
SHINGLES, HELD_BYTES = 1 << 20, 1 << 25
#: Pairs whose signatures are compared at once there.
PAIRS = 1 << 15
CACHE_WORDS = 200_000
_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(0, 2**32, SIGNED, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, SIGNED, dtype=np.uint32)
_MIX = _rng.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    """64-bit hashes of words; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = CACHES[__name__] = _Hashes()


def word_list(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at space and \\x09-\\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    x = np.zeros(n, np.uint64)
    for k in range(min(size, len(h))):
        x = (x ^ h[k : k + n]) * _MIX[k]
        x ^= x >> np.uint64(29)
    return np.unique(x)


def exact_set(text: str | None, size: int) -> set:
    w = word_list(text)
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return set(zip(*(w[k:] for k in range(size)), strict=False))


def minima(x: np.ndarray, n: int) -> np.ndarray:
    """The first n minima over the hashes, in blocks so that a very long text needs little memory."""
    x32 = (x >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    step = max(256, (1 << 18) // n)
    for k in range(0, len(x32), step):
        np.minimum(out, (_MULT[:n, None] * x32[None, k : k + step] + _ADD[:n, None]).min(axis=1), out=out)
    return out


def _pack(m: np.ndarray) -> np.ndarray:
    """Two low bits of the mixed minima, 32 to a long."""
    bits = (((m * np.uint32(0x9E3779B1)) >> np.uint32(15)) & np.uint32(3)).astype(np.uint64).reshape(len(m), m.shape[1] // 32, 32)
    return (bits << (np.arange(32, dtype=np.uint64) * np.uint64(2))).sum(axis=2, dtype=np.uint64).view(np.int64)


def band_rows(percent: int) -> int:
    """Minima in a band: the most with which a link at the threshold is missed by a chance under MISS."""
    s = percent / 100
    return next((r for r in range(8, 1, -1) if (1 - s**r) ** (K // r) < MISS), 1)


def _bands(m: np.ndarray, rows: int) -> np.ndarray:
    n = K // rows
    b = m[:, : n * rows].reshape(len(m), n, rows).astype(np.uint64)
    x = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64) * _MIX[8], (len(m), n)).copy()
    for k in range(rows):
        x = (x ^ b[:, :, k]) * _MIX[9 + k % 6]
        x ^= x >> np.uint64(31)
    return x.view(np.int64)


def _lists(a: np.ndarray, full: list[bool]) -> pa.Array:
    """Rows of a as lists, null where ``full`` is not."""
    off = np.concatenate(([0], np.cumsum(full))) * a.shape[1]
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.ascontiguousarray(a).reshape(-1), pa.int64()), mask=pa.array([not f for f in full], pa.bool_()))


def banded(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, h, n_shingles, print, bands) of ``docs(id, h, text)``; the last two null for empty sets."""
    fields = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("n_shingles", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64()))])
    rows = band_rows(percent)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, prints, mins = [], [], []
        for t in batch.column(2):
            w = word_list(t.as_py())
            x = shingle_hashes(w, size) if w else ()
            n.append(len(x))
            prints.append(hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None)
            if w:
                mins.append(minima(x, K))
        bands = _bands(np.stack(mins), rows) if mins else np.zeros((0, K // rows), np.int64)
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), _lists(bands, [p is not None for p in prints])], schema=fields)

    return arrow_map(docs, run, "id long, h long, n_shingles long, print binary, bands array<long>")


def signed(texts: DataFrame, size: int) -> DataFrame:
    """(id, n_shingles, bits) of ``texts(id, text)``, none of them empty."""
    fields = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("bits", pa.list_(pa.int64()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_hashes(word_list(t.as_py()), size) for t in batch.column(1)]
        bits = _pack(np.stack([minima(x, SIGNED) for x in sets]))
        return pa.record_batch([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), _lists(bits, [True] * len(sets))], schema=fields)

    return arrow_map(texts, run, "id long, n_shingles long, bits array<long>")


def estimate(a: str, b: str) -> Column:
    """Similarity from equal 2-bit pairs, corrected for the quarter that agree by chance."""
    half = 0x5555555555555555
    unequal = " + ".join(f"bit_count((({a}[{k}] ^ {b}[{k}]) | shiftrightunsigned({a}[{k}] ^ {b}[{k}], 1)) & {half}L)" for k in range(SIGNED // 32))
    return (F.lit(1.0) - F.expr(f"({unequal})") / F.lit(float(SIGNED)) - F.lit(0.25)) / F.lit(0.75)


def slack(threshold: float) -> float:
    p = threshold + (1 - threshold) / 4
    return threshold - SIGMAS * (p * (1 - p) / SIGNED) ** 0.5 / 0.75


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) of pairs whose full sets agree to ``percent``."""
    fields = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        a_ids, b_ids, a_texts, b_texts = (c.to_pylist() for c in batch.columns)
        keep, last, other = [], None, set()
        for k, (ta, tb) in enumerate(zip(a_texts, b_texts, strict=True)):
            if b_ids[k] != last:
                last, other = b_ids[k], exact_set(tb, size)
            own = exact_set(ta, size)
            both = len(own & other)
            if both and 100 * both >= percent * (len(own) + len(other) - both):
                keep.append(k)
        return pa.record_batch([pa.array([a_ids[k] for k in keep], pa.int64()), pa.array([b_ids[k] for k in keep], pa.int64())], schema=fields) if keep else None

    ta, tb = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    j = pairs.select("a", "b").join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    return arrow_map(j, run, "a long, b long")


def _exact_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of ``exact_set`` as numbers, side by side, and where each begins: equal numbers are equal shingles."""
    number: dict[bytes, int] = {}
    words = [[number.setdefault(w, len(number) + 1) for w in word_list(t)] for t in texts]
    words = [w + [0] * (size - len(w)) if w else w for w in words]  # a short text's sequence, which no full shingle equals
    n = np.array([max(0, len(w) - size + 1) for w in words], np.int64)
    row, off = np.repeat(np.arange(len(n)), n), np.concatenate(([0], np.cumsum(n)))
    flat = np.fromiter(chain.from_iterable(words), np.int64, sum(map(len, words)))
    begins = np.concatenate(([0], np.cumsum([len(w) for w in words])))[:-1]
    at = np.arange(off[-1]) + np.repeat(begins - off[:-1], n)
    x = flat[at]
    for k in range(1, size):
        x = np.unique((x << 32) | flat[at + k], return_inverse=True)[1]
    sets = np.unique((row << 32) | x)
    return sets & 0xFFFFFFFF, np.searchsorted(sets >> 32, np.arange(len(n) + 1))


def _meeting(group: np.ndarray, block: np.ndarray, sizes: np.ndarray, ids: np.ndarray, comps: np.ndarray, bits: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of rows (groups side by side) in one group and in blocks that the group compares, of different components,
    whose sizes and signatures allow a link. ``group`` is (n, 3): key and the two blocks that are compared."""
    n = len(ids)
    most = int(np.floor(SIGNED * (1 - 0.25 - 0.75 * slack(percent / 100)) + 1e-9))  # unequal bit pairs of the least estimate
    last = np.append(np.flatnonzero((group[1:] != group[:-1]).any(axis=1)), n - 1)
    after = np.repeat(last, np.diff(np.concatenate(([-1], last)))) - np.arange(n)  # rows that follow in the group
    halves = [np.ascontiguousarray(h) for h in np.split(bits, 2, axis=1)]
    within, before = group[:, 1] == group[:, 2], np.concatenate(([0], np.cumsum(after)))
    found_i, found_j = [], []
    for lo in range(0, int(before[-1]), PAIRS):
        at = np.arange(lo, min(lo + PAIRS, int(before[-1])))
        i = np.searchsorted(before, at, side="right") - 1
        j = i + 1 + at - before[i]
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        ok = (comps[i] != comps[j]) & (ids[i] != ids[j]) & (small * 100 >= large * percent) & (within[i] | (block[i] != block[j]))
        i, j = i[ok], j[ok]
        unequal = np.zeros(len(i), np.int64)
        for half in halves:  # what differs too much in one half needs no other
            x = half[i] ^ half[j]
            x = (x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)
            unequal += np.bitwise_count(x).sum(axis=1, dtype=np.int64)
            ok = unequal <= most
            i, j, unequal = i[ok], j[ok], unequal[ok]
        found_i.append(i.astype(np.int32))
        found_j.append(j.astype(np.int32))
    empty = np.zeros(0, np.int32)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


def _joining(pairs: np.ndarray, comps: np.ndarray, sets: tuple[np.ndarray, np.ndarray] | None, percent: int) -> Iterator[tuple[int, int]]:
    """Of different pairs (a << 32 | b), in order, as many links as join what the pairs' links join: fewer than there are
    components. Pairs are compared on the full sets, but for those that links found before have joined."""
    c = np.unique(comps, return_inverse=True)[1]
    flat, off = sets or (None, None)
    own = np.zeros(int(flat.max(initial=-1)) + 1, np.bool_) if sets else None
    ends = np.append(np.flatnonzero((pairs[1:] >> 32) != (pairs[:-1] >> 32)) + 1, len(pairs)).tolist()
    for lo, hi in zip([0, *ends], ends, strict=False):
        x, many = int(pairs[lo] >> 32), pairs[lo:hi] & 0xFFFFFFFF
        many = many[c[many] != c[x]]
        if not len(many):
            continue
        if sets:
            mine, n = flat[off[x] : off[x + 1]], off[many + 1] - off[many]
            begins = np.cumsum(n) - n
            own[mine] = True
            both = np.add.reduceat(own[flat[np.arange(n.sum()) + np.repeat(off[many] - begins, n)]], begins, dtype=np.int64)
            own[mine] = False
            many = many[(both > 0) & (100 * both >= percent * (len(mine) + n - both))]
        for y in many.tolist():
            if c[y] != c[x]:
                yield x, y
                c[c == c[y]] = c[x]


def _near_in_buckets(left: DataFrame, mark: DataFrame, percent: int, texts: DataFrame | None = None, size: int = 0) -> DataFrame:
    """(a, b): links between rows of ``left(key, id, c)`` that share a key and have different c, as many as join what all
    such links join, so no more than rows, however many pairs are near. Pairs that the signatures and set sizes allow are
    compared on the full sets of ``texts(id, text)``; without texts each of them counts. Buckets over BLOCK, or of more than
    SHINGLES, are cut into blocks, each two of which are compared on their own."""
    fields, whole = pa.schema([("a", pa.int64()), ("b", pa.int64())]), texts is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
            """Links in whole groups. What one group joins is joined for the next ones too."""
            t = t.combine_chunks()
            group = np.stack([t[c].to_numpy() for c in ("key", "p", "q")], axis=1)
            block, sizes, ids, comps = (t[c].to_numpy() for c in ("block", "n_shingles", "id", "c"))
            bits = t["bits"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(t.num_rows, -1)
            i, j = _meeting(group, block, sizes, ids, comps, bits, percent)
            if not len(i):
                return
            x = np.unique(np.concatenate([i, j]))
            nodes, first = np.unique(ids[x], return_index=True)
            place = np.zeros(t.num_rows, np.int64)
            place[x] = np.searchsorted(nodes, ids[x])
            pairs = np.unique((np.maximum(place[i], place[j]) << 32) | np.minimum(place[i], place[j]))
            sets = _exact_sets(t["text"].take(pa.array(x[first])).to_pylist(), size) if whole else None
            if found := list(_joining(pairs, comps[x[first]], sets, percent)):
                a, b = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], schema=fields)

        begin(__name__)
        rest, held = [], 0
        for batch in batches:
            rest.append(batch)
            held += batch.num_rows
            if held >= 2 * BLOCK or sum(b.nbytes for b in rest) >= HELD_BYTES:  # what stands before the last group, which may go on
                t = pa.Table.from_batches(rest)
                key, p, q = (t[c].to_numpy() for c in ("key", "p", "q"))
                before = np.flatnonzero((key != key[-1]) | (p != p[-1]) | (q != q[-1]))
                if len(before):
                    cut = int(before[-1]) + 1
                    yield from compared(t.slice(0, cut))
                    rest, held = t.slice(cut).to_batches(), t.num_rows - cut
        if rest:
            yield from compared(pa.Table.from_batches(rest))
        give_back()

    sizes = left.select("key", "id").join(mark.select("id", "n_shingles"), "id")
    blocks = sizes.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / SHINGLES)).cast("int").alias("blocks"))
    rows = left.select("key", "id", "c").join(mark, "id").join(blocks, "key").withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "c", "n_shingles", "bits")
    if whole:
        rows = rows.join(texts.select("id", "text"), "id").select(*rows.columns, "text")
    short_batches(rows)
    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("text"))
    return alone(docs.sparkSession, lambda: _near_duplicates(docs, size, percent)).withColumnRenamed("id", id_col)


def _near_duplicates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    sig = written(banded(docs, size, percent))
    # ids of several rows: the text of least hash that has words is theirs
    first = F.min(F.when(F.col("print").isNotNull(), F.struct("h", "print")))
    twice = written(sig.where("id is not null").groupBy("id").agg(F.count("*").alias("n"), first.alias("s")).where("n > 1").select("id", "s.h", "s.print"))
    repeats = not twice.isEmpty()
    if repeats:
        firsts = twice.select(F.col("id").alias("i"), F.col("h").alias("first_h"), F.col("print").alias("first_print"))
        rows = sig.join(firsts, F.col("id") == F.col("i"), "left")
        sig = rows.withColumn("own", F.col("i").isNull() | (F.col("h") == F.col("first_h"))).withColumn("print", F.when(F.col("i").isNull(), F.col("print")).otherwise(F.col("first_print"))).drop("i", "first_h", "first_print")
        docs = docs.join(firsts.drop("first_print"), F.col("id") == F.col("i"), "left").where("i is null or h = first_h").drop("i", "first_h")
    else:
        sig = sig.withColumn("own", F.lit(True))
    sets = sig.where("own and print is not null and id is not null and bands is not null")
    classes = written(sets.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    one = sets.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    one = one.dropDuplicates(["id"]) if repeats else one
    cells = one.select("id", F.explode("bands").alias("key"))
    shared = cells.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    # buckets with several classes only: a small part of all
    cells = written(cells.join(shared.select("key", "first"), "key"))
    some = cells.select("id").distinct()
    texts = marked(docs.select("id", "text"), F.col("id"), some, "maybe").where("maybe").select("id", "text").join(some, "id", "left_semi")
    texts = written(texts.dropDuplicates(["id"]) if repeats else texts)
    mark = written(signed(texts, size))
    low = slack(percent / 100)

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs that the signatures and set sizes leave."""
        a = mark.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("sa"))
        b = mark.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("sb"))
        ok = (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent) & (estimate("sa", "sb") >= low)
        return pairs.join(a, "a").join(b, "b").where(ok).select("a", "b")

    tried = written(likely(cells.groupBy("id").agg(F.min("first").alias("b")).where("id <> b").select(F.col("id").alias("a"), "b")))
    comp = components(_confirm(tried, texts, size, percent))
    for last in (False, True):
        at = cells.join(comp, cells["id"] == comp["node"], "left").select("key", "id", F.coalesce("component", "id").alias("c"))
        centre = lambda k: F.min_by(F.struct("id", "c"), F.xxhash64("id", F.lit(k)))
        spread = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.array(*[centre(k) for k in range(CENTRES)]).alias("mids")).where("lo < hi")
        left = written(at.join(spread.select("key", "mids"), "key"))
        if left.isEmpty():
            break
        if not last:  # each document with up to CENTRES centres outside its component
            some = left.select("id", "c", F.posexplode("mids").alias("k", "mid")).where("c <> mid.c")
            some = some.groupBy("id", "k").agg(F.min_by("mid.id", F.xxhash64("mid.id", "k")).alias("m"))
            pairs = some.select(F.greatest("id", "m").alias("a"), F.least("id", "m").alias("b")).distinct()
            pairs = likely(pairs.join(tried, ["a", "b"], "left_anti"))
            more = _confirm(written(pairs), texts, size, percent)
        else:  # whatever is left across components, without exception
            more = _near_in_buckets(left, mark, percent, texts, size)
        comp = components(more.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    by_class = classes.join(comp, classes["rep"] == comp["node"], "left").select(F.col("print").alias("p"), "n", F.coalesce("component", "rep").alias("c"))
    # copies of a class meet by its print, but the rows of a large class, one task's otherwise, by a broadcast
    total = classes.agg(F.sum("n")).first()[0] or 0
    large = F.broadcast(by_class.where(F.col("n") > max(HOT, total // HOT_CLASSES)).select(F.col("p").alias("large_p"), F.col("c").alias("large_c")))
    rows = sig.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("print")).alias("print")).join(large, F.col("print") == F.col("large_p"), "left")
    known = rows.where("print is null or large_p is not null").withColumn("c", F.col("large_c"))
    others = rows.where("print is not null and large_p is null").join(by_class.drop("n"), F.col("print") == F.col("p"), "left").drop("p")
    cid = F.coalesce("c", "id")
    return known.unionByName(others).select("id", "n_shingles", cid.alias("component_id"), F.coalesce(F.col("id") == cid, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each component: the one of the smallest id. Of rows that repeat
    an id the one whose text is the document's stays (ties: the least as JSON); rows without an id stay."""
    found = near_duplicates(docs, size=size, percent=percent, id_col=id_col, text_col=text_col)
    stay = without(docs, id_col, found.where(~F.col("kept")).select(id_col))
    twice = found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col)
    if twice.isEmpty():
        return stay
    row, at = free_name(docs, "row"), free_name(docs, "same")
    t = twice.toDF(at)
    again = stay.join(t, F.col(id_col) == F.col(at), "left_semi")
    wordless = ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    best = again.groupBy(F.col(id_col).alias(at)).agg(F.min_by(F.struct(*docs.columns), F.struct(wordless, F.xxhash64(F.col(text_col)), F.to_json(F.struct(*docs.columns)))).alias(row))
    return without(stay, id_col, twice).unionByName(best.select(f"{row}.*"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=85)
