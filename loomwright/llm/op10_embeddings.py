"""Embedding near-dedup with a forest of random-projection trees.

Vectors are compared only within one label. Every tree splits recursively by random directions (one per level of a tree)
at thresholds of its own per node; vectors close to a threshold go to both sides (spill), so a linked pair is parted
seldom in one tree and practically never in all. Vectors that share a leaf are compared by cosine in double precision,
pairs at or above the threshold are links, and links are united to components.

Thresholds are fitted on the SAMPLE vectors whose id hashes lowest (below what they reach, one for each level of a tree);
every vector is indexed. A node that could only be
split through the middle of a dense crowd is not split: such a leaf is compared in blocks, each pair of blocks a task of
its own, so it is whole however large. Equal vectors are one class with a count first. A pair that meets in several
leaves is counted in the first of them only, and each leaf gives sums and one root per vector: pairs never leave it.

Vectors that are null, empty, zero or hold null or non-finite components, null labels and null ids link with nothing and
are components of their own; vectors of different lengths are never compared. Repeated rows with one id are one vector
(of their least embedding). Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alone, arrow_map, components, without, written

TREES, LEAF, BLOCK, SAMPLE, MAX_DEPTH = 6, 256, 1024, 16_384, 24
#: A split that would send more than this share of a node's sample to both sides is not made.
MOST_SPILL = 0.35


def direction(dim: int, tree: int, level: int) -> np.ndarray:
    v = np.random.default_rng([7, dim, tree, level]).standard_normal(dim)
    return v / np.linalg.norm(v)


def margin(dim: int, threshold: float) -> float:
    """0.6 standard deviations of what a projection tells a linked pair at the threshold apart."""
    return 0.6 * (2 - 2 * threshold) ** 0.5 / dim**0.5


class Tree:
    """Thresholds of one tree: those fitted per node (heap numbers; NaN: not split), else one per level."""

    def __init__(self, nodes: dict[int, float], levels: list[float]):
        self.nodes = np.array(sorted(nodes), np.int64)
        self.cuts = np.array([nodes[k] for k in sorted(nodes)])
        self.levels = levels

    def thresholds(self, nodes: np.ndarray, level: int) -> np.ndarray:
        out = np.full(len(nodes), self.levels[level])
        if len(self.nodes):
            at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
            own = self.nodes[at] == nodes
            out[own] = self.cuts[at[own]]
        return out


def fit_tree(x: np.ndarray, tree: int, depth: int, near: float) -> Tree:
    """Memory by the sample: nodes that no sampled vector reaches split at the sample's median for their level."""
    cuts, levels = {}, []
    nodes = [(0, np.arange(len(x)))]
    for level in range(depth):
        p, below = x @ direction(x.shape[1], tree, level), []
        levels.append(float(np.median(p)))
        for node, rows in nodes:
            own = np.sort(p[rows])
            if len(rows) < 16:
                cut = float(np.median(own))
            else:
                tries = np.quantile(own, np.linspace(0.35, 0.65, 13))
                spill = np.searchsorted(own, tries + near) - np.searchsorted(own, tries - near)
                best = min(range(13), key=lambda k: (spill[k], abs(k - 6)))
                cut = float(tries[best]) if spill[best] <= MOST_SPILL * len(rows) else np.nan
            cuts[node] = cut
            if not np.isnan(cut):
                below += [(n, r) for n, r in ((2 * node + 1, rows[p[rows] < cut]), (2 * node + 2, rows[p[rows] >= cut])) if len(r)]
        nodes = below
    return Tree(cuts, levels)


def leaves(x: np.ndarray, fitted: Tree, tree: int, depth: int, near: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, nodes) of all leaves that the rows of x fall into."""
    rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
    done_r, done_n = [], []
    for level in range(depth):
        t = fitted.thresholds(nodes, level)
        stop = np.isnan(t)
        done_r.append(rows[stop])
        done_n.append(nodes[stop])
        rows, nodes, t = rows[~stop], nodes[~stop], t[~stop]
        p = (x @ direction(x.shape[1], tree, level))[rows]
        a, b = p < t + near, p >= t - near
        rows, nodes = np.concatenate([rows[a], rows[b]]), np.concatenate([2 * nodes[a] + 1, 2 * nodes[b] + 2])
    return np.concatenate([*done_r, rows]), np.concatenate([*done_n, nodes])


def pack_codes(codes: list[list[int]]) -> bytes:
    """Leaves by tree: for each tree their number, then the leaves, as 32-bit integers."""
    return np.array([x for c in codes for x in (len(c), *c)], "<i4").tobytes()


def unpack_codes(packed: bytes) -> list[list[int]]:
    flat, out, k = np.frombuffer(packed, "<i4").tolist(), [], 0
    while k < len(flat):
        out.append(flat[k + 1 : k + 1 + flat[k]])
        k += 1 + flat[k]
    return out


def _unit(lists: list) -> np.ndarray:
    x = np.array(lists, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _meet(ci: np.ndarray, cj: np.ndarray) -> np.ndarray:
    """Rows whose padded code lists share a code."""
    out = np.zeros(len(ci), bool)
    for a in range(ci.shape[1]):
        for b in range(cj.shape[1]):
            out |= (ci[:, a] == cj[:, b]) & (ci[:, a] >= 0)
    return out


def _linked(table: pa.Table, threshold: float) -> list[tuple[int, int, int]]:
    """(id, links counted here, root) of the vectors of one leaf, or of two of its blocks."""
    ids = table.column("id").to_numpy()
    order = np.argsort(ids)
    ids = ids[order]
    count, block = table.column("n").to_numpy()[order], table.column("block").to_numpy()[order]
    x = _unit(table.column("vec").to_pylist())[order]
    tree, leaf, p, q = (table.column(c)[0].as_py() for c in ("tree", "leaf", "p", "q"))
    lists = [unpack_codes(c) for c in table.column("codes").to_pylist()]
    codes = []  # of each tree up to this one, padded
    for t in range(tree + 1):
        own = [lists[k][t] for k in order.tolist()]
        width = max(map(len, own))
        codes.append(np.array([c + [-1] * (width - len(c)) for c in own], np.int64))
    earlier = np.where(codes[tree] < leaf, codes[tree], -1)  # leaves of this tree before this one
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    left = np.flatnonzero(block == p)
    right = left if p == q else np.flatnonzero(block == q)
    found_i, found_j = [], []
    for a in range(0, len(left), 256):
        rows = left[a : a + 256]
        i, j = np.nonzero(x[rows] @ x[right].T >= threshold)
        i, j = rows[i], right[j]
        if p == q:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        found_i.append(i)
        found_j.append(j)
        new = ~_meet(earlier[i], earlier[j])
        for t in range(tree):
            new &= ~_meet(codes[t][i], codes[t][j])
        np.add.at(links, i[new], count[j[new]])
        np.add.at(links, j[new], count[i[new]])
    if not found_i:
        return []
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    while True:  # the least place that links reach
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    some = np.unique(np.concatenate([i, j]))
    return [(int(ids[k]), int(links[k]), int(ids[root[k]])) for k in some]


def near_vectors(vectors: DataFrame, *, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    return alone(vectors.sparkSession, lambda: _near_vectors(vectors, threshold, id_col, vec_col, label_col)).withColumnRenamed("id", id_col)


def _near_vectors(vectors: DataFrame, threshold: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).cast("string").alias("label"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0)
    sound &= F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("vec", lambda c: c != 0)
    # vectors go by a 256-bit print of their components, so that they need not be shuffled to find equal ones
    text = F.concat_ws(",", F.transform("vec", lambda c: F.when(c == 0, F.lit(0.0)).otherwise(c.cast("double")).cast("string")))
    good = v.where(sound).withColumn("print", F.unhex(F.sha2(text, 256)))
    keys = good.select("id", "label", "print")
    twice = written(keys.groupBy("id").agg(F.min(F.struct("label", "print")).alias("s"), F.count("*").alias("n")).where("n > 1").select("id", "s"))
    if not twice.isEmpty():  # rows of one id: the least label and print
        t = twice.select(F.col("id").alias("i"), "s")
        least = lambda d: d.join(t, F.col("id") == F.col("i"), "left").where(F.col("i").isNull() | (F.struct("label", "print") == F.col("s"))).drop("i", "s").dropDuplicates(["id"])
        good, keys = least(good), least(keys)
    counted = written(keys.groupBy("label", "print").agg(F.min("id").alias("rep"), F.count("*").alias("n")))
    members = keys.join(counted.select(F.col("label").alias("l"), F.col("print").alias("p"), "rep", "n"), (F.col("label") == F.col("l")) & (F.col("print") == F.col("p"))).select("id", "rep", F.col("n").alias("copies"))
    copies = members.where("id <> rep").select("id")
    many = written(counted.where("n > 1").select(F.col("rep").alias("r"), "n"))
    classes = without(good.select("id", "label", "vec"), "id", written(copies))
    classes = written(classes.withColumnRenamed("id", "rep").join(many, F.col("rep") == F.col("r"), "left").select("rep", "label", "vec", F.coalesce("n", F.lit(1)).cast("long").alias("n")))
    most = classes.groupBy("label", F.size("vec")).count().agg(F.max("count")).first()[0] or 0
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(most, 1) / LEAF)))))
    sample: dict[int, list] = {}
    for r in classes.select("vec", "rep").orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect():
        sample.setdefault(len(r.vec), []).append(r.vec)
    forest = {dim: [fit_tree(_unit(x), t, depth, margin(dim, threshold)) for t in range(TREES)] for dim, x in sample.items()}
    shared = spark.sparkContext.broadcast(forest)  # at most twice the sample's vectors in thresholds a tree
    # components stay in their own type, which is exact and half the bytes where that is float
    kind = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"
    schema = f"id long, n long, label string, dim int, vec array<{kind}>, codes binary, leaves array<struct<tree:int,leaf:int>>"
    item = pa.float32() if kind == "float" else pa.float64()
    place = pa.struct([("tree", pa.int32()), ("leaf", pa.int32())])
    fields = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("vec", pa.list_(item)), ("codes", pa.binary()), ("leaves", pa.list_(place))])
    unseen = Tree({}, [np.nan] * depth)  # of a length that the sample has not: one leaf

    def coded(batch: pa.RecordBatch) -> pa.RecordBatch:
        vecs = batch.column(3).to_pylist()
        codes: list[list[list[int]]] = [[[] for _ in range(TREES)] for _ in vecs]
        by_dim: dict[int, list[int]] = {}
        for k, x in enumerate(vecs):
            by_dim.setdefault(len(x), []).append(k)
        for dim, ks in by_dim.items():
            x = _unit([vecs[k] for k in ks])
            for t in range(TREES):
                rows, nodes = leaves(x, shared.value[dim][t] if dim in shared.value else unseen, t, depth, margin(dim, threshold))
                for r, node in zip(rows.tolist(), nodes.tolist(), strict=True):
                    codes[ks[r]][t].append(node)
        return pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array([len(x) for x in vecs], pa.int32()), batch.column(3).cast(fields[4].type), pa.array([pack_codes([sorted(c) for c in cs]) for cs in codes], pa.binary()), pa.array([[{"tree": t, "leaf": x} for t, c in enumerate(cs) for x in c] for cs in codes], fields[6].type)], schema=fields)

    rows = arrow_map(classes.select(F.col("rep").alias("id"), "n", "label", F.col("vec").cast(f"array<{kind}>").alias("vec")), coded, schema)
    rows = written(rows)
    cells = rows.select("id", "n", "label", "dim", "vec", "codes", F.explode("leaves").alias("at")).select("id", "n", "label", "dim", "vec", "codes", "at.tree", "at.leaf")
    key = ["label", "dim", "tree", "leaf"]
    large = cells.groupBy(*key).count().where(F.col("count") > BLOCK).select(*[F.col(k).alias(f"{k}_") for k in key], F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    cells = cells.join(large, [F.col(k) == F.col(f"{k}_") for k in key], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cells = cells.withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = cells.select("id", "n", "vec", "codes", *key, "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
    out = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def compare(table: pa.Table) -> pa.Table:
        found = _linked(table, threshold) if table.num_rows > 1 else []
        return pa.table({n: pa.array([f[k] for f in found], pa.int64()) for k, n in enumerate(out.names)}, schema=out)

    # a leaf of one vector has nothing to compare; most of the others are far smaller than a block
    found = written(cells.groupBy(*key, "p", "q").applyInArrow(compare, "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    m = members.join(links.withColumnRenamed("id", "rep"), "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
    m = m.select(F.col("id").alias("i"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    r = v.select("id").join(m, F.col("id") == F.col("i"), "left")
    cid = F.coalesce("c", "id")
    return r.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"), F.coalesce(F.col("id") == cid, F.lit(True)).alias("kept"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
