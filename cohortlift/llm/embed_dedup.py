"""Near-duplicate vectors by a forest of random projection trees.

A tree splits recursively at a random direction; vectors near the split (the
``spill`` quantiles on either side of the median) go to both sides. Pairs are
compared within the leaves of every tree by exact cosine in double precision,
links are united to components.

A node whose links are not short against its spread (a hot cluster of distinct
near vectors) would lose some of them at every split: it is cut elsewhere, with
a wider spill, or stays a leaf, however many vectors it holds, so recall does not
fall with depth.

The trees are fitted on a bounded sample (``sample`` distinct vectors, the
smallest by hash), every vector is routed through them. Depth follows the
number of distinct vectors up to ``max_depth``, so the trees that tasks receive
are at most trees x 2^max_depth directions.

Scale: equal vectors are one class with a weight before anything else, so
copies cost nothing more. A leaf is compared in blocks of about ``block``
vectors, each pair of blocks in a task of its own, however many vectors a leaf
holds. Pairs are never rows: a block sends one row per vector, with the
summed weights of its links and its component within the block. A pair that
meets in several leaves counts only in the first one they share.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing, and so do vectors of different lengths; a null vec_id takes
no part (no links, component_id null, kept false); rows with equal vectors are
linked, and rows that repeat a vec_id are in one component; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components, local_components


#: Widest spill; recall aimed at for links at the threshold; sample rows that a split needs, and that its lost links
#: are counted on; shares to cut a node at, and further directions to try where none will do.
WIDEST, RECALL, LEAST, COUNTED = 0.15, 0.98, 16, 512
CUTS, TRIES = (0.5, 0.35, 0.65, 0.25, 0.75), 8


class Forest:
    """Random directions and spill limits, by tree and node (complete binary trees); a node with ``stop`` is a leaf.

    A split may lose ``loss`` of the links, so that ``RECALL`` is left after ``depth`` splits in ``trees`` trees. Where
    the node's links are too long against its spread for that, the spill is widened, the cut or the direction changed,
    and if nothing helps the node is not split.
    """

    def __init__(self, sample: np.ndarray, trees: int, depth: int, spill: float, seed: int, threshold: float = 0.9):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1] if sample.ndim == 2 else 0
        self.depth, self.trees = depth, trees
        self.directions = rng.standard_normal((trees, 2**depth - 1, dim))
        self.low = np.zeros((trees, 2**depth - 1))
        self.high = np.zeros((trees, 2**depth - 1))
        self.stop = np.ones((trees, 2 ** (depth + 1) - 1), bool)
        loss = 1 - (1 - (1 - RECALL) ** (1 / trees)) ** (1 / max(1, depth))
        for t in range(trees):
            rows, nodes = np.arange(len(sample)), np.zeros(len(sample), np.int64)
            for level in range(depth):
                if not len(rows):
                    break
                order = np.argsort(nodes, kind="stable")
                found, first = np.unique(nodes[order], return_index=True)
                for node, own in zip(found, np.split(order, first[1:]), strict=True):
                    if split := _split(sample[rows[own]], self.directions[t, node], rng, spill, threshold, loss):
                        self.directions[t, node], self.low[t, node], self.high[t, node] = split
                        self.stop[t, node] = False
                go = ~self.stop[t, nodes]
                rows, nodes = rows[go], nodes[go]
                rows, nodes = self._down(t, rows, nodes, (sample[rows] * self.directions[t, nodes]).sum(1))

    def _down(self, t, rows, nodes, at):
        left, right = at <= self.high[t, nodes], at >= self.low[t, nodes]
        return np.r_[rows[left], rows[right]], np.r_[2 * nodes[left] + 1, 2 * nodes[right] + 2]

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for all leaves a vector goes to, leaves numbered across trees; sorted."""
        found = []
        for t in range(self.trees):
            rows, nodes = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
            while len(rows):
                stop = self.stop[t, nodes]
                found.append((rows[stop], nodes[stop] + t * self.stop.shape[1]))
                rows, nodes = rows[~stop], nodes[~stop]
                rows, nodes = self._down(t, rows, nodes, (vectors[rows] * self.directions[t, nodes]).sum(1))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, leaf = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((leaf, rows))
        return rows[order], leaf[order]


def _split(x: np.ndarray, direction: np.ndarray, rng, spill: float, threshold: float, loss: float):
    """(direction, low, high) with which a split of the rows x loses at most ``loss`` of the links: of those at the
    threshold, by the density at the cut, and of those among the rows. Of the ``direction``'s cuts, the one
    that leaves the fewest comparisons; if it has none, of up to ``TRIES`` other directions. None if they have none."""
    if len(x) < LEAST:
        return None
    reach = max(1e-9, math.sqrt(max(0.0, 2 - 2 * threshold)))  # directions are normal, so a link's projection is too
    some = x[:COUNTED]  # rows lie in order of their hash
    a, b = np.nonzero(np.triu(some @ some.T >= threshold, 1))
    shares = sorted({spill, max(spill, (spill + WIDEST) / 2), max(spill, WIDEST)})
    for k in range(1 + TRIES):
        if k:
            direction = rng.standard_normal(x.shape[1])
        at = x @ direction
        least, best = 1.0, None
        for cut in CUTS:
            for share in shares:
                if share >= min(cut, 1 - cut) or (left := (cut + share) ** 2 + (1 - cut + share) ** 2) >= least:
                    continue
                low, high = np.quantile(at, (cut - share, cut + share))
                if high <= low:
                    continue
                w = (high - low) / reach
                beyond = 2 * (math.exp(-w * w / 2) / math.sqrt(2 * math.pi) - w * math.erfc(w / math.sqrt(2)) / 2)
                if beyond * 2 * share / w > loss:
                    continue
                if not len(a) or ((np.minimum(at[a], at[b]) < low) & (np.maximum(at[a], at[b]) > high)).mean() <= loss:
                    least, best = left, (direction, low, high)
        if best:
            return best
    return None


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows in double precision, of list values of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _linked(x: np.ndarray, y: np.ndarray, same: bool, threshold: float):
    a, b = [], []
    for k in range(0, len(x), 1024):
        i, j = np.nonzero(x[k : k + 1024] @ y.T >= threshold)
        i += k
        if same:
            i, j = i[i < j], j[i < j]
        a.append(i)
        b.append(j)
    return np.concatenate(a), np.concatenate(b)


def _first_shared(leaves: np.ndarray, a: np.ndarray, b: np.ndarray, leaf: int) -> np.ndarray:
    """Whether ``leaf`` is the smallest leaf that the rows a and b share; leaves: padded with -1 and sorted."""
    out = np.ones(len(a), bool)
    for k in range(0, len(a), 100_000):
        x, y = leaves[a[k : k + 100_000]], leaves[b[k : k + 100_000]]
        for c in range(leaves.shape[1]):
            now = x[:, c, None]
            out[k : k + 100_000] &= ~((now == y) & (now >= 0) & (now < leaf)).any(1)
    return out


def link_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    trees: int = 4,
    spill: float = 0.1,
    leaf: int = 1024,
    max_depth: int = 12,
    sample: int = 20_000,
    block: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    absolute = F.transform("v", lambda e: F.abs(e.cast("double")))
    valid = F.col("vec_id").isNotNull() & F.coalesce(
        F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
        & (F.array_max(absolute) > 0),
        F.lit(False),
    )
    # zeros of either sign are equal
    digest = F.md5(F.to_json(F.struct(F.transform("v", lambda e: F.when(e == 0, F.abs(e)).otherwise(e)).alias("v"))))
    rows = written(rows.select("vec_id", "v", F.when(valid, digest).alias("class")), "vectors")
    classes = rows.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("v").alias("v")
    )
    classes = written(classes.withColumn("dim", F.size("v")), "classes")
    links, edges = [], []
    for dim in [r["dim"] for r in classes.select("dim").distinct().collect()]:
        own = classes.filter(F.col("dim") == dim)
        found = _within(own, threshold, trees, spill, leaf, max_depth, sample, block, seed)
        links.append(found.groupBy("class").agg(F.sum("links").alias("links")))
        edges.append(found.select("a", "b"))
    # rows that share a vec_id are one node; equal vectors are a star around their class's smallest id
    star = rows.filter(F.col("class").isNotNull()).join(classes.select("class", "rep", "weight"), "class")
    star = star.select("vec_id", "class", "rep", "weight")
    for e in [star.select(F.col("vec_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")]:
        edges.append(e)
    united = edges[0]
    for e in edges[1:]:
        united = united.union(e)
    labels = components(united)
    out = rows.select("vec_id", "class").join(classes.select("class", "weight"), "class", "left")
    if links:
        total = links[0]
        for x in links[1:]:
            total = total.union(x)
        out = out.join(total, "class", "left")
    else:
        out = out.withColumn("links", F.lit(0))
    out = out.join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("label", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _within(classes: DataFrame, threshold, trees, spill, leaf, max_depth, sample, block, seed) -> DataFrame:
    """Per block, a row for each linked class: its links' weight, and an edge
    between its smallest id and that of its component in the block."""
    n = classes.count()
    depth = min(max_depth, max(0, int(np.ceil(np.log2(max(1, n / leaf))))))
    fit = classes.select("v").orderBy("class").limit(sample).toArrow()  # the digest is the hash
    forest = Forest(_matrix(fit.column("v")), trees, depth, spill, seed, threshold)
    shared = classes.sparkSession.sparkContext.broadcast(vars(forest))

    def route(batches):
        own = Forest.__new__(Forest)
        vars(own).update(shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, leaf_ = own.leaves(_matrix(batch.column("v")))
            counts = np.bincount(row, minlength=batch.num_rows)
            offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(leaf_, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "leaves"])

    base = classes.select("class", "rep", "weight", "v")
    kind = classes.schema["v"].dataType.simpleString()
    routed = written(base.mapInArrow(route, f"class string, rep long, weight long, v {kind}, leaves array<int>"), "routed")
    each = routed.withColumn("leaf", F.explode("leaves"))
    # at most trees x 2^max_depth leaves, as a node that is not split has none below it
    sizes = each.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    each = each.join(F.broadcast(sizes), "leaf")
    each = each.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("blocks")))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    each = each.select(
        "leaf", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "class", "rep", "weight", "v", "leaves"
    )

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        leaf_, i, j = (k.as_py() for k in key)
        mine = table.column("mine").to_numpy()
        table = table.take(pa.array(np.argsort(mine, kind="stable")))
        first = int((mine == i).sum())
        x = _matrix(table.column("v"))
        if i == j:
            a, b = _linked(x, x, True, threshold)
        else:
            a, b = _linked(x[:first], x[first:], False, threshold)
            b = b + first
        lists = table.column("leaves").combine_chunks()
        counts = lists.value_lengths().to_numpy()
        padded = np.full((len(lists), counts.max() if len(counts) else 0), -1)
        padded[np.arange(padded.shape[1]) < counts[:, None]] = lists.flatten().to_numpy()
        new = _first_shared(padded, a, b, leaf_)
        a, b = a[new], b[new]
        weight, rep = table.column("weight").to_numpy(), table.column("rep").to_numpy()
        links = np.bincount(a, weight[b], len(x)) + np.bincount(b, weight[a], len(x))
        label = local_components(len(x), a, b)
        out = np.flatnonzero(links)
        return pa.table({
            "class": table.column("class").take(pa.array(out)), "links": pa.array(links[out].astype(np.int64)),
            "a": pa.array(rep[out]), "b": pa.array(rep[label[out]]),
        })

    found = each.groupBy("leaf", "i", "j").applyInArrow(compare, "class string, links long, a long, b long")
    return written(found, "links")
