"""Near-duplicate documents: Jaccard join of word shingles by a MinHash LSH forest.

A document's set holds its runs of ``words`` lower-case, blank-separated words
(all its words, if fewer). A tree's signature is a row of ``levels`` MinHash values
(16 bits each). The forest is the sorted order of (tree, signature): its prefix
tries are the runs of rows that agree on their first values, and the prefix
that a row shares with the row before it holds all of them, at any depth.

Matched prefixes are shortened from the whole signature on. At each depth the
links met so far (neighbours in the order whose signatures agree in a share of
``threshold`` or more) tell how many were missed: one of similarity s is met in
some tree with probability P = 1 - (1 - s^depth)^trees, so each found stands for
(1 - P) / P that were not. Shortening ends when the recall so estimated reaches
``recall``, a link at the threshold added for what was never seen; at the latest
at the depth at which links at the threshold are met with that probability.
Candidates are then verified exactly on their whole sets.

Scale: documents with equal sets are one class with a weight first, so copies
cost nothing more. The order is one range sort of 40 rows per class; classes of
equal signatures, however many, are spread over ranges by their ids, and the
ranges' ends are stitched (two rows per range on the driver). Neighbours make
candidate components; a component is verified in blocks of about ``block``
classes and ``block_chars`` characters, each pair of blocks by itself.
Pairs are never rows beyond neighbours: a pair of blocks yields a row per class,
with its links' weight and its component there. Texts are shuffled once.

Cases: null text is empty; texts without words are equal to one another; a null
doc_id takes no part (n_links 0, class_id null, kept false); rows that repeat a
doc_id are one node, each row with its own text's links; an empty table gives
an empty result; further columns are ignored (``keep`` carries them through).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, polynomial, runs, small, text_of, written
from .components import components, local_components

SLICE_BYTES = 900 << 10


def shingles(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles."""
    out, at = [], 0
    while at < len(texts):  # so many texts at a time that the arrays stay small
        raw, size = [], 0
        while at + len(raw) < len(texts) and size < SLICE_BYTES:
            raw.append(" ".join(texts[at + len(raw)].lower().split()).encode())
            size += len(raw[-1]) + 1
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        poly = polynomial(len(data))
        prefix = poly.prefix(data)
        stops = np.flatnonzero((data == 32) | (data == 10))  # blanks between words, newlines between texts
        last = np.cumsum([len(r) + 1 for r in raw]) - 1  # each text's newline
        first_stop = np.searchsorted(stops, np.r_[0, last[:-1] + 1])
        end_stop = np.searchsorted(stops, last)
        begin = np.r_[0, last[:-1] + 1]
        for k in range(len(raw)):
            ends = stops[first_stop[k] : end_stop[k] + 1]
            starts = np.r_[begin[k], ends[:-1] + 1]
            n = len(ends)
            if n > words:
                starts, ends = starts[: n - words + 1], ends[words - 1 :]
            else:
                starts, ends = starts[:1], ends[-1:]
            out.append(np.unique(poly.ranges(prefix, starts, ends)))
        at += len(raw)
    return out


def depth(trees: int, max_depth: int, threshold: float, recall: float) -> int:
    """The longest prefix at which pairs at the threshold are found with probability ``recall``."""
    for d in range(max_depth, 1, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def signatures(sets: list[np.ndarray], trees: int, levels: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Per set and tree, 16 bits of each of the tree's MinHash values, the first four in one long, the rest in another."""
    rng = np.random.default_rng(seed)
    flip, odd = (rng.integers(0, 2**63, trees * levels, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    out = np.zeros((2, len(sets), trees), np.uint64)
    for k, own in enumerate(sets):
        low = np.full(trees * levels, np.iinfo(np.uint64).max, np.uint64)
        for c in range(0, len(own), 512):
            np.minimum(low, (((own[c : c + 512, None] ^ flip) * odd)).min(0), out=low)
        bits = (low ^ low >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)
        for level, value in enumerate(bits.reshape(trees, levels).T):
            out[level // 4, k] |= value << np.uint64(48 - 16 * (level % 4))
    return out[0].view(np.int64), out[1].view(np.int64)


def agreement(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], levels: int) -> np.ndarray:
    """Which of the ``levels`` values of signatures (first, rest) are equal; values along the last axis."""
    x = [(p ^ q).view(np.uint64) for p, q in zip(a, b, strict=True)]
    return np.stack([x[k // 4] >> np.uint64(48 - 16 * (k % 4)) & np.uint64(0xFFFF) for k in range(levels)], -1) == 0


def prefix_lengths(a, b, levels: int) -> np.ndarray:
    """Lengths of the common prefixes of signatures."""
    return np.logical_and.accumulate(agreement(a, b, levels), -1).sum(-1)


def digest(own: np.ndarray) -> bytes:
    import hashlib

    return hashlib.md5(own.tobytes()).digest()


def _jaccard_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float):
    """Index pairs (into a, into b; or within a) of sets with Jaccard >= threshold."""
    both = a if b is None else a + b
    ids, inverse = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    shared = np.bincount(inverse, minlength=len(ids))[inverse] > 1
    owner, inverse = owner[shared], inverse[shared]
    ids, inverse = np.unique(inverse, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    owner, inverse = owner[order], inverse[order]
    inter = np.zeros((len(a), len(both) - (0 if b is None else len(a))), np.float32)
    step = max(256, (4 << 20) // max(1, len(both)))
    for c in range(0, len(ids), step):
        lo, hi = np.searchsorted(inverse, (c, c + step))
        m = np.zeros((len(both), min(step, len(ids) - c)), np.float32)
        m[owner[lo:hi], inverse[lo:hi] - c] = 1
        inter += m[: len(a)] @ (m.T if b is None else m[len(a) :].T)
    size = np.array([len(s) for s in both], np.float64)
    other = size if b is None else size[len(a) :]
    inter = inter.astype(np.float64)
    i, j = np.nonzero(inter / (size[: len(a), None] + other - inter) >= threshold)
    if b is None:
        i, j = i[i < j], j[i < j]
    return i, j


def neighbours(classes: DataFrame, trees: int, levels: int, least: int) -> DataFrame:
    """(a, b, depth): classes next to each other in the forest's order whose signatures share ``least`` values or more."""
    each = classes.select("rep", F.posexplode(F.arrays_zip("first", "rest")).alias("tree", "s"))
    keys = ["tree", "first", "rest", "rep"]
    each = each.select("tree", "s.first", "s.rest", "rep").repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "a long, b long, depth int, tree int, first long, rest long, part int"

    def run(batches):
        part, last = TaskContext.get().partitionId(), None

        def rows(a, b, depth, row=(0, 0, 0)):
            n = len(a)
            values = [a, b, np.broadcast_to(depth, n), *[np.full(n, x) for x in row], np.full(n, part)]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=[x.split()[0] for x in schema.split(", ")])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy() for c in batch.columns]
            if last is None:  # the ends of a range, to be stitched
                yield rows(now[3][:1], now[3][:1], -1, [c[0] for c in now[:3]])
            else:
                now = [np.concatenate([x, c]) for x, c in zip(last, now, strict=True)]
            tree, first, rest, rep = now
            shared = np.where(tree[1:] == tree[:-1], prefix_lengths((first[1:], rest[1:]), (first[:-1], rest[:-1]), levels), 0)
            near = np.flatnonzero(shared >= least)
            yield rows(rep[near + 1], rep[near], shared[near])
            last = [c[-1:] for c in now]
        if last is not None:
            yield rows(last[3], last[3], -2, [c[0] for c in last[:3]])

    found = written(each.mapInArrow(run, schema), "neighbours")
    ends = sorted(tuple(r) for r in found.filter("depth < 0").select("part", -F.col("depth"), "a", "tree", "first", "rest").collect())
    stitched = []
    for x, y in zip(ends[1::2], ends[2::2], strict=False):
        if x[3] == y[3]:
            shared = prefix_lengths(*[tuple(np.array([v], np.int64) for v in e[4:]) for e in (x, y)], levels)
            stitched.append((y[2], x[2], int(shared[0])))
    edges = found.filter("depth >= 0").select("a", "b", "depth")
    edges = edges.union(classes.sparkSession.createDataFrame([e for e in stitched if e[2] >= least], "a long, b long, depth int"))
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "depth").filter("a <> b")
    pairs = written(pairs.groupBy("a", "b").agg(F.max("depth").alias("depth")), "neighbour_pairs")
    discard(found)
    return pairs


def level_of(pairs: DataFrame, classes: DataFrame, trees: int, levels: int, least: int, threshold: float, recall: float) -> int:
    """The longest prefix at which the estimated recall is reached, ``least`` at the shortest."""
    signed = classes.select("rep", "first", "rest")
    for x in "ab":
        pairs = pairs.join(signed.select(F.col("rep").alias(x), F.col("first").alias(f"first_{x}"), F.col("rest").alias(f"rest_{x}")), x)

    def similarity(batches):
        for batch in small(batches, 2048):
            a, b = ([batch.column(f"{c}_{x}").flatten().to_numpy().reshape(-1, trees) for c in ("first", "rest")] for x in "ab")
            share = agreement(a, b, levels).mean((1, 2))
            yield pa.RecordBatch.from_arrays([batch.column("depth"), pa.array(share)], names=["depth", "s"])

    links = pairs.mapInArrow(similarity, "depth int, s double").filter(F.col("s") >= threshold)
    met = lambda s, d: 1 - F.pow(1 - F.pow(s, F.lit(float(d))), F.lit(float(trees)))
    depths = range(levels, least, -1)
    sums = []
    for d in depths:
        own = F.col("depth") >= d
        p = met(F.col("s"), d)
        sums += [F.sum(own.cast("long")).alias(f"found{d}"), F.sum(F.when(own, (1 - p) / p)).alias(f"missed{d}")]
    if not sums:
        return least
    got = links.agg(*sums).first()
    for d in depths:
        found = got[f"found{d}"] or 0
        unseen = (got[f"missed{d}"] or 0.0) + (1 - threshold**d) ** trees
        if found and found / (found + unseen) >= recall:
            return d
    return least


def join(
    docs: DataFrame,
    threshold: float = 0.8,
    words: int = 5,
    trees: int = 40,
    levels: int = 8,
    recall: float = 0.99999,
    block: int = 384,
    block_chars: int = 64 << 20,
    seed: int = 11,
) -> DataFrame:
    """(doc_id, n_links, class_id, kept): how many other documents (rows) have a
    Jaccard similarity of ``threshold`` or more; the smallest doc_id reachable
    by such links, itself included."""
    if levels > 8:
        raise ValueError("a signature has up to 8 levels")
    least = depth(trees, levels, threshold, recall)

    def sign(batches):
        for b in small(batches, 2048):
            texts = b.column(1).to_pylist()
            sets = shingles(texts, words)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), trees).cast(pa.list_(pa.int64())) for x in signatures(sets, trees, levels, seed)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([digest(s) for s in sets], pa.binary()), pa.array([len(t) for t in texts], pa.int64()), *lists],
                names=["doc_id", "class", "chars", "first", "rest"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    labelled = written(rows.mapInArrow(sign, "doc_id long, class binary, chars long, first array<long>, rest array<long>"), "signatures")
    known = labelled.filter("doc_id is not null")
    classes = known.groupBy("class").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.max("chars").alias("chars"), F.first("first").alias("first"), F.first("rest").alias("rest")
    )
    classes = written(classes, "classes")
    pairs = neighbours(classes, trees, levels, least)
    level = level_of(pairs, classes, trees, levels, least, threshold, recall)
    candidates = components(pairs.filter(F.col("depth") >= level).select("a", "b")).withColumnRenamed("node", "rep")
    member = classes.select("class", "rep", "weight", "chars").join(candidates, "rep")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(block)), F.ceil(F.sum("chars") / F.lit(block_chars)), F.lit(1).cast("long"))
    sizes = member.groupBy("label").agg(blocks.alias("blocks"))
    member = written(member.drop("chars").join(sizes, "label"), "members")

    def verify(batches):
        for table in runs(batches, ["label", "i", "j"]):
            texts = table.column("text").to_pylist()
            sets = shingles(texts, words)
            mine, i, j = table.column("mine").to_pylist(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
            wanted = table.column("class").to_pylist()
            # a row whose doc_id is repeated with another text is not the class's text
            take = {}
            for k, s in enumerate(sets):
                if wanted[k] not in take and digest(s) == wanted[k]:
                    take[wanted[k]] = k
            left = [k for k in take.values() if mine[k] == i]
            right = [] if i == j else [k for k in take.values() if mine[k] == j]
            if len(left) < 2 and not right or not left:
                continue
            a, b = _jaccard_pairs([sets[k] for k in left], [sets[k] for k in right] or None, threshold)
            own = np.array(left + right)
            if right:
                b = b + len(left)
            weight, rep = (table.column(c).to_numpy()[own] for c in ("weight", "rep"))
            links = np.bincount(a, weight[b], len(own)) + np.bincount(b, weight[a], len(own))
            root = local_components(len(own), a, b)
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([wanted[k] for k in own[found]], pa.binary()), pa.array(links[found].astype(np.int64)), pa.array(rep[found]), pa.array(rep[root[found]])],
                names=["class", "links", "a", "b"],
            )

    each = member.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    text = rows.filter("doc_id is not null").withColumnRenamed("doc_id", "rep")
    # by shuffle at any size: the documents in question grow with all documents
    each = each.join(text.hint("merge"), "rep").withColumn("other", other)
    each = each.select("label", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "class", "rep", "weight", "text")
    each = each.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    found = written(each.mapInArrow(verify, "class binary, links long, a long, b long"), "links")

    # rows that share a doc_id are one node; a class is a star around its smallest id
    star = known.join(classes.select("class", "rep"), "class").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    names = components(found.select("a", "b").union(star).distinct())
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    out = labelled.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    out = out.join(classes.select("class", "weight"), "class", "left").join(links, "class", "left")
    out = out.join(names.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    group = F.coalesce("label", "doc_id")
    return out.select(
        "doc_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
        group.alias("class_id"),
        F.coalesce(F.col("doc_id") == group, F.lit(False)).alias("kept"),
    )


def keep(docs: DataFrame, **kw) -> DataFrame:
    """One document of each class (the smallest doc_id), with all columns; rows
    without doc_id stay, a repeated row of a kept document goes."""
    kept = join(docs, **kw).filter("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    stay = rows.filter("id is not null").join(kept.hint("merge"), "id", "left_semi").dropDuplicates(["id", "text"])
    out = stay.unionByName(rows.filter("id is null"))
    return out.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def join_sql(threshold: float = 0.8, words: int = 5) -> str:
    """Brute force for DuckDB: pairs by shared shingles, then reachability."""
    shingle = f"[array_to_string(w[i:i+{words - 1}], ' ') for i in range(1, greatest(2, len(w) - {words - 2}))]"
    return f"""
    WITH RECURSIVE t AS (SELECT doc_id, string_split_regex(trim(lower(coalesce(text, ''))), '\\s+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest({shingle}) AS g FROM t),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE k / (a.n + b.n - k) >= {threshold}::DOUBLE),
    reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
    c AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x),
    l AS (SELECT x, count(*) AS k FROM link GROUP BY x)
    SELECT d.doc_id, coalesce(l.k, 0)::BIGINT AS n_links, c.class_id, d.doc_id = c.class_id AS kept
    FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN l ON l.x = d.doc_id
    """
