"""n-gram join, embedding links and components against brute force."""

import random

import numpy as np
import pytest
from cohortlift.llm import components, embed_dedup, ngram_join


def reach(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(500, 560)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = reach({x for e in edges for x in e}, edges)
    assert all(want[n] == label for n, label in got.items())
    assert {n for a, b in edges if a != b for n in (a, b)} == set(got)
    a, b = np.array(edges).T
    local = components.local_components(600, a, b)
    assert all(local[n] == want[n] for n in want)


def sets(text):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def expected(texts, threshold=0.8):
    s = [sets(t) for t in texts]
    links = [(a, b) for a in range(len(s)) for b in range(len(s)) if a < b and len(s[a] & s[b]) / len(s[a] | s[b]) >= threshold]
    low = reach(range(len(s)), links)
    return {k: (sum(k in x for x in links), low[k], low[k] == k) for k in range(len(s))}


def texts(seed, n=50):
    rng = random.Random(seed)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta iota kappa la mu".split()) + str(rng.randrange(40))
    base = [[word() for _ in range(rng.randrange(1, 120))] for _ in range(n)]
    out = [" ".join(b) for b in base]
    for b in base:
        for _ in range(rng.randrange(4)):
            c = list(b)
            for _ in range(rng.randrange(3)):
                c[rng.randrange(len(c))] = word()
            out.append((" " * rng.randrange(1, 3)).join(c))
    return [*out, "", None, " \n", "One two", "one  TWO", "one two three four five", "a b c d e f", "a b c d e f"]


def join(df, **kw):
    rows = ngram_join.join(df, **kw).collect()
    return {r["doc_id"]: (r["n_links"], r["class_id"], r["kept"]) for r in rows}


@pytest.mark.parametrize("block", [384, 8])
def test_ngram_join_is_exact(spark, docs_of, block):
    assert join(docs_of(texts(block)), block=block) == expected(texts(block))


def test_ngram_hot_near_copies(spark, docs_of):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    many = []
    for k in range(120):
        c = list(base)
        c[rng.randrange(200)] = f"x{k}"
        many.append(" ".join(c))
    many += [" ".join(base)] * 60
    assert join(docs_of(many), block=32, block_chars=20_000) == expected(many)


def test_ngram_prefix_depth():
    d = ngram_join.depth(40, 8, 0.8, 0.99999)
    assert 1 - (1 - 0.8**d) ** 40 >= 0.99999 > 1 - (1 - 0.8 ** (d + 1)) ** 40


def test_signatures_sort_into_prefix_tries():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(30)]
    sets += [np.unique(np.r_[s[: 40 - k], rng.integers(0, 2**63, k, dtype=np.uint64)]) for k, s in enumerate(sets) if k < 9]
    first, rest = ngram_join.signatures(sets, 40, 8, 11)
    values = np.stack([(x >> np.uint64(48 - 16 * k)) & np.uint64(0xFFFF) for x in (first.view(np.uint64), rest.view(np.uint64)) for k in range(4)], -1)
    a, b = np.repeat(range(len(sets)), len(sets)), np.tile(range(len(sets)), len(sets))
    shared = ngram_join.prefix_lengths((first[a], rest[a]), (first[b], rest[b]), 8)
    want = [[next((k for k in range(8) if values[x, t, k] != values[y, t, k]), 8) for t in range(40)] for x, y in zip(a, b, strict=True)]
    assert (shared == np.array(want)).all()
    share = ngram_join.agreement((first[a], rest[a]), (first[b], rest[b]), 8).mean((1, 2))
    true = np.array([len(np.intersect1d(sets[x], sets[y])) / len(np.union1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True)])
    assert np.abs(share - true).max() < 0.15


def test_neighbours_hold_the_tries_of_every_depth(spark):
    """Rows that share a prefix of d values are joined by neighbours that share d or more, over ranges' ends too."""
    rng = np.random.default_rng(6)
    first = rng.integers(0, 3, (60, 2)) << 48 | rng.integers(0, 2, (60, 2)) << 32
    rest = rng.integers(0, 2, (60, 2)) << 48
    rows = [(k, first[k].tolist(), rest[k].tolist()) for k in range(60)]
    pairs = ngram_join.neighbours(spark.createDataFrame(rows, "rep long, first array<long>, rest array<long>"), 2, 8, 1).collect()
    value = lambda k, t: [(int(x) >> s) & 0xFFFF for x in (first[k, t], rest[k, t]) for s in (48, 32, 16, 0)]
    for d in (1, 2, 3, 5):
        links = [(a, b) for a in range(60) for b in range(a) if any(value(a, t)[:d] == value(b, t)[:d] for t in range(2))]
        assert reach(range(60), links) == reach(range(60), [(r.a, r.b) for r in pairs if r.depth >= d])


@pytest.mark.parametrize(("similar", "level"), [(0.99, 8), (0.82, 6), (None, 6)])
def test_prefixes_are_shortened_until_the_recall_is_reached(spark, similar, level):
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    for k in range(0 if similar is None else 400):
        own = rng.integers(0, 2**16, (2, 40, 8))
        own[1] = np.where(rng.random((40, 8)) < similar, own[0], own[1])
        for j, x in enumerate(own):
            packed = [sum(x[:, i + 4 * h].astype(object) << (48 - 16 * i) for i in range(4)) for h in (0, 1)]
            rows.append((2 * k + j, *[[int(v) - (1 << 64) if int(v) >> 63 else int(v) for v in p] for p in packed]))
        pairs.append((2 * k, 2 * k + 1, 8))
    classes = spark.createDataFrame(rows, "rep long, first array<long>, rest array<long>")
    pairs = spark.createDataFrame(pairs, "a long, b long, depth int")
    assert ngram_join.level_of(pairs, classes, 40, 8, 6, 0.8, 0.99999) == level


def test_ngram_null_repeated_empty(spark, docs_of):
    t = "a b c d e f g h"
    rows = ngram_join.join(docs_of([t, t, t, "x y z u v", None], ids=[None, 3, 3, 3, None])).collect()
    assert sorted((str(r["doc_id"]), r["n_links"], str(r["class_id"]), r["kept"]) for r in rows) == [
        ("3", 0, "3", True), ("3", 1, "3", True), ("3", 1, "3", True), ("None", 0, "None", False), ("None", 0, "None", False),
    ]
    assert join(docs_of([])) == {}
    kept = ngram_join.keep(docs_of([t, t, t + " ", "other words that stay here", None], ids=[5, 2, 2, 9, None]))
    assert kept.columns == docs_of([]).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "9", "None"]  # texts of doc 2 differ


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, links string")


def test_embedding_links(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((200, 16))
    x = np.concatenate([centres] + [centres[rng.integers(0, 40, 60)] + 0.05 * rng.standard_normal((60, 16)) for _ in range(5)] + [centres[:1]] * 30)
    x = x.astype(np.float32)
    rows = [(k, v.tolist(), 1, "x") for k, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, 1, "x"), (n + 1, [0.0] * 16, 1, "x"), (n + 2, [float("nan")] * 16, 1, "x"), (n + 3, [None] * 16, 1, "x"), (n + 4, [], 1, "x"), (n + 5, [1.0, 2.0], 1, "x"), (n + 6, [1.0, 2.0], 2, "x"), (None, x[0].tolist(), 1, "x"), (n + 7, [float("inf")] * 16, 1, "x")]
    got = {r["vec_id"]: tuple(r)[1:] for r in embed_dedup.link_vectors(vectors(spark, rows), leaf=32, block=24).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    want = s.sum(1)
    have = np.array([got[k][0] for k in range(n)])
    assert (have <= want).all() and have.sum() >= 0.95 * want.sum()
    low = reach(range(n), list(zip(*np.nonzero(s))))
    assert np.mean([got[k][1] == low[k] for k in range(n)]) > 0.95
    assert all(got[n + k] == (0, n + k, True) for k in (0, 1, 2, 3, 4, 7))
    assert got[n + 5] == (1, n + 5, True) and got[n + 6] == (1, n + 5, False)
    assert got[None] == (0, None, False)


def test_embedding_exact_in_one_leaf(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.standard_normal((20, 8)), 6, axis=0) + 0.08 * rng.standard_normal((120, 8))
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.link_vectors(vectors(spark, [(k, v.tolist(), 0, "") for k, v in enumerate(x.astype(np.float32))])).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert [got[k] for k in range(120)] == ((u @ u.T >= 0.9).sum(1) - 1).tolist()


def test_embedding_repeated_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 0, ""), (1, [0.0, 1.0], 0, ""), (2, [0.0, 1.0], 0, ""), (3, [1.0, -0.0], 0, "")]
    got = sorted(tuple(r) for r in embed_dedup.link_vectors(vectors(spark, rows)).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    assert embed_dedup.link_vectors(vectors(spark, [])).collect() == []


@pytest.mark.parametrize("depth", [9, 12])
def test_embedding_forest_recall_of_a_hot_cluster(depth):
    rng = np.random.default_rng(depth)
    base = rng.standard_normal((7000, 64)) / 8
    hot = base[0] + 0.0355 * rng.standard_normal((6000, 64))
    x = np.concatenate([hot, base, base + 0.05 * rng.standard_normal((7000, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = embed_dedup.Forest(x[rng.permutation(len(x))], 4, depth, 0.1, 7)
    rows, leaves = forest.leaves(x)
    member = np.zeros((len(x), leaves.max() + 1), bool)
    member[rows, leaves] = True

    def recall(a, b):
        linked = (x[a] * x[b]).sum(1) >= 0.9
        return (member[a] & member[b]).any(1)[linked].mean()

    a, b = rng.integers(0, 6000, (2, 10000))
    assert recall(a[a != b], b[a != b]) >= 0.9
    k = np.arange(6000, 9000)
    assert recall(k, k + 7000) >= 0.98
    # what is not hot is still split
    assert np.bincount(leaves[rows >= 6000]).max() <= 0.1 * 14000
