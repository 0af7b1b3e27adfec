import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cohortlift.llm import suffix


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) per text."""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def check(spark, docs_of, texts, length=40, gram=12, **kw):
    df = docs_of(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats_digest(df, length, gram, **kw).collect()}
    assert got == dict(enumerate(brute(texts, length)))


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8))) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [words(rng, 14) for _ in range(5)]
    texts = []
    for _ in range(40):
        t = words(rng, rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p)), 2))
            at = rng.randrange(len(t) + 1)
            t = t[:at] + p[a:b] * rng.choice([1, 1, 2]) + t[at:]
        texts.append(t)
    texts += [texts[3], texts[3], texts[4] + "x", "x" + texts[4], texts[5][:30] + "#" + texts[5][31:]]
    return texts + [None, "", "a" * 300, "ab" * 90, "a" * 39, "é" * 60]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, docs_of, seed):
    check(spark, docs_of, corpus(seed))


def test_many_ranges_runs_and_cut_groups(spark, docs_of, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, docs_of, corpus(3), entries=40)
        check(spark, docs_of, corpus(3), entries=40, max_broadcast=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_passage(spark, docs_of):
    rng = random.Random(5)
    p = words(rng, 12)
    check(spark, docs_of, [words(rng, 6) + p + words(rng, 6) for _ in range(150)] + [p] * 40)


def test_repeated_rows_null_ids_empty_table(spark, docs_of):
    t = "the quick brown fox jumps over the lazy dog again and again"
    rows = suffix.remove_repeats_digest(docs_of([t, t, "short"], ids=[None, None, 4]), 40, 12).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"], r["n_spans"]) for r in rows) == [("4", 0, 0), ("None", len(t), 1), ("None", len(t), 1)]
    assert suffix.remove_repeats_digest(docs_of([]), 40, 12).collect() == []


def test_remaining_bytes(spark, docs_of):
    t = "0123456789" * 3 + "abcdefghijklmnopqrst"
    rows = {r["doc_id"]: r["kept"] for r in suffix.remove_repeats(docs_of([t + "#", "!" + t, "z"]), 50, 12).collect()}
    assert {k: bytes(v) if v is not None else None for k, v in rows.items()} == {0: b"#", 1: b"!", 2: None}


def test_merge_is_a_merge_sort_with_common_prefixes():
    rng = random.Random(1)
    for streams in (1, 2, 3, 7, 8):
        data = [sorted({bytes(rng.choices(b"ab", k=rng.randrange(1, 12))) for _ in range(rng.randrange(0, 30))}) for _ in range(streams)]
        coded = []
        for own in data:
            shared = [0] + [suffix.common(a, b, 0) for a, b in zip(own, own[1:])]
            coded.append((shared[: len(own)], [s[n:] for s, n in zip(own, shared)]))
        order = [(data[s][i], known, n) for s, i, known, n in suffix.merge(coded)]
        assert [x for x, _, _ in order] == sorted(x for own in data for x in own)
        for (a, _, _), (b, known, n) in zip(order, order[1:]):
            assert known == suffix.common(a, b, 0) and n == len(b)


def test_front_coding_round_trip():
    strings = [b"aaa", b"aab", b"b", b"bcd"]
    places = [[(1, 2, 3)], [(4, 5, 6), (7, 8, 9)], [(-1, -(1 << 63), 0)], [(0, 0, 0)]]
    shared, rests, found = suffix.decoded(suffix.front_coded(strings, places))
    out, last = [], b""
    for n, r in zip(shared, rests):
        last = last[:n] + r
        out.append(last)
    assert out == strings and [list(map(tuple, p.T.tolist())) for p in found] == places


@pytest.mark.parametrize("levels", [[4, 14], [4, 9, 14], [4, 6, 7, 11, 14]])
def test_chosen_suffixes_hold_all_that_anchors_share(levels):
    """Merging the chosen suffixes alone gives each anchor the union of what it shares with any other of its gram."""
    length, gram = levels[-1], levels[0]
    reach, taken, lengths_shared = length - gram, 0, 0
    for seed in range(400):
        rng = random.Random(seed)
        # anchors: (gram, reversed left context, own, right context), in the order of the sort
        near = rng.choice([2, 6])
        rows = {}
        for _ in range(rng.randrange(2, 25)):
            left = [rng.choices("ab", [near, 1])[0] for _ in range(rng.choice([reach, reach, rng.randrange(reach + 1)]))]
            right = [rng.choices("ab", [near, 1])[0] for _ in range(rng.choice([length, length, rng.randrange(gram, length)]) - gram)]
            rows[rng.randrange(2), "".join(left), "g" * gram + "".join(right)] = rng.random() < 0.8
        rows = sorted((g, left.encode(), own, right.encode()) for (g, left, right), own in rows.items())
        lefts, rights = [r[1] for r in rows], [r[3] for r in rows]
        lcp = suffix.neighbours_common(pa.array(lefts, pa.binary()), reach)
        assert lcp.tolist() == [suffix.common(a, b, 0) for a, b in zip(lefts, lefts[1:])]
        hashes = np.array([[hash(r[:n]) for n in levels[1:]] for r in rights])
        own = np.array([r[2] for r in rows])
        who, how = suffix.chosen(np.array([r[0] for r in rows]), lcp, np.array([len(r) for r in rights]), hashes, own, levels)
        assert len(set(zip(who.tolist(), how.tolist()))) == len(who)
        merged, wanted = {}, {}
        sorted_ = [(int(a), int(n), rows[a][0], lefts[a][:n][::-1] + rights[a]) for a, n in zip(who, how)]
        for a, n, g, s in sorted_:
            best = max((suffix.common(s, t, 0) for b, _, h, t in sorted_ if b != a and h == g), default=0)
            if best >= length:
                x = merged.get(a, (0, 0))
                merged[a] = max(x[0], n), max(x[1], best - n)
        for a in range(len(rows)):
            for b in range(len(rows)):
                if a != b and rows[a][0] == rows[b][0]:
                    n, m = suffix.common(lefts[a], lefts[b], 0), suffix.common(rights[a], rights[b], 0)
                    lengths_shared += n + m >= length
                    if n + m >= length:
                        x = wanted.get(a, (0, 0))
                        wanted[a] = max(x[0], n), max(x[1], m)
        assert {a: x for a, x in merged.items() if own[a]} == {a: x for a, x in wanted.items() if own[a]}
        taken += len(who)
    assert lengths_shared > 1000 and taken > 1000


def test_suffixes_of_an_anchor_do_not_grow_with_the_lengths_it_shares():
    """Near copies: anchors share many lengths with each other, two suffixes and their partners' do."""
    rng = random.Random(4)
    levels = [64, 83, 102, 122, 141, 161, 180, 200]
    # right contexts differ after the gram, each is that of two anchors; left ones share 0 to 135 bytes
    lefts = sorted({b"a" * n + bytes(rng.choices(b"bc", k=136 - n)) for n in range(137) for _ in range(2)})[:270]
    n = len(lefts)
    right = [k % (n // 2) for k in range(n)]
    rights = np.array([[k] * 7 for k in right])
    lcp = suffix.neighbours_common(pa.array(lefts, pa.binary()), 136)
    who, _ = suffix.chosen(np.zeros(n, np.int64), lcp, np.full(n, 200), rights, np.ones(n, bool), levels)
    ways = [suffix.shared_lengths(lefts, right, lcp.tolist(), False, back) for back in (False, True)]
    before = sum(len(a | b) for a, b in zip(ways[0], ways[1][::-1]))
    assert len(who) <= 4 * n < before / 5


def test_contexts_end_with_the_text():
    texts = [b"0123456789", b"", b"xx0123456789yy", b"6789"]
    counts, at = np.array([2, 0, 1, 1]), np.array([0, 6, 8, 0])
    ((first, last, left, avail, rights),) = suffix.contexts_of(texts, counts, at, 5, [3, 4, 6])
    assert (first, last, left.to_pylist(), avail.tolist()) == (0, 4, [b"", b"54321", b"54321", b""], [6, 4, 6, 4])
    assert (rights[1, :2] == rights[3, :2]).all() and (rights[1, :2] == rights[2, :2]).all() and rights[1, 2] == rights[3, 2] != rights[2, 2]
