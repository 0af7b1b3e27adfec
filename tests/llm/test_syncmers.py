"""Syncmer fingerprints against the same selection in plain Python."""

import hashlib
import random

import regex
import xxhash

from cohortlift.llm import syncmers
from cohortlift.llm.queries import QUERIES
from cohortlift.llm.syncmers import INNER, K, S

SMALL = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hashed(values):
    h = 42
    for v in values:
        h = xxhash.xxh64(v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True), seed=h & (1 << 64) - 1).intdigest()
    return signed(h)


def short(h):
    return f"{(h & (1 << 64) - 1) >> 40:06X}"


def fingerprint(text):
    words = [hashed([w]) for w in regex.findall(syncmers.WORD, text.lower())]
    inner = [hashed(words[i : i + S]) for i in range(len(words) - S + 1)]
    places = [i for i in range(len(words) - K + 1) if min(inner[i : i + INNER]) in (inner[i], inner[i + INNER - 1])]
    if places:
        return " ".join(f"{i - p}{short(hashed(words[i : i + K]))}" for i, p in zip(places, [0, *places], strict=False))
    return "0" + short(hashed(words) if words else hashed([text])) if text else ""


def likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = set(a.split()), set(b.split())
    return len(a & b) * 2 / (len(a) + len(b))


def expected(rows):
    """rows: (doc_id, text), each with the next one by doc_id (nulls first), then by hash of the text."""
    rows = [(d, t or "") for d, t in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}:{r[1]}".encode()).hexdigest())
    rows.sort(key=key)
    out = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        fp, other = fingerprint(text), fingerprint(edited)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), sha, fp, other, likeness(fp, other), likeness(fp, fingerprint(after))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = rows_of(QUERIES["op12_document_fingerprints"](spark, SMALL))
    assert found == expected([tuple(d) for d in docs])
    long = [r for r in found if r[1] >= 1000]
    # texts of repeated lines have few different anchors
    middle = lambda k: sorted(r[k] for r in long)[len(long) // 2]
    assert middle(5) > 0.65 and middle(6) < 0.05 and min(r[5] for r in long) > 0.3


def test_cases_against_brute_force(spark, docs_of):
    rng = random.Random(4)
    words = "alpha beta gamma Δelta éa 12 x".split()
    texts = [None, "", "...", "one", "ünï 𝒳 code", "a" * 500, " ".join(rng.choices(words, k=60_000)), "two words", " ".join(rng.choices(words, k=30))]
    texts += [" ".join(rng.choices(words, k=n)) for n in (7, 8, 9, 13, 14, 40)]
    texts += ["same text"] * 5 + ["other", "other"]
    ids = [None, None, 0, 1, 2, 3, 4, 5, 5, *range(20, 26), 7, 7, 7, 7, 7, 8, -3]
    assert rows_of(syncmers.report(docs_of(texts, ids=ids))) == expected(list(zip(ids, texts, strict=True)))


def test_empty_single_and_one_repeated(spark, docs_of):
    assert rows_of(syncmers.report(docs_of(["x"]).limit(0))) == []
    for texts in (["lone text of a few words"], ["again"] * 3):
        ids = [1] * len(texts)
        assert rows_of(syncmers.report(docs_of(texts, ids=ids))) == expected(list(zip(ids, texts, strict=True)))


def test_anchors_are_dense_and_free_of_context():
    rng = random.Random(1)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    a, b = (fingerprint(" ".join([f"{c}{k}" for k in range(50)] + passage + [c] * 9)).split() for c in "xy")
    steps = [int(x[0]) for x in a]
    assert max(steps) <= K - S
    assert len(set(a) & set(b)) >= 0.95 * len(fingerprint(" ".join(passage)).split())


def test_plan_has_no_python_and_moves_texts_once(spark):
    df = QUERIES["op12_document_fingerprints"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan
