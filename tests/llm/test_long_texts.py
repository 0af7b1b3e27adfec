"""Texts longer than the slices in which the operators work (about 1 MB): results at their ends as elsewhere."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlift.llm import decontam, licenses, line_dedup, ngram_join, packing, pii, quality, suffix
from test_packing import PATH, reference_ids

PASSAGE = " ".join(f"passage{k}" for k in range(40))
LINE = "this very line stands in both documents, once at the end of the long one"
NOTICE = "Licensed under the Apache License, Version 2.0."


@pytest.fixture(scope="module")
def long_docs(spark):
    """0: over 1 MB, all marks at its end; 1: 0 with one word changed; 2: short, with the marks."""
    rng = random.Random(12)
    lines = [" ".join(f"w{rng.randrange(10**7)}" for _ in range(20)) for _ in range(7000)]
    end = [LINE, f"x {PASSAGE} y", "mail me@example.org", NOTICE]
    near = [*lines[:50], "changed", *lines[51:], *end]
    texts = ["\n".join([*lines, *end]), "\n".join(near), "\n".join(["short", *end])]
    assert len(texts[0]) > 1_100_000
    rows = [(k, t, "en", f"dir{k}", len(t)) for k, t in enumerate(texts)]
    return texts, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_packing(long_docs):
    texts, docs = long_docs
    pieces = packing.tokenize(docs, PATH).collect()
    for k, text in enumerate(texts):
        own = sorted((r["piece"], r["ids"]) for r in pieces if r["doc_id"] == k)
        assert np.frombuffer(b"".join(i for _, i in own), "<u4").tolist() == reference_ids(text)


def test_suffix(long_docs, docs_of):
    texts, _ = long_docs
    rng = random.Random(3)
    other = " ".join(f"v{rng.randrange(10**7)}" for _ in range(140_000))
    rows = {r["doc_id"]: r for r in suffix.remove_repeats_digest(docs_of([other + "#" + PASSAGE, "!" + PASSAGE, other[:-1000] + "?"])).collect()}
    assert rows[1]["n_removed"] == len(PASSAGE) and rows[0]["n_removed"] == len(other) - 1000 + len(PASSAGE)
    assert rows[2]["n_removed"] == len(other) - 1000 and [rows[k]["n_spans"] for k in range(3)] == [2, 1, 1]


def test_ngram_join(long_docs):
    _, docs = long_docs
    assert [tuple(r)[:3] for r in ngram_join.join(docs).orderBy("doc_id").collect()] == [(0, 1, 0), (1, 1, 0), (2, 0, 2)]


def test_lines(long_docs):
    texts, docs = long_docs
    rows = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    assert rows[0]["n_removed"] == 0 and rows[1]["text"] == "changed" and rows[2]["text"] == "short"


def test_pii(long_docs):
    texts, docs = long_docs
    rows = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    assert [rows[k]["n_email"] for k in range(3)] == [1, 1, 1]
    assert f"email:{texts[0].index('me@')}:" in rows[0]["spans"]


def test_quality(spark, long_docs):
    texts, docs = long_docs
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 3 and {r["text"] for r in quality.keep(docs, labels).collect()} <= set(texts)
    x = quality.features_of([texts[0], texts[0][:500_000]])
    assert np.isfinite(x).all()


def test_licence(long_docs):
    _, docs = long_docs
    rows = {r["doc_id"]: r["license"] for r in licenses.scan(docs, F.col("source")).collect()}
    assert rows == {0: "Apache-2.0", 1: "Apache-2.0", 2: "Apache-2.0"}


def test_decontamination(spark, long_docs):
    _, docs = long_docs
    bench = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.overlaps(docs, bench).collect()) == [(0, 7), (1, 7), (2, 7)]
    assert decontam.remove_contaminated(docs, bench).count() == 0
