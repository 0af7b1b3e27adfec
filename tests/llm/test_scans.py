"""Line dedup, quality, licences and decontamination against brute force."""

import itertools
import random

import numpy as np
import pytest
from cohortlift.llm import decontam, licenses, line_dedup, quality
from pyspark.sql import functions as F


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# line dedup


def edited(rng, line, n):
    for _ in range(n):
        at = rng.randrange(len(line) + 1)
        line = rng.choice([line[:at] + "é" + line[at:], line[:at] + line[at + 1 :], line[:at] + "x" + line[at + 1 :]])
    return line


def lines_brute(texts, edits=2, min_chars=10, min_near=30):
    seen, out = [], []
    for t in texts:
        kept = []
        for line in (t or "").split("\n"):
            gone = len(line) >= min_chars and any(
                s == line or (min(len(s), len(line)) >= min_near and abs(len(s) - len(line)) <= edits and distance(s, line) <= edits) for s in seen
            )
            if not gone:
                kept.append(line)
            seen.append(line)
        out.append("\n".join(kept))
    return out


def test_lines_against_brute_force(spark, docs_of):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(1, 60))) for _ in range(25)]
    texts = ["\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(6))) for _ in range(60)]
    for big in (10**6, 0):
        rows = line_dedup.report(docs_of(texts), max_broadcast=big).orderBy("doc_id").collect()
        assert [r["text"] for r in rows] == lines_brute(texts)
    assert all(r["n_lines"] == len(t.split("\n")) for r, t in zip(rows, texts))


def test_edit_distance_is_exact_up_to_the_band(spark):
    rng = random.Random(3)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 10)))
        pairs.append((a, edited(rng, a, rng.randrange(5))))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.characters(F.col("a")).alias("x"), line_dedup.characters(F.col("b")).alias("y"))
    for edits in (1, 2, 3):
        for r in df.select("a", "b", line_dedup.edit_distance(F.col("x"), F.col("y"), edits).alias("d")).collect():
            assert r["d"] == min(distance(r["a"], r["b"]), edits + 1)


@pytest.mark.parametrize("edits", [1, 2])
def test_segments_meet(spark, edits):
    rng = random.Random(11)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(8, 20)))
        b = edited(rng, a, edits)
        pairs.append((a, b) if len(a) <= len(b) else (b, a))
    df = spark.createDataFrame([p for p in pairs if distance(*p) <= edits], "a string, b string")
    index, probe = line_dedup.index_keys(F.col("a"), F.length("a"), edits), line_dedup.probe_keys(F.col("b"), F.length("b"), edits)
    met = F.arrays_overlap(F.array(*index), F.array(*probe))
    assert df.filter(~line_dedup.letters_close(line_dedup.letter_counts(F.col("a")), line_dedup.letter_counts(F.col("b")), edits)).count() == 0
    assert df.filter(~met).count() == 0


def test_lines_cases(spark, docs_of):
    line = "a line of more than thirty characters"
    df = docs_of([line, line, None, "", line, line + "\nshort"], ids=[2, 1, 3, 4, None, 1])
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns
    rows = sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect())
    # rows of doc 1 are one document, whose first line is first; without an id nothing is compared
    assert rows == [("1", line), ("1", line + "\nshort"), ("2", ""), ("3", "None"), ("4", ""), ("None", line)]
    assert line_dedup.dedup_lines(docs_of([])).collect() == []
    assert line_dedup.report(docs_of([])).collect() == []


def test_lines_hot(spark, docs_of):
    line = "the same boilerplate line in very many of the documents here"
    texts = [f"{line}\nown text number {k * 7919} of this document {k * 104729}" for k in range(200)]
    assert [r["text"] for r in line_dedup.report(docs_of(texts)).orderBy("doc_id").collect()] == lines_brute(texts)


# quality


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    rows = quality.classify(docs, train).join(test, "doc_id").select("kept", "quality").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in rows]) > 0.97
    kept = quality.keep(docs, train)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in quality.classify(docs, train).filter("kept").select("doc_id").collect()}


def quality_brute(docs, labels, threshold=0.5):
    """{doc_id: (evidence, site probability, probability, kept)}: the method in plain numpy and dictionaries.

    docs: (doc_id, host, path, text); labels: {doc_id: quality}.
    """
    x = {d: quality.features_of([t])[0] for d, _, _, t in docs}
    known = sorted(set(labels) & set(x))
    rows, y = np.array([x[d] for d in known]), np.array([float(labels[d]) for d in known])
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale <= 1e-9] = 1
    design = lambda r: np.hstack([np.clip((r - mean) / scale, -8, 8), np.ones((len(r), 1))])
    z, w = design(rows), np.zeros(rows.shape[1] + 1)
    ridge = np.full(len(w), 1.0)
    ridge[-1] = 1e-6
    for _ in range(60):  # Newton's steps on the penalised likelihood
        p = 1 / (1 + np.exp(-z @ w))
        w += np.linalg.solve(z.T * (p * (1 - p)) @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
    prior = np.log(y.mean() / (1 - y.mean()))
    evidence = {d: float(np.clip(design(x[d][None])[0] @ w - prior, -20, 20)) for d in x}
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    paths, hosts = {}, {}
    for d, host, path, _ in docs:
        for table, key in ((paths, (host, path)), (hosts, host)):
            n, total = table.get(key, (0, 0.0))
            table[key] = n + 1, total + sigmoid(evidence[d] + prior)
    rate = np.clip(sum(t for _, t in hosts.values()) / len(docs), 1e-4, 1 - 1e-4)

    def strength(table, around):
        n = sum(k for k, _ in table.values())
        spread = sum(k * (t / k - around[key]) ** 2 for key, (k, t) in table.items())
        noise = [around[key] * (1 - around[key]) for key in table]
        return min(max(np.mean(noise) / max((spread - sum(noise)) / n, 1e-6) - 1, 1), 1e4)

    a = strength(hosts, dict.fromkeys(hosts, rate))
    above = {h: (t + a * rate) / (k + a) for h, (k, t) in hosts.items()}
    b = strength(paths, {key: above[key[0]] for key in paths})
    site = {key: np.clip((t + b * above[key[0]]) / (k + b), 1e-4, 1 - 1e-4) for key, (k, t) in paths.items()}
    out = {}
    for d, host, path, _ in docs:
        q = site[host, path]
        p = sigmoid(evidence[d] + np.log(q / (1 - q)))
        out[d] = evidence[d], q, p, p >= threshold
    return out


def test_quality_query_against_brute_force(spark):
    from cohortlift.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.source or "", r.lang or "", r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    want = quality_brute(docs, labels)
    rows = QUERIES["op8_quality_classifier"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(want) and len(rows) == len(docs)
    for r in rows:
        assert np.allclose((r.evidence, r.site_probability, r.probability), want[r.doc_id][:3], atol=1e-5)
        assert r.kept == want[r.doc_id][3] or abs(r.probability - 0.5) < 1e-4


def test_sparse_sites_lean_on_the_prior(spark, docs_of):
    good, bad = "A calm sentence with some words in it.", "$$$ ### !!! *** &&&"
    a = docs_of([good] * 80 + [bad] * 80, source="mixed")
    b = docs_of([bad] * 60, source="bad", ids=[1000 + k for k in range(60)])
    c = docs_of([good], source="tiny", ids=[5000])
    docs = a.union(b).union(c)
    labels = spark.createDataFrame([(k, int(k < 80), 0) for k in range(160)], "doc_id long, quality int, toxic int")
    p = {r["host"]: r["site_probability"] for r in quality.classify(docs, labels).select("host", "site_probability").distinct().collect()}
    assert p["bad"] < 0.1 and 0.4 < p["mixed"] < 0.6 and p["bad"] < p["tiny"] < 0.95


def test_quality_cases(spark, docs_of):
    df = docs_of([None, "", "x", "x"], source=None, lang=None, ids=[None, 1, 2, 2])
    none = spark.createDataFrame([(1, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(df, none).collect()
    assert len(rows) == 4 and all(r["kept"] and r["evidence"] == 0 for r in rows)
    assert quality.keep(df, none).count() == 4
    assert quality.classify(docs_of([]), none).collect() == [] and quality.keep(docs_of([]), none).collect() == []
    clash = df.withColumn("host", F.lit(1)).withColumn("evidence", F.lit("e")).withColumn("probability", F.lit(None))
    assert quality.keep(clash, none).columns == clash.columns
    # texts stay where they are, also where nothing is broadcast by estimates
    plan = quality.keep(df, none)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


# licences


def licence_rows(spark, rows):
    df = spark.createDataFrame([(k, t, d, "x") for k, (d, t) in enumerate(rows)], "doc_id long, text string, dir string, license string")
    return {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan(df, F.col("dir")).collect()}


def test_licences_and_inheritance(spark):
    prose = "some plain words without any further meaning " * 5
    got = licence_rows(spark, [
        ("a/b", f"{prose}\nLicensed under the Apache License, Version 2.0.\n{prose}"),
        ("a", "Released under the MIT License."),
        ("a/b/c", prose), ("a/b", prose), ("z", prose), ("a", prose), (None, "x"), ("a/b/c/d", None),
        ("a/b/c", "This work is licensed under the GNU General Public License, version 3."),
        ("ab", prose), ("/a//b/", prose),
    ])
    assert got == {
        0: ("Apache-2.0", "header"), 1: ("MIT", "file"), 2: ("GPL-3.0", "inherited"), 3: ("MIT", "inherited"), 4: (None, None),
        5: ("MIT", "inherited"), 6: (None, None), 7: ("GPL-3.0", "inherited"), 8: ("GPL-3.0", "file"), 9: (None, None), 10: ("MIT", "inherited"),
    }


def test_root_licence_and_templates(spark):
    rows = [("", "Licensed under CC BY-NC 4.0."), ("p/q", "words only"), (None, "more words")]
    assert licence_rows(spark, rows) == {0: ("CC-BY-NC-4.0", "file"), 1: ("CC-BY-NC-4.0", "inherited"), 2: ("CC-BY-NC-4.0", "inherited")}
    got = licence_rows(spark, [(f"d{k}", text) for k, (_, text) in enumerate(licenses.TEMPLATES)])
    assert [got[k][0] for k in range(len(licenses.TEMPLATES))] == [name for name, _ in licenses.TEMPLATES]
    assert licence_rows(spark, []) == {}


def test_whole_licence_files_are_inherited(spark):
    prose = "the reader of this file may use it for all the things that are said in the text of the file and in any other work " * 20
    texts = licenses.full_texts()
    assert {"Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "ISC", "MIT"} <= {name for name, _ in texts}
    rows = [("z", prose), ("", "Copyright")]
    for name, text in texts:
        cut = text[: text.index("How to Apply")] if "How to Apply" in text else text  # as projects leave it out, under their own name
        rows += [(f"p/{name}", "Copyright 2021 Some Company and others\n\n" + cut.replace("  ", " ")), (f"p/{name}/src", prose)]
    got = licence_rows(spark, rows)
    assert got[0] == got[1] == (None, None)
    for k, (name, _) in enumerate(texts):
        assert (got[2 + 2 * k], got[3 + 2 * k]) == ((name, "file"), (name, "inherited"))


# decontamination


def overlap_brute(texts, items):
    import re

    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for d, t in enumerate(texts):
        for i, b in enumerate(items):
            x, y = split(t), split(b)
            if len(y) < decontam.MIN_WORDS:
                continue
            w, s = decontam.tolerance(len(y))
            best = max((sum(p == q for p, q in zip(x[a : a + w], y[c : c + w])) for a in range(len(x) - w + 1) for c in range(len(y) - w + 1)), default=0)
            if best >= w - s:
                out[d, i] = best
    return out


def test_masks_are_lossless():
    for n in range(8, 17):
        w, s = decontam.tolerance(n)
        for gone in itertools.combinations(range(w), s):
            assert any({p + o for p in m}.isdisjoint(gone) for m in decontam.MASKS for o in range(w - m[-1]))
    assert decontam.tolerance(40) == (16, 3)


@pytest.mark.parametrize("max_seeds", [100_000, 40])
def test_overlaps_against_brute_force(spark, docs_of, max_seeds):
    rng = random.Random(13)
    word = lambda: rng.choice("ab") + str(rng.randrange(30))
    items = [[word() for _ in range(n)] for n in (4, 5, 6, 7, 8, 10, 12, 15, 16, 17, 25, 40)]
    texts = []
    for _ in range(60):
        b = list(rng.choice(items))
        a, c = sorted(rng.sample(range(len(b) + 1), 2))
        for _ in range(rng.randrange(5)):
            b[rng.randrange(len(b))] = word()
        pad = lambda: [word() for _ in range(rng.randrange(30))]
        texts.append(" ".join(pad() + (b if rng.random() < 0.7 else b[a:c]) + pad()))
    items = [" ".join(b) for b in items]
    texts += [items[8].upper().replace(" ", ", "), None, ""]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.overlaps(docs_of(texts), bench, max_seeds).collect()}
    want = overlap_brute(texts, items)
    assert got == want and len(want) > 20
    clean = decontam.remove_contaminated(docs_of(texts), bench)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_decontamination_cases(spark, docs_of):
    bench = spark.createDataFrame([(0, "one two three four five six seven eight nine"), (0, None), (None, "a b")], "item_id long, text string")
    df = docs_of(["x one two three four five six seven eight nine", "clean", "clean", None], ids=[None, 1, 1, 2])
    assert [tuple(r) for r in decontam.overlaps(df, bench).collect()] == [(None, 0, 9)]
    assert decontam.remove_contaminated(df, bench).columns == df.columns
    assert sorted(str(r["doc_id"]) for r in decontam.remove_contaminated(df, bench).collect()) == ["1", "1", "2"]
    # of rows without id, or of one id, only those go that overlap themselves
    item = "one two three four five six seven eight nine"
    mixed = docs_of([f"x {item}", "clean", item, "clean too", "clean too", f"{item} y"], ids=[None, None, 5, 5, 5, 6])
    left = decontam.remove_contaminated(mixed, bench).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == [("5", "clean too"), ("5", "clean too"), ("None", "clean")]
    assert decontam.overlaps(docs_of([]), bench).collect() == []
    assert decontam.overlaps(df, bench.filter("false")).collect() == []


def test_overlaps_at_the_ends_of_documents(spark, docs_of):
    item = [f"w{k}" for k in range(40)]
    pad = [f"x{k}" for k in range(30)]
    parts = [item[5:n] for n in (9, 10, 11, 12, 13, 17, 20)] + [item[-13:] + pad, pad + item[:13], item[:13] + pad, pad + item[20:32], pad + item[20:33] + pad]
    parts += [item[5:9] + ["y"], item[5:14] + ["y"], item[5:12] + ["y", "y"], ["y", *item[21:34], "y", "z"], item[3:15] + pad]
    parts += [pad + item[3:16], pad + item[30:], [*item[20:33], *pad], item + pad]
    short = [f"v{k}" for k in range(7)]
    parts += [short[:6], short[1:], pad + short, short[:6] + pad]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(short))], "item_id long, text string")

    def matched(x, y):
        w, s = decontam.tolerance(min(len(x), len(y)))
        best = max((sum(0 <= a + k < len(x) and x[a + k] == y[c + k] for k in range(w)) for a in range(-s, len(x) - w + s + 1) for c in range(len(y) - w + 1)), default=0)
        return best if min(len(x), len(y)) >= decontam.MIN_WORDS and best >= w - s else None

    want = {(d, i): m for d, x in enumerate(parts) for i, y in enumerate((item, short)) if (m := matched(x, y))}
    for max_seeds in (100_000, 40):
        got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontam.overlaps(docs_of([" ".join(x) for x in parts]), bench, max_seeds).collect()}
        assert got == want
    assert {k for k, _ in want} == {1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 15, 17, 19, 20, 21, 22, 23}
