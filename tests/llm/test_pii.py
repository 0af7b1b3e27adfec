import hashlib
import random
import re

import numpy as np
from cohortlift.llm import pii

PATTERN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    found = []
    for kind, p in enumerate(PATTERN):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and max(int(x) for x in m.group().split(".")) > 255:
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_are_the_patterns(spark):
    rng = random.Random(4)
    bits = ["a", "b.c", "@", "@x.de", ".", "-", "+", " ", "1", "25", "255", "256", "007", "(", ")", "4111111111111111", "é", "%", "1.2.3.4", "+1 (988) 555-2485"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == brute(text), text


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "+" + "(" * 300_000, "1 " * 150_000):
        pii.base_spans(text)
        pii.loose_spans(text, [])


def test_reliabilities_recover_the_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.4
    right = np.array([0.9, 0.8, 0.7, 0.6])
    vote = np.where(rng.random((20_000, 4)) < right, 1, -1) * np.where(truth, 1, -1)[:, None]
    pattern, inverse, count = np.unique(vote, axis=0, return_inverse=True, return_counts=True)
    p, rate, share = pii.reliabilities(pattern, count.astype(float))
    assert abs(share - 0.4) < 0.05 and np.abs(rate[1, :, 2] - right).max() < 0.06
    assert ((p[inverse.ravel()] > 0.5) == truth).mean() > 0.88


def texts():
    rng = random.Random(2)
    out = [f"please call me on phone {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)} today" for _ in range(60)]
    out += [f"serial order part {rng.randrange(100, 199)}.{rng.randrange(100, 199)}.{rng.randrange(1000, 9999)}x" for _ in range(60)]
    out += [f"write to name{k} [at] host{k} [dot] com now" for k in range(40)] + [f"mail name{k}@host.com" for k in range(40)]
    out += [f"call phone +1 (988) 555-{1000 + k}" for k in range(40)] + [f"card 4111 1111 1111 1111 and 192.0.2.{k}" for k in range(20)]
    return out


def test_method_adds_spans_and_keeps_base(spark, docs_of):
    rows = {r["doc_id"]: r for r in pii.digest(pii.find(docs_of(texts()))).collect()}
    for k, text in enumerate(texts()):
        base = brute(text)
        name = ",".join(f"{pii.KINDS[kind]}:{a}:{b}" for a, kind, b in base)
        r = rows[k]
        assert r["base_sha256"] == hashlib.sha256(name.encode()).hexdigest()
        assert [r[f"n_{n}"] for n in pii.KINDS] == [sum(x == j for _, x, _ in base) for j in range(4)]
        assert set(filter(None, name.split(","))) <= set(r["spans"].split(","))
    assert sum(rows[k]["spans"].startswith("phone") for k in range(60)) > 50
    assert sum("email" in rows[k]["spans"] for k in range(120, 160)) > 30


def test_null_empty_repeated(spark, docs_of):
    rows = pii.digest(pii.find(docs_of([None, "", "a@b.c", "a@b.c"], ids=[None, 1, 2, 2]))).collect()
    assert sorted((str(r["doc_id"]), r["n_email"], r["spans"]) for r in rows) == [("1", 0, ""), ("2", 1, "email:0:5"), ("2", 1, "email:0:5"), ("None", 0, "")]
    assert pii.digest(pii.find(docs_of([]))).collect() == []
