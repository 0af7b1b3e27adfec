"""Quality classifier: document evidence combined with site posteriors (hierarchical empirical Bayes).

1. Document evidence: a logistic model on character-class and repetition
   features of the whole text, fitted on labelled rows (at most
   ``max_labelled``, the smallest by hash of doc_id; a documented bound).
2. Sites: grouped aggregation of every document's probability per host and per
   path within the host. A host's rate is shrunk toward the global rate, a
   path's toward its host's; how strongly follows from the spread between
   hosts (paths) beyond what sampling explains (method of moments), so sparse
   sites lean on their prior and large ones on their own documents.
3. A document's log odds are its evidence (model log odds less the training
   prior's) plus the log odds of its path's posterior rate; it is kept from
   ``threshold`` on.

Scale: one pass over the texts yields a small feature row per document; host and
path sums are partially aggregated before their shuffle, so a host with a third
of all rows is a few rows per task. The driver sees the bounded sample and a
few sums.

Cases: null or empty text has features of the empty text; null host or path is
a site named by the empty string; a null doc_id has no label but is scored;
null labels are left out, repeated ones count each; without labels of both
kinds the evidence is 0; repeated rows are scored each; an empty table gives an
empty result; further columns are ignored (``keep`` carries them through).
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, text_of, written

SLICE_BYTES = 1 << 20
CLASSES = ["other", "lower", "upper", "digit", "blank", "newline", "stop", "exclamation", "bar", "symbol", "wide"]
#: Byte classes; bytes from 128 on belong to letters outside ASCII here.
CLASS_OF = np.zeros(256, np.uint8)
for _name, _bytes in (
    ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t"), ("newline", b"\n\r"),
    ("stop", b".,;:?'\"()-"), ("exclamation", b"!"), ("bar", b"|"), ("symbol", b"#$%&*+/<=>@[\\]^_`{}~"), ("wide", range(128, 256)),
):
    CLASS_OF[list(_bytes)] = CLASSES.index(_name)
N_FEATURES = len(CLASSES) + 5


def features_of(texts: list[str]) -> np.ndarray:
    """A row of N_FEATURES numbers per text."""
    out = np.zeros((len(texts), N_FEATURES))
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw])
    at = 0
    while at < len(raw):  # so many texts at a time that the byte arrays stay small
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), SLICE_BYTES)))
        data = CLASS_OF[np.frombuffer(b"".join(raw[at:upto]), np.uint8)]
        n, k = upto - at, len(CLASSES)
        owner = np.repeat(np.arange(n, dtype=np.int64) * k, sizes[at:upto])
        counts = np.bincount(owner + data, minlength=n * k)[: n * k].reshape(n, k)
        out[at:upto, :k] = np.sqrt(counts / np.maximum(1, sizes[at:upto, None]))
        at = upto
    k = len(CLASSES)
    for i, text in enumerate(texts):
        words, lines = text.split(), text.split("\n")
        letters = sum(map(len, words))
        out[i, k:] = (
            np.log1p(len(words)), letters / max(1, len(words)) / 10, len(set(words)) / max(1, len(words)),
            len(set(lines)) / len(lines), sum(map(str.isupper, words)) / max(1, len(words)),
        )
    return out


@dataclasses.dataclass(frozen=True)
class Linear:
    """A logistic model on standardised features; log odds relative to the prior's."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(np.c_[z, np.ones(len(z))] @ self.weights - self.prior, -20, 20)


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Linear:
    """Newton's method with a ridge; no evidence where a class has no example."""
    if not len(y) or y.min() == y.max():
        return Linear(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]
    w = np.zeros(z.shape[1])
    penalty = np.r_[np.full(z.shape[1] - 1, ridge), 1e-6]
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return Linear(mean, scale, w, float(np.log(y.mean() / (1 - y.mean()))))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(sites: DataFrame, rate: Column, prior: Column) -> float:
    """Prior weight in documents: a site's rate varies between sites by what is
    left of the weighted spread around the prior after sampling variance."""
    r = sites.agg(
        F.sum(F.col("n") * (rate - prior) ** 2).alias("spread"), F.sum(prior * (1 - prior)).alias("noise"),
        F.sum("n").alias("n"), F.avg(prior * (1 - prior)).alias("v"),
    ).first()
    if not r["n"]:
        return 1.0
    between = max((r["spread"] - r["noise"]) / r["n"], 1e-6)
    return float(min(max(r["v"] / between - 1, 1.0), 1e4))


@dataclasses.dataclass
class Quality:
    """A fitted classifier: the linear model and the path posteriors."""

    linear: Linear
    sites: DataFrame
    features: DataFrame
    max_broadcast_bytes: int = 32 << 20

    def score(self, evidence: DataFrame) -> DataFrame:
        """Adds site_probability and probability to rows with host, path, evidence.

        The posteriors are broadcast if they are counted to be small, so that
        the rows (and the texts they may carry) stay where they are; beyond
        that they are joined by site.
        """
        sites = self.sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "site_probability")
        held = sites.agg(F.sum(F.octet_length("_host") + F.octet_length("_path") + 64)).first()[0] or 0
        if held <= self.max_broadcast_bytes:
            sites = F.broadcast(sites)
        out = evidence.join(sites, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
        return out.drop("_host", "_path").withColumn(
            "probability", _sigmoid(F.col("evidence") + _logit(F.col("site_probability")))
        )


def _site(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def _with_evidence(df: DataFrame, linear: Linear) -> DataFrame:
    def run(batches):
        for b in batches:
            x = b.column("features").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, N_FEATURES)
            columns = [b.column(k) for k in ("doc_id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(linear.evidence(x))], names=["doc_id", "host", "path", "evidence"])

    return df.select("doc_id", "host", "path", "features").mapInArrow(run, "doc_id long, host string, path string, evidence double")


def fit(docs: DataFrame, labels: DataFrame, host="source", path="lang", max_labelled: int = 20_000) -> Quality:
    def run(batches):
        for b in small(batches):
            x = features_of(b.column(3).to_pylist())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), lists], names=["doc_id", "host", "path", "features"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _site(host).alias("host"), _site(path).alias("path"), text_of())
    features = written(rows.mapInArrow(run, "doc_id long, host string, path string, features array<double>"), "features")
    known = labels.filter("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    sample = features.select("doc_id", "features").join(known, "doc_id")
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_labelled).select("features", "y").toArrow()
    x = sample.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(sample.num_rows, N_FEATURES)
    linear = fit_linear(x, (sample.column("y").to_numpy() > 0.5).astype(float))
    share = 1 / (1 + np.exp(-linear.prior))
    p = _sigmoid(F.col("evidence") + F.lit(float(np.log(share / (1 - share)))))
    paths = written(
        _with_evidence(features, linear).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p).alias("s")), "paths"
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = min(max((total["s"] or 0.0) / (total["n"] or 1), 1e-4), 1 - 1e-4) if total["n"] else 0.5
    a = _strength(hosts, F.col("s") / F.col("n"), F.lit(rate))
    hosts = hosts.select("host", ((F.col("s") + a * rate) / (F.col("n") + a)).alias("host_probability"))
    sites = paths.join(hosts, "host")
    b = _strength(sites, F.col("s") / F.col("n"), F.col("host_probability"))
    sites = sites.select(
        "host", "path", "n", "host_probability",
        F.least(F.greatest((F.col("s") + b * F.col("host_probability")) / (F.col("n") + b), F.lit(1e-4)), F.lit(1 - 1e-4)).alias("site_probability"),
    )
    return Quality(linear, written(sites, "sites"), features)


def classify(docs: DataFrame, labels: DataFrame, host="source", path="lang", threshold: float = 0.5, **kw) -> DataFrame:
    """(doc_id, host, path, evidence, site_probability, probability, kept) per document."""
    model = fit(docs, labels, host, path, **kw)
    return model.score(_with_evidence(model.features, model.linear)).withColumn("kept", F.col("probability") >= threshold)


def keep(docs: DataFrame, labels: DataFrame, host="source", path="lang", threshold: float = 0.5, **kw) -> DataFrame:
    """The documents that ``classify`` keeps, with all their columns.

    Decides row by row in a second pass over the texts instead of joining
    decisions back, so that texts are not shuffled.
    """
    model = fit(docs, labels, host, path, **kw)
    linear = model.linear
    fields = docs.schema.fields
    at = docs.columns.index("text")
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(fields)) + ", host string, path string, evidence double"

    def run(batches):
        for b in small(batches):
            texts = [t or "" for t in b.column(at).to_pylist()]
            e = linear.evidence(features_of(texts))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(e)], names=[*b.schema.names, "evidence"])

    rows = docs.select(*[docs[f"`{f.name}`"].alias(f"c{k}") for k, f in enumerate(fields)], _site(host).alias("host"), _site(path).alias("path"))
    scored = model.score(rows.mapInArrow(run, schema)).filter(F.col("probability") >= threshold)
    return scored.select(*[F.col(f"c{k}").alias(f.name) for k, f in enumerate(fields)])
