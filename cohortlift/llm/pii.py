"""Personal data by weak supervision: emails, IP addresses, payment cards, phone numbers.

Candidates are the matches of four base patterns and of looser ones (written-out
emails, dotted card numbers, phone numbers without +, IPv6). Four labelers vote
for (1), against (-1) or abstain (0) on each: its pattern, a gazetteer (endings,
address blocks, issuer prefixes, country codes), the words before it, and its
borders. Expectation maximisation over all candidates estimates each labeler's
reliabilities (per kind, how often it votes so on true and on false spans) and
every vote pattern's probability; a logistic span classifier is trained on
those probabilities, from the votes and a few features, and decides on the
candidates. Base matches always stay.

Scale: one pass over the texts; all candidates' votes and features are counted by
Spark, and as all are coarse, the counts are a bounded table (some thousand rows
at most), on which the driver estimates and trains. Matching is linear in the
text, also in long runs without blanks.

Cases: null text is empty and has no spans; null doc_id is reported as such; rows
are reported each, repeated ones too; an empty table gives an empty result;
further columns are ignored. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

KINDS = ["email", "ip", "card", "phone"]
LABELERS = ["pattern", "gazetteer", "context", "border"]
SPAN = "struct<start:int,kind:int,end:int,base:boolean,pattern:int,gazetteer:int,context:int,border:int,size:int,digits:int>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # no other start in a run of digits can match
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
LOOSE_CARD = re.compile(r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){2,3}(?![0-9])")
LOOSE_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
#: Gazetteers and context words.
ENDINGS = set("com org net edu gov mil int info biz io dev app de fr es it nl uk eu us ca au jp cn in br ch at be se no fi dk pl pt ru".split())
ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38")
COUNTRY_CODES = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69]\d|3[578]\d|42\d|5[09]\d|6[789]\d|8[058]\d|9[679]\d")
NEAR = [
    set("mail email e-mail contact write mailto reach".split()), set("ip address server host node ping from".split()),
    set("card visa mastercard amex credit debit payment pay number".split()), set("phone call tel telephone fax mobile cell dial ring".split()),
]
AGAINST = set("version v release build isbn issn order page pages figure section serial id sku part model".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part, @ and a host with a dot; a local part
    holds no @, so each @ is tried once, with all that may stand before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (host := HOST.match(text, at + 1)):
            done = host.end()
            yield start, done
            at = text.find("@", done)
        else:
            done = max(done, at + 1)
            at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _only(chars: str) -> str:
    return re.sub("[^0-9]", "", chars)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches that pass their checks."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in CARD.finditer(text):
            if 12 <= len(m.group()) <= 37 and 12 <= len(d := _only(m.group())) <= 19 and luhn(d):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_only(m.group())) <= 15]
    return sorted(found)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches of the looser patterns that touch no base span, nor each other."""
    found = []
    if re.search(r"[\[(]at[\])]", text, re.I):
        found += [(m.start(), 0, m.end()) for m in LOOSE_EMAIL.finditer(text)]
    if text.count(":") >= 7:
        found += [(m.start(), 1, m.end()) for m in LOOSE_IP.finditer(text)]
    if DIGIT.search(text):
        found += [(m.start(), 2, m.end()) for m in LOOSE_CARD.finditer(text) if luhn(_only(m.group()))]
        found += [(m.start(), 3, m.end()) for m in LOOSE_PHONE.finditer(text)]
    taken = sorted((a, b) for a, _, b in base)
    out, last, k = [], 0, 0
    for a, kind, b in sorted(found):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        # base spans of different kinds may overlap, so look at a few from here on
        if a >= last and not any(x < b and a < y for x, y in taken[max(0, k - 4) : k + 4]):
            out.append((a, kind, b))
            last = b
    return out


def votes(text: str, start: int, kind: int, end: int, base: bool) -> tuple[int, int, int, int]:
    span = text[start:end]
    digits = _only(span)
    if kind == 0:
        known = re.split(r"[.\])\s]", span.lower())[-1] in ENDINGS
    elif kind == 1:
        known = ":" in span or 1 <= int(span.split(".")[0].lstrip("0") or 0) <= 223 and not re.match("127|10|192\\.168|169\\.254", span)
    elif kind == 2:
        known = bool(ISSUER.match(digits))
    else:
        known = bool(COUNTRY_CODES.match(digits)) if span[0] == "+" else digits[0] not in "01" and digits[3] not in "01"
    before = re.findall(r"[\w-]+", text[max(0, start - 60) : start].lower())[-4:]
    context = 1 if NEAR[kind].intersection(before) else -1 if AGAINST.intersection(before[-2:]) else 0
    left, right = text[start - 1 : start] if start else " ", text[end : end + 1] or " "
    border = 1 if not (left.isalnum() or right.isalnum()) and left not in "=_#/" else -1
    return 1 if base else 0, 1 if known else -1, context, border


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) with each candidate's votes and features."""
    names = [x.split(":")[0] for x in SPAN[7:-1].split(",")]

    def run(batches):
        for b in batches:
            flat, counts = [], []
            for text in b.column(1).to_pylist():
                base = base_spans(text)
                both = [(*s, True) for s in base] + [(*s, False) for s in loose_spans(text, base)]
                for start, kind, end, is_base in both:
                    size = min(7, (end - start) // 4)
                    digits = min(4, 5 * len(_only(text[start:end])) // (end - start))
                    flat.append((start, kind, end, is_base, *votes(text, start, kind, end, is_base), size, digits))
                counts.append(len(both))
            columns = list(zip(*flat, strict=True)) or [[]] * len(names)
            types = [pa.bool_() if n == "base" else pa.int32() for n in names]
            values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), text_of()).mapInArrow(run, f"doc_id long, spans array<{SPAN}>")


def reliabilities(vote: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation maximisation over vote patterns (rows of -1, 0, 1) with counts.

    Returns each pattern's probability of being true; per truth, labeler and
    vote the estimated rate; the share of true spans. Starts from the majority
    and smooths by one vote, so that a labeler that rarely votes is not trusted
    for it.
    """
    n, m = vote.shape
    p = np.clip(0.5 + 0.2 * vote.sum(1), 0.05, 0.95)
    rate, share = np.zeros((2, m, 3)), 0.5
    for _ in range(rounds):
        both = np.stack([1 - p, p]) * weight
        for k in range(3):
            rate[:, :, k] = (both @ (vote == k - 1)) + 1
        rate /= rate.sum(2, keepdims=True)
        share = (both[1].sum() + 1) / (weight.sum() + 2)
        log = np.log(rate)[:, np.arange(m), vote + 1].sum(2) + np.log([1 - share, share])[:, None]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -30, 30)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p, rate, share


def _design(kind, vote, size, digits) -> np.ndarray:
    """One column per kind, labeler and vote; and per kind for size and digits."""
    onehot = lambda x, n: np.eye(n)[x]
    own = np.concatenate([onehot(vote[:, k] + 1, 3) for k in range(vote.shape[1])] + [size[:, None] / 7, digits[:, None] / 4, np.ones((len(kind), 1))], 1)
    return (onehot(kind, len(KINDS))[:, :, None] * own[:, None]).reshape(len(kind), len(KINDS) * own.shape[1])


def train(x: np.ndarray, p: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights for soft labels p, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (q - p)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def find(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(doc_id, spans): an array of (start, kind, end, base), sorted, of the
    base matches and the candidates that the classifier takes."""
    found = written(candidates(docs), "pii")
    features = ["kind", *LABELERS, "size", "digits"]
    span = found.select(F.explode("spans").alias("s"))
    table = span.groupBy(*[F.col(f"s.{c}").alias(c) for c in features]).count().orderBy(*features).toArrow()
    column = {c: table.column(c).to_numpy().astype(np.int64) for c in [*features, "count"]}
    kind, vote = column["kind"], np.stack([column[c] for c in LABELERS], 1)
    p = np.zeros(len(kind))
    for k in range(len(KINDS)):
        if (own := kind == k).any():
            p[own] = reliabilities(vote[own], column["count"][own])[0]
    x = _design(kind, vote, column["size"], column["digits"])
    w = train(x, p, column["count"].astype(float)) if len(kind) else np.zeros(0)
    yes = (1 / (1 + np.exp(-(x @ w)))) >= threshold if len(kind) else np.zeros(0, bool)
    taken = [F.lit("-".join(str(column[c][i]) for c in features)) for i in np.flatnonzero(yes & (column["pattern"] == 0))]
    taken = F.array(*taken) if taken else F.array().cast("array<string>")

    def stays(s):
        return s["base"] | F.array_contains(taken, F.concat_ws("-", *[s[c] for c in features]))

    kept = F.transform(F.filter("spans", stays), lambda s: F.struct(*[s[c].alias(c) for c in ("start", "kind", "end", "base")]))
    return found.select("doc_id", F.array_sort(kept).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans as text."""
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{n}") for k, n in enumerate(KINDS)],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
