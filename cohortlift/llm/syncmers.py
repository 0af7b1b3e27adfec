"""Document fingerprints by closed syncmers.

A text's words (lower case, runs of letters and digits, cut after 16) are its
letters. A k-mer of 8 words is an anchor if the least hash of its inner
2-word substrings lies at one of its edges. That depends on the k-mer alone,
so equal passages have equal anchors wherever they lie, and an edit changes
only the anchors over it. Consecutive anchors are at most 6 words apart. The
fingerprint is the list of anchors, each as its distance from the one before
(one digit) and 24 bits of its hash; likeness is the share of (distance, hash)
pairs that two fingerprints have in common (Dice), so anchors count where
they also lie alike. Only built-in functions are used.

Scale: the documents' order is found on ids, lengths and hashes. Texts are
shuffled once, by key; a document gives its first code points and fingerprint
to the document before it, whose key it learns from the order. Equal rows (doc_id
and text) are shuffled once and multiplied at the end, each followed by the next.
Nothing is broadcast but the number of rows before each range.

Cases: a null text is empty; an empty text has the empty fingerprint; a text
without anchor (few words) has one for all its words, or for its characters if
it has no word; equal fingerprints have likeness 1, two empty ones too; null
doc_ids come first; rows of one doc_id come by a hash of the text; repeated
rows follow one another; the only document is its own next; an empty table gives an
empty result; texts of any length are read whole; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written
from .order import ranked

K, S = 8, 2
INNER = K - S + 1
WORD = "[\\p{L}\\p{N}]{1,16}"


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _short(hashed: Column) -> Column:
    return F.lpad(F.hex(F.shiftrightunsigned(hashed, 40)), 6, "0")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (not null): anchors ``d`` + 6 hexadecimal digits, separated by spaces."""

    def anchors(words: Column, inner: Column) -> Column:
        edges = lambda i: F.least(F.get(inner, i), F.get(inner, i + F.lit(INNER - 1)))
        chosen = lambda i: edges(i) <= F.array_min(F.slice(inner, i + F.lit(2), F.lit(INNER - 2)))
        places = F.filter(F.sequence(F.lit(0), F.size(words) - F.lit(K)), chosen)
        return _let(places, lambda p: F.transform(p, lambda i, n: F.concat(
            F.when(n == 0, i).otherwise(i - F.get(p, n - F.lit(1))).cast("string"), _short(F.xxhash64(F.slice(words, i + F.lit(1), F.lit(K))))
        )))

    def of_words(words: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(words) - F.lit(S)), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + F.lit(1))))
        found = F.when(F.size(words) >= K, _let(inner, lambda m: anchors(words, m))).otherwise(F.expr("CAST(array() AS array<string>)"))
        whole = F.when(F.size(words) > 0, F.xxhash64(words)).when(text != "", F.xxhash64(text))
        return _let(found, lambda x: F.when(F.size(x) > 0, F.array_join(x, " ")).otherwise(F.coalesce(F.concat(F.lit("0"), _short(whole)), F.lit(""))))

    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def likeness(a: Column, b: Column) -> Column:
    """Share of the anchors, with their distances, that two fingerprints have in common (Dice)."""
    parts = F.struct(F.split(a, " ").alias("a"), F.split(b, " ").alias("b"))
    both = lambda p: F.size(F.array_intersect(p["a"], p["b"])).cast("double")
    total = lambda p: F.size(F.array_distinct(p["a"])) + F.size(F.array_distinct(p["b"]))
    share = _let(parts, lambda p: both(p) * 2 / total(p))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(share)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, other, next_fingerprint, fingerprint, again) of each
    different document: ``other`` is the start of the next document, as long as
    a quarter of the text or whole; ``again`` rows of it follow it in ``docs``."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), "text"))
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("key", key)
    kinds = rows.groupBy("doc_id", "key", F.length("text").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    order = written(ranked(written(kinds, "documents"), ["doc_id", "key"], "documents_in_order"), "documents_ranked")
    last = order.agg(F.max("rank")).first()[0] or 0
    behind = order.select(F.when(F.col("rank") == 0, last).otherwise(F.col("rank") - 1).alias("rank"), F.col("key").alias("next_key"))
    give = order.join(behind, "rank").select(F.col("next_key").alias("key"), F.col("key").alias("to"), F.expr("n div 4").cast("int").alias("wanted"))
    texts = rows.select("key", "text").groupBy("key").agg(F.first("text").alias("text"))
    given = texts.join(give, "key").select(
        F.col("to").alias("key"), F.substring("text", F.lit(1), F.col("wanted")).alias("other"), fingerprint(F.col("text")).alias("next_fingerprint")
    )
    own = texts.join(order.select("key", "doc_id", (F.col("rows") - 1).alias("again")), "key").join(given, "key")
    return own.select("doc_id", "text", "other", "next_fingerprint", "again", fingerprint(F.col("text")).alias("fingerprint"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row of ``docs``: its last quarter is
    replaced by the start of the next document."""
    rows = with_next(docs)
    n = F.length("text")
    quarter = F.expr("length(text) div 4").cast("int")
    # a repeated row is followed by itself, but for the last
    case = lambda other, fp, times: F.struct(other.alias("other"), fp.alias("next_fingerprint"), times.alias("times"))
    repeated = F.when(F.col("again") > 0, F.array(case(F.substring("text", F.lit(1), quarter), F.col("fingerprint"), F.col("again"))))
    once = F.array(case(F.col("other"), F.col("next_fingerprint"), F.lit(1).cast("long")))
    rows = rows.select("doc_id", "text", "fingerprint", F.explode(F.concat(once, F.coalesce(repeated, F.slice(once, 1, 0)))).alias("c"))
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.col("c.other"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "c.next_fingerprint", "c.times", edited.alias("edited"))
    rows = rows.select("doc_id", "n_chars", "fingerprint", "next_fingerprint", "times", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("edited")).alias("edited_fingerprint"))
    rows = rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_"),
    )
    return rows.drop("_")
