"""Near-duplicate lines by a segment-partition edit join; DataFrame operations only.

A line is removed if an earlier line (by doc_id, then position) equals it, or if
both have ``min_near`` code points or more and their edit distance (insertions,
deletions, substitutions of code points) is at most ``edits``. Whether the
earlier line itself stays does not matter. Lines of under ``min_chars`` code
points are left alone, and so are documents as such: one may end up empty.

Equal lines are found by their first occurrence per hash. For the rest, a line
is split into ``edits`` + 1 segments; two lines within the distance share one
of them. Segments are indexed by length and place, and each line probes the
indexes of its own and slightly smaller lengths at the few shifts that can
matter. Pairs that meet, and whose letter counts differ by no more than the
edits allow, are verified with a banded bit-parallel edit distance: one word
holds the reachable diagonals per number of edits.

Scale: keys are hashes, so that what is shuffled per line is small. First
occurrences are a partially aggregated minimum, so a line of a third of all rows
is one row per task. Line texts are fetched only for verified candidates: their
ids are broadcast while they are under ``max_broadcast`` (checked), joined by
shuffle beyond. The letter counts cut candidates within the join; a segment
with very many lines is split by adaptive execution. Documents are shuffled
once, to put the remaining lines together.

Cases: null text is one empty line and stays null in ``dedup_lines``; rows with a null doc_id stay
as they are and are compared with nothing; rows that repeat a doc_id are the same
document; an empty table gives an empty result; further columns are carried through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

EDITS, MIN_CHARS, MIN_NEAR = 2, 10, 30
#: Letters whose counts are compared before the distance; any sixteen would be right, frequent ones first shorten the line for the rest.
LETTERS = "etnriaosldhucmgb"


def segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """(start from 1, length) of edits + 1 segments, as even as can be, the longer ones last."""
    k = edits + 1
    base, longer = F.floor(length / k).cast("int"), (length % k).cast("int")
    out, start = [], F.lit(1)
    for i in range(k):
        size = base + F.when(F.lit(i) >= k - longer, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def index_keys(line: Column, length: Column, edits: int) -> list[Column]:
    """The line's segments, hashed with length and place."""
    return [F.xxhash64(length, F.lit(i), F.substring(line, s, n)) for i, (s, n) in enumerate(segments(length, edits))]


def probe_keys(line: Column, length: Column, edits: int) -> list[Column]:
    """The substrings that can equal a segment of a line as long or shorter:
    shifts are bounded by the edits left of and right of the segment."""
    found = []
    for less in range(edits + 1):
        other = length - less
        for i, (start, size) in enumerate(segments(other, edits)):
            right = edits - i
            for shift in range(max(-i, less - right), min(i, less + right) + 1):
                found.append(F.xxhash64(other.cast("int"), F.lit(i), F.substring(line, start + shift, size)))
    return found


def letter_counts(line: Column) -> Column:
    """Counts, modulo 16, of the letters in the half bytes of a long; each letter is counted in what the ones before have left."""
    out, rest = F.lit(0).cast("long"), line
    for k, c in enumerate(LETTERS):
        less = F.replace(rest, F.lit(c), F.lit(""))
        n = F.octet_length(rest) - F.octet_length(less)
        out, rest = out.bitwiseOR(F.shiftleft(n.cast("long").bitwiseAND(F.lit(15)), 4 * k)), less
    return out


def letters_close(a: Column, b: Column, edits: int) -> Column:
    """An edit changes the counts by two in all at most; round the clock of 16,
    no distance is longer than the true one."""
    found = F.lit(0)
    count = lambda x, k: F.shiftrightunsigned(x, 4 * k).bitwiseAND(F.lit(15))
    for k in range(len(LETTERS)):
        d = (count(a, k) - count(b, k)).bitwiseAND(F.lit(15))
        found = found + F.least(d, 16 - d)
    return found <= 2 * edits


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """The distance of two arrays of characters if it is at most ``edits``, else edits + 1.

    Bit d + edits of word e tells whether the first i characters of a can
    become the first i + d of b by e edits; a step takes one more character of a.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    zero = 1 << edits
    start = F.struct(*[F.lit(sum(zero << j for j in range(e + 1)) & full).alias(f"r{e}") for e in range(edits + 1)])

    once = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  value is computed once

    def advance(state, equal):
        words = [state["r0"].bitwiseAND(equal)]
        for e in range(1, edits + 1):
            before = state[f"r{e - 1}"]
            now = state[f"r{e}"].bitwiseAND(equal).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
            words.append(now.bitwiseOR(F.shiftleft(words[-1], 1)).bitwiseAND(F.lit(full)))
        return F.struct(*[w.alias(f"r{e}") for e, w in enumerate(words)])

    def step(state, i):
        equal = F.lit(0)
        for d in range(-edits, edits + 1):
            equal = equal + F.when(F.get(a, i) == F.get(b, i + d), 1 << (d + edits)).otherwise(0)
        return once(equal, lambda m: advance(state, m))

    steps = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
    bit = F.greatest(F.lit(0), F.least(F.size(b) - F.size(a) + edits, F.lit(width - 1)))

    def least(end):
        out = F.lit(edits + 1)
        for e in range(edits, -1, -1):
            out = F.when(F.getbit(end[f"r{e}"], bit) == 1, e).otherwise(out)
        return out

    return F.when(F.abs(F.size(a) - F.size(b)) > edits, edits + 1).otherwise(once(F.aggregate(steps, start, step), least))


def characters(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit("(?s)."), F.lit(0))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of documents with an id; line_no from 0."""
    rows = docs.filter("doc_id is not null").select("doc_id", F.split("text", "\n").alias("lines"))
    return rows.select("doc_id", F.posexplode("lines").alias("line_no", "line"))


def _near_firsts(docs: DataFrame, edits: int, min_near: int, max_broadcast: int) -> DataFrame:
    """(doc_id, line_no) of first occurrences within the distance of an earlier line."""
    long = _lines(docs).select("line").withColumn("n", F.length("line")).filter(F.col("n") >= min_near)
    line, n = F.col("line"), F.col("n")
    index, probe = index_keys(line, n, edits), probe_keys(line, n, edits)
    kinds = len(index)
    # one row per different line, partially aggregated; its keys are plain columns, so that hashing aggregates them
    keys = [k.alias(f"k{i}") for i, k in enumerate([*index, *probe])]
    keyed = long.select(F.xxhash64("line").alias("id"), letter_counts(line).alias("letters"), *keys)
    keyed = keyed.groupBy("id").agg(*[F.first(c).alias(c) for c in keyed.columns[1:]])
    # both sides unfold the same columns, so that they read one shuffle and letters and keys are computed once
    unfolded = keyed.select("id", "letters", F.posexplode(F.array(*[f"k{i}" for i in range(len(keys))])).alias("kind", "key"))
    index = unfolded.filter(F.col("kind") < kinds).select("id", "letters", "key")
    probe = unfolded.filter(F.col("kind") >= kinds)
    probe = probe.select(F.col("id").alias("id2"), F.col("letters").alias("letters2"), "key")
    pair = index.join(probe, "key").filter((F.col("id") != F.col("id2")) & letters_close(F.col("letters"), F.col("letters2"), edits))
    pair = pair.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
    pair = written(pair, "line_pairs")
    ids = written(pair.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "line_ids")
    if ids.count() <= max_broadcast:
        ids = F.broadcast(ids)
    text = _lines(docs).filter(F.length("line") >= min_near).withColumn("id", F.xxhash64("line")).join(ids, "id")
    text = text.groupBy("id", "line").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    # written, so that the steps of the distance read the characters instead of making them
    text = written(text.select("id", "first", characters(F.col("line")).alias("chars")), "line_texts")
    a, b = (text.select(F.col("id").alias(x), F.col("chars").alias(f"chars_{x}"), F.col("first").alias(f"first_{x}")) for x in "ab")
    near = pair.join(a, "a").join(b, "b")
    near = near.filter(edit_distance(F.col("chars_a"), F.col("chars_b"), edits) <= edits)
    return near.select(F.greatest("first_a", "first_b").alias("f")).select("f.doc_id", "f.line_no").distinct()


def _deduped(docs: DataFrame, edits: int, min_chars: int, min_near: int, max_broadcast: int) -> DataFrame:
    """(doc, text, n_lines, n_removed); doc holds all columns, so that their names cannot clash."""
    near = _near_firsts(docs, edits, min_near, max_broadcast)
    # two 64-bit hashes name a line
    line = _lines(docs).filter(F.length("line") >= min_chars)
    named = line.select("doc_id", "line_no", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))
    firsts = named.groupBy("h", "h2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    firsts = firsts.select("first.doc_id", "first.line_no", "h").join(near, ["doc_id", "line_no"], "left_anti")
    stay = firsts.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "h")).alias("stay"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("doc_id"))
    out = rows.join(stay, "doc_id", "left").withColumn("lines", F.split(F.coalesce("doc.text", F.lit("")), "\n"))
    # the hash counts where a doc_id is repeated with another text
    first = F.filter(
        F.coalesce("stay", F.array().cast("array<struct<line_no:int,h:bigint>>")),
        lambda s: F.xxhash64(F.get("lines", s["line_no"])) == s["h"],
    )
    short = F.filter(F.transform("lines", lambda x, i: F.when(F.length(x) < min_chars, i)), lambda i: i.isNotNull())
    numbers = F.array_sort(F.concat(F.transform(first, lambda s: s["line_no"]), short))
    kept = F.when(F.col("doc_id").isNull(), F.col("lines")).otherwise(F.transform(numbers, lambda i: F.get("lines", i)))
    out = out.select("doc", "lines", kept.alias("kept"))
    return out.select(
        "doc",
        F.when(F.col("doc.text").isNotNull(), F.array_join("kept", "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )


def report(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, min_near: int = MIN_NEAR, max_broadcast: int = 2_000_000
) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) with the text that remains."""
    out = _deduped(docs.select("doc_id", "text"), edits, min_chars, min_near, max_broadcast)
    return out.select("doc.doc_id", "text", "n_lines", "n_removed")


def dedup_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, min_near: int = MIN_NEAR, max_broadcast: int = 2_000_000
) -> DataFrame:
    """``docs`` (all columns) with the text that remains."""
    out = _deduped(docs, edits, min_chars, min_near, max_broadcast)
    return out.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def dedup_sql(edits: int = EDITS, min_chars: int = MIN_CHARS, min_near: int = MIN_NEAR) -> str:
    """Brute force for DuckDB: first occurrences, and the distance of all pairs of long lines."""
    counts = " + ".join(f"abs(len(replace(a.line, '{c}', '')) - len(replace(b.line, '{c}', '')) - (a.n - b.n))" for c in "etnriaosldhu")
    return f"""
    WITH l AS (SELECT doc_id, generate_subscripts(x, 1) AS no, unnest(x) AS line, len(x) AS n_lines
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
    f AS (SELECT line, length(line) AS n, min((doc_id, no)) AS first FROM l WHERE length(line) >= {min_chars} GROUP BY line),
    near AS (SELECT DISTINCT b.line FROM f a JOIN f b ON a.first < b.first AND a.n >= {min_near} AND b.n >= {min_near}
             AND abs(a.n - b.n) <= {edits} AND {counts} <= {2 * edits} AND levenshtein(a.line, b.line) <= {edits}),
    k AS (SELECT l.doc_id, no, l.line, n_lines,
                 length(l.line) < {min_chars} OR (f.first = (l.doc_id, no) AND near.line IS NULL) AS stays
          FROM l LEFT JOIN f USING (line) LEFT JOIN near USING (line))
    SELECT doc_id, any_value(n_lines)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (stays), '')) AS text_sha256
    FROM k GROUP BY doc_id
    """
