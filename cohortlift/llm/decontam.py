"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A text is its lower-case words (letters and digits). A document overlaps a
benchmark item if, on some alignment, a window of W words of the item matches
the document in all but S of its positions (substitutions, no gaps). Where item
and document have 16 words or more, W = 16 and S = 3; else the shorter of them
gives W, with fewer substitutions. A window lies inside the item, but may
overhang the document's ends; positions it misses there are substitutions.

Candidates come from spaced seeds: fixed masks hash six of the words in a span
and ignore the others. The masks are lossless: whatever positions of a window
are substituted, one mask still hits (``tolerance`` derives the S for which
that holds). Each hit is verified in place: all windows around it on its
alignment are counted word by word. Documents too short for the masks' spans
allow no substitution; their words' hash is looked up among the items' runs of as
many words.

Scale: no text is shuffled. Benchmark seeds, each with only the words around
it, are broadcast in blocks of at most ``max_seeds`` (some tens of MB); a larger
benchmark means more blocks, each a pass over the documents. Verified overlaps
are aggregated per (document, item).

Cases: null text is empty and overlaps nothing, null doc_id is reported as such;
items of under ``MIN_WORDS`` words are not searched for, nor are such documents in them; repeated documents or
items (by id) are reported once; empty tables give an empty result; further
columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

WINDOW, SUBSTITUTIONS, MIN_WORDS = 16, 3, 5
BLOCK = 16
#: Word positions that a seed hashes.
MASKS = [(0, 1, 2, 4, 6, 7), (0, 1, 4, 8, 9, 10)]


@functools.cache
def tolerance(words: int) -> tuple[int, int]:
    """(W, S) of an item of so many words: the most substitutions, up to three
    in sixteen, for which the masks are lossless on a window."""
    w = min(words, WINDOW)
    for s in range(SUBSTITUTIONS * w // WINDOW, 0, -1):
        hits = [{p + o for p in m} for m in MASKS for o in range(w - m[-1])]
        if all(any(h.isdisjoint(c) for h in hits) for c in itertools.combinations(range(w), s)):
            return w, s
    return w, 0


def masks() -> list[tuple[int, ...]]:
    """The spaced masks, and contiguous ones for items shorter than their span."""
    least = min(m[-1] + 1 for m in MASKS)
    return [*MASKS, *(tuple(range(n)) for n in range(MIN_WORDS, least))]


def words_of(column: Column) -> Column:
    return F.array_remove(F.split(F.lower(column), "[^\\p{L}\\p{N}]+"), "")


def _seeds(df: DataFrame, wanted: list[int]) -> DataFrame:
    """A row for each seed of each wanted mask of df (..., text): mask, h, the
    seed's position ``at`` among n words, and the words around it: the one at
    position at + k is ``near[place + k]``, as far as windows around the seed reach.

    Words are cut into short overlapping blocks first, so that a row never
    carries a whole text; words are compared by 64-bit hash.
    """
    least = min(masks()[m][-1] for m in wanted)
    before, size = WINDOW - min(len(masks()[m]) for m in wanted), BLOCK

    def blocks(words):
        starts = F.when(F.size(words) > least, F.sequence(F.lit(0), F.size(words) - 1 - least, F.lit(size)))
        return F.transform(
            starts,
            lambda s: F.struct(
                s.alias("s"), F.greatest(s - before, F.lit(0)).alias("base"), F.size(words).alias("n"),
                F.slice(words, F.greatest(s - before, F.lit(0)) + 1, F.lit(before + size + WINDOW)).alias("near"),
            ),
        )

    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    # through a list of one, so that the words are computed once per text
    found = F.flatten(F.transform(F.array(hashes), blocks))
    df = df.select(*[c for c in df.columns if c != "text"], F.inline(found))
    df = df.withColumn("at", F.explode(F.sequence(F.col("s"), F.least(F.col("s") + (size - 1), F.col("n") - 1 - least))))
    df = df.withColumn("place", F.col("at") - F.col("base")).drop("s", "base")
    seeds = [
        F.struct(F.lit(m).alias("mask"), F.xxhash64(F.lit(m), *[F.get("near", F.col("place") + p) for p in masks()[m]]).alias("h"))
        for m in wanted
    ]
    return df.select("*", F.inline(F.array(*seeds)))


def _inside(docs: DataFrame, items: DataFrame, max_seeds: int) -> list[DataFrame]:
    """(doc_id, item_id, matched) of documents too short for the spaced masks that lie whole in a longer item."""
    own = list(range(len(MASKS), len(masks())))
    span = F.element_at(F.array(*[F.lit(len(m)) for m in masks()]), F.col("mask") + 1)
    runs = _seeds(items.select("item_id", "text"), own).filter((F.col("at") + span <= F.col("n")) & (span < F.col("n")))
    runs = written(runs.select("item_id", "mask", "h").distinct(), "runs")
    hashes = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    # through a list of one, so that the words are computed once per text
    whole = lambda x, m: F.xxhash64(F.lit(m), *[F.get(x, F.lit(p)) for p in masks()[m]])
    kinds = lambda x: [F.when(F.size(x) == len(masks()[m]), F.struct(F.lit(m).alias("mask"), whole(x, m).alias("h"))) for m in own]
    short = docs.select("doc_id", F.get(F.transform(F.array(hashes), lambda x: F.coalesce(*kinds(x))), F.lit(0)).alias("k"))
    short = written(short.filter("k is not null").select("doc_id", "k.mask", "k.h").distinct(), "short_texts")
    found = []
    for block in range(blocks := max(1, math.ceil(runs.count() / max_seeds))):
        part = runs if blocks == 1 else runs.filter(F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)) == block)
        hits = short.join(F.broadcast(part), ["h", "mask"])
        found.append(hits.select("doc_id", "item_id", span.alias("matched")))
    return found


def overlaps(docs: DataFrame, benchmark: DataFrame, max_seeds: int = 100_000) -> DataFrame:
    """(doc_id, item_id, matched): the most matching words of a window, for each overlap."""
    items = benchmark.select("item_id", text_of().alias("text")).withColumn("words", F.size(words_of(F.col("text"))))
    items = items.filter(F.col("words") >= MIN_WORDS)
    items = items.select("item_id", "text", F.least("words", F.lit(WINDOW)).alias("w"))
    spans = [m[-1] + 1 for m in masks()]
    spaced, short = list(range(len(MASKS))), min(spans[: len(MASKS)])
    span = F.element_at(F.array(*[F.lit(s) for s in spans]), F.col("mask") + 1)
    seeds = _seeds(items.filter(F.col("w") >= short), spaced)
    if lengths := [r[0] for r in items.filter(F.col("w") < short).select("w").distinct().collect()]:
        own = [m for m in range(len(MASKS), len(spans)) if spans[m] in lengths]
        seeds = seeds.union(_seeds(items.filter(F.col("w") < short), own).filter(span == F.col("w")))
        spaced = spaced + own
    seeds = seeds.withColumn("span", span).filter((F.col("span") <= F.col("w")) & (F.col("at") + F.col("span") <= F.col("n")))
    seeds = seeds.select(
        "item_id", "h", "mask", "span", F.col("w").alias("item_w"), F.col("near").alias("item_near"), F.col("place").alias("item_place"),
        F.col("at").alias("item_at"), F.col("n").alias("item_n"),
    )
    allowed = F.array(*[F.lit(tolerance(n)[1]) for n in range(1, WINDOW + 1)])
    seeds = written(seeds.distinct(), "seeds")
    blocks = max(1, math.ceil(seeds.count() / max_seeds))
    texts = docs.select("doc_id", text_of().alias("text"))
    found = None
    for block in range(blocks):
        own = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("item_id", "item_place", "h"), F.lit(blocks)) == block)
        hits = _seeds(texts, spaced).join(F.broadcast(own), ["h", "mask"])
        hits = hits.withColumn("w", F.least("item_w", "n")).filter("span <= w").withColumn("s_max", F.element_at(allowed, F.col("w")))
        # first and last window start relative to the seed: inside the item, and at most s_max words outside the document
        hits = hits.withColumn("lo", F.greatest(F.col("span") - F.col("w"), -F.col("item_at"), -F.col("at") - F.col("s_max")))
        hits = hits.withColumn(
            "hi", F.least(F.lit(0), F.col("item_n") - F.col("w") - F.col("item_at"), F.col("n") - F.col("w") - F.col("at") + F.col("s_max"))
        ).filter("lo <= hi")
        count = F.expr(
            "array_max(transform(sequence(lo, hi), k -> size(filter(sequence(0, w - 1),"
            " i -> get(near, place + k + i) = get(item_near, item_place + k + i)))))"
        )
        hits = hits.select("doc_id", "item_id", "w", "s_max", count.alias("matched"))
        hits = hits.filter(F.col("matched") >= F.col("w") - F.col("s_max")).select("doc_id", "item_id", "matched")
        found = hits if found is None else found.union(hits)
    for hits in _inside(texts, items, max_seeds):
        found = found.union(hits)
    found = found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))
    return found.select("doc_id", "item_id", F.col("matched").cast("long").alias("matched"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows (all columns) whose text overlaps no item.

    Each row is judged by its own text: rows without doc_id, or of a repeated
    one, go only if they overlap themselves. Equal texts of one doc_id share
    their judgement.
    """
    row = lambda doc_id, text: F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text))
    judged = docs.select(row(F.col("doc_id"), text_of()).alias("doc_id"), "text")
    bad = overlaps(judged, benchmark, **kw).select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct("*").alias("doc"), row(F.col("doc_id"), text_of()).alias("id"))
    out = rows.join(bad, "id", "left_anti")
    return out.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def overlaps_sql() -> str:
    """Brute force for DuckDB: all equal words of documents and items, by
    alignment, then all windows of alignments with enough of them."""
    rows = ", ".join(f"({n}, {tolerance(n)[0]}, {tolerance(n)[1]})" for n in range(MIN_WORDS, WINDOW + 1))
    words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
    return f"""
    WITH kinds(n, w, s) AS (VALUES {rows}),
    item AS (SELECT item_id, ws, len(ws) AS n, k.w, k.s FROM (SELECT item_id, {words} AS ws FROM benchmark)
             JOIN kinds k ON k.n = least(len(ws), {WINDOW})),
    iw AS (SELECT item_id, n, w, s, unnest(ws) AS word, generate_subscripts(ws, 1) AS ip FROM item),
    dw AS (SELECT doc_id, nd, unnest(ws) AS word, generate_subscripts(ws, 1) AS dp
           FROM (SELECT doc_id, ws, len(ws) AS nd FROM (SELECT doc_id, {words} AS ws FROM documents))),
    eq AS (SELECT doc_id, item_id, n, w, s, nd, dp - ip AS shift, ip FROM dw JOIN iw USING (word)),
    lines AS (SELECT doc_id, item_id, shift, nd FROM eq GROUP BY ALL HAVING count(DISTINCT ip) >= min(w - s)),
    windows AS (SELECT eq.doc_id, eq.item_id, eq.shift, eq.nd, ip - o AS start, w, s, count(DISTINCT ip) AS matched
                FROM eq JOIN lines ON eq.doc_id IS NOT DISTINCT FROM lines.doc_id AND eq.item_id = lines.item_id
                     AND eq.shift = lines.shift AND eq.nd = lines.nd,
                     range({WINDOW}) t(o)
                WHERE o < w AND ip - o >= 1 AND ip - o + w - 1 <= n AND ip - o + eq.shift >= 1
                      AND ip - o + w - 1 + eq.shift <= eq.nd
                GROUP BY ALL)
    SELECT doc_id, item_id, max(matched)::BIGINT AS matched FROM windows WHERE matched >= w - s GROUP BY ALL
    """
