"""License scan by sparse TF-IDF cosine, with directory inheritance; DataFrame operations only.

Every line of a text (a header) and every whole text (a licence file) is compared
to short template notices, and every whole text also to the full licence texts in
``license_texts``, by the cosine of TF-IDF vectors. Document frequencies
are counted over all documents; a word outside the templates weighs as much as
one that no document has, each occurrence by itself. Against full texts, n
occurrences of a word weigh 1 + ln n, so that the many little words of
long texts do not make them alike; the closest notice or full text is the file's.

A document with a line of cosine ``threshold`` or more has that licence
('header', or 'file' if its whole text is that close). Others inherit from the
nearest ancestor directory in which a licence file lies ('inherited'): their own
directory, its parent, and so on to the root, found by joining paths.

Scale: texts are read twice (document frequencies, then cosines) and never
shuffled; a text's units are compared within its row. Texts and lines without a
telling template word are passed over, which loses nothing: per template the
words left out have too little weight to reach the threshold together; for the
full texts the telling words are the corpus's rarest. The
templates are fixed, so what the driver gathers is too. Directories are joined
by path; a directory with very many documents adds small rows to one side only.

Cases: null text is empty and has no licence; a null directory is the root; null
doc_id is reported as such; repeated rows are reported each; ties go to the
first licence by name; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

THRESHOLD = 0.6
#: Notices by which licences are commonly stated (SPDX name, notice).
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
WORD = "[a-z0-9]+"
#: Lists by which a full text's word is found, so that no lookup searches the whole vocabulary.
LISTS = 1024


def template_terms() -> list[tuple[int, str, str, int]]:
    """(template, licence, term, tf)"""
    return [(k, name, t, n) for k, (name, text) in enumerate(TEMPLATES) for t, n in Counter(re.findall(WORD, text.lower())).items()]


def full_texts() -> list[tuple[str, str]]:
    """(licence, whole text)"""
    found = [x for x in files(__package__).joinpath("license_texts").iterdir() if x.name.endswith(".txt")]
    return sorted((x.name.removesuffix(".txt"), x.read_text(encoding="utf-8")) for x in found)


def words_of(column: Column) -> Column:
    return F.array_remove(F.split(F.lower(column), "[^a-z0-9]+"), "")


def ancestors(path: Column) -> Column:
    """The path and its ancestors up to the root (the empty path), nearest first."""
    parts = F.array_remove(F.split(path, "/"), "")
    return F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def _unit_best(words: Column, known: Column, idf: Column, other: float, weights: list[tuple[str, Column]], threshold: float) -> Column:
    """Of a unit's words: (-similarity, licence) of the closest licence, or null."""
    zero = F.lit(0.0)
    once = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  value is computed once

    def counted(words):
        hits = F.transform(F.array_intersect(words, known), lambda t: F.struct(t.alias("t"), F.size(F.filter(words, lambda w: w == t)).alias("n")))
        hits = F.transform(hits, lambda h: F.struct(h["t"].alias("t"), h["n"].alias("n"), (h["n"] * F.element_at(idf, h["t"])).alias("x")))
        return once(hits, lambda h: closest(h, F.size(words)))

    def closest(hits, size):
        outside = size - F.aggregate(hits, F.lit(0), lambda a, h: a + h["n"])
        norm = F.sqrt(F.aggregate(hits, zero, lambda a, h: a + h["x"] * h["x"]) + outside * F.lit(other * other))
        return once(norm, lambda n: F.array_min(F.array(*[similar(hits, n, name, weight) for name, weight in weights])))

    def similar(hits, norm, name, weight):
        dot = F.aggregate(hits, zero, lambda a, h: a + h["x"] * F.coalesce(F.try_element_at(weight, h["t"]), F.lit(0.0)))
        return F.struct((-F.round(dot / norm, 6)).alias("d"), F.lit(name).alias("license"))

    best = once(words, counted)
    return once(best, lambda b: F.when(b["d"] <= -threshold, b))


def _full_text(idf: dict[str, float], seen: dict[str, int], other: float, threshold: float):
    """A function from a whole text's words to (-similarity, licence) of the closest full text, or null."""
    texts = [(name, Counter(re.findall(WORD, text.lower()))) for name, text in full_texts()]
    weights, telling = [], set()
    for _, tf in texts:
        own = {t: (1 + math.log(n)) * idf[t] for t, n in tf.items()}
        norm = math.sqrt(sum(w * w for w in own.values()))
        weights.append({t: w / norm for t, w in own.items()})
        mass = 0.0
        for t in sorted(own, key=lambda t: (seen.get(t, 0), -weights[-1][t], t)):  # the others cannot reach the threshold together
            if mass > 1 - 0.999 * threshold**2:
                break
            mass += weights[-1][t] ** 2
            telling.add(t)
    signal = F.array(*[F.lit(t) for t in sorted(telling)])
    table = [{} for _ in range(LISTS)]
    for t in sorted({t for _, tf in texts for t in tf}):
        table[zlib.crc32(t.encode()) % LISTS][t] = {"idf": idf[t], "w": [w.get(t, 0) for w in weights]}
    table = F.from_json(F.lit(json.dumps(table)), "array<map<string,struct<idf:double,w:array<double>>>>")  # folded to a constant
    names = F.array(*[F.lit(name) for name, _ in texts])
    once = lambda value, body: F.get(F.transform(F.array(value), body), F.lit(0))  # noqa: E731  value is computed once

    def best(words):
        starts = lambda s: F.filter(
            F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), F.struct(t.alias("t"), i.alias("i")))), lambda x: x.isNotNull()
        )
        return once(F.array_sort(words), lambda s: once(starts(s), lambda x: counted(x, F.size(s))))

    def counted(starts, size):
        n = lambda x, i: F.coalesce(F.get(starts, i + 1)["i"], size) - x["i"]
        entry = lambda t: F.try_element_at(F.get(table, F.pmod(F.crc32(t.cast("binary")), F.lit(LISTS)).cast("int")), t)
        hits = F.transform(starts, lambda x, i: F.struct(n(x, i).alias("n"), entry(x["t"]).alias("e")))
        return once(hits, lambda h: closest(F.filter(h, lambda x: x["e"].isNotNull()), F.filter(h, lambda x: x["e"].isNull())))

    def closest(inside, outside):
        hits = F.transform(inside, lambda h: F.struct(((1 + F.log(h["n"])) * h["e"]["idf"]).alias("x"), h["e"]["w"].alias("w")))
        rest = F.aggregate(outside, F.lit(0), lambda a, h: a + h["n"]) * F.lit(other * other)
        return once(hits, lambda h: once(F.sqrt(F.aggregate(h, F.lit(0.0), lambda a, x: a + x["x"] * x["x"]) + rest), lambda n: least(h, n)))

    def least(hits, norm):
        dot = lambda k: F.aggregate(hits, F.lit(0.0), lambda a, x: a + x["x"] * F.get(x["w"], k))
        return F.array_min(F.transform(names, lambda name, k: F.struct((-F.round(dot(k) / norm, 6)).alias("d"), name.alias("license"))))

    return lambda words: F.when(F.arrays_overlap(words, signal), once(best(words), lambda b: F.when(b["d"] <= -threshold, b)))


def scan(docs: DataFrame, directory: Column, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, directory, license, origin, similarity) of each document of
    (doc_id, text); license is null where none is found."""
    spark = docs.sparkSession
    terms = template_terms()
    vocabulary = sorted({t for _, _, t, _ in terms})
    known = F.array(*[F.lit(t) for t in vocabulary])
    every = sorted({*vocabulary, *(t for _, text in full_texts() for t in re.findall(WORD, text.lower()))})
    # how many documents hold each template word, and how many there are
    counted = F.array_intersect(words_of(text_of()), F.split(F.lit(" ".join(every)), " "))
    own = docs.select(F.explode(F.concat(counted, F.array(F.lit("")))).alias("t"))
    count = {r["t"]: r["count"] for r in own.groupBy("t").count().collect()}
    n = count.pop("", 0)
    idf = {t: math.log((n + 1) / (count.get(t, 0) + 1)) + 1 for t in every}
    other = math.log(n + 1) + 1
    full = _full_text(idf, count, other, threshold)
    idf = {t: idf[t] for t in vocabulary}

    weights, telling = [], set()
    for k, (name, _) in enumerate(TEMPLATES):
        own = {t: tf * idf[t] for j, _, t, tf in terms if j == k}
        norm = math.sqrt(sum(w * w for w in own.values()))
        weights.append((name, F.create_map(*[F.lit(x) for t, w in own.items() for x in (t, w / norm)])))
        mass = 0.0
        for t, w in sorted(own.items(), key=lambda x: x[1]):  # the lightest words cannot reach the threshold together
            mass += (w / norm) ** 2
            if mass >= 0.999 * threshold**2:
                telling.add(t)
    signal = F.array(*[F.lit(t) for t in sorted(telling)])
    idf_map = F.create_map(*[F.lit(x) for t, w in idf.items() for x in (t, w)])
    best = lambda words: _unit_best(words, known, idf_map, other, weights, threshold)

    parts = F.array_remove(F.split(F.coalesce(directory.cast("string"), F.lit("")), "/"), "")
    rows = docs.select("doc_id", F.array_join(parts, "/").alias("directory"), text_of().alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text")))
    told = F.arrays_overlap("words", signal)
    headers = F.transform(F.filter(F.split("text", "\n"), lambda x: F.arrays_overlap(words_of(x), signal)), lambda x: best(words_of(x)))
    file = F.array_min(F.array(F.when(told, best(F.col("words"))), full(F.col("words"))))
    rows = rows.select("doc_id", "directory", file.alias("file"), F.when(told, F.array_min(headers)).alias("header"))
    rows = written(rows, "licenses")

    declared = rows.filter("file is not null").groupBy(F.col("directory").alias("ancestor")).agg(F.min("file").alias("found"))
    place = rows.filter("file is null and header is null").select("directory").distinct()
    place = place.select("directory", F.posexplode(ancestors(F.col("directory"))).alias("distance", "ancestor"))
    nearest = place.join(declared, "ancestor").groupBy("directory").agg(F.min(F.struct("distance", "found")).alias("nearest"))
    out = rows.join(nearest, "directory", "left")
    mine = F.coalesce("file", "header", F.col("nearest")["found"])
    return out.select(
        "doc_id", "directory", mine["license"].alias("license"),
        F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header")
        .when(F.col("nearest").isNotNull(), "inherited").alias("origin"),
        F.abs(mine["d"]).alias("similarity"),
    )


def scan_sql(directory: str, threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB: exploded words, grouped counts, joined weights."""
    values = ", ".join(f"({k}, '{name}', '{t}', {n})" for k, name, t, n in template_terms())
    words = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
    WITH tpl(k, license, t, tf) AS (VALUES {values}),
    d AS (SELECT row_number() OVER () AS r, doc_id, array_to_string(list_filter(string_split(coalesce({directory}, ''), '/'), lambda x: x <> ''), '/') AS directory,
                 coalesce(text, '') AS text FROM documents),
    u AS (SELECT r, 0 AS pos, text AS s FROM d
          UNION ALL SELECT r, generate_subscripts(string_split(text, chr(10)), 1), unnest(string_split(text, chr(10))) FROM d),
    w AS (SELECT r, pos, unnest({words.format('s')}) AS t FROM u),
    total AS (SELECT count(*) AS n FROM d),
    seen AS (SELECT t, count(DISTINCT r) AS df FROM w WHERE pos = 0 GROUP BY t),
    idf AS (SELECT v.t, ln((n + 1) / (coalesce(df, 0) + 1)) + 1 AS idf FROM (SELECT DISTINCT t FROM tpl) v LEFT JOIN seen USING (t), total),
    tw AS (SELECT k, license, t, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY k)) AS w FROM tpl JOIN idf USING (t)),
    c AS (SELECT r, pos, t, count(*) AS tf FROM w GROUP BY ALL),
    x AS (SELECT r, pos, c.t, tf, idf FROM c LEFT JOIN idf USING (t)),
    norm AS (SELECT r, pos, sqrt(sum(CASE WHEN idf IS NULL THEN tf * (ln(n + 1) + 1) ** 2 ELSE (tf * idf) ** 2 END)) AS norm FROM x, total GROUP BY ALL),
    dot AS (SELECT r, pos, k, license, sum(tf * idf * w) AS dot FROM x JOIN tw USING (t) GROUP BY ALL),
    sim AS (SELECT r, pos, license, round(dot / norm, 6) AS s FROM dot JOIN norm USING (r, pos) WHERE round(dot / norm, 6) >= {threshold}),
    file AS (SELECT r, arg_min(license, (-s, license)) AS license, max(s) AS s FROM sim WHERE pos = 0 GROUP BY r),
    head AS (SELECT r, arg_min(license, (-s, license)) AS license, max(s) AS s FROM sim WHERE pos > 0 GROUP BY r),
    dirs AS (SELECT directory, arg_min(license, (-s, license)) AS license, max(s) AS s FROM file JOIN d USING (r) GROUP BY 1),
    near AS (SELECT r, arg_max(dirs.license, length(dirs.directory)) AS license, arg_max(dirs.s, length(dirs.directory)) AS s FROM d
             JOIN dirs ON dirs.directory = '' OR d.directory = dirs.directory OR starts_with(d.directory, dirs.directory || '/') GROUP BY r)
    SELECT doc_id, directory, coalesce(file.license, head.license, near.license) AS license,
           CASE WHEN file.r IS NOT NULL THEN 'file' WHEN head.r IS NOT NULL THEN 'header' WHEN near.r IS NOT NULL THEN 'inherited' END AS origin,
           coalesce(file.s, head.s, near.s) AS similarity
    FROM d LEFT JOIN file USING (r) LEFT JOIN head USING (r) LEFT JOIN near USING (r)
    """
