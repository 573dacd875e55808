"""Licence scans: TF-IDF cosine of lines, paragraphs and whole files to licence notices and of whole files to
the full texts of licences, then inheritance from the nearest directory above that holds a licence
file. DataFrame operations only.

A term's weight is (1 + ln tf) * idf, with idf = ln((1 + T) / (1 + df)) + 1 over the T notices. A segment can
only reach the threshold if it shares a *key term* with a notice: a notice's other terms, the commonest
first, are so light together that they cannot reach it alone. Nor can it if too many of its terms
occur in no notice. Both bounds are exact; what they rule out is settled by one narrow pass, and only
the rest is joined with the notices by term.

The full texts in ``texts`` are templates apart from the notices, with an idf of their own. The cosine's
square is at most the squared weight, in a template's unit vector, of the terms that a file shares
with it; so a file needs a least number of a template's terms, which is exact as well.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.store import keep

THRESHOLD = 0.6
FILE_THRESHOLD = 0.5  # of a whole file: then its licence covers its directory

# Notices by which licences are stated.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
)
TEXTS = Path(__file__).with_name("texts")  # full texts, each named by its licence
TERM = r"\p{L}+|[0-9]+(?:\.[0-9]+)*"
_PYTHON_TERM = r"[^\W\d_]+|[0-9]+(?:\.[0-9]+)*"
# Words that say nothing about a licence; they are no terms.
STOP_WORDS = tuple("a all an and any are as at be by can for from in is it may not of on or that the this to under use was with without you".split())


@cache
def full_texts() -> tuple[tuple[str, str], ...]:
    return tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt")))


def notice_weights(templates: Iterable[tuple[str, str]] = NOTICES) -> tuple[dict[str, float], list[tuple[str, int, str, float]]]:
    """idf by term, and (term, notice, licence, weight in the notice's unit vector)."""
    templates = tuple(templates)
    counts = [Counter(t for t in re.findall(_PYTHON_TERM, text.lower()) if t not in STOP_WORDS) for _, text in templates]
    df = Counter(term for c in counts for term in c)
    idf = {term: math.log((1 + len(counts)) / (1 + n)) + 1 for term, n in df.items()}
    rows = []
    for k, c in enumerate(counts):
        weight = {term: (1 + math.log(tf)) * idf[term] for term, tf in c.items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        rows += [(term, k, templates[k][0], w / norm) for term, w in weight.items()]
    return idf, rows


def key_terms(threshold: float) -> list[str]:
    """Terms of which every segment similar enough to a notice holds one."""
    idf, rows = notice_weights()
    keys = set()
    for k in range(len(NOTICES)):
        mass = 0.0
        for term, _, _, weight in sorted((r for r in rows if r[1] == k), key=lambda r: (idf[r[0]], r[0])):
            mass += weight * weight
            if math.sqrt(mass) >= threshold - 1e-6:
                keys.add(term)
    return sorted(keys)


def may_reach(found: Column, threshold: float) -> Column:
    """Whether enough terms of a segment occur in notices for it to reach the threshold at all.

    The cosine's square is at most known / (known + unknown) of the segment's squared weights. As
    (1 + ln tf)**2 <= 1.48 tf, the known part is at most 1.48 * idf**2 for every known term, counted
    as often as it occurs; the unknown part is at least idf**2 for every different unknown one.
    """
    idf, _ = notice_weights()
    most, unknown = 1.48 * max(idf.values()) ** 2, (math.log(1 + len(NOTICES)) + 1) ** 2
    known = F.size(F.filter(found, lambda t: t.isin(*idf)))
    others = F.size(F.array_distinct(F.filter(found, lambda t: ~t.isin(*idf, *STOP_WORDS))))
    return known * most * (1 - threshold**2) >= others * unknown * threshold**2 * (1 - 1e-9)


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def _table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A constant relation."""
    shown = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else str(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {shown} AS t({columns})")


def least_terms(threshold: float) -> list[tuple[list[str], int]]:
    """The terms of every full text, and of how many of them a file similar enough to it holds one at least."""
    _, rows = notice_weights(full_texts())
    needs = []
    for k in range(len(full_texts())):
        parts = sorted(((weight, term) for term, n, _, weight in rows if n == k), reverse=True)
        mass, least = 0.0, 0
        while least < len(parts) and mass < threshold**2 - 1e-6:
            mass += parts[least][0] ** 2
            least += 1
        needs.append((sorted(term for _, term in parts), least))
    return needs


def text_scores(files: DataFrame, threshold: float) -> DataFrame:
    """path, text_key, licence, score: of the files that are the full text of a licence, one row per licence similar enough."""
    spark = files.sparkSession
    idf, rows = notice_weights(full_texts())
    needs = least_terms(threshold)
    among = lambda words: "t -> t IN (" + ", ".join(f"'{w}'" for w in words) + ")"
    enough = " OR ".join(f"size(filter(k, {among(words)})) >= {least}" for words, least in needs)
    known = f"filter(array_distinct(regexp_extract_all(lower(text), r'({TERM})', 1)), {among(sorted(idf))})"
    # The one-element array has the terms worked out once for all texts.
    may = F.expr(f"exists(array({known}), k -> size(k) >= {min(least for _, least in needs)} AND ({enough}))")
    segment = ["path", "text_key"]
    found = files.where(may).select("path", F.xxhash64("text").alias("text_key"), "text").dropDuplicates(segment)
    found = found.select(*segment, F.explode(terms(F.col("text"))).alias("term")).where(~F.col("term").isin(*STOP_WORDS))
    found = found.groupBy(*segment, "term").agg((1 + F.log(F.count("*"))).alias("tf"))
    idfs = spark.createDataFrame(pa.table({"term": list(idf), "idf": list(idf.values())}))
    parts = spark.createDataFrame(pa.table(dict(zip(("term", "notice", "licence", "part"), map(list, zip(*rows, strict=True)), strict=True))))
    unknown = math.log(1 + len(needs)) + 1
    weighed = found.join(F.broadcast(idfs), "term", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy(*segment).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = weighed.join(F.broadcast(parts), "term").groupBy(*segment, "notice", "licence").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"))
    scored = dots.join(norms, segment).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    return scored.where(F.col("score") >= threshold).select(*segment, "licence", "score")


def file_scores(files: DataFrame, threshold: float = THRESHOLD, file_threshold: float = FILE_THRESHOLD) -> DataFrame:
    """path, text_key, licence, score, file_licence, file_score, full: of the files that state a licence.

    Best segment first, ties to the licence that sorts first; file_licence is set where the whole text
    is a licence statement, by the same rule. A file that is a licence's full text states that licence,
    whatever its lines say; then full is true.
    """
    spark = files.sparkSession
    idf, rows = notice_weights()
    keys = F.array(*[F.lit(k) for k in key_terms(min(threshold, file_threshold))])
    stated = files.where(F.arrays_overlap(terms(F.col("text")), keys)).select("path", F.xxhash64("text").alias("text_key"), "text")
    # Distinct as plain strings, which are hashed: a file of very many lines takes time in proportion.
    lines = F.array_distinct(F.concat(F.split("text", "\n"), F.split("text", r"\n[\x20\t\r]*\n")))
    cuts = F.concat(
        F.transform(lines, lambda s: F.struct(s.alias("words"), F.lit(False).alias("whole"))),
        F.array(F.struct(F.col("text").alias("words"), F.lit(True).alias("whole"))),
    )
    segment = ["path", "text_key", "pos", "whole"]
    cut = stated.select("path", "text_key", F.posexplode(cuts).alias("pos", "cut"))
    cut = cut.select("path", "text_key", "pos", "cut.whole", terms(F.col("cut.words")).alias("terms"))
    cut = cut.where(F.arrays_overlap("terms", keys) & may_reach(F.col("terms"), min(threshold, file_threshold)))
    found = cut.select(*segment, F.explode("terms").alias("term"))
    found = found.where(~F.col("term").isin(*STOP_WORDS)).groupBy(*segment, "term").agg((1 + F.log(F.count("*"))).alias("tf"))
    unknown = math.log(1 + len(NOTICES)) + 1
    idfs = _table(spark, "term, idf", list(idf.items()))
    weighed = found.join(idfs, "term", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy(*segment).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    notices = _table(spark, "term, notice, licence, part", rows)
    dots = weighed.join(notices, "term").groupBy(*segment, "notice", "licence").agg(F.sum(F.col("weight") * F.col("part")).alias("dot"))
    scored = dots.join(norms, segment).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    order = F.struct((-F.col("score")).alias("minus"), "licence")
    scored = scored.select("path", "text_key", "licence", "score", "whole", F.lit(False).alias("full"))
    scored = scored.unionByName(text_scores(files, file_threshold).select("*", F.lit(True).alias("whole"), F.lit(True).alias("full")))
    best = scored.groupBy("path", "text_key").agg(
        F.min(F.when(F.col("full"), order)).alias("text"),
        F.min(F.when(~F.col("full") & (F.col("score") >= threshold), order)).alias("own"),
        F.min(F.when(~F.col("full") & F.col("whole") & (F.col("score") >= file_threshold), order)).alias("file"),
    )
    best = best.where("text is not null or own is not null or file is not null")
    stated, file = F.coalesce("text", "own", "file"), F.coalesce("text", "file")
    return best.select(
        "path",
        "text_key",
        stated["licence"].alias("licence"),
        (-stated["minus"]).alias("score"),
        file["licence"].alias("file_licence"),
        (-file["minus"]).alias("file_score"),
        F.col("text").isNotNull().alias("full"),
    )


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame, threshold: float = THRESHOLD, file_threshold: float = FILE_THRESHOLD) -> DataFrame:
    """The columns of ``files`` but text, with own_licence, own_score, licence, licence_from.

    ``files`` has path and text. A file's own statement counts first; else the licence file of its
    directory, or of the nearest directory above that has one, of several a full text, then the one
    with the best score, then the first licence by name. ``licence_from`` is the path of the file itself or that
    directory; both are null if there is none. The root is the empty path; a null path is in no
    directory. Null and blank texts state nothing; rows that share a path and text give equal rows.
    """
    named = files.withColumn("_key", F.xxhash64("text")).withColumn("_dir", directory(F.col("path")))
    scores = keep(file_scores(files.where("path is not null"), threshold, file_threshold), "licences")
    covering = scores.where("file_licence is not null").groupBy(directory(F.col("path")).alias("above"))
    covering = covering.agg(F.min(F.struct((~F.col("full")).alias("brief"), (-F.col("file_score")).alias("minus"), F.col("file_licence").alias("licence"))).alias("best"))
    covering = covering.select("above", F.col("best.licence").alias("inherited"))
    dirs = named.where("path is not null").select(F.col("_dir").alias("dir")).distinct()
    steps = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))).alias("above"))
    nearest = ups.join(covering, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), F.col("above"), F.col("inherited"))).alias("up"))
    nearest = nearest.select(F.col("dir").alias("_dir"), F.col("up.above").alias("_above"), F.col("up.inherited").alias("_inherited"))
    own = scores.select("path", F.col("text_key").alias("_key"), F.col("licence").alias("own_licence"), F.col("score").alias("own_score"))
    found = named.join(own, ["path", "_key"], "left").join(nearest, "_dir", "left")
    return found.select(
        *[c for c in files.columns if c != "text"],
        "own_licence",
        "own_score",
        F.coalesce("own_licence", "_inherited").alias("licence"),
        F.when(F.col("own_licence").isNotNull(), F.col("path")).otherwise(F.col("_above")).alias("licence_from"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: a tree by the digits of the id, without its trailing zeros.

    Round ids lie near the root: document 1200 is /1/2/1200.txt. A null id is no file.
    """
    digits = F.regexp_replace(F.regexp_replace(F.col("doc_id").cast("string"), "0+$", ""), "(?<=.)(?=.)", "/")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    path = F.concat(F.when(digits != "", F.concat(F.lit("/"), digits)).otherwise(""), F.lit("/"), name)
    return docs.select(F.col("doc_id").cast("long"), path.alias("path"), "text")
