"""Licences of files: TF-IDF cosine of headers and licence files to templates, then directory inheritance.

The licence statements of a file are the runs of its lines that are made of template words and hold a cue,
and the words around each cue that come closest to a template, wherever they stand in a line or across lines.
An SPDX tag makes one term of each identifier, so identifiers are equal or not, never similar.
Equal statements are one unit with a count, so a header in a million files is compared once. Units and
templates meet by joining terms. A file without a licence of its own has that of the licence file in
the nearest directory above it; ancestors are listed for directories, not for files.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, sheltered, text_of

#: Customary licence notices, as (licence, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT license. See LICENSE file in the project root for full license information"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the"
        " software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and sell copies",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License"
        " at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an as is basis, without warranties or conditions of any kind, either express or implied",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free"
        " Software Foundation, either version 3 of the License, or any later version",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
        " neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("MIT", "Apache-2.0", "BSD-3-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0")),
    *((name, f"SPDX-License-Identifier: {name}{kind}") for name in ("GPL-3.0", "GPL-2.0", "LGPL-3.0") for kind in ("", "+", "-only", "-or-later")),
)

#: A statement holds one of these; they are looked for in lower case.
CUES = ("licen", "copyright", "permission is hereby", "redistribut", "public domain", "spdx")

#: File names whose whole text is a statement, and whose licence holds for the directory.
LICENSE_FILE = r"(?i)^(licen[sc]e|copying|unlicense|notice)([.-].*)?$"

#: Cosine from which a unit is taken to be the template's licence.
SIMILARITY = 0.6

TERM = re.compile(r"spdx:[a-z0-9.+-]*[a-z0-9+]|[^\W_]+(?:\.\d+)*")

#: An SPDX tag with its expression, in lower case; the name after "with" is an exception, not a licence.
_ID = r"[a-z0-9][a-z0-9.+-]*"
SPDX = re.compile(rf"spdx-license-identifier:[ \t(]*({_ID}(?:[ \t()]+(?:or|and|with)[ \t()]+{_ID})*)")

#: Share of a line's words that are template words, from which the line belongs to a statement; share of the
#: words of a part of a line and a template that both have, from which the part is one.
TEMPLATE_WORDS = 0.5


def _identifiers(tag: re.Match) -> str:
    names = re.sub(rf"[ \t()]+with[ \t()]+{_ID}", "", tag[1])
    return "".join(f" spdx:{name} " for name in re.split(r"[ \t()]+(?:or|and)[ \t()]+", names))


def terms_of(text: str) -> list[str]:
    return TERM.findall(SPDX.sub(_identifiers, text.casefold()))


def cued_terms(terms: Sequence[str], cues: Sequence[str] = CUES) -> list[int]:
    """The numbers of the terms in which a cue begins."""
    ends = list(accumulate(len(t) + 1 for t in terms))
    places = re.finditer("|".join(map(re.escape, cues)), " ".join(terms))
    return list(dict.fromkeys(bisect_right(ends, m.start()) for m in places))


def shapes_of(templates: Sequence[tuple[str, str]], cues: Sequence[str] = CUES) -> list[tuple[int, Counter, list[int]]]:
    """Of each template its number of terms, its terms with counts, and where its cues stand; all places where it has none."""
    made = [terms_of(text) for _, text in templates]
    return [(len(t), Counter(t), cued_terms(t, cues) or list(range(len(t)))) for t in made if t]


def parts(terms: Sequence[str], shapes: Sequence[tuple[int, Counter, list[int]]], cues: Sequence[str] = CUES) -> list[str]:
    """For each cue, the terms around it that share most with a template whose cue is laid on it."""
    found = []
    for place in cued_terms(terms, cues):
        best = (0.0, 0, "")
        for length, counts, anchors in shapes:
            for anchor in anchors:
                low, high = max(0, place - anchor), min(len(terms), place - anchor + length)
                while low < high and terms[low] not in counts:
                    low += 1
                while low < high and terms[high - 1] not in counts:
                    high -= 1
                common = sum(min(n, counts[t]) for t, n in Counter(terms[low:high]).items() if t in counts)
                share = 2 * common / (high - low + length)
                if share >= TEMPLATE_WORDS and (share, length) > best[:2]:
                    best = (share, length, " ".join(terms[low:high]))
        if best[2]:
            found.append(best[2])
    return found


def statements(
    text: str, whole: bool, vocabulary: frozenset[str], shapes: Sequence[tuple[int, Counter, list[int]]], cues: Sequence[str] = CUES
) -> list[str]:
    """The statements of a text as terms joined by spaces, each line of them with a cue, and the parts around cues.

    With ``whole``, all of the text is one besides. A part that is a statement or a line already is no other.
    """
    found = [" ".join(terms)] if whole and (terms := terms_of(text)) else []
    lowered = text.lower()
    if not any(c in lowered for c in cues):
        return found
    run, cued = [], []
    for line in [*text.split("\n"), None]:
        terms = terms_of(line) if line is not None else []
        if terms and sum(t in vocabulary for t in terms) >= TEMPLATE_WORDS * len(terms):
            run.append(" ".join(terms))
            if any(c in line.lower() for c in cues):
                cued.append(run[-1])
            continue
        if cued:
            found += {" ".join(run): None, **dict.fromkeys(cued)}
        run, cued = [], []
    known = set(found)
    return found + [p for p in dict.fromkeys(parts(terms_of(text), shapes, cues)) if p not in known]


def file_units(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per file: its number, doc_id, path, directory, whether it is a licence file, and its statements."""
    words = frozenset(t for _, text in templates for t in terms_of(text))
    shapes = shapes_of(templates)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    named = files.select(
        F.monotonically_increasing_id().alias("file"),
        "doc_id",
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
        text_of("text").alias("text"),
    ).select("file", "doc_id", "path", name.rlike(LICENSE_FILE).alias("is_license"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statements(t, w, words, shapes) for t, w in zip(batch.column(4).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(made, pa.list_(pa.string()))], ["file", "doc_id", "path", "is_license", "units"])

    kind = files.schema["doc_id"].dataType.simpleString()
    return named.mapInArrow(run, f"file long, doc_id {kind}, path string, is_license boolean, units array<string>")


def matched_units(units: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``unit``, and the ``license`` and ``similarity`` of the template closest to it.

    Frequencies count every statement of the corpus and every template. Ties go to the licence first in order.
    """
    spark: SparkSession = units.sparkSession
    distinct = settled(units.groupBy("unit").agg(F.count(F.lit(1)).alias("n")), "license-units")
    shapes = spark.createDataFrame([(i, name, " ".join(terms_of(text))) for i, (name, text) in enumerate(templates)], "template int, license string, unit string")

    def counted(df: DataFrame, *keys: str) -> DataFrame:
        return df.select(*keys, F.explode(F.split("unit", " ")).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))

    own = counted(distinct.withColumn("of", F.col("unit")), "of", "n").withColumnRenamed("of", "unit")
    theirs = counted(shapes, "template", "license")
    total = (distinct.agg(F.sum("n")).first()[0] or 0) + len(templates)
    frequency = (
        own.select("term", "n").union(theirs.select("term", F.lit(1).cast("long"))).groupBy("term").agg(F.sum("n").alias("df"))
        .select("term", (F.log((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
    )

    def weighted(df: DataFrame, *keys: str) -> DataFrame:
        return df.join(frequency, "term").select(*keys, "term", ((1 + F.log("tf")) * F.col("idf")).alias("w"))

    left = weighted(own, "unit")
    right = weighted(theirs, "template", "license")
    norms = left.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    sizes = right.groupBy("template").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("size"))
    dots = left.join(right.withColumnRenamed("w", "v"), "term").groupBy("unit", "template", "license").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    cosine = F.round(F.col("dot") / (F.col("norm") * F.col("size")), 9)
    close = dots.join(norms, "unit").join(sizes, "template").select("unit", "license", cosine.alias("similarity"))
    best = close.groupBy("unit").agg(F.min(F.struct((-F.col("similarity")).alias("far"), "license")).alias("best"))
    return best.select("unit", F.col("best.license").alias("license"), (-F.col("best.far")).alias("similarity"))


def directories(path: Column) -> Column:
    """All directories above a path with their depth; the root is the empty one at depth 0."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), "/").alias("dir"), k.alias("depth")),
    )


def scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``files`` (doc_id, path, text): doc_id, path, license, similarity, how and licensed_by.

    ``how`` is 'own', 'inherited' or 'none'; ``licensed_by`` the directory whose licence file is inherited.
    Of several statements or licence files the closest to its template counts, then the licence first in
    order. A null path is a file in the root, a null text an empty one; equal rows are files of their own.
    """
    files, _ = sheltered(files, "doc_id", "path", "text")
    found = settled(file_units(files, templates), "license-files")
    units = found.select("file", F.explode("units").alias("unit"))
    known = matched_units(units, templates).where(F.col("similarity") >= similarity)
    best = F.min(F.struct((-F.col("similarity")).alias("far"), "license")).alias("best")
    own = units.join(known, "unit").groupBy("file").agg(best).select("file", F.col("best.license").alias("own"), (-F.col("best.far")).alias("close"))
    placed = found.select("file", "doc_id", "path", "is_license", F.element_at(directories(F.col("path")), -1)["dir"].alias("dir"))
    licensed = settled(placed.join(own, "file", "left"), "license-own")
    nearest = F.min(F.struct((-F.col("close")).alias("far"), F.col("own").alias("license"))).alias("best")
    holders = licensed.where("is_license AND own IS NOT NULL").groupBy("dir").agg(nearest).select(F.col("dir").alias("holder"), "best.license")
    above = (
        licensed.select("dir").distinct()
        # a file stands in for the directory's content, so that the directory itself is among its ancestors
        .select("dir", F.inline(directories(F.concat(F.col("dir"), F.lit("/x")))).alias("holder", "depth"))
    )
    inherited = (
        above.join(holders, "holder")
        .groupBy("dir")
        .agg(F.max(F.struct("depth", "license", "holder")).alias("best"))
        .select("dir", F.col("best.license").alias("inherited"), F.col("best.holder").alias("holder"))
    )
    return licensed.join(inherited, "dir", "left").select(
        "doc_id",
        "path",
        F.coalesce("own", "inherited").alias("license"),
        F.col("close").alias("similarity"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("how"),
        F.when(F.col("own").isNull(), F.col("holder")).alias("licensed_by"),
    )


def documents_as_files(docs: DataFrame, license_words: int = 80) -> DataFrame:
    """The documents table as files, which it has no paths for: source, language and thousands make folders.

    A document of up to ``license_words`` words that speaks of a licence plays the folder's licence file.
    """
    short = F.size(F.split(text_of("text"), r"\s+")) <= license_words
    name = F.when(short & F.lower("text").contains("licen"), "LICENSE-").otherwise("")
    folder = F.floor(F.col("doc_id") / 1000).cast("string")
    return docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", folder, F.concat(name, F.col("doc_id").cast("string"))).alias("path"))
