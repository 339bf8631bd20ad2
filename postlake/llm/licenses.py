"""License scans with DataFrame functions only.

Headers (whole lines that speak of licences, and stretches of words around a cue, fitted to each template's length) and
licence files (by name) are compared to templates by TF-IDF cosine; files without a finding inherit from the licence file of their
nearest ancestor directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lookup

#: Licence identifiers and statements that declare them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "This software is released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This software is released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: What speaks of licences, also across line breaks and comment marks.
CUE = r"(?i:licen[cs]|spdx|copyleft|public[^a-z0-9]+domain|permission[^a-z0-9]+is[^a-z0-9]+hereby[^a-z0-9]+granted|redistribution[^a-z0-9]+and[^a-z0-9]+use)"
#: A cue holds one of these, which are found faster than the cue.
_HINTS = ("licen", "spdx", "copyleft", "domain", "hereby", "redistribution")
#: Cues of several words, as words.
PHRASES = ("public domain", "permission is hereby granted", "redistribution and use")
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense)(?:[._-].*)?$"
_WORD = "[a-z0-9]+"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _best(units: DataFrame, rows: list[tuple], idf: dict[str, float], new: float, least: float) -> DataFrame:
    """(unit, license, score): of each distinct unit (unit, words) the most similar template of at least `least`; ties to the first identifier."""
    session = units.sparkSession
    weights = F.broadcast(session.createDataFrame([(i, row[0], w, x) for i, row in enumerate(rows) for w, x in row[4].items()], "template int, license string, word string, share double"))
    known = F.broadcast(session.createDataFrame(list(idf.items()), "word string, idf double"))
    terms = units.dropDuplicates(["unit"]).select("unit", F.explode("words").alias("word")).groupBy("unit", "word").agg(F.count(F.lit(1)).alias("tf"))
    # a word of no template still lengthens the vector: it is as rare as can be
    terms = terms.join(known, "word", "left").select("unit", "word", (F.col("tf") * F.coalesce("idf", F.lit(new))).alias("weight"))
    lengths = terms.groupBy("unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    dots = terms.join(weights, "word").groupBy("unit", "template", "license").agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    scored = dots.join(lengths, "unit").select("unit", "license", F.round(F.col("dot") / F.col("length"), 6).alias("score")).where(F.col("score") >= least)
    top = scored.groupBy("unit").agg(F.min(F.struct(-F.col("score"), F.col("license"))).alias("m"))
    return top.select("unit", F.col("m.license").alias("license"), (-F.col("m.col1")).alias("score"))


def _fitted(templates: tuple[tuple[str, str], ...]) -> tuple[list[tuple], dict[str, float], float]:
    """Rows (license, n_words, keys, need, shares) of the templates, the idf of their words, and that of any other word.

    Keys tell a template from prose about licences: at least one of the words that only templates of its licence have; where
    there is none, all of its rarest words.
    """
    words = [re.findall(_WORD, text.lower()) for _, text in templates]
    df = Counter(w for ws in words for w in set(ws))
    idf = {w: math.log((len(templates) + 1) / (n + 1)) + 1 for w, n in df.items()}
    of: dict[str, set[str]] = {}
    for (license_, _), ws in zip(templates, words, strict=True):
        for w in ws:
            of.setdefault(w, set()).add(license_)
    rows = []
    for (license_, _), ws in zip(templates, words, strict=True):
        if not ws:
            continue
        weights = {w: n * idf[w] for w, n in Counter(ws).items()}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        own = sorted(w for w in weights if len(of[w]) == 1)
        keys = own or sorted(w for w in weights if df[w] == min(df[v] for v in weights))
        rows.append((license_, len(ws), keys, 1 if own else len(keys), {w: x / norm for w, x in weights.items()}))
    return rows, idf, math.log(len(templates) + 1) + 1


def _contexts(words: Column, reach: int) -> Column:
    """Array of (words, at): the words around each cue, `reach` on either side, and the cue's place in them (from 0)."""

    def cue(word: Column, i: Column) -> Column:
        phrases = [[F.get(words, i + n) == w for n, w in enumerate(phrase.split())] for phrase in PHRASES]
        found = word.rlike("licen[cs]|spdx|copyleft")
        for first, *others in phrases:
            for other in others:
                first = first & other
            found = found | first
        return found

    places = F.filter(F.transform(words, lambda w, i: F.when(cue(w, i), i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i: F.struct(F.slice(words, i - F.least(i, F.lit(reach)) + 1, F.least(i, F.lit(reach)) + reach + 1).alias("words"), F.least(i, F.lit(reach)).alias("at")))


def _best_stretch(contexts: DataFrame, rows: list[tuple], idf: dict[str, float], new: float, least: float) -> DataFrame:
    """(path, whole, license, score): of each context and template the most similar stretch of the template's length that holds the cue and the template's keys."""
    session = contexts.sparkSession
    known = session.createDataFrame([(*row, idf) for row in rows], "license string, n int, keys array<string>, need int, shares map<string,double>, idf map<string,double>")
    holds = lambda words: F.size(F.array_intersect(words, F.col("keys"))) >= F.col("need")

    def score(stretch: Column) -> Column:
        tf = lambda w: F.size(F.filter(stretch, lambda x: x == w))
        terms = F.transform(F.array_distinct(stretch), lambda w: F.struct((tf(w) * F.coalesce(F.try_element_at("idf", w), F.lit(new))).alias("x"), F.coalesce(F.try_element_at("shares", w), F.lit(0.0)).alias("y")))
        sums = F.aggregate(terms, F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("all")), lambda a, t: F.struct((a["dot"] + t["x"] * t["y"]).alias("dot"), (a["all"] + t["x"] * t["x"]).alias("all")), lambda a: a["dot"] / F.sqrt(a["all"]))
        return F.round(sums, 6)

    stretches = F.transform(F.sequence(F.greatest(F.col("at") - F.col("n") + 1, F.lit(0)), F.col("at")), lambda start: F.slice("words", start + 1, F.col("n")))
    scored = contexts.join(F.broadcast(known), holds(F.col("words"))).select("path", "whole", "license", F.array_max(F.transform(F.filter(stretches, holds), score)).alias("score"))
    return scored.where(F.col("score") >= least)


def scan_licenses(files: DataFrame, path_col: str = "path", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.6) -> DataFrame:
    """One row per distinct path: path, license, score (cosine, 6 digits), origin (`file`, `header`, `inherited` or `none`), directory.

    A licence file is compared as a whole, and it and any other by whole lines with a cue and by the stretches of words around cues,
    so that a statement counts beside other words of its line or wrapped over lines; the best of at least `least` counts
    (ties to the first identifier). A stretch must also hold a template's keys (see `_fitted`). A file without one takes the licence of the licence file in the nearest directory above it, whose
    path is `directory`. Null and empty texts have no header. Rows of one path are one file. Rows with a null path
    are scanned together as one file without directory. Other columns are left out, whatever their names. An empty table
    gives an empty result. `templates` is broadcast: a fixed list, not data.
    """
    picked = files.select(F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    is_file = F.coalesce(F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILE), F.lit(False))
    rows, idf, new = _fitted(templates)
    reach = max((n for _, n, *_ in rows), default=1) - 1
    low = F.lower("text")
    hinted = reduce(Column.__or__, (low.contains(h) for h in _HINTS)) & F.col("text").rlike(CUE)
    speaking = picked.where("text is not null").where(is_file | hinted).select("path", is_file.alias("whole"), "text", F.explode(F.array(_words(F.col("text")))).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(CUE))
    units = F.transform(F.concat(lines, F.when(F.col("whole"), F.array("text")).otherwise(F.array().cast("array<string>"))), lambda u: F.struct(F.md5(u.cast("binary")).alias("unit"), _words(u).alias("words"), F.lit(None).cast("int").alias("at")))
    around = F.transform(_contexts(F.col("words"), reach), lambda c: F.struct(F.lit(None).cast("string").alias("unit"), c["words"].alias("words"), c["at"].alias("at")))
    # few rows, read by several branches below: written once, so that texts are scanned once
    pieces = cut(speaking.select("path", "whole", F.explode(F.concat(units, around)).alias("p")).select("path", "whole", "p.*").distinct())
    by_line = pieces.where("unit is not null")
    found = cut(_best(by_line, rows, idf, new, least))
    by_line = lookup(by_line.select("path", "whole", "unit"), found, ["unit"]).select("path", "whole", "license", "score")
    by_stretch = _best_stretch(pieces.where("unit is null"), rows, idf, new, least)
    own = by_line.unionByName(by_stretch).groupBy("path").agg(F.min(F.struct(-F.col("score"), F.col("license"))).alias("m"), F.max("whole").alias("whole"))
    own = cut(own.select("path", F.col("m.license").alias("license"), (-F.col("m.col1")).alias("score"), "whole"))
    parent = lambda c: F.regexp_replace(c, r"/?[^/]*$", "")
    granted = own.where("whole").select(parent(F.col("path")).alias("above"), "license", "score").groupBy("above").agg(F.min(F.struct(-F.col("score"), F.col("license"))).alias("g"))
    # nearest ancestors are found once per directory, not per file
    folders = picked.where("path is not null").select(parent(F.col("path")).alias("folder")).distinct()
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    chain = folders.select("folder", F.posexplode(F.array_distinct(above)).alias("depth", "above"))
    nearest = lookup(chain, cut(granted), ["above"]).groupBy("folder").agg(F.max(F.struct("depth", "above", "g")).alias("n")).select("folder", F.col("n.above").alias("from"), F.col("n.g.license").alias("lent"), (-F.col("n.g.col1")).alias("lent_score"))
    every = picked.select("path").distinct().join(own.withColumnRenamed("path", "own_path"), F.col("path").eqNullSafe(F.col("own_path")), "left").select("path", "license", "score", "whole")
    # one directory may hold a third of all files
    joined = lookup(every.withColumn("folder", parent(F.col("path"))), cut(nearest), ["folder"], "left")
    origin = F.when(F.col("license").isNotNull(), F.when(F.col("whole"), "file").otherwise("header")).when(F.col("lent").isNotNull(), "inherited").otherwise("none")
    return joined.select(
        F.col("path").alias(path_col), F.coalesce("license", "lent").alias("license"), F.coalesce("score", "lent_score").alias("score"),
        origin.alias("origin"), F.when(F.col("license").isNull(), F.col("from")).alias("directory"),
    )
