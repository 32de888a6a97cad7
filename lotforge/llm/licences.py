"""Licence scans: sparse TF-IDF cosine to templates, then inheritance along paths. DataFrame
operations only.

Texts are compared with notices, headers, titles and whole short licences. Terms weigh by tf * idf,
the idf from the document frequencies of the templates' terms over all documents; terms outside
the templates weigh as if unseen. Nothing reaches the least cosine with a template unless it holds
one of the template's heavy terms (the rest of the template is too light). Two kinds of parts are
compared: every line with every template, and windows of a template's length in terms with that
template, so that neither line breaks nor neighbouring words decide. A window is laid over a text
so that one of its heavy terms stands where the template has it; it may start or end with the text.
Lines without a heavy term, and windows that share too little of the template, are left out before
any counting, without loss. A text's licence is that of its best part.

A text without such a part has the licence of an SPDX tag in it, else of a bare name that fills a
line; these are looked up literally, since two or three terms are too few for a cosine.

A text without one inherits from the nearest ancestor directory whose licence file has one: every
such directory is a row, every text joins the few directories above its path, the deepest wins.

A null or empty text has no licence of its own; a null path, or one without a directory above that
has a licence file, inherits nothing. Equal best parts of two licences go to the name that sorts
first; two licence files of one directory to the better one, then the same way. Repeated rows give
equal results, an empty table an empty one, other columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import stored

#: Terms of a text that are searched for windows at a time.
STRETCH = 1000


def _gnu(kind: str, name: str, version: str) -> str:
    return (
        f"This {kind} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
        f"as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


#: Public notices, headers, titles and short licences by licence identifier (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", _gnu("program", "General Public License", "3")),
    ("GPL-2.0", _gnu("program", "General Public License", "2")),
    ("LGPL-3.0", _gnu("library", "Lesser General Public License", "3")),
    ("LGPL-2.1", _gnu("library", "Lesser General Public License", "2.1")),
    ("AGPL-3.0", _gnu("program", "Affero General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
)
#: Bare names that count where they fill a line. A GNU licence without a version may be taken in any.
TITLES = (
    ("Apache-2.0", "Apache License 2.0"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("GPL-1.0-or-later", "GNU General Public License"),
    ("LGPL-2.0-or-later", "GNU Lesser General Public License"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("Unlicense", "The Unlicense"),
)
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _vocabulary(spark, templates) -> list[tuple[int, str, list[str]]]:
    """(template number, licence, terms), by the same expression as for texts."""
    frame = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(templates)], "template int, licence string, text string"
    )
    return [tuple(r) for r in frame.select("template", "licence", terms(F.col("text")).alias("all")).collect()]


def heavy_terms(own: dict[str, float], least: float) -> set[str]:
    """Terms without which no text can reach the cosine `least` with a template of weights `own`."""
    out: set[str] = set()
    left = whole = sum(w * w for w in own.values())
    for term, w in sorted(own.items(), key=lambda x: (-x[1], x[0])):
        if left < least * least * whole * (1 - 1e-9):
            break
        out.add(term)
        left -= w * w
    return out


def _windows(texts: DataFrame, laid: DataFrame, heavy: Column, least: float, reach: int) -> DataFrame:
    """(key, part, number, template, all): the windows that share enough with their template.

    `texts` has key and all. `laid` has template, length, squares (term to squared share of the
    template) and places (heavy term to its places in the template). A text is searched in
    stretches that overlap by `reach`, the longest template, so that no row grows with a text."""
    parts = F.sequence(F.lit(0), F.floor((F.size("all") - 1) / STRETCH).cast("int"))
    # Rows of texts that hold heavy terms only; each stretch is cut before it is exploded.
    cut = F.transform(
        parts,
        lambda n: F.struct(
            n.alias("part"),
            F.least(n * STRETCH, F.lit(reach)).alias("first"),
            F.slice("all", F.greatest(n * STRETCH - reach, F.lit(0)) + 1, F.least(n * STRETCH, F.lit(reach)) + STRETCH + reach).alias("all"),
        ),
    )
    stretches = texts.where(F.arrays_overlap("all", heavy)).select("key", F.explode(cut).alias("cut")).select("key", "cut.*")

    def shared(words) -> Column:
        return F.aggregate(F.array_intersect(F.map_keys("squares"), words), F.lit(0.0), lambda sum_, w: sum_ + F.element_at("squares", w))

    enough = least * least * (1 - 1e-9)
    near = stretches.where(F.arrays_overlap("all", heavy)).join(F.broadcast(laid), shared(F.col("all")) >= enough)
    none = F.array().cast("array<int>")
    starts = F.transform(
        "all",
        lambda w, i: F.when(
            (i >= F.col("first")) & (i < F.col("first") + STRETCH) & F.array_contains(F.map_keys("places"), w),
            F.transform(F.element_at("places", w), lambda place: i - place),
        ).otherwise(none),
    )
    begin = lambda s: F.greatest(s, F.lit(0))
    windows = F.transform(F.array_distinct(F.flatten(starts)), lambda s: F.slice("all", begin(s) + 1, s + F.col("length") - begin(s)))
    return near.select("key", "part", "template", F.posexplode(F.filter(windows, lambda w: shared(w) >= enough)).alias("number", "all"))


def _named(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, licence) by SPDX tags, and by bare names that fill a line."""
    lower = F.lower("text")
    tags = {name: rf"spdx-license-identifier:[ \t(]*{re.escape(name.lower())}(?![a-z0-9]|\.[0-9]|-(?!only|or-later))" for name, _ in TEMPLATES}
    names: dict[str, str] = {}
    for name, title in TITLES:
        line = r"[^a-z0-9\n]+".join(map(re.escape, re.findall(TERM, title.lower())))
        names[name] = names.get(name, "") + ("|" if name in names else "") + line
    names = {name: rf"(?m)^[^a-z0-9\n]*(?:{lines})[^a-z0-9\n]*$" for name, lines in names.items()}

    def by(patterns: dict[str, str], word: str) -> DataFrame:
        found = F.array_min(F.array(*(F.when(lower.rlike(p), F.lit(name)) for name, p in sorted(patterns.items()))))
        return texts.where(lower.rlike(word)).select("key", found.alias("licence")).where("licence is not null")

    return by(tags, "spdx"), by(names, "license|cc0").distinct()


def own_licences(texts: DataFrame, least: float = 0.8, templates=TEMPLATES) -> DataFrame:
    """(key, licence, score): the best part of every text that reaches `least`.

    `texts` has key and text. The templates, their vocabulary and its frequencies are fixed in
    number; parts are taken only from texts that hold a heavy term."""
    spark = texts.sparkSession
    vocabulary = _vocabulary(spark, templates)
    words = sorted({term for _, _, own in vocabulary for term in own})
    texts = texts.where(F.col("text").isNotNull())
    held = texts.select("key", F.array_intersect(terms(F.col("text")), F.array(*map(F.lit, words))).alias("known"))
    counted = stored(held, "terms")
    number = counted.count()
    seen = {r["term"]: r["count"] for r in counted.select(F.explode("known").alias("term")).groupBy("term").count().collect()}
    idf = {w: math.log((1 + number) / (1 + seen.get(w, 0))) + 1 for w in words}
    unseen = math.log(1 + number) + 1

    shares: dict[int, dict[str, float]] = {}
    for template, _, own in vocabulary:
        weights = {term: own.count(term) * idf[term] for term in own}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        shares[template] = {term: w / norm for term, w in weights.items()}
    needed = {template: heavy_terms(own, least) for template, own in shares.items()}
    table = spark.createDataFrame(
        [(term, template, licence, shares[template][term]) for template, licence, _ in vocabulary for term in shares[template]],
        "term string, template int, licence string, share double",
    )
    laid = spark.createDataFrame(
        [
            (t, len(own), {w: s * s for w, s in shares[t].items()}, {w: [i for i, x in enumerate(own) if x == w] for w in needed[t]})
            for t, _, own in vocabulary
        ],
        "template int, length int, squares map<string,double>, places map<string,array<int>>",
    )
    heavy = F.array(*(F.lit(t) for t in sorted(set().union(*needed.values()))))
    known = F.create_map(*chain.from_iterable((F.lit(w), F.lit(v)) for w, v in sorted(idf.items())))

    lines = texts.select("key", F.posexplode(F.split("text", "\n")).alias("number", "body"))
    lines = lines.select("key", F.lit(-1).alias("part"), "number", F.lit(-1).alias("of"), terms(F.col("body")).alias("all"))
    windows = _windows(texts.select("key", terms(F.col("text")).alias("all")), laid, heavy, least, max(len(own) for *_, own in vocabulary))
    parts = lines.where(F.arrays_overlap("all", heavy)).union(
        windows.select("key", "part", "number", F.col("template").alias("of"), "all")
    )
    place = ["key", "of", "part", "number"]
    counts = (
        parts.select(*place, F.explode("all").alias("term"))
        .groupBy(*place, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
        .withColumn("weight", F.col("tf") * F.coalesce(F.element_at(known, F.col("term")), F.lit(unseen)))
    )
    norm = counts.groupBy(*place).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    # One row per part and licence, from the templates' few terms: a broadcast of fixed size.
    dots = counts.join(F.broadcast(table), "term").where("of in (-1, template)").groupBy(*place, "template", "licence")
    dots = dots.agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    notices = (
        dots.join(norm, place)
        .withColumn("score", F.round(F.least(F.col("dot") / F.col("norm"), F.lit(1.0)), 6))
        .where(F.col("score") >= least)
        .select("key", "licence", "score")
    )
    tags, names = _named(texts)
    # A bare name says least: it ranks behind every notice and tag.
    found = notices.withColumn("rank", F.lit(0)).union(tags.select("key", "licence", F.lit(1.0), F.lit(0)))
    found = found.union(names.select("key", "licence", F.lit(1.0), F.lit(1)))
    return (
        found.groupBy("key")
        .agg(F.min(F.struct("rank", (-F.col("score")).alias("minus"), "licence")).alias("best"))
        .select("key", "best.licence", (-F.col("best.minus")).alias("score"))
    )


def _parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def licences(files: DataFrame, least: float = 0.8, templates=TEMPLATES) -> DataFrame:
    """doc_id, path, licence, score, origin (`own`, `inherited` or null) and directory for every
    row of `files`, which has doc_id, path, text and is_licence_file."""
    rows = files.select(
        "doc_id", "path", "is_licence_file", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("second"), "text").alias("t2")
    )
    key = F.struct("t1", "t2")
    own = own_licences(rows.select(key.alias("key"), "text"), least, templates).select("key.t1", "key.t2", "licence", "score")
    named = stored(
        rows.drop("text").join(own, ["t1", "t2"], "left").select("doc_id", "path", "is_licence_file", "licence", "score"),
        "licences",
    )
    roots = (
        named.where("is_licence_file and licence is not null and path is not null")
        .groupBy(_parent(F.col("path")).alias("directory"))
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best"))
        .select("directory", F.col("best.licence").alias("given"))
    )
    # Directories, not files, look for their ancestors: one row per directory and level.
    homes = named.where("licence is null and path is not null").select(_parent(F.col("path")).alias("home")).distinct()
    steps = F.split("home", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    above = F.array_union(F.array(F.lit("")), above)
    nearest = (
        homes.select("home", F.explode(above).alias("directory"))
        .join(roots, "directory")
        .groupBy("home")
        .agg(F.max(F.struct(F.length("directory").alias("depth"), "directory", "given")).alias("near"))
        .select("home", "near.directory", "near.given")
    )
    return (
        named.withColumn("home", F.when(F.col("licence").isNull(), _parent(F.col("path"))))
        .join(nearest, "home", "left")
        .select(
            "doc_id",
            "path",
            F.coalesce("licence", "given").alias("licence"),
            "score",
            F.when(F.col("licence").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").alias("origin"),
            "directory",
        )
    )
