"""Language by held-out accuracy; licences against a plain TF-IDF; the pipeline stage by stage."""

import math
import re
import textwrap
from collections import Counter

from lotforge.llm import bytecnn
from lotforge.llm.bytecnn import fit, languages, predict
from lotforge.llm.licences import TEMPLATES, TERM, licences
from lotforge.llm.queries import queries
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries()["op8_byte_cnn"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").collect()
    held = [r for r in got if r["held_out"] and r["lang"] is not None and r["lang_pred"] != "und"]
    assert len(held) > 200 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_hard_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = fit(docs)
    rows = [(1, None, "en", 0.5), (2, "", "en", 0.5), (3, "½ ² ① 12 !?_", None, 0.5), (None, "the house and the road", None, None)]
    rows += [(4, "the house and the road " * 40_000, "fr", 1.0), (4, "the house and the road " * 40_000, "de", 1.0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score_in double")
    got = predict(frame, net, ["doc_id", "lang"]).collect()
    assert [(r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (1, 2, 3)] == [("und", 0.0)] * 3
    assert len({(r["lang_pred"], r["score"]) for r in got if r["doc_id"] == 4}) == 1  # lang is no input
    assert languages(frame.limit(0)).count() == 0
    unlabelled = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in languages(unlabelled).collect()} == {"und"}


def plain_licences(files, least=0.8):
    """(licence, score, origin, directory) of each file."""
    split = lambda t: re.findall(TERM, t.lower())
    texts = [t for _, _, t, _ in files if t is not None]
    seen = Counter(w for t in texts for w in set(split(t)))
    vocabulary = {w for _, t in TEMPLATES for w in split(t)}
    idf = lambda w: math.log((1 + len(texts)) / (1 + (seen[w] if w in vocabulary else 0))) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(split(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [(name, vector(t)) for name, t in TEMPLATES]

    def own(text):
        found = []
        for line in set((text or "").split("\n")):
            v = vector(line)
            for name, w in known:
                score = round(min(1.0, sum(x * w.get(k, 0) for k, x in v.items()) / (norm(v) * norm(w))), 6) if v else 0
                if score >= least:
                    found.append((-score, name))
        return min(found, default=None)

    best = [own(t) for _, _, t, _ in files]
    parent = lambda p: p.rpartition("/")[0]
    roots = {}
    for (_, path, _, is_file), b in zip(files, best):
        if path is not None and is_file and b:
            roots[parent(path)] = min(roots.get(parent(path), b), b)
    out = []
    for (_, path, _, _), b in zip(files, best):
        if b:
            out.append((b[1], -b[0], "own", None))
            continue
        home = None if path is None else parent(path)
        while home is not None and home not in roots:
            home = parent(home) if home else None
        out.append((roots[home][1], None, "inherited", home) if home is not None else (None, None, None, None))
    return out


def test_licences_match_a_plain_computation(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [(0, "LICENSE", apache, True), (1, "a/LICENSE", "x\n" + mit, True), (2, "a/b/c.txt", "plain words", False)]
    files += [(3, "a.txt", None, False), (4, "a/d.txt", "// " + apache, False), (5, None, mit, True), (6, "z/y/x", "", False)]
    files += [(6, "z/y/x", "", False), (None, "a/b/LICENSE", "no licence here", True), (7, "a/e", "word " * 200_000, False)]
    frame = spark.createDataFrame([(*f, "x") for f in files], "doc_id long, path string, text string, is_licence_file boolean, licence string")
    got = Counter(tuple(r) for r in licences(frame).select("doc_id", "path", "licence", "score", "origin", "directory").collect())
    assert got == Counter((f[0], f[1], *e) for f, e in zip(files, plain_licences(files)))
    assert licences(frame.limit(0)).count() == 0


def test_licences_of_all_documents(spark):
    got = queries()["op10_licences"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    text = {d["doc_id"]: d["text"] for d in docs}
    files = [(r["doc_id"], r["path"], text[r["doc_id"]], r["doc_id"] % 100 == 0) for r in got]
    expected = plain_licences(files)
    assert [(r["licence"], r["origin"], r["directory"]) for r in got] == [(e[0], e[2], e[3]) for e in expected]


def test_every_query_on_empty_tables(spark, tmp_path):
    for name in ("documents", "embeddings", "pages", "conversations", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries().items():
        assert query(spark, str(tmp_path)).count() == (1 if name.startswith("op11_") else 0), name


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    known = stages["language_id"](spark, docs, SF)
    assert known.columns == names and known.count() >= 0.95 * docs.where("text rlike '[a-z]'").count()
    unique = stages["minhash_near_dedup"](spark, docs.union(docs.limit(20)), SF)
    kept = {r["doc_id"] for r in queries()["op6_dart_minhash"](spark, SF).where("kept").collect()}
    assert unique.columns == names and sorted(r["doc_id"] for r in unique.collect()) == sorted(kept)
    cut = stages["suffix_array_dedup"](spark, docs, SF)
    sizes = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in queries()["op5_deep_shallow"](spark, SF).collect()}
    assert cut.columns == names
    for r in cut.collect():
        left = len((r["text"] or "").encode())
        assert sizes[r["doc_id"]] - 16 <= left <= sizes[r["doc_id"]] and r["n_chars"] == (None if r["text"] is None else len(r["text"]))
    mixed = stages["source_mixing"](spark, docs, SF)
    taken = queries()["op4_waterfill"](spark, SF).agg(F.sum("taken")).first()[0]
    assert mixed.columns == names
    assert mixed.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == taken
    assert stages["best_fit_packing"](spark, mixed, SF).count() >= mixed.count()


def test_pipeline_stages_with_clashing_names(spark):
    """Columns named as the stages name their own come out unchanged."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = ["score", "lang_pred", "t1", "t2", "_id", "document", "row", "kept", "component_id", "node"]
    marked = docs.withColumns({name: F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")) for name in own})
    for name in ("language_id", "minhash_near_dedup"):
        stage = dict(corpus_pipeline.STAGES)[name]
        result = stage(spark, marked, SF)
        assert result.columns == marked.columns
        plain = sorted(map(str, stage(spark, docs, SF).collect()))
        rows = result.collect()
        assert all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in own)
        assert sorted(map(str, result.select(*docs.columns).collect())) == plain


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""


def test_notices_wherever_they_stand(spark):
    wrap = lambda text, width: "\n".join(" * " + line for line in textwrap.wrap(text, width))
    filler = "some words before and after that say nothing "
    texts = {
        "MIT License": "MIT",
        "MIT License\n\nCopyright (c) 2024 The Authors\n\n" + MIT: "MIT",
        " ".join(MIT.split()): "MIT",
        wrap(MIT, 40): "MIT",
        filler * 400 + MIT.replace("\n", " ") + filler * 400: "MIT",
        "Copyright 2024 The Example Authors. All rights reserved. Released under the MIT License.": "MIT",
        "// SPDX-License-Identifier: Apache-2.0\nint main;": "Apache-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "SPDX-License-Identifier: MIT-0": None,
        wrap(GPL.format(3), 30): "GPL-3.0",
        filler + " ".join(GPL.format(2).split()) + filler: "GPL-2.0",
        "GNU GENERAL PUBLIC LICENSE": "GPL-1.0-or-later",
        "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nEveryone may copy it.": "GPL-3.0",
        "GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007": "LGPL-3.0",
        "Licensed under\nthe Apache License,\nVersion 2.0.": "Apache-2.0",
        "The license of the software is not known to us": None,
        "license " * 5_000: None,
        filler * 3_000: None,
    }
    files = [(i, f"{i}/x", text, False) for i, text in enumerate(texts)]
    got = licences(spark.createDataFrame(files, "doc_id long, path string, text string, is_licence_file boolean")).collect()
    assert {r["doc_id"]: r["licence"] for r in got} == dict(enumerate(texts.values()))


def test_sample_of_rows_that_tie(spark, monkeypatch):
    monkeypatch.setattr(bytecnn, "train", lambda windows, numbers, labels: (Counter(labels[i] for i in numbers), windows.tobytes()))
    rows = [(None, f"text {'abcdefghij'[i % 10]} {i}", "en") for i in range(4_000)]
    rows += [(1, "one and the same", "fr")] * 3_000 + [(None, f"wort {i}", "de") for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts, windows = fit(frame)
    assert counts == {"en": bytecnn.SAMPLE // 3, "fr": bytecnn.SAMPLE // 3, "de": 10}
    assert fit(frame.repartition(7)) == (counts, windows)
