"""Near-duplicate classes of texts and vectors against all pairs, and exact search by SQL."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from lotforge.llm import dartminhash
from lotforge.llm.dartminhash import cells, near_duplicates, signatures
from lotforge.llm.pivots import near_vectors
from lotforge.llm.queries import queries
from lotforge.llm.sql import ORACLE
from lotforge.llm.vafile import top_k
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def shingles(text):
    for c in SPACE:
        text = (text or "").replace(c, " ")
    words = [w for w in text.split(" ") if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def classes(docs, least=0.8):
    """doc_id -> smallest doc_id of its class, from all pairs."""
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t), t or "") for i, t in docs]
    for n, (i, a, text) in enumerate(sets):
        for j, b, other in sets[:n]:
            if text == other and not a:
                continue
            total = sum((a | b).values())
            if a and b and sum((a & b).values()) >= least * total - 1e-12:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def test_classes_of_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries()["op6_dart_minhash"](spark, SF).collect()
    expected = classes([d for d in docs if shingles(d[1])])
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] in expected} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(docs)


def test_a_crowd_of_almost_near_texts(spark):
    rng = random.Random(0)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    docs = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((0, 1, 2, 3, 5))):
            words[at] = f"n{rng.randint(0, 10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(i, docs[7][1]) for i in range(200, 230)] + [(300, "few words"), (301, "few\twords"), (302, "x " * 300_000)]
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, node string, key long")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame).collect()}
    assert got == classes(docs)


def test_crowds_are_dealt_into_blocks(spark, monkeypatch):
    """Many texts around a few centres, most pairs just below the bound, in blocks of seven."""
    monkeypatch.setattr(dartminhash, "BLOCK", 7)
    rng = random.Random(3)
    docs = []
    for centre in range(3):
        base = [f"c{centre}w{i}" for i in range(150)]
        for i in range(70):
            words = list(base)
            for at in rng.sample(range(150), rng.choice((1, 2, 3, 4, 5, 6))):
                words[at] = f"n{rng.randint(0, 10**6)}"
            docs.append((centre * 1000 + i, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == classes(docs)


def test_nulls_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["doc_id"] in (3, 4)} == {3}
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    both = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "quite another text of six words")]
    got = near_duplicates(spark.createDataFrame(both, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(3, 3, True), (5, 3, False), (5, 5, True)]
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_signatures_estimate_the_similarity():
    a, b = "a b c d e f g h i j k l m n o p q r s t", "a b c d e f g h i j k l m n o p q r s z"
    doc, cell = cells([a.encode(), b.encode()])
    _, signature = signatures(doc, cell, 2, 4096)
    x, y = shingles(a), shingles(b)
    assert np.mean(signature[0] == signature[1]) == pytest.approx(sum((x & y).values()) / sum((x | y).values()), abs=0.04)


def database():
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    return db


@pytest.mark.parametrize("name", ["op3_va_file", "op7_pivots"])
def test_vectors_match_the_sql(spark, name):
    db = database()
    expected = db.execute(ORACLE[name]).fetchall()
    names = [c[0] for c in db.description]
    assert sorted(map(tuple, queries()[name](spark, SF).select(*names).collect())) == sorted(expected)


NAN = float("nan")
VECTORS = [(0, [1.0, 0.0], 1), (1, [1.0, 0.01], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [-1.0, 0.0], 1), (4, [1.0, 0.0], 2)]
VECTORS += [(5, None, 1), (6, [NAN, 1.0], 1), (7, [None, 1.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 1)]


def test_vectors_that_take_no_part(spark):
    frame = spark.createDataFrame([(*v, 1) for v in VECTORS], "vec_id long, embedding array<float>, label int, node long")
    got = near_vectors(frame, 0.93).collect()
    assert len(got) == len(VECTORS)
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}
    assert links[0] == (3, 0) and links[1] == (3, 0) and links[2] == (3, 0)
    assert all(links[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9))
    assert near_vectors(frame.limit(0), 0.93).count() == 0


def test_search_with_ties_and_too_few_rows(spark):
    frame = spark.createDataFrame([(*v, 1) for v in VECTORS], "vec_id long, embedding array<float>, label int, score long")
    got = top_k(frame, F.col("vec_id") == 0, k=3, scale=1024).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [
        (0, 1, 1, 1024 * 1024), (0, 2, 2, 1024 * 1024), (0, 3, 2, 1024 * 1024)
    ]
    assert top_k(frame.limit(0), F.col("vec_id") == 0, k=3, scale=1024).count() == 0


def test_pivots_find_planted_links_in_many_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(1500, 24))
    vectors = np.vstack([base, base[:500] + rng.normal(size=(500, 24)) * 0.25])
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(vectors)]
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    label = np.arange(2000) % 2
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None]) & ~np.eye(2000, dtype=bool)
    expected = linked.sum(axis=1)
    assert expected.sum() > 300
    assert sum(got.values()) >= 0.9 * expected.sum() and all(got[i] <= expected[i] for i in range(2000))
