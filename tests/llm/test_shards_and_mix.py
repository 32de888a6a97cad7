"""Hilbert sharding and source mixing against their laws and plain computations."""

import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lotforge.llm.hilbert import document_shards, hilbert_index
from lotforge.llm.queries import queries
from lotforge.llm.sql import ORACLE
from lotforge.llm.waterfill import mixed_documents, mixture, targets

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, curve string, size string"


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_the_grid(spark, dims, bits):
    n = 1 << (dims * bits)
    levels = F.array(*(F.expr(f"int(shiftright(id, {bits * i}) & {(1 << bits) - 1})") for i in range(dims)))
    rows = spark.range(n).select(levels.alias("x"), hilbert_index(levels, dims, bits).alias("at")).collect()
    cells = [r["x"] for r in sorted(rows, key=lambda r: r["at"])]
    assert sorted(r["at"] for r in rows) == list(range(n))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(cells, cells[1:]))


def check_shards(rows, docs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    runs = sorted((r["shard"], r["slot"], r["curve"]) for r in rows)
    assert [r[2] for r in runs] == sorted(r[2] for r in runs)


def test_shards_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    query = queries()["op2_hilbert"]
    rows = query(spark, SF).collect()
    check_shards(rows, docs, 40)
    assert sorted(map(str, rows)) == sorted(map(str, query(spark, SF).collect()))


HARD = (
    [(1, None, None, None, None, "c", "s"), (None, "", "", "", 0, None, None), (2, "a b", "en", "w", 3, "c", "s")] * 3
    + [(3, "word " * 200_000, "en", "w", 10**6, "c", "s")]
    + [(7, "same", "de", "hot", 4, "c", "s")] * 40
)


def test_shards_of_nulls_long_texts_and_repeated_rows(spark):
    rows = document_shards(spark.createDataFrame(HARD, SCHEMA), 7).collect()
    check_shards(rows, [r[:2] for r in HARD], 7)
    assert document_shards(spark.createDataFrame([], SCHEMA), 7).count() == 0


def test_mix_matches_the_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = db.execute(ORACLE["op4_waterfill"]).fetchall()
    names = [c[0] for c in db.description]
    got = queries()["op4_waterfill"](spark, SF).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def clamped(sizes, weights, budget, epochs):
    """Targets by repeated clamping."""
    stopped = set()
    while True:
        left = budget - sum(epochs * sizes[i] for i in stopped)
        free = sum(w for i, w in enumerate(weights) if i not in stopped)
        over = {i for i in range(len(sizes)) if i not in stopped and left * weights[i] / free > epochs * sizes[i]}
        if not over:
            return [epochs * sizes[i] if i in stopped else left * weights[i] / free for i in range(len(sizes))]
        stopped |= over


def test_targets_are_those_of_repeated_clamping(spark):
    sizes = [10, 1000, 30, 400, 5, 77, 0]
    frame = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = targets(frame, (5, 2, 1), (3, 2), 2).orderBy("source").collect()
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    assert [r["target"] for r in got] == pytest.approx(clamped(sizes, weights, sum(sizes) * 1.5, 2))


def test_mix_of_nulls_long_texts_and_repeated_rows(spark):
    frame = spark.createDataFrame(HARD, SCHEMA)
    rows = mixture(frame, weights=(5, 2, 1), share=(3, 2), epochs=2, seed=0).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((h[0], len((h[1] or "").split())) for h in HARD)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    again = mixed_documents(frame, weights=(5, 2, 1), share=(3, 2), epochs=2, seed=0)
    assert again.columns == frame.columns
    assert again.count() == sum(r["times"] for r in rows)
    assert mixture(spark.createDataFrame([], SCHEMA), weights=(5, 2, 1), share=(3, 2), epochs=2).count() == 0
