"""Repeat removal against a dictionary of all windows; the sort against sorted()."""

import hashlib
import random
from collections import Counter

import pytest
from lotforge.llm import deepshallow
from lotforge.llm.deepshallow import deep_shallow_sort, without_repeats
from lotforge.llm.queries import queries

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = b"\x01" * length
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.append((len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string, n_bytes_in string, h long")
    got = without_repeats(frame.select("doc_id", "text", "row", "h"), **settings)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got.collect())
    expected = brute([r[1] for r in rows], settings.get("length", 200))
    assert got == Counter((r[0], *e) for r, e in zip(rows, expected))


def test_all_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = queries()["op5_deep_shallow"](spark, SF).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == {d["doc_id"]: e for d, e in zip(docs, brute([d["text"] for d in docs], 200))}


def some_rows(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(60), text(90), "a" * 700, text(45)]
    rows = [(None, None, "r", "x", 1), (5, "", "r", None, 2), (6, "short", None, "x", None)]
    for i in range(40):
        parts = [text(rng.randint(0, 80)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared)[rng.randint(0, 40) :])
        rows.append((i, rng.choice("xyz").join(parts), "r", "x", i))
    return rows + rows[10:13] * 2 + [(99, "a" * 1500, "r", "x", 0), (100, text(150) * 2, "r", "x", 0)]


@pytest.mark.parametrize("few,crowd", [(24, 2048), (0, 2048), (24, 4)])
def test_hard_texts_whichever_way_a_group_is_settled(spark, monkeypatch, few, crowd):
    if few == 0:  # the forked workers read the module, so the sort itself is compared here
        monkeypatch.setattr(deepshallow, "FEW", 0)
    compare(spark, some_rows(crowd + few), length=200, gram=64, crowd=crowd)


def test_a_text_longer_than_one_pass(spark):
    rng = random.Random(1)
    filler = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000))
    passage = filler[524_100:524_900]
    rows = [(1, filler, "r", "x", 1), (2, "z" + passage + "z", "r", "x", 2)]
    compare(spark, rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, extra string")
    assert without_repeats(frame).count() == 0


def test_kept_text_has_no_halved_character(spark):
    common = "é" * 150
    rows = [(1, "x" + common + "y"), (2, "z" + common + "w")]
    got = without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_text=True).collect()
    assert {r["doc_id"]: r["kept"] for r in got} == {1: "xy", 2: "zw"}


def test_both_ways_of_finding_windows_agree():
    rng = random.Random(3)
    for _ in range(200):
        gram = bytes(rng.choice(b"ab") for _ in range(4))
        spans, back, more = [], [], []
        for _ in range(rng.randint(2, 9)):
            before = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6)))
            after = bytes(rng.choice(b"ab") for _ in range(6))
            m = rng.randint(0, len(before))
            spans.append((before + gram + after)[: m + 10])
            back.append(len(before))
            more.append(m)
        keep = [i for i in range(len(spans)) if len(spans[i]) == more[i] + 10 and spans[i][back[i] : back[i] + 4] == gram]
        unique = list({(spans[i], back[i], more[i]): i for i in keep}.values())
        if len(unique) < 2:
            continue
        args = [[x[i] for i in unique] for x in (spans, back, more)] + [[1] * len(unique), 10, 4]
        flat = lambda found: [{w for a, b in runs for w in range(a, b + 1)} for runs in found]
        assert flat(deepshallow._few_windows(*args)) == flat(deepshallow.repeated_windows(*args))


def test_sort_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(300):
        strings = [b"gg" + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 30))]
        strings += [b"gg" + b"a" * 60, b"gg" + b"a" * 61, strings[0]]
        order, lcp = deep_shallow_sort(strings, 2, 3)
        placed = [strings[i] for i in order]
        assert placed == sorted(strings) and sorted(order) == list(range(len(strings)))
        for x, y, n in zip(placed, placed[1:], lcp[1:]):
            assert x[:n] == y[:n] and x[n : n + 1] != y[n : n + 1] or x == y and n == len(x)
