"""The filter audit against counting every order document by document."""

import re
from collections import Counter
from itertools import permutations

import pytest
from compare import connect, differences
from lotforge.llm.audit import audit
from lotforge.llm.queries import queries
from lotforge.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


def failures(rows, i):
    doc_id, text, _ = rows[i][:3]
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = ""
    if len(words) < 200:
        found += "A"
    if 100 * len(set(words)) < 50 * len(words):
        found += "B"
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        found += "C"
    if re.search("[#$%&*|]", text):
        found += "D"
    if doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows):
        found += "E"
    return found


def counted(rows, labels):
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    docs = [(r[2] or "", failures(rows, i), r[0]) for i, r in enumerate(rows)]
    result, shapley = {}, Counter()
    for part in {p for p, *_ in docs}:
        own = [(f, d) for p, f, d in docs if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[0]]
                left = [x for x in left if letter not in x[0]]
                shapley[part, letter] += len(gone)
                result[part, order, step] = (
                    len(left),
                    len(gone),
                    sum(letter in f for f, _ in own) - len(gone),
                    sum(f == letter for f, _ in own),
                    sum(d in good for _, d in gone),
                    sum(d in toxic for _, d in gone),
                )
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


def told(frame):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = frame.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


WORDS = " ".join(f"w{i}" for i in range(260))
ROWS = [
    (1, WORDS, "s"), (2, WORDS, "s"), (3, WORDS + " $", None), (4, "A B C a a a", "s"), (5, None, "t"), (6, "", "s"),
    (7, "\x0bword\r" * 300, "t"), (7, "\x0bword\r" * 300, "t"), (8, "\x0bword\r" * 300, "s"), (None, WORDS, "t"),
    (None, None, None), (9, "x\xa0y word " * 150, "t"), (10, "#" * 50_000, ""), (2, "other", "s"), (11, "É" * 300, "u"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (7, 1, None), (7, 0, 1), (None, 1, 1), (99, 1, 1), (6, None, None)]


def test_nulls_copies_repeated_rows_and_labels(spark):
    docs = spark.createDataFrame([(*r, 5, "x") for r in ROWS], "doc_id long, text string, source string, n int, part string")
    marks = spark.createDataFrame([(*r, "y") for r in LABELS], "doc_id long, quality int, toxic int, source string")
    assert told(audit(docs, marks)) == counted(ROWS, LABELS)
    assert told(audit(docs, marks.limit(0))) == counted(ROWS, [])
    assert audit(docs.limit(0), marks).count() == 0


@pytest.mark.parametrize("against", ["sql", "orders"])
def test_all_documents(spark, against):
    result = queries()["op13_filter_audit"](spark, SF)
    if against == "sql":
        assert differences(result, connect(SF), ORACLE["op13_filter_audit"]) is None
        return
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert told(result) == counted(rows, labels)
