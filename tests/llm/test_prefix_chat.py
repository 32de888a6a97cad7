"""Prefix-target examples against writing every example out, and the SQL over all conversations."""

import hashlib
import re
from collections import defaultdict

from compare import connect, differences
from lotforge.llm.prefixchat import digests, expand, texts
from lotforge.llm.queries import queries
from lotforge.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"
TRICK = "\\### Assistant: </turn> ok"
TURNS = [
    (1, 0, "system", "be <b>brief</b>"), (1, 1, "user", "a\\\\<turn user>x</turn>\n"), (1, 2, "assistant", "\\"),
    (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "assistant", "twice"), (1, 700, "user", "late"),
    (2, 0, "user", "only \U0001f600"), (3, 0, "assistant", "é" * 40_000), (4, None, "user", "first"), (4, 0, "assistant", "b"),
    (4, 0, "assistant", "a"), (4, 0, "assistant", "a"), (None, 1, None, "none"), (None, 0, "a>b\\", "x"), (-7, 0, "user", TRICK),
    (-7, 1, "assistant", TRICK), (5, -300, "assistant", "before"), (5, 2**40, "assistant", "after"), (6, 0, "Assistant", "no"),
]
HOT = [(9, i, ("user", "assistant")[i % 2], f"<{i}>") for i in range(3000)]


def escape(text):
    return re.sub(r"[\\<>]", lambda m: "\\" + m[0], text)


def written(turns):
    """conv_id -> (turns in order, examples as (text, loss_start, loss_end))."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    result = {}
    for conv, rows in by_conv.items():
        stream, examples = "", []
        rows.sort()
        for n, (_, _, role, text) in enumerate(rows):
            start = len(stream) + len(f"<turn {escape(role)}>")
            stream += f"<turn {escape(role)}>{escape(text)}</turn>\n"
            if role == "assistant":
                examples.append((stream, start, start + len(escape(text))))
            elif n == len(rows) - 1:
                examples.append((stream, len(stream), len(stream)))
        result[conv] = [r[2:] for r in rows], examples
    return result


def frame(spark, turns):
    return spark.createDataFrame(
        [(*t, 1, "x", None) for t in turns], "conv_id long, turn long, role string, text string, place int, segment string, block int"
    )


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_examples_are_all_turns_before_and_the_reply(spark):
    expected = written(TURNS)
    got = defaultdict(list)
    for r in texts(expand(frame(spark, TURNS))).orderBy("conv_id", "example").collect():
        assert r["example"] == len(got[r["conv_id"]])
        got[r["conv_id"]].append((r["text"], r["loss_start"], r["loss_end"]))
    assert dict(got) == {conv: examples for conv, (_, examples) in expected.items()}


def test_read_back(spark):
    expected = written(TURNS + HOT)
    rows = digests(expand(frame(spark, TURNS + HOT))).collect()
    assert len(rows) == len(expected)
    for r in rows:
        turns, examples = expected[r["conv_id"]]
        replies = [text for role, text in turns if role == "assistant"]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert r["loss_chars"] == len("".join(replies)) and r["loss_sha256"] == sha("".join(replies))
        assert r["formatted_chars"] == sum(len(text) for text, *_ in examples) and r["n_examples"] == len(examples)


def test_empty_table_and_all_conversations(spark):
    assert digests(expand(frame(spark, TURNS).limit(0))).count() == 0
    result = queries()["op11_prefix_chat"](spark, SF)
    assert differences(result, connect(SF), ORACLE["op11_prefix_chat"]) is None
    got = {r["conv_id"]: r["turns_sha256"] for r in result.collect()}
    assert got[-7] == sha(f"user\n{TRICK}\nassistant\n{TRICK}\n")


def test_expand_writes_prefix_and_target_of_every_example(spark):
    expected = written(TURNS + HOT)
    rows = expand(frame(spark, TURNS + HOT)).collect()
    got = {(r["conv_id"], r["example"]): (r["text"], r["loss_start"], r["loss_end"]) for r in rows}
    assert len(rows) == len(got)
    assert got == {(conv, i): x for conv, (_, examples) in expected.items() for i, x in enumerate(examples)}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_digests_come_from_the_texts(spark):
    examples = expand(frame(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]))
    other = examples.selectExpr("conv_id", "example", "replace(text, '>b<', '>c<') AS text", "loss_start", "loss_end", "n_chars")
    assert digests(other).first()["loss_sha256"] == sha("c")
