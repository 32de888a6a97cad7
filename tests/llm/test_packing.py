"""Packing: every token once, nothing too long, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
from lotforge.llm import lingroup
from lotforge.llm.lingroup import WordIds, linear_grouping, pack, word_vocabulary
from lotforge.llm.queries import queries

SF = "/root/testdata/sf0.001"


def ids_of(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for t in texts]


def check(rows, docs, capacity):
    expected = Counter()
    for (doc_id, _), ids in zip(docs, ids_of([t for _, t in docs])):
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[doc_id, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(r["length"] for r in rows) // capacity)


def test_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    used, least = check(queries()["op9_linear_grouping"](spark, SF).collect(), docs, 4096)
    assert used <= least * 1.02 + 1


def test_nulls_long_texts_ties_and_repeated_rows(spark):
    rows = [(1, None), (None, ""), (None, ""), (2, "house " * 30_000), (3, "a\x1cb c d"), (4, "x" * 5000)]
    rows += [(5, "a tree by the road")] * 300
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, length string, rank long")
    check(pack(frame, word_vocabulary(), 64, small=12, groups=8).collect(), rows, 64)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack(empty, word_vocabulary()).count() == 0


def test_plan_places_each_piece_once_in_few_sequences():
    rng = np.random.default_rng(0)
    for trial in range(20):
        lengths = Counter(np.minimum(1000, rng.lognormal(5, 1, 3000)).astype(int).clip(1).tolist())
        plan = linear_grouping(dict(lengths), 1000, 180, 16)
        placed, fill = Counter(), defaultdict(int)
        for length, first, count, sequence, offset in plan.runs:
            assert first == placed[length]
            placed[length] += count
            for s in range(sequence, sequence + count):
                assert fill[s] == offset
                fill[s] += length
        assert placed == lengths and max(fill.values()) <= 1000
        assert len(fill) <= -(-sum(k * n for k, n in lengths.items()) // 1000) * 1.02 + 1


def test_ids_of_parts_are_those_of_the_text():
    """Capitals, apostrophes, digits, odd spaces, other scripts, special tokens, random mixtures."""
    ids = WordIds(word_vocabulary())
    draw = random.Random(7)
    plain = "abSTtdr',.!<|>_0123½²ªµß×÷ÀéÿŸŁſŉ \t\n\x0b\x85\xa0\x00\x7f\xad-"
    odd = plain + "’€Σşİ\x1cć́漢"
    words = "'s 're 'LL d'été C'EST don't ,'s ('S) ''t 'tt ÀÉ_x a1b2 ½x <|endoftext|> x<|startoftext|>y".split()
    texts = ["", "naïve Œuvre, œuf: l'été's 12th", "ΣΑΣ", "é, x", "a" * 3000 + "'s"]
    texts += ["".join(draw.choice(odd if n % 4 == 0 else plain) for _ in range(n % 14)) for n in range(4000)]
    texts += ["".join(draw.choice(words) + draw.choice([" ", "", ","]) for _ in range(5)) for _ in range(1000)]
    for text in texts:
        assert ids.text(text) == ids.encode(text), text


def test_the_pipeline_sends_texts_in_small_batches(spark, monkeypatch):
    large, seen = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    cut = lingroup._cut

    def watched(*how):
        inner = cut(*how)

        def run(batches):
            def noted():
                for batch in batches:
                    seen.add(batch.num_rows)
                    large.add(int(batch.nbytes > 3_000_000))
                    yield batch

            yield from inner(noted())

        return run

    monkeypatch.setattr(lingroup, "_cut", watched)
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    assert corpus_pipeline.pack_sequences(spark, docs, SF).count() == 4000
    assert (seen.value, large.value) == (4000, 0)
