"""Alignment word by word against whole texts, encoded at once and compared by byte ends."""

import hashlib
import random
from collections import Counter

import pytest
from lotforge.llm import alignment
from lotforge.llm.alignment import Aligner, align_documents, public_paths
from lotforge.llm.queries import queries

SF = "/root/testdata/sf0.001"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Whole:
    """Both encodings of a whole text, its groups and its links, without any cutting."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        a, b = public_paths()
        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        letters = {c: i for i, c in enumerate(alignment.byte_letters())}
        self.bytes_a = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab().items()}

    def bytes_b(self, number):
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def align(self, text):
        if not text:
            return 0, 0, "", []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        parts = [self.bytes_a[i] for i in a], [self.bytes_b(i) for i in b]
        if any(b"".join(p) != b" " + text.encode() for p in parts):
            return 0, 0, "", []
        ends_a, ends_b = ([sum(map(len, p[: i + 1])) for i in range(len(p))] if len(p) < 300 else self.sums(p) for p in parts)
        common = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for end in common:
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        at_b = dict(zip(ends_b, b))
        return len(a), len(b), ";".join(groups), [(t, at_b[e]) for t, e in zip(a, ends_a) if e in at_b]

    @staticmethod
    def sums(parts):
        at, result = 0, []
        for p in parts:
            at += len(p)
            result.append(at)
        return result

    def documents(self, texts):
        found = [self.align(t) for t in texts]
        counts = Counter(pair for *_, links in found for pair in links)
        highest = Counter()
        for (_, b), n in counts.items():
            highest[b] = max(highest[b], n)
        for n_a, n_b, groups, links in found:
            sha = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            best = sum(counts[p] == highest[p[1]] for p in links)
            yield n_a, n_b, groups.count(";") + bool(n_a), len(links), best, sum(counts[p] for p in links), sha


@pytest.fixture(scope="module")
def whole():
    return Whole()


def found(frame):
    return Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in frame.collect())


def test_all_documents(spark, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter((d["doc_id"], *row) for d, row in zip(docs, whole.documents([d["text"] for d in docs])))
    assert found(queries()["op12_token_alignment"](spark, SF)) == expected


def test_nulls_odd_texts_long_texts_and_repeated_rows(spark, whole):
    rows = [(1, None), (2, ""), (3, " "), (4, "a▁b c"), (5, "▁ x"), (6, "x <|endoftext|> <s> </s> <unk> <0x41>")]
    rows += [(7, "same text"), (7, "same text"), (None, "same  text\n\n \tof \x00 it "), (8, "é" * 3000), (9, "a b " * 40_000)]
    rows += [(10, "\U0001f600 ́½ﬁ 你好"), (11, "x" * 20_000), (12, " " * 500 + "end")]
    expected = Counter((i, *row) for (i, _), row in zip(rows, whole.documents([t for _, t in rows])))
    assert sum(row[1] == 0 for row in expected) >= 4
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_a int, pairs string")
    assert found(align_documents(frame, *public_paths())) == expected
    assert align_documents(frame.limit(0), *public_paths()).count() == 0


def test_pieces_of_long_texts_and_a_full_memory(monkeypatch, whole):
    """Random mixtures of letters, marks, spaces and other scripts, cut into tiny pieces."""
    monkeypatch.setattr(alignment, "_PIECE", 20)
    monkeypatch.setattr(alignment, "_MEMORY", 50)
    draw = random.Random(5)
    some = "abSTtdr'’,.!?;:<|>_0123½²ªµß×÷ÀéÿŸŁſŉɏɐ \t\n\r\x0b\x1c\x1f\x85\xa0 　\x00\x7f\xad-你é\U0001f600"
    words = "'s 're 'LL d'été C'EST don't ,'s naïve a.\nB a\n\nB x, (y) 12th <|endoftext|> ▁ ½x ...".split(" ")
    texts = ["".join(draw.choice(some) for _ in range(draw.randrange(40))) for _ in range(3000)]
    texts += ["".join(draw.choice(words) + draw.choice([" ", " ", "", "  ", "\n"]) for _ in range(30)) for _ in range(500)]
    aligner = Aligner(*public_paths())
    for text, (n_a, n_b, n_groups, digest, links) in zip(texts, aligner.texts(texts)):
        a, b, groups, pairs = whole.align(text)
        assert (n_a, n_b, n_groups) == (a, b, groups.count(";") + bool(a)), text
        assert digest == (hashlib.sha256(groups.encode()).hexdigest() if a else ""), text
        size = len(aligner.tokens.bytes_b)
        assert [divmod(int(aligner.pairs[x]), size) for x in links] == pairs, text
