"""Alignment of the token ids of two tokenizers over the same text.

The cumulative byte ends of both sides' tokens go into dictionaries from end to index; the ends that
both dictionaries hold, sorted, slice both id lists into groups, and inside a slice the tokens that
end with it are linked. With the two vocabularies at hand, A byte-level BPE and B sentencepiece BPE
with byte fallback, both merge inside a word only: where a single space stands between two characters
that are not white space, both start a token. A text is therefore aligned word by word, and a word
once for all its occurrences while the memory of a task holds it.

A linked pair ends at one byte, so the bytes of one token are a suffix of the other's. All pairs that
can ever be linked follow from the two vocabularies alone (324,299 here), whatever the corpus; they
are numbered, and the corpus-wide count of each is one number in an array of that size, which every
task gets. Per document only the pairs' numbers are kept, in a table, until the counts are known.

Texts that are null, empty, or whose joined bytes of either side differ from space and text have no
tokens: zeros and an empty groups_sha256. Repeated rows are separate documents and each counts. A
null doc_id stays null. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import stored

#: Words that a task's memory holds, and the longest that it takes; the same for parts of words.
_MEMORY, _LONGEST = 3 << 17, 48
#: Characters of a piece of a long text, and documents that pass together.
_PIECE, _DOCS = 1 << 18, 512
#: A single space between characters that no tokenizer takes for white space.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Letters up to U+024F, digits and ASCII marks but the apostrophe, which begins contractions. A word
#: of these and of single line feeds splits into A's parts where the kind changes.
_LETTERS, _MARKS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS}](?:[{_LETTERS}0-9{_MARKS}]|\n(?=[{_LETTERS}0-9{_MARKS}]))*")
_PARTS = re.compile(f" ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n")


def byte_letters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: itself if visible in
    Latin-1, else one of those from U+0100 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(byte) if byte in visible else chr(next(hidden)) for byte in range(256)]


class Tokenizers:
    """Both sides with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        self.written = {byte: letter for byte, letter in enumerate(letters)}
        as_byte = {letter: byte for byte, letter in enumerate(letters)}
        size = max(self.a.get_vocab().values()) + 1
        self.bytes_a: list[bytes] = [b""] * size
        for token, number in self.a.get_vocab().items():
            self.bytes_a[number] = bytes(as_byte[c] for c in token)
        self.bytes_b = [self._piece(number) for number in range(self.b.get_piece_size())]
        if any(b" " in piece.lstrip(b" ") for piece in self.bytes_b):
            raise ValueError("a piece of B goes on after a space, so its words depend on each other")
        self.parts: dict[str, list[int]] = {}

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def _part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            written = part.encode().decode("latin-1").translate(self.written)
            ids = [token.id for token in self.a.model.tokenize(written)]
            if len(part) <= _LONGEST:
                if len(self.parts) >= _MEMORY:
                    self.parts.clear()
                self.parts[part] = ids
        return ids

    def ids_a(self, words: list[str]) -> list[list[int]]:
        """A's ids of a space and each word."""
        result: list[list[int]] = []
        rest = []
        for place, word in enumerate(words):
            if _PLAIN.fullmatch(word):
                parts = _PARTS.findall(" " + word)
                result.append(self._part(parts[0]) if len(parts) == 1 else [x for part in parts for x in self._part(part)])
            else:
                result.append([])
                rest.append(place)
        encoded = self.a.encode_batch([" " + words[place] for place in rest], add_special_tokens=False)
        for place, encoding in zip(rest, encoded):
            result[place] = encoding.ids
        return result

    def ids_b(self, words: list[str]) -> list[list[int]]:
        """B's ids of each word; B itself adds the space."""
        return self.b.encode(words, num_threads=1) if words else []


    def give_back(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether the bytes of both sides are those of space and text."""
        whole = b" " + text.encode()
        return all(b"".join([table[x] for x in ids]) == whole for table, ids in ((self.bytes_a, a), (self.bytes_b, b)))


def linkable(tokens: Tokenizers) -> np.ndarray:
    """All pairs that can end together, as sorted numbers a * size(B) + b."""
    by_bytes: dict[bytes, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
    for side, table in enumerate((tokens.bytes_a, tokens.bytes_b)):
        for number, token in enumerate(table):
            by_bytes[token][side].append(number)
    size, pairs = len(tokens.bytes_b), set()
    for a, token in enumerate(tokens.bytes_a):
        for cut in range(len(token) + 1):
            pairs.update(a * size + b for b in by_bytes[token[cut:]][1] if token[cut:] in by_bytes)
    for b, token in enumerate(tokens.bytes_b):
        for cut in range(len(token) + 1):
            pairs.update(a * size + b for a in by_bytes[token[cut:]][0] if token[cut:] in by_bytes)
    return np.array(sorted(pairs), dtype=np.int64)


class Word(NamedTuple):
    a: int
    b: int
    groups: int
    text: bytes
    #: Numbers of the linked pairs, 32 bits each.
    links: bytes
    #: White space at an edge (or an empty word): the spaces beside it are not between words.
    edge: bool
    #: The bytes of a side are not the word's. Both sides write every character by itself, so the
    #: bytes of a text with such a word are not the text's either.
    odd: bool


class Text:
    """What is known of a text so far."""

    def __init__(self) -> None:
        self.a = self.b = self.groups = 0
        self.digest = hashlib.sha256()
        self.links: list[bytes] = []
        self.odd = False

    def add(self, words: list[str], found: list[Word]) -> None:
        if self.groups:
            self.digest.update(b";")
        self.a += sum([w.a for w in found])
        self.b += sum([w.b for w in found])
        self.groups += sum([w.groups for w in found])
        self.digest.update(b";".join([w.text for w in found]))
        self.links.append(b"".join([w.links for w in found]))
        self.odd = self.odd or any([w.odd for w in found])


class Aligner:
    """Alignment of whole texts, a word at a time."""

    def __init__(self, path_a: str, path_b: str):
        self.tokens = Tokenizers(path_a, path_b)
        self.pairs = linkable(self.tokens)
        self.words: dict[str, Word] = {}
        tables = self.tokens.bytes_a, self.tokens.bytes_b
        self.lengths = [np.array([len(token) for token in table]) for table in tables]
        #: Ids as text with what follows them inside a group and at the end of their side of it.
        self.inside = [np.array([b"%d," % i for i in range(len(table))], dtype=object) for table in tables]
        self.closing = [
            np.array([b"%d%s" % (i, mark) for i in range(len(table))], dtype=object)
            for table, mark in zip(tables, (b"|", b";"))
        ]

    def _learn(self, words: list[str]) -> dict[str, Word]:
        """Entries of new words, aligned in one go over their bytes in a row."""
        tokens = self.tokens
        ids = tokens.ids_a(words), tokens.ids_b(words)
        odd = [False] * len(words)
        if not tokens.give_back(" ".join(words), *(list(chain.from_iterable(side)) for side in ids)):
            odd = [not tokens.give_back(*of_word) for of_word in zip(words, *ids)]
            ids = tuple([[] if o else of_word for o, of_word in zip(odd, side)] for side in ids)
        counts = [np.fromiter(map(len, side), np.int64, len(words)) for side in ids]
        flat = [np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in zip(ids, counts)]
        ends = [np.cumsum(table[side]) for table, side in zip(self.lengths, flat)]
        places = [{end: index for index, end in enumerate(side.tolist())} for side in ends]
        shared = sorted(places[0].keys() & places[1].keys())
        common = np.array(shared, dtype=np.int64)
        last = [np.array([index[end] for end in shared], dtype=np.int64) for index in places]
        codes = flat[0][last[0]] * len(tokens.bytes_b) + flat[1][last[1]]
        links = np.searchsorted(self.pairs, codes).astype("<i4").tobytes()
        # a group is written as its ids of A, then those of B
        group = [np.searchsorted(common, side) for side in ends]
        before = [np.r_[0, last[1] + 1], last[0] + 1]  # tokens of the other side written earlier
        parts = np.empty(len(flat[0]) + len(flat[1]), dtype=object)
        for side in (0, 1):
            written = self.inside[side][flat[side]]
            written[last[side]] = self.closing[side][flat[side][last[side]]]
            parts[np.arange(len(flat[side])) + before[side][group[side]]] = written
        parts = parts.tolist()
        sums = [np.r_[0, np.cumsum(n)] for n in counts]
        cuts = (sums[0] + sums[1]).tolist()
        borders = np.searchsorted(last[0], sums[0]).tolist()  # of groups, by word
        n_a, n_b = (n.tolist() for n in counts)
        result = {}
        for i, word in enumerate(words):
            first, end = borders[i], borders[i + 1]
            text = b"".join(parts[cuts[i] : cuts[i + 1]])[:-1]
            edge = not word or word[0].isspace() or word[-1].isspace()
            result[word] = Word(n_a[i], n_b[i], end - first, text, links[4 * first : 4 * end], edge, odd[i])
        return result

    def _find(self, lists: list[list[str]]) -> list[list[Word]]:
        known = self.words
        if len(known) >= _MEMORY:
            known.clear()
        new = list(set().union(*lists).difference(known))
        known.update(self._learn(new))
        found = [list(map(known.__getitem__, words)) for words in lists]
        for word in new:
            if len(word) > _LONGEST:
                del known[word]
        return found

    def _align(self, pieces: list[tuple[Text, str]]) -> None:
        lists = [piece.split(" ") for _, piece in pieces]
        found = self._find(lists)
        again = [n for n, words in enumerate(found) if any([w.edge for w in words])]
        if again:
            for n in again:
                lists[n] = _BETWEEN.split(pieces[n][1])
            for n, words in zip(again, self._find([lists[n] for n in again])):
                found[n] = words
        for (text, _), words, entries in zip(pieces, lists, found):
            text.add(words, entries)

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """(tokens of A, of B, groups, hash of the groups, numbers of the linked pairs) of each
        text; they pass in pieces, cut between words, so that a very long one needs no more lists
        of words than others."""
        results = [Text() for _ in texts]
        pieces, size = [], 0
        for result, piece in _pieces(results, texts):
            pieces.append((result, piece))
            size += len(piece)
            if size >= _PIECE:
                self._align(pieces)
                pieces, size = [], 0
        self._align(pieces)
        for result, text in zip(results, texts):
            if not text or result.odd:
                yield 0, 0, 0, "", np.zeros(0, "<i4")
            else:
                links = np.frombuffer(b"".join(result.links), dtype="<i4")
                yield result.a, result.b, result.groups, result.digest.hexdigest(), links


def _pieces(results: list[Text], texts: list[str | None]) -> Iterator[tuple[Text, str]]:
    for result, text in zip(results, texts):
        start = 0
        while text and len(text) - start > 2 * _PIECE:
            cut = _BETWEEN.search(text, start + _PIECE)
            if not cut:
                break
            yield result, text[start : cut.start()]
            start = cut.end()
        if text:
            yield result, text[start:]


# --- in Spark ------------------------------------------------------------------------------------

_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("tally", pa.bool_()),
    ]
)
_ROW_DDL = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " pairs array<int>, times array<int>, tally boolean"
)
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _texts(column: pa.Array) -> list[str | None]:
    """Texts; one that isn't UTF-8 can't be given back by tokens and counts as null."""
    result: list[str | None] = []
    for raw in column.cast(pa.binary()).to_pylist():
        try:
            result.append(None if raw is None else raw.decode())
        except UnicodeDecodeError:
            result.append(None)
    return result


def _tokenise(path_a: str, path_b: str):
    """Rows of documents with their distinct pairs, then rows of the task's counts by pair."""

    def rows(columns: list[list], pairs: list[np.ndarray], times: list[np.ndarray], tally: bool) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(columns, _ROW.types)]
        cuts = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
        for lists in (pairs, times):
            values = np.concatenate(lists) if lists else np.zeros(0)
            arrays.append(pa.ListArray.from_arrays(cuts, pa.array(values.astype(np.int32))))
        arrays.append(pa.array([tally] * len(pairs)))
        return pa.RecordBatch.from_arrays(arrays, schema=_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ALIGNERS.get((path_a, path_b)) or _ALIGNERS.setdefault((path_a, path_b), Aligner(path_a, path_b))
        counts, held = np.zeros(len(aligner.pairs), dtype=np.int64), 0

        def told() -> pa.RecordBatch:
            some = np.flatnonzero(counts)
            return rows([[None]] * 6, [some], [counts[some]], True)

        for batch in batches:
            for start in range(0, batch.num_rows, _DOCS):
                part = batch.slice(start, _DOCS)
                columns: list[list] = [[], [], [], [], []]
                pairs, times = [], []
                for a, b, groups, digest, links in aligner.texts(_texts(part.column("text"))):
                    which, often = np.unique(links, return_counts=True)
                    counts[which] += often
                    held += len(links)
                    pairs.append(which)
                    times.append(often)
                    for column, value in zip(columns, (a, b, groups, len(links), digest)):
                        column.append(value)
                yield rows([part.column("doc_id").to_pylist(), *columns], pairs, times, False)
                if held >= 1 << 30:
                    yield told()
                    counts[:], held = 0, 0
        yield told()

    return run


def _weigh(shared):
    """Sums over each document's links of what the corpus says of their pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            cuts = batch.column("pairs").offsets.to_numpy()
            pairs = batch.column("pairs").values.to_numpy()
            times = batch.column("times").values.to_numpy()[batch.column("times").offsets[0].as_py() :]
            pairs, cuts = pairs[cuts[0] : cuts[-1]], cuts - cuts[0]
            times = times[: len(pairs)].astype(np.int64)
            sums = [np.r_[0, np.cumsum(values[pairs] * times)] for values in (best, counts)]
            keep = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(s[cuts[1:]] - s[cuts[:-1]]) for s in sums)],
                names=[*keep, "n_best", "count_sum"],
            )

    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    `path_a` and `path_b` are vocabulary files that the driver and every executor can read."""
    spark = docs.sparkSession
    aligned = stored(docs.select("doc_id", "text").mapInArrow(_tokenise(path_a, path_b), _ROW_DDL), "aligned")
    tokens = Tokenizers(path_a, path_b)
    pairs, size = linkable(tokens), len(tokens.bytes_b)
    told = aligned.where("tally").select(F.inline(F.arrays_zip("pairs", "times")))
    totals = told.groupBy("pairs").agg(F.sum("times").alias("n")).toArrow()  # at most one row per linkable pair
    counts = np.zeros(len(pairs), dtype=np.int64)
    counts[totals.column("pairs").to_numpy()] = totals.column("n").to_numpy()
    highest = np.zeros(size, dtype=np.int64)
    np.maximum.at(highest, pairs % size, counts)
    best = (counts == highest[pairs % size]).astype(np.int64)
    shared = spark.sparkContext.broadcast((counts, best))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return (
        aligned.where("not tally")
        .select(*names, "groups_sha256", "pairs", "times")
        .mapInArrow(_weigh(shared), ", ".join(f"{n} long" for n in names) + ", groups_sha256 string, n_best long, count_sum long")
        .select(*names, "n_best", "count_sum", "groups_sha256")
    )


def public_paths() -> tuple[str, str]:
    """Paths of the public vocabularies; the package that holds them is installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
