"""Best-fit packing by linear grouping.

Documents become token counts in Spark; only the histogram of piece lengths, at most `capacity`
numbers whatever the input, is planned on the driver:

* lengths above `small` are sorted and cut into groups of equal cardinality, each rounded up to
  its longest member, so that a few sizes are left;
* the best multiset of configurations (what fits into one sequence) for these sizes is the
  cutting-stock linear programme, solved by column generation and rounded down;
* each slot of a configuration takes an actual length of its group, and the last slot the longest
  piece that still fits, which uses up the room that rounding had set aside;
* what is left, and all small pieces, go best-fit decreasing into that room, then into new
  sequences.

The plan is a list of runs: the pieces of one length and a range of ranks go, one each, into
consecutive sequences at one offset. A distributed rank within the length and one join apply it.

A null or empty text is one piece with the end token alone. Equal rows are separate documents.
An empty table gives an empty result. Pieces longer than a sequence do not exist: documents are
cut into full pieces and a rest.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import stored, with_position

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Letters up to U+017F in lower case.
_LETTER = "a-zªµºß-öø-\u017f"
#: Texts with a character above that, a space that the tokenizer's pattern does not know, a capital
#: whose lower case is two characters, or the start of a special token are encoded whole.
_ODD = re.compile("[\x1c-\x1f\u0130\u0180-\U0010ffff]|<\\|")
#: Where these end, a token of the vocabulary's pattern ends: letters; a run without letters and
#: apostrophes; a run with an apostrophe and the letters behind it, which may be a contraction.
_PART = re.compile(f"[{_LETTER}]+|[^\\s{_LETTER}']+(?![^\\s{_LETTER}])|[^\\s{_LETTER}]+[{_LETTER}]*")
#: Parts that the per-task memory of encoded parts holds, and the longest that it takes.
_MEMORY, _LONGEST = 1 << 19, 64


def _byte_letters() -> list[str]:
    """The character that a byte-level vocabulary writes for each byte: itself if visible in
    Latin-1, else one of those from U+0100 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(byte) if byte in visible else chr(next(hidden)) for byte in range(256)]


def word_vocabulary() -> str:
    """Path of the public vocabulary; the package that holds it is installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """Part of a text in lower case -> its ids as little-endian unsigned 32-bit bytes.

    The vocabulary lowers the text, drops white space and merges inside the tokens of its pattern
    only, so the ids of a text are those of its parts in a row; each part is encoded once while the
    memory holds it. Letters are one token of the pattern and go to the merges at once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))

    def encode(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, part: str) -> bytes:
        if part.isalpha():
            written = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            ids = _packed([token.id for token in self.merge(written)])
        else:
            ids = self.encode(part)
        if len(part) <= _LONGEST:
            if len(self) >= _MEMORY:
                self.clear()
            self[part] = ids
        return ids

    def text(self, text: str) -> bytes:
        if _ODD.search(text):
            return self.encode(text)
        return b"".join(map(self.__getitem__, _PART.findall(text.lower())))


def _cut(path: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(path)
        last = _packed([end])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = memoryview(ids_of.text(text or "") + last)
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


# --- planning on the histogram -------------------------------------------------------------------


def best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits (unbounded knapsack)."""
    worth, picked = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    array = np.array(sizes)
    for room in range(int(array.min()), capacity + 1):
        fits = array <= room
        options = np.where(fits, values + worth[np.where(fits, room - array, 0)], -1.0)
        best = int(options.argmax())
        worth[room], picked[room] = options[best], best
        if worth[room - 1] >= worth[room]:
            worth[room], picked[room] = worth[room - 1], -1
    counts, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if picked[room] < 0:
            room -= 1
            continue
        counts[picked[room]] += 1
        room -= sizes[picked[room]]
    return float(worth[capacity]), counts


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, rounds: int = 300) -> list[tuple[np.ndarray, int]]:
    """(counts by size, times) from the cutting-stock programme, times rounded down."""
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-7:
            break
        level, change = np.linalg.solve(basis, np.c_[demand, column]).T
        ratio = np.where(change > 1e-9, np.maximum(level, 0) / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    level = np.linalg.solve(basis, demand)
    times = np.floor(level + 1e-6).astype(np.int64)
    return [(basis[:, i].astype(np.int64), int(n)) for i, n in enumerate(times) if n > 0]


class Plan:
    """Runs (length, first rank, pieces, first sequence, offset) and the room that is left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left, self.rank = capacity, dict(counts), dict.fromkeys(counts, 0)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.runs.append((length, self.rank[length], count, sequence, offset))
        self.rank[length] += count
        self.left[length] -= count

    def substitute(self, pools: list[list[int]], pattern: np.ndarray, times: int) -> None:
        """`times` sequences of one configuration. Every slot but the last takes actual lengths of
        its group; the last takes the longest piece that the room now holds, which is no shorter
        than the group's while there are any, and gives the rounding of all slots back."""
        slots = [group for group, n in enumerate(pattern) for _ in range(n)]
        first = sum(self.left[x] for x in pools[slots[0]])
        times = min(times, first // int(pattern[slots[0]]))
        held = [(self.open(times), times, 0)] if times else []
        for group in slots[:-1]:
            filled = []
            for start, count, used in held:
                for length in pools[group]:
                    n = min(count, self.left[length])
                    if n:
                        self.put(length, n, start, used)
                        filled.append((start, n, used + length))
                        start, count = start + n, count - n
                if count:  # an earlier configuration took from this group
                    filled.append((start, count, used))
            held = filled
        for start, count, used in held:
            length = min(self.capacity - used, self.capacity - 1)
            while count and length:
                n = min(count, self.left.get(length, 0))
                if n:
                    self.put(length, n, start, used)
                    self.room[self.capacity - used - length].append((start, n))
                    start, count = start + n, count - n
                length -= 1
            if count:
                self.room[self.capacity - used].append((start, count))

    def best_fit(self) -> None:
        """All pieces that are left, longest first, each into the least room that holds it."""
        for length in sorted(self.left, reverse=True):
            room = length
            while self.left[length]:
                while room <= self.capacity and not self.room[room]:
                    room += 1
                if room > self.capacity:
                    each = self.capacity // length
                    whole, rest = divmod(self.left[length], each)
                    for count, pieces in ((whole, each), (1, rest)):
                        if count and pieces:
                            start = self.open(count)
                            for slot in range(pieces):
                                self.put(length, count, start, slot * length)
                            self.room[self.capacity - pieces * length].append((start, count))
                    break
                start, count = self.room[room].pop()
                n = min(count, self.left[length])
                self.put(length, n, start, self.capacity - room)
                if count > n:
                    self.room[room].append((start + n, count - n))
                self.room[room - length].append((start, n))
                room = length


def linear_grouping(counts: dict[int, int], capacity: int, small: int, groups: int) -> Plan:
    """Plan for `counts` pieces by length. `small` and `groups` set precision and driver time."""
    plan = Plan({k: v for k, v in counts.items() if v > 0}, capacity)
    full = plan.left.get(capacity, 0)
    if full:
        plan.put(capacity, full, plan.open(full), 0)
    large = sorted((x for x in plan.left if small < x < capacity), reverse=True)
    if large:
        each = -(-sum(plan.left[x] for x in large) // groups)
        pools: list[list[int]] = []
        sizes: list[int] = []
        demand: list[int] = []
        for length in large:  # a length on a border counts with the longer group
            if not pools or demand[-1] >= each:
                pools.append([])
                sizes.append(length)
                demand.append(0)
            pools[-1].append(length)
            demand[-1] += plan.left[length]
        for pattern, times in configurations(sizes, np.array(demand, dtype=float), capacity):
            plan.substitute(pools, pattern, times)
    plan.best_fit()
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 1, small: int = 768, groups: int = 32) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. `tokenizer` is the path of a vocabulary file that every executor can read."""
    pieces = stored(docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, end, capacity), PIECE), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = linear_grouping(counts, capacity, small, groups).runs
    placed = docs.sparkSession.createDataFrame(
        runs, "length long, first long, pieces long, sequence long, offset long"
    )
    if len(runs) <= 1 << 17:  # 5 MB
        placed = F.broadcast(placed)
    ranked = with_position(pieces, "length", ["doc_id", "piece", "start", "ids_crc32"], "rank")
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("pieces"))
    return (
        ranked.join(placed.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & inside)
        .withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )
