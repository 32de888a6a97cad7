"""Exact repeats of a fixed byte length by sorting suffixes, the deep-shallow way.

A repeated string of 200 bytes starts at two places, and the smallest hashed 64-byte gram in it
(leftmost on ties) stands at the same offset in both. So only suffixes at such anchors, one in
about 70 bytes, have to be sorted, and only against suffixes that share their anchor gram:

1. Every anchor is written as a narrow row: gram hash, hash of the stretch its windows cover,
   text key and place. Anchors whose gram occurs once are dropped by a counted join.
2. Stretches that are equal as a whole repeat in full; one of each, with its count, goes on.
3. The distinct stretches of one gram are sorted, rightwards and leftwards from the anchor:
   multikey quicksort to a shallow depth behind the gram, then a blind trie for each group that
   still ties. The longest common prefixes of neighbours tell which windows occur twice.
4. A gram with more than `crowd` distinct stretches (a passage that very many documents share,
   at its borders) is not gathered: its windows become counted rows instead.

Rows with a null text count as empty. Texts shorter than `length` lose nothing. Equal rows count
as separate documents, so a text of at least `length` bytes that occurs twice loses every byte.
An empty table gives an empty result. Other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import content_key, stored
from lotforge.llm.grams import Rolling, U, mix, sliding_min

#: Bytes of text that one vectorised pass takes.
SEGMENT = 1 << 19
#: Rows of a batch that are looked at together.
ROWS = 1024
#: Depth behind the shared gram to which multikey quicksort goes before blind tries take over.
SHALLOW = 12
#: Up to so many stretches, comparing each two costs less than one pass per window offset.
FEW = 24
ANCHOR = "h long, s long, t1 long, t2 long, lo long, back int, more int"


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(buffer, begin of each piece in it, index of its text, place of the piece in its text).

    Long texts come in pieces that overlap by length - 1, so each window is in exactly one."""
    held, size = [], 0
    for index, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SEGMENT):
            piece = text[at : at + SEGMENT + length - 1]
            if len(piece) >= length:
                held.append((piece, index, at))
                size += len(piece)
            if size >= SEGMENT:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held):
    begins = np.cumsum([0, *(len(x[0]) for x in held)])
    return (
        np.frombuffer(b"".join(x[0] for x in held), dtype=np.uint8),
        begins,
        np.array([x[1] for x in held]),
        np.array([x[2] for x in held], dtype=np.int64),
    )


def anchors(texts: list[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, gram hash, stretch hash, first window, anchor - first window, windows - 1)."""
    width = length - gram + 1
    low = U((1 << 24) - 1)
    for buffer, begins, index, at in _segments(texts, length):
        rolling = Rolling(buffer)
        grams = rolling.every(gram)
        keyed = (grams & ~low) | np.arange(len(grams), dtype=U)
        chosen = (sliding_min(keyed, width) & low).astype(np.int64)
        edge = np.zeros(len(buffer) + 1, dtype=np.int8)
        edge[begins[:-1]] += 1
        edge[begins[1:] - length + 1] -= 1
        first = np.flatnonzero(np.cumsum(edge)[: len(chosen)] > 0)
        picked = chosen[first]
        new = np.flatnonzero(np.r_[True, (picked[1:] != picked[:-1]) | (first[1:] != first[:-1] + 1)])
        last = np.r_[new[1:], len(first)] - 1
        lo, hi, q = first[new], first[last], picked[new]
        shape = ((q - lo) << 16 | (hi - lo)).astype(U)
        stretch = mix(rolling.of(lo, hi + length) ^ mix(shape + U(1)))
        piece = np.searchsorted(begins, lo, side="right") - 1
        yield index[piece], grams[q], stretch, lo - begins[piece] + at[piece], q - lo, hi - lo


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _find(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            t1, t2 = batch.column("t1").to_numpy(), batch.column("t2").to_numpy()
            for index, h, s, lo, back, more in anchors(_bytes(batch.column("text")), length, gram):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(s.view(np.int64)),
                        pa.array(t1[index]),
                        pa.array(t2[index]),
                        pa.array(lo),
                        pa.array(back.astype(np.int32)),
                        pa.array(more.astype(np.int32)),
                    ],
                    names=["h", "s", "t1", "t2", "lo", "back", "more"],
                )

    return run


# --- sorting -----------------------------------------------------------------------------------


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix of a and b, known to be `start` at least."""
    most = min(len(a), len(b))
    if a[start:most] == b[start:most]:
        return most
    reach = 16
    while a[start : start + reach] == b[start : start + reach]:
        start += reach
        reach *= 2
    while reach > 1:  # the first difference lies in the next `reach` bytes
        reach //= 2
        if a[start : start + reach] == b[start : start + reach]:
            start += reach
    return min(start, most)


def _symbol(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def multikey_quicksort(strings: list[bytes], ids: list[int], depth: int, floor: int) -> Iterator[tuple[int, list[int]]]:
    """Yields, in sorted order, (depth, ids): one string, or several that agree on all symbols
    before `floor` or up to their common end."""
    stack = [(ids, depth)]
    while stack:
        ids, depth = stack.pop()
        if len(ids) == 1 or depth >= floor:
            yield depth, ids
            continue
        pivot = sorted(_symbol(strings[i], depth) for i in (ids[0], ids[len(ids) // 2], ids[-1]))[1]
        less, same, more = [], [], []
        for i in ids:
            symbol = _symbol(strings[i], depth)
            (less if symbol < pivot else same if symbol == pivot else more).append(i)
        if more:
            stack.append((more, depth))
        stack.append((same, depth + 1 if pivot >= 0 else floor))
        if less:
            stack.append((less, depth))


class BlindTrie:
    """A Patricia trie that keeps branching symbols and depths only; a search goes down blindly
    to some leaf, and one comparison with that leaf's string finds where they part."""

    def __init__(self, strings: list[bytes], first: int):
        self.strings, self.root = strings, first  # a leaf is an id; a node is [depth, {symbol: child}, any leaf]

    def add(self, new: int, known: int) -> None:
        text, node = self.strings[new], self.root
        while not isinstance(node, int):
            child = node[1].get(_symbol(text, node[0]))
            if child is None:
                node = node[2]
                break
            node = child
        if not isinstance(node, int):
            node = node[2]
        other = self.strings[node]
        part = common(text, other, known)
        parent, symbol, node = None, 0, self.root
        while not isinstance(node, int) and node[0] < part:
            parent, symbol = node, _symbol(text, node[0])
            node = node[1][symbol]
        mine = _symbol(text, part)
        if not isinstance(node, int) and node[0] == part:
            node[1].setdefault(mine, new)
            return
        leaf = node if isinstance(node, int) else node[2]
        split = [part, {_symbol(self.strings[leaf], part): node, mine: new}, leaf]
        if parent is None:
            self.root = split
        else:
            parent[1][symbol] = split

    def walk(self) -> Iterator[int]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, int):
                yield node
            else:
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))


def deep_shallow_sort(strings: list[bytes], known: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, lcp): sorted order of `strings`, which all agree on `known` symbols, and the common
    prefix of each with the one before it (0 for the first)."""
    distinct: dict[bytes, list[int]] = {}
    for i, text in enumerate(strings):
        distinct.setdefault(text, []).append(i)
    keys = list(distinct)
    order: list[int] = []
    for _, ids in multikey_quicksort(keys, list(range(len(keys))), known, known + shallow):
        if len(ids) > 1:
            trie = BlindTrie(keys, ids[0])
            for i in ids[1:]:
                trie.add(i, known)
            ids = trie.walk()
        order.extend(ids)
    places, lcp, before = [], [], None
    for k in order:
        lcp.append(0 if before is None else common(before, keys[k], known))
        before = keys[k]
        places.extend(distinct[before])
        lcp.extend([len(before)] * (len(distinct[before]) - 1))
    return places, lcp


def repeated_windows(
    spans: Sequence[bytes], back: Sequence[int], more: Sequence[int], counts: Sequence[int], length: int, gram: int
) -> list[list[tuple[int, int]]]:
    """For stretches of one gram: runs (first, last) of windows, by distance from the stretch's
    first window, that also occur in another stretch or in another copy of the same one."""
    n = len(spans)
    right, right_lcp = deep_shallow_sort([s[b:] for s, b in zip(spans, back)], gram)
    left, left_lcp = deep_shallow_sort([s[:b][::-1] for s, b in zip(spans, back)])
    right, left = np.array(right), np.array(left)
    right_lcp, left_lcp = np.array(right_lcp), np.array(left_lcp)
    backs, mores = np.array(back), np.array(more)
    hits = np.zeros((n, int(mores.max()) + 1), dtype=bool)
    hits[np.array(counts) > 1] = True
    classes_r, classes_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int((backs - mores).min()), int(backs.max()) + 1):  # anchor - window start
        here = np.flatnonzero((d <= backs) & (d >= backs - mores))
        if len(here) < 2:
            continue
        classes_r[right] = np.cumsum(right_lcp < length - d)
        classes_l[left] = np.cumsum(left_lcp < d)
        keys = classes_r[here] * (n + 1) + classes_l[here]
        _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = here[times[inverse] > 1]
        hits[twice, backs[twice] - d] = True
    runs = []
    for i in range(n):
        row = np.r_[0, hits[i, : mores[i] + 1].astype(np.int8), 0]
        step = np.diff(row)
        runs.append(list(zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) - 1).tolist())))
    return runs


def _few_windows(
    spans: Sequence[bytes], back: Sequence[int], more: Sequence[int], counts: Sequence[int], length: int, gram: int
) -> list[list[tuple[int, int]]]:
    """The same for few stretches, from the common prefixes of each two of them."""
    n = len(spans)
    reach = []
    for strings, known in (([s[b:] for s, b in zip(spans, back)], gram), ([s[:b][::-1] for s, b in zip(spans, back)], 0)):
        order, lcp = deep_shallow_sort(strings, known)
        pairs = {}
        for i in range(n - 1):
            least = len(strings[order[i]])
            for j in range(i + 1, n):
                least = min(least, lcp[j])
                pairs[min(order[i], order[j]), max(order[i], order[j])] = least
        reach.append(pairs)
    found: list[list[tuple[int, int]]] = [[(0, more[i])] if counts[i] > 1 else [] for i in range(n)]
    for (i, j), ahead in reach[0].items():
        low = max(length - ahead, back[i] - more[i], back[j] - more[j])
        high = min(reach[1][i, j], back[i], back[j])
        if low <= high:
            for k in (i, j):
                if counts[k] == 1:
                    found[k].append((back[k] - high, back[k] - low))
    return [[tuple(x) for x in _merge(runs)] for runs in found]


def _compare(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int, int, int]] = []

        def settle(group: list[tuple]) -> None:
            group = list({row[1]: row for row in group}.values())  # repeated rows of a document
            if len(group) < 2:
                return
            h, s, spans, back, more, counts = zip(*group)
            windows = _few_windows if len(group) <= FEW else repeated_windows
            runs = windows(spans, back, more, counts, length, gram)
            for key, found in zip(s, runs):
                out.extend((h[0], key, first, last) for first, last in found)

        for batch in _slices(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "s", "span", "back", "more", "n"))):
                if held and held[0][0] != row[0]:
                    settle(held)
                    held = []
                held.append(row)
            yield _runs(out)
            out.clear()
        if held:
            settle(held)
        yield _runs(out)

    return run


def _runs(rows) -> pa.RecordBatch:
    h, s, first, last = zip(*rows) if rows else ((), (), (), ())
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, type=k) for x, k in zip((h, s, first, last), kinds)], names=["h", "s", "first", "last"]
    )


def _cut(length: int, crowd: int):
    """Stretches of the asked-for places; for crowded grams two hashes of each window instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows: list[tuple] = []
            for text, asked in zip(_bytes(batch.column("text")), batch.column("asked").to_pylist()):
                for a in asked:
                    span = text[a["lo"] : a["lo"] + a["more"] + length]
                    base = (a["h"], a["s"], a["back"], a["more"], a["n"])
                    if a["m"] <= crowd:
                        rows.append((*base, span, None, None, None))
                        continue
                    for first in range(a["more"] + 1):
                        digest = hashlib.blake2b(span[first : first + length], digest_size=16).digest()
                        rows.append((*base, None, first, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
            columns = list(zip(*rows)) or [()] * 9
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds)],
                names=["h", "s", "back", "more", "n", "span", "first", "w1", "w2"],
            )

    return run


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _digest(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = []
            for text, found in zip(_bytes(batch.column("text")), batch.column("found").to_pylist()):
                cuts = _merge([(f["start"], f["end"]) for f in found or ()])
                kept, at = [], 0
                for start, end in cuts:
                    kept.append(text[at:start])
                    at = end
                left = b"".join([*kept, text[at:]]) if cuts else text
                rows.append(
                    (
                        len(text),
                        len(text) - len(left),
                        len(cuts),
                        hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "ignore") if with_text else None,
                    )
                )
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c not in ("text", "found")), *(pa.array(c, type=k) for c, k in zip(columns, kinds))],
                names=[*(c for c in batch.schema.names if c not in ("text", "found")), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def repeats(docs: DataFrame, length: int = 200, gram: int = 64, crowd: int = 2048) -> DataFrame:
    """(t1, t2, start, end): byte ranges, by text key, that repeated strings cover."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).select(*content_key(F.col("text")), "text")
    found = texts.where(F.octet_length("text") >= length).mapInArrow(_find(length, gram), ANCHOR)
    shared = (
        found.groupBy("h")
        .agg(F.count(F.lit(1)).alias("c"), F.min("s").alias("s0"), F.max("s").alias("s1"))
        .where("c > 1")
        .select("h", (F.col("s0") == F.col("s1")).alias("alike"))
    )
    kept = stored(found.join(shared, "h"), "anchors")
    whole = (F.col("lo").alias("start"), (F.col("lo") + F.col("more") + length).alias("end"))
    alike = kept.where("alike").select("t1", "t2", *whole)

    mixed = kept.where("not alike").drop("alike")
    place = F.struct("t1", "t2", "lo", "back", "more")
    spans = mixed.groupBy("h", "s").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("p"))
    crowds = spans.groupBy("h").agg(F.count(F.lit(1)).alias("m"))
    spans = stored(spans.join(crowds, "h").select("h", "s", "n", "m", "p.*"), "stretches")

    # One copy of each text is enough to cut the stretches from.
    asked = spans.groupBy("t1", "t2").agg(
        F.collect_list(F.struct("h", "s", "n", "m", "lo", "back", "more")).alias("asked")
    )
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = named.select(F.coalesce("doc_id", F.lit(-1)).alias("one"), *content_key(F.col("text")), "text")
    one = named.groupBy("t1", "t2").agg(F.min("one").alias("one"))
    asked = asked.join(one, ["t1", "t2"])
    cut = stored(
        named.join(asked, ["t1", "t2", "one"])
        .select("text", "asked")
        .mapInArrow(_cut(length, crowd), "h long, s long, back int, more int, n long, span binary, first int, w1 long, w2 long"),
        "cut",
    )
    sorted_out = (
        cut.where("first is null")
        .select("h", "s", "span", "back", "more", "n")
        .repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(_compare(length, gram), "h long, s long, first int, last int")
    )
    windows = cut.where("first is not null").select("h", "s", "n", "first", "w1", "w2").distinct()
    twice = windows.groupBy("h", "w1", "w2").agg(F.sum("n").alias("c")).where("c > 1").drop("c")
    crowded = windows.join(twice, ["h", "w1", "w2"]).select("h", "s", "first", F.col("first").alias("last"))
    runs = sorted_out.union(crowded)
    partly = mixed.join(runs, ["h", "s"]).select(
        "t1", "t2", (F.col("lo") + F.col("first")).alias("start"), (F.col("lo") + F.col("last") + length).alias("end")
    )
    return reduce(DataFrame.union, [alike, partly]).distinct()


def without_repeats(docs: DataFrame, length: int = 200, gram: int = 64, crowd: int = 2048, with_text: bool = False) -> DataFrame:
    """Columns of `docs` but text, with n_bytes, n_removed, n_spans, kept_sha256 and kept.

    `kept` is the remaining text, without characters that a cut has halved; null unless
    `with_text`. See the module for the defined cases.
    """
    others = [c for c in docs.columns if c != "text"]
    inside = docs.select(F.struct(*others).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    inside = inside.select("row", *content_key(F.col("text")), "text")
    found = (
        repeats(docs, length, gram, crowd)
        .groupBy("t1", "t2")
        .agg(F.collect_list(F.struct("start", "end")).alias("found"))
    )
    row = inside.schema["row"].dataType.simpleString()
    return (
        inside.join(found, ["t1", "t2"], "left")
        .select("row", "text", "found")
        .mapInArrow(_digest(with_text), f"row {row}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
        .select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    )
