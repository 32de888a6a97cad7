"""Near-duplicates by DartMinHash signatures of weighted word shingles.

A document is the multiset of its runs of five words (of all its words, if it has fewer); a shingle
that occurs c times is c unit cells. Every cell has darts at hashed places of a time axis, one per
unit of time on average, each with a hashed coordinate; the signature keeps the earliest dart of
each coordinate. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. Time is walked in slabs until each coordinate has a dart, so a long document
sees a short stretch of time and a short one a long stretch, and the work per document is one hash
per cell and slab plus about k log k darts.

Candidates share one of 32 bands of 4 coordinates. They are settled in two rounds without returning
all pairs of a band: first each member with the band's smallest, verified; then, where the
components so far still differ, the members meet block by block inside tasks, with their cells, and
those that agree in enough coordinates are verified there, each pair in its first common band only.
Pairs already joined are passed over, and what a task returns is a spanning forest: the links that
joined two components. Verification is the exact weighted Jaccard of the texts.
At similarity 0.8 a pair misses all bands with probability 5e-8 and the agreement bound with 4e-6.

Words are maximal runs of characters other than space, tab, LF, VT, FF and CR. Null texts and texts
without words link with nothing. Equal texts are collapsed first and belong together. Rows are told
apart by their texts: rows of one doc_id with different texts are separate documents, each in the
class of its text. Rows with a null doc_id stay alone, with a null component, and are kept. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import components, content_key, stored
from lotforge.llm.grams import Rolling, U, mix

WORDS = 5
COORDINATES, ROWS_PER_BAND = 128, 4
BANDS = COORDINATES // ROWS_PER_BAND
#: Coordinates that a candidate pair of the second round must share.
AGREE = 82
#: Members of a band that are compared in one task; a larger band is dealt into pairs of blocks.
BLOCK = 1024
#: Documents, and bytes of them, that one vectorised pass takes.
_DOCS, _BYTES = 512, 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= _BYTES or i + 1 - start >= _DOCS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every unit cell, sorted by both."""
    buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    word = ~_SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.r_[False, word, False].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, U)
    hashes = Rolling(buffer).of(start, end)
    doc = np.searchsorted(begins, start, side="right") - 1
    counts = np.bincount(doc, minlength=len(texts))
    firsts = np.cumsum(np.r_[0, counts[:-1]])
    shingles = np.full(len(hashes), U(WORDS), dtype=U)
    for j in range(WORDS):  # words behind the document's end add nothing
        at = np.minimum(np.arange(len(hashes)) + j, len(hashes) - 1)
        inside = (np.arange(len(hashes)) + j) < (firsts + counts)[doc]
        shingles = np.where(inside, mix(shingles * U(0x9E3779B97F4A7C15) + hashes[at]), shingles)
    rank = np.arange(len(hashes)) - firsts[doc]
    keep = rank < np.maximum(counts[doc] - WORDS + 1, 1)
    doc, shingles = doc[keep], shingles[keep]
    order = np.lexsort((shingles, doc))
    doc, shingles = doc[order], shingles[order]
    new = np.r_[True, (shingles[1:] != shingles[:-1]) | (doc[1:] != doc[:-1])]
    at = np.arange(len(doc))
    copy = at - np.maximum.accumulate(np.where(new, at, 0))
    return doc, mix(shingles + copy.astype(U) * U(0xC2B2AE3D27D4EB4F))


def _slabs() -> Iterator[tuple[float, float]]:
    """(begin, width) of the time slabs: the first short, then doubling up to 16."""
    begin, width = 0.0, 2.0**-8
    while True:
        yield begin, width
        begin += width
        width = min(begin, 16.0)


def _poisson(mean: float) -> np.ndarray:
    """Probability of at most n darts, for every n that matters."""
    terms, n = [np.exp(-mean)], 0
    while n < mean or terms[-1] > 1e-18:
        n += 1
        terms.append(terms[-1] * mean / n)
    return np.cumsum(terms)


def signatures(doc: np.ndarray, cell: np.ndarray, docs: int, k: int = COORDINATES) -> tuple[np.ndarray, np.ndarray]:
    """(filled, signature): for each of `docs` documents the earliest dart of k coordinates;
    a document without cells is not filled."""
    signature = np.zeros(docs * k, dtype=U)
    open_slots = np.ones(docs * k, dtype=bool)
    active = np.bincount(doc, minlength=docs) > 0
    filled = active.copy()
    for number, (_, width) in enumerate(_slabs()):
        here = active[doc]
        if not here.all():
            doc, cell = doc[here], cell[here]
        if not len(doc):
            return filled, signature.reshape(docs, k)
        thrown = mix(cell ^ mix(np.array([number + 1], dtype=U)))
        steps = _poisson(width)
        hit = np.flatnonzero(thrown >= U(int(steps[0] * 2.0**64)))
        darts = np.searchsorted(steps, thrown[hit].astype(np.float64) / 2.0**64)
        owner = np.repeat(hit, darts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(thrown[owner] + (nth.astype(U) + U(1)) * U(0x165667B19E3779F9))
        slot = doc[owner] * k + (dart >> U(40)).astype(np.int64) % k
        free = open_slots[slot]
        dart, slot = dart[free], slot[free]
        time = mix(dart ^ U(0x27D4EB2F165667C5)) >> U(32)
        order = np.argsort((slot.astype(U) << U(32)) | time, kind="stable")
        slot, dart = slot[order], dart[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, np.int64)
        signature[slot[first]] = dart[first]
        open_slots[slot[first]] = False
        active &= open_slots.reshape(docs, k).any(axis=1)
    raise AssertionError


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        others = [c for c in batch.schema.names if c != "text"]
        for start, end in _groups(texts):
            doc, cell = cells(texts[start:end])
            filled, signature = signatures(doc, cell, end - start)
            chosen = pa.array(np.flatnonzero(filled) + start)
            values = signature[filled].ravel().view(np.int64).astype(np.int32)  # 32 bits tell darts apart
            lists = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, COORDINATES, dtype=np.int32), pa.array(values))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(chosen) for c in others), lists], names=[*others, "sig"])


def jaccard(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Exact weighted Jaccard similarity of the shingles of each two texts."""
    doc, cell = cells([t for pair in pairs for t in pair])
    pair = doc >> 1
    order = np.lexsort((cell, pair))
    pair, cell = pair[order], cell[order]
    both = pair[1:][(pair[1:] == pair[:-1]) & (cell[1:] == cell[:-1])]
    both = np.bincount(both, minlength=len(pairs))
    total = np.bincount(pair, minlength=len(pairs))
    return both / np.maximum(total - both, 1)


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
            for start, end in _groups([a + b for a, b in zip(left, right)]):
                alike = jaccard(list(zip(left[start:end], right[start:end]))) >= least - 1e-12
                chosen = pa.array(np.flatnonzero(alike) + start)
                yield pa.RecordBatch.from_arrays([batch.column(c).take(chosen) for c in ("a", "b")], names=["a", "b"])

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted cells of every text, as bytes."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = []
        for start, end in _groups(texts):
            doc, cell = cells(texts[start:end])
            order = np.lexsort((cell, doc))
            cuts = np.searchsorted(doc, np.arange(1, end - start))
            found += [part.tobytes() for part in np.split(cell[order], cuts)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], names=["node", "cells"])


def _alike(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Exact weighted Jaccard similarity of sorted cells to several others."""
    sizes = np.array([len(o) for o in others])
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(one, every), len(one) - 1)
    both = np.add.reduceat(one[place] == every, np.r_[0, np.cumsum(sizes)[:-1]])
    return both / (len(one) + sizes - both)


def _forests(least: float, agree: int):
    """Links between members of one band that join components that are still apart: for every
    group of rows a spanning forest, so never more links than members.

    Members are compared 64 by 64. A pair counts that agrees in `agree` coordinates and in no
    earlier band, lies in components not joined yet, and whose cells verify it."""

    def links(rows: dict[str, np.ndarray], sig: np.ndarray, body: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x != root.setdefault(x, x):
                root[x] = x = root[root[x]]
            return x

        component, mine, band = rows["component"], rows["mine"], int(rows["band"][0])
        sizes = np.array([len(b) for b in body])
        if rows["lo"][0] == rows["hi"][0]:
            left = right = np.arange(len(component))
        else:
            left, right = np.flatnonzero(mine == rows["lo"]), np.flatnonzero(mine == rows["hi"])
        for i in range(0, len(left), 64):
            x = left[i : i + 64]
            for j in range(i if left is right else 0, len(right), 64):
                y = right[j : j + 64]
                match = sig[x][:, None, :] == sig[y][None, :, :]
                bands = match[:, :, : band * ROWS_PER_BAND].reshape(len(x), len(y), band, ROWS_PER_BAND)
                fits = (match.sum(axis=2) >= agree) & ~bands.all(axis=3).any(axis=2)
                fits &= component[x][:, None] != component[y][None, :]
                small, large = np.minimum(sizes[x][:, None], sizes[y][None]), np.maximum(sizes[x][:, None], sizes[y][None])
                fits &= small >= least * large - 1e-9
                if left is right and i == j:
                    fits = np.triu(fits, 1)
                for a in np.flatnonzero(fits.any(axis=1)):
                    own = find(int(component[x[a]]))
                    apart = [b for b in y[np.flatnonzero(fits[a])] if find(int(component[b])) != own]
                    if not apart:
                        continue
                    for b in np.array(apart)[_alike(body[x[a]], [body[b] for b in apart]) >= least - 1e-12]:
                        one, other = find(int(component[x[a]])), find(int(component[b]))
                        if one != other:
                            root[max(one, other)] = min(one, other)
                            yield int(rows["node"][x[a]]), int(rows["node"][b])

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        names = ("node", "component", "band", "lo", "hi", "mine")
        columns = {n: table.column(n).to_numpy() for n in names}
        sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        body = [np.frombuffer(c, dtype=U) for c in table.column("cells").to_pylist()]
        cuts = np.r_[0, _starts(table), table.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            found = list(links({n: c[start:end] for n, c in columns.items()}, sig[start:end], body[start:end]))
            if found:
                a, b = np.array(found, dtype=np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = _starts(batch)
            if held and any(held[-1].column(n)[-1] != batch.column(n)[0] for n in ("key", "lo", "hi")):
                cuts = np.r_[0, cuts]
            if len(cuts):
                last = int(cuts[-1])
                whole = pa.Table.from_batches([*held, batch.slice(0, last)])
                if whole.num_rows:
                    yield from settle(whole)
                held = []
                batch = batch.slice(last)
            held.append(batch)
        if held:
            yield from settle(pa.Table.from_batches(held))

    return run


def _starts(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Places where a group of sorted rows begins, but for the first."""
    groups = np.stack([rows.column(n).to_numpy() for n in ("key", "lo", "hi")])
    return np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, component_id (smallest doc_id of its class) and kept for every row of `docs`, with
    the text's key t1, t2."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select("doc_id", *content_key(F.col("text")), "text")
    signed = texts.where("doc_id is not null").mapInArrow(_sign, "doc_id long, t1 long, t2 long, sig array<int>")
    distinct = stored(
        signed.groupBy("t1", "t2").agg(F.min(F.struct("doc_id", "sig")).alias("m")).select("t1", "t2", "m.*"),
        "signatures",
    ).withColumnRenamed("doc_id", "node")
    band = F.posexplode(
        F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda i: F.xxhash64(i, F.slice("sig", i * ROWS_PER_BAND + 1, ROWS_PER_BAND)),
        )
    ).alias("band", "key")
    members = distinct.select("node", band)
    shared = members.groupBy("band", "key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = shared.where("least < most").drop("most")
    members = stored(members.join(shared, ["band", "key"]), "bands")
    asked = distinct.drop("sig").join(members.select("node").distinct(), "node")
    bodies = texts.withColumnRenamed("doc_id", "node").join(asked, ["node", "t1", "t2"]).select("node", "text")
    bodies = stored(bodies, "bodies")

    def verified(pairs: DataFrame) -> DataFrame:
        left = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_verify(least), "a long, b long")

    stars = members.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(verified(stars), "links")
    so_far = components(first)
    open_bands = members.join(so_far, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = open_bands.groupBy("band", "key").agg(
        F.min("component").alias("least_of"), F.max("component").alias("most_of"), F.count(F.lit(1)).alias("n")
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mixed = mixed.where("least_of < most_of").select("band", "key", blocks.alias("blocks"))
    rest = open_bands.join(mixed, ["band", "key"]).withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rest = stored(rest.select("key", "band", "node", "component", "mine", "blocks"), "open")
    known = bodies.join(rest.select("node").distinct(), "node", "left_semi")
    known = stored(known.mapInArrow(_cells, "node long, cells binary"), "cells")
    second = stored(
        rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")})
        .drop("other", "blocks")
        .join(distinct.select("node", "sig"), "node")
        .join(known, "node")
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi")
        .mapInArrow(_forests(least, AGREE), "a long, b long"),
        "links",
    )
    classes = components(first.union(second))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return (
        texts.select("doc_id", "t1", "t2")
        .join(distinct.drop("sig"), ["t1", "t2"], "left")
        .join(classes, "node", "left")
        .select(
            "doc_id",
            "t1",
            "t2",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )
