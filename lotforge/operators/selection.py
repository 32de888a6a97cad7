"""The row at a given rank of an order, and the first k rows, without sorting all rows.

A rank is closed in on between two keys: a sample of the rows between them, drawn by hash, gives
splitters near the rank, one pass counts the rows between the splitters, and the two around the rank
are the next bounds. Each round leaves about a thousandth of the rows; when few are left, the rank is
read from their keys. Ranks that are asked for together share every pass, so that rows which are
costly to compute are computed three or five times in all. Only samples, counts and keys of bounded
number reach the driver, and the keys found are exact.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a sample holds, about, and rows between two bounds that are read instead.
SAMPLE, FEW = 1 << 13, 1 << 16
#: Splitters on either side of a rank, which together reach over four standard deviations.
_NEAR, _REACH = 32, 4


@dataclass(frozen=True)
class Cut:
    """The key at a rank and how many rows have a smaller key."""

    key: tuple
    below: int


@dataclass(frozen=True)
class Span:
    """The rows between two keys, either None for no bound, and how many rows come before the first
    and before the end of them."""

    low: tuple | None
    high: tuple | None
    under: int
    upto: int

    def held(self, keys: list[tuple]) -> list[tuple]:
        """Those of some sorted keys that lie inside."""
        start = 0 if self.low is None else bisect_right(keys, _sortable(self.low), key=_sortable)
        end = len(keys) if self.high is None else bisect_left(keys, _sortable(self.high), key=_sortable)
        return keys[start:end]

    def near(self, rank: int, keys: list[tuple]) -> list[tuple]:
        """Those of the sorted keys of a sample that lie around a rank."""
        place = len(keys) * (rank - self.under) // (self.upto - self.under)
        step = max(1, round(_REACH * math.sqrt(len(keys)) / 2 / _NEAR))
        return [keys[min(max(place + step * o, 0), len(keys) - 1)] for o in range(-_NEAR, _NEAR + 1)]


class Ordered:
    """Rows in the order of some columns, NULL first; the columns should tell all rows apart."""

    def __init__(self, rows: DataFrame, order: Sequence[str]) -> None:
        # A filter on the keys that was pushed below this draw would compute them for each comparison.
        self.keys = rows.select(F.struct(*order).alias("k"), F.rand(0).alias("_todas")).where("_todas >= 0")
        self.fields: list[T.StructField] = [rows.schema[name] for name in order]
        self.key = F.struct(*order)

    def literal(self, key: tuple) -> Column:
        """A key as it was collected; text keeps the value of every type whatever the time zone."""
        parts = zip(key, self.fields)
        return F.struct(
            *(F.lit(None if v is None else str(v)).cast(f.dataType).alias(f.name) for v, f in parts)
        )

    def before(self, cut: Cut | None) -> Column:
        """Whether a row comes before a cut; all rows come before the end (None)."""
        return F.lit(True) if cut is None else self.key < self.literal(cut.key)

    def _inside(self, spans: Collection[Span]) -> DataFrame:
        def inside(span: Span) -> Column:
            after = F.lit(True) if span.low is None else F.col("k") > self.literal(span.low)
            return after if span.high is None else after & (F.col("k") < self.literal(span.high))

        return self.keys.where(reduce(Column.__or__, map(inside, spans)))

    def _keys(self, rows: DataFrame) -> list[tuple]:
        found = {tuple(row["k"]) for row in rows.select("k").collect()}
        return sorted(found, key=_sortable)

    def _sampled(self, spans: Collection[Span], share: float) -> list[tuple]:
        """Different keys among about that share of the rows, however often a key is repeated."""
        rows, draw = self._inside(spans), F.xxhash64("k")
        if share < 1:
            rows = rows.where(F.pmod(draw, F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
        return self._keys(rows.orderBy(draw).limit(2 * SAMPLE * len(spans)))

    def _samples(self, spans: Collection[Span]) -> dict[Span, list[tuple]]:
        """Some sorted keys of each span, at least one."""
        rows = sum(span.upto - span.under for span in spans)
        keys = self._sampled(spans, SAMPLE * len(spans) / rows)
        return {span: span.held(keys) or self._sampled([span], 1) for span in spans}

    def _place(self, splitters: list[tuple]) -> Column:
        """How many of the sorted splitters are not greater than a row's key, by bisection."""
        bounds = F.array(*map(self.literal, splitters))
        strides = [1 << power for power in reversed(range(len(splitters).bit_length()))]

        def closer(place: Column, stride: Column) -> Column:
            ahead = place + stride
            inside = (ahead <= len(splitters)) & (F.get(bounds, ahead - 1) <= F.col("k"))
            return F.when(inside, ahead).otherwise(place)

        return F.aggregate(F.array(*map(F.lit, strides)), F.lit(0), closer)

    def _counted(self, spans: Collection[Span], splitters: list[tuple]) -> tuple[list[int], list[int]]:
        """By place among the splitters, the rows of the spans there, and those equal to the last one."""
        bounds = F.array(*map(self.literal, splitters))
        placed = self._inside(spans).withColumn("_lugar", self._place(splitters))
        same = F.get(bounds, F.col("_lugar") - 1) == F.col("k")
        counts = placed.groupBy("_lugar").agg(F.count("*").alias("n"), F.count_if(same).alias("same"))
        n, alike = [0] * (len(splitters) + 1), [0] * (len(splitters) + 1)
        for row in counts.collect():
            n[row["_lugar"]], alike[row["_lugar"]] = row["n"], row["same"]
        return n, alike

    def _closer(self, spans: dict[int, Span]) -> dict[int, Cut | Span]:
        """For each rank the narrower span that it lies in, or its cut."""
        different = set(spans.values())
        samples = self._samples(different)
        chosen = {key for rank, span in spans.items() for key in span.near(rank, samples[span])}
        # With the bounds among the splitters, the rows of a place are all of one span.
        chosen |= {key for span in different for key in (span.low, span.high) if key is not None}
        splitters = sorted(chosen, key=_sortable)
        n, alike = self._counted(different, splitters)
        found: dict[int, Cut | Span] = {}
        for rank, span in spans.items():
            inner = span.held(splitters)
            first = splitters.index(inner[0])
            low, under, smaller = span.low, span.under, span.under + n[first]
            found[rank] = span
            for place, key in enumerate(inner, first + 1):
                if rank < smaller:
                    found[rank] = Span(low, key, under, smaller)
                    break
                if rank < smaller + alike[place]:
                    found[rank] = Cut(key, smaller)
                    break
                low, under, smaller = key, smaller + alike[place], smaller + n[place]
            else:
                found[rank] = Span(low, span.high, under, span.upto)
        return found

    def cuts(self, ranks: Collection[int], count: int) -> dict[int, Cut | None]:
        """The cuts at some ranks from 0; None from `count`, the number of rows, on."""
        found: dict[int, Cut | Span | None] = {
            rank: Span(None, None, 0, count) if rank < count else None for rank in ranks
        }

        def spans(wide: bool) -> dict[int, Span]:
            return {r: s for r, s in found.items() if isinstance(s, Span) and (s.upto - s.under > FEW) == wide}

        while wide := spans(True):
            found |= self._closer(wide)
        if left := spans(False):
            read = self._inside(set(left.values())).select("k").collect()
            keys = sorted((tuple(row["k"]) for row in read), key=_sortable)
            for rank, span in left.items():
                held = span.held(keys)
                key = held[rank - span.under]
                found[rank] = Cut(key, span.under + held.index(key))
        return found

    def at(self, rank: int, count: int) -> Cut | None:
        """The cut at one rank."""
        return self.cuts([rank], count)[rank]


def _sortable(key: tuple) -> tuple:
    """Order of Spark: NULL first, text by its UTF-8 bytes."""
    return tuple((v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0) for v in key)


def first_rows(rows: DataFrame, order: Sequence[str], wanted: Callable[[int], int]) -> DataFrame:
    """The first `wanted(number of rows)` rows by `order`, then by all other columns.

    Rows alike in all columns are interchangeable, so as many of them as belong here are repeated
    from one.
    """
    columns = [*order, *(c for c in rows.columns if c not in order)]
    ordered = Ordered(rows, columns)
    count = rows.count()
    rank = wanted(count)
    cut = ordered.at(rank, count)
    found = rows.where(ordered.before(cut))
    if cut is None or cut.below == rank:
        return found
    alike = rows.where(ordered.key == ordered.literal(cut.key)).limit(1)
    copies = F.explode(F.sequence(F.lit(cut.below + 1), F.lit(rank)))
    return found.unionByName(alike.select("*", copies.alias("_n")).drop("_n"))
