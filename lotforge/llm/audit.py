"""Interaction of document filters, audited by the Hart-Mas-Colell potential.

Every document has a mask of the filters it fails. A coalition S of filters removes v(S) documents,
those whose mask meets S. The potential of the removal game is P({}) = 0 and

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

computed over all coalitions from small to large. A filter's Shapley value is P(all) - P(all
without it), so no order is enumerated for it. `Q(S) = |S|! P(S)` stays in whole numbers.
What a filter does at a step of an order is a difference of two coalitions: those before the step,
with and without the filter. All that is read from the documents is the count by part and mask.

Filters: A fewer than 200 words; B fewer distinct words than half of all; C more than 2 % capitals
A-Z of the code points; D any of # $ % & * |; E the text of a smaller doc_id, wherever it is.
Words are maximal runs of characters other than space, tab, LF, VT, FF and CR.

A null text is the empty one: it fails A, and E where a smaller doc_id is empty as well. Rows that
share a doc_id are separate documents and not copies of each other. A null doc_id is neither smaller
nor larger than any, so its row never fails E and has no label. Of several labels of one doc_id, any
quality = 1 and any toxic = 1 counts. A null source is the part ''. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.llm.common import content_key

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1
_SPACE = r"[\x20\x09-\x0D]+"
#: What is counted of a set of documents.
_COUNTS = ("n", "good", "toxic")


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column) -> Column:
    """Mask of the filters that look at one text alone."""
    words = F.array_remove(F.split(text, _SPACE), "")
    total, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = {
        "A": total < 200,
        "B": 100 * distinct < 50 * total,
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(test, _bit(letter)).otherwise(0) for letter, test in failed.items()), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: (part, mask, n, good, toxic).

    Copies meet as counts only: documents of one text are first added up by text and part, with
    those of the smallest doc_id apart, so a text of very many copies is a few rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        *content_key(text),
        own_failures(text).alias("own"),
        F.coalesce("doc_id", F.monotonically_increasing_id()).alias("_asked"),
    )
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_marked")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).cast("long").alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("long").alias("toxic"),
    )
    # a row without doc_id has no label; fillers keep such rows from meeting in one task
    labelled = (F.col("_asked") == F.col("_marked")) & F.col("doc_id").isNotNull()
    marked = rows.join(marks, labelled, "left")
    by_id = marked.groupBy("t1", "t2", "part", "own", "doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    known = F.col("doc_id").isNotNull()
    first = F.struct("doc_id", *_COUNTS)
    by_part = by_id.groupBy("t1", "t2", "part", "own").agg(
        *(F.sum(c).alias(c) for c in _COUNTS),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("apart"),
        F.min(F.when(known, first)).alias("first"),
    )
    least = by_part.groupBy("t1", "t2").agg(F.min("first.doc_id").alias("least"))
    sides = by_part.join(least, ["t1", "t2"])
    here = F.col("first.doc_id") == F.col("least")
    original = [F.coalesce(F.when(here, F.col(f"first.{c}")), F.lit(0)) for c in _COUNTS]
    original[0] = original[0] + F.col("apart")
    split = F.array(
        F.struct(F.col("own").alias("mask"), *(o.alias(c) for o, c in zip(original, _COUNTS))),
        F.struct(
            F.col("own").bitwiseOR(F.lit(_bit("E"))).alias("mask"),
            *((F.col(c) - o).alias(c) for o, c in zip(original, _COUNTS)),
        ),
    )
    return sides.select("part", F.inline(split)).groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in _COUNTS))


def coalition_values(counts: DataFrame) -> DataFrame:
    """Per part its size `n` and the arrays v_n, v_good, v_toxic: what each coalition removes, at
    the place of its bits. A part has one count per mask at most."""
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("mask", *_COUNTS)).alias("masks")
    )

    def removed(name: str) -> Column:
        def by(coalition: Column) -> Column:
            met = F.filter("masks", lambda m: m["mask"].bitwiseAND(coalition) != 0)
            return F.aggregate(met, F.lit(0).cast("long"), lambda total, m: total + m[name])

        return F.transform(F.sequence(F.lit(0), F.lit(_ALL)), by)

    return parts.select("part", "n", *(removed(c).alias(f"v_{c}") for c in _COUNTS))


def potentials(values: DataFrame) -> DataFrame:
    """Add `q`: |S|! times the potential of every coalition. A coalition without one member is a
    smaller number, so going up the numbers finds each of them done."""
    factorials = F.array(*(F.lit(factorial(k)).cast("long") for k in range(len(FILTERS))))

    def grown(q: Column, coalition: Column) -> Column:
        below = [
            F.when(coalition.bitwiseAND(F.lit(1 << i)) != 0, F.get(q, coalition - (1 << i))).otherwise(0)
            for i in range(len(FILTERS))
        ]
        weight = F.get(factorials, F.bit_count(coalition) - 1)
        return F.concat(q, F.array(weight * F.get("v_n", coalition) + sum(below, F.lit(0))))

    coalitions = F.sequence(F.lit(1), F.lit(_ALL))
    return values.withColumn("q", F.aggregate(coalitions, F.array(F.lit(0).cast("long")), grown))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what the step keeps and removes, and its filter's
    Shapley value times the number of orders."""
    games = potentials(coalition_values(failure_counts(docs, labels)))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = games.withColumn("filter_order", F.explode(orders))
    bits = [F.expr(f"shiftleft(1, ascii(substring(filter_order, {k + 1}, 1)) - ascii('A'))") for k in range(len(FILTERS))]
    steps = F.array(
        *(
            F.struct(F.lit(k + 1).alias("step"), bits[k].alias("bit"), sum(bits[:k], F.lit(0)).alias("before"))
            for k in range(len(bits))
        )
    )
    rows = rows.select("*", F.inline(steps)).withColumn("after", F.col("before") + F.col("bit"))

    def at(name: str, coalition: Column | str) -> Column:
        return F.get(F.col(name), F.col(coalition) if isinstance(coalition, str) else coalition)

    def change(name: str) -> Column:
        return at(name, "after") - at(name, "before")

    rest = F.lit(_ALL) - F.col("bit")
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - at("v_n", "after")).alias("kept"),
        change("v_n").alias("removed"),
        (at("v_n", "bit") - change("v_n")).alias("redundant"),
        (at("v_n", F.lit(_ALL)) - at("v_n", rest)).alias("unique_fails"),
        change("v_good").alias("good_lost"),
        change("v_toxic").alias("toxic_lost"),
        (at("q", F.lit(_ALL)) - len(FILTERS) * at("q", rest)).alias("shapley"),
    )
