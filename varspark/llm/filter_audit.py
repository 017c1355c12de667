"""Filter interaction audit: what each filter of a chain removes, alone, in any order, and on average over all orders.

A document fails a subset of the filters. A coalition of filters removes the
documents that fail any of its members, so the table of all coalitions holds
everything: a step of an order is the difference of two coalitions, and Shapley
values are the additive model nearest to the table by weighted least squares
under the constraint that they add up to what all filters remove.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.llm.columns import wide_hash

# The letters of the filters; the last one, copies of an earlier text, is found over the whole table.
LETTERS = "ABCDE"
LEAST_WORDS = 200

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point
_SYMBOLS = re.compile(rb"[#$%&*|]")
#: Bytes of a text split into words at once.
SLICE = 1 << 20


def _word_counts(data: bytes) -> tuple[int, int]:
    """Words and distinct words between ASCII white space; memory beyond a slice goes to distinct words alone."""
    if len(data) <= SLICE:
        words = data.split()
        return len(words), len(set(words))
    n, distinct, at = 0, set(), 0
    space = re.compile(rb"[\x20\x09-\x0D]")
    while at < len(data):
        end = space.search(data, min(at + SLICE, len(data)))
        until = end.start() if end else len(data)
        words = data[at:until].split()
        n += len(words)
        distinct.update(words)
        at = until
    return n, len(distinct)


def text_failures(data: bytes) -> int:
    """Filters A to D that a text fails, as bits."""
    n, distinct = _word_counts(data)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    points = len(data.translate(None, _CONTINUED))
    return (n < LEAST_WORDS) | (100 * distinct < 50 * n) << 1 | (100 * capitals > 3 * points) << 2 | bool(_SYMBOLS.search(data)) << 3


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part, text hash (a, b) and ``mask`` of the filters A to D that each row's text fails."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            mask = [text_failures(t.as_py() or b"") for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(mask, pa.int32())], ["doc_id", "part", "a", "b", "mask"])

    text = F.coalesce("text", F.lit(""))
    hashed = docs.select("text", "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), wide_hash(text).alias("h"))
    rows = hashed.select("text", F.col("doc_id").cast("long").alias("doc_id"), "part", "h.a", "h.b")
    return rows.mapInArrow(judge, "doc_id long, part string, a long, b long, mask int")


def failure_cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, mask (all five filters), n, good, toxic: documents of a part that fail exactly these filters.

    Rows are counted before they meet the labels and before texts are compared, so a group
    of copies is a few rows per task. Rows without doc_id are nobody's copy and nobody's original.
    """
    same = ["a", "b", "mask", "part"]
    rows = failures(docs, part).groupBy("doc_id", *same).agg(F.count("*").alias("n"))
    # Rows without an id have no label; the second key spreads them.
    rows = rows.withColumn("spread", F.when(F.col("doc_id").isNull(), F.col("a")).otherwise(F.lit(0).cast("long")))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    marked = rows.join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left").fillna(False, ["good", "toxic"])
    kinds = ["part", "good", "toxic"]
    counts = marked.groupBy("a", "b", "mask", *kinds).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    # Per text a row per part and label at most.
    texts = counts.groupBy("a", "b", "mask").agg(F.min("first.doc_id").alias("lowest"), F.collect_list(F.struct(*kinds, "n", "no_id", "first")).alias("k"))
    each = texts.select("mask", "lowest", F.explode("k").alias("k"))
    first = F.coalesce(F.when(F.col("k.first.doc_id") == F.col("lowest"), F.col("k.first.n")), F.lit(0)) + F.col("k.no_id")
    copy = F.lit(1 << (len(LETTERS) - 1))
    split = F.array(F.struct(F.col("mask").alias("mask"), first.alias("n")), F.struct(F.col("mask").bitwiseOR(copy).alias("mask"), (F.col("k.n") - first).alias("n")))
    cells = each.select("k.part", "k.good", "k.toxic", F.explode(split).alias("c"))
    count = lambda when: F.sum(F.when(when, F.col("c.n")).otherwise(0))
    return cells.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic")
    )


def coalition_table(cells: DataFrame, filters: int = len(LETTERS)) -> DataFrame:
    """part, coalition (its filters as bits), n, good, toxic: documents that the coalition removes. Coalition 0 stands for all documents of the part."""
    all_of = F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1)))
    hit = (F.col("coalition") == 0) | (F.col("coalition").bitwiseAND(F.col("mask")) != 0)
    rows = cells.withColumn("coalition", all_of).groupBy("part", "coalition")
    return rows.agg(*[F.sum(F.when(hit, F.col(c)).otherwise(0)).cast("long").alias(c) for c in ("n", "good", "toxic")])


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """Per filter the weight of each coalition's removals in its Shapley value.

    Minimises the sum over proper coalitions S of k(S) (v(S) - sum of its members' values)^2 with
    k(S) = (m - 1) / (C(m, s) s (m - s)), given that all values add up to v(all). The normal
    equations with the constraint's multiplier are solved in rationals for every coalition at once.
    """
    m, everyone = filters, (1 << filters) - 1
    if m == 1:
        return [[Fraction(0), Fraction(1)]]
    inside = lambda s: [s >> i & 1 for i in range(m)]
    kernel = {s: Fraction(m - 1, comb(m, k) * k * (m - k)) for s in range(1, everyone) if (k := s.bit_count())}
    # Rows: m normal equations and the constraint; columns: m values, the multiplier, then one right side per coalition.
    rows = [[Fraction(0)] * (m + 1 + everyone + 1) for _ in range(m + 1)]
    for s, weight in kernel.items():
        member = inside(s)
        for i in range(m):
            for j in range(m):
                rows[i][j] += weight * member[i] * member[j]
            rows[i][m + 1 + s] += weight * member[i]
    for i in range(m):
        rows[i][m] = rows[m][i] = Fraction(1)
    rows[m][m + 1 + everyone] = Fraction(1)
    for at in range(m + 1):
        pivot = next(r for r in range(at, m + 1) if rows[r][at])
        rows[at], rows[pivot] = rows[pivot], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for r in range(m + 1):
            if r != at and rows[r][at]:
                factor = rows[r][at]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[at], strict=True)]
    return [row[m + 1 :] for row in rows[:m]]


def _orders(letters: str) -> Column:
    """All orders as strings, each letter a filter."""
    return F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", orders: Sequence[str] | None = None) -> DataFrame:
    """A row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``shapley`` is what the step's filter removes, summed over all orders: its Shapley value times their number,
    a whole number. Null texts are empty; a null part is the empty string. Two texts are equal if 128 bits of hash agree.
    A row fails E if a smaller doc_id has the same text; equal ids are no copies of each other. Rows of
    ``labels`` that repeat an id count once, 1 if any says so; null labels are no 1. Each input row counts once; other columns are ignored.
    An empty table has no parts and gives no rows. ``orders`` restricts the orders that are listed, not those summed over.
    """
    m = len(LETTERS)
    everyone = (1 << m) - 1
    table = coalition_table(failure_cells(docs, labels, part))
    # A part in one row: its coalitions in order, so that a coalition's bits are its place.
    parts = table.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("coalition", "n", "good", "toxic"))).alias("v"))
    shares = [[w * factorial(m) for w in row] for row in shapley_weights(m)]
    if any(x.denominator != 1 for row in shares for x in row):
        raise ArithmeticError("sums over all orders are whole numbers")
    times = lambda row: F.transform(F.split(F.lit(",".join(str(int(x)) for x in row)), ","), lambda x: x.cast("long"))
    total = lambda row: F.aggregate(F.zip_with("v", times(row), lambda v, w: v["n"] * w), F.lit(0).cast("long"), lambda x, y: x + y)
    parts = parts.withColumn("values", F.array(*[total(row) for row in shares]))

    listed = _orders(LETTERS) if orders is None else F.array(*map(F.lit, orders))
    steps = parts.withColumn("filter_order", F.explode(listed)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(m))))
    number = lambda i: f"(instr('{LETTERS}', substr(filter_order, {i}, 1)) - 1)"
    before = F.expr(f"aggregate(sequence(1, {m}), 0, (mask, i) -> IF(i < step, mask | shiftleft(1, {number('i')}), mask))")
    steps = steps.withColumns({"own": F.expr(f"shiftleft(1, {number('step')})"), "before": before, "number": F.expr(number("step"))})
    at = lambda s, name: F.get("v", s)[name]
    steps = steps.withColumn("after", F.col("before").bitwiseOR(F.col("own")))
    # Coalition 0 holds the size of the part, and nothing is removed before the first step.
    lost = lambda name: at(F.col("after"), name) - F.when(F.col("before") == 0, F.lit(0).cast("long")).otherwise(at(F.col("before"), name))
    return steps.select(
        "part",
        "filter_order",
        "step",
        (at(F.lit(0), "n") - at(F.col("after"), "n")).alias("kept"),
        lost("n").alias("removed"),
        (at(F.col("own"), "n") - lost("n")).alias("redundant"),
        (at(F.lit(everyone), "n") - at(F.lit(everyone) - F.col("own"), "n")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("values", F.col("number")).alias("shapley"),
    )
