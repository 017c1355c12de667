"""Ordered computations that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def running_total(
    df: DataFrame,
    value: Column,
    out: str,
    *,
    order: Sequence[str],
    keys: Sequence[str] = (),
    width: int = BLOCK,
) -> DataFrame:
    """Inclusive prefix sum of ``value`` per ``keys``.

    The first ``order`` column is an integer and cuts each group into blocks of
    ``width`` values. Rows are sorted inside one block only; the block totals,
    one row per block, carry the sums of the blocks before.
    """
    block = F.floor(F.col(order[0]) / F.lit(width)).cast("long")
    rows = df.withColumn("_block", block).withColumn("_value", value)
    totals = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.join(offsets, [*keys, "_block"])
        .withColumn(out, F.col("_offset") + F.sum("_value").over(inside))
        .drop("_block", "_value", "_offset")
    )


def row_index(
    df: DataFrame, out: str, *, order: Sequence[str], keys: Sequence[str] = (), width: int = BLOCK
) -> DataFrame:
    """Position of each row in its group, from 0."""
    return running_total(df, F.lit(1), out, order=order, keys=keys, width=width).withColumn(
        out, (F.col(out) - 1).cast("long")
    )


def _edge_rows(df: DataFrame, n: int, keys: Sequence[str], order: str, latest: bool, width: int) -> DataFrame:
    block = F.floor(F.col(order) / F.lit(width)).cast("long")
    by = F.col(order).desc() if latest else F.col(order).asc()
    return (
        df.withColumn("_block", block)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(by)))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(by)))
        .filter(F.col("_rank") <= n)
        .drop("_block", "_rank")
    )


def last_rows(df: DataFrame, n: int, *, keys: Sequence[str], order: str, width: int = BLOCK) -> DataFrame:
    """The ``n`` rows of each group that come last.

    Ranked first per block of the order column and then per group: the second
    rank sees at most ``n`` rows of a block, and Spark cuts both before the
    shuffle as well.
    """
    return _edge_rows(df, n, keys, order, True, width)


def first_rows(df: DataFrame, n: int, *, keys: Sequence[str], order: str, width: int = BLOCK) -> DataFrame:
    """The ``n`` rows of each group that come first, found like the last ones."""
    return _edge_rows(df, n, keys, order, False, width)
