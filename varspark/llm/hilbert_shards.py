"""Sharding along a Hilbert curve over document metadata, so that files can be skipped by any of its dimensions.

Each dimension is cut into cells of equal numbers of rows. The cells of a row are a point of a
grid, whose place on the curve orders the rows; neighbours on the curve are neighbours in every dimension.
Runs of the order are the shards. Only narrow rows are sorted to find where the runs
end; with those few keys known, each text is shuffled once, straight to its place.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varspark.llm.columns import wide_hash
from varspark.llm.stages import Stages
from varspark.session import stored

#: Bits per dimension: 256 cells.
BITS = 8
#: Bytes that a row counts beside its text.
ROW_BYTES = 8
#: Order of rows: the curve, then doc_id (null first) and hashes of text and dimensions. None is null.
KEY = ["curve", "has_id", "doc", "ta", "tb"]


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid points (a row each, a column per dimension, the first leading)."""
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        high, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for axis in x:
            flip = (axis & high) > 0
            swap = np.where(flip, np.uint64(0), (x[0] ^ axis) & low)
            x[0] ^= np.where(flip, low, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint64(level) & one > 0, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= turn
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            place = place << one | axis >> np.uint64(level) & one
    return place.astype(np.int64)


def in_order(rows: DataFrame, keys: Sequence[str], weight: str, stages: Stages) -> DataFrame:
    """The rows with ``rank`` (rows before) and ``before`` (their weight) in the order of the keys.

    Rows are sorted within ranges; a range knows the sums of those before from one row per range.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            w = batch.column(at).to_numpy().astype(np.int64)
            before = total + np.cumsum(w) - w
            added = [pa.array(np.full(len(w), part, np.int32)), pa.array(n + np.arange(len(w))), pa.array(before)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "range", "rank", "before"])
            n, total = n + len(w), total + int(w.sum())

    at = rows.columns.index(weight)
    schema = T.StructType([*rows.schema.fields, T.StructField("range", T.IntegerType()), T.StructField("rank", T.LongType()), T.StructField("before", T.LongType())])
    sorted_rows = stages.stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(summed, schema), "curve-order")
    sizes = sorted_rows.groupBy("range").agg(F.count("*").alias("n"), F.sum(weight).alias("w"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = sizes.select("range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("n", "w")])
    return sorted_rows.join(offsets, "range").select(*rows.columns, (F.col("rank") + F.col("n0")).alias("rank"), (F.col("before") + F.col("w0")).alias("before"))


def cell_bounds(rows: DataFrame, dimension: str, n_rows: int, bits: int, stages: Stages) -> tuple[list, list[int]]:
    """Least value of each cell in use, and the cell: cells hold equal shares of all rows, so a common value spans many.

    Values are counted before they are ordered; 2**bits rows at most come to the driver.
    """
    values = rows.groupBy(F.col(dimension).alias("value")).agg(F.count("*").alias("n"))
    cell = F.expr(f"cast(before as decimal(20, 0)) * {1 << bits} div {max(n_rows, 1)}").cast("int")
    placed = in_order(values, ["value"], "n", stages).where("value is not null")
    found = placed.groupBy(cell.alias("cell")).agg(F.min("value").alias("low")).orderBy("cell").collect()
    return [r.low for r in found], [r.cell for r in found]


def _curve(bounds: list[tuple[list, list[int]]], bits: int):
    """Column function from the dimensions to the curve index; null lies in cell 0."""

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        cells = np.zeros((len(columns[0]), len(bounds)), np.int64)
        for k, (values, (low, cell)) in enumerate(zip(columns, bounds, strict=True)):
            known = values.notna().to_numpy()
            if len(low) and known.any():
                least = np.array(low, object) if isinstance(low[0], str) else np.array(low)
                at = np.searchsorted(least, values[known].to_numpy(least.dtype), "right") - 1
                cells[known, k] = np.array(cell)[at]
        return pd.Series(curve_index(cells, bits))

    return index


def _run_of(first_keys: list[tuple[int, ...]], numbers: list[int]):
    """Column function from a row's key to its shard, by binary search among the first keys of the shards."""

    @F.pandas_udf("int")
    def shard(*key: pd.Series) -> pd.Series:
        return pd.Series([numbers[max(bisect_right(first_keys, k) - 1, 0)] for k in zip(*key, strict=True)], dtype="int32")

    return shard


def write_shards(docs: DataFrame, path: str, dimensions: dict[str, Column], shards: int = 24, law: str = "rows", bits: int = BITS) -> DataFrame:
    """Write the documents to ``shards`` folders in curve order; returns the manifest, which is read off the files.

    ``law`` says what the runs share equally: ``rows`` (counts at most one apart) or ``bytes`` (each row goes to the
    share of all bytes that holds its middle). Rows of one place on the curve are ordered by doc_id, then by hashes of text and dimensions;
    rows that agree in all of these stay in one shard. Nulls come first and lie in cell 0. A file row holds
    ``row`` (the document's columns, whatever their names), ``size``, its dimensions and its ``place`` in the order.

    The manifest has a row per shard that holds any: shard, n, bytes, and for each dimension its least and
    largest value (``<name>_low``, ``<name>_high``), which are null where all are.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"no such law: {law}")
    if bits * len(dimensions) > 62:
        raise ValueError("the curve index has to fit 62 bits")
    spark, stages = docs.sparkSession, Stages(docs.sparkSession)
    names = [f"d{k}" for k in range(len(dimensions))]
    tie = wide_hash("text", *dimensions.values())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.col("doc_id").isNotNull().cast("int").alias("has_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"),
        tie["a"].alias("ta"), tie["b"].alias("tb"), *[c.alias(d) for d, c in zip(names, dimensions.values(), strict=True)],
    )
    narrow = stages.stored(rows.drop("row"), "curve-rows")
    whole = narrow.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    index = _curve([cell_bounds(narrow, d, whole.n, bits, stages) for d in names], bits)
    ordered = in_order(narrow.withColumn("curve", index(*names)).select(*KEY, "size"), KEY, "size", stages)
    if law == "rows":
        share = F.expr(f"((cast(rank as decimal(20, 0)) + 1) * {shards} - 1) div {max(whole.n, 1)}")
    else:
        share = F.expr(f"(cast(2 * before + size as decimal(20, 0)) * {shards}) div {max(2 * whole.bytes, 1)}")
    # A row per shard comes to the driver: the key of its first document.
    first = ordered.groupBy(share.cast("int").alias("shard")).agg(F.min(F.struct(*KEY)).alias("key")).orderBy("shard").collect()
    run_of = _run_of([tuple(r.key) for r in first], [r.shard for r in first])
    placed = rows.withColumn("curve", index(*names)).withColumn("shard", run_of(*KEY))
    dealt = placed.repartitionByRange("shard", *KEY).sortWithinPartitions("shard", *KEY)
    dealt = dealt.select("row", "size", *names, F.monotonically_increasing_id().alias("place"), "shard")
    dealt.write.partitionBy("shard").parquet(path)
    stages.drop()
    ends = [f(d).alias(f"{name}_{end}") for d, name in zip(names, dimensions, strict=True) for f, end in ((F.min, "low"), (F.max, "high"))]
    return spark.read.schema(dealt.schema).parquet(path).groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *ends)


def read_shards(spark: SparkSession, path: str, manifest: DataFrame, **ranges: tuple) -> DataFrame:
    """shard, place and row of the shards that may hold values in all the ranges: dimension=(low, high), None where open.

    The manifest, a row per shard, chooses the folders; only those are listed and read. Rows of other values in them are not left out.
    """
    may = F.lit(True)
    for name, (low, high) in ranges.items():
        may = may & (F.lit(low is None) if low is None else F.col(f"{name}_high") >= F.lit(low))
        may = may & (F.lit(high is None) if high is None else F.col(f"{name}_low") <= F.lit(high))
    wanted = [r.shard for r in manifest.where(may).select("shard").collect()]
    return spark.read.parquet(path).where(F.col("shard").isin(wanted)).select("shard", "place", "row")


def sharded_documents(docs: DataFrame, dimensions: dict[str, Column], shards: int = 24, law: str = "rows", bits: int = BITS) -> DataFrame:
    """Write shards, read them back, and place each document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 8, a null text has none; ``text_crc32`` is unsigned, 0 for null. ``slot`` is the place
    within the shard, from 0. No law of this method depends on the number of shards alone, so ``grown_shard`` is null. Each input row
    gives one row; an empty table gives none. Other columns are carried in the files, whatever their names.
    """
    spark, stages = docs.sparkSession, Stages(docs.sparkSession)
    path = stages.path("curve-shards")
    write_shards(docs, path, dimensions, shards, law, bits)
    shape = T.StructType([T.StructField("row", T.StructType([docs.schema["doc_id"], docs.schema["text"]])), T.StructField("place", T.LongType()), T.StructField("shard", T.IntegerType())])
    text = F.coalesce("row.text", F.lit(""))
    size = F.octet_length(text).cast("long") + ROW_BYTES
    found = spark.read.schema(shape).parquet(path).select("row.doc_id", size.alias("size"), F.crc32(text).alias("text_crc32"), "shard", "place")
    found = stored(found, "curve-places").withColumn("part", F.shiftright("place", 33))
    stages.drop()
    # A task's rows of a shard lie together; a row per task and shard tells how many lie before.
    runs = found.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("low"))
    earlier = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("shard", "part", (F.col("low") - F.coalesce(earlier, F.lit(0))).alias("low"))
    return found.join(runs, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("place") - F.col("low")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
