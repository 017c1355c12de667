"""Language identification by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary n-gram classifier
tells the languages with a one from those with a zero. The prediction is the language whose codeword loses
least against the bit margins, bits weighted by how well their classifier did on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varspark.llm.blocks import Block, mixed, text_blocks

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
BUCKET_BITS = 15
#: Bytes whose n-grams are held at once, however long a text is.
SLICE = 1 << 18
#: Bound on the fitting sample: documents per language, by hash of doc_id.
SAMPLE_DOCS = 4000
#: Languages up to which the code has every split of the languages as a bit.
EXHAUSTIVE = 6
#: Log odds count fully up to so many n-grams; a longer text is no surer than that.
ENOUGH = 60.0
#: Predictions with a smaller share of the decoding weight are flagged ambiguous.
CLEAR = 0.6

_CLASS = np.full(256, 0x20, np.uint8)  # what is not a letter separates words
_CLASS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[0x80:] = np.arange(0x80, 0x100)
_SCALE = 1 << 16


class Model(NamedTuple):
    """Languages, codewords (+1/-1, a row each), bit weights, and fixed-point log odds per bucket and bit."""

    languages: list[str]
    code: np.ndarray
    reliability: np.ndarray
    odds: np.ndarray


def codewords(languages: int) -> np.ndarray:
    """Rows far apart: all splits for few languages, else the best of some random codes."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        # Bit strings without the constant one and without complements: the last language is always 0.
        columns = np.arange(1, 1 << (languages - 1))
        return np.where(columns >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    rng = np.random.default_rng(languages)
    bits = int(np.ceil(10 * np.log2(languages)))
    apart = lambda c: (c[:, None] != c[None]).sum(axis=2)[~np.eye(len(c), dtype=bool)].min()
    tried = [rng.choice([-1, 1], (languages, bits)).astype(np.int8) for _ in range(32)]
    return max((c for c in tried if (np.abs(c.sum(axis=0)) < languages).all()), key=apart, default=tried[0])


def _ngrams(block: Block, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of the block's rows, in slices of bounded size: buckets in order of place, the rows that have any, and where each of these begins."""
    for lo in range(0, max(len(block.data) - order + 1, 0), SLICE):
        data = _CLASS[block.data[lo : lo + SLICE + order - 1]].astype(np.uint64)
        n = len(data) - order + 1
        key = np.full(n, order, np.uint64)
        for k in range(order):
            key = key << np.uint64(8) | data[k : k + n]
        bucket = (mixed(key) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        # Rows of the slice, and the n-grams that end within their row.
        row = np.arange(np.searchsorted(block.starts, lo, "right") - 1, np.searchsorted(block.starts, lo + n, "left"))
        first = np.clip(block.starts[row] - lo, 0, n)
        last = np.clip(block.starts[row + 1] - order + 1 - lo, first, n)
        kept = last > first
        row, first, last = row[kept], first[kept], last[kept]
        if len(row):
            inside = np.zeros(n + 1, np.int8)
            inside[first] += 1
            inside[last] -= 1
            yield bucket[np.cumsum(inside[:-1], dtype=np.int8) > 0], row, np.cumsum(last - first) - (last - first)


def _any_per_row(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows in which the mask holds anywhere."""
    found = np.zeros(len(starts) - 1, bool)
    filled = starts[:-1] < starts[1:]
    if filled.any():
        found[filled] = np.logical_or.reduceat(mask, starts[:-1][filled])
    return found


def _has_letter(block: Block) -> np.ndarray:
    """Rows with a letter. ASCII letters are seen in bytes; only rows with none but other bytes are decoded, a slice at a time."""
    found = _any_per_row((block.data | 0x20) - np.uint8(ord("a")) < 26, block.starts)
    for k in np.flatnonzero(~found & _any_per_row(block.data >= 0x80, block.starts)):
        data = block.data[block.starts[k] : block.starts[k + 1]]
        # Slices overlap by three bytes, so that each character lies whole in one of them.
        found[k] = any(any(map(str.isalpha, data[lo : lo + SLICE + 3].tobytes().decode("utf-8", "ignore"))) for lo in range(0, len(data), SLICE))
    return found


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def _sample(docs: DataFrame, label: str, sample_docs: int) -> DataFrame:
    """Up to ``sample_docs`` labelled rows per language, and rows that tie with the last, not held out."""
    rows = docs.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).select(
        "text", F.col(label).alias("lang"), F.xxhash64("doc_id").alias("at")
    )
    # The first of each language, found in parts, so that a common language is not ranked in one task.
    first = rows.select("lang", "at").withColumn("part", F.pmod("at", F.lit(64)))
    for parts in (["lang", "part"], ["lang"]):
        first = first.withColumn("nth", F.row_number().over(Window.partitionBy(*parts).orderBy("at"))).where(F.col("nth") <= sample_docs)
    last = first.groupBy("lang").agg(F.max("at").alias("last")).collect()  # a row per language
    chosen = [(F.col("lang") == r.lang) & (F.col("at") <= r["last"]) for r in last]
    return rows.where(reduce(or_, chosen, F.lit(False))).select("text", "lang")


def fit(docs: DataFrame, label: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learn from labelled documents that are not held out.

    What comes to the driver is a number per language and bucket. Rows with
    null label, and languages without any n-gram, teach nothing; texts are read whole.
    """
    buckets = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for block in text_blocks(batch.column(0)):
                for order in ORDERS:
                    for bucket, rows, begins in _ngrams(block, order):
                        for row, part in zip(rows, np.split(bucket, begins[1:]), strict=True):
                            counts = total.setdefault(langs[block.first + row], np.zeros(buckets, np.int64))
                            np.add.at(counts, part, 1)
        for lang, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])], ["lang", "bucket", "n"])

    table = _sample(docs, label, sample_docs).mapInArrow(count, "lang string, bucket long, n long")
    table = table.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), buckets))
    place = {x: k for k, x in enumerate(languages)}
    counts[table["lang"].map(place).to_numpy(int), table["bucket"].to_numpy(int)] = table["n"].to_numpy(float)
    return _fitted(languages, counts)


def _fitted(languages: list[str], counts: np.ndarray) -> Model:
    """Classifiers from n-gram counts: languages weigh alike on each side of a bit, whatever their share of the sample."""
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.ones(1), np.zeros((counts.shape[1], 1), np.int32))
    smooth = counts + 0.5
    share = smooth / smooth.sum(axis=1, keepdims=True)
    odds = np.stack([np.log(share[bit > 0].mean(axis=0) / share[bit < 0].mean(axis=0)) for bit in code.T], axis=1)
    # A bit is as reliable as the margin it gives the languages on its right side, the least of them counting.
    margin = (share @ odds) * code
    reliability = np.maximum(margin.min(axis=0), 1e-3)
    return Model(languages, code, reliability / reliability.sum(), np.round(odds * _SCALE).astype(np.int32))


def _decode(model: Model, sums: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language and its score per row, from summed log odds and numbers of n-grams."""
    evidence = np.minimum(n, ENOUGH) / np.maximum(n, 1)
    margin = sums / _SCALE * evidence[:, None]
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ model.reliability
    weight = np.exp(loss.min(axis=1, keepdims=True) - loss)
    best = loss.argmin(axis=1)
    return best, weight[np.arange(len(best)), best] / weight.sum(axis=1)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with lang_pred, lang_score (0 to 1) and lang_ambiguous; only ``text`` is read.

    Texts that are null or have no letter are ``und``, score 0 and not
    ambiguous, and so is every text if no language was learned. Ties go to the language that sorts first. Columns of these names are
    replaced. Sums are integers, so a prediction does not depend on how rows are batched.
    """
    names = ["lang_pred", "lang_score", "lang_ambiguous"]
    docs = docs.drop(*names)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang: list[str] = []
            scores: list[float] = []
            for block in text_blocks(batch.column(at)):
                rows = block.last - block.first
                sums, n = np.zeros((rows, model.odds.shape[1]), np.int64), np.zeros(rows)
                for order in ORDERS:
                    for bucket, row, begins in _ngrams(block, order):
                        sums[row] += np.add.reduceat(model.odds[bucket], begins, axis=0, dtype=np.int64)
                        n[row] += np.diff(np.append(begins, len(bucket)))
                known = _has_letter(block) & (len(model.languages) > 0)
                best, score = _decode(model, sums, n) if model.languages else (np.zeros(rows, int), np.zeros(rows))
                lang += [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
                scores += np.where(known, score, 0.0).tolist()
            unsure = [x != UNDETERMINED and s < CLEAR for x, s in zip(lang, scores, strict=True)]
            added = [pa.array(lang, pa.string()), pa.array(scores, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])
    return docs.mapInArrow(predict, schema)
