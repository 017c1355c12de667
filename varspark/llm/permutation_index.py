"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of nearness. Each block
of rows posts its vectors in the inverted files of their pivots, with the place of the
pivot. A query reads the files of its own nearest pivots, which gives the
footrule distance to every vector of the block; the best are ranked anew by cosine.
In a tight crowd the footrule says little, so ranking goes on until the rest of the
block is clearly farther by footrule than the k best found.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varspark.session import stored

#: Rows from which pivots are chosen, pivots, and the largest cosine between two of them.
SAMPLE_ROWS, PIVOTS, APART = 4096, 256, 0.8
#: Pivots that represent a vector, and those whose files a query reads.
POSTED, READ = 128, 64
#: Share of a block that is ranked by cosine at first, and the least number.
RERANKED, LEAST = 0.10, 64
#: Rows whose footrule is above that of the k best by this share of the largest footrule are clearly farther.
CLEAR = 0.10
#: Rows per block, and queries searched in one pass; both bound memory.
BLOCK_ROWS, PASS_QUERIES = 1 << 14, 1 << 13


class Hits(NamedTuple):
    """Best vectors so far, a row per query; id -1 is none."""

    ids: np.ndarray
    scores: np.ndarray


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part: an id, and a vector that is not zero and holds finite numbers only."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", vector.alias("vector")).where("vec_id is not null and size(vector) > 0")
    return rows.where(fine & F.exists("vector", lambda x: x != 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1. They are scaled by their largest part first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Pivots from a bounded sample by hash of vec_id, those apart from each other first, so that a crowd of like vectors gives one pivot.

    All have the commonest length of the sample; vectors of other lengths take no part in the index.
    """
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    if not rows:
        return np.zeros((0, 0))
    lengths = [len(r.vector) for r in rows]
    size = max(set(lengths), key=lambda n: (lengths.count(n), n))
    found = unit(np.array([r.vector for r in rows if len(r.vector) == size]))
    chosen, nearest, crowded = [], np.full(len(found), -2.0), []
    for k in range(len(found)):
        if len(chosen) == pivots:
            break
        if nearest[k] < APART:
            chosen.append(k)
            nearest = np.maximum(nearest, found @ found[k])
        else:
            crowded.append(k)
    return found[(chosen + crowded)[:pivots]]


def build(vectors: DataFrame, pivots: np.ndarray, posted: int = POSTED) -> DataFrame:
    """The index: each row with its nearest pivots in order, stored in the shared folder."""
    size, posted = pivots.shape[1], min(posted, len(pivots))

    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = _order(_matrix(batch.column(1), size), pivots)[:, :posted].astype(np.int16)
                near = pa.ListArray.from_arrays(np.arange(0, order.size + 1, posted, dtype=np.int32), pa.array(order.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), near], ["vec_id", "vector", "near"])

    rows = vectors.where(F.size("vector") == size)
    return stored(rows.mapInArrow(represent, "vec_id long, vector array<double>, near array<short>"), "permutation-index")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _order(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.argsort(-(unit(rows) @ pivots.T), axis=1, kind="stable")


class BlockIndex:
    """Inverted files of one block of rows, which lie in order of vec_id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray, pivots: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.units, near = ids[order], unit(vectors[order]), near[order]
        self.posted = near.shape[1]
        entry = np.argsort(near.ravel(), kind="stable")
        self.rows, self.places = entry // self.posted, (entry % self.posted).astype(np.int32)
        self.files = np.searchsorted(near.ravel()[entry], np.arange(pivots + 1))

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """Sum over the query's pivots of how far their places differ; an absent pivot counts as placed after all posted ones."""
        far = np.full(len(self.ids), (self.posted - np.arange(len(near))).sum(), np.int32)
        for place, pivot in enumerate(near):
            lo, hi = self.files[pivot], self.files[pivot + 1]
            far[self.rows[lo:hi]] -= (self.posted - place) - np.abs(self.places[lo:hi] - place)
        return far

    def nearest(self, query: int, vector: np.ndarray, near: np.ndarray, k: int, reranked: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of largest cosine (ties: smaller vec_id) among the best by footrule, never the query's own row.

        The first cut is a share of the block; all rows that are not clearly farther than the k best found are ranked as well.
        """
        n = min(max(int(np.ceil(reranked * len(self.ids))), least, k), len(self.ids))
        far, own = self.footrule(near).astype(np.int64), self.ids == query
        key = far * len(self.ids) + np.arange(len(self.ids))
        key[own] = np.iinfo(np.int64).max
        found = np.sort(np.argpartition(key, n - 1)[:n])
        found = found[~own[found]]
        margin = CLEAR * (self.posted - np.arange(len(near))).sum()
        # All rows up to this footrule are ranked; of those at the cut itself some may not be.
        reached = far[found].max(initial=0) - 1
        while True:
            score = np.einsum("ij,j->i", self.units[found], vector)
            best = np.lexsort((self.ids[found], -score))[:k]
            clear = far[found[best]].max(initial=0) + margin
            if not len(best) or clear <= reached:
                return self.ids[found[best]], score[best]
            found, reached = np.flatnonzero((far <= clear) & ~own), clear


def _merged(hits: Hits, row: int, ids: np.ndarray, scores: np.ndarray) -> None:
    ids, scores = np.concatenate([hits.ids[row], ids]), np.concatenate([hits.scores[row], scores])
    best = np.lexsort((ids, -scores))[: hits.ids.shape[1]]
    hits.ids[row], hits.scores[row] = ids[best], scores[best]


def search(index: DataFrame, pivots: np.ndarray, queries: DataFrame, k: int = 5, read: int = READ, reranked: float = RERANKED, least: int = LEAST, pass_queries: int = PASS_QUERIES) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank, vec_id, score (cosine).

    ``queries`` has vec_id and vector. They are taken in passes of about ``pass_queries``; a
    pass sends its queries to all tasks and reads the index once, so nothing
    is shuffled but the k best of each query and task. Queries without any candidate have no rows.
    """
    spark = index.sparkSession
    size = pivots.shape[1] if len(pivots) else 0
    queries = queries.where(F.size("vector") == size)
    passes = max(1, -(-queries.count() // pass_queries))
    found = []
    for number in range(passes):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).orderBy("vec_id").collect()
        if rows:
            vectors = np.array([r.vector for r in rows])
            asked = spark.sparkContext.broadcast((np.array([r.vec_id for r in rows]), unit(vectors), _order(vectors, pivots)[:, :read]))
            found.append(_one_pass(index, asked, len(pivots), size, k, reranked, least))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _one_pass(index: DataFrame, asked, pivots: int, size: int, k: int, reranked: float, least: int) -> DataFrame:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors, near = asked.value
        hits = Hits(np.full((len(query_ids), k), -1), np.full((len(query_ids), k), -np.inf))
        held: list[pa.RecordBatch] = []

        def searched() -> None:
            if held:
                rows = pa.Table.from_batches(held).combine_chunks()
                column = lambda c, width: _matrix(rows.column(c).combine_chunks(), width)
                lists = rows.column(2).combine_chunks()
                block = BlockIndex(rows.column(0).to_numpy(), column(1, size), column(2, len(lists[0])), pivots)
                for row, query in enumerate(query_ids):
                    _merged(hits, row, *block.nearest(query, vectors[row], near[row], k, reranked, least))
                held.clear()

        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                if sum(b.num_rows for b in held) + min(batch.num_rows - lo, BLOCK_ROWS) > BLOCK_ROWS:
                    searched()
                held.append(batch.slice(lo, BLOCK_ROWS))
        searched()
        some = hits.scores > -np.inf
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(query_ids, some.sum(axis=1))), pa.array(hits.ids[some]), pa.array(hits.scores[some])],
            ["query_id", "vec_id", "score"],
        )

    return index.mapInArrow(look, "query_id long, vec_id long, score double")


def neighbours(vectors: DataFrame, every: int = 50, k: int = 5, **options) -> DataFrame:
    """Index all rows and search those whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    Reads vec_id and embedding; other columns are ignored. Rows without id, and vectors that are
    null, empty, zero, of an unusual length or not finite, take no part. Rows that repeat a
    vec_id are candidates each, but never of a query with that id. An empty table gives no rows.
    """
    rows = usable(vectors)
    pivots = choose_pivots(rows)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build(rows, pivots)
    asked = index.where(F.col("vec_id") % every == 0).select("vec_id", "vector").dropDuplicates(["vec_id"])
    return search(index, pivots, asked, k, **options)
