"""N-gram Jaccard join: which texts share most of their word shingles.

Sets are compared only if they share keys that every linked pair must share. In
an order that puts tokens of crowded hash buckets last, a set of n tokens takes
its first n - ceil(t n) + l; two linked sets share l tokens of these prefixes. Small
sets enumerate the 2-subsets of their prefix (l = 2), which few other sets have. Large sets
file the tokens themselves in inverted lists, which are scanned, and must meet in l lists.
The boundary between small and large is where the estimated cost is least.

Links are found in two passes over the lists. The first joins each set to one hub
per list; sets that its links connect need no further comparison. The second scans the
lists for pairs between different components. Both drop pairs by size and by a bound on
the difference from parity bitmaps, and the rest is verified on the whole sets.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.llm.blocks import Block, RunHashes, mixed, spaced_words, text_blocks
from varspark.llm.columns import spare
from varspark.llm.components import connected
from varspark.llm.stages import Stages, shuffles_removed
from varspark.session import stored

GRAM = 5
#: Least similarity in per cent.
SIMILARITY = 75
#: Bits of a token's hash that name its bucket; the counts of all buckets are 4 MB in the driver.
BUCKET_BITS = 19
#: Bits of a set's parity bitmap.
BITMAP_BITS = 1024
#: Hubs that the first pass verifies per set. More of them leave fewer pairs to the second pass; the links found are the same.
HUBS = 8
#: Members of a list compared by one task; longer lists are dealt out as pairs of blocks.
LIST_BLOCK = 2048
#: Rows of lists with one smallest member that one task reads; more of them are dealt to several tasks.
LEAD_ROWS = 8192

_SEED = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Plan(NamedTuple):
    """Crowded buckets, and the size up to which sets are small."""

    crowded: np.ndarray
    small: int
    similarity: int


# ---- sets


def shingle_sets(block: Block, gram: int = GRAM) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row: ``gram`` words, or all words if there are fewer; none without words."""
    data, starts, ends, first = spaced_words(block)
    words = RunHashes(data).of(starts, ends)
    factors = mixed(np.arange(1, gram + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(len(words) - gram + 1, 0)
    with np.errstate(over="ignore"):
        grams = np.zeros(n, np.uint64)
        for k in range(gram):
            grams += words[k : k + n] * factors[k]
        grams = mixed(grams)
        for row in range(block.last - block.first):
            lo, hi = first[row], first[row + 1]
            if hi - lo >= gram:
                yield np.unique(grams[lo : hi - gram + 1])
            else:
                yield mixed(np.array([(words[lo:hi] * factors[: hi - lo]).sum() + np.uint64(hi - lo)]) if hi > lo else np.zeros(0, np.uint64))


def set_hash(tokens: np.ndarray, seed: int) -> int:
    with np.errstate(over="ignore"):
        return int(mixed(np.array([mixed(tokens ^ _SEED[seed]).sum(dtype=np.uint64) + np.uint64(len(tokens))])).astype(np.int64)[0])


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens per bit: where two bitmaps differ, the sets differ."""
    counts = np.bincount((tokens & np.uint64(BITMAP_BITS - 1)).astype(np.int64), minlength=BITMAP_BITS)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _sets(batch: pa.RecordBatch, column: int, gram: int) -> Iterator[np.ndarray]:
    for block in text_blocks(batch.column(column)):
        yield from shingle_sets(block, gram)


def members(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """doc_id, tie (text hash), n (set size), id and check (two hashes of the set) per row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(len(s), set_hash(s, 0), set_hash(s, 1)) for s in _sets(batch, 1, gram)]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["doc_id", "tie", "n", "id", "check"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    return rows.mapInArrow(read, "doc_id long, tie long, n long, id long, check long")


# ---- plan


def bucket_counts(docs: DataFrame, gram: int = GRAM) -> np.ndarray:
    """Tokens of all sets per hash bucket, summed in the tasks and then by parts of the buckets."""
    parts, size = 64, (1 << BUCKET_BITS) // 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for tokens in _sets(batch, 0, gram):
                held.append(tokens >> np.uint64(64 - BUCKET_BITS))
                if sum(map(len, held[-1:])) > 1 << 18 or len(held) == 1024:
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total))
                    held.clear()
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total))
        yield packed(enumerate(total.reshape(parts, size)))

    def packed(rows) -> pa.RecordBatch:
        numbers, counts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([c.astype("<i8").tobytes() for c in counts])], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts.as_buffer(), "<i8")
        if total:
            yield packed(total.items())

    schema = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).repartition(parts, "part").mapInArrow(add, schema).collect()
    counts = np.zeros((parts, size), np.int64)
    for r in rows:
        counts[r.part] = np.frombuffer(r.counts, "<i8")
    return counts.ravel()


def _need(n, similarity: int):
    """Least overlap of a set of n tokens with any set it is linked to."""
    return -(-similarity * n // 100)


def _meet(n):
    """Prefix tokens that a large set must share with a partner that is not smaller."""
    return 1 + n // 20


def _least(similarity: int) -> int:
    """Tokens of the smallest set that can be linked to another set: its best partner has one token more."""
    return -(-similarity // (100 - similarity)) if similarity < 100 else sys.maxsize


def _partners_met(similarity: int) -> bool:
    """Whether a large set shares ``_meet`` of its own size with every smaller partner too, not of the partner's size only.

    The gap grows with the sizes, so that none over 1,000 tokens has to be tried.
    """
    n, m = np.arange(1, 1001)[:, None], np.arange(1, 1001)
    partners = (m <= n) & (100 * m >= similarity * n)
    both = np.minimum(-(-similarity * (n + m) // (100 + similarity)), m)
    return bool((np.minimum(both - _need(m, similarity) + _meet(m), both) >= _meet(n))[partners].all())


def make_plan(counts: np.ndarray, sizes: dict[int, int], similarity: int = SIMILARITY) -> Plan:
    """The boundary of least cost.

    A small set costs its subsets; sets up to 1/t of the boundary have subsets too, to meet
    small partners. A large set costs its prefix times the mean length of a list, which
    is the second moment of the tokens by the first; the bucket counts give both.
    Up to 50 per cent, sets that share one token can be linked, which subsets of two do not find.
    """
    if not 50 < similarity <= 100:
        raise ValueError(f"similarity is {similarity}; it has to be over 50 and at most 100 per cent")
    middle = float(np.median(counts))
    crowded = counts > middle + 6 * np.sqrt(middle) + 8
    light = counts[~crowded].astype(float)
    total = max(light.sum(), 1.0)
    length = max(1.0, (np.square(light).sum() - total**2 / len(light)) / total)
    n = np.array(sorted(sizes), float)
    sets = np.array([sizes[int(k)] for k in n], float)
    spare = n - _need(n, similarity)
    subsets = sets * (spare + 2) * (spare + 1) / 2
    scans = sets * (spare + _meet(n)) * length
    costs = [subsets[n <= s * 100 // similarity].sum() + scans[n > s].sum() for s in range(129)]
    return Plan(crowded, int(np.argmin(costs)), similarity)


def keys_of(tokens: np.ndarray, plan: Plan) -> np.ndarray:
    """Keys of a set: even ones for subsets, odd ones for tokens."""
    n = len(tokens)
    late = plan.crowded[(tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
    ordered = np.concatenate([tokens[~late], tokens[late]])
    spare = n - int(_need(n, plan.similarity))
    keys, least = [], _least(plan.similarity)  # smaller sets are linked to equal ones only
    if least <= n <= plan.small * 100 // plan.similarity:
        head = ordered[: spare + 2]
        i, j = np.triu_indices(len(head), 1)
        low, high = np.minimum(head[i], head[j]), np.maximum(head[i], head[j])
        with np.errstate(over="ignore"):
            keys.append(mixed(low * _SEED[0] + high * _SEED[1]) & ~np.uint64(1))
    if n > plan.small and n >= least:
        keys.append(mixed(ordered[: spare + _meet(n)]) | np.uint64(1))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


# ---- lists


def postings(docs: DataFrame, plan: Plan, gram: int = GRAM) -> DataFrame:
    """key, id, n; equal sets of a batch give their keys once."""
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            keys, ids, sizes, held = [], [], [], 0

            def made() -> pa.RecordBatch:
                each = [len(k) for k in keys]
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), each)), pa.array(np.repeat(np.array(sizes, np.int32), each))],
                    ["key", "id", "n"],
                )

            for tokens in _sets(batch, 0, gram):
                if (number := set_hash(tokens, 0)) not in seen:
                    seen.add(number)
                    keys.append(keys_of(tokens, shared.value)), ids.append(number), sizes.append(len(tokens))
                    held += len(keys[-1])
                    if held > 1 << 18:
                        yield made()
                        keys, ids, sizes, held = [], [], [], 0
            if held:
                yield made()

    return docs.select("text").mapInArrow(read, "key long, id long, n int")


def shared_lists(rows: DataFrame) -> DataFrame:
    """Postings of keys that two or more sets have, each (key, id) once. Lists are streamed in order, never held."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[np.ndarray, ...] | None = None  # the last posting
        told = False  # whether it has been given out
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            key, number, n = now if last is None else [np.concatenate([a, b]) for a, b in zip(last, now, strict=True)]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
            key, number, n = key[fresh], number[fresh], n[fresh]
            like = np.zeros(len(key) + 1, bool)
            like[1:-1] = key[1:] == key[:-1]
            some = like[1:] | like[:-1]
            if told:
                some |= key == key[0]  # the rest of a list that has begun
                some[0] = False
            last_told = bool(like[-2] or (told and key[-1] == key[0]))
            last, told = (key[-1:], number[-1:], n[-1:]), last_told
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(number[some]), pa.array(n[some])], ["key", "id", "n"])

    return rows.repartition("key").sortWithinPartitions("key", "id").mapInArrow(read, rows.schema)


def _token_list(key: Column) -> Column:
    return F.pmod(key, F.lit(2)) == 1


def with_partners(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Postings of sets that meet others often enough to be linked at all."""
    least = 1 + F.floor(F.max("n") / 20) if _partners_met(similarity) else F.lit(1)
    enough = F.count_if(_token_list(F.col("key"))) >= least
    possible = lists.groupBy("id").agg((enough | (F.count_if(~_token_list(F.col("key"))) > 0)).alias("possible")).where("possible")
    return lists.join(possible.select("id"), "id", "left_semi")


def set_table(docs: DataFrame, chosen: DataFrame, gram: int = GRAM) -> DataFrame:
    """id, tokens and bits of chosen sets; ``chosen`` names one document for each (doc_id, id)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                # A row that only repeats the doc_id has another set.
                found = [(i, s) for i, s in zip(wanted[lo:], _sets(part, 1, gram)) if set_hash(s, 0) == i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in found], pa.int64()), pa.array([s.tobytes() for _, s in found], pa.binary()), pa.array([bitmap(s) for _, s in found], pa.binary())],
                    ["id", "tokens", "bits"],
                )

    pick = chosen.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), "id")
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_tie"))
    rows = docs.select("doc_id", "text").join(pick, here).select("id", "text")
    return rows.mapInArrow(read, "id long, tokens binary, bits binary").dropDuplicates(["id"])


# ---- pairs


def _close(n: np.ndarray, m: np.ndarray, bits: np.ndarray, others: np.ndarray, similarity: int) -> np.ndarray:
    """Pairs that size and bitmaps leave: a linked pair differs in at most (1 - t) / (1 + t) of both sizes."""
    fit = similarity * np.maximum(n, m) <= 100 * np.minimum(n, m)
    fit[fit] = (100 + similarity) * np.bitwise_count(bits[fit] ^ others[fit]).sum(axis=1, dtype=np.int64) <= (100 - similarity) * (n + m)[fit]
    return fit


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BITMAP_BITS // 64)


def hub_pairs(lists: DataFrame, similarity: int) -> DataFrame:
    """a, b: each set with the hub of its list, which is a random member (by hash, alike in every run). Lists are streamed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            key, number, n = [batch.column(i).to_numpy() for i in range(3)]
            if not len(key):
                continue
            bits = _bits(batch.column(3))
            if hub is not None:
                key, number, n, bits = [np.concatenate([a, b]) for a, b in zip(hub, (key, number, n, bits), strict=True)]
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
            rest = np.flatnonzero(number != number[first])
            near = rest[_close(n[rest].astype(np.int64), n[first[rest]].astype(np.int64), bits[rest], bits[first[rest]], similarity)]
            yield pa.RecordBatch.from_arrays([pa.array(number[near]), pa.array(number[first[near]])], ["a", "b"])
            k = first[-1]
            hub = key[k : k + 1], number[k : k + 1], n[k : k + 1], bits[k : k + 1]

    rows = lists.select("key", "id", "n", "bits", F.xxhash64("key", "id").alias("at"))
    return rows.repartition("key").sortWithinPartitions("key", "at").select("key", "id", "n", "bits").mapInArrow(read, "a long, b long")


def _different(lo: int, x: np.ndarray, y: np.ndarray, rows: list[np.ndarray], similarity: int) -> tuple[np.ndarray, ...]:
    """Of the pairs x, y of members of the list that begins at ``lo``, those to be verified: a, b, lists they must have in common."""
    key, _, i, j, block, number, n, bits, component = rows
    x, y = x + lo, y + lo
    open_ = (component[x] != component[y]) & ((i[x] == j[x]) | (block[x] != block[y]))
    x, y = x[open_], y[open_]
    near = _close(n[x], n[y], bits[x], bits[y], similarity)
    x, y = x[near], y[near]
    must = np.where(key[x] & 1 == 1, _meet(np.minimum(n[x], n[y])), 1)
    return np.minimum(number[x], number[y]), np.maximum(number[x], number[y]), must


def _pairs_of(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a list's members, in parts of bounded size."""
    if size <= 256:
        yield np.triu_indices(size, 1)
    else:
        for x in range(1, size):
            yield np.full(x, x), np.arange(x)


def _counted(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Each pair once, with the number of lists in which it was found."""
    a, b, must = [np.concatenate(c) for c in zip(*found, strict=True)]
    order = np.lexsort((b, a))
    a, b, must = a[order], b[order], must[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    met = np.diff(np.append(first, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.array(met), pa.array(np.minimum.reduceat(must, first))], ["a", "b", "met", "least"])


def open_lists(lists: DataFrame) -> DataFrame:
    """key, lead (smallest member), blocks, parts (shares of the lead's lists): lists with members of different components.

    Rows of one lead are dealt to as many tasks as it takes for some LEAD_ROWS each.
    """
    length = lists.groupBy("key").agg(
        F.count("*").alias("length"), F.min("id").alias("lead"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    rows = length.where("low != high").select("key", "lead", "length", F.ceil(F.col("length") / LIST_BLOCK).cast("int").alias("blocks"))
    heavy = rows.groupBy("lead").agg(F.sum(F.col("length") * F.col("blocks")).alias("rows")).where(F.col("rows") > LEAD_ROWS)
    heavy = heavy.select(F.col("lead").alias("heavy"), F.ceil(F.col("rows") / LEAD_ROWS).alias("parts"))
    parted = rows.join(heavy, F.col("lead") == F.col("heavy"), "left")
    return parted.select("key", "lead", "blocks", F.coalesce("parts", F.lit(1)).alias("parts"))


def cross_pairs(lists: DataFrame, opened: DataFrame, similarity: int) -> DataFrame:
    """a, b, met (lists in common), least (lists they must have in common): pairs of different components.

    ``lists`` has key, id, n, bits, component. A list longer than a block is
    dealt out as pairs of its blocks, so that no task compares more than
    two blocks at once; a pair meets once per list. Lists with the same
    smallest member, as those of one passage or one crowd of near copies, meet in one task block by block, which counts their pairs before they are shuffled;
    many such lists are split by key over several tasks (see ``open_lists``), whose counts add up.
    """
    rows = lists.join(opened, "key").withColumn("part", F.pmod(F.xxhash64("key"), "parts")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "part", "key", "lead", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", F.col("n").cast("long").alias("n"), "bits", "component"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found, size = None, [], 0

        def compared(now: list[np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal found, size
            begin = 0
            for end in ends:
                for x, y in _pairs_of(end - begin):
                    pairs = _different(begin, x, y, now, similarity)
                    if len(pairs[0]):
                        found.append(pairs)
                        size += len(pairs[0])
                    if size > 1 << 18:
                        yield _counted(found)
                        found, size = [], 0
                begin = end

        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                now = [_bits(part.column(k)) if k == 7 else part.column(k).to_numpy() for k in range(9)]
                now = now if held is None else [np.concatenate([a, b]) for a, b in zip(held, now, strict=True)]
                ends = np.flatnonzero(np.logical_or.reduce([now[k][1:] != now[k][:-1] for k in (0, 2, 3)])) + 1
                yield from compared(now, ends)
                held = [c[ends[-1] :] if len(ends) else c for c in now]
        if held is not None:
            yield from compared(held, np.array([len(held[0])]))
        if found:
            yield _counted(found)

    dealt = rows.repartition("lead", "part", "i", "j").drop("part").sortWithinPartitions("lead", "i", "j", "key")
    pairs = dealt.mapInArrow(read, "a long, b long, met long, least long")
    return pairs.groupBy("a", "b").agg(F.sum("met").alias("met"), F.min("least").alias("least")).where("met >= least")


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs a, b whose sets are as similar as asked, by their exact overlap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = [np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right)]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    side = lambda end: sets.select(F.col("id").alias(end), F.col("tokens").alias(f"{end}_tokens"))
    rows = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_tokens", "b_tokens")
    return rows.mapInArrow(read, "a long, b long")


def links(docs: DataFrame, rows: DataFrame, similarity: int = SIMILARITY, gram: int = GRAM) -> DataFrame:
    """a, b: links between distinct sets, ids as in ``rows`` (see ``members``), that together connect all sets that links connect."""
    stages = Stages(docs.sparkSession, remove_shuffles=True)
    sizes = {r.n: r.sets for r in rows.where("n <= 200").groupBy("n").agg(F.count_distinct("id").alias("sets")).collect()}
    plan = make_plan(bucket_counts(docs, gram), sizes, similarity)
    lists = stages.stored(with_partners(stages.stored(shared_lists(postings(docs, plan, gram)), "jaccard-shared"), similarity), "jaccard-partners")
    stages.drop("jaccard-shared")
    chosen = lists.select("id").distinct().join(rows, "id").groupBy("id").agg(F.min(F.struct("doc_id", "tie")).alias("d")).select("id", "d.*")
    sets = stages.stored(set_table(docs, chosen, gram), "jaccard-sets")
    lists = stages.stored(lists.join(sets.select("id", "bits"), "id").select("key", "id", "n", "bits"), "jaccard-lists")
    stages.drop("jaccard-partners")

    # The hubs that a set met most often are its best chances; pass two finds what they leave.
    hubs = hub_pairs(lists, similarity).groupBy("a", "b").agg(F.count("*").alias("met"))
    order = Window.partitionBy("a").orderBy(F.col("met").desc(), "b")
    hubs = hubs.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= HUBS)
    first = stages.stored(verified(hubs, sets, similarity), "jaccard-links")
    joined = connected(first)
    lists = lists.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    opened = stages.stored(open_lists(lists), "jaccard-open")
    second = verified(cross_pairs(lists, opened, similarity), sets, similarity)
    with shuffles_removed(docs.sparkSession):
        both = stored(first.unionAll(second), "jaccard-links")
    stages.drop()
    return both


def _classes(docs: DataFrame, similarity: int, gram: int) -> DataFrame:
    """``members`` with class: the component of their set, null for empty sets."""
    rows = stored(members(docs, gram), "jaccard-members")
    if rows.where("n > 0").groupBy("id").agg((F.min("check") != F.max("check")).alias("mixed")).where("mixed").take(1):
        raise ValueError("two different sets have the same id; change the seeds")
    found = connected(links(docs, rows, similarity, gram))
    return rows.join(found, "id", "left").withColumn("class", F.when(F.col("n") > 0, F.coalesce("component", "id")))


def jaccard_groups(docs: DataFrame, similarity: int = SIMILARITY, gram: int = GRAM) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links, its own included) of each input row.

    Words are runs between ASCII white space, A-Z lower-cased. A set holds the distinct shingles
    of ``gram`` words; fewer words are one shingle; null or wordless texts have none and are linked with nothing.
    Linked means 100 * intersection >= similarity * union, with a whole similarity over 50 (others raise). Equal sets are one class from
    the start, so copies are never paired. Rows without doc_id
    belong to their group but do not name it. Other columns are ignored; an empty table gives no rows.
    Raises if two different sets have one 64-bit id (the second hash tells).
    """
    rows = _classes(docs, similarity, gram)
    names = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("name"))
    named = rows.join(names, "class", "left")
    own = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each_group(docs: DataFrame, similarity: int = SIMILARITY, gram: int = GRAM) -> DataFrame:
    """The document of smallest doc_id of each group (rows without id last), and all documents without words, with all columns.

    Rows that repeat doc_id and text are one document.
    """
    rows = _classes(docs, similarity, gram)
    first = rows.where("n > 0").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")).alias("r"))
    kept = first.select("r.doc_id", "r.tie").unionAll(rows.where("n = 0").select("doc_id", "tie")).distinct()
    id_, tie = spare(docs, "id", "tie")
    kept = kept.select(F.col("doc_id").alias(id_), F.col("tie").alias(tie))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.xxhash64("text").eqNullSafe(F.col(tie))
    return docs.join(kept, same).dropDuplicates([id_, tie]).select(*[f"`{c}`" for c in docs.columns])
