"""Suffix-array dedup: remove every byte of a string of given length that starts twice in the corpus.

Every window of ``WIDTH`` bytes has an anchor: the one of its short grams with the
least hash. Equal windows have equal anchors at equal places, so only suffixes with
a repeated anchor can repeat. Adjacent windows with one anchor form a slice, which
travels as one piece of text.

1. Slices are shuffled as hashes only. Those with an anchor of their own are
   dropped, those that repeat as a whole are settled.
2. One copy of each other slice goes, as text, to the bucket of its anchor's leading bytes;
   buckets are ranges between sampled splitters. A bucket sorts the suffixes of
   its slices by multikey quicksort over tokens, and equal neighbours in that order repeat. Suffixes with one
   anchor lie in one bucket, so none has an equal beyond a bucket's boundary.
3. The results return to all documents that hold the slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspark.llm.blocks import RunHashes, text_blocks
from varspark.llm.columns import wide_hash
from varspark.llm.stages import Stages
from varspark.session import stored

WIDTH = 200
#: Bytes of a gram; longer ones are repeated less often, but more of them become anchors.
GRAM = 64
#: Bytes per token of the sort.
TOKEN = 40
#: Bytes handled at once; longer texts are cut into overlapping parts.
PART_BYTES = 1 << 18
#: Suffixes sorted at once, and slices of one anchor past which its windows are counted by hash instead.
SORT_SUFFIXES, CROWD = 1 << 20, 4096

_SLICE = "key long, slice long, ra long, rb long, start int, windows int, anchor int"


# ---- slices


def _least_before(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of n values: of the rest of one stretch of n and the begin of the next."""
    short = len(values) - n + 1
    filled = np.concatenate([values, np.full(-len(values) % n, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, n)
    begin = np.minimum.accumulate(filled, axis=1).ravel()
    rest = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(rest[:short], begin[n - 1 : n - 1 + short])


def slices_of(data: np.ndarray, starts: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Slices of the texts in a block: text, first byte, windows, place of the anchor in the slice, anchor hash, slice hash.

    ``starts`` are the begins of the texts and the end of the last one.
    """
    n = len(data)
    if n < width:
        return (np.zeros(0, np.int64),) * 6
    hashes = RunHashes(data)
    at = np.arange(n - gram + 1)
    grams = hashes.of(at, at + gram)
    # Order by 32 bits of hash, then by place: the first of the least.
    order = (grams & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    anchor = (_least_before(order, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    inside = np.arange(len(anchor)) + width <= starts[text + 1]
    window = np.flatnonzero(inside)
    if not len(window):
        return (np.zeros(0, np.int64),) * 6
    anchor, text = anchor[window], text[window]
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    first, count = window[cut], np.diff(np.append(cut, len(window)))
    # The place of the anchor belongs to the hash, as its windows are told by it.
    whole = hashes.of(first, first + count + width - 1)
    return text[cut], first, count, anchor[cut] - first, grams[anchor[cut]].view(np.int64), whole.view(np.int64)


def _parts(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of texts as (first row, offset in it, bytes, begins); a long text comes in parts that overlap by width - 1 bytes."""
    for block in text_blocks(column, PART_BYTES):
        if block.last - block.first > 1 or len(block.data) <= 2 * PART_BYTES:
            yield block.first, 0, block.data, block.starts
        else:
            for lo in range(0, len(block.data), PART_BYTES):
                part = block.data[lo : lo + PART_BYTES + width - 1]
                yield block.first, lo, part, np.array([0, len(part)])


def slices(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """All slices of all texts, as hashes: key (anchor), slice, ra, rb, start, windows, anchor (its place)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first_keys, second_keys = batch.column(0), batch.column(1)
            for row, offset, data, starts in _parts(batch.column(2), width):
                text, first, count, place, key, whole = slices_of(data, starts, width, gram)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key), pa.array(whole), first_keys.take(pa.array(row + text)), second_keys.take(pa.array(row + text)),
                            pa.array((first - starts[text] + offset).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(place.astype(np.int32)),
                        ],
                        ["key", "slice", "ra", "rb", "start", "windows", "anchor"],
                    )

    return docs.select("ra", "rb", "text").mapInArrow(read, _SLICE)


def repeated_anchors(found: DataFrame) -> DataFrame:
    """Slices whose anchor occurs twice or more, with ``whole``: the same slice occurs again. Rows are streamed in order of their hashes, no anchor's rows are held."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None  # the last row; whether its neighbour before shares its anchor, its slice
        shares = (False, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if last is None else pa.concat_batches([last, batch])
            key, whole, place = [rows.column(i).to_numpy() for i in (0, 1, 6)]
            like = np.zeros((2, len(key) + 1), bool)
            like[0, 1:-1] = key[1:] == key[:-1]
            like[1, 1:-1] = like[0, 1:-1] & (whole[1:] == whole[:-1]) & (place[1:] == place[:-1])
            like[:, 0] = shares
            known = like[:, 1:] | like[:, :-1]
            yield _told(rows.slice(0, len(key) - 1), known[:, :-1])
            last, shares = rows.slice(len(key) - 1), tuple(like[:, -2])
        if last is not None:
            yield _told(last, np.array(shares)[:, None])

    def _told(rows: pa.RecordBatch, known: np.ndarray) -> pa.RecordBatch:
        rows = rows.append_column("whole", pa.array(known[1]))
        return rows.filter(pa.array(known[0]))

    order = ["key", "slice", "anchor"]
    return found.repartition("key").sortWithinPartitions(*order).mapInArrow(read, _SLICE + ", whole boolean")


# ---- buckets


def multikey_groups(first: np.ndarray, at: np.ndarray, hashes: RunHashes, width: int, token: int) -> np.ndarray:
    """Which suffixes have an equal one: multikey quicksort, one token at a time.

    ``first`` is the leading token of each suffix, ``at`` its begin. Suffixes with equal tokens
    so far form a group; each round sorts the groups by the next token, splits them, and drops suffixes left alone.
    """
    group, active = first, np.arange(len(at))
    for lo in range(0, width + token, token):
        tokens = group if lo == 0 else hashes.of(at[active] + lo - token, np.minimum(at[active] + lo, at[active] + width)).view(np.int64)
        order = np.argsort(tokens, kind="stable") if lo == 0 else np.lexsort((tokens, group))
        tokens, group, active = tokens[order], group[order], active[order]
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (group[1:] != group[:-1])]) if len(active) else np.zeros(0, bool)
        alone = new & np.append(new[1:], True)
        group, active = np.cumsum(new)[~alone], active[~alone]
    repeats = np.zeros(len(at), bool)
    repeats[active] = True
    return repeats


def _runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of set flags within one owner."""
    padded = np.concatenate([[False], flags, [False]])
    split = np.concatenate([[True], owner[1:] != owner[:-1], [True]])
    begins = np.flatnonzero(padded[1:-1] & (~padded[:-2] | split[:-1]))
    ends = np.flatnonzero(padded[1:-1] & (~padded[2:] | split[1:])) + 1
    return begins, ends


def _sorted_bucket(width: int, token: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None

        def done() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(r[3] for r in held), np.uint8)
            key, number, place = (np.array([r[k] for r in held], np.int64) for k in (0, 1, 2))
            length = np.array([len(r[3]) for r in held])
            begin, windows = np.cumsum(length) - length, length - width + 1
            owner = np.repeat(np.arange(len(held)), windows)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            # Equal windows have the same anchor at the same place.
            lead = (key[owner] * np.int64(0x9E3779B97F4A7C1) + place[owner] - within)
            repeats = multikey_groups(lead, begin[owner] + within, RunHashes(data), width, token)
            a, b = _runs(repeats, owner)
            return pa.RecordBatch.from_arrays(
                [pa.array(key[owner[a]]), pa.array(number[owner[a]]), pa.array(place[owner[a]], pa.int32()), pa.array(within[a], pa.int32()), pa.array(within[b - 1] + 1, pa.int32())],
                ["key", "slice", "anchor", "from", "to"],
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if size > SORT_SUFFIXES and row[0] != last:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) - width + 1
                last = row[0]
        if held:
            yield done()

    return read


def _by_hash(width: int):
    """Windows of slices as rows of hashes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, number, place, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = np.frombuffer(text, np.uint8)
                at = np.arange(len(data) - width + 1)
                each = [RunHashes(data, seed).of(at, at + width).view(np.int64) for seed in (0, 1)]
                same = lambda x, kind: pa.array(np.full(len(at), x), kind)
                yield pa.RecordBatch.from_arrays(
                    [same(key, pa.int64()), same(number, pa.int64()), same(place, pa.int32()), pa.array(at.astype(np.int32)), *map(pa.array, each)],
                    ["key", "slice", "anchor", "from", "a", "b"],
                )

    return read


def repeated_windows(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, token: int = TOKEN, crowd: int = CROWD) -> DataFrame:
    """key, slice, anchor, from, to: windows of a slice that occur in another slice of its anchor.

    ``texts`` has key, slice, anchor, slices (how many the anchor has) and content. The suffixes
    of an anchor are sorted in one task. Anchors with more than ``crowd`` slices do
    not fit one; their windows are counted by hash, each pair of equal windows again under one key.
    """
    columns = ["key", "slice", "anchor", "content"]
    lead = F.substring("content", F.col("anchor") + 1, 16)
    few = texts.where(F.col("slices") <= crowd).select(*columns, lead.alias("lead"))
    few = few.repartitionByRange("lead", "key").sortWithinPartitions("lead", "key").select(*columns)
    result = "key long, slice long, anchor int, `from` int, `to` int"
    found = few.mapInArrow(_sorted_bucket(width, token), result)
    windows = texts.where(F.col("slices") > crowd).select(*columns).mapInArrow(_by_hash(width), "key long, slice long, anchor int, `from` int, a long, b long")
    again = windows.groupBy("key", "a", "b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    many = windows.join(again, ["key", "a", "b"]).select("key", "slice", "anchor", "from", (F.col("from") + 1).alias("to"))
    return found.unionAll(many)


def slice_texts(docs: DataFrame, chosen: DataFrame, width: int = WIDTH) -> DataFrame:
    """The bytes of chosen slices: key, slice, anchor, slices, content. ``chosen`` lists them per document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                data, wanted = text.as_py().encode(), wanted.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array([w[k] for w in wanted], t) for k, t in (("key", pa.int64()), ("slice", pa.int64()), ("anchor", pa.int32()), ("slices", pa.int64()))],
                        pa.array([data[w["start"] : w["start"] + w["windows"] + width - 1] for w in wanted], pa.binary()),
                    ],
                    ["key", "slice", "anchor", "slices", "content"],
                )

    wanted = chosen.groupBy("ra", "rb").agg(F.collect_list(F.struct("key", "slice", "anchor", "slices", "start", "windows")).alias("wanted"))
    here = docs.join(wanted, ["ra", "rb"])
    rows = here.select("text", "wanted").mapInArrow(read, "key long, slice long, anchor int, slices long, content binary")
    return rows.dropDuplicates(["key", "slice", "anchor"])  # rows that repeat a document


# ---- documents


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, token: int = TOKEN, crowd: int = CROWD) -> DataFrame:
    """ra, rb, spans: starts of repeated windows as [from, to), per document that has any. ``docs`` has ra, rb, text."""
    stages = Stages(docs.sparkSession)
    shared = stages.stored(repeated_anchors(slices(docs, width, gram)), "suffix-slices")
    one = shared.groupBy("key", "slice", "anchor").agg(F.min(F.struct("ra", "rb", "start", "windows")).alias("r"))
    several = one.groupBy("key").agg(F.count("*").alias("slices")).where("slices > 1")
    chosen = one.join(several, "key").select("key", "slice", "anchor", "slices", "r.*")
    found = repeated_windows(slice_texts(docs, chosen, width), width, gram, token, crowd)
    whole = shared.where("whole").select("ra", "rb", F.col("start").alias("from"), (F.col("start") + F.col("windows")).alias("to"))
    part = shared.where("not whole").join(found, ["key", "slice", "anchor"])
    part = part.select("ra", "rb", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
    spans = whole.unionAll(part).groupBy("ra", "rb").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    spans = stored(spans, "suffix-spans")
    stages.drop()
    return spans


def dedup_suffixes(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, token: int = TOKEN, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (bytes) per input row.

    Removes each byte that a string of ``width`` bytes covers which also starts anywhere else in the
    corpus, in the same text too; overlaps count, and strings are judged on the input. Texts are their UTF-8 bytes, null is empty;
    strings never cross texts. Rows that repeat a document are occurrences each. Other columns are ignored.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    h = wide_hash("doc_id", "text")  # tells rows apart; rows that agree in both are one document
    keyed = texts.select("doc_id", "text", h["a"].alias("ra"), h["b"].alias("rb"))
    both = keyed.join(repeated_spans(keyed, width, gram, token, crowd), ["ra", "rb"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = []
                for text, found in zip(part.column(1), part.column(2), strict=True):
                    data = text.as_py().encode()
                    kept, at, removed, runs = [], 0, 0, 0
                    for a, b in sorted((s["from"], s["to"] + width - 1) for s in found.as_py() or []):
                        if a > at or not runs:
                            kept.append(data[at:a])
                            runs += 1
                            removed += b - a
                            at = b
                        elif b > at:
                            removed += b - at
                            at = b
                    kept = b"".join([*kept, data[at:]])
                    rows.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
                columns = zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, t) for c, t in columns]], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return both.select("doc_id", "text", "spans").mapInArrow(cut, schema)
