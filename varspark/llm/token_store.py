"""Token ids in binary shards: frequency ranks, byte-aligned, with separate control bytes.

A shard is a run of blocks. Its first block holds the ids by falling frequency,
so that frequent ids get small ranks. Every other block holds documents: their
ids as ranks of 1 to 4 bytes each, and apart from them two control bits per
rank that give its length. Reading looks four lengths up per control byte and
gathers all ranks of a block at once.

Files are written by Spark's text writer, which ends each block with a line feed
and commits the files of a task as a whole. A reader goes by the lengths in
the block heads, so the line feeds within blocks do not matter.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varspark.llm.stages import Stages
from varspark.session import stored

# Fixed values of the file format. Heads are little-endian: mark, counts and lengths, crc32 of what follows.
RANKS, DOCS = b"IDR1", b"IDB1"
RANKS_HEAD = struct.Struct("<4sQI")  # ids, crc
DOCS_HEAD = struct.Struct("<4sIQQQI")  # documents, ids, control bytes, data bytes, crc

#: Ids per block at which it is closed, and ids per shard; both end with a whole document.
BLOCK_IDS = 1 << 16
SHARD_IDS = 4 << 20
#: Distinct pieces of text a worker remembers; past that it forgets all and starts anew.
PIECES = 700_000
#: Runs of new pieces that the BPE model takes at once.
RUNS = 256
#: Bytes of text that are cut and looked up at once; a longer text stands alone.
SLICE_BYTES = 1 << 19

_LENGTHS = np.stack([(np.arange(256) >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.int64)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


# ---- ids of texts


def _byte_signs() -> dict[int, str]:
    """Byte-level BPE writes each byte as one sign: printable Latin-1 as itself, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


# White space as Python and the pattern's library know it: in ASCII by byte, beyond that by its UTF-8 bytes.
_SPACE, _ALNUM = np.zeros(256, bool), np.zeros(256, bool)
_SPACE[[*range(9, 14), *range(28, 33)]] = True
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_WIDE_SPACES = {c.encode(): len(c.encode()) for c in map(chr, range(128, 0x3001)) if c.isspace()}


def _white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to white space."""
    space = _SPACE[data]
    lead = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(lead):
        padded = np.append(data, np.zeros(2, np.uint8))
        for sign, n in _WIDE_SPACES.items():
            same = lead[np.logical_and.reduce([padded[lead + k] == sign[k] for k in range(n)])]
            for k in range(n):
                space[same + k] = True
    return space


class PieceEncoder:
    """Encodes texts piece by piece and remembers the ids of each piece.

    A byte-level BPE with its usual pattern never joins what lies before a single space or line feed to
    what follows, nor a letter or digit to a full stop or comma, so the ids of a text are those of its parts, cut
    there and after such line feeds. White space signs beside each other are not cut at; texts
    that hold an added token, and tokenizers of another kind, are encoded as a whole. Places to cut are found in the bytes of many texts at
    once, and Arrow finds the distinct pieces, so that only these become Python texts and are looked up.

    New pieces are cut into the runs of that pattern where ASCII or letters alone leave no doubt about them. Runs are
    remembered as pieces are; those not known yet go to the BPE model many at once, with zero bytes between, which no merge takes in.
    """

    _signs = _byte_signs()
    # Fixed value: the usual pattern of byte-level BPE for ASCII.
    _ascii_runs = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

    def __init__(self, tokenizer_json: str, end_id: int, width: np.dtype, most: int = PIECES) -> None:
        self.end_id, self.width = end_id, width
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = json.loads(tokenizer_json)
        split = kind.get("pre_tokenizer") or {}
        self.by_piece = (
            not kind.get("normalizer")
            and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True)
            and kind["model"].get("type") == "BPE"
        )
        zero = self._signs[0]
        self.zero_id = self.tokenizer.token_to_id(zero)
        alone = not any(zero in t for t in self.tokenizer.get_vocab() if len(t) > 1)
        self.joins = self.by_piece and alone and self.zero_id is not None and not kind["model"].get("ignore_merges")
        self.most = most
        self._forget()

    def _forget(self) -> None:
        # Pieces by their text, a space before it included; the entry k of a piece has ids flat[ends[k] : ends[k + 1]].
        self.place: dict[str, int] = {}
        self.ends, self.flat, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 18, self.width), 0
        self.end = self._keep(np.array([self.end_id]), np.array([1]))

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> int:
        """Append entries of so many ids each to the arrays, which double when full; returns the first entry's number."""
        until = self.ends[self.n] + np.cumsum(counts, dtype=np.int32)
        while self.n + len(until) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        while until[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.ends[self.n] : until[-1]] = ids
        self.ends[self.n + 1 : self.n + 1 + len(until)] = until
        self.n += len(until)
        return self.n - len(until)

    def _gather(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries one after the other, and where each ends."""
        first = self.ends[entry]
        n = self.ends[entry + 1] - first
        # Position k takes the k-th id counted from the begin of its entry.
        until = np.cumsum(n, dtype=np.int32)
        return self.flat[np.repeat(first - (until - n), n) + np.arange(until[-1], dtype=np.int32)], until

    def _runs(self, piece: str) -> list[str]:
        """The piece cut into runs; none where that is left to the library."""
        core = piece[1:] if piece[0] == " " else piece
        if core.isalpha():
            return [piece]
        if core[-1:] in (".", ",") and core[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        if not piece.isascii() or "\0" in piece or any(a in piece for a in self.added):
            return []
        return self._ascii_runs.findall(piece)

    def _learn_runs(self, runs: list[str]) -> None:
        """Entries for new runs."""
        ids = []
        for k in range(0, len(runs), RUNS):
            signs = "\0".join(runs[k : k + RUNS]).encode().decode("latin-1").translate(self._signs)
            ids += [t.id for t in self.tokenizer.model.tokenize(signs)]
            ids.append(self.zero_id)
        ids = np.array(ids)
        between = ids == self.zero_id
        owner = (np.cumsum(between) - between)[~between]
        at = self._keep(ids[~between], np.bincount(owner, minlength=len(runs)))
        self.place.update(zip(runs, range(at, at + len(runs)), strict=True))

    def _learn(self, pieces: list[str]) -> None:
        """Entries for new pieces."""
        cut = [self._runs(p) for p in pieces] if self.joins else [[]] * len(pieces)
        runs = dict.fromkeys(chain.from_iterable(cut))
        if new := [r for r in runs if r not in self.place]:
            self._learn_runs(new)
        several = [(p, c) for p, c in zip(pieces, cut, strict=True) if len(c) > 1]
        if several:
            entry = np.fromiter(map(self.place.__getitem__, chain.from_iterable(c for _, c in several)), np.int32)
            ids, until = self._gather(entry)
            at = self._keep(ids, np.diff(until[np.cumsum([len(c) for _, c in several]) - 1], prepend=0))
            self.place.update(zip([p for p, _ in several], range(at, at + len(several)), strict=True))
        rest = [p for p, c in zip(pieces, cut, strict=True) if not c]
        if rest:
            each = [self.tokenizer.encode(p, add_special_tokens=False).ids for p in rest]
            at = self._keep(np.fromiter(chain.from_iterable(each), np.int64), np.array([len(e) for e in each]))
            self.place.update(zip(rest, range(at, at + len(rest)), strict=True))

    def _begins(self, texts: pa.Array, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where pieces begin in the bytes of all texts; ``bounds`` are those of the texts."""
        begins = np.zeros(len(data) + 1, bool)
        if self.by_piece:
            space = _white_space(data)
            # A text's first byte is cut at anyway; what stands before it or after its last byte can only prevent a cut.
            at = np.flatnonzero((data == 0x20) | (data == 0x0A))
            at = at[~space[at - 1] & ~space[at + 1 - (at + 1 == len(data))]] if len(data) > 1 else at[:0]
            begins[at] = True
            begins[at[data[at] == 0x0A] + 1] = True
            at = np.flatnonzero((data == 0x2E) | (data == 0x2C))
            begins[at[_ALNUM[data[at - 1]]]] = True
            for k in np.flatnonzero(np.logical_or.reduce([pc.match_substring(texts, a).to_numpy(zero_copy_only=False) for a in self.added] or [np.zeros(len(texts), bool)])):
                begins[bounds[k] : bounds[k + 1]] = False
        begins[bounds] = True
        return np.flatnonzero(begins[:-1])

    def ids(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """The ids of each text, the end id last."""
        if self.n > self.most:
            self._forget()
        texts = pa.concat_arrays([pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())])
        bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        low, high = int(bounds[0]), int(bounds[-1])
        bytes_ = (texts.buffers()[2] or pa.py_buffer(b"")).slice(low, high - low)
        bounds = bounds - low
        begin = self._begins(texts, np.frombuffer(bytes_, np.uint8), bounds)
        offsets = np.append(begin, high - low)
        coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), bytes_).dictionary_encode()
        entry = self._entries(coded.dictionary)[coded.indices.to_numpy()] if len(begin) else np.zeros(0, np.int32)
        # The end id follows the pieces of each text.
        ends = np.searchsorted(begin, bounds[1:]) + np.arange(1, len(bounds))
        all_ = np.full(len(entry) + len(texts), self.end, np.int32)
        is_piece = np.ones(len(all_), bool)
        is_piece[ends - 1] = False
        all_[is_piece] = entry
        flat, until = self._gather(all_)
        return np.split(flat, until[ends - 1][:-1])

    def _entries(self, distinct: pa.Array) -> np.ndarray:
        """The entry of each piece; new ones are learned."""
        # One long text of all pieces is cut far faster than they are turned into Python texts one by one.
        one = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct)
        pieces = pc.binary_join(one, pa.scalar("\0", pa.large_string()))[0].as_py().split("\0")
        if len(pieces) != len(distinct):  # zero bytes in texts
            pieces = distinct.to_pylist()
        found = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int32, len(pieces))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new = [pieces[i] for i in unknown]
            self._learn(new)
            found[unknown] = [self.place[p] for p in new]
        return found


_ENCODERS: dict[tuple, PieceEncoder] = {}


def _encoder(*settings) -> PieceEncoder:
    """One encoder per Python worker, which serves several tasks."""
    if settings not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[settings] = PieceEncoder(*settings)
    return _ENCODERS[settings]


def _slices(sizes: Iterable[int], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Begin and end of runs of texts that hold so many bytes together; a longer text stands alone."""
    begin, held, end = 0, 0, 0
    for end, size in enumerate(sizes, 1):
        if held + size > most and end - 1 > begin:
            yield begin, end - 1
            begin, held = end - 1, 0
        held += size
    if end > begin:
        yield begin, end


def _narrow(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def token_ids(docs: DataFrame, tokenizer_json: str, end_id: int, pieces: int = PIECES) -> DataFrame:
    """doc_id, n and ids of each text, ``end_id`` appended; null is an empty text. Row order stays."""
    width = _narrow(max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_json, end_id, width, pieces)
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for lo, hi in _slices(pc.binary_length(texts).to_pylist()):
                ids = encoder.ids(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                    ["doc_id", "n", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n long, ids binary")


def id_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in the whole table. What comes to the driver is one number per id of the vocabulary."""
    width = _narrow(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _ENCODERS.clear()  # the ids are stored by now; a worker that waits for later stages need not hold its pieces
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                ids = b"".join(batch.column(0).slice(lo, 256).to_pylist())
                total += np.bincount(np.frombuffer(ids, width), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(vocabulary, np.int64)
    counts[rows["id"].to_numpy(int)] = rows["n"].to_numpy(int)
    return counts


# ---- blocks


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of the ranks."""
    ranks = ranks.astype("<u4")
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = length - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    top = int(length.max(initial=1))
    used = np.arange(top) < length[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[:, :top][used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks back: lengths by table, then a gather of up to four bytes each."""
    length = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    begin = np.cumsum(length) - length
    plain = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    value = plain[begin]
    for k in range(1, int(length.max(initial=1))):
        value |= plain[begin + k] << np.uint32(8 * k)
    return value & _MASKS[length]


def ranks_block(by_rank: np.ndarray) -> bytes:
    body = by_rank.astype("<u4").tobytes()
    return RANKS_HEAD.pack(RANKS, len(by_rank), zlib.crc32(body)) + body


def docs_block(doc_ids: list, counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    known = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    body = known + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(counts, "<u8").tobytes() + control + data
    return DOCS_HEAD.pack(DOCS, len(doc_ids), len(ranks), len(control), len(data), zlib.crc32(body)) + body


def read_shard(content: bytes) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """doc_ids, ids per document, and all ids of each block; raises where marks, lengths or checksums do not agree."""
    at, by_rank = 0, None

    def body(head: struct.Struct, size: int, crc: int) -> bytes:
        found = content[at + head.size : at + head.size + size]
        if len(found) != size or zlib.crc32(found) != crc or content[at + head.size + size : at + head.size + size + 1] != b"\n":
            raise ValueError(f"damaged block at byte {at}")
        return found

    while at < len(content):
        mark = content[at : at + 4]
        if mark == RANKS:
            _, n, crc = RANKS_HEAD.unpack_from(content, at)
            by_rank = np.frombuffer(body(RANKS_HEAD, 4 * n, crc), "<u4")
            at += RANKS_HEAD.size + 4 * n + 1
        elif mark == DOCS and by_rank is not None:
            _, docs, n, controls, datas, crc = DOCS_HEAD.unpack_from(content, at)
            found = body(DOCS_HEAD, 17 * docs + controls + datas, crc)
            known = np.frombuffer(found, np.uint8, docs)
            doc_ids = np.frombuffer(found, "<i8", docs, docs).tolist()
            counts = np.frombuffer(found, "<u8", docs, 9 * docs).astype(np.int64)
            ranks = unpack(found[17 * docs : 17 * docs + controls], found[17 * docs + controls :], n)
            if counts.sum() != n:
                raise ValueError(f"block at byte {at} holds {n} ids, not {counts.sum()}")
            yield [d if k else None for d, k in zip(doc_ids, known, strict=True)], counts, by_rank[ranks]
            at += DOCS_HEAD.size + len(found) + 1
        else:
            raise ValueError(f"no block at byte {at}")


# ---- tables


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for lo in range(0, batch.num_rows, 256):
        yield from zip(*[c.to_pylist() for c in batch.slice(lo, 256).columns], strict=True)


def write_shards(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, shard_ids: int = SHARD_IDS, pieces: int = PIECES) -> None:
    """Encode all texts and write them in ascending doc_id order, null first.

    Texts are dealt into ranges of doc_id and sorted there; repeated ids
    are ordered by a hash of their text. The ids are stored once in that
    order, counted, and written as ranks without another shuffle. Shard names sort like the documents.
    """
    vocabulary = max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1)
    width = _narrow(vocabulary)
    key = ["doc_id", "tie"]
    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange(*key).sortWithinPartitions(*key)
    # Row numbers ascend within a range and from range to range; the range is in their upper bits.
    stages = Stages(docs.sparkSession)
    tokens = stages.stored(token_ids(dealt, tokenizer_json, end_id, pieces).withColumn("row", F.monotonically_increasing_id()), "token-ids")
    by_rank = np.argsort(-(counts := id_counts(tokens, vocabulary)), kind="stable")[: int((counts > 0).sum())]
    rank_of = np.zeros(vocabulary, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    head = ranks_block(by_rank)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, piece, in_shard, last, doc_ids, counts, parts = "", 0, 0, None, [], [], []

        def row(content: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([piece], pa.int32()), pa.array([content], pa.binary())], ["shard", "piece", "content"])

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal piece, in_shard
            if doc_ids:
                piece += 1
                in_shard += sum(counts)
                yield row(docs_block(doc_ids, counts, rank_of[np.frombuffer(b"".join(parts), width)]))
                doc_ids.clear(), counts.clear(), parts.clear()

        pending = 0
        for batch in batches:
            for doc_id, n, content, number in _rows(batch):
                part = number >> 33
                if part != last or in_shard + pending > shard_ids:
                    yield from flushed()
                    shard, piece, in_shard, pending, last = f"r{number:020d}", 0, 0, 0, part
                    yield row(head)
                doc_ids.append(doc_id), counts.append(n), parts.append(content)
                pending += n
                if pending >= BLOCK_IDS:
                    yield from flushed()
                    pending = 0
        yield from flushed()

    blocks = tokens.select("doc_id", "n", "ids", "row").mapInArrow(write, "shard string, piece int, content binary")
    blocks = blocks.sortWithinPartitions("shard", "piece").select("shard", F.col("content").cast("string").alias("value"))
    blocks.write.partitionBy("shard").option("lineSep", "\n").text(path)
    stages.drop()


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """shard, doc_id, before (ids of the shard's documents before it), n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) and ids, decoded from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard, before = re.search(r"shard=([^/]*)/", path)[1], 0
                for doc_ids, counts, ids in read_shard(content.as_buffer().to_pybytes()):
                    ends = np.cumsum(counts)
                    each = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends, counts, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * len(doc_ids)), pa.array(doc_ids, pa.int64()), pa.array(before + ends - counts), pa.array(counts),
                            pa.array([zlib.crc32(x) for x in each], pa.int64()), pa.array(each, pa.binary()),
                        ],
                        ["shard", "doc_id", "before", "n_tokens", "ids_crc32", "ids"],
                    )
                    before += int(counts.sum())

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, "shard string, doc_id long, before long, n_tokens long, ids_crc32 long, ids binary")


def encoded_documents(docs: DataFrame, tokenizer_json: str, end_id: int = 2, **options) -> DataFrame:
    """Write shards, read them back, and place each document: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Each input row gives
    one row; null and empty texts are the end id alone; null doc_ids come first,
    and repeated doc_ids follow each other. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stages = Stages(spark)
    path = stages.path("token-shards")
    write_shards(docs, path, tokenizer_json, end_id, **options)
    if not spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").take(1):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    found = stored(read_shards(spark, path).drop("ids"), "token-places")
    stages.drop()
    sizes = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per shard
    return found.join(sizes.select("shard", before.alias("offset")), "shard").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
