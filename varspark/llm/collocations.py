"""Phrase collocations: an FM-index per shard of word ids counts short phrases, and the shards' counts are added.

A shard is a run of a task's texts of one language. Its pieces are one sequence of word ids, zero after each piece; the
index is built of the sequence and of its reverse. A phrase is an interval in both.
Extending it by a word on one side narrows one interval through the Burrows-Wheeler
transform of that side and the other by the counts of smaller words. All phrases of a length are extended at once, in numpy.

Most long phrases occur once. A sieve of hashed counts over the whole corpus tells
which phrases can reach the least count at all; the others are not extended. It lets
through too much at worst, never too little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.llm.blocks import RunHashes, mixed
from varspark.llm.stages import Stages
from varspark.session import stored

UNDETERMINED = "und"
LEAST, MOST_WORDS, BEST = 30, 4, 2000
#: Bytes of text per shard.
SHARD_BYTES = 2 << 20
#: Words hashed at once.
HASHED = 1 << 15
#: Buckets of the sieve: one per 16 bytes of text, within these bounds. The largest is 128 MB of bits; beyond it the sieve lets more through.
LEAST_BITS, MOST_BITS = 26, 30
#: Parts that the sieve is counted in: at least 2**8, and so many that a part has 2**18 buckets at most.
PART_BITS, BUCKET_BITS = 8, 18

# Bytes that end pieces, and those between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# ---- shards


def _cut(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts of ``most`` bytes or more that end where pieces end."""
    at = 0
    while len(text) - at > 2 * most:
        ends = np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8, min(most, len(text) - at - most), at + most)])
        reach = most
        while not len(ends) and at + most + reach < len(text):  # a piece of more than `most` bytes
            ends = np.flatnonzero(_ENDS[np.frombuffer(text, np.uint8, min(most, len(text) - at - most - reach), at + most + reach)]) + reach
            reach += most
        if not len(ends):
            break
        until = at + most + int(ends[0]) + 1
        yield text[at:until]
        at = until
    yield text[at:]


def text_shards(batches: Iterator[pa.RecordBatch], most: int = SHARD_BYTES) -> Iterator[tuple[str, np.ndarray]]:
    """lang and bytes of each shard of (lang, text) rows; a line feed parts two texts."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for lang, text in zip(batch.column(0), texts, strict=True):
            lang = lang.as_py()
            for part in _cut(text.as_py() or b"", most):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                # A full shard goes; so does the largest where many languages together hold as much as four.
                if sizes[lang] >= most or sum(sizes.values()) >= 4 * most:
                    full = max(sizes, key=sizes.get)
                    yield full, np.frombuffer(b"\n".join(held.pop(full)), np.uint8)
                    sizes.pop(full)
    for lang, parts in held.items():
        yield lang, np.frombuffer(b"\n".join(parts), np.uint8)


class Words:
    """Words of a shard in order: hash and bounds of each, and whether a piece ends after it."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_GAPS[self.data]
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        self.hashes = np.zeros(len(self.starts), np.uint64)
        for lo in range(0, len(self.starts), HASHED):
            part = slice(lo, min(lo + HASHED, len(self.starts)))
            starts, ends = self.starts[part], self.ends[part]
            self.hashes[part] = RunHashes(self.data[starts[0] : ends[-1]]).of(starts - starts[0], ends - starts[0])
        ended = np.concatenate([[0], np.cumsum(_ENDS[self.data])])
        self.last = np.ones(len(self.starts), bool)
        self.last[:-1] = ended[self.starts[1:]] > ended[self.ends[:-1]]


def _phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A hash per phrase from the hashes of its words, alike in every shard."""
    seed = np.frombuffer(lang.encode(), np.uint8)
    with np.errstate(over="ignore"):
        total = np.full(len(words[0]), int(RunHashes(seed).of(np.array([0]), np.array([len(seed)]))[0]), np.uint64)
        for w in words:
            total = mixed(total + w)
    return total


# ---- sieve


def _gaps(low: np.ndarray) -> bytes:
    """Ascending numbers as their differences: the low bytes of all, then the others, which are nearly all zero and pack well."""
    return np.diff(low, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T[:3].tobytes()


def _places(content: pa.Buffer, n: int) -> np.ndarray:
    return np.cumsum(np.tensordot([1, 256, 65536], np.frombuffer(content, np.uint8).reshape(3, n).astype(np.int64), 1))


def sieve(texts: DataFrame, bits: int, least: int, most_words: int, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Bitmap of 2**bits buckets: those whose phrases occur ``least`` times together. ``texts`` has lang and text.

    Counts stop at 255 in a shard, which is enough for a least count up to that. What comes to the driver is the bitmap.
    """
    per = bits - min(max(PART_BITS, bits - BUCKET_BITS), bits - 3)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data in text_shards(batches, shard_bytes):
            words, found = Words(data), []
            whole = np.ones(len(words.hashes), bool)
            for n in range(1, most_words + 1):
                if n > 1:
                    whole = whole[:-1] & ~words.last[n - 2 : len(words.last) - 1]
                at = np.flatnonzero(whole)
                if not len(at):
                    break
                found.append(_phrase_hash(lang, [words.hashes[at + k] for k in range(n)]) >> np.uint64(64 - bits))
            if found:
                bucket, n = np.unique(np.concatenate(found), return_counts=True)
                part = bucket >> np.uint64(per)
                edges = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
                low, n = (bucket & np.uint64((1 << per) - 1)).astype("<u4"), np.minimum(n, 255).astype(np.uint8)
                rows = [(int(part[a]), _gaps(low[a:b]), n[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                for k in range(0, len(rows), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 1024], strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["part", "low", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(1 << per, np.int64), None

        def done() -> Iterator[pa.RecordBatch]:
            if part is not None:
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["part", "set"])

        for batch in batches:
            for now, low, n in zip(*batch.columns, strict=True):
                if now.as_py() != part:
                    yield from done()
                    part = now.as_py()
                    total[:] = 0
                total[_places(low.as_buffer(), len(n.as_buffer()))] += np.frombuffer(n.as_buffer(), np.uint8)
        yield from done()

    rows = texts.mapInArrow(count, "part long, low binary, n binary").repartition("part").sortWithinPartitions("part")
    found = rows.mapInArrow(add, "part long, set binary").toPandas()
    bitmap = np.zeros((1 << bits - per, max(1 << per, 8) // 8), np.uint8)
    for part, content in zip(found["part"], found["set"], strict=True):
        bitmap[part] = np.frombuffer(content, np.uint8)
    return bitmap.ravel()


# ---- index


class Side:
    """One direction of the index: rows ordered by the next ``depth`` words, the word before each, and its occurrences."""

    def __init__(self, sequence: np.ndarray, depth: int) -> None:
        n = len(sequence)
        key, reach = sequence, 1
        while reach < depth:  # rows that agree in `reach` words are ranked by as many after them
            rank = key if reach == 1 else np.unique(key, return_inverse=True)[1]
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -reach)
            reach *= 2
        order = np.argsort(key, kind="stable")
        self.n, self.before = n, np.roll(sequence, 1)[order].astype(np.int64)
        self.occurrences = np.sort(self.before * n + np.arange(n))  # by word, then by row
        self.followed = np.concatenate([[0], np.cumsum(self.before > 0)])

    def narrowed(self, word: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Where the interval of word + phrase begins, if the phrase's begins at ``low``: smaller words, then occurrences of the word above."""
        return np.searchsorted(self.occurrences, word * self.n + low)

    def extensions(self, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions of the intervals: interval, word, count, and the count of smaller words there."""
        first = np.cumsum(count) - count
        rows = np.arange(int(count.sum())) + np.repeat(low - first, count)
        key = np.repeat(np.arange(len(low)) * self.n, count) + self.before[rows]
        key, n = np.unique(key, return_counts=True)
        owner, word = key // self.n, key % self.n
        smaller = np.cumsum(n) - n - first[owner]
        kept = word > 0  # no phrase crosses a piece
        return owner[kept], word[kept], n[kept], smaller[kept]


class Index:
    """Both sides of a shard's index over ids 1 to ``len(words)``, in order of the words' hashes."""

    def __init__(self, words: Words, depth: int) -> None:
        self.hashes, first, ids = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.bounds = np.stack([words.starts[first], words.ends[first]], axis=1)
        place = np.arange(len(ids)) + np.cumsum(words.last) - words.last
        sequence = np.zeros(len(ids) + int(words.last.sum()), np.int64)
        sequence[place] = ids + 1
        self.left = Side(sequence, depth)
        self.right = Side(sequence[::-1], depth)
        self.counts = np.bincount(sequence, minlength=len(self.hashes) + 1)

    def phrases(self, most_words: int, may) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per length: word ids (a row each), count, and how many of these have a word before and after them.

        ``may`` tells from word ids which phrases to keep; others are not extended. Phrases grow to the right and to the left in turn.
        """
        begins = np.cumsum(self.counts) - self.counts
        ids = np.arange(1, len(self.counts))[:, None]
        state = [ids, begins[1:], begins[1:], self.counts[1:]]
        for n in range(1, most_words + 1):
            keep = may(state[0])
            state = [x[keep] for x in state]
            ids, at_left, at_right, count = state
            if not len(ids):
                return
            yield ids, count, self.left.followed[at_left + count] - self.left.followed[at_left], self.right.followed[at_right + count] - self.right.followed[at_right]
            if n == most_words:
                return
            if n % 2:
                owner, word, found, smaller = self.right.extensions(at_right, count)
                state = [np.column_stack([ids[owner], word]), at_left[owner] + smaller, self.right.narrowed(word, at_right[owner]), found]
            else:
                owner, word, found, smaller = self.left.extensions(at_left, count)
                state = [np.column_stack([word, ids[owner]]), self.left.narrowed(word, at_left[owner]), at_right[owner] + smaller, found]


# ---- counts


def phrase_counts(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, shard_bytes: int = SHARD_BYTES, bits: int | None = None) -> DataFrame:
    """lang, words, phrase, n, before, after: phrases of up to ``most_words`` words that occur ``least`` times in a language.

    A-Z are lower-cased; texts are cut at ``.,;:!?`` and line breaks into pieces and those at spaces and tabs into words; null is
    empty, a null lang ``und``. All contiguous occurrences within pieces count, overlaps included; ``before`` and ``after`` count those with another
    word on that side. A row with no words and an empty phrase holds the number of all words of each language that has documents. ``least`` is 255 at most.
    """
    if not 1 <= least <= 255:
        raise ValueError("the least count has to lie within 1 and 255")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang"), "text")
    if bits is None:
        size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
        bits = min(max((size // 16).bit_length(), LEAST_BITS), MOST_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(sieve(texts, bits, least, most_words, shard_bytes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for lang, data in text_shards(batches, shard_bytes):
            words = Words(data)
            yield rows(lang, 0, pa.array([""]), *[np.array([n]) for n in (len(words.starts), 0, 0)])
            if not len(words.starts):
                continue
            index = Index(words, most_words)

            def may(ids: np.ndarray) -> np.ndarray:
                bucket = _phrase_hash(lang, [index.hashes[c - 1] for c in ids.T]) >> np.uint64(64 - bits)
                return (bitmap[bucket >> np.uint64(3)] >> (np.uint64(7) - (bucket & np.uint64(7))).astype(np.uint8) & 1) > 0

            text = words.data.tobytes()
            spelled: dict[int, str] = {}
            for ids, n, before, after in index.phrases(most_words, may):
                for i in np.unique(ids):
                    if i not in spelled:
                        a, b = index.bounds[i - 1]
                        spelled[i] = text[a:b].decode()
                phrase = [" ".join([spelled[i] for i in row]) for row in ids.tolist()]
                yield rows(lang, ids.shape[1], pa.array(phrase, pa.string()), n, before, after)

    def rows(lang: str, words: int, phrase: pa.Array, *counts: np.ndarray) -> pa.RecordBatch:
        same = [pa.array([lang] * len(phrase), pa.string()), pa.array(np.full(len(phrase), words, np.int32)), phrase]
        return pa.RecordBatch.from_arrays([*same, *[pa.array(c.astype(np.int64)) for c in counts]], ["lang", "words", "phrase", "n", "before", "after"])

    found = texts.mapInArrow(count, "lang string, words int, phrase string, n long, before long, after long")
    found = found.groupBy("lang", "words", "phrase").agg(*[F.sum(c).alias(c) for c in ("n", "before", "after")])
    return found.where((F.col("words") == 0) | (F.col("n") >= least))


def _part(words: Column, start: int | Column, n: int | Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def collocations(
    docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, best: int = BEST, inside: int = 80, shard_bytes: int = SHARD_BYTES, bits: int | None = None
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score, and before and after.

    Candidates are phrases of 2 to ``most_words`` words that occur ``least`` times (a). Cut after k words into parts of
    counts l and r, a phrase scores floor(2000000 a / (l + r)); its lowest cut counts, the smallest k of equals. Candidates whose words lie
    inside a longer candidate with 100 n >= ``inside`` a are dropped, be that one dropped or not. Order: score and a descending, then phrase by its bytes.
    Products are decimals of 38 digits. Texts, nulls and ``n`` (all words of the language) are as in ``phrase_counts``; repeated rows count each;
    other columns are ignored; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession)
    counts = stages.stored(phrase_counts(docs, least, most_words, shard_bytes, bits), "phrase-counts")
    candidates = counts.where("words >= 2").withColumn("w", F.split("phrase", " "))
    parts_at = lambda k: F.struct(F.lit(k).alias("k"), _part(F.col("w"), 1, k).alias("left"), _part(F.col("w"), k + 1, F.col("words") - k).alias("right"))
    cuts = F.filter(F.array(*[parts_at(k) if k == 1 else F.when(F.col("words") > k, parts_at(k)) for k in range(1, most_words)]), lambda x: x.isNotNull())
    sides = lambda c: F.array(F.struct(c["k"].alias("k"), F.lit("l").alias("side"), c["left"].alias("part")), F.struct(c["k"].alias("k"), F.lit("r").alias("side"), c["right"].alias("part")))
    asked = candidates.select("lang", "phrase", F.explode(F.flatten(F.transform(cuts, sides))).alias("c")).select("lang", "phrase", "c.*")
    known = counts.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    side = lambda k, s: F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}")
    found = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase").agg(*[side(k, s) for k in range(1, most_words) for s in "lr"])

    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: _part(F.col("w"), i, n)),
        )
    )
    longer = candidates.where("words > 2").select("lang", "n", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (wide("longer") * 100 < wide("n") * inside))

    score = lambda k: F.expr(f"cast(n as decimal(20, 0)) * 2000000 div (cast(l{k} as decimal(20, 0)) + r{k})")
    scored = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = F.array_min(F.filter(F.array(*[scored(k) for k in range(1, most_words)]), lambda x: x.isNotNull()))
    rows = kept.join(found, ["lang", "phrase"]).withColumn("low", lowest)
    order = Window.partitionBy("lang").orderBy(F.col("low.score").desc(), F.col("n").desc(), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    named = ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), F.col("low.l").alias("l"), F.col("low.r").alias("r"),
        F.col("total").alias("n"), F.col("low.score").alias("score"), "before", "after",
    )
    result = stored(named, "collocations")
    stages.drop()
    return result
