"""Benchmark decontamination: word n-grams of test items looked up in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.llm.columns import ascii_lower, spare, wide_hash, words_in

#: Windows and item ids in their lists that may be broadcast together, under 200 MB in an executor. More are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000


#: A-Z belong to words here: they are lower-cased word by word afterwards.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """A hash of each word. Words of one byte per character take the fast lower(), which changes A-Z alone in them."""
    lowered = lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(ascii_lower(w))
    return F.transform(words_in(text, _WORD), lambda w: F.xxhash64(lowered(w)))


def _windows(words: Column, length: int) -> Column:
    """Start and hashes of each run of ``length`` words."""
    at = lambda i: F.struct(
        i.alias("start"),
        F.lit(length).alias("length"),
        F.xxhash64(F.lit(1), F.slice(words, i + 1, length)).alias("a"),
        F.xxhash64(F.lit(2), F.slice(words, i + 1, length)).alias("b"),
    )
    none = F.array().cast("array<struct<start:int,length:int,a:bigint,b:bigint>>")
    return F.when(F.size(words) >= length, F.transform(F.sequence(F.lit(0), F.size(words) - length), at)).otherwise(none)


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """Each distinct window with the items that hold it; an item of fewer words is one window."""
    words = benchmark.select("item_id", _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(n))
    run = lambda i: F.slice(F.col("words"), i + 1, length)
    each = words.select(
        "item_id",
        length.alias("length"),
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("words") - length),
                lambda i: F.struct(F.xxhash64(F.lit(1), run(i)).alias("a"), F.xxhash64(F.lit(2), run(i)).alias("b")),
            )
        ).alias("w"),
    )
    return each.groupBy("length", "w.a", "w.b").agg(F.collect_set("item_id").alias("items"))


def _covered(spans: Column) -> Column:
    """Words inside at least one of the spans, which are sorted by start."""
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("until"))
    step = lambda acc, s: F.struct(
        (acc["words"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(acc["until"], s["start"]))).alias("words"),
        F.greatest(acc["until"], s["start"] + s["length"]).alias("until"),
    )
    return F.aggregate(spans, zero, step)["words"]


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 13, least_share: float = 0.05, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """Benchmark words per document: doc_id, text_hash, n_words, n_hit, spans, items, contaminated.

    A word is hit where it lies inside an occurrence of a benchmark window. A
    document is contaminated if it has hits and they are ``least_share`` of its
    words or more. Windows are compared by two 64-bit hashes of their words' hashes:
    one finds the hit, the other verifies it. Each input row gives one row,
    repeated rows and rows with null doc_id included; null and empty texts
    have no words. Other columns are ignored. An empty benchmark hits nothing;
    items with null id count as hits but are not listed.

    Documents are read once: every window, and one marker row per document,
    meets the set of windows, and only hits and markers are shuffled. The set
    is broadcast up to ``broadcast_windows`` windows and listed items and else joined by shuffle.
    """
    windows = benchmark_windows(benchmark, n)
    held = F.sum(F.size("items") + 1)
    per_length = {r.length: r.n for r in windows.groupBy("length").agg(held.alias("n")).collect()}  # n rows at most
    known = F.broadcast(windows) if sum(per_length.values()) <= broadcast_windows else windows
    base = docs.select("doc_id", wide_hash("text").alias("text_hash"), _words(F.col("text")).alias("words"))
    marker = F.array(F.struct(F.lit(-1).alias("start"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")))
    runs = base.select(
        "doc_id",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        F.explode(F.concat(marker, *[_windows(F.col("words"), size) for size in sorted(per_length)])).alias("w"),
    ).select("doc_id", "text_hash", "n_words", "w.*")
    met = runs.join(known, ["length", "a", "b"], "left").where((F.col("start") < 0) | F.col("items").isNotNull())
    found = met.groupBy("doc_id", "text_hash", "n_words").agg(
        F.count_if(F.col("start") < 0).alias("copies"),
        F.collect_set(F.when(F.col("start") >= 0, F.struct("start", "length"))).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    return (
        found.withColumn("spans", F.array_sort("spans"))
        .withColumn("items", F.array_sort(F.transform(F.array_distinct(F.flatten("items")), lambda i: i.cast("string"))))
        .withColumn("n_hit", _covered(F.col("spans")).cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") >= least_share * F.col("n_words")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("doc_id", "text_hash", "n_words", "n_hit", "spans", "items", "contaminated")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark, **options).where("contaminated")
    id_, hash_ = spare(docs, "id", "hash")
    bad = bad.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (wide_hash("text") == F.col(hash_)), "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without their hit words, and without what follows each up to the next word."""
    hit = contamination(docs, benchmark, **options).where("n_hit > 0")
    id_, hash_, spans = spare(docs, "id", "hash", "spans")
    hit = hit.groupBy(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).agg(F.first("spans").alias(spans))
    both = docs.join(hit, F.col("doc_id").eqNullSafe(F.col(id_)) & (wide_hash("text") == F.col(hash_)), "left")
    letter, gap = _WORD, _WORD.replace("[^", "[").replace("]+", "]*")
    parts = F.regexp_extract_all("text", F.lit(letter + gap), F.lit(0))
    kept = F.filter(
        parts, lambda p, i: ~F.exists(F.col(spans), lambda s: (i >= s["start"]) & (i < s["start"] + s["length"]))
    )
    cut = F.concat(F.regexp_extract("text", f"^{gap}", 0), F.array_join(kept, ""))
    return both.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut)).select(*[f"`{c}`" for c in docs.columns])
