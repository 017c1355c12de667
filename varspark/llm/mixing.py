"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.llm.columns import SPACED_WORD, wide_hash
from varspark.llm.stages import Stages
from varspark.session import stored

#: Parts of a source's rank order; only the part that holds the end of the sample is put in order.
BUCKETS = 4096
#: Words at which the preference by size is one half.
HALF_LIKED = 500


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *key: Column) -> Column:
    """A number in (0, 1) that depends on the seed and key alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    return (F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Words to take per source: the columns of ``sizes`` (source, source_size and others), weight, target.

    Weights repeat over the sources in code-point order, null last. A target
    stops at ``most`` times its source; the excess goes to the others by
    weight. Sources fill up in order of size by weight, so running sums over
    the sources in that order give all targets at once. The windows without
    a key hold a row per source, not per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("n") - 1) % len(weights) + 1).cast("int"))
    named = sizes.withColumn("n", F.row_number().over(by_name)).withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("n").asc())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("total") - (F.col("caps") - F.col("cap"))) / F.col("rest")
    filled = (
        named.withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("caps", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("full", F.col("weight") * level >= F.col("cap"))
        .withColumn("left", F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
        .withColumn("open", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything))
    )
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (F.col("left") / F.col("open")))
    return filled.select(*sizes.columns, "weight", target.alias("target"))


def _sized(docs: DataFrame, preference: Column | None, seed: int, *keep: Column) -> DataFrame:
    """keep, doc_id, text_hash, source, size, u (uniform by seed, doc_id and text), wish (preference in thousandths) of each row."""
    asked = F.lit(None).cast("double") if preference is None else F.coalesce(preference.cast("double"), F.lit(0.5))
    rows = docs.select(
        *keep,
        "doc_id",
        wide_hash("text").alias("text_hash"),
        "source",
        word_count(F.col("text")).alias("size"),
        uniform(seed, F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))).alias("u"),
        asked.alias("asked"),
    )
    by_size = F.expr(f"1000 * size div (size + {HALF_LIKED})")
    given = F.round(1000 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), "asked"))).cast("long")
    return rows.withColumn("wish", by_size if preference is None else given).drop("asked")


def _beside(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """The rows with what a table holds about their source, which it names ``of``."""
    return rows.join(by_source, rows["source"].eqNullSafe(by_source["of"]), "left").drop("of")


def _ranked(sized: DataFrame, plan: DataFrame, buckets: int) -> DataFrame:
    """Sized rows with the plan of their source, ``bucket`` and ``key`` (rank, then what tells rows apart), null where no sample is drawn."""
    chance = F.col("p") + F.least(F.col("p"), 1 - F.col("p")) / 2 * ((F.col("wish") - F.col("wished") / F.col("source_size")) / 1000)
    odds = lambda p: p / (F.lit(1.0) - p)
    # At mean odds the rank is spread evenly by this; a document's own odds make a part three times as full at most.
    spread = 1 - 1 / (1 + F.col("rank") * odds(F.col("p")))
    return (
        _beside(sized, plan)
        .withColumn("rank", F.when(F.col("p") > 0, odds(F.col("u")) / odds(chance)))
        .withColumn("bucket", F.when(F.col("p") > 0, F.floor(spread * buckets)))
        .withColumn("key", F.struct("rank", "doc_id", "size", "text_hash"))
    )


def _taken() -> Column:
    """Whether a row lies before the end of its source's sample."""
    inside = (F.col("bucket") == F.col("cut")) & F.coalesce(F.col("key") <= F.col("last"), F.lit(False))
    return F.when(F.col("p") > 0, F.col("cut").isNull() | (F.col("bucket") < F.col("cut")) | inside).otherwise(False)


def _plan(docs: DataFrame, weights: Sequence[float], share: float, most: float, preference: Column | None, seed: int, buckets: int) -> DataFrame:
    """What each source's rows need to be judged one by one: a row per source."""
    stages = Stages(docs.sparkSession)
    sized = stages.stored(_sized(docs, preference, seed), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("wish")).alias("wished"))
    share_of = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (
        targets(sizes, weights, share, most)
        .withColumn("whole", F.floor(share_of))
        .withColumn("p", share_of - F.col("whole"))
        .withColumn("room", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumnRenamed("source", "of")
    )
    plan = stages.stored(plan, "mix-plan")
    ranked = _ranked(sized, plan, buckets).where("p > 0")

    # Words up to each bucket, from at most `buckets` rows per source, tell which bucket the sample ends in.
    words = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
    words = words.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words"))
    cuts = words.where("before + words > room").groupBy("source").agg(F.min(F.struct("bucket", "before")).alias("c"))
    cuts = stages.stored(cuts.select(F.col("source").alias("of"), F.col("c.bucket").alias("cut"), F.col("c.before").alias("before")), "mix-cuts")

    # Only that bucket is put in order. Rows that tie count as one.
    last = _beside(ranked, cuts).where("bucket = cut").groupBy("source", "key")
    last = last.agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("room").alias("room"))
    last = last.withColumn("until", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key")))
    last = last.where("until <= room").groupBy("source").agg(F.max("key").alias("last"), F.max("until").alias("until"))
    ends = cuts.join(last, cuts["of"].eqNullSafe(last["source"]), "left").select("of", "cut", "last", F.coalesce("until", "before").alias("until"))
    ends = stages.stored(ends, "mix-ends")

    waiting = _beside(ranked, ends).where(~_taken()).groupBy("source", "key")
    waiting = waiting.agg(F.sum("size").alias("words"), F.first(F.col("room") - F.col("until")).alias("open"))
    miss = F.abs(F.col("words") - F.col("open"))
    closing = waiting.where(miss < F.col("open")).groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "key")).alias("c"))
    closing = closing.select(F.col("source").alias("closed"), F.col("c.key").alias("closer"))
    whole = plan.join(ends.withColumnRenamed("of", "ended"), F.col("of").eqNullSafe(F.col("ended")), "left")
    whole = whole.join(closing, F.col("of").eqNullSafe(F.col("closed")), "left").drop("ended", "closed", "until", "weight")
    result = stored(whole, "mix-plan")
    stages.drop()
    return result


def _copies() -> Column:
    closes = F.coalesce(F.col("key") == F.col("closer"), F.lit(False))
    return (F.col("whole") + _taken().cast("long") + closes.cast("long")).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    preference: Column | None = None,
    seed: int = 17,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Copies of each document in the mix: doc_id, text_hash, source, size, source_size, target, copies.

    A source expects target / source_size copies of its words. The whole part is certain for each document.
    The fraction p is the mean inclusion probability of a Pareto order sample: with
    u uniform from the seed, doc_id and text, documents of a source are ranked by
    (u / (1 - u)) / (p_i / (1 - p_i)), and taken in that order while their words fit
    into what the certain copies leave of the target. One more document closes the
    sample: of those not taken, the one whose size is nearest to what is
    still open, if it brings the words nearer to the target.

    p_i = p + min(p, 1 - p) / 2 * (w_i - w): w_i is the document's preference and w the mean of these over the
    words of its source, so the expected words are the target's. ``preference`` is a deterministic column from 0 to 1 (beyond: clipped;
    null: 0.5; rounded to thousandths); without one it is size / (size + 500), which favours long documents.

    Sizes are words; null and empty texts have none and take no room. Null sources form a source of their own.
    Each input row gives one row. After the odds, doc_id, size and text hash decide the order, so
    only rows that repeat doc_id, text and source tie; they are taken or left together. An empty table gives no rows.
    """
    plan = _plan(docs, weights, share, most, preference, seed, buckets)
    judged = _ranked(_sized(docs, preference, seed), plan, buckets)
    return judged.select("doc_id", "text_hash", "source", "size", "source_size", "target", _copies().alias("copies"))


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    preference: Column | None = None,
    seed: int = 17,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The documents of the mix, each as many times as it is taken, with all their columns. Options as in ``mix``; no text is shuffled."""
    plan = _plan(docs, weights, share, most, preference, seed, buckets)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = _ranked(_sized(docs, preference, seed, row), plan, buckets).select("row", _copies().alias("copies")).where("copies > 0")
    return judged.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
