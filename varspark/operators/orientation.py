"""Read-orientation model: artefacts whose alt reads come from one strand order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.functions.evidence import orientation_weight, with_share
from varspark.operators.skew import spread_join

# Expected share of F1R2 among alt reads, and starting prior, per state.
STATES = {"balanced": (0.5, 0.8), "art_f1r2": (0.95, 0.1), "art_f2r1": (0.05, 0.1)}

ITERATIONS = 10
#: Change of a prior in one round below which a group is done, and the least prior a state keeps.
TOLERANCE, LEAST_PRIOR = 1e-12, 1e-12


def complement(bases: Column) -> Column:
    return F.translate(bases, "ACGT", "TGCA")


def kmer_context(loci: DataFrame, ref_bases: DataFrame) -> DataFrame:
    """The three reference bases around each locus; loci at an edge drop out."""
    around = loci.select("contig", "pos").distinct().withColumn("_shift", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    asked = around.select("contig", "pos", (F.col("pos") + F.col("_shift")).alias("_at"), "_shift")
    bases = ref_bases.select("contig", F.col("pos").alias("_at"), "base")
    at = lambda shift: F.max(F.when(F.col("_shift") == shift, F.col("base")))
    return (
        asked.join(bases, ["contig", "_at"])
        .groupBy("contig", "pos")
        .agg(F.count("*").alias("_n"), F.concat(at(-1), at(0), at(1)).alias("context"))
        .filter(F.col("_n") == 3)
        .drop("_n")
    )


def fold_context(df: DataFrame, contexts: DataFrame | None, f1r2: str, f2r1: str) -> DataFrame:
    """Add ``context``, ``alt_base`` and ``f1r2``, read off the strand whose ref base is A or C.

    On the other strand first and second read swap, and so do the two counts.
    Without ``contexts`` the ref base alone is the context. Rows that are not
    SNVs, or lie where no context is known, get NULL. A locus has a few rows per
    sample, so the join by locus is even.
    """
    if contexts is None:
        seen = df.withColumn("_seen", F.col("ref"))
    else:
        around = contexts.select("contig", "pos", F.col("context").alias("_seen"))
        seen = df.join(around, ["contig", "pos"], "left")
    snv = (F.length("ref") == 1) & (F.length("alt") == 1) & F.col("_seen").isNotNull()
    turn = F.col("ref").isin("G", "T")
    read_off = {
        "context": F.when(turn, F.reverse(complement(F.col("_seen")))).otherwise(F.col("_seen")),
        "alt_base": F.when(turn, complement(F.col("alt"))).otherwise(F.col("alt")),
        "f1r2": F.when(turn, F.col(f2r1)).otherwise(F.col(f1r2)),
    }
    return seen.withColumns({name: F.when(snv, value) for name, value in read_off.items()}).drop("_seen")


def f1r2_histogram(counts: DataFrame, pairs: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """Number of tumour loci per pair, context, alt base, depth, alt count and F1R2 count.

    Loci are counted per tumour; its pairs meet the counts, not the loci.
    """
    cell = ["context", "alt_base", "depth", "alt_count", "f1r2"]
    per_sample = (
        fold_context(counts.join(pairs.select(F.col("tumour_id").alias("lab_id")).distinct(), "lab_id", "left_semi"), contexts, "alt_f1r2", "alt_f2r1")
        .filter(F.col("context").isNotNull())
        .withColumn("depth", F.col("ref_count") + F.col("alt_count"))
        .groupBy(F.col("lab_id").alias("tumour_id"), *cell)
        .agg(F.count("*").alias("n"))
    )
    return per_sample.join(pairs.select("pair", "tumour_id"), "tumour_id").select("pair", *cell, "n")


def _state_weights(prior: dict[str, Column], forward: Column, total: Column) -> dict[str, Column]:
    return {s: F.log10(prior[s]) + orientation_weight(forward, total, STATES[s][0]) for s in STATES}


def learn_orientation(hist: DataFrame, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> DataFrame:
    """State priors per (pair, context, alt base) by expectation maximisation.

    The weights need the alt and F1R2 counts only, so the histogram is summed
    down to those first. The cells of a group, bounded by the depth and not by the genome, are
    one array in one row, over which the rounds are folded; a group is left alone once no prior of
    it moves by more than ``tolerance``.
    """
    group, states = ["pair", "context", "alt_base"], list(STATES)
    cells = hist.filter(F.col("alt_count") > 0).groupBy(*group, "alt_count", "f1r2").agg(F.sum("n").alias("n"))
    logs = {f"_l_{s}": orientation_weight(F.col("f1r2"), F.col("alt_count"), STATES[s][0]) for s in states}
    cells = cells.withColumns(logs).withColumn("_top", F.greatest(*logs))
    scaled = [F.pow(F.lit(10.0), F.col(f"_l_{s}") - F.col("_top")).alias(s) for s in states]
    whole = cells.groupBy(*group).agg(F.collect_list(F.struct(F.col("n").cast("double").alias("n"), *scaled)).alias("cells"), F.sum("n").alias("total"))

    def next_round(state: Column) -> Column:
        prior = {s: F.greatest(state[s], F.lit(LEAST_PRIOR)) for s in states}
        mass = lambda c: sum((prior[s] * c[s] for s in states), F.lit(0.0))
        add = lambda acc, c: F.struct(*[(acc[s] + c["n"] * prior[s] * c[s] / mass(c)).alias(s) for s in states])
        sums = F.aggregate("cells", F.struct(*[F.lit(0.0).alias(s) for s in states]), add)
        # One entry, so that the sums have a name and are taken once.
        named = lambda x: F.struct(
            *[(x[s] / F.col("total")).alias(s) for s in states], F.greatest(*[F.abs(x[s] / F.col("total") - state[s]) for s in states]).alias("moved")
        )
        return F.get(F.transform(F.array(sums), named), F.lit(0))

    start = F.struct(*[F.lit(STATES[s][1]).alias(s) for s in states], F.lit(1.0).alias("moved"))
    fold = lambda state, _: F.when(state["moved"] <= tolerance, state).otherwise(next_round(state))
    learned = whole.select(*group, F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, fold).alias("_p"))
    pairs_of = F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.col(f"_p.{s}").alias("prior")) for s in states]))
    return learned.select(*group, pairs_of.alias("_s")).select(*group, "_s.state", "_s.prior")


def orientation_posterior(calls: DataFrame, model: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """Add ``p_orientation``; 0 for indels and for contexts the model has not seen."""
    group = ["pair", "context", "alt_base"]
    wide = model.groupBy(*group).agg(
        *[F.max(F.when(F.col("state") == s, F.col("prior"))).alias(s) for s in STATES]
    )
    folded = fold_context(calls, contexts, "t_f1r2", "t_f2r1")
    prior = {s: F.greatest(F.col(s), F.lit(LEAST_PRIOR)) for s in STATES}
    known = spread_join(folded, wide, group, "left")
    return with_share(
        known,
        "p_orientation",
        _state_weights(prior, F.col("f1r2"), F.col("t_alt")),
        ["art_f1r2", "art_f2r1"],
        where=F.col("balanced").isNotNull(),
    ).drop("context", "alt_base", "f1r2", *STATES)
