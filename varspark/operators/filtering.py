"""Evidence tables joined to calls, error probabilities, thresholds and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.functions.evidence import contamination_weights, with_share
from varspark.operators.ordered import running_total
from varspark.operators.orientation import orientation_posterior
from varspark.operators.regions import bin_join
from varspark.operators.sites import sort_sites
from varspark.operators.skew import spread_join
from varspark.operators.somatic import MIN_TUMOUR_LOD, germline_posterior

MIN_NORMAL_LOD = 2.2
SEGMENT_BIN = 1_000_000
PLACES = 12
CLUSTER_BIN = 10_000


def filter_evidence(
    calls: DataFrame,
    stats: DataFrame,
    segments: DataFrame,
    contamination: DataFrame,
    orientation: DataFrame,
    contexts: DataFrame | None = None,
    segment_width: int = SEGMENT_BIN,
) -> DataFrame:
    """Calls with callable sites, segment MAF, contamination and orientation evidence.

    What belongs to a whole pair is joined into one small table first, so the
    calls meet it in a single join.
    """
    callable_ = stats.filter(F.col("statistic") == "callable").select("pair", F.col("value").alias("callable"))
    per_pair = (
        calls.groupBy("pair")
        .agg(F.count("*").alias("n_calls"))
        .join(callable_, "pair", "left")
        .join(contamination.select("pair", "contamination"), "pair", "left")
    )
    known = spread_join(calls, per_pair, ["pair"])
    spans = segments.select("pair", "contig", "start_pos", "end_pos", "maf")
    placed = bin_join(known, spans, width=segment_width, how="left", by=("pair", "contig"))
    return orientation_posterior(placed, orientation, contexts)


def contamination_posterior(calls: DataFrame) -> DataFrame:
    """Add P(alt reads come from another person); 0 where no contamination was measured."""
    weights = contamination_weights(F.col("t_ref"), F.col("t_alt"), F.col("af"), F.col("contamination"))
    return with_share(calls, "p_contamination", weights, ["foreign"], where=F.col("contamination") > 0)


def weak_share(tlod: Column, n_calls: Column, callable_: Column) -> Column:
    """P(no variant): the tumour LOD against the share of callable sites that are called."""
    rate = n_calls / F.greatest(F.coalesce(callable_, n_calls), n_calls)
    prior = F.least(F.greatest(rate, F.lit(1e-8)), F.lit(0.5))
    odds = F.log10(prior) - F.log10(F.lit(1.0) - prior) + tlod
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), odds))


def error_probability(calls: DataFrame, diploid: Column | None = None) -> DataFrame:
    """Add ``p_error``: the call is not somatic for at least one reason.

    ``diploid`` is false where there is no heterozygous state (mitochondria).
    """
    scored = contamination_posterior(germline_posterior(calls, diploid, maf="maf")).withColumn(
        "p_weak", weak_share(F.col("tlod"), F.col("n_calls"), F.col("callable"))
    )
    right = F.lit(1.0)
    for reason in ("p_germline", "p_contamination", "p_orientation", "p_weak"):
        right = right * (F.lit(1.0) - F.col(reason))
    return scored.withColumn("p_error", F.lit(1.0) - right)


def learn_threshold(calls: DataFrame) -> DataFrame:
    """Per pair the error probability with the best expected F-score when calls up to it are kept; ties go to the lowest.

    Running sums are taken in two steps: inside stretches of 1/10,000 of the
    probability scale, and over the totals of the stretches, so no window sorts a whole pair.
    Probabilities are compared to ``PLACES`` decimals.
    """
    p = F.round("p_error", PLACES)
    kept = calls.select("pair", p.alias("_p"), (F.lit(1.0) - F.col("p_error")).alias("_real"), F.col("p_error").alias("_false"))
    steps = kept.groupBy("pair", "_p").agg(F.sum("_real").alias("_real"), F.sum("_false").alias("_false"))
    steps = steps.withColumn("_b", F.floor(F.col("_p") * F.lit(10_000)).cast("long"))
    whole = steps.groupBy("pair").agg(F.sum("_real").alias("_all"))
    summed = running_total(steps, F.col("_real"), "_tp", order=["_b", "_p"], keys=["pair"], width=1)
    summed = running_total(summed, F.col("_false"), "_fp", order=["_b", "_p"], keys=["pair"], width=1).join(whole, "pair")
    denominator = F.col("_tp") + (F.col("_fp") + F.col("_all") - F.col("_tp")) / F.lit(2.0)
    score = F.round(F.when(denominator > 0, F.col("_tp") / denominator).otherwise(F.lit(0.0)), 9)
    best = F.max(F.struct(score.alias("f"), (-F.col("_p")).alias("p")))
    return summed.groupBy("pair").agg(best.alias("_best")).select("pair", (-F.col("_best.p")).alias("threshold"), F.col("_best.f").alias("f_score"))


def _neighbours(calls: DataFrame, within: int) -> DataFrame:
    """``n_near``: called sites of the pair within ``within`` bases, its own included; ``n_alleles`` at its own.

    A call is also listed in the neighbouring bin it can be seen from, so a
    window holds the calls of one pair in one bin and its rim.
    """
    width = max(CLUSTER_BIN, 2 * within)
    bin_of = lambda place: F.floor(place / F.lit(width)).cast("long")
    pos = F.col("pos")
    listed = calls.withColumn("_home", bin_of(pos)).withColumn(
        "_bin", F.explode(F.sequence(bin_of(pos - within), bin_of(pos + within)))
    )
    region = ["pair", "contig", "_bin"]
    # Dealt by region, rows lie right for both windows; else each would shuffle them.
    listed = listed.repartition(*region)
    near = Window.partitionBy(*region).orderBy("pos").rangeBetween(-within, within)
    here = Window.partitionBy(*region, "pos")
    first = F.row_number().over(here.orderBy("ref", "alt")) == 1
    return (
        listed.withColumn("n_alleles", F.count("*").over(here))
        .withColumn("_site", F.when(first, 1).otherwise(0))
        .withColumn("n_near", F.sum("_site").over(near))
        .filter(F.col("_home") == F.col("_bin"))
        .drop("_home", "_bin", "_site")
    )


def apply_filters(
    calls: DataFrame,
    thresholds: DataFrame,
    min_tumour_lod: Column | float = MIN_TUMOUR_LOD,
    min_normal_lod: float = MIN_NORMAL_LOD,
    max_near: int = 2,
    within: int = 100,
) -> DataFrame:
    """Add ``filters``: the names of all failed tests, empty for a PASS call.

    A reason fails a call when its probability exceeds the pair's threshold.
    """
    judged = spread_join(_neighbours(calls, within), thresholds.select("pair", "threshold"), ["pair"])

    def over(name: str) -> Column:
        return F.round(name, PLACES) > F.col("threshold")

    short_of_normal = F.col("nlod") < min_normal_lod
    doubtful = over("p_error") & ~over("p_germline") & ~over("p_contamination") & ~over("p_orientation")
    weak = (F.col("tlod") < min_tumour_lod) | (short_of_normal & (F.col("n_alt") == 0)) | doubtful
    tests = {
        "panel_of_normals": F.col("in_pon"),
        "germline": over("p_germline"),
        "contamination": over("p_contamination"),
        "orientation": over("p_orientation"),
        "weak_evidence": weak,
        "normal_artifact": short_of_normal & (F.col("n_alt") > 0),
        "multiallelic": F.col("n_alleles") > 1,
        "clustered_events": F.col("n_near") > max_near,
    }
    named = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))
    return judged.withColumn("filters", named)


def filter_summary(calls: DataFrame) -> DataFrame:
    """Calls per pair and filter, with totals (NULL) per pair and over the cohort.

    A call with several filters counts under each; ``PASS`` stands for none.
    """
    labels = F.when(F.size("filters") == 0, F.array(F.lit("PASS"))).otherwise(F.col("filters"))
    counted = calls.select("pair", F.explode(labels).alias("filter")).groupBy("pair", "filter").agg(
        F.count("*").alias("n")
    )
    return counted.rollup("pair", "filter").agg(F.sum("n").alias("n_calls"))


def final_calls(calls: DataFrame, contigs: DataFrame) -> DataFrame:
    """PASS calls in dictionary order."""
    return sort_sites(calls.filter(F.size("filters") == 0), contigs)
