"""Tumour-normal calls from allele counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.functions.evidence import germline_weights, normal_lod, tumour_lod, with_share
from varspark.operators.pileup import reference_depths
from varspark.operators.regions import only_contig
from varspark.operators.sites import annotate_germline, sort_sites
from varspark.operators.skew import spread_join
from varspark.schemas import SITE

MIN_ALT = 3
MIN_DEPTH = 10
MIN_TUMOUR_LOD = 6.3
MIN_TUMOUR_LOD_MITO = 3.0


def tumour_candidates(
    counts: DataFrame,
    pairs: DataFrame,
    min_alt: int = MIN_ALT,
    min_depth: int = MIN_DEPTH,
    min_lod: Column | float = MIN_TUMOUR_LOD,
) -> DataFrame:
    """Tumour alleles of each pair with enough evidence of their own.

    Evidence is tested before the pairs are joined, so weak alleles never move.
    """
    ref, alt = F.col("ref_count"), F.col("alt_count")
    strong = (
        counts.filter((alt >= min_alt) & (ref + alt >= min_depth))
        .withColumn("tlod", tumour_lod(ref, alt))
        .filter(F.col("tlod") >= min_lod)
        .withColumnsRenamed(
            {
                "lab_id": "tumour_id",
                "ref_count": "t_ref",
                "alt_count": "t_alt",
                "alt_f1r2": "t_f1r2",
                "alt_f2r1": "t_f2r1",
            }
        )
    )
    return spread_join(strong, pairs.select("pair", "tumour_id", "normal_id"), ["tumour_id"])


def join_matched_normal(cands: DataFrame, counts: DataFrame, depths: DataFrame | None = None) -> DataFrame:
    """Counts of the matched normal for the same allele, 0 where it has none.

    Counts from reads list only alleles that were seen, so a normal without the
    allele has no row; its reference reads then come from ``depths`` (lab_id, contig, pos,
    ref_count), as from ``pileup.reference_depths``. A normal that neither table
    holds is not covered: both counts are 0. The key holds sample and allele, one row each, so no key is hot.
    """
    normal = counts.select(
        F.col("lab_id").alias("normal_id"),
        *SITE,
        F.col("ref_count").alias("n_ref"),
        F.col("alt_count").alias("n_alt"),
    )
    joined = cands.join(normal, ["normal_id", *SITE], "left")
    if depths is not None:
        covered = depths.select(F.col("lab_id").alias("normal_id"), "contig", "pos", F.col("ref_count").alias("_covered"))
        joined = joined.join(covered, ["normal_id", "contig", "pos"], "left")
        joined = joined.withColumn("n_ref", F.coalesce("n_ref", "_covered")).drop("_covered")
    joined = joined.fillna(0, ["n_ref", "n_alt"])
    return joined.withColumn("nlod", normal_lod(F.col("n_ref"), F.col("n_alt")))


def mark_pon(calls: DataFrame, pon: DataFrame, salts: int = 1) -> DataFrame:
    """Add ``in_pon`` for alleles of the panel."""
    listed = pon.select(*SITE).distinct().withColumn("in_pon", F.lit(True))
    return spread_join(calls, listed, SITE, "left", salts).withColumn("in_pon", F.coalesce("in_pon", F.lit(False)))


def germline_posterior(
    calls: DataFrame, diploid: Column | None = None, maf: str | None = None, out: str = "p_germline"
) -> DataFrame:
    """Add P(germline) given the counts of both samples and the population frequency."""
    counts = [F.col(c) for c in ("t_ref", "t_alt", "af", "n_ref", "n_alt")]
    weights = germline_weights(*counts, maf=F.col(maf) if maf else None, diploid=diploid)
    return with_share(calls, out, weights, ["het", "hom"])


def _call(counts, pairs, pon, germline, min_lod: Column | float, diploid: Column | None, reads=None) -> DataFrame:
    cands = tumour_candidates(counts, pairs, min_lod=min_lod)
    depths = None if reads is None else reference_depths(reads, cands.select(F.col("normal_id").alias("lab_id"), *SITE))
    cands = join_matched_normal(cands, counts, depths)
    # Both site tables are joined on one key: the calls are shuffled by allele once.
    marked = mark_pon(annotate_germline(cands, germline), pon)
    return germline_posterior(marked, diploid)


def call_pairs(
    counts: DataFrame, pairs: DataFrame, pon: DataFrame, germline: DataFrame, min_lod: float = MIN_TUMOUR_LOD
) -> DataFrame:
    """Unfiltered calls of every pair."""
    return _call(counts, pairs, pon, germline, min_lod, None)


def call_mitochondria(
    counts: DataFrame,
    pairs: DataFrame,
    pon: DataFrame,
    germline: DataFrame,
    contig: str = "chrM",
    min_lod: float = MIN_TUMOUR_LOD_MITO,
) -> DataFrame:
    """Calls on the mitochondrial contig: lower LOD, no heterozygous state."""
    only = only_contig(germline, contig)
    return _call(only_contig(counts, contig), pairs, pon, only, min_lod, F.lit(False))


def call_genome(
    counts: DataFrame, pairs: DataFrame, pon: DataFrame, germline: DataFrame, mito: str = "chrM", reads: DataFrame | None = None
) -> DataFrame:
    """Nuclear and mitochondrial calls in one pass, each contig by its own rules.

    With ``reads``, which ``counts`` come from, the reference depth of the normals is taken from them.
    """
    nuclear = F.col("contig") != mito
    min_lod = F.when(nuclear, MIN_TUMOUR_LOD).otherwise(MIN_TUMOUR_LOD_MITO)
    return _call(counts, pairs, pon, germline, min_lod, nuclear, reads)


def merge_branches(contigs: DataFrame, *branches: DataFrame) -> DataFrame:
    return sort_sites(reduce(lambda a, b: a.unionByName(b), branches), contigs)


def callable_stats(callable_: DataFrame, pairs: DataFrame) -> DataFrame:
    """Callable loci of each tumour and interval as statistics of its pairs."""
    of_tumour = callable_.withColumnRenamed("lab_id", "tumour_id")
    return spread_join(of_tumour, pairs.select("pair", "tumour_id"), ["tumour_id"]).select(
        "pair", "interval_id", F.lit("callable").alias("statistic"), F.col("callable").cast("double").alias("value")
    )


def merge_stats(stats: DataFrame) -> DataFrame:
    """Each statistic summed over all intervals of a pair."""
    return stats.groupBy("pair", "statistic").agg(F.sum("value").alias("value"))
