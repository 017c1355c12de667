"""Panel of normals: candidates of each normal, the cohort store and the panel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspark.functions.evidence import allele_fraction, germline_weights, tumour_lod, with_share
from varspark.operators.regions import assign_interval
from varspark.operators.sites import annotate_germline
from varspark.operators.skew import spread_join
from varspark.schemas import SITE
from varspark.sources.store import MOST_PARTS, VersionedStore
from varspark.sources.writers import write_table

SUMS = "contig string, pos bigint, ref string, alt string, n_seen bigint, mean_f double, m2 double"
SAMPLES = "lab_id string"
MIN_SAMPLES = 2
MAX_P_GERMLINE = 0.5
# Rounding of equal fractions leaves less than this.
NO_VARIANCE = 1e-15


def normal_candidates(
    counts: DataFrame, normals: DataFrame, min_alt: int = 2, min_depth: int = 10, min_lod: float = 3.0
) -> DataFrame:
    """Alternate alleles seen in a normal, called as if it had no match."""
    ref, alt = F.col("ref_count"), F.col("alt_count")
    deep = counts.filter((alt >= min_alt) & (ref + alt >= min_depth))
    called = deep.withColumn("lod", tumour_lod(ref, alt)).filter(F.col("lod") >= min_lod)
    kept = spread_join(called, normals.select("lab_id").distinct(), ["lab_id"])
    return kept.withColumn("fraction", allele_fraction(ref, alt))


def split_mnps(variants: DataFrame) -> DataFrame:
    """Substitutions of several bases as one SNV row per changed base; the rest as they are."""
    bases = F.zip_with(
        F.split("ref", ""), F.split("alt", ""), lambda r, a: F.struct(r.alias("ref"), a.alias("alt"))
    )
    placed = F.transform(
        bases, lambda b, i: F.struct(i.cast("long").alias("shift"), b["ref"].alias("ref"), b["alt"].alias("alt"))
    )
    changed = F.filter(placed, lambda b: b["ref"] != b["alt"])
    whole = F.array(F.struct(F.lit(0).cast("long").alias("shift"), F.col("ref"), F.col("alt")))
    is_mnp = (F.length("ref") == F.length("alt")) & (F.length("ref") > 1)
    rest = [c for c in variants.columns if c not in ("pos", "ref", "alt")]
    return variants.select(
        *rest, F.col("pos").alias("_pos"), F.explode(F.when(is_mnp, changed).otherwise(whole)).alias("_b")
    ).select(
        *rest,
        (F.col("_pos") + F.col("_b.shift")).alias("pos"),
        F.col("_b.ref").alias("ref"),
        F.col("_b.alt").alias("alt"),
    )


def gather_calls(*parts: DataFrame) -> DataFrame:
    """Interval parts as one table, in order of position within each partition.

    Range partitions also split a sample that holds most of the calls.
    """
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    order = ["lab_id", *SITE]
    return whole.repartitionByRange(*order).sortWithinPartitions(*order)


def consolidate_cohort(calls: DataFrame, intervals: DataFrame, path: str | None = None) -> DataFrame:
    """All samples in one store keyed by interval; written and read back when a path is given."""
    store = assign_interval(calls, intervals)
    if path is None:
        return store
    write_table(store, path, by="interval_id", order=("contig", "pos", "lab_id"))
    return store.sparkSession.read.schema(store.schema).parquet(path)


def cohort_matrix(
    calls: DataFrame, columns: list[str], by: str = "lab_id", rows: list[str] = SITE, value: str = "alt_count"
) -> DataFrame:
    """Wide sites × samples table for the named columns.

    Naming them keeps the width with the caller and saves a pass to find them.
    """
    return calls.groupBy(*rows).pivot(by, columns).agg(F.max(value))


def pon_sums(calls: DataFrame, germline: DataFrame | None = None, max_p_germline: float = MAX_P_GERMLINE) -> DataFrame:
    """Per site the number, mean and squared deviation (M2) of the alt fraction over normals whose call is not germline.

    These moments of separate cohorts can be merged. Grouping by sample first spreads a
    site that every normal shows over many tasks.
    """
    if germline is not None:
        known = annotate_germline(calls, germline)
        weights = germline_weights(F.col("ref_count"), F.col("alt_count"), F.col("af"))
        calls = with_share(known, "_p", weights, ["het", "hom"]).filter(F.col("_p") <= max_p_germline)
    per_sample = calls.groupBy(*SITE, "lab_id").agg(F.max("fraction").alias("f"))
    return per_sample.groupBy(*SITE).agg(
        F.count("*").alias("n_seen"), F.avg("f").alias("mean_f"), (F.var_pop("f") * F.count("*")).alias("m2")
    )


def merge_pon_sums(*sums: DataFrame) -> DataFrame:
    """Moments of all cohorts together; a site has a row per cohort at most."""
    whole = reduce(lambda a, b: a.unionByName(b), sums)
    parts = whole.groupBy(*SITE).agg(
        F.sum("n_seen").alias("n_seen"),
        (F.sum(F.col("n_seen") * F.col("mean_f")) / F.sum("n_seen")).alias("mean_f"),
        F.collect_list(F.struct("n_seen", "mean_f", "m2")).alias("_parts"),
    )
    gap = lambda p: p["mean_f"] - F.col("mean_f")
    m2 = F.aggregate("_parts", F.lit(0.0), lambda total, p: total + p["m2"] + p["n_seen"] * gap(p) * gap(p))
    return parts.withColumn("m2", m2).drop("_parts")


def panel_from_sums(sums: DataFrame, normals: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Sites of enough normals, with the moments of the alt fraction and the beta shape they imply (NULL without variance)."""
    n_normals = normals.agg(F.count_distinct("lab_id").alias("n")).scalar()
    panel = sums.filter(F.col("n_seen") >= min_samples).select(
        *SITE,
        "n_seen",
        (F.col("n_seen") / n_normals).alias("share_of_normals"),
        F.col("mean_f").alias("mean_fraction"),
        (F.col("m2") / F.col("n_seen")).alias("var_fraction"),
    )
    m, v = F.col("mean_fraction"), F.col("var_fraction")
    size = F.when(v > NO_VARIANCE, m * (F.lit(1.0) - m) / v - F.lit(1.0))
    return panel.withColumns({"beta_alpha": m * size, "beta_beta": (F.lit(1.0) - m) * size})


def create_pon(
    calls: DataFrame,
    normals: DataFrame,
    germline: DataFrame | None = None,
    min_samples: int = MIN_SAMPLES,
    max_p_germline: float = MAX_P_GERMLINE,
) -> DataFrame:
    """Sites seen as non-germline in at least ``min_samples`` normals."""
    return panel_from_sums(pon_sums(calls, germline, max_p_germline), normals, min_samples)


def write_panel_store(
    calls: DataFrame,
    normals: DataFrame,
    path: str,
    germline: DataFrame | None = None,
    max_p_germline: float = MAX_P_GERMLINE,
) -> None:
    """A panel that can grow: the moments per site, and the register of the samples in them, as the first generation of a store."""
    VersionedStore(calls.sparkSession, path).commit({"sums": pon_sums(calls, germline, max_p_germline), "samples": normals.select("lab_id").distinct()})


def extend_pon(
    path: str,
    new_calls: DataFrame,
    new_normals: DataFrame,
    germline: DataFrame | None = None,
    min_samples: int = MIN_SAMPLES,
    max_p_germline: float = MAX_P_GERMLINE,
    most_parts: int = MOST_PARTS,
) -> DataFrame:
    """Panel of a grown cohort from a written store and the samples that its register lacks.

    The store grows with it: moments and names of the new samples become visible in one commit, so that
    the next cohort can be offered alone, and a run that fails before it can simply be repeated. Of two runs at a time one raises.
    Calls of samples that ``new_normals`` lacks are left out. Past ``most_parts`` parts the moments are merged into one.
    """
    store = VersionedStore(new_calls.sparkSession, path)
    fresh = new_normals.select("lab_id").distinct().join(store.read("samples", SAMPLES), "lab_id", "left_anti")
    store.commit({"sums": pon_sums(new_calls.join(fresh, "lab_id", "left_semi"), germline, max_p_germline), "samples": fresh})
    if len(store.parts()["sums"]) > most_parts:
        store.commit({"sums": merge_pon_sums(store.read("sums", SUMS)), "samples": store.read("samples", SAMPLES)}, replacing=True)
    return panel_from_sums(merge_pon_sums(store.read("sums", SUMS)), store.read("samples", SAMPLES), min_samples)
