"""Site resources: alleles, variant types and population frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varspark.functions.evidence import DEFAULT_AF
from varspark.operators.reference import normalise_indels
from varspark.operators.skew import spread_join
from varspark.schemas import SITE


def explode_alleles(variants: DataFrame) -> DataFrame:
    """One row per ALT allele with its own AF (``alts`` and ``afs`` side by side)."""
    paired = F.arrays_zip(F.col("alts").alias("alt"), F.col("afs").alias("af"))
    rest = [c for c in variants.columns if c not in ("alts", "afs")]
    return variants.select(*rest, F.explode(paired).alias("_allele")).select(
        *rest, F.col("_allele.alt").alias("alt"), F.col("_allele.af").alias("af")
    )


def classify_variant(variants: DataFrame) -> DataFrame:
    """Add ``variant_type`` of one ref and one alt: SNP, MNP, INS, DEL or MIXED.

    An insertion or deletion shares its first base with the reference and only
    grows or shrinks from there; other unequal lengths are MIXED.
    """
    ref, alt = F.col("ref"), F.col("alt")
    n_ref, n_alt = F.length(ref), F.length(alt)
    kind = (
        F.when((n_ref == 1) & (n_alt == 1), "SNP")
        .when(n_ref == n_alt, "MNP")
        .when((n_ref < n_alt) & F.startswith(alt, ref), "INS")
        .when((n_ref > n_alt) & F.startswith(ref, alt), "DEL")
        .otherwise("MIXED")
    )
    return variants.withColumn("variant_type", kind)


def select_common_biallelic(sites: DataFrame, min_af: float = 0.05) -> DataFrame:
    """SNPs with exactly one ALT and AF above the threshold (strictly)."""
    one = F.size("alts") == 1
    alt, af = F.try_element_at("alts", F.lit(1)), F.try_element_at("afs", F.lit(1))
    snp = (F.length("ref") == 1) & (F.length(alt) == 1)
    kept = sites.filter(one & snp & (af > min_af))
    return kept.withColumns({"alt": alt, "af": af}).drop("alts", "afs")


def annotate_germline(
    variants: DataFrame, germline: DataFrame, default_af: float = DEFAULT_AF, salts: int = 1, chunks: DataFrame | None = None
) -> DataFrame:
    """Population AF of each allele, ``default_af`` where the resource lacks it or gives none.

    An allele has at most one row per sample here, which bounds its rows by the
    cohort; the resource may be large, so it is repeated only if asked. With packed reference ``chunks`` indels of both
    sides are compared as ``normalise_indels`` writes them; the variants keep their own spelling.
    """
    if chunks is not None:
        own = {c: f"_own_{c}" for c in ("pos", "ref", "alt")}
        kept = variants.withColumns({o: F.col(c) for c, o in own.items()})
        named = annotate_germline(normalise_indels(kept, chunks), normalise_indels(germline.select(*SITE, "af"), chunks), default_af, salts)
        return named.select(*[F.col(own[c]).alias(c) if c in own else c for c in variants.columns if c != "af"], "af")
    known = germline.groupBy(*SITE).agg(F.max("af").alias("af"))
    return spread_join(variants, known, SITE, "left", salts).withColumn(
        "af", F.coalesce("af", F.lit(default_af))
    )


def resource_size(sites: DataFrame) -> DataFrame:
    """Loci per contig and, with contig NULL, in all."""
    per_contig = sites.groupBy("contig").agg(F.count("*").alias("n"))
    return per_contig.rollup("contig").agg(F.sum("n").alias("n_loci"))


def sort_sites(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """Reference-dictionary order, by a parallel range sort; contigs the dictionary lacks (idx NULL) come last, by name."""
    placed = df.join(contigs.select("contig", "idx"), "contig", "left")
    rest = [c for c in ("ref", "alt", "pair", "lab_id") if c in df.columns]
    return placed.orderBy(F.col("idx").asc_nulls_last(), "contig", "pos", *rest)
