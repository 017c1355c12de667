"""Samples, patients and tumour-normal pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varspark.operators.skew import spread_join

# Name endings that give a sample its role.
NORMAL_SUFFIX = r"-[NB].?"
TUMOUR_SUFFIX = r"-[TMP].*"



def active_rows(manifest: DataFrame) -> DataFrame:
    """Rows that are neither commented out nor blank."""
    named = F.coalesce(F.trim("sample_id"), F.lit("")) != ""
    return manifest.filter(named & ~F.col("sample_id").startswith("#") & F.col("lab_id").isNotNull())


def classify_samples(manifest: DataFrame, normal: str = NORMAL_SUFFIX, tumour: str = TUMOUR_SUFFIX) -> DataFrame:
    """Add ``role``: normal, tumour or unknown. Normal wins where both endings fit."""
    lab = F.col("lab_id")
    role = (
        F.when(lab.rlike(normal + "$"), "normal").when(lab.rlike(tumour + "$"), "tumour").otherwise("unknown")
    )
    return active_rows(manifest).withColumn("role", role)


def derive_patient(samples: DataFrame, normal: str = NORMAL_SUFFIX, tumour: str = TUMOUR_SUFFIX) -> DataFrame:
    """Split LabSampleID into ``patient`` and ``suffix``; both NULL for an unknown role."""
    lab = F.col("lab_id")
    ending = F.when(F.col("role") == "normal", F.regexp_extract(lab, f"({normal})$", 1)).when(
        F.col("role") == "tumour", F.regexp_extract(lab, f"({tumour})$", 1)
    )
    return samples.withColumn("suffix", F.substring(ending, F.lit(2), F.length(ending))).withColumn(
        "patient", F.substring(lab, F.lit(1), F.length(lab) - F.length(ending))
    )


def samples_of(manifest: DataFrame) -> DataFrame:
    return derive_patient(classify_samples(manifest))


def normal_samples(samples: DataFrame) -> DataFrame:
    return samples.filter(F.col("role") == "normal")


def tumour_samples(samples: DataFrame) -> DataFrame:
    return samples.filter(F.col("role") == "tumour")


def pair_tumour_normal(samples: DataFrame) -> DataFrame:
    """Each tumour with each normal of its patient, once."""
    tumours = tumour_samples(samples).select("patient", F.col("lab_id").alias("tumour_id")).distinct()
    normals = normal_samples(samples).select("patient", F.col("lab_id").alias("normal_id")).distinct()
    return spread_join(tumours, normals, ["patient"]).select(
        F.concat_ws("_", "tumour_id", "normal_id").alias("pair"), "patient", "tumour_id", "normal_id"
    )


def unpaired_normals(samples: DataFrame) -> DataFrame:
    return spread_join(normal_samples(samples), tumour_samples(samples).select("patient").distinct(), ["patient"], "left_anti")


def unpaired_tumours(samples: DataFrame) -> DataFrame:
    return spread_join(tumour_samples(samples), normal_samples(samples).select("patient").distinct(), ["patient"], "left_anti")


def pair_counts(samples: DataFrame) -> DataFrame:
    """Samples and pairs per patient and, with patient NULL, for the cohort.

    Pairs are a product of counts, so no pair is built to be counted.
    ``patients_split`` is the number of patients with several normals, whose
    tumours are paired more than once.
    """
    per_patient = (
        samples.filter(F.col("patient").isNotNull())
        .groupBy("patient")
        .agg(
            F.count_if(F.col("role") == "normal").alias("normals"),
            F.count_if(F.col("role") == "tumour").alias("tumours"),
        )
        .withColumn("pairs", F.col("normals") * F.col("tumours"))
        .withColumn("several", F.when(F.col("normals") > 1, 1).otherwise(0))
    )
    return per_patient.rollup("patient").agg(
        F.sum("normals").alias("normals"),
        F.sum("tumours").alias("tumours"),
        F.sum("pairs").alias("pairs"),
        F.sum("several").alias("patients_split"),
    )


def concat_manifests(*manifests: DataFrame) -> DataFrame:
    """One manifest out of several, without header, comment or blank rows."""
    return active_rows(reduce(lambda a, b: a.unionByName(b), manifests))


def duplicate_samples(manifest: DataFrame) -> DataFrame:
    """LabSampleIDs listed more than once."""
    return manifest.groupBy("lab_id").agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def reuse_previous(samples: DataFrame, store: DataFrame) -> DataFrame:
    """Normals with ``gathered`` true when the store already holds their calls."""
    known = store.select("lab_id").distinct().withColumn("gathered", F.lit(True))
    return (
        normal_samples(samples)
        .join(known, "lab_id", "left")
        .withColumn("gathered", F.coalesce("gathered", F.lit(False)))
    )


def sample_map(samples: DataFrame, root: str, ending: str = ".parquet") -> DataFrame:
    """Where the gathered table of each normal lies."""
    return normal_samples(samples).select(
        "lab_id", F.concat(F.lit(root.rstrip("/") + "/"), F.col("lab_id"), F.lit(ending)).alias("location")
    )


def expected_grid(keys: DataFrame, present: DataFrame, intervals: DataFrame, key: str) -> DataFrame:
    """Gaps in what each key should have: runs of listed intervals that are not present.

    ``intervals`` numbers the scatter list (interval_id, interval_no from 0);
    ``present`` has a row or more per key and interval found. A gap is one row
    (first_no, last_no, n_missing), so the result grows with what is there,
    never with keys times intervals; a complete key has none. The numbers of a key are gathered as a set, which the width
    of the scatter list bounds and which is filled before rows are shuffled.
    """
    listed = intervals.agg(F.count("*").alias("n")).scalar()
    numbered = present.select(key, "interval_id").join(intervals.select("interval_id", "interval_no"), "interval_id")
    have = numbered.groupBy(key).agg(F.collect_set("interval_no").alias("_have"))
    marks = keys.select(key).distinct().join(have, key, "left")
    none = F.array().cast("array<bigint>")
    marks = marks.select(key, F.concat(F.array(F.lit(-1).cast("long")), F.sort_array(F.coalesce("_have", none)), F.array(listed)).alias("_have"))
    ahead = F.slice("_have", 2, F.size("_have") - 1)
    gap = lambda a, b: F.struct((a + 1).alias("first_no"), (b - 1).alias("last_no"), (b - a - 1).alias("n_missing"))
    gaps = F.filter(F.zip_with(F.slice("_have", 1, F.size("_have") - 1), ahead, gap), lambda g: g["n_missing"] > 0)
    return marks.select(key, F.explode(gaps).alias("_g")).select(key, "_g.*")
