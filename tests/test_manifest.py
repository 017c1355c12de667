import pytest

from varspark.operators import manifest as m
from varspark.schemas import MANIFEST

LISTED = [
    ("S1", "P1-N", "C", 1),
    ("S2", "P1-T1", "C", 1),
    ("S3", "P1-M2", "C", 1),
    ("#S4", "P2-N", "C", 1),
    ("S5", "P2-T1", "C", 1),
    ("S6", "P3-B1", "C", 1),
    ("S7", "P4-N10", "C", 1),
    ("S8", "P5-TB", "C", 1),
    ("S9", "P5-NB", "C", 1),
    ("", "P6-N", "C", 1),
    ("S10", "P7-N", "C", 1),
    ("S11", "P7-B2", "C", 1),
    ("S12", "P7-P1", "C", 1),
]


@pytest.fixture
def samples(spark):
    return m.samples_of(spark.createDataFrame(LISTED, MANIFEST))


def test_roles_and_patients(samples, rows):
    assert rows(samples, "lab_id", "role", "patient", "suffix") == [
        ("P1-M2", "tumour", "P1", "M2"),
        ("P1-N", "normal", "P1", "N"),
        ("P1-T1", "tumour", "P1", "T1"),
        ("P2-T1", "tumour", "P2", "T1"),
        ("P3-B1", "normal", "P3", "B1"),
        ("P4-N10", "unknown", None, None),
        ("P5-NB", "normal", "P5", "NB"),
        ("P5-TB", "tumour", "P5", "TB"),
        ("P7-B2", "normal", "P7", "B2"),
        ("P7-N", "normal", "P7", "N"),
        ("P7-P1", "tumour", "P7", "P1"),
    ]


def test_pairs_list_each_tumour_with_each_normal_once(samples, rows):
    assert rows(m.pair_tumour_normal(samples), "pair") == [
        ("P1-M2_P1-N",),
        ("P1-T1_P1-N",),
        ("P5-TB_P5-NB",),
        ("P7-P1_P7-B2",),
        ("P7-P1_P7-N",),
    ]
    assert rows(m.unpaired_normals(samples), "lab_id") == [("P3-B1",)]
    assert rows(m.unpaired_tumours(samples), "lab_id") == [("P2-T1",)]


def test_pair_counts_agree_with_the_pairs(samples):
    total = m.pair_counts(samples).filter("patient is null").collect()[0]
    assert (total.normals, total.tumours, total.pairs, total.patients_split) == (5, 5, 5, 1)


def test_concatenation_reports_duplicates(spark, rows):
    one = spark.createDataFrame(LISTED, MANIFEST)
    two = spark.createDataFrame([("S20", "P1-N", "D", 1), ("S21", "P8-N", "D", 2)], MANIFEST)
    both = m.concat_manifests(one, two)
    assert both.count() == 13
    assert rows(m.duplicate_samples(both)) == [("P1-N", 2)]


def test_reuse_and_map(spark, samples, rows):
    store = spark.createDataFrame([("P1-N", 1), ("P1-N", 2), ("gone", 1)], "lab_id string, pos int")
    assert rows(m.reuse_previous(samples, store).filter("gathered"), "lab_id") == [("P1-N",)]
    assert rows(m.sample_map(samples, "root/"))[0] == ("P1-N", "root/P1-N.parquet")


def test_gaps_of_each_key(spark, rows):
    intervals = spark.createDataFrame([(f"i{n}", n) for n in range(6)], "interval_id string, interval_no bigint")
    keys = spark.createDataFrame([("full",), ("none",), ("some",), ("some",)], "pair string")
    present = [("full", f"i{n}") for n in range(6)] + [("some", "i1"), ("some", "i1"), ("some", "i4"), ("some", "unlisted"), ("other", "i0")]
    got = m.expected_grid(keys, spark.createDataFrame(present, "pair string, interval_id string"), intervals, "pair")
    assert rows(got) == [("none", 0, 5, 6), ("some", 0, 0, 1), ("some", 2, 3, 2), ("some", 5, 5, 1)]


def test_empty_manifest(spark):
    samples = m.samples_of(spark.createDataFrame([], MANIFEST))
    assert m.pair_tumour_normal(samples).count() == 0
    assert m.unpaired_tumours(samples).count() == 0
