import statistics

import pytest
from pyspark.sql import functions as F

from varspark.operators import pon, sites

VARIANT = "contig string, pos bigint, ref string, alts array<string>, afs array<double>"


@pytest.fixture
def resource(spark):
    return spark.createDataFrame(
        [
            ("c", 1, "A", ["C"], [0.05]),
            ("c", 2, "A", ["C"], [0.06]),
            ("c", 3, "A", ["C", "G"], [0.3, 0.2]),
            ("c", 4, "AT", ["A"], [0.5]),
            ("c", 5, "A", ["AT"], [0.5]),
            ("c", 6, "A", ["T"], [None]),
            ("c", 7, "A", ["T"], [1.0]),
        ],
        VARIANT,
    )


def test_common_biallelic_is_strict(resource, rows):
    assert rows(sites.select_common_biallelic(resource), "pos") == [(2,), (7,)]


def test_alleles_keep_their_own_af(resource, rows):
    assert [x for x in rows(sites.explode_alleles(resource), "pos", "alt", "af") if x[0] == 3] == [(3, "C", 0.3), (3, "G", 0.2)]


def test_variant_types(spark):
    pairs = {("A", "C"): "SNP", ("AC", "GT"): "MNP", ("A", "AT"): "INS", ("AT", "A"): "DEL", ("AT", "GCC"): "MIXED", ("ATG", "CT"): "MIXED"}
    df = spark.createDataFrame(list(pairs), "ref string, alt string")
    assert {(x.ref, x.alt): x.variant_type for x in sites.classify_variant(df).collect()} == pairs


def test_missing_or_null_frequency_gets_the_default(spark, resource, rows):
    calls = spark.createDataFrame([("s", "c", 3, "A", "G"), ("s", "c", 6, "A", "T"), ("s", "c", 99, "A", "T")], "lab_id string, contig string, pos bigint, ref string, alt string")
    got = rows(sites.annotate_germline(calls, sites.explode_alleles(resource)), "pos", "af")
    assert got == [(3, 0.2), (6, 1e-6), (99, 1e-6)]


def test_sorted_by_dictionary_not_by_name(spark):
    contigs = spark.createDataFrame([("chr2", 0, 1), ("chr10", 1, 1), ("chrM", 2, 1)], "contig string, idx bigint, length bigint")
    df = spark.createDataFrame([(c, p, "A", "T") for c in ("chrM", "chr10", "chr2") for p in (30, 4)], "contig string, pos bigint, ref string, alt string")
    got = [(x.contig, x.pos) for x in sites.sort_sites(df, contigs).collect()]
    assert got == [(c, p) for c in ("chr2", "chr10", "chrM") for p in (4, 30)]


def test_mnps_become_their_changed_bases(spark, rows):
    df = spark.createDataFrame([("c", 10, "ACG", "ATT"), ("c", 20, "A", "AT"), ("c", 30, "A", "T")], "contig string, pos bigint, ref string, alt string")
    assert rows(pon.split_mnps(df), "pos", "ref", "alt") == [(11, "C", "T"), (12, "G", "T"), (20, "A", "AT"), (30, "A", "T")]


CALLS = "lab_id string, contig string, pos bigint, ref string, alt string, ref_count bigint, alt_count bigint"


def evidence(spark, n_samples):
    data = []
    for s in range(n_samples):
        for pos in range(1, 30):
            if (s * 7 + pos * 3) % 4:
                data.append((f"P{s}-N", "c", pos, "A", "C", 20 + s, 3 + (pos + s) % 5))
    return spark.createDataFrame(data, CALLS)


@pytest.fixture
def cohort(spark):
    normals = spark.createDataFrame([(f"P{i}-N",) for i in range(9)], "lab_id string")
    return pon.normal_candidates(evidence(spark, 9), normals, min_lod=0.0), normals


def test_candidates_come_from_normals_only(spark, rows):
    data = [("P1-N", "c", 1, "A", "C", 20, 5), ("P1-T", "c", 1, "A", "C", 20, 5), ("P1-N", "c", 2, "A", "C", 20, 1), ("P1-N", "c", 3, "A", "C", 5, 4)]
    normals = spark.createDataFrame([("P1-N",), ("P1-N",)], "lab_id string")
    assert rows(pon.normal_candidates(spark.createDataFrame(data, CALLS), normals), "lab_id", "pos") == [("P1-N", 1)]


def test_panel_moments(cohort):
    calls, normals = cohort
    by_site = {}
    for c in calls.collect():
        by_site.setdefault(c.pos, []).append(c.fraction)
    for row in pon.create_pon(calls, normals).collect():
        seen = by_site[row.pos]
        assert row.n_seen == len(seen) >= 2
        assert row.share_of_normals == pytest.approx(len(seen) / 9)
        assert row.mean_fraction == pytest.approx(statistics.fmean(seen))
        assert row.var_fraction == pytest.approx(statistics.pvariance(seen), abs=1e-12)
        if row.beta_alpha is not None:
            a, b = row.beta_alpha, row.beta_beta
            assert a / (a + b) == pytest.approx(row.mean_fraction)
            assert a * b / ((a + b) ** 2 * (a + b + 1)) == pytest.approx(row.var_fraction, rel=1e-6)


def test_extending_equals_rebuilding(spark, cohort, tmp_path):
    calls, normals = cohort
    germline = spark.createDataFrame([("c", p, "A", "C", 0.3) for p in range(1, 30, 3)], "contig string, pos bigint, ref string, alt string, af double")
    for resource in (None, germline):
        whole = {x.pos: x for x in pon.create_pon(calls, normals, resource).collect()}
        old = F.col("lab_id") < "P5"
        store = str(tmp_path / str(resource is None))
        pon.write_panel_store(calls.filter(old), normals.filter(old), store, resource)
        # Samples that the register knows are offered again and change nothing.
        grown = {x.pos: x for x in pon.extend_pon(store, calls, normals, resource).collect()}
        assert whole.keys() == grown.keys() and whole
        for pos, row in whole.items():
            assert grown[pos].n_seen == row.n_seen and grown[pos].share_of_normals == row.share_of_normals
            assert grown[pos].var_fraction == pytest.approx(row.var_fraction, abs=1e-12)


def test_two_extensions_in_a_row_equal_rebuilding(spark, cohort, tmp_path):
    """Each cohort is offered alone, with a stricter limit than the usual one."""
    calls, normals = cohort
    germline = spark.createDataFrame([("c", p, "A", "C", 0.3) for p in range(1, 30, 3)], "contig string, pos bigint, ref string, alt string, af double")
    for resource, limit in ((None, 0.5), (germline, 1e-6)):
        whole = {x.pos: x for x in pon.create_pon(calls, normals, resource, max_p_germline=limit).collect()}
        store = str(tmp_path / str(resource is None))
        batch = lambda df, low, high: df.filter(F.col("lab_id").between(f"P{low}-N", f"P{high}-N"))
        pon.write_panel_store(batch(calls, 0, 3), batch(normals, 0, 3), store, resource, max_p_germline=limit)
        for low, high in ((4, 5), (6, 8)):
            grown = {x.pos: x for x in pon.extend_pon(store, batch(calls, low, high), batch(normals, low, high), resource, max_p_germline=limit).collect()}
        assert whole.keys() == grown.keys() and whole
        for pos, row in whole.items():
            assert (grown[pos].n_seen, grown[pos].share_of_normals) == (row.n_seen, row.share_of_normals)
            assert grown[pos].mean_fraction == pytest.approx(row.mean_fraction)
            assert grown[pos].var_fraction == pytest.approx(row.var_fraction, abs=1e-12)


def test_germline_alleles_do_not_enter_the_panel(spark):
    normals = spark.createDataFrame([("P1-N",), ("P2-N",)], "lab_id string")
    data = [(s, "c", pos, "A", "C", r, a) for s in ("P1-N", "P2-N") for pos, r, a in ((1, 20, 20), (2, 38, 4))]
    calls = pon.normal_candidates(spark.createDataFrame(data, CALLS), normals)
    germline = spark.createDataFrame([("c", p, "A", "C", 0.4) for p in (1, 2)], "contig string, pos bigint, ref string, alt string, af double")
    assert [x.pos for x in pon.create_pon(calls, normals, germline).collect()] == [2]
    assert sorted(x.pos for x in pon.create_pon(calls, normals).collect()) == [1, 2]


def test_empty_panel(spark):
    normals = spark.createDataFrame([], "lab_id string")
    calls = pon.normal_candidates(spark.createDataFrame([], CALLS), normals)
    assert pon.create_pon(calls, normals).count() == 0


def test_gathered_parts_are_whole_and_ordered(cohort):
    calls, _ = cohort
    parts = [calls.filter(f"pos % 3 = {i}").drop("lod") for i in range(3)]
    whole = pon.gather_calls(*parts)
    assert whole.count() == calls.count()
    runs = whole.rdd.mapPartitions(lambda it: [[(r.lab_id, r.contig, r.pos, r.ref, r.alt) for r in it]]).collect()
    assert all(run == sorted(run) for run in runs)
    ends = [(run[0], run[-1]) for run in runs if run]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_matrix_and_store(spark, cohort, tmp_path, rows):
    calls, _ = cohort
    intervals = spark.createDataFrame([("0000", "c", 1, 15), ("0001", "c", 16, 40)], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    store = pon.consolidate_cohort(calls, intervals, str(tmp_path / "store"))
    assert store.count() == calls.count()
    pruned = store.filter("interval_id = '0001'")
    assert "PartitionFilters: [isnotnull(interval_id" in pruned._jdf.queryExecution().executedPlan().toString()
    assert {x.pos for x in pruned.collect()} <= set(range(16, 41))
    wide = pon.cohort_matrix(calls, ["P0-N", "P1-N"])
    assert wide.columns == ["contig", "pos", "ref", "alt", "P0-N", "P1-N"]
