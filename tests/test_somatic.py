import math

import pytest
from pyspark.sql import functions as F

from varspark.functions import evidence as ev
from varspark.operators import filtering, pileup, somatic
from varspark.plans.workflow import Workflow

E = 1e-3
COUNTS = "lab_id string, contig string, pos bigint, ref string, alt string, ref_count bigint, alt_count bigint, alt_f1r2 bigint, alt_f2r1 bigint"


def lik(r, a, f):
    return r * math.log10((1 - f) * (1 - E) + f * E / 3) + a * math.log10(f * (1 - E) + (1 - f) * E / 3)


def one(spark, df_values, schema, **columns):
    return spark.createDataFrame([df_values], schema).withColumns(columns).collect()[0]


@pytest.mark.parametrize("r,a", [(30, 10), (0, 40), (40, 0), (5000, 900), (0, 0)])
def test_lods_match_the_formula(spark, r, a):
    row = one(spark, (r, a), "r bigint, a bigint", t=ev.tumour_lod(F.col("r"), F.col("a")), n=ev.normal_lod(F.col("r"), F.col("a")))
    f = a / (r + a) if r + a else 0.0
    assert row.t == pytest.approx(lik(r, a, f) - lik(r, a, 0.0), abs=1e-9)
    assert row.n == pytest.approx(lik(r, a, 0.0) - lik(r, a, 0.5), abs=1e-9)


@pytest.mark.parametrize("r,a,nr,na,q,diploid", [(20, 20, 20, 20, 0.3, True), (40, 8, 30, 0, None, True), (0, 50, 0, 40, 0.9, True), (40000, 9000, 30000, 0, 0.0, True), (1, 60, 50, 0, 1.0, False)])
def test_germline_share_matches_the_formula(spark, r, a, nr, na, q, diploid):
    df = spark.createDataFrame([(r, a, nr, na, q)], "t_ref bigint, t_alt bigint, n_ref bigint, n_alt bigint, af double")
    got = somatic.germline_posterior(df, None if diploid else F.lit(False)).collect()[0].p_germline
    q = min(max(1e-6 if q is None else q, 1e-6), 1 - 1e-6)
    d = r + a
    het = math.log10(2 * q * (1 - q)) + d * math.log10(0.5) + lik(nr, na, 0.5)
    hom = 2 * math.log10(q) + lik(r, a, 1.0) + lik(nr, na, 1.0)
    som = math.log10(1e-3) + 2 * math.log10(1 - q) + lik(r, a, a / d) + lik(nr, na, 0.0)
    terms = [het, hom] if diploid else [hom]
    top = max(*terms, som)
    mass = [10 ** (x - top) for x in terms]
    assert got == pytest.approx(sum(mass) / (sum(mass) + 10 ** (som - top)), abs=1e-9)


@pytest.fixture
def world(spark):
    pairs = spark.createDataFrame([("T_N", "T", "N"), ("U_N", "U", "N")], "pair string, tumour_id string, normal_id string")
    counts = spark.createDataFrame(
        [
            ("T", "c", 1, "A", "C", 30, 12, 6, 6),
            ("T", "c", 1, "A", "G", 30, 12, 6, 6),
            ("T", "c", 2, "A", "C", 40, 2, 1, 1),
            ("T", "c", 3, "A", "C", 30, 30, 15, 15),
            ("T", "chrM", 4, "A", "C", 96, 5, 2, 3),
            ("T", "c", 5, "A", "C", 96, 5, 2, 3),
            ("U", "c", 1, "A", "C", 30, 12, 6, 6),
            ("N", "c", 1, "A", "C", 40, 0, 0, 0),
            ("N", "c", 3, "A", "C", 22, 20, 10, 10),
            ("N", "c", 9, "A", "C", 0, 40, 20, 20),
        ],
        COUNTS,
    )
    site = "contig string, pos bigint, ref string, alt string"
    pon = spark.createDataFrame([("c", 1, "A", "G")], site)
    germline = spark.createDataFrame([("c", 3, "A", "C", 0.4)], site + ", af double")
    return pairs, counts, pon, germline


def test_calls_of_every_pair(world):
    pairs, counts, pon, germline = world
    got = {(c.pair, c.contig, c.pos, c.alt): c for c in somatic.call_genome(counts, pairs, pon, germline).collect()}
    assert set(got) == {("T_N", "c", 1, "C"), ("T_N", "c", 1, "G"), ("T_N", "c", 3, "C"), ("U_N", "c", 1, "C"), ("T_N", "c", 5, "C"), ("T_N", "chrM", 4, "C")}
    assert got["T_N", "c", 1, "G"].in_pon and not got["T_N", "c", 1, "C"].in_pon
    assert (got["T_N", "c", 1, "G"].n_ref, got["T_N", "c", 1, "G"].n_alt, got["T_N", "c", 1, "G"].nlod) == (0, 0, 0.0)
    assert got["T_N", "c", 3, "C"].p_germline > 0.99 > 0.01 > got["T_N", "c", 1, "C"].p_germline


def test_mitochondria_have_their_own_threshold(spark, world):
    pairs, counts, pon, germline = world
    weak = spark.createDataFrame([("T", c, 4, "A", "C", 996, 6, 2, 4) for c in ("c", "chrM")], COUNTS)
    lod = lik(996, 6, 6 / 1002) - lik(996, 6, 0.0)
    assert 3.0 < lod < 6.3
    assert [c.contig for c in somatic.call_genome(weak, pairs, pon, germline).collect()] == ["chrM"]
    only = somatic.call_mitochondria(counts, pairs, pon, germline).collect()
    assert [(c.contig, c.pos) for c in only] == [("chrM", 4)]


def test_two_branches_equal_one_pass(spark, world):
    pairs, counts, pon, germline = world
    contigs = spark.createDataFrame([("c", 0, 1), ("chrM", 1, 1)], "contig string, idx bigint, length bigint")
    nuclear = somatic.call_pairs(counts.filter("contig <> 'chrM'"), pairs, pon, germline)
    merged = somatic.merge_branches(contigs, nuclear, somatic.call_mitochondria(counts, pairs, pon, germline))
    once = somatic.call_genome(counts, pairs, pon, germline)
    pick = lambda df: sorted((c.pair, c.contig, c.pos, c.alt, round(c.p_germline, 9)) for c in df.collect())
    assert pick(merged) == pick(once)
    order = [(x.idx, x.pos) for x in merged.collect()]
    assert order == sorted(order)


def test_stats_add_up(spark, rows):
    stats = spark.createDataFrame([("a", "0", "callable", 1.0), ("a", "1", "callable", 2.0), ("b", "0", "callable", 5.0)], "pair string, interval_id string, statistic string, value double")
    assert rows(somatic.merge_stats(stats)) == [("a", "callable", 3.0), ("b", "callable", 5.0)]


SCORED = "pair string, contig string, pos bigint, ref string, alt string, p_error double"


def test_threshold_maximises_expected_f(spark):
    ps = [0.001, 0.02, 0.02, 0.3, 0.45, 0.6, 0.8, 0.95, 0.999, 1.0]
    df = spark.createDataFrame([("p", "c", i, "A", "C", p) for i, p in enumerate(ps)], SCORED)
    got = filtering.learn_threshold(df).collect()[0]

    def score(t):
        kept = [p for p in ps if p <= t]
        tp, fp = sum(1 - p for p in kept), sum(kept)
        fn = sum(1 - p for p in ps) - tp
        return tp / (tp + (fp + fn) / 2)

    best = max(map(score, ps))
    assert got.f_score == pytest.approx(best, abs=1e-9)
    assert score(got.threshold) == pytest.approx(best, abs=1e-9)


def judged(spark, values):
    base = {"pair": "p", "contig": "c", "ref": "A", "alt": "C", "tlod": 20.0, "nlod": 9.0, "n_alt": 0, "in_pon": False}
    base |= {"p_germline": 0.0, "p_contamination": 0.0, "p_orientation": 0.0, "p_error": 0.0}
    full = [base | v for v in values]
    schema = "pair string, contig string, pos bigint, ref string, alt string, tlod double, nlod double, n_alt bigint, in_pon boolean, p_germline double, p_contamination double, p_orientation double, p_error double"
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(v[n] for n in names) for v in full], schema)
    limits = spark.createDataFrame([("p", 0.5)], "pair string, threshold double")
    return {(c.pos, c.alt): list(c.filters) for c in filtering.apply_filters(df, limits).collect()}


def test_every_filter_fires_for_its_reason(spark):
    got = judged(
        spark,
        [
            {"pos": 1000},
            {"pos": 2000, "in_pon": True},
            {"pos": 3000, "p_germline": 0.6, "p_error": 0.6},
            {"pos": 4000, "p_contamination": 0.6, "p_error": 0.6},
            {"pos": 5000, "p_orientation": 0.6, "p_error": 0.6},
            {"pos": 6000, "tlod": 6.0},
            {"pos": 7000, "nlod": 0.0},
            {"pos": 8000, "nlod": 1.0, "n_alt": 2},
            {"pos": 8500, "p_error": 0.5},
            {"pos": 9000, "p_error": 0.5 + 1e-9},
            {"pos": 9900},
            {"pos": 9900, "alt": "G"},
        ],
    )
    assert got == {
        (1000, "C"): [],
        (2000, "C"): ["panel_of_normals"],
        (3000, "C"): ["germline"],
        (4000, "C"): ["contamination"],
        (5000, "C"): ["orientation"],
        (6000, "C"): ["weak_evidence"],
        (7000, "C"): ["weak_evidence"],
        (8000, "C"): ["normal_artifact"],
        (8500, "C"): [],
        (9000, "C"): ["weak_evidence"],
        (9900, "C"): ["multiallelic"],
        (9900, "G"): ["multiallelic"],
    }


def test_clusters_reach_over_bin_edges(spark):
    got = judged(spark, [{"pos": p} for p in (9_950, 9_999, 10_000, 10_100, 10_201, 30_000, 30_100)])
    near = {p for (p, _), names in got.items() if "clustered_events" in names}
    positions = sorted(p for p, _ in got)
    assert near == {p for p in positions if sum(abs(p - q) <= 100 for q in positions) > 2}


def test_summary_totals(spark):
    df = spark.createDataFrame([("p", []), ("p", ["germline", "orientation"]), ("q", ["germline"])], "pair string, filters array<string>")
    got = {(r.pair, r.filter): r.n_calls for r in filtering.filter_summary(df).collect()}
    assert got == {("p", "PASS"): 1, ("p", "germline"): 1, ("p", "orientation"): 1, ("q", "germline"): 1, ("p", None): 3, ("q", None): 1, (None, None): 4}


def test_thresholds_tell_small_probabilities_apart(spark):
    df = spark.createDataFrame([("p", "c", i, "A", "C", p) for i, p in enumerate([1e-7, 2e-6, 0.9])], SCORED)
    assert filtering.learn_threshold(df).collect()[0].threshold == pytest.approx(2e-6)


def reads_of(sample, n, base, start=1, flag=0):
    """Reads of 60 bases over the whole stretch, all A but for one base at position 30."""
    seq = "A" * 29 + base + "A" * 30
    return [(sample, f"{sample}{base}{i}", flag | (64 if i % 2 else 128), "chr1", start, 60, "60M", seq, "I" * 60) for i in range(n)]


READS = "lab_id string, read_id string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string"


def test_reads_to_a_passing_call(spark):
    """A clean normal shows no allele, yet its depth counts for the call."""
    reads = spark.createDataFrame(reads_of("P1-T1", 28, "A") + reads_of("P1-T1", 12, "C") + reads_of("P1-N", 40, "A"), READS)
    reference = spark.createDataFrame([("chr1", p, "A") for p in range(1, 61)], "contig string, pos bigint, base string")
    counts = pileup.allele_counts(reads, reference)
    pairs = spark.createDataFrame([("P1-T1_P1-N", "P1", "P1-T1", "P1-N")], "pair string, patient string, tumour_id string, normal_id string")
    none = spark.createDataFrame([], "contig string, pos bigint, ref string, alt string, af double")
    call = somatic.call_genome(counts, pairs, none.drop("af"), none, reads=reads).collect()
    assert [(c.pos, c.t_ref, c.t_alt, c.n_ref, c.n_alt) for c in call] == [(30, 28, 12, 40, 0)] and call[0].nlod > 2.2
    bare = somatic.call_genome(counts, pairs, none.drop("af"), none).collect()[0]
    assert (bare.n_ref, bare.nlod) == (0, 0)
    got = judged(spark, [{"pos": 30, "tlod": call[0].tlod, "nlod": call[0].nlod}])
    assert list(got.values()) == [[]]


def test_callable_positions_from_reads(spark):
    reads = spark.createDataFrame(reads_of("T", 28, "A") + reads_of("T", 12, "C") + reads_of("N", 40, "A") + reads_of("N", 9, "A", start=200) + reads_of("X", 20, "A", flag=1024), READS)
    intervals = spark.createDataFrame([("0", "chr1", 1, 30), ("1", "chr1", 31, 100), ("2", "chr1", 101, 9000)], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    got = {(r.lab_id, r.interval_id): r.callable for r in pileup.callable_from_reads(reads, intervals).collect()}
    assert got == {("T", "0"): 30, ("T", "1"): 30, ("N", "0"): 30, ("N", "1"): 30}
    assert {r.lab_id: r.callable for r in pileup.callable_from_reads(reads, intervals.filter("interval_id = '2'"), min_depth=9).collect()} == {"N": 60}


def test_mitochondrial_calls_keep_their_rules(spark):
    """A chrM call that calling admits is not failed by the nuclear limit."""

    schema = "pair string, contig string, pos bigint, ref string, alt string, tlod double, nlod double, n_alt bigint, in_pon boolean, p_germline double, p_contamination double, p_orientation double, p_error double"
    calls = spark.createDataFrame([("p", c, 5, "A", "C", 5.07, 271.0, 0, False, 0.0, 0.0, 0.0, 0.1) for c in ("chrM", "chr1")], schema)
    limits = spark.createDataFrame([("p", 0.5)], "pair string, threshold double")
    least = F.when(F.col("contig") != "chrM", 6.3).otherwise(3.0)
    assert {c.contig: list(c.filters) for c in filtering.apply_filters(calls, limits, min_tumour_lod=least).collect()} == {"chrM": [], "chr1": ["weak_evidence"]}


class HandWritten:
    """A cohort of one pair whose counts are the library's own, of contigs chr1 and chrM."""

    def __init__(self, spark):
        self.spark = spark

    def manifest(self):
        return self.spark.createDataFrame([("S1", "P1-T1", "C", "1"), ("S2", "P1-N", "C", "1")], "sample_id string, lab_id string, seq_centre string, library string")

    def reads(self):
        rows = reads_of("P1-T1", 28, "A") + reads_of("P1-T1", 12, "C") + reads_of("P1-N", 40, "A")
        return self.spark.createDataFrame(rows + [(*r[:2], r[2], "chrM", *r[4:]) for r in rows], READS)

    def counts(self):
        reference = [(c, p, "A") for c in ("chr1", "chrM") for p in range(1, 61)]
        return pileup.allele_counts(self.reads(), self.spark.createDataFrame(reference, "contig string, pos bigint, base string"))

    def germline(self):
        return self.spark.createDataFrame([], "contig string, pos bigint, ref string, alt string, af double")

    def pileups(self):
        return self.spark.createDataFrame([], "lab_id string, contig string, pos bigint, ref string, alt string, ref_count bigint, alt_count bigint, other_alt_count bigint, af double")

    def intervals(self):
        return self.spark.createDataFrame([("0", "chr1", 1, 50), ("1", "chr1", 51, 1000)], "interval_id string, contig string, start_pos bigint, end_pos bigint")

    def contexts(self):
        return None


@pytest.mark.parametrize("keep", [False, True])
def test_workflow_from_reads_to_filters(spark, keep):
    cohort = Workflow(HandWritten(spark), keep=keep, iterations=2)
    assert [(s.statistic, s.value) for s in cohort.stats.collect()] == [("callable", 120.0)]
    got = {(c.contig, c.pos): c for c in cohort.filtered.collect()}
    assert set(got) == {("chr1", 30), ("chrM", 30)}
    for c in got.values():
        assert (c.t_ref, c.t_alt, c.n_ref, c.n_alt) == (28, 12, 40, 0) and c.nlod > 2.2 and list(c.filters) == []
    cohort.close()


def test_stages_of_a_workflow_leave_no_shuffle_files(spark):
    """A stage that is written needs its shuffles no more; they do not wait for the driver's garbage collection."""
    import time

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    cohort = Workflow(HandWritten(spark), iterations=2).prepare()
    thresholds = cohort.thresholds
    until = time.time() + 10
    while blocks.getAllFiles().size() > before and time.time() < until:
        time.sleep(0.1)
    assert blocks.getAllFiles().size() <= before
    assert thresholds.count() == 1
    cohort.close()


def test_neighbours_are_counted_with_one_shuffle(spark):
    calls = spark.createDataFrame([("p", "c", p, "A", alt) for p, alt in ((9_950, "C"), (10_020, "C"), (10_020, "G"), (10_300, "T"))], "pair string, contig string, pos bigint, ref string, alt string")
    found = filtering._neighbours(calls, 100)
    assert sorted((r.pos, r.alt, r.n_near, r.n_alleles) for r in found.collect()) == [(9_950, "C", 2, 1), (10_020, "C", 2, 2), (10_020, "G", 2, 2), (10_300, "T", 1, 1)]
    assert found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
