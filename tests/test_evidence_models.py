import math
import random

import pytest

from varspark.operators import contamination as cont
from varspark.operators import orientation as ori

HIST = "pair string, context string, alt_base string, depth bigint, alt_count bigint, f1r2 bigint, n bigint"


@pytest.fixture
def hist(spark):
    rng = random.Random(11)
    data = []
    for context, skewed in (("ACA", 0.0), ("ACG", 0.5), ("CCC", 1.0)):
        for _ in range(60):
            n = rng.randint(1, 12)
            share = 0.95 if rng.random() < skewed else 0.5
            data.append(("p", context, "T", 30, n, sum(rng.random() < share for _ in range(n)), 1))
    return spark.createDataFrame(data, HIST)


def priors(model):
    out = {}
    for r in model.collect():
        out.setdefault((r.context, r.alt_base), {})[r.state] = r.prior
    return out


def likelihood(rows, prior):
    total = 0.0
    for r in rows:
        p = prior[r.context, r.alt_base]
        total += r.n * math.log(sum(p[s] * x**r.f1r2 * (1 - x) ** (r.alt_count - r.f1r2) for s, (x, _) in ori.STATES.items()))
    return total


def test_em_priors_are_distributions_and_likelihood_rises(hist):
    rows = hist.collect()
    last = None
    for rounds in (1, 2, 3, 5):
        now = priors(ori.learn_orientation(hist, rounds))
        assert all(sum(p.values()) == pytest.approx(1.0) for p in now.values())
        score = likelihood(rows, now)
        assert last is None or score >= last - 1e-9
        last = score
    assert now["ACA", "T"]["balanced"] > 0.9
    assert now["CCC", "T"]["art_f1r2"] > 0.6


def plain_rounds(cells, rounds):
    """Priors of one group by the definition, round by round."""
    prior = {s: p for s, (_, p) in ori.STATES.items()}
    for _ in range(rounds):
        sums = dict.fromkeys(prior, 0.0)
        for alt, forward, n in cells:
            logs = {s: math.log(max(prior[s], 1e-12)) + forward * math.log(x) + (alt - forward) * math.log(1 - x) for s, (x, _) in ori.STATES.items()}
            top = max(logs.values())
            whole = sum(math.exp(v - top) for v in logs.values())
            for s, v in logs.items():
                sums[s] += n * math.exp(v - top) / whole
        prior = {s: x / sum(n for *_, n in cells) for s, x in sums.items()}
    return prior


def test_folded_rounds_equal_plain_ones(spark, hist):
    deep = spark.createDataFrame([("p", "GGG", "A", 9000, n, f, m) for n, f, m in ((4000, 3990, 2), (3000, 1500, 3), (2500, 10, 1))], HIST)
    for rounds in (1, 6, 40):
        got = priors(ori.learn_orientation(hist.unionByName(deep), rounds))
        for context in ("ACA", "ACG", "CCC", "GGG"):
            cells = [(r.alt_count, r.f1r2, r.n) for r in hist.unionByName(deep).filter(f"context = '{context}'").collect()]
            assert list(got.values()) and got[context, "A" if context == "GGG" else "T"] == pytest.approx(plain_rounds(cells, rounds), abs=1e-9)


def test_a_group_at_rest_is_left_alone(hist):
    at_rest, more = [priors(ori.learn_orientation(hist, n, tolerance=0.01)) for n in (50, 100)]
    assert at_rest == more


def test_the_model_is_one_fold(hist):
    plan = ori.learn_orientation(hist, 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "Join" not in plan


def test_strands_fold_together(spark, rows):
    df = spark.createDataFrame(
        [("c", 1, "C", "T", 5, 2), ("c", 2, "G", "A", 2, 5), ("c", 3, "CA", "C", 1, 1)],
        "contig string, pos bigint, ref string, alt string, a bigint, b bigint",
    )
    around = spark.createDataFrame([("c", 1, "ACG"), ("c", 2, "CGT"), ("c", 3, "ACG")], "contig string, pos bigint, context string")
    got = rows(ori.fold_context(df, around, "a", "b"), "pos", "context", "alt_base", "f1r2")
    assert got == [(1, "ACG", "T", 5), (2, "ACG", "T", 5), (3, None, None, None)]


def test_context_of_three_bases(spark, rows):
    bases = spark.createDataFrame([("c", i + 1, b) for i, b in enumerate("ACGT")], "contig string, pos bigint, base string")
    loci = spark.createDataFrame([("c", p) for p in (1, 2, 2, 3, 4)], "contig string, pos bigint")
    assert rows(ori.kmer_context(loci, bases), "pos", "context") == [(2, "ACG"), (3, "CGT")]


def test_one_sided_reads_look_like_an_artefact(spark):
    model = spark.createDataFrame([("p", "C", "T", s, x) for s, (_, x) in ori.STATES.items()], "pair string, context string, alt_base string, state string, prior double")
    calls = spark.createDataFrame(
        [("p", "c", 1, "C", "T", 12, 12, 0), ("p", "c", 2, "C", "T", 12, 6, 6), ("p", "c", 3, "A", "T", 12, 12, 0), ("p", "c", 4, "CA", "C", 12, 12, 0), ("p", "c", 5, "G", "A", 12, 0, 12)],
        "pair string, contig string, pos bigint, ref string, alt string, t_alt bigint, t_f1r2 bigint, t_f2r1 bigint",
    )
    got = {r.pos: r.p_orientation for r in ori.orientation_posterior(calls, model).collect()}
    assert got[1] > 0.95 and got[2] < 0.01 and got[3] == 0.0 and got[4] == 0.0
    assert got[5] == pytest.approx(got[1])


PILE = "lab_id string, contig string, pos bigint, ref_count bigint, alt_count bigint, af double"
PAIRS = "pair string, tumour_id string, normal_id string"


def test_contamination_of_known_counts(spark):
    pairs = spark.createDataFrame([("a", "T", "N"), ("b", "T2", "N2")], PAIRS)
    piles = spark.createDataFrame(
        [("N", "c", 1, 0, 40, 0.2), ("N", "c", 2, 4, 36, 0.5), ("N", "c", 3, 5, 36, 0.5), ("T", "c", 1, 5, 95, 0.2), ("T", "c", 2, 1, 49, 0.5), ("T", "c", 3, 30, 10, 0.5), ("N2", "c", 1, 20, 20, 0.2), ("T2", "c", 1, 20, 20, 0.2)],
        PILE,
    )
    got = {r.pair: r for r in cont.contamination(pairs, piles).collect()}
    expected = 100 * 0.8 + 50 * 0.5
    assert got["a"].contamination == pytest.approx(6 / expected)
    assert got["a"].error == pytest.approx(math.sqrt(6 / expected / expected))
    assert got["a"].n_sites == 2
    assert (got["b"].n_sites, got["b"].contamination, got["b"].error) == (0, None, None)


def test_contamination_with_frequency_one_is_finite(spark):
    pairs = spark.createDataFrame([("a", "T", "N")], PAIRS)
    piles = spark.createDataFrame([("N", "c", 1, 0, 40, 1.0), ("T", "c", 1, 5, 95, 1.0)], PILE)
    assert cont.contamination(pairs, piles).collect()[0].contamination == 1.0


def test_segments_break_at_jumps_and_contigs(spark, rows):
    pairs = spark.createDataFrame([("a", "T", "N")], PAIRS)
    data = []
    for i in range(12):
        for contig in ("c1", "c2"):
            data.append(("N", contig, i * 10 + 1, 10, 10, 0.3))
            low = contig == "c1" and i >= 6
            data.append(("T", contig, i * 10 + 1, 5 if low else 10, 15 if low else 10, 0.3))
    got = rows(cont.maf_segments(pairs, spark.createDataFrame(data, PILE), run=3), "contig", "segment", "start_pos", "end_pos", "n_sites", "maf")
    assert got == [("c1", 0, 1, 51, 6, 0.5), ("c1", 1, 61, 111, 6, 0.25), ("c2", 0, 1, 111, 12, 0.5)]


def test_single_het_site_is_one_segment(spark):
    pairs = spark.createDataFrame([("a", "T", "N")], PAIRS)
    piles = spark.createDataFrame([("N", "c", 1, 10, 10, 0.2), ("T", "c", 1, 10, 30, 0.2)], PILE)
    got = cont.maf_segments(pairs, piles).collect()
    assert [(r.start_pos, r.end_pos, r.n_sites, r.maf) for r in got] == [(1, 1, 1, 0.25)]


def test_change_point_inside_a_run_is_found_at_its_site(spark, rows):
    pairs = spark.createDataFrame([("a", "T", "N")], PAIRS)
    data = []
    for i in range(60):
        data.append(("N", "c", i * 10 + 1, 20, 20, 0.3))
        data.append(("T", "c", i * 10 + 1, *((10, 30) if i >= 27 else (20 + i % 2, 20 - i % 2)), 0.3))
    for block in (1 << 20, 150):
        got = rows(cont.maf_changepoints(pairs, spark.createDataFrame(data, PILE), block=block), "contig", "segment", "start_pos", "end_pos", "n_sites")
        assert got == [("c", 0, 1, 261, 27), ("c", 1, 271, 591, 33)]
    assert cont.maf_changepoints(pairs, spark.createDataFrame([], PILE)).count() == 0


def test_cuts_are_those_of_least_cost():
    import itertools
    import random

    import numpy as np

    rng = random.Random(7)
    for _ in range(40):
        x = [rng.choice([3, 5]) * 10 + rng.randint(-4, 4) for _ in range(rng.randint(1, 10))]
        penalty = rng.choice([1.0, 30.0, 200.0])

        def cost(cuts):
            parts = [np.array(x[a:b], dtype=float) for a, b in zip(cuts, [*cuts[1:], len(x)], strict=True)]
            return sum(((p - p.mean()) ** 2).sum() + penalty for p in parts)

        every = [[0, *c] for k in range(len(x)) for c in itertools.combinations(range(1, len(x)), k)]
        got = cont.best_cuts(np.ones(len(x)), np.array(x), np.array(x) ** 2, penalty)
        assert abs(cost(got) - min(map(cost, every))) < 1e-9
