import random
import re

import pytest

from varspark.operators import pileup as p
from varspark.schemas import READS


def read(spark, *items):
    full = [("s", f"r{i}", flag, "c", pos, mapq, cigar, seq, "I" * len(seq)) for i, (flag, pos, mapq, cigar, seq) in enumerate(items)]
    return spark.createDataFrame(full, READS)


def walk(pos, cigar, seq):
    """Blocks by hand: (reference start, read start from 1, bases)."""
    at, off, out = pos, 0, []
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "M=X":
            out.append((at, at + n - 1, off + 1, seq[off : off + n]))
        if op in "M=XDN":
            at += n
        if op in "M=XIS":
            off += n
    return out


@pytest.mark.parametrize(
    "cigar,n",
    [("32M", 32), ("4S28M", 32), ("10M2I20M", 32), ("12M3D20M", 32), ("5M100N27M", 32), ("4H28M", 28), ("10=2X20=", 32), ("3M2P3M", 6), ("8S", 8)],
)
def test_blocks_follow_the_cigar(spark, cigar, n):
    seq = "".join(random.Random(cigar).choice("ACGT") for _ in range(n))
    got = p.cigar_blocks(read(spark, (0, 50, 60, cigar, seq))).collect()
    assert sorted((b.start_pos, b.end_pos, b.read_offset, b.bases) for b in got) == walk(50, cigar, seq)


def test_unusable_reads_are_dropped(spark):
    flags = [0, 4, 16, 256, 512, 1024, 2048, 99]
    reads = read(spark, *[(f, 1, 60, "4M", "ACGT") for f in flags], (0, 1, 19, "4M", "ACGT"), (0, 1, 20, "4M", "ACGT"))
    assert sorted(x.flag for x in p.usable_reads(reads).collect()) == [0, 0, 16, 99]


def test_pileup_at_block_and_bin_edges(spark, rows):
    reads = read(spark, (0, 60, 60, "8M", "AAAACCCC"), (0, 64, 60, "2M2D4M", "CGTTTT"), (0, 57, 60, "8M", "GGGGGGGA"))
    sites = spark.createDataFrame(
        [("c", 64, "C", "A", 0.1), ("c", 66, "C", "T", 0.2), ("c", 67, "C", "G", 0.3), ("c", 68, "T", "C", 0.4)],
        "contig string, pos bigint, ref string, alt string, af double",
    )
    for width, salts in ((64, 8), (3, 1), (1000, 2)):
        got = rows(p.pileup_summaries(reads, sites, width=width, salts=salts), "pos", "ref_count", "alt_count", "other_alt_count")
        assert got == [(64, 2, 1, 0), (66, 1, 0, 0), (67, 1, 0, 0), (68, 1, 0, 0)]


def test_blocks_in_bins_without_a_site_are_not_shuffled(spark):
    from varspark.operators.regions import bin_join, occupied_bins

    spans = spark.range(0, 3_000_000, 10).selectExpr("'c' as contig", "id as start_pos", "id + 9 as end_pos")
    places = [1, 1023, 1024, 33_554_431, 33_554_432, 2_999_999]
    sites = spark.createDataFrame([("c", x) for x in places] + [("d", 5)], "contig string, pos bigint")
    occupied = occupied_bins(sites, 1024)
    met = bin_join(sites, spans, width=1024, heavy="spans", occupied=occupied)
    assert sorted(r.pos for r in met.collect()) == sorted(r.pos for r in bin_join(sites, spans, width=1024, heavy="spans").collect()) == [1, 1023, 1024, 2_999_999]
    from varspark.operators import regions

    kept = regions._in_occupied(spans.selectExpr("*", "explode(sequence(start_pos div 1024, end_pos div 1024)) as _bin"), occupied)
    assert {r._bin for r in kept.select("_bin").distinct().collect()} == {0, 1, 2929}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert occupied_bins(sites, 1024) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_pileup_depth_is_the_number_of_blocks_over_the_site(spark):
    rng = random.Random(5)
    items = [(0, rng.randint(1, 200), 60, rng.choice(["20M", "5M3D15M", "5M2I13M"]), "".join(rng.choice("ACGT") for _ in range(20))) for _ in range(80)]
    sites = spark.createDataFrame([("c", x, "A", "C", 0.1) for x in range(1, 230, 7)], "contig string, pos bigint, ref string, alt string, af double")
    got = {x.pos: x.ref_count + x.alt_count + x.other_alt_count for x in p.pileup_summaries(read(spark, *items), sites).collect()}
    for pos in range(1, 230, 7):
        depth = sum(1 for _, start, _, cigar, seq in items for a, b, _, _ in walk(start, cigar, seq) if a <= pos <= b)
        assert got.get(pos, 0) == depth


def test_allele_counts_of_snvs_and_indels(spark, rows):
    reference = "ACGTACGTAC"
    bases = spark.createDataFrame([("c", i + 1, b) for i, b in enumerate(reference)], "contig string, pos bigint, base string")
    reads = read(
        spark,
        (64 + 1, 1, 60, "6M", "ACGTAC"),  # first of pair, forward: F1R2, all reference
        (64 + 1, 1, 60, "6M", "ACTTAC"),  # G>T at 3
        (128 + 1, 1, 60, "6M", "ACTTAC"),  # second of pair, forward: F2R1
        (64 + 16 + 1, 1, 60, "3M2I3M", "ACGGGTAC"),  # insertion of GG after 3, F2R1
        (128 + 16 + 1, 1, 60, "3M2D3M", "ACGCGT"),  # deletion of TA after 3, F1R2
    )
    got = rows(p.allele_counts(reads, bases), "pos", "ref", "alt", "ref_count", "alt_count", "alt_f1r2", "alt_f2r1")
    assert got == [(3, "G", "GGG", 3, 1, 0, 1), (3, "G", "T", 3, 2, 1, 1), (3, "GTA", "G", 3, 1, 1, 0)]


def test_callable_counts_a_locus_once(spark, rows):
    counts = spark.createDataFrame(
        [("s", "0", "c", 5, "T", 9, 1), ("s", "0", "c", 5, "G", 9, 0), ("s", "0", "c", 6, "G", 5, 4)],
        "lab_id string, interval_id string, contig string, pos bigint, alt string, ref_count bigint, alt_count bigint",
    )
    assert rows(p.callable_sites(counts)) == [("s", "0", 1)]


def test_no_reads(spark):
    sites = spark.createDataFrame([("c", 64, "C", "A", 0.1)], "contig string, pos bigint, ref string, alt string, af double")
    assert p.pileup_summaries(spark.createDataFrame([], READS), sites).count() == 0


def test_reference_depths_of_loci_without_a_sample_are_those_of_every_sample(spark, rows):
    mine = [("s", "a", 0, "c", 60, 60, "8M", "AAAACCCC", "IIIIIIII"), ("s", "b", 0, "c", 64, 60, "4M", "CCGG", "I#II")]
    others = [("t", "a", 0, "c", 64, 60, "4M", "GCCC", "IIII"), ("u", "a", 1024, "c", 64, 60, "4M", "CCCC", "IIII"), ("t", "b", 0, "d", 64, 60, "1M", "C", "I")]
    reads = spark.createDataFrame(mine + others, READS)
    # Two alleles of one locus count once; an indel's base is its first.
    loci = [("c", 64, "C", "A"), ("c", 64, "C", "T"), ("c", 65, "CA", "C"), ("c", 90, "C", "A")]
    sites = spark.createDataFrame(loci, "contig string, pos bigint, ref string, alt string")
    whole = [("s", "c", 64, 2), ("s", "c", 65, 1), ("t", "c", 64, 0), ("t", "c", 65, 1)]
    assert rows(p.reference_depths(reads, sites, min_baseq=10), "lab_id", "contig", "pos", "ref_count") == whole
    assert rows(p.reference_depths(reads, sites.selectExpr("'s' as lab_id", "*"), min_baseq=10), "lab_id", "contig", "pos", "ref_count") == whole[:2]
