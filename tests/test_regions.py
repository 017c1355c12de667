import random

import pytest
from pyspark.sql import functions as F

from varspark.operators import regions as r
from varspark.operators.ordered import last_rows, row_index, running_total


def brute(points, spans):
    return sorted((p, s) for p in points for s in spans if p[0] == s[0] and s[1] <= p[1] <= s[2])


@pytest.mark.parametrize("width,salts,heavy", [(7, 1, "points"), (64, 4, "points"), (10_000, 3, "spans"), (1, 2, "spans")])
def test_bin_join_equals_nested_loop(spark, width, salts, heavy):
    rng = random.Random(width)
    points = list({(f"c{rng.randint(1, 2)}", rng.randint(1, 400)) for _ in range(120)})
    spans = []
    for _ in range(60):
        start = rng.randint(1, 400)
        spans.append((f"c{rng.randint(1, 3)}", start, start + rng.choice([0, 1, 5, 63, 64, 150])))
    spans = list(set(spans))
    left = spark.createDataFrame(points, "contig string, pos bigint")
    right = spark.createDataFrame(spans, "contig string, start_pos bigint, end_pos bigint").withColumn(
        "kept", F.struct("start_pos", "end_pos")
    )
    got = r.bin_join(left, right, width=width, salts=salts, heavy=heavy).collect()
    assert sorted(((x.contig, x.pos), (x.contig, x.kept[0], x.kept[1])) for x in got) == brute(points, spans)
    semi = r.bin_join(left, right, width=width, salts=salts, how="left_semi")
    assert sorted(map(tuple, semi.collect())) == sorted({p for p, _ in brute(points, spans)})
    anti = r.bin_join(left, right, width=width, salts=salts, how="left_anti")
    assert anti.count() + semi.count() == len(points)


def test_bounds_of_intervals_and_beds(spark, rows):
    sites = spark.createDataFrame([("c", p) for p in (9, 10, 11, 20, 21)], "contig string, pos bigint")
    interval = spark.createDataFrame([("0000", "c", 10, 20)], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    assert rows(r.restrict_to_intervals(sites, interval), "pos") == [(10,), (11,), (20,)]
    bed = spark.createDataFrame([("c", 10, 20), ("c", 5, 5)], "contig string, bed_start bigint, bed_end bigint")
    assert rows(r.exclude_regions(sites, bed), "pos") == [(9,), (10,), (21,)]


def test_empty_sides(spark):
    sites = spark.createDataFrame([("c", 1)], "contig string, pos bigint")
    none = spark.createDataFrame([], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    bed = spark.createDataFrame([], "contig string, bed_start bigint, bed_end bigint")
    assert r.assign_interval(sites, none).count() == 0
    assert r.exclude_regions(sites, bed).count() == 1


def test_crowded_position_is_spread_and_whole(spark):
    """Two thirds of the rows lie at one position: no partition may get them all."""
    crowd = spark.range(30_000).selectExpr("id", "'c' as contig", "if(id % 3 < 2, 77, id) as pos")
    spans = spark.createDataFrame([("0001", "c", 1, 40_000)], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = r.assign_interval(crowd, spans, salts=16)
        sizes = [n for (n,) in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 30_000
    assert max(sizes) < 10_000


def test_split_keeps_contigs_whole_and_in_order(spark):
    lengths = [100, 90, 5, 5, 5, 50, 40, 1]
    contigs = spark.createDataFrame([(f"c{i}", i, n) for i, n in enumerate(lengths)], "contig string, idx bigint, length bigint")
    got = {x.contig: x.group_id for x in r.split_intervals(contigs, 6).collect()}
    groups = [got[f"c{i}"] for i in range(len(lengths))]
    assert groups == sorted(groups) and groups[0] == 0
    assert len(set(groups)) <= 6 and set(groups) == set(range(len(set(groups))))


def test_chunks_round_trip(spark, rows):
    intervals = spark.createDataFrame([(i, f"{i:04d}", c) for i, c in enumerate([5, 1, 1, 1, 8, 2, 2])], "interval_no bigint, interval_id string, cost bigint")
    chunks = r.pack_chunks(intervals, 3)
    assert sum(c.cost for c in chunks.collect()) == 20
    assert sorted(x for (x,) in rows(r.explode_chunks(chunks), "interval_id")) == [f"{i:04d}" for i in range(7)]


def test_gather_order_reports_overlap_only(spark, rows):
    parts = spark.createDataFrame(
        [("a", "c", 1, 10), ("b", "c", 11, 20), ("c", "c", 20, 30), ("d", "e", 5, 6)],
        "interval_id string, contig string, start_pos bigint, end_pos bigint",
    )
    assert rows(r.check_gather_order(parts), "interval_id", "previous_id") == [("c", "b")]


def test_running_total_does_not_depend_on_block_width(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.randint(0, 500), i, rng.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(data, "k string, o bigint, tie bigint, v bigint")
    for width in (1, 7, 10_000):
        got = {x.tie: x.s for x in running_total(df, F.col("v"), "s", order=["o", "tie"], keys=["k"], width=width).collect()}
        for key in "ab":
            total = 0
            for _, _, tie, v in sorted((x for x in data if x[0] == key), key=lambda x: (x[1], x[2])):
                total += v
                assert got[tie] == total
    assert [x.i for x in row_index(df, "i", order=["o", "tie"], width=5).orderBy("o", "tie").collect()] == list(range(300))


def test_last_rows_over_blocks(spark):
    df = spark.range(1000).selectExpr("'t' as task_id", "id * 3 as line_no")
    got = sorted(x.line_no for x in last_rows(df, 50, keys=["task_id"], order="line_no", width=16).collect())
    assert got == [i * 3 for i in range(950, 1000)]


def test_a_part_is_held_against_all_before_it(spark, rows):
    parts = spark.createDataFrame([("a", "c", 1, 100), ("b", "c", 10, 20), ("d", "c", 50, 60), ("e", "c", 101, 110)], "interval_id string, contig string, start_pos bigint, end_pos bigint")
    assert rows(r.check_gather_order(parts), "interval_id", "previous_id", "previous_end") == [("b", "a", 100), ("d", "a", 100)]


def test_unlisted_contigs_come_last(spark):
    from varspark.operators.sites import sort_sites

    contigs = spark.createDataFrame([("chr2", 1), ("chr1", 0)], "contig string, idx bigint")
    sites = spark.createDataFrame([("new", 1), ("chr2", 5), ("chr1", 9)], "contig string, pos bigint")
    assert [x.contig for x in sort_sites(sites, contigs).collect()] == ["chr1", "chr2", "new"]


SPANS = "contig string, start_pos bigint, end_pos bigint, interval_id string"


def test_long_spans_are_listed_in_few_bins(spark):
    lengths = [1, 9_999, 10_000, 160_000, 250_000, 3_000_000, 50_000_000, 250_000_000, 2_000_000_000]
    spans = spark.createDataFrame([("c", 7_777, 7_776 + n, str(n)) for n in lengths], SPANS)
    level = r.level_of("start_pos", "end_pos", r.SITE_BIN)
    width = F.lit(float(r.SITE_BIN)) * F.pow(F.lit(float(r.FAN)), level)
    listed = spans.select("interval_id", (F.floor(F.col("end_pos") / width) - F.floor(F.col("start_pos") / width) + 1).alias("n")).collect()
    assert all(x.n <= r.FAN for x in listed if x.interval_id != "2000000000") and max(x.n for x in listed) < 40
    assert r.levels_in(spans) == [0, 1, 2, 3, 4]


def test_joins_over_nested_bins_equal_plain_ones(spark, rows):
    rng = random.Random(21)
    spans = [(rng.choice("ab"), a, a + rng.choice([0, 5, 30, 400, 9_000, 200_000]), str(k)) for k in range(60) for a in [rng.randrange(1, 300_000)]]
    points = [(rng.choice("abc"), rng.randrange(1, 500_000), k) for k in range(500)]
    sites = spark.createDataFrame(points, "contig string, pos bigint, n bigint")
    for some in (spans, spans[:1], []):
        table = spark.createDataFrame(some, SPANS)
        holds = lambda c, x, some=some: [s[3] for s in some if s[0] == c and s[1] <= x <= s[2]]
        for width, salts in ((10, 1), (64, 3)):
            assert rows(r.assign_interval(sites, table, width, salts), "n", "interval_id") == sorted((k, i) for c, x, k in points for i in holds(c, x))
            inside = sorted((k,) for c, x, k in points if holds(c, x))
            assert rows(r.restrict_to_intervals(sites, table, width, salts), "n") == inside
            bed = table.selectExpr("contig", "start_pos - 1 as bed_start", "end_pos as bed_end")
            assert rows(r.exclude_regions(sites, bed, width, salts), "n") == sorted({(k,) for *_, k in points} - set(inside))
