"""One key with most of the rows: results stay whole and no partition gets them all."""

import pytest
from pyspark.sql import functions as F

from varspark.operators.skew import SALT, add_salt, spread_join
from varspark.operators.sites import annotate_germline, resource_size


@pytest.fixture
def crowd(spark):
    return spark.range(20_000).selectExpr("concat('s', id) as lab_id", "'c' as contig", "if(id % 3 = 0, id, 5) as pos", "'A' as ref", "'C' as alt")


def test_salt_depends_on_values_only(spark, crowd):
    once = add_salt(crowd).select("lab_id", SALT)
    again = add_salt(crowd.repartition(7)).select("lab_id", SALT)
    assert once.exceptAll(again).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, crowd, how):
    small = spark.createDataFrame([(5, "hot"), (9, "x"), (9, "y")], "pos bigint, tag string")
    plain = crowd.join(small, "pos", how).select("lab_id", "pos", "tag")
    spread = spread_join(crowd, small, ["pos"], how).select("lab_id", "pos", "tag")
    assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_hot_site_is_annotated_in_several_tasks(spark, crowd):
    germline = spark.createDataFrame([("c", 5, "A", "C", 0.25)], "contig string, pos bigint, ref string, alt string, af double")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        done = annotate_germline(crowd, germline, salts=16)
        sizes = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
        hot = done.filter("af = 0.25").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and hot == 13_333
    assert max(sizes) < 6_000


def test_totals_come_from_partial_counts(spark, crowd):
    got = {r.contig: r.n_loci for r in resource_size(crowd).collect()}
    assert got == {"c": 20_000, None: 20_000}
