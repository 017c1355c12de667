"""Registered queries: equal to their SQL, and planned without nested loops."""

import importlib.util
import math
import os

import duckdb
import pytest

from varspark.plans import oracle
from varspark.plans import queries as registered

SF = os.environ.get("VARSPARK_TEST_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")

spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

QUERIES, SQL = registered.all_queries(), oracle.all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v
    return sorted(tuple(repr(plain(r[i])) for i in order) for r in rows)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == comparable(columns, expected.fetchall())


def test_reference_depths_cover_every_sample_at_every_site(spark, duck):
    """Every base of a usable read at a site of the resource, not those alone that a sample's counts name."""
    asked = "WITH one AS (%s) SELECT DISTINCT lab_id, contig, pos FROM one"
    covered = set(duck.execute(asked % SQL["q_gather_pileups"]).fetchall())
    got = {(r.lab_id, r.contig, r.pos) for r in QUERIES["q_reference_depths"](spark, SF).collect()}
    assert covered and covered <= got


PLANNED = [
    "q_assign_interval", "q_exclude_regions", "q_pileup_summaries", "q_allele_counts", "q_create_pon", "q_call_pairs",
    "q_contamination", "q_maf_segments", "q_f1r2_histogram", "q_expected_grid", "q_rerun_set", "q_annotate_germline",
]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_nested_loop_and_no_python(spark, name, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = executed(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    for word in ("NestedLoop", "Cartesian", "Python", "ArrowEval"):
        assert word not in plan
    if broadcast == "-1":
        assert "BroadcastExchange" not in plan


def test_scans_read_only_what_they_use(spark):
    plan = executed(QUERIES["q_only_contig"](spark, SF))
    lineitem = [x for x in plan.splitlines() if "FileScan parquet" in x and "lineitem" in x]
    assert lineitem and all("l_extendedprice" not in x and "l_shipdate" not in x for x in lineitem)


def test_stored_stages_change_nothing(spark):
    from varspark.plans.fixtures import Tables
    from varspark.plans.queries import workflow

    key = ["pair", "contig", "pos", "ref", "alt"]
    rounded = lambda w: sorted((*[r[k] for k in key], round(r.p_error, 9)) for r in w.scored.collect())
    assert rounded(workflow(Tables(spark, SF), keep=True)) == rounded(workflow(Tables(spark, SF), keep=False))


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_no_row_of_lineitem_is_lost(spark):
    from varspark.plans.fixtures import Tables

    t = Tables(spark, SF)
    seen = t.observations().agg({"ref_count": "sum", "alt_count": "sum"}).collect()[0]
    kept = t.observations().join(t.keyed_sites().select("locus"), "locus").agg({"ref_count": "sum", "alt_count": "sum"}).collect()[0]
    whole = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr("sum(cast(l_quantity as bigint)) as n").collect()[0].n
    assert sum(seen) == sum(kept) == whole


def test_threads_that_ask_for_a_table_at_once_share_one(spark):
    """Else each of them stores a copy of its own."""
    import time
    from concurrent.futures import ThreadPoolExecutor

    from varspark.plans.fixtures import Tables, once

    class Slow(Tables):
        made = 0

        @once
        def counts(self):
            time.sleep(0.2)
            self.made += 1
            return spark.range(1)

    t = Slow(spark, "nowhere")
    with ThreadPoolExecutor(4) as pool:
        frames = list(pool.map(lambda _: t.counts(), range(4)))
    assert t.made == 1 and all(f is frames[0] for f in frames)


def test_inputs_of_a_workflow_go_when_its_stages_are_written(spark, tmp_path):
    import glob

    from varspark.plans.fixtures import Tables
    from varspark.plans.queries import CohortFixture, StoredTables, workflow

    tables = {
        "customer": (12, ["id as c_custkey", "1 as c_nationkey", "if(id = 4, -600.0D, 9.0D) as c_acctbal", "'X' as c_mktsegment"]),
        "part": (60, ["id as p_partkey", "cast(5 + id % 40 as int) as p_size"]),
        "lineitem": (170, ["id * 7 as l_orderkey", "id % 60 as l_partkey", "id as l_suppkey", "cast(id % 3 as int) as l_linenumber", "20.0D + id % 30 as l_quantity", "0.07D as l_discount"]),
    }
    for name, (n, columns) in tables.items():
        spark.range(n).selectExpr(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    plain, stored = CohortFixture(spark, str(tmp_path)), StoredTables(spark, str(tmp_path))
    everything = lambda df: sorted(map(str, df.collect()))
    assert everything(stored.counts()) == everything(plain.counts()) != []
    assert [*stored._stages] == ["counts"]
    stored.drop()
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    inputs = lambda: sum((glob.glob(f"{shared}/{name}-*") for name in ("located", "counts", "pileups")), [])
    before = inputs()
    cohort = workflow(Tables(spark, str(tmp_path)), keep=True)
    assert inputs() == before
    assert cohort.filtered.count() > 0
    cohort.close()
