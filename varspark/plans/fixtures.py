"""Cohort tables derived from the driver's tables (see FIXTURES.md).

Everything grows with the tables it is derived from, but for the scatter list:
like any scatter it has a fixed number of evenly sized intervals.
"""

from __future__ import annotations

from functools import wraps
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.operators.contamination import LOCUS
from varspark.operators.manifest import normal_samples, pair_tumour_normal, samples_of
from varspark.operators.orientation import kmer_context
from varspark.operators.sites import explode_alleles, select_common_biallelic
from varspark.operators.skew import spread_join

SCATTER = 100
ORDERS_PER_SAMPLE = 100
PANEL = 400
SHIFT = 40

# Types of the columns used, so that no file is opened to infer them.
TYPES = {
    "c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string",
    "s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double",
    "p_partkey": "bigint", "p_size": "int",
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string",
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_discount": "double",
    "event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double",
}


def once(method):
    """Build the frame of a method once per ``Tables``, also if several threads ask for it."""

    @wraps(method)
    def built(self):
        with self._lock:
            if method.__name__ not in self._built:
                self._built[method.__name__] = method(self)
            return self._built[method.__name__]

    return built


def padded(number: str) -> str:
    return f"lpad(cast({number} as string), 11, '0')"


class Tables:
    """Driver tables of one scale factor as cohort tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}
        self._lock = RLock()

    def raw(self, name: str, *columns: str) -> DataFrame:
        """The named columns of a driver table and nothing else."""
        schema = ", ".join(f"{c} {TYPES[c]}" for c in columns)
        return self.spark.read.schema(schema).parquet(f"{self.sf_dir}/{name}.parquet")

    def _manifest(self, rows: DataFrame) -> DataFrame:
        """``rows``: s, nation, balance, library."""
        patient = "s div 3"
        return rows.selectExpr(
            "s",
            f"concat(case when balance < -500 then '#' else '' end, 'S', {padded('s')}) as sample_id",
            f"""concat('P', {padded(patient)}, case
                  when ({patient}) % 11 = 5 then if(s % 3 = 0, '-N', if(s % 3 = 1, '-N3', '-B2'))
                  when s % 3 = 1 then '-T1'
                  when s % 3 = 0 and nation = 7 then '-N10'
                  when s % 3 = 2 and nation = 3 then '-B2'
                  when s % 3 = 0 then if(({patient}) % 2 = 0, '-N', '-B1')
                  else if(({patient}) % 2 = 0, '-M2', '-P2') end) as lab_id""",
            "concat('CENTRE', cast(nation as string)) as seq_centre",
            "library",
        )

    @once
    def keyed_manifest(self) -> DataFrame:
        return self._manifest(
            self.raw("customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").selectExpr(
                "c_custkey as s",
                "c_nationkey as nation",
                "c_acctbal as balance",
                "if(c_mktsegment = 'HOUSEHOLD', 2, 1) as library",
            )
        )

    @once
    def manifest(self) -> DataFrame:
        return self.keyed_manifest().drop("s")

    @once
    def second_manifest(self) -> DataFrame:
        return self._manifest(
            self.raw("supplier", "s_suppkey", "s_nationkey", "s_acctbal").selectExpr(
                "s_suppkey as s", "s_nationkey as nation", "s_acctbal as balance", "1 as library"
            )
        ).drop("s")

    @once
    def samples(self) -> DataFrame:
        return samples_of(self.manifest())

    @once
    def normals(self) -> DataFrame:
        return normal_samples(self.samples())

    @once
    def pairs(self) -> DataFrame:
        return pair_tumour_normal(self.samples())

    @once
    def keyed_sites(self) -> DataFrame:
        """locus, contig, pos, r (letter of the reference base), ref, alts, afs."""
        letter = lambda n: f"substr('ACGT', cast(1 + ({n}) % 4 as int), 1)"
        af = "p_size / 100.0D"
        return (
            self.raw("part", "p_partkey", "p_size")
            .selectExpr(
                "p_partkey as locus",
                "concat('chr', cast(1 + p_partkey % 4 as string)) as contig",
                "100 + (p_partkey div 4) * 25 as pos",
                "(p_partkey * 5 + p_partkey div 16) % 4 as r",
                f"{af} as af",
            )
            .selectExpr(
                "locus",
                "contig",
                "pos",
                "r",
                f"if(locus % 13 = 0 and locus % 2 = 1, concat({letter('r')}, 'A'), {letter('r')}) as ref",
                f"""case when locus % 13 = 0 and locus % 2 = 1 then array({letter('r')})
                         when locus % 13 = 0 then array(concat({letter('r')}, 'A'))
                         when locus % 29 = 0 then array({letter('r + 1')}, {letter('r + 2')})
                         else array({letter('r + 1 + locus % 3')}) end as alts""",
                "if(locus % 29 = 0 and locus % 13 <> 0, array(af, af / 2.0D), array(af)) as afs",
            )
        )

    @once
    def sites(self) -> DataFrame:
        return self.keyed_sites().drop("locus", "r")

    @once
    def resource(self) -> DataFrame:
        """All alleles, as a site resource."""
        return explode_alleles(self.sites())

    @once
    def germline(self) -> DataFrame:
        """The resource as callers know it: alleles up to an AF of 0.16 are unknown to it."""
        return self.resource().filter(F.col("af") > 0.16)

    @once
    def observations(self) -> DataFrame:
        """Ref and alt reads per sample number, locus and allele number.

        One row of lineitem is one locus covered by ``l_quantity`` reads in the
        sample of its order; neighbouring patients share most of their panel.
        """
        observed = self.raw(
            "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount"
        ).selectExpr(
            f"l_orderkey div {ORDERS_PER_SAMPLE} as s",
            f"(l_orderkey div {3 * ORDERS_PER_SAMPLE}) as patient",
            f"(l_orderkey div {3 * ORDERS_PER_SAMPLE}) * {SHIFT} + l_partkey % {PANEL} as place",
            "cast(l_quantity as bigint) as d",
            "l_suppkey % 2 as f1",
            "l_linenumber",
            "if(l_discount > 0.065D and l_discount < 0.075D, 1L, 0L) as noise",
        )
        # Panels run on from the last part to the first, so that every row has a site.
        ends = self.raw("part", "p_partkey").agg(F.min("p_partkey").alias("low"), F.max("p_partkey").alias("high"))
        low, high = ends.select("low").scalar(), ends.select("high").scalar()
        observed = observed.withColumn("locus", low + (F.col("place") - low + (high - low + 1)) % (high - low + 1)).drop("place")
        planted = observed.selectExpr(
            "s",
            "locus",
            "d",
            "f1",
            "noise",
            "if(locus % 29 = 0 and locus % 13 <> 0, l_linenumber % 2, 0) as allele",
            "locus % 97 = 5 as artefact",
            "(locus * 31 + patient * 17) % 100 as g",
        ).selectExpr(
            "s",
            "locus",
            "allele",
            "d",
            "f1",
            "artefact",
            """case when artefact then d div 5
                    when g < 8 then d - noise
                    when g < 24 then d div 2
                    when g < 30 and s % 3 <> 0 then d div 4
                    else noise end as a""",
        )
        f1r2 = F.expr("case when artefact or f1 = 1 then a else 0 end")
        return planted.groupBy("s", "locus", "allele").agg(
            F.sum(F.col("d") - F.col("a")).alias("ref_count"),
            F.sum("a").alias("alt_count"),
            F.sum(f1r2).alias("alt_f1r2"),
            F.sum(F.col("a") - f1r2).alias("alt_f2r1"),
        )

    @once
    def located(self) -> DataFrame:
        """Observations with the place and the alleles of their locus."""
        alleles = self.keyed_sites().select(
            "locus", "contig", "pos", "ref", F.posexplode("alts").alias("allele", "alt")
        )
        return self.observations().join(alleles, ["locus", "allele"]).drop("locus", "allele")

    @once
    def counts(self) -> DataFrame:
        """lab_id, contig, pos, ref, alt, ref_count, alt_count, alt_f1r2, alt_f2r1."""
        listed = self.keyed_manifest().filter(~F.col("sample_id").startswith("#")).select("s", "lab_id")
        return spread_join(self.located(), listed, ["s"]).select(
            "lab_id", "contig", "pos", "ref", "alt", "ref_count", "alt_count", "alt_f1r2", "alt_f2r1"
        )

    @once
    def pileups(self) -> DataFrame:
        """Counts at common biallelic sites, in the form of a pileup table."""
        common = select_common_biallelic(self.sites())
        return self.counts().join(common, [*LOCUS, "ref", "alt"]).selectExpr(
            "lab_id", "contig", "pos", "ref_count", "alt_count", "0L as other_alt_count", "af"
        )

    @once
    def intervals(self) -> DataFrame:
        """``SCATTER`` evenly sized intervals over four contigs, with their number."""
        per_contig = SCATTER // 4
        return (
            self.sites()
            .agg(F.max("pos").alias("last"))
            .selectExpr(
                f"cast(ceil((last - 99) / {per_contig}.0D) as bigint) as w",
                f"explode(sequence(0L, {SCATTER - 1}L)) as interval_no",
            )
            .selectExpr(
                "interval_no",
                "format_string('%04d', interval_no) as interval_id",
                f"concat('chr', cast(1 + interval_no div {per_contig} as string)) as contig",
                f"100 + (interval_no % {per_contig}) * w as start_pos",
                f"100 + (interval_no % {per_contig}) * w + w - 1 as end_pos",
            )
        )

    @once
    def excluded(self) -> DataFrame:
        """BED regions around every site with an AF above 0.45."""
        return (
            self.sites().filter(F.col("afs")[0] > 0.45).selectExpr("contig", "pos - 11 as bed_start", "pos + 29 as bed_end")
        )

    @once
    def dictionary(self) -> DataFrame:
        """Contigs of the sites, in numeric order."""
        return (
            self.sites()
            .groupBy("contig")
            .agg((F.max("pos") + 1000).alias("length"))
            .selectExpr("contig", "cast(substr(contig, 4) as bigint) - 1 as idx", "length")
        )

    @once
    def contigs(self) -> DataFrame:
        """A dictionary with one contig per supplier."""
        return self.raw("supplier", "s_suppkey").selectExpr(
            f"concat('ctg', {padded('s_suppkey')}) as contig",
            "s_suppkey as idx",
            "1000 + (s_suppkey * 7919) % 5000 as length",
        )

    @once
    def ref_bases(self) -> DataFrame:
        """Reference sequence: 25 bases from each site on."""
        return (
            self.keyed_sites()
            .selectExpr("contig", "pos", "r", "explode(sequence(0, 24)) as o")
            .selectExpr(
                "contig", "pos + o as pos", "substr('ACGT', cast(1 + (r + o * (o + 1) div 2) % 4 as int), 1) as base"
            )
        )

    @once
    def contexts(self) -> DataFrame:
        return kmer_context(self.sites(), self.ref_bases())

    @once
    def mnps(self) -> DataFrame:
        """Three-base substitutions; the first and the last base always change."""
        return (
            self.raw("part", "p_partkey")
            .selectExpr(
                "concat('chr', cast(1 + p_partkey % 4 as string)) as contig",
                "p_partkey * 10 as pos",
                "substr('ACGTACGT', cast(1 + p_partkey % 4 as int), 3) as ref",
                "p_partkey % 2 as keeps",
            )
            .selectExpr(
                "contig",
                "pos",
                "ref",
                """concat(translate(substr(ref, 1, 1), 'ACGT', 'CGTA'), if(keeps = 0, substr(ref, 2, 1), translate(substr(ref, 2, 1), 'ACGT', 'GTAC')),
                   translate(substr(ref, 3, 1), 'ACGT', 'TACG')) as alt""",
            )
        )

    @once
    def reads(self) -> DataFrame:
        return self.raw("events", "event_id", "user_id").selectExpr(
            f"concat('P', {padded('user_id div 10')}, '-N') as lab_id",
            "cast(event_id as string) as read_id",
            """cast(case event_id % 11 when 0 then 1024 when 1 then 256 when 2 then 16 when 3 then 16 else 0 end
                 + if(event_id % 2 = 0, 64, 128) + 1 as int) as flag""",
            "concat('chr', cast(1 + user_id % 4 as string)) as contig",
            "1 + event_id * 5 div 4 as pos",
            "cast(event_id % 61 as int) as mapq",
            """case event_id % 5 when 0 then '10M2I20M' when 1 then '12M3D20M' when 2 then '4S28M'
                 when 3 then '2H10=2X20=' else '32M' end as cigar""",
            "translate(md5(cast(event_id as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq",
            "translate(md5(cast(event_id + 1 as string)), '0123456789abcdef', '#+5:?AFIIIIIIIII') as qual",
        )

    @once
    def log_lines(self) -> DataFrame:
        return self.raw("events", "event_id", "event_type", "value").selectExpr(
            f"{padded('event_id div 4')} as task_id",
            "event_id as line_no",
            """case event_type
                 when 'error' then 'A USER ERROR has occurred'
                 when 'purchase' then concat('Tool done. Elapsed time: ', cast(cast(floor(value) as bigint) as string), '.25 minutes.')
                 when 'view' then 'Tool returned:'
                 when 'click' then 'SUCCESS'
                 else concat('Runtime.totalMemory()=', cast(cast(floor(value * 10000000) as bigint) as string)) end as line""",
        )

    @once
    def tasks(self) -> DataFrame:
        """Expected tasks with a parameter: five orders are one task."""
        return (
            self.raw("orders", "o_orderkey")
            .groupBy(F.expr(f"{padded('o_orderkey div 5')} as task_id"), F.expr("o_orderkey div 5 as n"))
            .agg(F.max("o_orderkey").alias("last_order"))
            .selectExpr("task_id", "concat('group', cast(n div 50 as string)) as batch", "last_order")
        )

    @once
    def outputs(self) -> DataFrame:
        """Files found: one per order, absent for cheap orders and empty for dear ones."""
        return (
            self.raw("orders", "o_orderkey", "o_custkey", "o_totalprice")
            .filter("o_totalprice >= 20000")
            .selectExpr(
                f"{padded('o_orderkey div 5')} as task_id",
                "element_at(array('vcf', 'tbi', 'stats', 'f1r2', 'log'), cast(1 + o_orderkey % 5 as int)) as kind",
                "if(o_totalprice > 480000, 0L, o_custkey + 1) as length",
            )
        )

    @once
    def job_logs(self) -> DataFrame:
        return self.raw("events", "event_id", "event_type", "value").selectExpr(
            f"{padded('event_id')} as job_id",
            """case when value < 2 then 'walltime used' when event_type = 'error' then 'Exit Status: 271'
                 else 'Exit Status: 0' end as line""",
            "if(value > 150, 'stderr text', '') as stderr",
        )

    @once
    def jobs(self) -> DataFrame:
        return self.raw("orders", "o_orderkey").selectExpr(f"{padded('o_orderkey')} as job_id")

    @once
    def job_usage(self) -> DataFrame:
        return self.raw("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").selectExpr(
            f"concat('job', {padded('o_orderkey')}) as job",
            "o_orderpriority as stage",
            "48 * (1 + o_custkey % 10) as cpus",
            "o_totalprice / 100.0D as cpu_minutes",
            "cast(30 + o_orderkey % 60 as double) as wall_minutes",
        )
