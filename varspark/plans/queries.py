"""One registered query per operator, over the tables of one scale factor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.functions import text
from varspark.operators import contamination as cont
from varspark.operators import filtering, manifest, orientation, pileup, pon, qc, reference, regions, sites, somatic
from varspark.plans.fixtures import Tables, once
from varspark.plans.workflow import Workflow
from varspark.schemas import SITE
from varspark.session import removed, scratch_path, shuffles_removed, stored
from varspark.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

MITO = "chr4"
RUN = 5
ITERATIONS = 5
KINDS = ("vcf", "tbi", "stats", "f1r2", "log")
CALL = ["pair", *SITE]

_registry: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _registry[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


class CohortFixture(Tables):
    """Fixture tables as a workflow takes them: the counts hold rows of loci that show the reference alone, and come from no reads."""

    def reads(self) -> None:
        return None


class StoredTables(CohortFixture):
    """Fixture tables whose inputs of the workflow are written once, as a cohort has them.

    ``drop`` deletes them once the stages that read them are written. Counts are written in two steps, so that the shuffles of the first are gone in the second.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self._stages: dict[str, str] = {}

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        self._stages[name] = scratch_path(self.spark, name)
        with shuffles_removed(self.spark):
            df.write.parquet(self._stages[name])
        return self.spark.read.schema(df.schema).parquet(self._stages[name])

    def drop(self, *names: str) -> None:
        """Delete the tables of these names, or all; frames that read them can not be used any more."""
        for name in names or [*self._stages]:
            removed(self.spark, self._stages.pop(name))

    @once
    def located(self) -> DataFrame:
        return self._stored(Tables.located.__wrapped__(self), "located")

    @once
    def counts(self) -> DataFrame:
        counts = self._stored(Tables.counts.__wrapped__(self), "counts")
        self.drop("located")
        return counts

    @once
    def pileups(self) -> DataFrame:
        return self._stored(Tables.pileups.__wrapped__(self), "pileups")


def workflow(t: Tables, keep: bool = False) -> Workflow:
    """With ``keep``, counts and pileups are input tables of the workflow; they go when all stages that read them are written."""
    t = (StoredTables if keep else CohortFixture)(t.spark, t.sf_dir)
    cohort = Workflow(t, mito=MITO, run=RUN, iterations=ITERATIONS, keep=keep)
    if keep:
        cohort.prepare()
        t.drop()
    return cohort


# --- sources and sinks -------------------------------------------------------


def _write_text(df: DataFrame, t: Tables, name: str) -> str:
    path = scratch_path(t.spark, name)
    df.write.text(path)
    return path


def _write_text_by(df: DataFrame, t: Tables, name: str, key: str, *order: str) -> str:
    """One folder per key; ranges keep a key in few files and split a long one."""
    path = scratch_path(t.spark, name)
    order = order or ("value",)
    placed = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    placed.select(key, "value").write.partitionBy(key).text(path)
    return path


@query
def q_read_manifest(t: Tables) -> DataFrame:
    library = F.when(F.col("library") == 1, "").otherwise(F.col("library").cast("string"))
    lines = t.manifest().select(F.concat_ws("\t", "sample_id", "lab_id", "seq_centre", library).alias("value"))
    head = t.spark.createDataFrame([("#SampleID\tLabSampleID\tSeq_centre\tLibrary",), ("",)], "value string")
    return readers.read_manifest(t.spark, _write_text(head.union(lines), t, "manifest"))


@query
def q_read_intervals(t: Tables) -> DataFrame:
    """Interval lists of the cohort: the span each sample covers, one list per sample."""
    spans = t.counts().groupBy("lab_id", "contig").agg(F.min("pos").alias("a"), F.max("pos").alias("b"))
    rows = spans.select(
        "lab_id", F.concat_ws("\t", "contig", F.col("a").cast("string"), F.col("b").cast("string"), F.lit("+"), F.lit(".")).alias("value")
    )
    heads = spans.select("lab_id").distinct().select("lab_id", F.lit("@HD\tVN:1.6").alias("value"))
    path = _write_text_by(heads.union(rows), t, "intervals", "lab_id")
    return readers.read_intervals(t.spark, path, r"/lab_id=([^/]+)/")


@query
def q_read_bed(t: Tables) -> DataFrame:
    lines = t.excluded().select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("contig", "bed_start", "bed_end")]).alias("value"))
    return readers.read_bed(t.spark, _write_text(lines, t, "bed"))


@query
def q_read_contigs(t: Tables) -> DataFrame:
    lines = (
        t.contigs()
        .repartitionByRange("idx")
        .sortWithinPartitions("idx")
        .select(F.concat(F.lit("@SQ\tSN:"), "contig", F.lit("\tLN:"), F.col("length").cast("string"), F.lit("\tM5:x")).alias("value"))
    )
    return readers.read_contigs(t.spark, _write_text(lines, t, "dictionary"))


@query
def q_read_variants(t: Tables) -> DataFrame:
    """Sites with the pooled counts of normals and tumours as two genotype columns."""
    pooled = t.counts().join(t.samples().select("lab_id", "role"), "lab_id").groupBy(*SITE).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("role") == role, F.col(c))), F.lit(0)).cast("string").alias(f"{role}_{c}")
            for role in ("normal", "tumour")
            for c in ("ref_count", "alt_count")
        ]
    )
    cell = lambda role: F.concat(F.lit("0/1:"), f"{role}_ref_count", F.lit(","), f"{role}_alt_count")
    lines = pooled.select(
        F.concat_ws(
            "\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("."),
            F.concat(F.lit("DB;LEN="), F.length("alt").cast("string")), F.lit("GT:AD"), cell("normal"), cell("tumour"),
        ).alias("value")
    )
    columns = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT NORMAL TUMOUR".split())
    head = t.spark.createDataFrame([("##fileformat=VCFv4.2",), (columns,)], "value string")
    path = _write_text(head.union(lines), t, "variants")
    rows = readers.explode_genotypes(readers.read_variants(t.spark, path, one_header=True))
    depths = F.split(F.col("fields")["AD"], ",")
    return rows.select(
        "contig", "pos", "ref", F.concat_ws(",", "alts").alias("alt"), "lab_id",
        depths[0].cast("long").alias("ref_count"), depths[1].cast("long").alias("alt_count"),
        F.col("info")["LEN"].cast("long").alias("alt_length"), F.map_contains_key("info", "DB").alias("in_db"),
    )


@query
def q_read_variants_by_file(t: Tables) -> DataFrame:
    """Pooled counts in files of 10 Mb, each with a header that names a sample of its own."""
    stretch = F.concat_ws("_", "contig", F.floor(F.col("pos") / 10_000_000).cast("string"))
    pooled = t.counts().groupBy(*SITE).agg(F.sum("ref_count").alias("r"), F.sum("alt_count").alias("a")).withColumn("stretch", stretch)
    line = F.concat_ws(
        "\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("AD"),
        F.concat_ws(",", F.col("r").cast("string"), F.col("a").cast("string")),
    )
    columns = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split())
    heads = pooled.select("stretch").distinct().select("stretch", F.lit(-1).cast("long").alias("pos"), F.concat_ws("\t", F.lit(columns), "stretch").alias("value"))
    path = scratch_path(t.spark, "variants")
    lines = heads.unionByName(pooled.select("stretch", "pos", line.alias("value")))
    lines.repartition("stretch").sortWithinPartitions("stretch", "pos").select("stretch", "value").write.partitionBy("stretch").text(path)
    rows = readers.explode_genotypes(readers.read_variants(t.spark, path))
    depths = F.split(F.col("fields")["AD"], ",")
    return rows.select(
        "contig", "pos", "ref", F.concat_ws(",", "alts").alias("alt"), "lab_id", depths[0].cast("long").alias("ref_count"), depths[1].cast("long").alias("alt_count")
    )


@query
def q_read_job_logs(t: Tables) -> DataFrame:
    """Jobs with the lines of their logs and what they wrote to stderr first."""
    path = scratch_path(t.spark, "jobs")
    events = t.raw("events", "event_id", "event_type", "value").select(
        "event_id", "value", F.col("event_type").alias("job"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("line")
    )
    for kind, rows in (("o", events), ("e", events.filter("value > 150"))):
        placed = rows.repartitionByRange("job", "event_id").sortWithinPartitions("job", "event_id")
        placed.select("job", F.col("line").alias("value")).write.partitionBy("job").text(f"{path}/{kind}")
    logs = readers.read_job_logs(t.spark, path, r"/o/job=([^/]+)/", r"/e/job=([^/]+)/")
    return logs.groupBy("job_id", "stderr").agg(F.count("*").alias("n_lines"))


@query
def q_read_reads(t: Tables) -> DataFrame:
    lines = t.reads().select(
        "lab_id",
        F.concat_ws(
            "\t", "read_id", F.col("flag").cast("string"), "contig", F.col("pos").cast("string"), F.col("mapq").cast("string"),
            "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual",
        ).alias("value"),
    )
    return readers.read_reads(t.spark, _write_text_by(lines, t, "reads", "lab_id"), sample=r"/lab_id=([^/]+)/")


@query
def q_read_pileups(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "pileups")
    writers.write_pileups(t.pileups(), path)
    return readers.read_pileups(t.spark, path, r"/lab_id=([^/]+)/")


@query
def q_read_logs(t: Tables) -> DataFrame:
    """One log per kind of event; long logs come in several files and splits."""
    text_of = F.concat(F.lit("event "), F.col("event_id").cast("string"))
    lines = t.raw("events", "event_id", "event_type").withColumn("value", text_of)
    path = _write_text_by(lines, t, "logs", "event_type", "event_id")
    return readers.read_logs(t.spark, path, r"/event_type=([^/]+)/")


@query
def q_read_reference(t: Tables) -> DataFrame:
    """The bases from the first site of each contig on, as FASTA lines of 25."""
    base = "substr('ACGT', cast(1 + (r + o * (o + 1) div 2) % 4 as int), 1)"
    lines = t.keyed_sites().selectExpr("contig", "pos", f"concat_ws('', transform(sequence(0, 24), o -> {base})) as value")
    heads = lines.select("contig").distinct().selectExpr("contig", "0L as pos", "concat('>', contig, ' bases') as value")
    path = _write_text_by(heads.unionByName(lines), t, "reference", "contig", "pos")
    return readers.single_bases(readers.read_reference(t.spark, path))


@query
def q_list_outputs(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "outputs")
    t.outputs().select("kind", F.concat_ws(",", "task_id", F.col("length").cast("string")).alias("value")).write.partitionBy("kind").text(path)
    kind = text.captured(F.col("path"), r"/kind=([^/]+)/")
    files = readers.list_outputs(t.spark, path).withColumn("kind", kind).filter(F.col("kind").isNotNull())
    return files.groupBy("kind").agg(F.sum("length").alias("bytes"))


@query
def q_write_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "store")
    store = regions.assign_interval(t.counts(), t.intervals())
    writers.write_table(store, path, by="interval_id", order=("contig", "pos", "lab_id"))
    return t.spark.read.schema(store.schema).parquet(path)


@query
def q_write_variants(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "panel")
    writers.write_variants(writers.panel_records(workflow(t).panel), path, t.dictionary())
    back = readers.read_variants(t.spark, path, one_header=True)
    return back.select(
        "contig", "pos", "ref", F.concat_ws(",", "alts").alias("alt"), F.col("info")["SEEN"].cast("long").alias("n_seen")
    )


# --- manifest and pairing ----------------------------------------------------


@query
def q_classify_samples(t: Tables) -> DataFrame:
    return manifest.classify_samples(t.manifest())


@query
def q_derive_patient(t: Tables) -> DataFrame:
    return t.samples().select("lab_id", "role", "patient", "suffix")


@query
def q_normal_samples(t: Tables) -> DataFrame:
    return t.normals().select("sample_id", "lab_id", "patient")


@query
def q_pair_tumour_normal(t: Tables) -> DataFrame:
    return t.pairs()


@query
def q_unpaired_normals(t: Tables) -> DataFrame:
    return manifest.unpaired_normals(t.samples()).select("lab_id", "patient")


@query
def q_unpaired_tumours(t: Tables) -> DataFrame:
    return manifest.unpaired_tumours(t.samples()).select("lab_id", "patient")


@query
def q_pair_counts(t: Tables) -> DataFrame:
    return manifest.pair_counts(t.samples())


@query
def q_concat_manifests(t: Tables) -> DataFrame:
    return manifest.concat_manifests(t.manifest(), t.second_manifest())


@query
def q_duplicate_samples(t: Tables) -> DataFrame:
    return manifest.duplicate_samples(manifest.concat_manifests(t.manifest(), t.second_manifest()))


@query
def q_reuse_previous(t: Tables) -> DataFrame:
    return manifest.reuse_previous(t.samples(), t.counts()).select("lab_id", "gathered")


@query
def q_sample_map(t: Tables) -> DataFrame:
    return manifest.sample_map(t.samples(), "store/normals/")


@query
def q_expected_grid(t: Tables) -> DataFrame:
    """Intervals in which the tumour of a pair has no counts, as gaps."""
    present = regions.assign_interval(t.counts(), t.intervals()).select(F.col("lab_id").alias("tumour_id"), "interval_id")
    gaps = manifest.expected_grid(t.pairs().select("tumour_id"), present, t.intervals(), "tumour_id")
    return gaps.join(t.pairs().select("tumour_id", "pair"), "tumour_id").drop("tumour_id")


# --- intervals and regions ---------------------------------------------------


@query
def q_restrict_to_intervals(t: Tables) -> DataFrame:
    """Counts inside the excluded regions, taken as an interval list."""
    return regions.restrict_to_intervals(t.counts(), regions.bed_to_spans(t.excluded()))


@query
def q_assign_interval(t: Tables) -> DataFrame:
    return regions.assign_interval(t.counts(), t.intervals()).select("lab_id", *SITE, "interval_id")


@query
def q_exclude_regions(t: Tables) -> DataFrame:
    return regions.exclude_regions(t.counts(), t.excluded())


@query
def q_exclude_contig(t: Tables) -> DataFrame:
    return regions.exclude_contig(t.counts(), MITO)


@query
def q_only_contig(t: Tables) -> DataFrame:
    return regions.only_contig(t.counts(), MITO)


@query
def q_split_intervals(t: Tables) -> DataFrame:
    return regions.split_intervals(t.contigs(), 24)


def _costed(t: Tables) -> DataFrame:
    """Scatter intervals with the reads seen in each as their cost."""
    cost = (
        regions.assign_interval(t.counts(), t.intervals())
        .groupBy("interval_id")
        .agg(F.sum(F.col("ref_count") + F.col("alt_count")).alias("cost"))
    )
    return t.intervals().join(cost, "interval_id", "left").fillna(0, ["cost"])


@query
def q_pack_chunks(t: Tables) -> DataFrame:
    return regions.pack_chunks(_costed(t), 8)


@query
def q_chunk_members(t: Tables) -> DataFrame:
    return regions.chunk_members(_costed(t), 8).select("chunk_id", "place", "interval_id", "cost")


@query
def q_explode_chunks(t: Tables) -> DataFrame:
    return regions.explode_chunks(regions.pack_chunks(_costed(t), 8)).select("chunk_id", "place", "interval_id")


@query
def q_split_resource(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "resource")
    writers.split_resource(t.resource(), t.intervals(), path)
    return t.spark.read.parquet(path).withColumn("interval_id", F.format_string("%04d", F.col("interval_id").cast("long")))


@query
def q_check_gather_order(t: Tables) -> DataFrame:
    """Parts of each sample; reads at the last locus reach past its position."""
    parts = (
        regions.assign_interval(t.counts(), t.intervals())
        .groupBy("lab_id", "interval_id", "contig")
        .agg(F.min("pos").alias("start_pos"), (F.max("pos") + F.max("ref_count")).alias("end_pos"))
    )
    return regions.check_gather_order(parts, ["lab_id"])


# --- reads to counts ---------------------------------------------------------


@query
def q_usable_reads(t: Tables) -> DataFrame:
    return pileup.usable_reads(t.reads())


@query
def q_cigar_blocks(t: Tables) -> DataFrame:
    return pileup.cigar_blocks(t.reads()).select("read_id", "start_pos", "end_pos", "read_offset", "bases")


@query
def q_pileup_summaries(t: Tables) -> DataFrame:
    return pileup.pileup_summaries(t.reads(), sites.select_common_biallelic(t.sites()), min_baseq=10)


@query
def q_gather_pileups(t: Tables) -> DataFrame:
    common = sites.select_common_biallelic(t.sites())
    parts = [
        pileup.pileup_summaries(t.reads(), regions.exclude_contig(common, MITO)),
        pileup.pileup_summaries(t.reads(), regions.only_contig(common, MITO)),
    ]
    return pileup.gather_pileups(*parts)


@query
def q_allele_counts(t: Tables) -> DataFrame:
    return pileup.allele_counts(t.reads(), t.ref_bases(), min_baseq=10)


@query
def q_reference_depths(t: Tables) -> DataFrame:
    """Reference reads at the sites of the resource, for every sample with reads."""
    return pileup.reference_depths(t.reads(), t.resource().select(*SITE), min_baseq=10)


@query
def q_normalise_indels(t: Tables) -> DataFrame:
    """Indels of the reads as far left as the reference allows, beside their own spelling."""
    alleles = pileup.allele_counts(t.reads(), t.ref_bases()).filter(F.length("ref") != F.length("alt")).select(*SITE).distinct()
    given = stored(alleles, "alleles").withColumns({f"given_{c}": F.col(c) for c in ("pos", "ref", "alt")})
    return reference.normalise_indels(given, reference.reference_chunks(t.ref_bases()))


@query
def q_callable_from_reads(t: Tables) -> DataFrame:
    return pileup.callable_from_reads(t.reads(), t.intervals(), min_depth=1)


@query
def q_callable_sites(t: Tables) -> DataFrame:
    return pileup.callable_sites(regions.assign_interval(t.counts(), t.intervals()))


# --- site resources ----------------------------------------------------------


@query
def q_select_common_biallelic(t: Tables) -> DataFrame:
    return sites.select_common_biallelic(t.sites())


@query
def q_explode_alleles(t: Tables) -> DataFrame:
    return rounded(sites.explode_alleles(t.sites()), "af")


@query
def q_classify_variant(t: Tables) -> DataFrame:
    both = t.mnps().unionByName(t.counts().select(*SITE))
    return sites.classify_variant(both).groupBy("contig", "variant_type").agg(F.count("*").alias("n"))


@query
def q_annotate_germline(t: Tables) -> DataFrame:
    return rounded(sites.annotate_germline(t.counts().select("lab_id", *SITE), t.germline()), "af")


@query
def q_resource_size(t: Tables) -> DataFrame:
    return sites.resource_size(t.resource())


# --- panel of normals --------------------------------------------------------


@query
def q_normal_candidates(t: Tables) -> DataFrame:
    return rounded(pon.normal_candidates(t.counts(), t.normals()), "lod", "fraction")


@query
def q_split_mnps(t: Tables) -> DataFrame:
    return pon.split_mnps(t.mnps())


@query
def q_gather_calls(t: Tables) -> DataFrame:
    calls = pon.normal_candidates(t.counts(), t.normals()).select("lab_id", *SITE, "alt_count")
    return pon.gather_calls(regions.exclude_contig(calls, MITO), regions.only_contig(calls, MITO))


@query
def q_consolidate_cohort(t: Tables) -> DataFrame:
    calls = pon.normal_candidates(t.counts(), t.normals()).select("lab_id", *SITE, "ref_count", "alt_count")
    return pon.consolidate_cohort(calls, t.intervals(), scratch_path(t.spark, "cohort"))


@query
def q_cohort_matrix(t: Tables) -> DataFrame:
    """One row per patient and site, one column per sample suffix."""
    samples = t.samples().filter(F.col("patient").isNotNull()).select("lab_id", "patient", "suffix")
    calls = t.counts().join(samples, "lab_id")
    return pon.cohort_matrix(calls, ["N", "B1", "B2", "T1", "M2", "P2"], by="suffix", rows=["patient", *SITE])


def _panel(df: DataFrame) -> DataFrame:
    """The beta shape spans five orders of magnitude, so it is compared by its logarithm."""
    small = rounded(df, "share_of_normals", "mean_fraction", "var_fraction")
    shapes = ("beta_alpha", "beta_beta")
    return small.withColumns({f"log_{c}": F.round(F.log10(c), 6) for c in shapes}).drop(*shapes)


@query
def q_create_pon(t: Tables) -> DataFrame:
    return _panel(workflow(t).panel)


@query
def q_sort_sites(t: Tables) -> DataFrame:
    return sites.sort_sites(rounded(t.resource(), "af"), t.dictionary())


@query
def q_extend_pon(t: Tables) -> DataFrame:
    """Normals named -N are the stored cohort; those with another ending are added to it."""
    calls = pon.normal_candidates(t.counts(), t.normals())
    first = F.col("lab_id").endswith("-N")
    path = scratch_path(t.spark, "panel-store")
    pon.write_panel_store(calls.filter(first), t.normals().filter(first), path, t.germline())
    # All normals are offered; the register tells which are new.
    return _panel(pon.extend_pon(path, calls, t.normals(), t.germline()))


# --- somatic calling ---------------------------------------------------------


@query
def q_tumour_candidates(t: Tables) -> DataFrame:
    return rounded(somatic.tumour_candidates(t.counts(), t.pairs()), "tlod")


@query
def q_join_matched_normal(t: Tables) -> DataFrame:
    cands = somatic.tumour_candidates(t.counts(), t.pairs())
    return rounded(somatic.join_matched_normal(cands, t.counts()).select(*CALL, "n_ref", "n_alt", "nlod"), "nlod")


@query
def q_mark_pon(t: Tables) -> DataFrame:
    cands = somatic.tumour_candidates(t.counts(), t.pairs()).select(*CALL)
    return somatic.mark_pon(cands, workflow(t).panel)


@query
def q_germline_posterior(t: Tables) -> DataFrame:
    cands = somatic.join_matched_normal(somatic.tumour_candidates(t.counts(), t.pairs()), t.counts())
    scored = somatic.germline_posterior(sites.annotate_germline(cands, t.germline()))
    return rounded(scored.select(*CALL, "af", "p_germline"), "af", "p_germline")


_CALL_VALUES = ["t_ref", "t_alt", "t_f1r2", "t_f2r1", "tlod", "n_ref", "n_alt", "nlod", "af", "in_pon", "p_germline"]


def _calls(df: DataFrame) -> DataFrame:
    return rounded(df.select(*CALL, *_CALL_VALUES), "tlod", "nlod", "af", "p_germline")


@query
def q_call_pairs(t: Tables) -> DataFrame:
    w = workflow(t)
    return _calls(somatic.call_pairs(w.counts, w.pairs, w.panel, w.germline))


@query
def q_call_mitochondria(t: Tables) -> DataFrame:
    w = workflow(t)
    return _calls(somatic.call_mitochondria(w.counts, w.pairs, w.panel, w.germline, MITO))


@query
def q_merge_branches(t: Tables) -> DataFrame:
    w = workflow(t)
    nuclear = somatic.call_pairs(regions.exclude_contig(w.counts, MITO), w.pairs, w.panel, w.germline)
    mito = somatic.call_mitochondria(w.counts, w.pairs, w.panel, w.germline, MITO)
    return rounded(
        somatic.merge_branches(t.dictionary(), nuclear, mito).select(*CALL, "idx", "tlod", "p_germline"),
        "tlod", "p_germline",
    )


@query
def q_merge_stats(t: Tables) -> DataFrame:
    return workflow(t).stats


# --- orientation -------------------------------------------------------------


@query
def q_f1r2_histogram(t: Tables) -> DataFrame:
    return orientation.f1r2_histogram(t.counts(), t.pairs(), t.contexts())


@query
def q_kmer_context(t: Tables) -> DataFrame:
    return t.contexts()


@query
def q_learn_orientation(t: Tables) -> DataFrame:
    return rounded(workflow(t).orientation, "prior")


@query
def q_orientation_posterior(t: Tables) -> DataFrame:
    w = workflow(t)
    cands = somatic.tumour_candidates(w.counts, w.pairs)
    scored = orientation.orientation_posterior(cands, w.orientation, w.contexts)
    return rounded(scored.select(*CALL, "p_orientation"), "p_orientation")


# --- contamination -----------------------------------------------------------


@query
def q_homalt_sites(t: Tables) -> DataFrame:
    return cont.homalt_sites(t.pileups())


@query
def q_het_sites(t: Tables) -> DataFrame:
    return cont.het_sites(t.pileups())


@query
def q_contamination(t: Tables) -> DataFrame:
    return rounded(workflow(t).contamination, "contamination", "error")


@query
def q_maf_segments(t: Tables) -> DataFrame:
    return rounded(workflow(t).segments, "maf")


@query
def q_maf_changepoints(t: Tables) -> DataFrame:
    cohort = workflow(t)
    return rounded(cont.maf_changepoints(cohort.pairs, t.pileups(), penalty=0.002), "maf")


# --- filtering ---------------------------------------------------------------


@query
def q_filter_evidence(t: Tables) -> DataFrame:
    values = ["n_calls", "callable", "contamination", "maf", "p_orientation"]
    return rounded(workflow(t, keep=True).evidence.select(*CALL, *values), *values[2:])


@query
def q_contamination_posterior(t: Tables) -> DataFrame:
    return rounded(
        filtering.contamination_posterior(workflow(t, keep=True).evidence).select(*CALL, "p_contamination"), "p_contamination"
    )


@query
def q_error_probability(t: Tables) -> DataFrame:
    scores = ["p_germline", "p_contamination", "p_orientation", "p_weak", "p_error"]
    return rounded(workflow(t, keep=True).scored.select(*CALL, *scores), *scores)


@query
def q_learn_threshold(t: Tables) -> DataFrame:
    return rounded(workflow(t, keep=True).thresholds, "threshold", "f_score")


@query
def q_apply_filters(t: Tables) -> DataFrame:
    judged = workflow(t, keep=True).filtered
    return judged.select(*CALL, F.concat_ws(",", "filters").alias("filters"), "n_near", "n_alleles")


@query
def q_filter_summary(t: Tables) -> DataFrame:
    return filtering.filter_summary(workflow(t, keep=True).filtered)


@query
def q_final_calls(t: Tables) -> DataFrame:
    final = filtering.final_calls(workflow(t, keep=True).filtered, t.dictionary())
    return rounded(final.select(*CALL, "idx", "t_ref", "t_alt", "tlod"), "tlod")


@query
def q_write_pair_variants(t: Tables) -> DataFrame:
    """Filtered calls as a folder of VCF text per pair, with genotypes, written and read back."""
    path = scratch_path(t.spark, "pairs")
    cohort = workflow(t, keep=True)
    writers.write_pair_variants(cohort.filtered, cohort.pairs, path, t.dictionary())
    rows = readers.explode_genotypes(readers.read_variants(t.spark, path, by_folder=True))
    return rows.select(
        "contig", "pos", "ref", F.concat_ws(",", "alts").alias("alt"), F.concat_ws(",", "filters").alias("filters"),
        "lab_id", F.col("fields")["GT"].alias("genotype"), F.col("fields")["AD"].alias("depths"),
    )


@query
def q_export_calls(t: Tables) -> DataFrame:
    """Filtered calls written as VCF text and read back."""
    path = scratch_path(t.spark, "filtered")
    writers.write_variants(writers.call_records(workflow(t, keep=True).filtered), path, t.dictionary())
    back = readers.read_variants(t.spark, path, one_header=True)
    info = F.col("info")
    return back.select(
        info["PAIR"].alias("pair"), "contig", "pos", "ref", F.concat_ws(",", "alts").alias("alt"),
        F.concat_ws(",", "filters").alias("filters"), info["TAD"].alias("tumour_depths"), info["NAD"].alias("normal_depths"),
        F.map_contains_key("info", "PON").alias("in_pon"),
    )


# --- completeness and run checks ---------------------------------------------


@query
def q_log_outcome(t: Tables) -> DataFrame:
    return qc.log_outcome(t.log_lines())


@query
def q_log_tail(t: Tables) -> DataFrame:
    """The end of each batch log: all lines of the tasks of one event kind."""
    lines = t.raw("events", "event_id", "event_type").selectExpr("event_type as task_id", "event_id as line_no")
    return qc.log_tail(lines)


@query
def q_log_head(t: Tables) -> DataFrame:
    lines = t.raw("events", "event_id", "event_type").selectExpr("event_type as task_id", "event_id as line_no")
    return qc.log_head(lines, 2)


@query
def q_first_match(t: Tables) -> DataFrame:
    return qc.first_match(t.log_lines(), "Elapsed time")


@query
def q_line_after(t: Tables) -> DataFrame:
    return qc.line_after(t.log_lines())


@query
def q_task_metrics(t: Tables) -> DataFrame:
    return rounded(qc.task_metrics(t.log_lines(), t.tasks()), "gb")


@query
def q_task_metrics_binary(t: Tables) -> DataFrame:
    return qc.task_metrics_binary(t.log_lines())


@query
def q_error_counts(t: Tables) -> DataFrame:
    return qc.error_counts(t.log_lines())


@query
def q_exit_status(t: Tables) -> DataFrame:
    return qc.exit_status(t.job_logs(), t.jobs())


@query
def q_missing_outputs(t: Tables) -> DataFrame:
    return qc.missing_outputs(t.tasks(), t.outputs(), KINDS)


@query
def q_rerun_set(t: Tables) -> DataFrame:
    grid = t.tasks()
    missing = qc.missing_outputs(grid, t.outputs(), KINDS)
    return qc.rerun_set(grid, missing, qc.incomplete_tasks(grid, qc.log_outcome(t.log_lines())))


@query
def q_run_summary(t: Tables) -> DataFrame:
    return qc.run_summary(t.tasks(), qc.log_outcome(t.log_lines()), "batch")


@query
def q_job_efficiency(t: Tables) -> DataFrame:
    return qc.job_efficiency(t.job_usage()).select("job", "efficiency", "service_units")


@query
def q_stage_scaling(t: Tables) -> DataFrame:
    return rounded(qc.stage_scaling(t.job_usage()), "wall_minutes", "speed_up", "cost_ratio", "efficiency")


# --- scalar functions --------------------------------------------------------


@query
def q_scalar_functions(t: Tables) -> DataFrame:
    """Every text function over the path and parameter row of each order's task."""
    row = t.raw("orders", "o_orderkey", "o_orderpriority").select(
        F.col("o_orderkey").alias("n"),
        F.concat(
            F.lit("../Calls/S"), (F.col("o_orderkey") % 100).cast("string"), F.lit("/part."), F.col("o_orderkey").cast("string"), F.lit(".vcf.gz")
        ).alias("path"),
        F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderpriority", F.lit("a;b")).alias("params"),
        F.col("o_orderpriority").alias("words"),
    )
    return row.select(
        "n",
        text.nth_field(F.col("params"), 2).alias("second"),
        text.nth_field(F.col("params"), 9).alias("ninth"),
        text.field_from_end(F.col("params"), 1, ",").alias("last"),
        text.base_name(F.col("path")).alias("base"),
        text.dir_name(F.col("path")).alias("folder"),
        text.strip_suffix(F.col("path"), ".vcf.gz").alias("stripped"),
        text.stem(F.col("path")).alias("stem"),
        text.zero_padded(F.col("n"), 4).alias("padded"),
        text.contains_ci(F.col("words"), "URGENT").alias("urgent"),
        text.captured(F.col("words"), r"^([12])-").alias("top"),
        text.swap_separator(text.field_from_end(F.col("params"), 1, ","), ";", "-").alias("swapped"),
    )


@query
def q_split_rows(t: Tables) -> DataFrame:
    params = t.raw("orders", "o_orderkey", "o_orderpriority").select(
        "o_orderkey", F.concat_ws(";", F.lit("x"), "o_orderpriority").alias("p")
    )
    return params.select("o_orderkey", text.split_rows(F.col("p")).alias("part"))
