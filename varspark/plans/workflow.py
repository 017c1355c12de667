"""The three stages of the cohort workflow over one set of tables."""

from __future__ import annotations

from functools import cached_property
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varspark.operators.contamination import contamination, maf_segments
from varspark.operators.filtering import apply_filters, error_probability, filter_evidence, learn_threshold
from varspark.operators.manifest import normal_samples, pair_tumour_normal, samples_of
from varspark.operators.orientation import f1r2_histogram, learn_orientation
from varspark.operators.pileup import callable_from_reads, callable_sites, cigar_blocks, usable_reads
from varspark.operators.pon import create_pon, normal_candidates
from varspark.operators.regions import assign_interval, exclude_contig, only_contig
from varspark.operators.somatic import MIN_TUMOUR_LOD, MIN_TUMOUR_LOD_MITO, call_genome, callable_stats, merge_stats
from varspark.session import removed, scratch_path, shuffles_removed


class CohortTables(Protocol):

    def manifest(self) -> DataFrame: ...

    def counts(self) -> DataFrame: ...

    def reads(self) -> DataFrame | None:
        """The reads that ``counts`` come from; None if counts are complete, with rows for loci that show the reference alone."""

    def germline(self) -> DataFrame: ...

    def pileups(self) -> DataFrame: ...

    def intervals(self) -> DataFrame: ...

    def contexts(self) -> DataFrame | None: ...


class Workflow:
    """Panel of normals, calls and filtered calls of one cohort.

    Stages are lazy. ``keep`` writes each stage that a later one reads, so that
    it is computed once and its size is known when it is joined.
    """

    def __init__(
        self, tables: CohortTables, *, mito: str = "chrM", run: int = 20, iterations: int = 10, keep: bool = True
    ):
        self.tables = tables
        self.mito, self.run, self.iterations = mito, run, iterations
        self.keep, self._paths = keep, []

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.keep:
            return df
        path = scratch_path(df.sparkSession, name)
        self._paths.append(path)
        with shuffles_removed(df.sparkSession):
            df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove the stages; frames that read them can not be used any more."""
        for path in self._paths:
            removed(self.samples.sparkSession, path)
        self._paths = []

    @property
    def nuclear(self) -> Column:
        return F.col("contig") != self.mito

    @cached_property
    def counts(self) -> DataFrame:
        return self.tables.counts()

    @cached_property
    def reads(self) -> DataFrame | None:
        return self.tables.reads()

    @cached_property
    def pileups(self) -> DataFrame:
        return self.tables.pileups()

    @cached_property
    def germline(self) -> DataFrame:
        return self.tables.germline()

    @cached_property
    def contexts(self) -> DataFrame | None:
        contexts = self.tables.contexts()
        return None if contexts is None else self._keep(contexts, "contexts")

    def prepare(self) -> Workflow:
        """Write all stages before scoring, one by one: the shuffle files of a stage go before the next begins."""
        for name in ("pairs", "contexts", "panel", "calls", "stats", "segments", "contamination", "orientation"):
            getattr(self, name)
        return self

    @cached_property
    def samples(self) -> DataFrame:
        return samples_of(self.tables.manifest())

    @cached_property
    def normals(self) -> DataFrame:
        return normal_samples(self.samples)

    @cached_property
    def pairs(self) -> DataFrame:
        return self._keep(pair_tumour_normal(self.samples), "pairs")

    @cached_property
    def panel(self) -> DataFrame:
        return self._keep(create_pon(normal_candidates(self.counts, self.normals), self.normals, self.germline), "panel")

    @cached_property
    def calls(self) -> DataFrame:
        return self._keep(
            call_genome(self.counts, self.pairs, self.panel, self.germline, self.mito, self.reads), "calls"
        )

    @cached_property
    def stats(self) -> DataFrame:
        """Callable loci; the mitochondrial contig is a part of its own, listed or not."""
        if self.reads is None:
            placed = assign_interval(exclude_contig(self.counts, self.mito), self.tables.intervals())
            mito = only_contig(self.counts, self.mito).withColumn("interval_id", F.lit(self.mito))
            loci = callable_sites(placed.unionByName(mito))
        else:
            mito = only_contig(self.reads, self.mito)
            span = cigar_blocks(usable_reads(mito)).groupBy("contig").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
            loci = callable_from_reads(exclude_contig(self.reads, self.mito), self.tables.intervals())
            loci = loci.unionByName(callable_from_reads(mito, span.withColumn("interval_id", F.lit(self.mito))))
        return self._keep(merge_stats(callable_stats(loci, self.pairs)), "stats")

    @cached_property
    def segments(self) -> DataFrame:
        return self._keep(maf_segments(self.pairs, self.pileups, run=self.run), "segments")

    @cached_property
    def contamination(self) -> DataFrame:
        return self._keep(contamination(self.pairs, self.pileups), "contamination")

    @cached_property
    def orientation(self) -> DataFrame:
        hist = f1r2_histogram(self.counts, self.pairs, self.contexts)
        return self._keep(learn_orientation(hist, self.iterations), "orientation")

    @cached_property
    def evidence(self) -> DataFrame:
        return filter_evidence(
            self.calls, self.stats, self.segments, self.contamination, self.orientation, self.contexts
        )

    @cached_property
    def scored(self) -> DataFrame:
        return self._keep(error_probability(self.evidence, self.nuclear), "scored")

    @cached_property
    def thresholds(self) -> DataFrame:
        return self._keep(learn_threshold(self.scored), "thresholds")

    @cached_property
    def filtered(self) -> DataFrame:
        least = F.when(self.nuclear, MIN_TUMOUR_LOD).otherwise(MIN_TUMOUR_LOD_MITO)
        return apply_filters(self.scored, self.thresholds, min_tumour_lod=least)
