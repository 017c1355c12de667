"""Reads to counts: usable reads, aligned blocks, pileups and allele counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.operators.reference import BLANK, CHUNK, chunk_of, reference_chunks
from varspark.operators.regions import bin_join, occupied_bins
from varspark.operators.skew import SALTS

# SAM flag bits.
UNMAPPED = 0x4
REVERSE = 0x10
FIRST_IN_PAIR = 0x40
SECOND_IN_PAIR = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800

UNUSABLE = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE | SUPPLEMENTARY
READ_BIN = 1024


def usable_reads(reads: DataFrame, min_mapq: int = 20, flag_mask: int = UNUSABLE) -> DataFrame:
    return reads.filter((F.col("flag").bitwiseAND(F.lit(flag_mask)) == 0) & (F.col("mapq") >= min_mapq))


def is_f1r2(flag: Column) -> Column:
    """First of pair on the forward strand, or second of pair on the reverse."""
    reverse = flag.bitwiseAND(F.lit(REVERSE)) != 0
    first = flag.bitwiseAND(F.lit(FIRST_IN_PAIR)) != 0
    second = flag.bitwiseAND(F.lit(SECOND_IN_PAIR)) != 0
    return (first & ~reverse) | (second & reverse)


def _cigar_steps(cigar: Column, pos: Column) -> Column:
    """CIGAR elements with the reference position and read offset (from 1) at which each starts."""
    lengths = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), 1)
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), 1)
    steps = F.zip_with(lengths, ops, lambda n, op: F.struct(n.cast("long").alias("n"), op.alias("op")))
    moves_ref = lambda s: F.when(s["op"].isin("M", "=", "X", "D", "N"), s["n"]).otherwise(F.lit(0))
    moves_read = lambda s: F.when(s["op"].isin("M", "=", "X", "I", "S"), s["n"]).otherwise(F.lit(0))
    none = F.expr("cast(array() as array<struct<op:string,n:bigint,ref_start:bigint,read_start:bigint>>)")
    start = F.struct(pos.cast("long").alias("ref"), F.lit(1).cast("long").alias("read"), none.alias("done"))

    def walk(acc: Column, step: Column) -> Column:
        here = F.struct(
            step["op"].alias("op"),
            step["n"].alias("n"),
            acc["ref"].alias("ref_start"),
            acc["read"].alias("read_start"),
        )
        return F.struct(
            (acc["ref"] + moves_ref(step)).alias("ref"),
            (acc["read"] + moves_read(step)).alias("read"),
            F.concat(acc["done"], F.array(here)).alias("done"),
        )

    return F.aggregate(steps, start, walk, lambda acc: acc["done"])


def _elements(reads: DataFrame, ops: tuple[str, ...]) -> DataFrame:
    wanted = F.filter(_cigar_steps(F.col("cigar"), F.col("pos")), lambda s: s["op"].isin(*ops))
    return reads.withColumn("_step", F.explode(wanted))


def cigar_blocks(reads: DataFrame) -> DataFrame:
    """One row per gap-free aligned block, with its own bases and qualities.

    ``start_pos`` and ``end_pos`` are on the reference, ``read_offset`` counts
    read bases from 1. Insertions and soft clips move the read only, deletions
    and skips the reference only, hard clips and padding neither.
    """
    step = F.col("_step")
    return _elements(reads, ("M", "=", "X")).select(
        *[c for c in reads.columns if c not in ("pos", "cigar", "seq", "qual", "mapq")],
        step["ref_start"].alias("start_pos"),
        (step["ref_start"] + step["n"] - 1).alias("end_pos"),
        step["read_start"].alias("read_offset"),
        F.substring(F.col("seq"), step["read_start"], step["n"]).alias("bases"),
        F.substring(F.col("qual"), step["read_start"], step["n"]).alias("quals"),
    )


def phred(quals: Column, place: Column) -> Column:
    return F.ascii(F.substring(quals, place, F.lit(1))) - 33


def pileup_summaries(
    reads: DataFrame, sites: DataFrame, min_baseq: int = 0, width: int = READ_BIN, salts: int = SALTS
) -> DataFrame:
    """Ref, alt and other base counts of each sample at biallelic SNV sites.

    ``sites`` (contig, pos, ref, alt, af) repeats per bin salt while the reads,
    by far the larger side, are shuffled once or, when Spark finds the sites
    small enough to broadcast, not at all. Blocks in bins without a site are
    dropped before that, by a bitmap of the sites' bins.
    """
    blocks = cigar_blocks(usable_reads(reads)).select(
        "lab_id", "contig", "start_pos", "end_pos", F.col("start_pos").alias("block_start"), "bases", "quals"
    )
    hits = bin_join(sites, blocks, width=width, heavy="spans", salts=salts, occupied=occupied_bins(sites, width))
    place = (F.col("pos") - F.col("block_start") + 1).cast("int")
    seen = hits.withColumn("base", F.substring(F.col("bases"), place, F.lit(1)))
    if min_baseq > 0:
        seen = seen.filter(phred(F.col("quals"), place) >= min_baseq)
    is_ref, is_alt = F.col("base") == F.col("ref"), F.col("base") == F.col("alt")
    return seen.groupBy("lab_id", "contig", "pos", "ref", "alt").agg(
        F.count_if(is_ref).alias("ref_count"),
        F.count_if(is_alt).alias("alt_count"),
        F.count_if(~is_ref & ~is_alt).alias("other_alt_count"),
        F.max("af").alias("af"),
    )


def gather_pileups(*parts: DataFrame) -> DataFrame:
    """All parts of all samples as one table; a sample is its exact id."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def _deleted_texts(usable: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """contig, pos, removed, text: the reference text of each deletion after ``pos``, where all of it is held.

    A second, light pass: of the reads it needs place and CIGAR only, and of those the ones with a deletion.
    """
    step = F.col("_step")
    shapes = (
        _elements(usable.filter(F.col("cigar").contains("D")).select("contig", "pos", "cigar"), ("D",))
        .select("contig", (step["ref_start"] - 1).alias("pos"), step["n"].alias("removed"))
        .distinct()
    )
    last = F.col("pos") + F.col("removed")
    parts = shapes.withColumn("chunk", F.explode(F.sequence(chunk_of(F.col("pos"), width), chunk_of(last, width)))).join(chunks, ["contig", "chunk"])
    low, high = F.greatest("pos", F.col("chunk") * width), F.least(last, F.col("chunk") * width + (width - 1))
    text = F.substring(F.col("bases"), (low - F.col("chunk") * width + 1).cast("int"), (high - low + 1).cast("int"))
    spelled = parts.groupBy("contig", "pos", "removed").agg(F.array_join(F.sort_array(F.collect_list(F.struct("chunk", text.alias("t"))))["t"], "").alias("text"))
    return spelled.filter((F.length("text") == F.col("removed") + 1) & ~F.contains("text", F.lit(BLANK)))


def _events(usable: DataFrame, chunks: DataFrame, min_baseq: int, width: int) -> DataFrame:
    """What reads show other than the reference, and where their coverage changes.

    An aligned block is cut at chunk ends and compared with its stretch of the reference inside the row. It
    gives a row per mismatch of enough quality (``seen``, a base), and a row wherever its coverage begins, ends, or changes between
    enough and too little quality (``seen`` null): ``step_all`` and ``step_good`` are what that adds to the depth from ``pos`` on.
    Insertions (``+`` and the bases) and deletions (``-`` and their number) lie at the base before them, as written in the read.
    """
    step = F.col("_step")
    aligned = step["op"].isin("M", "=", "X")
    start = F.when(aligned, step["ref_start"]).otherwise(step["ref_start"] - 1)
    end = F.when(aligned, step["ref_start"] + step["n"] - 1).otherwise(step["ref_start"] - 1)
    own = lambda text: F.substring(F.col(text), step["read_start"].cast("int"), F.when(step["op"] == "D", 0).otherwise(step["n"]).cast("int"))
    elements = _elements(usable, ("M", "=", "X", "I", "D")).select(
        "lab_id", "contig", is_f1r2(F.col("flag")).alias("f1r2"), aligned.alias("aligned"), step["n"].alias("n"), own("seq").alias("own"), own("qual").alias("quals"),
        start.alias("start"), end.alias("end"), F.explode(F.sequence(chunk_of(start, width), chunk_of(end, width))).alias("chunk"),
    )
    low = F.greatest("start", F.col("chunk") * width)
    size = (F.least("end", F.col("chunk") * width + (width - 1)) - low + 1).cast("int")
    skipped = (low - F.col("start") + 1).cast("int")
    # Qualities that are too low become one sign.
    few = "".join(chr(33 + k) for k in range(max(min_baseq, 1)))
    marks = F.translate("quals", few, "!" * len(few)) if min_baseq > 0 else F.lit("")
    stretch = F.rpad(F.substring(F.col("bases"), (low - F.col("chunk") * width + 1).cast("int"), size), size, F.lit(BLANK))
    met = elements.join(chunks, ["contig", "chunk"]).select(
        "lab_id", "contig", "chunk", "f1r2", "aligned", "n", "own", low.alias("low"), size.alias("size"), stretch.alias("ref"),
        F.substring(F.col("own"), skipped, size).alias("shown"), F.substring(marks, skipped, size).alias("marks"),
    )
    # A list of signs is read by place at once; a text would be walked from its begin for each.
    met = met.withColumns({f"{c}_signs": F.split(c, "") for c in ("shown", "ref", *(["marks"] if min_baseq > 0 else []))})
    sign = lambda text, i: F.get(F.col(f"{text}_signs"), i - 1)
    good = lambda i: (sign("marks", i) != "!") if min_baseq > 0 else F.lit(True)
    event = lambda i, seen, ref, all_, good_: F.struct(
        (F.col("low") + i - 1).alias("pos"), seen.alias("seen"), ref.alias("ref"), all_.cast("int").alias("step_all"), good_.cast("int").alias("step_good")
    )
    none, zero = F.lit(None).cast("string"), F.lit(0)
    differs = lambda i: (sign("shown", i) != sign("ref", i)) & (sign("ref", i) != BLANK) & good(i)
    places = F.sequence(F.lit(1), F.col("size"))
    alts = F.when(F.col("shown") == F.col("ref"), F.array().cast("array<int>")).otherwise(F.filter(places, differs))
    covers = lambda i: (i >= 1) & (i <= F.col("size"))
    is_good = lambda i: covers(i) & good(i)
    if min_baseq > 0:
        changes = F.filter(F.sequence(F.lit(1), F.col("size") + 1), lambda i: (i == 1) | (i > F.col("size")) | (is_good(i) != is_good(i - 1)))
    else:
        changes = F.array(F.lit(1), F.col("size") + 1)
    # Coverage that goes on beyond the chunk needs no end there.
    inside = F.filter(changes, lambda i: F.col("low") + i - 1 < (F.col("chunk") + 1) * width)
    delta = lambda f, i: f(i).cast("int") - f(i - 1).cast("int")
    shown = F.concat(
        F.transform(alts, lambda i: event(i, sign("shown", i), sign("ref", i), zero, zero)),
        F.transform(inside, lambda i: event(i, none, none, delta(covers, i), delta(is_good, i))),
    )
    indel = F.when(F.length("own") > 0, F.concat(F.lit("+"), F.col("own"))).otherwise(F.concat(F.lit("-"), F.col("n").cast("string")))
    at_base = F.when(F.col("ref") != BLANK, F.array(event(F.lit(1), indel, F.col("ref"), zero, zero))).otherwise(F.array().cast("array<struct<pos:bigint,seen:string,ref:string,step_all:int,step_good:int>>"))
    events = met.select("lab_id", "contig", "chunk", "f1r2", F.explode(F.when(F.col("aligned"), shown).otherwise(at_base)).alias("e"))
    return events.groupBy("lab_id", "contig", "chunk", "e.pos", "e.seen").agg(
        F.max("e.ref").alias("ref"), F.count("*").alias("n"), F.count_if("f1r2").alias("f"), F.sum("e.step_all").alias("step_all"), F.sum("e.step_good").alias("step_good")
    )


def allele_counts(reads: DataFrame, ref_bases: DataFrame, min_baseq: int = 0, width: int = CHUNK) -> DataFrame:
    """Counts of every non-reference allele per sample: SNVs from blocks, indels from I and D.

    ``ref_bases`` (contig, pos, base) bounds the loci: a position it does not
    hold is not counted, nor is a deletion that leaves it. It is packed into chunks; blocks are compared inside the row, and
    only mismatches, indels and changes of coverage become rows, counted per sample and position before they are shuffled. Depth is
    the running sum of the changes within a sample's chunk, to which blocks are cut, so nothing is carried from one to the next.
    Reference reads are the depth less the mismatches. Indels are as written in the reads (``normalise_indels`` moves them).
    """
    usable = usable_reads(reads)
    chunks = reference_chunks(ref_bases, width)
    seen = F.col("seen")
    inserted, removed = seen.startswith("+"), seen.startswith("-")
    indel = inserted | removed
    rest = F.substring(seen, F.lit(2), F.length(seen))
    along = Window.partitionBy("lab_id", "contig", "chunk").orderBy("pos")  # rows of one position count together
    locus = Window.partitionBy("lab_id", "contig", "chunk", "pos")
    loci = (
        _events(usable, chunks, min_baseq, width)
        .withColumn("deep", F.sum("step_all").over(along))
        .withColumn("deep_good", F.sum("step_good").over(along))
        .withColumn("n_snv", F.sum(F.when(seen.isNotNull() & ~indel, F.col("n")).otherwise(0)).over(locus))
        .withColumn("n_indel", F.sum(F.when(indel, F.col("n")).otherwise(0)).over(locus))
        .filter(seen.isNotNull())
        .withColumn("ref_count", F.when(indel, F.greatest(F.col("deep") - F.col("n_indel"), F.lit(0))).otherwise(F.col("deep_good") - F.col("n_snv")))
        .withColumn("removed", F.when(removed, rest.cast("long")))
    )
    spelled = loci.join(_deleted_texts(usable, chunks, width), ["contig", "pos", "removed"], "left").filter(~removed | F.col("text").isNotNull())
    return spelled.select(
        "lab_id",
        "contig",
        "pos",
        F.when(removed, F.col("text")).otherwise(F.col("ref")).alias("ref"),
        F.when(removed, F.col("ref")).when(inserted, F.concat("ref", rest)).otherwise(seen).alias("alt"),
        "ref_count",
        F.col("n").alias("alt_count"),
        F.col("f").alias("alt_f1r2"),
        (F.col("n") - F.col("f")).alias("alt_f2r1"),
    )


def callable_sites(counts: DataFrame, min_depth: int = 10) -> DataFrame:
    """Loci per sample and interval that are deep enough to call.

    ``counts`` carries ``interval_id``; alleles of one locus count once.
    """
    loci = counts.groupBy("lab_id", "interval_id", "contig", "pos").agg(
        F.max(F.col("ref_count") + F.col("alt_count")).alias("depth")
    )
    return loci.filter(F.col("depth") >= min_depth).groupBy("lab_id", "interval_id").agg(
        F.count("*").alias("callable")
    )


def reference_depths(reads: DataFrame, loci: DataFrame, min_baseq: int = 0) -> DataFrame:
    """Reads that show the reference base at given loci of given samples: lab_id, contig, pos, ref_count.

    ``loci`` has a site (contig, pos, ref, alt) and lab_id; without lab_id, each locus is meant for every sample that covers it,
    and samples come from the blocks, not from a product of samples and loci. Only these loci are read
    off the blocks, so what grows with the genome is the scan alone. An indel's base is the first of its reference text.
    """
    by = [c for c in ("lab_id", "contig") if c in loci.columns]
    wanted = loci.select(*by, "pos", F.substring("ref", 1, 1).alias("ref")).distinct()
    blocks = cigar_blocks(usable_reads(reads)).select(
        F.col("lab_id"), "contig", "start_pos", "end_pos", F.col("start_pos").alias("block_start"), "bases", "quals"
    )
    hits = bin_join(wanted, blocks, width=READ_BIN, by=by, heavy="spans")
    place = (F.col("pos") - F.col("block_start") + 1).cast("int")
    shows = F.substring(F.col("bases"), place, F.lit(1)) == F.col("ref")
    if min_baseq > 0:
        shows = shows & (phred(F.col("quals"), place) >= min_baseq)
    return hits.groupBy("lab_id", "contig", "pos").agg(F.count_if(shows).alias("ref_count"))


def callable_from_reads(reads: DataFrame, intervals: DataFrame, min_depth: int = 10, width: int = 1 << 20) -> DataFrame:
    """Positions per sample and interval that at least ``min_depth`` usable reads cover: lab_id, interval_id, callable.

    Depth changes only where a block begins or ends. Blocks are clipped to the
    intervals they touch, their ends are summed per place, and a window adds them up
    within one sample and interval; no row per base is made.
    """
    listed = lambda start, end: F.explode(F.sequence(F.floor(F.col(start) / width).cast("long"), F.floor(F.col(end) / width).cast("long")))
    blocks = cigar_blocks(usable_reads(reads)).select("lab_id", "contig", "start_pos", "end_pos")
    blocks = blocks.withColumn("_bin", listed("start_pos", "end_pos"))
    spans = intervals.select("interval_id", "contig", F.col("start_pos").alias("_a"), F.col("end_pos").alias("_b"))
    spans = spans.withColumn("_bin", listed("_a", "_b"))
    # A block and an interval meet in the first bin that both touch.
    first = F.floor(F.greatest("start_pos", "_a") / width).cast("long") == F.col("_bin")
    met = blocks.join(spans, ["contig", "_bin"]).filter(first & (F.col("start_pos") <= F.col("_b")) & (F.col("end_pos") >= F.col("_a")))
    edges = F.array(
        F.struct(F.greatest("start_pos", "_a").alias("pos"), F.lit(1).alias("step")),
        F.struct((F.least("end_pos", "_b") + 1).alias("pos"), F.lit(-1).alias("step")),
    )
    steps = met.select("lab_id", "interval_id", F.explode(edges).alias("e")).groupBy("lab_id", "interval_id", "e.pos").agg(F.sum("e.step").alias("step"))
    along = Window.partitionBy("lab_id", "interval_id").orderBy("pos")
    runs = steps.withColumn("depth", F.sum("step").over(along)).withColumn("length", F.lead("pos").over(along) - F.col("pos"))
    return runs.filter(F.col("depth") >= min_depth).groupBy("lab_id", "interval_id").agg(F.sum("length").alias("callable"))
