"""Text formats of the workflow as typed tables.

Key columns that a path carries are taken from the path of each row's file.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varspark import schemas
from varspark.functions.text import base_name, captured
from varspark.operators.ordered import row_index, running_total
from varspark.session import held

# Path layouts that carry a key, as the first group.
INTERVAL_FILE = r"([^/]+)-scattered\.interval_list$"
PILEUP_FILE = r"([^/]+?)_pileups(?:\.[^/]*)?\.table$"
SAMPLE_FILE = r"([^/.]+)\.[^/]*$"
TASK_FILE = r"([^/]+)\.(?:log|oe|o|e)$"
JOB_LOG = r"([^/]+)\.o$"
JOB_STDERR = r"([^/]+)\.e$"

#: Bytes of a file whose rows meet one copy of its header, and copies of a folder's header.
STRETCH = 1 << 27
FOLDER_SHARES = 64


def _file_path() -> Column:
    """Path of the row's file as it is named: the metadata column is a URI, with signs encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows of text with the path of their file."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("value").alias("line"), _file_path().alias("path")
    )


def _listed_text(spark: SparkSession, path: str) -> DataFrame:
    """Text below a path, listed by a few tasks per core; Spark would start one per folder."""
    tasks = 16 * spark.sparkContext.defaultParallelism
    with held(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks)):
        return spark.read.option("recursiveFileLookup", "true").text(path)


def _packed(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows``, read from ``files``: small files are put together in a task until it has the bytes of a split."""
    context = rows.sparkSession.sparkContext
    size = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(rows.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    enough = max(-(-size // split), 4 * context.defaultParallelism)
    return rows.coalesce(enough) if enough < files._jdf.queryExecution().toRdd().getNumPartitions() else rows


def _fields(df: DataFrame, sep: str = "\t") -> DataFrame:
    return df.withColumn("f", F.split("line", sep))


def _at(n: int) -> Column:
    """The n-th field, NULL if the row is short."""
    return F.try_element_at("f", F.lit(n))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Sample manifest; header, comments and blank lines dropped, library 1 unless given, NULL if it is no number."""
    lines = _lines(spark, path).filter((F.trim("line") != "") & ~F.col("line").startswith("#"))
    return (
        lines.withColumn("f", F.split(F.trim("line"), r"\s+"))
        .select(
            _at(1).alias("sample_id"),
            _at(2).alias("lab_id"),
            _at(3).alias("seq_centre"),
            F.when(F.coalesce(_at(4), F.lit("")) == "", F.lit(1)).otherwise(_at(4).try_cast("int")).alias("library"),
        )
        .to(schemas.MANIFEST)
    )


def read_intervals(spark: SparkSession, path: str, interval: str = INTERVAL_FILE) -> DataFrame:
    """Interval lists; the id comes from the path, ``@`` header lines are dropped."""
    rows = _fields(_lines(spark, path).filter(~F.col("line").startswith("@")))
    return rows.select(
        captured(F.col("path"), interval).alias("interval_id"),
        _at(1).alias("contig"),
        _at(2).cast("long").alias("start_pos"),
        _at(3).cast("long").alias("end_pos"),
    ).filter(F.col("interval_id").isNotNull())


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED regions as written: 0-based, half-open."""
    rows = _fields(_lines(spark, path).filter(~F.col("line").rlike(r"^(#|track|browser|\s*$)")))
    return rows.select(_at(1).alias("contig"), _at(2).cast("long").alias("bed_start"), _at(3).cast("long").alias("bed_end"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Contig dictionary; ``idx`` is the place of the contig among the ``@SQ`` lines, from 0."""
    rows = _numbered(spark, path, F.lit("dictionary")).filter(F.col("line").startswith("@SQ"))
    named = rows.select(
        "line_no",
        F.regexp_extract("line", r"\tSN:([^\t]+)", 1).alias("contig"),
        F.regexp_extract("line", r"\tLN:(\d+)", 1).cast("long").alias("length"),
    )
    return row_index(named, "idx", order=["line_no"]).select("contig", "idx", "length")


def _sample_names(line: Column) -> Column:
    fields = F.split(line, "\t")
    return F.slice(fields, F.lit(10), F.greatest(F.size(fields) - 9, F.lit(0)))


def _with_samples(rows: DataFrame, head: DataFrame) -> DataFrame:
    """Rows beside the sample names of the header of their file.

    The header is repeated per stretch of its file, and rows meet the
    copy of their own: a row's key is a stretch of one file, however long the file is.
    """
    parts = F.sequence(F.lit(0).cast("long"), F.floor(F.max("size") / F.lit(STRETCH)).cast("long"))
    named = head.groupBy("owner").agg(F.min("samples").alias("samples"), parts.alias("_parts"))
    listed = named.select("owner", "samples", F.explode("_parts").alias("_part"))
    return rows.withColumn("_part", F.floor(F.col("at") / F.lit(STRETCH)).cast("long")).join(listed, ["owner", "_part"], "left")


def _with_folder_samples(lines: DataFrame) -> DataFrame:
    """Rows beside the sample names of the header among the parts of their folder.

    The header is repeated per share of the folder's splits. Headers and rows meet in one window, so that
    each file is opened once; folders may have a file of a few rows each.
    """
    line, is_head = F.col("line"), F.col("line").startswith("#CHROM")
    kept = lines.filter(is_head | (~line.startswith("#") & (line != "")))
    shares = F.when(is_head, F.sequence(F.lit(0), F.lit(FOLDER_SHARES - 1))).otherwise(F.array(F.pmod(F.hash("path", "at"), F.lit(FOLDER_SHARES))))
    spread = kept.select(
        "owner", F.when(~is_head, line).alias("line"), F.when(is_head, _sample_names(line)).alias("samples"), F.explode(shares).alias("_part")
    )
    return spread.withColumn("samples", F.min("samples").over(Window.partitionBy("owner", "_part"))).filter(line.isNotNull())


def read_variants(spark: SparkSession, path: str, one_header: bool = False, by_folder: bool = False) -> DataFrame:
    """VCF text, plain or gzip, as typed rows.

    ``alts`` and ``filters`` are arrays (missing: empty), ``info`` is a map with
    NULL for flags, ``genotypes`` is an array of (sample, fields). Sample names
    come from the header of the row's own file, with ``by_folder`` from the header
    among the parts of its folder, or, with ``one_header``, from the one header of
    a table written in parts. Rows without a header have no genotypes.
    """
    owner = F.regexp_replace("path", "/[^/]*$", "") if by_folder else F.col("path")
    files = _listed_text(spark, path)
    lines = files.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("at"), F.col("_metadata.file_size").alias("size"),
    )
    lines = _packed(lines, files).withColumn("owner", owner)
    if by_folder and not one_header:
        named = _fields(_with_folder_samples(lines))
    else:
        head = lines.filter(F.col("line").startswith("#CHROM")).select("owner", "size", _sample_names(F.col("line")).alias("samples"))
        rows = _fields(lines.filter(~F.col("line").startswith("#") & (F.col("line") != "")))
        named = rows.withColumn("samples", head.agg(F.first("samples").alias("samples")).scalar()) if one_header else _with_samples(rows, head)
    empty = F.array().cast("array<string>")
    info = F.when(_at(8) == ".", F.create_map().cast("map<string,string>")).otherwise(
        F.str_to_map(_at(8), F.lit(";"), F.lit("="))
    )
    keys = F.split(_at(9), ":")

    def genotype(sample: Column, i: Column) -> Column:
        values = F.split(F.try_element_at("f", i + 10), ":")
        return F.struct(
            sample.alias("sample"), F.map_from_arrays(F.slice(keys, F.lit(1), F.size(values)), values).alias("fields")
        )

    known = F.coalesce("samples", empty)
    return named.select(
        _at(1).alias("contig"),
        _at(2).cast("long").alias("pos"),
        F.when(_at(3) != ".", _at(3)).alias("id"),
        _at(4).alias("ref"),
        F.when(_at(5) == ".", empty).otherwise(F.split(_at(5), ",")).alias("alts"),
        F.when(_at(6) != ".", _at(6)).cast("double").alias("qual"),
        F.when(_at(7).isin(".", "PASS"), empty).otherwise(F.split(_at(7), ";")).alias("filters"),
        info.alias("info"),
        F.transform(known, genotype).alias("genotypes"),
    )


def explode_genotypes(variants: DataFrame) -> DataFrame:
    """One row per variant and sample."""
    rest = [c for c in variants.columns if c != "genotypes"]
    return variants.select(*rest, F.explode("genotypes").alias("_g")).select(
        *rest, F.col("_g.sample").alias("lab_id"), F.col("_g.fields").alias("fields")
    )


def read_reads(spark: SparkSession, path: str, form: str = "sam", sample: str = SAMPLE_FILE) -> DataFrame:
    """Aligned reads from SAM text, with the sample id in the path, or from Parquet."""
    if form == "parquet":
        return spark.read.schema(schemas.READS).parquet(path)
    rows = _fields(_lines(spark, path).filter(~F.col("line").startswith("@")))
    return rows.select(
        captured(F.col("path"), sample).alias("lab_id"),
        _at(1).alias("read_id"),
        _at(2).cast("int").alias("flag"),
        _at(3).alias("contig"),
        _at(4).cast("long").alias("pos"),
        _at(5).cast("int").alias("mapq"),
        _at(6).alias("cigar"),
        _at(10).alias("seq"),
        _at(11).alias("qual"),
    )


def read_pileups(spark: SparkSession, path: str, sample: str = PILEUP_FILE) -> DataFrame:
    """Pileup tables of all samples without their header lines; the sample id is matched whole."""
    data = ~F.col("line").startswith("#") & ~F.col("line").startswith("contig\t")
    rows = _fields(_lines(spark, path).filter(data & (F.col("line") != "")))
    return rows.select(
        captured(F.col("path"), sample).alias("lab_id"),
        _at(1).alias("contig"),
        _at(2).cast("long").alias("pos"),
        _at(3).cast("long").alias("ref_count"),
        _at(4).cast("long").alias("alt_count"),
        _at(5).cast("long").alias("other_alt_count"),
        _at(6).cast("double").alias("af"),
    )


def _numbered(spark: SparkSession, path: str, task: Column) -> DataFrame:
    """Lines numbered from 1 within ``task``, over its files in name order.

    A long file is read in several splits. Lines are numbered inside their
    split, and the small table of split sizes gives each split the number of
    lines before it.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select(
            _file_path().alias("path"),
            F.col("_metadata.file_block_start").alias("at"),
            F.monotonically_increasing_id().alias("row"),
            F.col("value").alias("line"),
        )
        .withColumn("task_id", task)
    )
    splits = rows.groupBy("task_id", "path", "at").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("task_id").orderBy("path", "at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("path", "at", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(offsets, ["path", "at"]).select(
        "task_id", (F.col("before") + F.col("row") - F.col("first") + 1).alias("line_no"), "line"
    )


def read_logs(spark: SparkSession, path: str, task: str = TASK_FILE) -> DataFrame:
    """Log lines with their task id, from the path, and their number in the log."""
    return _numbered(spark, path, captured(F.col("path"), task))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """Reference sequence from FASTA text: a row per line, with its contig and first position (from 1), bases in upper case.

    A line's contig is the last header before it and its place the length of the contig's
    lines so far; both are running sums in blocks, so a long contig is not one task.
    """
    rows = _numbered(spark, path, F.lit("reference"))
    is_head = F.col("line").startswith(">")
    named = running_total(rows, is_head.cast("long"), "_section", order=["line_no"])
    heads = named.filter(is_head).select("_section", F.regexp_extract("line", r"^>\s*(\S+)", 1).alias("contig"))
    body = named.filter(~is_head).withColumn("bases", F.upper(F.trim("line"))).filter(F.col("bases") != "").join(heads, "_section")
    placed = running_total(body, F.length("bases"), "_until", order=["line_no"], keys=["contig"])
    return placed.select("contig", (F.col("_until") - F.length("bases") + 1).alias("start_pos"), "bases")


def single_bases(reference: DataFrame) -> DataFrame:
    """The sequence as (contig, pos, base)."""
    return reference.select("contig", "start_pos", F.posexplode(F.split("bases", "")).alias("_i", "base")).select(
        "contig", (F.col("start_pos") + F.col("_i")).alias("pos"), "base"
    )


def list_outputs(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with their sizes, empty ones too; contents are not read.

    A scan skips empty files, so they are those of the source's file index that the scan does not show. The index is
    made by Spark, in parallel for many folders, and held by the driver for any scan; the names in it are all that is taken from there.
    """
    source = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    shown = source.select("path", "length")
    # A name in the index is a URI; the path column of a scan is not, and has no empty host.
    plain = lambda uri: unquote(uri).replace(":///", ":/", 1)
    names = spark.createDataFrame([(plain(u), 0) for u in source.inputFiles()], "path string, length bigint")
    return shown.unionByName(names.join(shown, "path", "left_anti"))


def read_job_logs(spark: SparkSession, path: str, log: str = JOB_LOG, stderr: str = JOB_STDERR) -> DataFrame:
    """Lines of job logs beside what each job wrote to stderr: job_id, line, stderr.

    ``stderr`` is the first line of the job's stderr file, a blank for a file that begins with an empty line, '' for an
    empty file and NULL where there is none. The job id comes from both paths, which may lie anywhere below ``path``.
    """
    lines = _lines(spark, path)
    jobs = lines.withColumn("job_id", captured(F.col("path"), log)).filter(F.col("job_id").isNotNull())
    errors = list_outputs(spark, path).select(captured(F.col("path"), stderr).alias("job_id"), "length").filter(F.col("job_id").isNotNull())
    first = _numbered(spark, path, captured(F.col("path"), stderr)).filter(F.col("task_id").isNotNull() & (F.col("line_no") == 1))
    text = first.select(F.col("task_id").alias("job_id"), F.when(F.col("line") == "", " ").otherwise(F.col("line")).alias("_first"))
    said = errors.groupBy("job_id").agg(F.sum("length").alias("length")).join(text, "job_id", "left")
    said = said.select("job_id", F.when(F.col("length") == 0, "").otherwise(F.coalesce("_first", F.lit(" "))).alias("stderr"))
    return jobs.select("job_id", "line").join(said, "job_id", "left")


def output_kind(path: Column) -> Column:
    """Kind of an output by its ending."""
    name = base_name(path)
    return (
        F.when(name.endswith(".tbi") | name.endswith(".idx"), "tbi")
        .when(name.endswith(".stats"), "stats")
        .when(name.rlike(r"\.f1r2\..*tar\.gz$"), "f1r2")
        .when(name.rlike(r"\.vcf(\.gz)?$"), "vcf")
        .when(name.rlike(r"\.(log|oe)$"), "log")
    )


__all__ = [
    "read_manifest",
    "read_intervals",
    "read_bed",
    "read_contigs",
    "read_variants",
    "explode_genotypes",
    "read_reads",
    "read_pileups",
    "read_logs",
    "read_reference",
    "single_bases",
    "list_outputs",
    "read_job_logs",
    "output_kind",
]
