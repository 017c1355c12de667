"""Partitioned tables and text exports."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator, Sequence
from contextlib import suppress
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.session import removed, shuffles_removed


# Header lines of a table with genotypes.
GENOTYPE_HEADER = (
    "##fileformat=VCFv4.2",
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Reads of each allele">',
)

#: Rows that a folder counts as when rows are dealt to tasks: to open it takes about as long as to write them.
FOLDER_ROWS = 32
#: Signs that Spark does not leave in the name of a partition's folder.
ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"])


def write_table(df: DataFrame, path: str, by: str = "interval_id", order: Sequence[str] = ("contig", "pos"), mode: str = "overwrite") -> None:
    """Store keyed by ``by`` and sorted inside, so that both prune on reading.

    Ranges run over key and order together: an interval that holds most of the
    rows becomes several files instead of one long task.
    """
    keys = [by, *order]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).partitionBy(by).parquet(path)


def split_resource(sites: DataFrame, intervals: DataFrame, path: str) -> None:
    """Site resource as one folder per interval."""
    from varspark.operators.regions import assign_interval

    write_table(assign_interval(sites, intervals), path)


def _info_text(info: Column) -> Column:
    entries = F.transform(
        F.sort_array(F.map_entries(info)),
        lambda e: F.when(e["value"].isNull(), e["key"]).otherwise(F.concat(e["key"], F.lit("="), e["value"])),
    )
    text = F.array_join(entries, ";")
    return F.when(info.isNull() | (F.size(info) == 0), ".").otherwise(text)


def _listed(items: Column, sep: str, none: str) -> Column:
    return F.when(F.size(items) > 0, F.array_join(items, sep)).otherwise(F.lit(none))


def write_variants(
    df: DataFrame, path: str, contigs: DataFrame, meta: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Sites-only VCF text, gzip, in dictionary order over its parts.

    The header is a part of its own ahead of the data; gzip parts can be
    concatenated. Ties are ordered by their text, so a site with many rows may
    span parts. ``df`` has contig, pos, ref, alts, filters and info.
    """
    spark = df.sparkSession
    fixed = ["##fileformat=VCFv4.2", *meta]
    columns = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"])
    described = contigs.select(
        F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), F.col("length").cast("string"), F.lit(">")).alias("value"),
        (F.col("idx") + len(fixed)).alias("at"),
    )
    ends = spark.createDataFrame(
        [(line, i) for i, line in enumerate(fixed)] + [(columns, 2**62)], "value string, at bigint"
    )
    header = ends.unionByName(described).coalesce(1).sortWithinPartitions("at").select("value")
    body = (
        df.join(contigs.select("contig", "idx"), "contig", "left")
        .select(
            F.coalesce("idx", F.lit(2**62)).alias("idx"),  # contigs the dictionary lacks come last
            "contig",
            "pos",
            "ref",
            F.concat_ws(
                "\t",
                "contig",
                F.col("pos").cast("string"),
                F.lit("."),
                "ref",
                _listed(F.col("alts"), ",", "."),
                F.lit("."),
                _listed(F.col("filters"), ";", "PASS"),
                _info_text(F.col("info")),
            ).alias("value"),
        )
        .repartitionByRange("idx", "contig", "pos", "ref", "value")
        .sortWithinPartitions("idx", "contig", "pos", "ref", "value")
        .select("value")
    )
    header.union(body).write.mode(mode).option("compression", "gzip").text(path)


def _infos(**entries: Column) -> Column:
    """INFO map; an entry that is NULL is left out."""
    pairs = [F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in entries.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["v"].isNotNull()))


def _number(column: str, places: int = 4) -> Column:
    return F.round(column, places).cast("string")


def panel_records(panel: DataFrame) -> DataFrame:
    """Panel of normals in the form ``write_variants`` takes."""
    info = _infos(
        SEEN=F.col("n_seen").cast("string"),
        SHARE=_number("share_of_normals"),
        MEAN=_number("mean_fraction"),
        ALPHA=_number("beta_alpha"),
        BETA=_number("beta_beta"),
    )
    none = F.array().cast("array<string>")
    return panel.select("contig", "pos", "ref", F.array("alt").alias("alts"), none.alias("filters"), info.alias("info"))


def call_records(calls: DataFrame) -> DataFrame:
    """Filtered calls in the form ``write_variants`` takes; the pair is an INFO entry."""
    depths = lambda r, a: F.concat_ws(",", F.col(r).cast("string"), F.col(a).cast("string"))
    info = _infos(
        PAIR=F.col("pair"),
        TLOD=_number("tlod"),
        NLOD=_number("nlod"),
        TAD=depths("t_ref", "t_alt"),
        NAD=depths("n_ref", "n_alt"),
        POPAF=F.col("af").cast("string"),
        PERR=_number("p_error", 6),
    )
    marked = F.when(F.col("in_pon"), F.map_concat(info, F.create_map(F.lit("PON"), F.lit(None).cast("string"))))
    return calls.select(
        "contig", "pos", "ref", F.array("alt").alias("alts"), "filters", F.coalesce(marked, info).alias("info")
    )


def folder_of(key: str, value: str | None) -> str:
    """Folder of a partition as Spark names it."""
    name = "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value or "")
    return f"{key}={name or '__HIVE_DEFAULT_PARTITION__'}"


def _mounted(spark: SparkSession, path: str) -> str | None:
    """``path`` in the file system of the machines, or None if it is in another store."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _write_mounted(rows: DataFrame, path: str, local: str) -> None:
    """``rows`` (key, value) as gzip text, a folder per key, like Spark's writer below a path of the machines' file system.

    For each folder and file there Spark's writer starts a process that sets the mode; here the tasks open the files themselves. Files are
    written aside, and the whole appears under ``path`` at once, so that a task that is run again or a run that fails leaves no half.
    """
    spark, key = rows.sparkSession, rows.columns[0]
    jvm, run = spark.sparkContext._jvm, uuid.uuid4().hex
    aside = f"{os.path.dirname(local)}/.{os.path.basename(local)}-{run}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, own = f"part-{task.partitionId():05d}-{run}.txt.gz", f"{aside}/_attempts/{task.taskAttemptId()}"
        os.makedirs(f"{aside}/_attempts", exist_ok=True)
        folder = text = packer = None

        def close() -> None:
            if folder is not None:
                text.write(packer.flush())
                text.close()
                with suppress(FileExistsError):
                    os.mkdir(f"{aside}/{folder}")
                os.replace(own, f"{aside}/{folder}/{part}")

        for batch in batches:
            for value, lines in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), itemgetter(0)):
                if folder != folder_of(key, value):
                    close()
                    folder, text, packer = folder_of(key, value), open(own, "wb"), zlib.compressobj(wbits=31)
                text.write(packer.compress("".join(f"{line or ''}\n" for _, line in lines).encode()))
        close()
        yield from ()

    target, hidden = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path("file", "", aside)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        fs.mkdirs(hidden)
        with shuffles_removed(spark):
            rows.mapInArrow(write, "done boolean").write.format("noop").mode("overwrite").save()
        fs.delete(jvm.org.apache.hadoop.fs.Path(hidden, "_attempts"), True)
        fs.create(jvm.org.apache.hadoop.fs.Path(hidden, "_SUCCESS")).close()
        removed(spark, path)
        if not fs.rename(hidden, target):
            raise OSError(f"{aside} could not be moved to {path}")
    except BaseException:
        fs.delete(hidden, True)
        raise


def write_pair_variants(calls: DataFrame, pairs: DataFrame, path: str, contigs: DataFrame, mode: str = "overwrite") -> None:
    """Filtered calls as VCF text, gzip, a folder per pair with the genotypes of its normal and tumour.

    All pairs are written in one pass. The parts of a folder follow each other in dictionary order and the
    first begins with the header, so that put together in name order they are the pair's file; a pair with many calls has several, so none is one
    long task. A pair without calls is a header alone. ``calls`` has pair, contig, pos, ref, alt, filters and the counts
    ``t_ref t_alt n_ref n_alt``; ``read_variants(..., by_folder=True)`` reads the folders back.
    Tasks get ranges of pairs with about as many rows, of which a folder counts as ``FOLDER_ROWS`` more: many pairs without calls are dealt out as well.
    """
    spark = calls.sparkSession
    described = contigs.select("idx", F.concat(F.lit("##contig=<ID="), "contig", F.lit(",length="), F.col("length").cast("string"), F.lit(">")).alias("line"))
    listed = described.agg(F.array_join(F.sort_array(F.collect_list(F.struct("idx", "line")))["line"], "\n").alias("lines")).scalar()
    columns = F.concat_ws("\t", F.lit("\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split())), "normal_id", "tumour_id")
    # Kinds of rows: weight alone, header, record.
    kinds = F.explode(F.concat(F.array(F.lit(0)), F.array_repeat(F.lit(-1), FOLDER_ROWS))).alias("kind")
    heads = pairs.select("pair", "normal_id", "tumour_id").distinct().select("pair", "normal_id", "tumour_id", kinds).select(
        "pair", "kind", F.lit(-1).cast("long").alias("idx"), F.lit("").alias("contig"), F.lit(0).cast("long").alias("pos"),
        F.when(F.col("kind") == 0, columns).alias("value"),
    )
    sample = lambda called, ref, alt: F.concat(F.lit(f"{called}:"), F.col(ref).cast("string"), F.lit(","), F.col(alt).cast("string"))
    record = F.concat_ws(
        "\t", "contig", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), _listed(F.col("filters"), ";", "PASS"),
        F.lit("."), F.lit("GT:AD"), sample("0/0", "n_ref", "n_alt"), sample("0/1", "t_ref", "t_alt"),
    )
    body = calls.join(contigs.select("contig", "idx"), "contig", "left").select(
        "pair", F.lit(1).alias("kind"), F.coalesce("idx", F.lit(2**62)).alias("idx"), "contig", F.col("pos").cast("long").alias("pos"), record.alias("value")
    )
    order = ["pair", "kind", "idx", "contig", "pos", "value"]
    # The number of partitions is named, as small ones would be put together by their bytes. The test hangs on the partition, so that it stays behind the exchange.
    dealt = heads.unionByName(body).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    rows = dealt.filter(F.when(F.spark_partition_id() >= 0, F.col("kind") >= 0)).sortWithinPartitions(*order).select(
        "pair", F.when(F.col("kind") == 0, F.concat_ws("\n", F.lit("\n".join(GENOTYPE_HEADER)), listed, "value")).otherwise(F.col("value")).alias("value")
    )
    local = _mounted(spark, path)
    if local and mode == "overwrite" and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static":
        _write_mounted(rows, path, local)
    else:
        rows.write.mode(mode).option("compression", "gzip").partitionBy("pair").text(path)


def write_pileups(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pileup rows as text below one folder per sample."""
    order = ["lab_id", "contig", "pos"]
    line = F.concat_ws(
        "\t",
        "contig",
        *[F.col(c).cast("string") for c in ("pos", "ref_count", "alt_count", "other_alt_count", "af")],
    )
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("lab_id", line.alias("value"))
        .write.mode(mode)
        .partitionBy("lab_id")
        .text(path)
    )
