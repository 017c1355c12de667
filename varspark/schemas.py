"""Table schemas. Nothing is ever inferred from the data."""

from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("lab_id", T.StringType()),
        T.StructField("seq_centre", T.StringType()),
        T.StructField("library", T.IntegerType()),
    ]
)

REGIONS = T.StructType(
    [
        T.StructField("contig", T.StringType()),
        T.StructField("bed_start", T.LongType()),
        T.StructField("bed_end", T.LongType()),
    ]
)

INTERVALS = T.StructType(
    [
        T.StructField("interval_id", T.StringType()),
        T.StructField("contig", T.StringType()),
        T.StructField("start_pos", T.LongType()),
        T.StructField("end_pos", T.LongType()),
    ]
)

CONTIGS = T.StructType(
    [
        T.StructField("contig", T.StringType()),
        T.StructField("idx", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)

READS = T.StructType(
    [
        T.StructField("lab_id", T.StringType()),
        T.StructField("read_id", T.StringType()),
        T.StructField("flag", T.IntegerType()),
        T.StructField("contig", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("mapq", T.IntegerType()),
        T.StructField("cigar", T.StringType()),
        T.StructField("seq", T.StringType()),
        T.StructField("qual", T.StringType()),
    ]
)

PILEUPS = T.StructType(
    [
        T.StructField("lab_id", T.StringType()),
        T.StructField("contig", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("ref_count", T.LongType()),
        T.StructField("alt_count", T.LongType()),
        T.StructField("other_alt_count", T.LongType()),
        T.StructField("af", T.DoubleType()),
    ]
)

SITE = ["contig", "pos", "ref", "alt"]
