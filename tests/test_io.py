import gzip
import os

import pytest
from pyspark.sql import functions as F

from varspark import session
from varspark.functions import text
from varspark.operators import qc
from varspark.sources import readers, writers


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(folder)


def test_manifest_with_comments_blanks_and_defaults(spark, tmp_path, rows):
    path = put(tmp_path, "a.config", "#SampleID\tLabSampleID\tSeq_centre\tLibrary\nS1\tP1-N\tKCCG\t2\n\n#S2\tP2-N\tKCCG\t1\nS3 P3-T1 KCCG\nS4\tP4-N\tKCCG\t\nS5\tP5-N\tKCCG\ttwo\n")
    expected = [("S1", "P1-N", "KCCG", 2), ("S3", "P3-T1", "KCCG", 1), ("S4", "P4-N", "KCCG", 1), ("S5", "P5-N", "KCCG", None)]
    assert rows(readers.read_manifest(spark, path)) == expected


def test_intervals_take_their_id_from_the_file_name(spark, tmp_path, rows):
    put(tmp_path, "0000-scattered.interval_list", "@HD\tVN:1.6\n@SQ\tSN:chr1\tLN:100\nchr1\t1\t50\t+\t.\n")
    path = put(tmp_path, "0001-scattered.interval_list", "chr1\t51\t90\t+\t.\nchr2\t1\t10\t+\t.\n")
    assert rows(readers.read_intervals(spark, path)) == [("0000", "chr1", 1, 50), ("0001", "chr1", 51, 90), ("0001", "chr2", 1, 10)]


def test_bed_and_dictionary(spark, tmp_path, rows):
    assert rows(readers.read_bed(spark, put(tmp_path, "bed/x.bed", "#c\ntrack name=x\nchr1\t0\t10\textra\n"))) == [("chr1", 0, 10)]
    put(tmp_path, "dict/x.dict", "@HD\tVN:1.6\n" + "".join(f"@SQ\tSN:c{i}\tLN:{i + 5}\tM5:x\n" for i in (3, 1, 2)))
    assert sorted(readers.read_contigs(spark, str(tmp_path / "dict")).collect(), key=lambda r: r.idx) == [("c3", 0, 8), ("c1", 1, 6), ("c2", 2, 7)]


VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tN1\tT1
chr1\t10\t.\tA\tC,G\t.\tPASS\tAF=0.1,0.2;DB\tGT:AD:F1R2\t0/0:9,0,0:4,0,0\t0/1:5,4
chr1\t20\trs1\tAT\tA\t50.5\tgermline;weak\t.\tGT\t0/1\t0/0
chr2\t5\t.\tG\t.\t.\t.\tDP=3\tGT\t./.\t./.
"""


@pytest.mark.parametrize("zipped", [False, True])
def test_variants(spark, tmp_path, zipped):
    target = tmp_path / ("x.vcf.gz" if zipped else "x.vcf")
    target.write_bytes(gzip.compress(VCF.encode()) if zipped else VCF.encode())
    got = {r.pos: r for r in readers.read_variants(spark, str(tmp_path)).collect()}
    assert got[10].alts == ["C", "G"] and got[10].filters == [] and got[10].info == {"AF": "0.1,0.2", "DB": None}
    assert got[20].filters == ["germline", "weak"] and got[20].info == {} and got[20].qual == 50.5 and got[20].id == "rs1"
    assert got[5].alts == [] and got[5].qual is None
    long = readers.explode_genotypes(readers.read_variants(spark, str(tmp_path)))
    cells = {(r.pos, r.lab_id): r.fields for r in long.collect()}
    assert cells[10, "N1"] == {"GT": "0/0", "AD": "9,0,0", "F1R2": "4,0,0"}
    assert cells[10, "T1"] == {"GT": "0/1", "AD": "5,4"}
    assert len(cells) == 6


def test_variants_of_several_files_keep_their_samples(spark, tmp_path):
    put(tmp_path, "a.vcf", VCF)
    put(tmp_path, "b.vcf", VCF.replace("N1\tT1", "N2\tT2"))
    long = readers.explode_genotypes(readers.read_variants(spark, str(tmp_path)))
    assert sorted({r.lab_id for r in long.collect()}) == ["N1", "N2", "T1", "T2"]


@pytest.mark.parametrize("by_folder", [False, True])
def test_variants_of_a_file_in_many_splits_keep_their_samples(spark, tmp_path, by_folder):
    body = "".join(f"c\t{i}\t.\tA\tC\t.\t.\t.\tGT\t0/0\t0/1\n" for i in range(1, 3001))
    for name in ("1", "2"):
        os.mkdir(tmp_path / name)
        put(tmp_path / name, "a.vcf", f"##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tN{name}\tT{name}\n" + body)
    if by_folder:  # parts after the first have no header
        put(tmp_path / "2", "b.vcf", body.replace("\t.\tA", "\tx\tA"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    stretch, readers.STRETCH = readers.STRETCH, 8192
    try:
        got = readers.explode_genotypes(readers.read_variants(spark, str(tmp_path), by_folder=by_folder)).groupBy("lab_id").count().collect()
        plan = readers.read_variants(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
        readers.STRETCH = stretch
    more = 2 if by_folder else 1
    assert {r.lab_id: r["count"] for r in got} == {"N1": 3000, "T1": 3000, "N2": 3000 * more, "T2": 3000 * more}
    assert "_part" in plan[plan.index("Join LeftOuter") :].splitlines()[0]


def test_pair_files_begin_with_their_header_and_read_back(spark, tmp_path):
    contigs = spark.createDataFrame([("chr2", 0, 500), ("chr10", 1, 900)], "contig string, idx bigint, length bigint")
    pairs = spark.createDataFrame([("p", "T1", "N1"), ("q", "T2", "N1"), ("r", "T3", "N3")], "pair string, tumour_id string, normal_id string")
    data = [("p", c, x, "A", "C", ["germline"] if x % 2 else [], 5, 4, 9, 0) for c in ("chr10", "chr2") for x in range(1, 400)] + [("q", "chrX", 7, "G", "GT", [], 1, 2, 3, 4)]
    calls = spark.createDataFrame(data, "pair string, contig string, pos bigint, ref string, alt string, filters array<string>, t_ref bigint, t_alt bigint, n_ref bigint, n_alt bigint")
    path = str(tmp_path / "out")
    writers.write_pair_variants(calls, pairs, path, contigs)
    text = {}
    for pair in "pqr":
        folder = f"{path}/pair={pair}"
        text[pair] = "".join(gzip.open(os.path.join(folder, f), "rt").read() for f in sorted(os.listdir(folder)) if f.endswith(".gz")).splitlines()
        assert text[pair][0] == "##fileformat=VCFv4.2" and text[pair][3:5] == ["##contig=<ID=chr2,length=500>", "##contig=<ID=chr10,length=900>"]
        assert not any(x.startswith("#") for x in text[pair][6:])
    assert [len(text[p]) - 6 for p in "pqr"] == [798, 1, 0] and text["r"][5].split("\t")[8:] == ["FORMAT", "N3", "T3"]
    assert [tuple(x.split("\t")[:2]) for x in text["p"][6:]] == [(c, str(x)) for c in ("chr2", "chr10") for x in range(1, 400)]
    long = readers.explode_genotypes(readers.read_variants(spark, path, by_folder=True)).collect()
    assert len(long) == 2 * len(data)
    assert {(r.lab_id, r.fields["GT"], r.fields["AD"], *r.filters) for r in long if r.contig == "chrX"} == {("T2", "0/1", "1,2"), ("N1", "0/0", "3,4")}


def test_job_logs_know_missing_empty_and_filled_stderr(spark, tmp_path, rows):
    for name, content in (("a b.o", "start\nExit Status: 0\n"), ("a b.e", ""), ("2.o", "Exit Status: 0\n"), ("3.o", "Exit Status: 0\n"), ("3.e", "killed\nmore\n"), ("4.e", "x\n")):
        put(tmp_path, name, content)
    logs = readers.read_job_logs(spark, str(tmp_path))
    assert rows(logs, "job_id", "line", "stderr") == [("2", "Exit Status: 0", None), ("3", "Exit Status: 0", "killed"), ("a b", "Exit Status: 0", ""), ("a b", "start", "")]
    expected = spark.createDataFrame([("a b",), ("2",), ("3",), ("4",)], "job_id string")
    assert {r.job_id: r.failed for r in qc.exit_status(logs, expected).collect()} == {"a b": False, "2": True, "3": True, "4": True}


def test_variant_export_is_ordered_with_one_header_first(spark, tmp_path):
    contigs = spark.createDataFrame([("chr2", 0, 500), ("chr10", 1, 900)], "contig string, idx bigint, length bigint")
    data = [(c, p, "A", ["C", "G"], [], {"N": "2", "FLAG": None}) for c in ("chr10", "chr2") for p in range(400, 0, -7)]
    data.append(("chr2", 500, "A", ["T"], ["germline"], None))
    df = spark.createDataFrame(data, "contig string, pos bigint, ref string, alts array<string>, filters array<string>, info map<string,string>")
    path = str(tmp_path / "out")
    writers.write_variants(df, path, contigs, ["##source=x"])
    parts = sorted(f for f in os.listdir(path) if f.endswith(".gz"))
    lines = "".join(gzip.open(os.path.join(path, f), "rt").read() for f in parts).splitlines()
    assert lines[:5] == ["##fileformat=VCFv4.2", "##source=x", "##contig=<ID=chr2,length=500>", "##contig=<ID=chr10,length=900>", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    body = [x.split("\t") for x in lines[5:]]
    assert not any(x[0].startswith("#") for x in body) and len(body) == len(data)
    assert [(x[0], int(x[1])) for x in body] == sorted(((x[0], int(x[1])) for x in body), key=lambda t: (t[0] != "chr2", t[1]))
    assert body[0][6:] == ["PASS", "FLAG;N=2"]
    back = readers.read_variants(spark, path, one_header=True)
    assert back.count() == len(data) and back.filter("pos = 500").collect()[0].filters == ["germline"]


def test_sam_text(spark, tmp_path, rows):
    put(tmp_path, "P1-T1.final.sam", "@HD\tVN:1.6\nr1\t99\tchr1\t7\t60\t4M\t=\t20\t0\tACGT\tIIII\tNM:i:0\n")
    path = put(tmp_path, "P1-T10.final.sam", "r2\t0\tchr1\t8\t50\t2M\t*\t0\t0\tAC\tII\n")
    got = rows(readers.read_reads(spark, path))
    assert got == [("P1-T1", "r1", 99, "chr1", 7, 60, "4M", "ACGT", "IIII"), ("P1-T10", "r2", 0, "chr1", 8, 50, "2M", "AC", "II")]


def test_pileup_tables_do_not_mix_samples_with_a_common_prefix(spark, tmp_path, rows):
    head = "#<METADATA>SAMPLE=x\ncontig\tposition\tref_count\talt_count\tother_alt_count\tallele_frequency\n"
    put(tmp_path, "P1-T1_pileups.0000.table", head + "chr1\t5\t10\t2\t0\t0.25\n")
    put(tmp_path, "P1-T1_pileups.0001.table", head + "chr1\t9\t11\t0\t1\t0.5\n")
    path = put(tmp_path, "P1-T10_pileups.table", head + "chr1\t5\t7\t7\t0\t0.25\n")
    assert rows(readers.read_pileups(spark, path)) == [("P1-T1", "chr1", 5, 10, 2, 0, 0.25), ("P1-T1", "chr1", 9, 11, 0, 1, 0.5), ("P1-T10", "chr1", 5, 7, 7, 0, 0.25)]


def test_log_lines_are_numbered_over_splits(spark, tmp_path):
    content = "".join(f"line {i}\n" for i in range(1, 2001))
    put(tmp_path, "0001.log", content)
    path = put(tmp_path, "0002.log", "\n\nonly\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        got = readers.read_logs(spark, path)
        assert got.rdd.getNumPartitions() > 3
        lines = {(r.task_id, r.line_no): r.line for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
    assert lines == {("0001", i): f"line {i}" for i in range(1, 2001)} | {("0002", 1): "", ("0002", 2): "", ("0002", 3): "only"}


def test_outputs_are_listed_with_kind_and_size(spark, tmp_path):
    for name, size in (("a.unfiltered.0000.vcf.gz", 3), ("a.unfiltered.0000.vcf.gz.tbi", 0), ("a.vcf.gz.stats", 1), ("a.f1r2.0000.tar.gz", 2), ("0000.log", 4)):
        put(tmp_path, name, "x" * size)
    files = readers.list_outputs(spark, str(tmp_path)).withColumn("kind", readers.output_kind(F.col("path")))
    assert {(r.kind, r.length) for r in files.collect()} == {("vcf", 3), ("tbi", 0), ("stats", 1), ("f1r2", 2), ("log", 4)}
    assert "content" not in readers.list_outputs(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_table_prunes_by_interval_and_splits_a_full_one(spark, tmp_path):
    df = spark.range(4000).selectExpr("if(id < 3000, '0000', '0001') as interval_id", "'c' as contig", "id as pos")
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_table(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(os.path.join(path, "interval_id=0000")) if f.endswith(".parquet")]
    assert len(files) > 1
    back = spark.read.schema(df.schema).parquet(path)
    assert back.count() == 4000 and back.filter("interval_id = '0001'").count() == 1000


def test_stored_stage_lies_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    df = session.stored(spark.range(5).toDF("x"))
    assert session.shared_dir(spark) == named
    assert all(named in f for f in df.inputFiles()) and df.count() == 5


def test_text_functions(spark):
    df = spark.createDataFrame([("a,b;c,../x/y.tar.gz", "w1 w2 w3", 7, 12345)], "p string, w string, n int, big int")
    got = df.select(
        text.nth_field(F.col("p"), 2),
        text.nth_field(F.col("p"), 9),
        text.field_from_end(F.col("w"), 2),
        text.base_name(text.nth_field(F.col("p"), 3)),
        text.dir_name(text.nth_field(F.col("p"), 3)),
        text.dir_name(F.lit("bare")),
        text.strip_suffix(F.lit("x.vcf.gz"), ".vcf.gz"),
        text.strip_suffix(F.lit("xavcfbgz"), ".vcf.gz"),
        text.stem(text.nth_field(F.col("p"), 3)),
        text.zero_padded(F.col("n")),
        text.zero_padded(F.col("big"), 4),
        text.contains_ci(F.col("w"), "W2"),
        text.captured(F.col("w"), r"w(\d)$"),
        text.captured(F.col("w"), r"z(\d)$"),
        text.swap_separator(F.lit("a;b"), ";", "-"),
    ).collect()[0]
    assert list(got) == ["b;c", None, "w2", "y.tar.gz", "../x", ".", "x", "xavcfbgz", "y", "0007", "12345", True, "3", None, "a-b"]
    assert [r[0] for r in df.select(text.split_rows(text.nth_field(F.col("p"), 2))).collect()] == ["b", "c"]


def test_reference_over_several_contigs(spark, tmp_path, rows):
    path = put(tmp_path, "ref.fa", ">c1 first\nacg\nTT\n\n>c2\nN\n>c3\n")
    reference = readers.read_reference(spark, path)
    assert rows(reference) == [("c1", 1, "ACG"), ("c1", 4, "TT"), ("c2", 1, "N")]
    assert rows(readers.single_bases(reference)) == [("c1", 1, "A"), ("c1", 2, "C"), ("c1", 3, "G"), ("c1", 4, "T"), ("c1", 5, "T"), ("c2", 1, "N")]


def test_pair_folders_are_named_and_filled_as_sparks_writer_does(spark, tmp_path):
    names = ["a b", "a%b", "x=y", "q?#'\"", "[z]{^}", "t\tu", "ä:*", "back\\slash", "a,b+c"]
    pairs = spark.createDataFrame([(x, "T", "N") for x in names], "pair string, tumour_id string, normal_id string")
    contigs = spark.createDataFrame([("c", 0, 9)], "contig string, idx bigint, length bigint")
    calls = spark.createDataFrame([(x, "c", p, "A", "C", [], 1, 2, 3, 4) for x in [*names, None, ""] for p in (5, 3)], "pair string, contig string, pos bigint, ref string, alt string, filters array<string>, t_ref bigint, t_alt bigint, n_ref bigint, n_alt bigint")

    def text(path):
        folders = {d: sorted(f for f in os.listdir(path / d) if not f.startswith(".")) for d in os.listdir(path) if d.startswith("pair=")}
        return {d: "".join(gzip.open(path / d / f, "rt").read() for f in files) for d, files in folders.items()}

    writers.write_pair_variants(calls, pairs, str(tmp_path / "own"), contigs)
    writers.write_pair_variants(calls, pairs, f"file:{tmp_path}/again", contigs)
    writers.write_pair_variants(calls, pairs, f"file:{tmp_path}/again", contigs)
    writers.write_pair_variants(calls, pairs, str(tmp_path / "sparks"), contigs, mode="append")
    assert len(text(tmp_path / "own")) == len(names) + 1 and text(tmp_path / "own") == text(tmp_path / "again") == text(tmp_path / "sparks")
    assert sorted(os.listdir(tmp_path)) == ["again", "own", "sparks"]


def test_a_failed_write_of_pairs_leaves_what_was_there(spark, tmp_path):
    pairs = spark.createDataFrame([("p", "T", "N")], "pair string, tumour_id string, normal_id string")
    contigs = spark.createDataFrame([("c", 0, 9)], "contig string, idx bigint, length bigint")
    calls = spark.createDataFrame([("p", "c", 5, "A", "C", [], 1, 2, 3, 4)], "pair string, contig string, pos bigint, ref string, alt string, filters array<string>, t_ref bigint, t_alt bigint, n_ref bigint, n_alt bigint")
    path = tmp_path / "out"
    writers.write_pair_variants(calls, pairs, str(path), contigs)
    before = sorted(os.listdir(path))
    with pytest.raises(Exception):
        writers.write_pair_variants(calls.withColumn("ref", F.when(F.col("pos") < 9, F.raise_error(F.lit("no"))).cast("string")), pairs, str(path), contigs)
    assert sorted(os.listdir(path)) == before and os.listdir(tmp_path) == ["out"]


def test_pairs_without_calls_are_dealt_to_all_tasks(spark, tmp_path):
    """A range of pairs that have nothing but a header once was one task, as it has few rows."""
    n = 2000
    pairs = spark.range(n).selectExpr("format_string('P%05d', id) as pair", "'T' as tumour_id", "'N' as normal_id")
    calls = spark.range(200).selectExpr("'P00000' as pair", "'c' as contig", "id as pos", "'A' as ref", "'C' as alt", "cast(array() as array<string>) as filters", "1L as t_ref", "1L as t_alt", "1L as n_ref", "1L as n_alt")
    contigs = spark.createDataFrame([("c", 0, 9)], "contig string, idx bigint, length bigint")
    writers.write_pair_variants(calls.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(100)))), pairs, str(tmp_path / "out"), contigs)
    parts = [f.split("-")[1] for d in os.listdir(tmp_path / "out") if d.startswith("pair=") for f in os.listdir(tmp_path / "out" / d) if f.endswith(".gz")]
    per_task = [parts.count(x) for x in set(parts)]
    assert sum(per_task) >= n and max(per_task) < n / 2
    rows = readers.read_variants(spark, str(tmp_path / "out"), by_folder=True)
    assert rows.count() == 20_000 and rows.filter("size(genotypes) = 2").count() == 20_000
    assert rows.rdd.getNumPartitions() < n // 4
