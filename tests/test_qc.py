import pytest

from varspark.operators import qc

LOG = "task_id string, line_no bigint, line string"


@pytest.fixture
def logs(spark):
    data = {
        "good": ["start", "Tool done. Elapsed time: 1.25 minutes.", "Runtime.totalMemory()=2000000000", "Tool returned:", "SUCCESS"],
        "both": ["A USER ERROR has occurred", "Success", "Tool done. Elapsed time: 9.25 minutes.", "Runtime.totalMemory()=3221225472"],
        "quiet": ["nothing"],
        "nomem": ["Tool done. Elapsed time: 2.00 minutes.", "Tool returned:"],
        "noelapsed": ["Tool done. Elapsed time: soon", "Runtime.totalMemory()=1500000000"],
        "long": ["Runtime.totalMemory()=7000000000"] + ["x"] * 59 + ["Tool returned:", "failed"],
        "twice": ["Runtime.totalMemory()=1000000000", "Tool done. Elapsed time: 1.00 minutes.", "Tool done. Elapsed time: 4.50 minutes.", "Runtime.totalMemory()=4000000000"],
    }
    # numbers rise but are not dense, and lie in several blocks
    return spark.createDataFrame([(t, (i + 1) * 3000, x) for t, lines in data.items() for i, x in enumerate(lines)], LOG)


def test_outcomes(logs, rows):
    got = dict(rows(qc.log_outcome(logs), "task_id", "outcome"))
    assert got == {"good": "success", "both": "error", "quiet": "incomplete", "nomem": "incomplete", "noelapsed": "incomplete", "long": "incomplete", "twice": "incomplete"}


def test_tail_and_following_lines(logs, rows):
    assert qc.log_tail(logs).filter("task_id = 'long'").count() == 50
    assert rows(qc.line_after(logs), "task_id", "next_line") == [("good", "SUCCESS"), ("long", "failed"), ("nomem", None)]


def test_heads_and_first_matches(logs, rows):
    assert rows(qc.log_head(logs, 1).filter("task_id = 'good'"), "line") == [("start",)]
    got = {r.task_id: (r.n_lines, r.first_line) for r in qc.first_match(logs, "Elapsed time").collect()}
    assert got["twice"] == (4, "Tool done. Elapsed time: 1.00 minutes.") and got["quiet"] == (1, None)


def test_metrics(spark, logs):
    expected = spark.createDataFrame([(t,) for t in ("good", "both", "quiet", "nomem", "noelapsed", "long", "twice", "absent")], "task_id string")
    got = {r.task_id: (r.minutes, r.gb) for r in qc.task_metrics(logs, expected).collect()}
    none = (None, None)
    assert got == {"good": (1.25, 2.0), "both": none, "quiet": none, "nomem": none, "noelapsed": (None, 1.5), "long": (None, 7.0), "twice": (4.5, 4.0), "absent": none}
    binary = {r.task_id: (r.minutes, r.gb) for r in qc.task_metrics_binary(logs).collect()}
    assert binary["both"] == (9.25, 3.0) and binary["twice"] == (4.5, 0.93) and binary["nomem"] == (2.0, None)


def test_error_lines(logs, rows):
    got = {r[0]: r[1:] for r in rows(qc.error_counts(logs))}
    assert got["both"] == (1, None) and got["good"] == (0, "1.25") and got["quiet"] == (0, None)


def test_exit_status(spark):
    jobs = spark.createDataFrame([(j,) for j in "abcdef"], "job_id string")
    logs = spark.createDataFrame([("a", "Exit Status: 0", ""), ("b", "Exit Status: 271", ""), ("c", "walltime", ""), ("d", "Exit Status: 0", "oops"), ("f", "Exit Status: 0", None)], "job_id string, line string, stderr string")
    got = {r.job_id: r.failed for r in qc.exit_status(logs, jobs).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": True, "e": True, "f": True}


def test_missing_outputs_and_rerun(spark, rows):
    grid = spark.createDataFrame([("t1", "x"), ("t2", "y"), ("t3", "z"), ("t3", "z")], "task_id string, param string")
    present = spark.createDataFrame([("t1", "vcf", 5), ("t1", "tbi", 5), ("t2", "vcf", 0), ("t2", "tbi", 5), ("t3", "vcf", 5), ("t3", "tbi", 1)], "task_id string, kind string, length bigint")
    missing = qc.missing_outputs(grid, present, ("vcf", "tbi"))
    assert rows(missing) == [("t2", "vcf", "empty")]
    assert qc.missing_outputs(grid, present.limit(0), ("vcf", "tbi")).count() == 6
    outcomes = spark.createDataFrame([("t1", "success"), ("t2", "success"), ("t3", "error")], "task_id string, outcome string")
    failed = qc.incomplete_tasks(grid, outcomes)
    assert rows(qc.rerun_set(grid, missing, failed)) == [("t2", "y"), ("t3", "z")]
    total = qc.run_summary(grid.distinct(), outcomes.filter("task_id <> 't1'"), "param").filter("param is null").collect()[0]
    assert (total.expected, total.successful, total.failed, total.no_log) == (3, 1, 1, 1)


def test_published_efficiency_figures(spark):
    data = [("pon_960", "pon", 960, 92246.27, 98.05), ("pon_3840", "pon", 3840, 111569.13, 31.72)]
    usage = spark.createDataFrame(data, "job string, stage string, cpus bigint, cpu_minutes double, wall_minutes double")
    got = {r.job: r for r in qc.job_efficiency(usage).collect()}
    assert round(got["pon_960"].efficiency, 2) == 0.98 and round(got["pon_3840"].efficiency, 2) == 0.92
    assert got["pon_3840"].service_units == pytest.approx(4059.73, rel=0.001)
    scaled = {r.cpus: r for r in qc.stage_scaling(usage).collect()}
    assert scaled[960].speed_up == 1.0 and scaled[3840].speed_up == pytest.approx(98.05 / 31.72)


def test_no_logs(spark):
    empty = spark.createDataFrame([], LOG)
    assert qc.log_outcome(empty).count() == 0 and qc.line_after(empty).count() == 0
