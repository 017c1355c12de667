"""Completeness checks: outputs present, logs clean, tasks to run again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varspark.functions.text import captured, contains_ci, field_from_end, nth_field
from varspark.operators.ordered import first_rows, last_rows

# Texts the checks look for in logs.
SUCCESS = "success"
ERROR = "error"
ELAPSED = "done. Elapsed time:"
ELAPSED_MINUTES = r"([0-9]+\.[0-9]+) minutes\.$"
MEMORY = "Runtime.totalMemory"
RETURNED = "Tool returned:"

TAIL = 50


def _last(line: Column, wanted: Column) -> Column:
    """The last line that meets the condition."""
    return F.max_by(F.when(wanted, line), F.when(wanted, F.col("line_no")))


def log_tail(log_lines: DataFrame, n: int = TAIL) -> DataFrame:
    """The last ``n`` lines of each log."""
    return last_rows(log_lines, n, keys=["task_id"], order="line_no")


def log_head(log_lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines of each log."""
    return first_rows(log_lines, n, keys=["task_id"], order="line_no")


def first_match(log_lines: DataFrame, word: str) -> DataFrame:
    """Per log its length, and the first line with the word (NULL without one)."""
    line, number = F.col("line"), F.col("line_no")
    wanted = line.contains(word)
    return log_lines.groupBy("task_id").agg(
        F.count("*").alias("n_lines"),
        F.min_by(F.when(wanted, line), F.when(wanted, number)).alias("first_line"),
    )


def log_outcome(log_lines: DataFrame) -> DataFrame:
    """``error`` if any line has it, ``success`` if some line says so, else ``incomplete``."""
    line = F.col("line")
    seen = log_lines.groupBy("task_id").agg(
        F.bool_or(contains_ci(line, SUCCESS)).alias("has_success"), F.bool_or(contains_ci(line, ERROR)).alias("has_error")
    )
    outcome = F.when(F.col("has_error"), "error").when(F.col("has_success"), "success").otherwise("incomplete")
    return seen.withColumn("outcome", outcome)


def line_after(log_lines: DataFrame, marker: str = RETURNED) -> DataFrame:
    """The line that follows each line with the marker; NULL when the log ends there.

    Line numbers only need to rise, so the follower is the first line of the
    rest of the block, or of the next block that has lines.
    """
    width = 4096
    blocked = log_lines.select("task_id", "line_no", "line").withColumn(
        "_block", F.floor(F.col("line_no") / F.lit(width)).cast("long")
    )
    inside = Window.partitionBy("task_id", "_block").orderBy("line_no")
    across = Window.partitionBy("task_id").orderBy("_block")
    heads = (
        blocked.groupBy("task_id", "_block")
        .agg(F.min_by("line", "line_no").alias("_head"))
        .withColumn("_head_next", F.lead("_head").over(across))
        .drop("_head")
    )
    led = blocked.withColumn("_next", F.lead("line").over(inside)).filter(F.col("line").contains(marker))
    return led.join(heads, ["task_id", "_block"]).select(
        "task_id", "line_no", "line", F.coalesce("_next", "_head_next").alias("next_line")
    )


def task_metrics(log_lines: DataFrame, expected: DataFrame) -> DataFrame:
    """Elapsed minutes and memory (10^9 bytes) per expected task.

    Both are NULL for a task without a log, with an error anywhere, or without
    a memory line. The last line of each kind counts, wherever in the log it is.
    """
    line = F.col("line")
    ends = log_lines.groupBy("task_id").agg(
        F.bool_or(contains_ci(line, ERROR)).alias("has_error"),
        _last(line, line.contains(" " + ELAPSED)).alias("elapsed"),
        _last(line, line.contains(MEMORY)).alias("memory"),
    )
    gb = captured(F.col("memory"), r"([0-9]+)$").cast("double") / F.lit(1e9)
    measured = (
        ends.withColumn("gb", F.when(~F.col("has_error") & (gb > 0), gb))
        .withColumn(
            "minutes", F.when(F.col("gb").isNotNull(), captured(F.col("elapsed"), ELAPSED_MINUTES).cast("double"))
        )
        .select("task_id", "minutes", "gb")
    )
    return expected.select("task_id").join(measured, "task_id", "left")


def task_metrics_binary(log_lines: DataFrame) -> DataFrame:
    """Elapsed minutes and memory (1024^3 bytes, 2 decimals) per log, errors or not."""
    line = F.col("line")
    by_number = F.when(line.contains(MEMORY + "()"), F.col("line_no"))
    seen = log_lines.groupBy("task_id").agg(
        _last(line, line.contains(" " + ELAPSED)).alias("elapsed"),
        F.min_by(F.when(by_number.isNotNull(), line), by_number).alias("memory"),
    )
    gb = captured(F.col("memory"), r"([0-9]+)").cast("double") / F.lit(1024.0**3)
    return seen.select(
        "task_id", captured(F.col("elapsed"), ELAPSED_MINUTES).cast("double").alias("minutes"), F.round(gb, 2).alias("gb")
    )


def error_counts(log_lines: DataFrame, word: str = "ERROR") -> DataFrame:
    """Error lines per log (case as given), and the minutes of a log without any."""
    line = F.col("line")
    seen = log_lines.groupBy("task_id").agg(
        F.count_if(line.contains(word)).alias("n_errors"), _last(line, line.contains(ELAPSED)).alias("elapsed")
    )
    minutes = F.when(F.col("n_errors") == 0, field_from_end(F.col("elapsed"), 2))
    return seen.select("task_id", "n_errors", minutes.alias("minutes"))


def exit_status(job_logs: DataFrame, expected: DataFrame) -> DataFrame:
    """Whether each expected job failed: no log, no exit status, a status but 0, any stderr, or no stderr file (NULL)."""
    is_exit = F.col("line").contains("Exit")
    status = F.when(is_exit, nth_field(F.col("line"), 3, " ").try_cast("int"))
    seen = job_logs.groupBy("job_id").agg(
        F.max(status).alias("status"), F.bool_or(F.col("stderr").isNull() | (F.col("stderr") != "")).alias("has_stderr")
    )
    failed = F.coalesce((F.col("status") != 0) | F.col("has_stderr"), F.lit(True))
    return expected.select("job_id").join(seen, "job_id", "left").withColumn("failed", failed)


def missing_outputs(grid: DataFrame, present: DataFrame, kinds: Sequence[str], keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """Required outputs of each expected task that are ``missing`` or ``empty``."""
    wanted = grid.select(*keys).distinct().withColumn("kind", F.explode(F.array(*[F.lit(k) for k in kinds])))
    found = present.groupBy(*keys, "kind").agg(F.max("length").alias("length"))
    reason = F.when(F.col("length").isNull(), "missing").when(F.col("length") == 0, "empty")
    return (
        wanted.join(found, [*keys, "kind"], "left")
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .drop("length")
    )


def incomplete_tasks(grid: DataFrame, outcomes: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """Expected tasks whose log is absent or does not end in success."""
    good = outcomes.filter(F.col("outcome") == "success").select(*keys)
    return grid.select(*keys).distinct().join(good, list(keys), "left_anti")


def rerun_set(grid: DataFrame, *failures: DataFrame, keys: Sequence[str] = ("task_id",)) -> DataFrame:
    """Rows of the task grid whose key failed any check, each once, with their parameters."""
    failed = reduce(lambda a, b: a.union(b), [f.select(*keys) for f in failures]).distinct()
    return grid.distinct().join(failed, list(keys), "left_semi")


def run_summary(grid: DataFrame, outcomes: DataFrame, by: str) -> DataFrame:
    """Expected, successful, failed and log-less tasks per ``by`` and, with NULL, in all."""
    state = F.coalesce("outcome", F.lit("no_log"))
    counted = grid.join(outcomes.select("task_id", "outcome"), "task_id", "left").groupBy(by).agg(
        F.count("*").alias("expected"),
        F.count_if(state == "success").alias("successful"),
        F.count_if(state.isin("error", "incomplete")).alias("failed"),
        F.count_if(state == "no_log").alias("no_log"),
    )
    return counted.rollup(by).agg(*[F.sum(c).alias(c) for c in ("expected", "successful", "failed", "no_log")])


def job_efficiency(job_usage: DataFrame, units_per_cpu_hour: float = 2.0) -> DataFrame:
    """CPU time over reserved CPU time, and the service units a job was charged."""
    reserved = F.col("wall_minutes") * F.col("cpus")
    return job_usage.withColumn("efficiency", F.when(reserved > 0, F.col("cpu_minutes") / reserved)).withColumn(
        "service_units", reserved / F.lit(60.0) * F.lit(units_per_cpu_hour)
    )


def stage_scaling(job_usage: DataFrame) -> DataFrame:
    """Speed-up and cost of every CPU count of a stage against its smallest one."""
    runs = job_usage.groupBy("stage", "cpus").agg(
        F.avg("wall_minutes").alias("wall_minutes"), F.avg("cpu_minutes").alias("cpu_minutes"), F.count("*").alias("n_jobs")
    )
    base = runs.groupBy("stage").agg(
        F.min_by(F.struct("cpus", "wall_minutes"), "cpus").alias("_base")
    )
    wall, cpus = F.col("_base.wall_minutes"), F.col("_base.cpus")
    return runs.join(base, "stage").select(
        "stage",
        "cpus",
        "n_jobs",
        "wall_minutes",
        (wall / F.col("wall_minutes")).alias("speed_up"),
        (F.col("wall_minutes") * F.col("cpus") / (wall * cpus)).alias("cost_ratio"),
        (F.col("cpu_minutes") / (F.col("wall_minutes") * F.col("cpus"))).alias("efficiency"),
    )
