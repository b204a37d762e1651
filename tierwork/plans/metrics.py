"""Run metrics of jobs and reports over them."""

from __future__ import annotations

import os
import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.columns import percent
from ..sinks.tables import Warehouse, log_rows
from ..sources.files import inline_rows

JOB_LOG = "meta.job_log"
JOB_LOG_SCHEMA = (
    "run_id string, layer string, job_name string, status string, rows_in bigint, rows_out bigint, "
    "duration_sec double, error_msg string, run_timestamp timestamp"
)
MAX_ERROR = 1000


@dataclass
class JobRun:
    """Row counts of a running job: set them, or let a frame count itself."""

    rows_in: int = 0
    rows_out: int = 0
    _watched: list[tuple[str, Observation]] = field(default_factory=list)

    def watch(self, df: DataFrame, side: str) -> DataFrame:
        """Count the rows of ``df`` while the job's own action runs over it. The
        returned frame has to be executed before the job ends."""
        seen = Observation()
        self._watched.append((side, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def settle(self) -> None:
        for side, seen in self._watched:
            setattr(self, side, getattr(self, side) + seen.get["n"])


def job_row(run_id, layer, job_name, status, run: JobRun, seconds, error, run_ts) -> tuple:
    return (run_id, layer, job_name, status, int(run.rows_in), int(run.rows_out), float(seconds), error[:MAX_ERROR], run_ts)


@contextmanager
def job_run(wh: Warehouse, layer: str, job_name: str, run_id: str | None = None, log: str = JOB_LOG):
    """Time a job and append one row about it to the job log. An exception is
    recorded as 'failed' and raised again; a broken log never hides it."""
    run, started, status, error = JobRun(), time.monotonic(), "success", ""
    run_id = run_id or os.environ.get("RUN_ID", "manual")
    try:
        yield run
        run.settle()
    except Exception as failure:
        status, error = "failed", str(failure)
        raise
    finally:
        row = job_row(run_id, layer, job_name, status, run, round(time.monotonic() - started, 2), error,
                      datetime.now(timezone.utc))
        log_rows(wh, inline_rows(wh.spark, [row], JOB_LOG_SCHEMA), log)


def health_report(job_log: DataFrame, dq_results: DataFrame) -> DataFrame:
    """Runs, failures, durations and quality pass rate per layer. Both logs are
    aggregated before they meet."""
    runs = job_log.groupBy("layer").agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.round(F.avg("duration_sec"), 2).alias("avg_duration_sec"), F.max("duration_sec").alias("max_duration_sec"),
        F.sum("rows_out").alias("rows_out"),
    )
    checks = dq_results.groupBy("layer").agg(
        F.count("*").alias("checks"), F.count_if(~F.col("passed")).alias("failed_checks"))
    return runs.join(checks, "layer", "left").select(
        "layer", "runs", "failed_runs", "avg_duration_sec", "max_duration_sec", "rows_out",
        F.coalesce("checks", F.lit(0)).alias("checks"), F.coalesce("failed_checks", F.lit(0)).alias("failed_checks"),
        percent(F.col("checks") - F.col("failed_checks"), "checks").alias("dq_pass_pct"),
    )
