"""The outcome half of the daily loop as one job.

Answers of one run + the run's frozen batches -> classified send results ->
merged into the control table (M1) -> retry policy (M5) -> reconciled with the
platforms' reports (M6) -> the next control version, tagged with the run, so
that a repeated job applies it once.

    python -m relayline.plans.outcome --run DIR/run=ID --responses PATH --control ROOT --as-of "2024-04-09 00:00:00"
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators import control as ctl
from ..operators.reconcile import reconcile, valid_reports
from ..operators.responses import classify
from ..schemas import KEY, RESPONSE
from ..sources.tables import ControlTable


def settle(merged: DataFrame, as_of, report: DataFrame | None = None, max_attempts: int = 3,
           grace_days: int = 3) -> DataFrame:
    """What follows a merge on every path, job or stream: retry policy (M5),
    then reconciliation with the reports that hold at ``as_of`` (M6)."""
    merged = ctl.apply_retry_policy(merged, max_attempts)
    return merged if report is None else reconcile(merged, valid_reports(report, as_of), as_of, grace_days)


def next_control(control: DataFrame, batched: DataFrame, responses: DataFrame, as_of,
                 report: DataFrame | None = None, max_attempts: int = 3, grace_days: int = 3) -> DataFrame:
    """The control table after a run's answers, as a DataFrame."""
    merged = ctl.upsert(control, classify(batched, responses, sent_at=as_of), now=as_of)
    return settle(merged, as_of, report, max_attempts, grace_days)


def run(spark: SparkSession, run_dir: str, responses_path: str, control_root: str, as_of,
        report_path: str | None = None, max_attempts: int = 3, grace_days: int = 3) -> int:
    """Apply a run's answers; the control version that holds them."""
    table = ControlTable(spark, control_root)
    tag = "outcome-" + run_dir.rstrip("/").rpartition("run=")[2]
    done = table.tagged(tag)
    if done is not None:
        return done
    batched = spark.read.parquet(f"{run_dir.rstrip('/')}/batches")
    responses = spark.read.schema(RESPONSE).parquet(responses_path)
    report = spark.read.parquet(report_path) if report_path else None
    after = next_control(table.read(), batched, responses, as_of, report, max_attempts, grace_days)
    return table.write(after, KEY, tag, rules=ctl.row_rules())


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--run", required=True, help="a run's folder, as the daily job wrote it")
    ap.add_argument("--responses", required=True)
    ap.add_argument("--control", required=True, help="root of the control table snapshots")
    ap.add_argument("--as-of", required=True)
    ap.add_argument("--report", default=None, help="platform reports to reconcile with")
    a = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session(app="relayline-outcome")
    print(run(spark, a.run, a.responses, a.control, a.as_of, a.report))


if __name__ == "__main__":
    main()
