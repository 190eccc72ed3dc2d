"""Whole jobs: build the report once, then export, count and preview it.

The jobs this library rebuilds end in several actions (stage counts, one CSV
write, a ten-row preview), each of which recomputes the full lineage. Here the
final report is written once as a reliable checkpoint in the session's
``spark.checkpoint.dir`` (shared storage on a cluster): later actions read it
instead of recomputing, and a lost executor costs a re-read, not a rerun of
the star joins. ``localCheckpoint`` is never used (it dies with the executor).

Usage::

    python -m tessera.plans.jobs --sf-dir /root/testdata/sf0.01 --job gated
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from ..operators import consent as C
from ..operators.audit import observed, stage_counts
from ..session import ensure_checkpoint_dir
from ..sources.tables import run_stamp, write_csv
from . import profile as PR

JOBS = {"final": PR.profile_final, "gated": PR.profile_gated, "excluded": PR.profile_excluded}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` (eager) in the session's checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_export(spark: SparkSession, sf_dir: str, job: str = "gated", out_dir: str | None = None,
               preview_rows: int = 10, single_file: bool = False) -> dict:
    """Run one profile job end to end: report, CSV export, stage counts, preview.

    Returns a small summary (path, counts, preview rows). Only the counts (one
    row per stage) and the preview (``preview_rows`` rows) reach the driver.
    """
    f = PR.load(spark, sf_dir)
    built, report_rows = observed(JOBS[job](f, sort=True), "report")
    report = materialize(built)          # the one action that runs the job; counts its rows on the way
    root = (out_dir or ensure_checkpoint_dir(spark).rstrip("/") + "/exports").rstrip("/")
    path = write_csv(report, f"{root}/profile_{job}_{run_stamp()}", single_file=single_file)
    stages = {"open_points": PR.open_points(f), "customers": PR.customer_rows(f)}
    if job == "gated":
        rows = C.tagged(f)
        stages["law_a_gate"] = C.law_a_gate(rows)
        stages["law_b_latest"] = C.latest_channel(rows)
    counts = {r["stage"]: r["row_count"] for r in stage_counts(stages).collect()}
    counts["report"] = report_rows.get["row_count"]
    preview = [r.asDict() for r in PR.by_name(report).limit(preview_rows).collect()]
    return {"path": path, "counts": counts, "preview": preview}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--job", choices=sorted(JOBS), default="gated")
    ap.add_argument("--out-dir", default=None)
    ap.add_argument("--single-file", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    out = run_export(spark, args.sf_dir, args.job, args.out_dir, single_file=args.single_file)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
