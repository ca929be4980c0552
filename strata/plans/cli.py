"""Command line for the layer jobs (use with ``spark-submit`` or ``python -m``).

    python -m strata.plans.cli bronze   --execution-date 2024-03-15 --input-path <dir> \\
        --format csv --source-system crm --root <lake>
    python -m strata.plans.cli bronze   --execution-date 2024-03-15 --root <lake>   # registry
    python -m strata.plans.cli silver   --execution-date 2024-03-15 --root <lake> [--dim-path d]
    python -m strata.plans.cli gold     --execution-date 2024-03-15 --root <lake>
    python -m strata.plans.cli transform --execution-date 2024-03-15 --root <lake>
    python -m strata.plans.cli backfill --start-date 2024-03-01 --end-date 2024-03-14 --root <lake>
    python -m strata.plans.cli quality  --execution-date 2024-03-15 --root <lake>

``--root`` lays out landing/bronze/silver/gold/quality_audit/metrics/schema_baselines under one
folder; each can be overridden (``--bronze-path`` …). The per-job ``--input-path`` /
``--output-path`` style also works: bronze reads the input folder and writes the Bronze table,
silver reads Bronze and writes Silver, gold reads Silver and writes the Gold root. The session
comes from the cluster (``SparkSession.builder.getOrCreate()``); a failed gate exits with
status 1.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import sys
import uuid

from pyspark.sql import SparkSession

from strata.operators.quality import DataQualityError
from strata.plans import jobs
from strata.session import now_iso


# Per-command meaning of --input-path / --output-path (layer table read / written).
_IO = {"silver": ("bronze", "silver"), "gold": ("silver", "gold"), "bronze": (None, "bronze")}


def _paths(a: argparse.Namespace) -> jobs.Paths:
    base = jobs.Paths.under(a.root or a.output_path)
    over = {f: getattr(a, f"{f}_path") for f in ("landing", "bronze", "silver", "gold", "audit",
                                                  "metrics", "baselines")
            if getattr(a, f"{f}_path", None)}
    src, dst = _IO.get(a.command, (None, None))
    if src and a.input_path:
        over.setdefault(src, a.input_path)
    if dst and a.output_path:
        over.setdefault(dst, a.output_path)
    return jobs.Paths(**{**base.__dict__, **over})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("command", choices=["bronze", "silver", "gold", "transform", "backfill",
                                       "quality"])
    p.add_argument("--env", default="dev", choices=["dev", "staging", "prod"])
    p.add_argument("--execution-date", default=_dt.date.today().isoformat())
    p.add_argument("--start-date")
    p.add_argument("--end-date")
    p.add_argument("--root", help="lake folder holding every layer")
    p.add_argument("--output-path", help="table the command writes")
    for f in ("landing", "bronze", "silver", "gold", "audit", "metrics", "baselines"):
        p.add_argument(f"--{f}-path")
    p.add_argument("--input-path", help="Bronze: landed folder; silver/gold: table read")
    p.add_argument("--format", default="csv")
    p.add_argument("--source-system", default="unknown")
    p.add_argument("--keep-source-column", action="store_true")
    p.add_argument("--landing-layout", default="dated", choices=["dated", "hive"],
                   help="registry Bronze: <landing>/<YYYYMMDD>/<subdir> or "
                        "<landing>/<subdir>/landing_date=YYYYMMDD")
    p.add_argument("--dim-path", help="folder holding dim_source/ (Silver enrichment)")
    p.add_argument("--no-metrics", action="store_true")
    p.add_argument("--run-id", default=None)
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if not a.root and not a.output_path:
        parser().error("--root or --output-path is required")
    if a.command == "backfill" and not (a.start_date and a.end_date):
        parser().error("backfill needs --start-date and --end-date")
    spark = spark or SparkSession.builder.getOrCreate()
    paths = _paths(a)
    run_id = a.run_id or str(uuid.uuid4())
    now = now_iso()
    dim = None
    if a.dim_path:
        from strata.sources.readers import read_dimension
        dim = read_dimension(spark, a.dim_path)
    d = a.execution_date
    try:
        if a.command in ("bronze", "transform"):
            if a.input_path:
                jobs.bronze_path_job(spark, a.input_path, a.format, paths, d, run_id, now,
                                     a.source_system, a.env, a.keep_source_column)
            else:
                jobs.bronze_job(spark, paths, d, run_id, now, a.env, layout=a.landing_layout,
                                keep_source_column=a.keep_source_column)
        if a.command in ("silver", "transform"):
            jobs.silver_job(spark, paths, d, run_id, now, a.env, dim)
        if a.command in ("gold", "transform"):
            jobs.gold_job(spark, paths, d, run_id, now, a.env, emit_metrics=not a.no_metrics)
        if a.command == "backfill":
            jobs.backfill(spark, paths, a.start_date, a.end_date, run_id, now, a.env, dim,
                          emit_metrics=not a.no_metrics)
        if a.command == "quality":
            jobs.quality_stage(spark, paths, d, run_id, now, enforce=True)
    except DataQualityError as e:
        print(str(e), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(run())
