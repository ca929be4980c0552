"""Layer jobs composed from the operators: Bronze, Silver, Gold, end-to-end, backfill, quality.

Every job follows the same order: build the layer lazily → **stage** it as Parquet beside its
table (data are written once; this also cuts lineage, so a lost executor only recomputes from the
staged files) → all checks of a single date are observed by that write, those of a range are one
aggregation by date over the staged files → append the audit rows → gate on the audited rows →
publish the staged folders into the layer table by rename. Bad data therefore never reaches the
published table, the audit is always written, and the expensive lineage is computed exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contract import (AUDIT_SCHEMA, BUSINESS_KEY, GATE_COLUMNS, LAYER_PROFILES, PARTITION_COLUMNS,
                             SOURCE_REGISTRY, SUITES, THRESHOLDS)
from strata.functions.dates import date_parts, date_range
from strata.operators import gold, quality, silver
from strata.operators.bronze import attach_metadata
from strata.sinks import writers
from strata.sinks.writers import stage
from strata.sources import ledger, readers


@dataclass(frozen=True)
class Paths:
    landing: str
    bronze: str
    silver: str
    gold: str
    audit: str
    metrics: str
    baselines: str

    @property
    def daily(self) -> str:
        return f"{self.gold}/daily_summary"

    @property
    def kpi(self) -> str:
        return f"{self.gold}/kpi_summary"

    @property
    def kpi_state(self) -> str:
        return f"{self.gold}/kpi_state"

    @property
    def id_state(self) -> str:
        return f"{self.gold}/id_state"

    @classmethod
    def under(cls, root: str) -> "Paths":
        r = root.rstrip("/")
        return cls(f"{r}/landing", f"{r}/bronze", f"{r}/silver", f"{r}/gold",
                   f"{r}/quality_audit", f"{r}/metrics", f"{r}/schema_baselines")


def audit_and_gate(results: DataFrame, paths: Paths, run_id: str, layer: str,
                   execution_date: str | None, now: str, enforce: bool = True) -> DataFrame:
    """Evaluate the checks once, append the rows to the audit, then gate on them — the audit is
    always written first, and neither the layer nor the (growing) audit history is read again.

    The evaluated rows are at most one per check and date, so they are brought to the driver
    once and both the audit append and the gate use that small local copy.
    """
    spark = results.sparkSession
    rows = (quality.stamp(results, run_id, layer, execution_date, now)
            .select(*AUDIT_SCHEMA.fieldNames()).collect())
    stamped = spark.createDataFrame(rows, AUDIT_SCHEMA)
    writers.append_audit(stamped, paths.audit)
    if enforce:
        quality.gate_rows(rows)
    return stamped


# ---------------------------------------------------------------------------------------------
# Bronze
# ---------------------------------------------------------------------------------------------

def land_to_bronze_frame(spark: SparkSession, paths: Paths, execution_date: str, run_id: str,
                         ingested_at: str, registry: Sequence[dict] = SOURCE_REGISTRY,
                         layout: str = "dated", keep_source_column: bool = False) -> DataFrame:
    """All enabled sources landed for the date, stamped and unioned (lazy). Sources with no
    landed files are skipped."""
    presence = {r["source_id"]: r["files"] for r in
                readers.landing_presence(spark, paths.landing, execution_date, registry,
                                         layout).collect()}
    frames = []
    for src in registry:
        if not src.get("enabled", True) or presence.get(src["id"], 0) == 0:
            continue
        path = readers.landing_dir(paths.landing, execution_date, src["landing_subdir"], layout)
        df = readers.read_source(spark, path, src)
        frames.append(attach_metadata(df, run_id, src["source_system_label"], execution_date,
                                      ingested_at, keep_source_column))
    if not frames:
        raise ValueError(f"No landed files for {execution_date}")
    return readers.union_sources(frames)


def land_range_to_bronze_frame(spark: SparkSession, landing_root: str, start: str, end: str,
                               run_id: str, ingested_at: str,
                               registry: Sequence[dict] = SOURCE_REGISTRY,
                               keep_source_column: bool = False,
                               owned: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Every enabled source's files for [start, end] from a Hive-style landing zone, stamped
    with run metadata and the landing date of each file, unioned (one read per source). ``owned``
    names the paths to read of a source instead of all its folders."""
    frames = []
    for src in registry:
        if not src.get("enabled", True):
            continue
        df = readers.read_source_range(spark, landing_root, src, start, end, paths=(owned or {}).get(src["id"]))
        if df is None:
            continue
        frames.append(attach_metadata(df, run_id, src["source_system_label"], F.col("landing_date"),
                                      ingested_at, keep_source_column).drop("landing_date"))
    if not frames:
        raise ValueError(f"No landed files from {start} to {end}")
    return readers.union_sources(frames)


def bronze_range_job(spark: SparkSession, paths: Paths, start: str, end: str, run_id: str,
                     now: str, env: str = "dev", enforce: bool = True,
                     registry: Sequence[dict] = SOURCE_REGISTRY,
                     keep_source_column: bool = False, ledger_path: str | None = None) -> DataFrame:
    """Bronze for a whole date range in one pass (Hive-style landing zone). With ``ledger_path`` files
    whose contents another path delivered before are left out (:mod:`strata.sources.ledger`); the
    ledger is written after publishing."""
    found = {} if ledger_path is None else _file_owners(spark, paths.landing, start, end, registry, ledger_path)
    bronze = land_range_to_bronze_frame(spark, paths.landing, start, end, run_id, now, registry,
                                        keep_source_column, {k: at for k, (_, at) in found.items()})
    checks = quality.null_rate(GATE_COLUMNS["bronze"], bronze.columns,
                               THRESHOLDS[env]["bronze"]["max_null_rate"])
    with writers.staged_range(bronze, paths.bronze) as new:
        audit_and_gate(quality.evaluate(new.frame, checks, by=list(PARTITION_COLUMNS)), paths, run_id,
                       "bronze", None, now, enforce)
        new.publish(start, end)
    for source_id, (owners, _) in found.items():
        ledger.record(owners, ledger_path, source_id, run_id, now)
    return readers.read_range(spark, paths.bronze, start, end)


def _file_owners(spark: SparkSession, landing_root: str, start: str, end: str, registry: Sequence[dict],
                 ledger_path: str) -> dict[str, tuple[DataFrame, list[str]]]:
    """Per source that landed: the owners of its files' contents, and the paths to read."""
    out = {}
    for src in registry:
        folders = readers.range_folders(spark, landing_root, src, start, end) if src.get("enabled", True) else []
        if folders:
            digests = ledger.file_digests(spark, folders, readers.source_options(src))
            owners = stage(ledger.owners(digests, ledger.read_ledger(spark, ledger_path), src["id"]), "file-owners")
            out[src["id"]] = owners, ledger.owned_paths(owners, folders)
    return out


def bronze_path_job(spark: SparkSession, input_path: str, fmt: str, paths: Paths,
                    execution_date: str, run_id: str, now: str, source_system: str = "unknown",
                    env: str = "dev", keep_source_column: bool = False) -> DataFrame:
    """Bronze for one input folder of one format (the single-source form of the job). Fields are
    landed as text, as the registry's jobs land them."""
    raw = readers.read_source(spark, input_path, {"format": fmt})
    return _bronze_publish(spark, attach_metadata(raw, run_id, source_system, execution_date,
                                                  now, keep_source_column),
                           paths, execution_date, run_id, now, env)


def bronze_job(spark: SparkSession, paths: Paths, execution_date: str, run_id: str, now: str,
               env: str = "dev", **kwargs) -> DataFrame:
    """Bronze for every registry source landed for the date."""
    bronze = land_to_bronze_frame(spark, paths, execution_date, run_id, now, **kwargs)
    return _bronze_publish(spark, bronze, paths, execution_date, run_id, now, env)


def _bronze_publish(spark: SparkSession, bronze: DataFrame, paths: Paths, execution_date: str,
                    run_id: str, now: str, env: str) -> DataFrame:
    """Write the date beside the table and check it on the way, audit, gate, publish."""
    checks = quality.null_rate(GATE_COLUMNS["bronze"], bronze.columns,
                               THRESHOLDS[env]["bronze"]["max_null_rate"])
    _publish_date(bronze, checks, paths.bronze, paths, execution_date, run_id, "bronze", now)
    return readers.read_partition(spark, paths.bronze, execution_date)


def _publish_date(df: DataFrame, checks: Sequence[quality.Check], table: str, paths: Paths, execution_date: str,
                  run_id: str, layer: str, now: str) -> None:
    """One date of a layer: a single write beside the table observes the aggregates of all checks,
    so the gate scans nothing; then audit, gate, and publish by rename."""
    df, seen = quality.observe(df, checks)
    with writers.staged_date(df, table, execution_date) as new:
        audit_and_gate(quality.evaluate_observed(new.frame, seen, checks), paths, run_id, layer, execution_date, now)
        new.publish(execution_date, execution_date)


# ---------------------------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------------------------

def silver_frame(bronze: DataFrame, dim: DataFrame | None = None,
                 keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    s = silver.business_rules(silver.deduplicate(silver.cast_types(bronze), keys))
    return silver.enrich_with_dimension(s, dim) if dim is not None else s


def silver_checks(columns: Sequence[str], env: str) -> list[quality.Check]:
    t = THRESHOLDS[env]["silver"]
    return (quality.null_rate(GATE_COLUMNS["silver"], columns, t["max_null_rate"])
            + [quality.row_count(t["min_rows"], label="silver")])


def silver_job(spark: SparkSession, paths: Paths, execution_date: str, run_id: str, now: str,
               env: str = "dev", dim: DataFrame | None = None) -> DataFrame:
    bronze = readers.read_partition(spark, paths.bronze, execution_date)
    s = silver_frame(bronze, dim)
    _publish_date(s, silver_checks(s.columns, env), paths.silver, paths, execution_date, run_id, "silver", now)
    return readers.read_partition(spark, paths.silver, execution_date)


# ---------------------------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------------------------

def gold_checks(env: str, label: str) -> list[quality.Check]:
    return [quality.row_count(THRESHOLDS[env]["gold"]["min_rows"], label=label)]


def gold_job(spark: SparkSession, paths: Paths, execution_date: str, run_id: str, now: str,
             env: str = "dev", emit_metrics: bool = True) -> tuple[DataFrame, DataFrame]:
    """Daily summary and KPIs for one date; KPI rows also go to the metrics log."""
    s = readers.read_partition(spark, paths.silver, execution_date)
    # One slice = one date: daily and KPI groups coincide, so one aggregation feeds both.
    at = writers.stage_path(spark, f"{run_id}/gold-summaries")
    checks = gold_checks(env, "gold_daily") + gold_checks(env, "gold_kpis")
    # Daily and KPI tables are projections of the same aggregate: its write checks both.
    observed, seen = quality.observe(gold.compute_summaries(s), checks)
    summaries = stage(observed, "gold-summaries", path=at)
    daily = gold.daily_from_summaries(summaries, now)
    kpis = gold.kpis_from_summaries(summaries, execution_date, now)
    audit_and_gate(quality.evaluate_observed(summaries, seen, checks), paths, run_id, "gold", execution_date, now)
    writers.publish_partition(daily, paths.daily, execution_date)
    writers.publish_partition(kpis.withColumns(date_parts(execution_date)), paths.kpi,
                              execution_date)
    if emit_metrics:
        writers.write_metrics_log(kpis, paths.metrics, run_id)
    writers.discard(spark, at)
    return (readers.read_partition(spark, paths.daily, execution_date),
            readers.read_partition(spark, paths.kpi, execution_date))


def medallion_run(spark: SparkSession, paths: Paths, execution_date: str, run_id: str,
                  now: str, env: str = "dev", dim: DataFrame | None = None,
                  **bronze_kwargs) -> tuple[DataFrame, DataFrame]:
    """Bronze → Silver → Gold for one execution date in one session."""
    bronze_job(spark, paths, execution_date, run_id, now, env, **bronze_kwargs)
    silver_job(spark, paths, execution_date, run_id, now, env, dim)
    return gold_job(spark, paths, execution_date, run_id, now, env)


# ---------------------------------------------------------------------------------------------
# Backfill: one Spark job per layer over a whole date range
# ---------------------------------------------------------------------------------------------

def _empty_dates(have: set[tuple[int, int, int]], start: str, end: str,
                 only: set[tuple[int, int, int]] | None = None) -> list:
    return [d for d in date_range(start, end) if (d.year, d.month, d.day) not in have
            and (only is None or (d.year, d.month, d.day) in only)]


def _only(df: DataFrame, only: set[tuple[int, int, int]] | None) -> DataFrame:
    """The rows of some dates (a filter on partition columns: other folders are not opened)."""
    if only is None:
        return df
    key = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return df.where(key.isin([y * 10000 + m * 100 + d for y, m, d in sorted(only)]))


def backfill(spark: SparkSession, paths: Paths, start: str, end: str, run_id: str, now: str,
             env: str = "dev", dim: DataFrame | None = None, enforce: bool = True,
             emit_metrics: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Silver and Gold for every date in [start, end] from the Bronze table in one pass per
    layer. The date is part of the dedup key so the result equals one run per date; checks are
    evaluated per date in the same single aggregation."""
    silver_backfill(spark, paths, start, end, run_id, now, env, dim, enforce)
    daily, kpis = gold_backfill(spark, paths, start, end, run_id, now, env, enforce,
                                emit_metrics)
    return readers.read_range(spark, paths.silver, start, end), daily, kpis


def silver_backfill(spark: SparkSession, paths: Paths, start: str, end: str, run_id: str,
                    now: str, env: str = "dev", dim: DataFrame | None = None,
                    enforce: bool = True, only: set[tuple[int, int, int]] | None = None) -> None:
    """Silver for every date of the range (or for those ``only``) in one job (date in the dedup key)."""
    by = list(PARTITION_COLUMNS)
    bronze = _only(readers.read_range(spark, paths.bronze, start, end), only)
    new_rows = silver_frame(bronze, dim, keys=list(BUSINESS_KEY) + by)
    checks = silver_checks(new_rows.columns, env)
    with writers.staged_range(new_rows, paths.silver) as new:
        results = quality.evaluate(new.frame, checks, by=by).unionByName(quality.empty_date_row_counts(
            spark, _empty_dates(new.dates(start, end), start, end, only), THRESHOLDS[env]["silver"]["min_rows"], "silver"))
        audit_and_gate(results, paths, run_id, "silver", None, now, enforce)
        new.publish(start, end, only)


def gold_backfill(spark: SparkSession, paths: Paths, start: str, end: str, run_id: str,
                  now: str, env: str = "dev", enforce: bool = True,
                  emit_metrics: bool = False, only: set[tuple[int, int, int]] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """Daily summary and KPIs for every date of the range (or for those ``only``) from the Silver
    table: one fused aggregation, staged once, both tables published from it."""
    by = list(PARTITION_COLUMNS)
    silver_rng = _only(readers.read_range(spark, paths.silver, start, end), only)
    at = writers.stage_path(spark, f"{run_id}/summaries-range")
    summaries = stage(gold.compute_summaries(silver_rng), "summaries-range", partitioned=True, path=at)
    dates = writers.table_dates(spark, at, start, end)
    daily = gold.daily_from_summaries(summaries, now)
    kpis = gold.kpis_from_summaries(summaries, None, now, keep_date=True)
    g = THRESHOLDS[env]["gold"]["min_rows"]
    empty = _empty_dates(dates, start, end, only)
    results = quality.evaluate(summaries, [quality.row_count(g, label="gold_daily"),
                                           quality.row_count(g, label="gold_kpis")], by=by) \
        .unionByName(quality.empty_date_row_counts(spark, empty, g, "gold_daily")) \
        .unionByName(quality.empty_date_row_counts(spark, empty, g, "gold_kpis"))
    audit_and_gate(results, paths, run_id, "gold", None, now, enforce)
    writers.publish_range(daily, paths.daily, start, end, only)
    writers.publish_range(kpis, paths.kpi, start, end, only)
    if emit_metrics:
        writers.write_metrics_log(kpis, paths.metrics, run_id)
    writers.discard(spark, at)
    return (readers.read_range(spark, paths.daily, start, end),
            readers.read_range(spark, paths.kpi, start, end))


def state_backfill(spark: SparkSession, paths: Paths, start: str, end: str) -> None:
    """The KPI states of every date of the range from the Silver table, published by date."""
    silver_rng = readers.read_range(spark, paths.silver, start, end)
    writers.publish_range(gold.kpi_state(silver_rng), paths.kpi_state, start, end)
    writers.publish_range(gold.id_state(silver_rng), paths.id_state, start, end)


def range_kpis(spark: SparkSession, paths: Paths, start: str, end: str, now: str) -> DataFrame:
    """KPIs per source over a whole range, with exact distinct ids, from the states alone."""
    return gold.kpis_from_states(readers.read_range(spark, paths.kpi_state, start, end),
                                 readers.read_range(spark, paths.id_state, start, end), end, now)


# ---------------------------------------------------------------------------------------------
# Post-transform quality stage
# ---------------------------------------------------------------------------------------------

def profile_checks(layer: str, df: DataFrame, baseline: list[str] | None, execution_date: str,
                   base_path: str, env: str | None = None) -> list[quality.Check]:
    """Row-count floor, null rates, schema drift and partition presence for one layer slice.
    ``env`` switches the thresholds to the environment table instead of the fixed profile."""
    p = dict(LAYER_PROFILES[layer])
    if env is not None:
        p["min_rows"] = THRESHOLDS[env][layer]["min_rows"]
        p["max_null_rate"] = THRESHOLDS[env][layer]["max_null_rate"]
    return ([quality.row_count(p["min_rows"], label=layer)]
            + quality.null_rate(p["columns"], df.columns, p["max_null_rate"])
            + [quality.schema_drift(df.columns, baseline, layer),
               quality.partition_exists(execution_date, base_path)])


def profile_for(spark: SparkSession, layer: str, df: DataFrame, execution_date: str,
                base_path: str, baselines: str, env: str | None = None) -> list[quality.Check]:
    """A layer's profile checks against its saved schema baseline; the first run writes the
    baseline (column names only)."""
    base = writers.read_schema_baseline(spark, baselines, layer)
    checks = profile_checks(layer, df, base, execution_date, base_path, env)
    if base is None:
        writers.write_schema_baseline(spark, baselines, layer, df.columns)
    return checks


def suite_for(layer: str, max_rows: int | None = None) -> list[dict]:
    """The layer's expectations, with another upper bound on its rows if ``max_rows`` is given."""
    return [{**e, "kwargs": {**e["kwargs"], "max_value": max_rows}}
            if max_rows is not None and e["expectation_type"] == "expect_table_row_count_to_be_between"
            else e for e in SUITES[layer]]


def run_suite(df: DataFrame, layer: str, suite: Sequence[dict] | None = None,
              max_rows: int | None = None) -> DataFrame:
    return quality.evaluate(df, quality.compile_suite(suite_for(layer, max_rows) if suite is None else suite,
                                                      df.columns))


def quality_stage(spark: SparkSession, paths: Paths, execution_date: str, run_id: str,
                  now: str, enforce: bool = True, env: str | None = None) -> DataFrame:
    """Silver suite + profile, then Gold suite (daily summary) and profile (KPI summary). The
    suite and the profile of a table are compiled into one check list, so every table is
    scanned by one aggregation (plus the uniqueness aggregation of the Silver suite). All
    results are appended as NDJSON audit rows before any gate. ``env`` takes the thresholds of
    that environment instead of the fixed profiles."""
    silver_df = readers.read_partition(spark, paths.silver, execution_date)
    daily = readers.read_partition(spark, paths.daily, execution_date)
    kpis = readers.read_partition(spark, paths.kpi, execution_date)

    def profile(layer: str, df: DataFrame, base_path: str) -> list[quality.Check]:
        return profile_for(spark, layer, df, execution_date, base_path, paths.baselines, env)

    parts = [
        ("silver", quality.evaluate(silver_df, quality.compile_suite(
            SUITES["silver"], silver_df.columns) + profile("silver", silver_df, paths.silver))),
        ("gold", run_suite(daily, "gold")),
        ("gold", quality.evaluate(kpis, profile("gold", kpis, paths.kpi))),
    ]
    out = None
    for layer, res in parts:
        stamped = quality.stamp(res, run_id, layer, execution_date, now)
        out = stamped if out is None else out.unionByName(stamped)
    staged = stage(out, f"{run_id}/quality")
    writers.append_ndjson(staged, f"{paths.audit}_ndjson")
    if enforce:
        quality.gate(staged)
    return staged
