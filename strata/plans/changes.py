"""Backfill of the dates whose Bronze rows changed.

A date's fingerprint is an order-free sum of hashes over its Bronze rows without the run's stamps,
so landing the same rows again is no change. Fingerprints are kept beside the audit and compared
before any work is done; they are written after the dates they stand for are published, so a run
that fails is repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.contract import PARTITION_COLUMNS
from strata.functions.columns import col_ref
from strata.plans import jobs
from strata.sources import readers

STAMPS = ("pipeline_run_id", "ingested_at")
FINGERPRINT_SCHEMA = ("year int, month int, day int, fingerprint string, settings string, pipeline_run_id string, "
                      "written_at string")


def fingerprints(df: DataFrame) -> DataFrame:
    """``year, month, day, fingerprint``: rows of a date count with their repeats and by column name; one
    partial aggregation, a row per date."""
    by = list(PARTITION_COLUMNS)
    named = [F.concat_ws("=", F.lit(c), F.when(col_ref(c).isNotNull(), col_ref(c).cast("string"))) for c in
             sorted(df.columns) if c not in by and c not in STAMPS]
    sums = df.select(*by, F.xxhash64(*named).alias("_a"), F.xxhash64(F.lit(1), *named).alias("_b")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_a").cast("decimal(38,0)")).alias("a"),
        F.sum(F.col("_b").cast("decimal(38,0)")).alias("b"))
    return sums.select(*by, F.concat_ws(":", "n", "a", "b").alias("fingerprint"))


def _path(paths: jobs.Paths) -> str:
    return f"{paths.audit}_fingerprints"


def read_fingerprints(spark: SparkSession, paths: jobs.Paths) -> DataFrame:
    """The latest fingerprint of each date and its settings."""
    try:
        rows = spark.read.schema(FINGERPRINT_SCHEMA).parquet(_path(paths))
        rows.schema
    except AnalysisException as e:
        if not readers.is_missing_path(e):
            raise
        return spark.createDataFrame([], FINGERPRINT_SCHEMA)
    latest = Window.partitionBy(*PARTITION_COLUMNS).orderBy(F.col("written_at").desc(), F.col("pipeline_run_id").desc(),
                                                            "fingerprint")
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def changed_dates(spark: SparkSession, paths: jobs.Paths, start: str, end: str, settings: str = ""
                  ) -> tuple[DataFrame, set[tuple[int, int, int]]]:
    """Current fingerprints of [start, end], and the dates whose fingerprint or settings are not those
    of the last run (dates that Bronze lost since are among them)."""
    from strata.functions.dates import partition_range_predicate
    now = jobs.stage(fingerprints(readers.read_range(spark, paths.bronze, start, end)), "fingerprints")
    before = read_fingerprints(spark, paths).where(partition_range_predicate(start, end)).select(
        *PARTITION_COLUMNS, F.struct("fingerprint", "settings").alias("old"))
    differ = now.join(before, list(PARTITION_COLUMNS), "full").where(
        ~F.coalesce("fingerprint", F.lit("")).eqNullSafe(F.col("old.fingerprint")) | (F.col("old.settings") != settings))
    return now, {(r.year, r.month, r.day) for r in differ.select(*PARTITION_COLUMNS).collect()}


def backfill_changed(spark: SparkSession, paths: jobs.Paths, start: str, end: str, run_id: str, now: str,
                     env: str = "dev", dim: DataFrame | None = None, enforce: bool = True) -> list[str]:
    """Silver and Gold of the changed dates of [start, end], in one pass per layer; returns them. A run
    after which nothing changed reads Bronze for the fingerprints and writes nothing. Other
    ``env`` or dimension rows are a change of every date."""
    settings = env if dim is None else f"{env}:{_content(dim)}"
    current, changed = changed_dates(spark, paths, start, end, settings)
    if not changed:
        return []
    jobs.silver_backfill(spark, paths, start, end, run_id, now, env, dim, enforce, only=changed)
    jobs.gold_backfill(spark, paths, start, end, run_id, now, env, enforce, only=changed)
    dates = spark.createDataFrame(sorted(changed), "year int, month int, day int")
    (dates.join(current, list(PARTITION_COLUMNS), "left")
     .select(*PARTITION_COLUMNS, F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
             F.lit(settings).alias("settings"), F.lit(run_id).alias("pipeline_run_id"), F.lit(now).alias("written_at"))
     .coalesce(1).write.mode("append").parquet(_path(paths)))
    return ["{:04}-{:02}-{:02}".format(*d) for d in sorted(changed)]


def _content(df: DataFrame) -> str:
    """Order-free digest of a small table."""
    h = F.xxhash64(*[col_ref(c) for c in df.columns]).cast("decimal(38,0)")
    return str(tuple(df.agg(F.count(F.lit(1)), F.sum(h)).first()))
