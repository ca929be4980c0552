"""Ledger of landed files: what was delivered again under another name is not ingested again.

A file is known by a digest of its contents. The first path that delivered a content owns it;
other paths with the same content are re-deliveries. An owner is read on every run, so a rerun of
a date gives the same rows; a re-delivery is never read, on whatever date it lands.

The digest is made from the file's lines by a plain aggregation (size, number of lines, and two
sums of 64-bit line hashes that do not depend on the order of lines), so files of any size are
digested by many tasks and binary files work too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LEDGER_SCHEMA = "source_id string, digest string, path string, bytes long, pipeline_run_id string, ingested_at string"
_DATE_FOLDER = re.compile(r"^(.*/landing_date=[0-9]{8})(?:/|$)")


def file_digests(spark: SparkSession, paths: Sequence[str], options: dict[str, str] | None = None) -> DataFrame:
    """``path, bytes, digest`` of every file with contents below ``paths``."""
    lines = spark.read.options(**(options or {})).option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), "value")
    wide = "decimal(38,0)"
    sums = lines.groupBy("path", "bytes").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("value").cast(wide)).alias("s1"),
        F.sum(F.xxhash64(F.lit(1), "value").cast(wide)).alias("s2"))
    return sums.select("path", "bytes", F.sha2(F.concat_ws(":", "bytes", "n", "s1", "s2"), 256).alias("digest"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows; a ledger that was never written is empty."""
    from strata.sources.readers import is_missing_path
    try:
        df = spark.read.schema(LEDGER_SCHEMA).parquet(path)
        df.schema
        return df
    except AnalysisException as e:
        if is_missing_path(e):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def owners(digests: DataFrame, ledger: DataFrame, source_id: str) -> DataFrame:
    """``path, bytes, digest, owner, known`` of every file: the path that owns its contents (the ledger's,
    else the first by name among these files), and whether the ledger has it."""
    held = ledger.where(F.col("source_id") == source_id).groupBy(F.col("digest").alias("old_digest")).agg(
        F.min("path").alias("old_owner"))
    first = F.min("path").over(Window.partitionBy("digest"))
    return (digests.withColumn("first", first).join(held, F.col("digest") == F.col("old_digest"), "left")
            .select("path", "bytes", "digest", F.coalesce("old_owner", "first").alias("owner"),
                    F.col("old_owner").isNotNull().alias("known")))


def record(found: DataFrame, path: str, source_id: str, run_id: str, ingested_at: str) -> None:
    """Append the new owners among ``found`` (rows of :func:`owners`); called when their rows are published,
    so a run that died before is simply repeated."""
    (found.where("NOT known AND path = owner")
     .select(F.lit(source_id).alias("source_id"), "digest", "path", "bytes", F.lit(run_id).alias("pipeline_run_id"),
             F.lit(ingested_at).alias("ingested_at"))
     .coalesce(1).write.mode("append").parquet(path))


def owned_paths(found: DataFrame, folders: Sequence[str]) -> list[str]:
    """What to read of date folders: the folder where all its files own their contents, else the
    files that do. Only names from folders with re-deliveries reach the driver."""
    from strata.sources.layouts import literal_path
    folder = F.regexp_extract("path", _DATE_FOLDER.pattern, 1)
    again = [r.folder for r in found.where("path != owner").select(folder.alias("folder")).distinct().collect()]
    if not again:
        return list(folders)
    mixed = {literal_path(f) for f in again}
    files = found.where("path = owner").where(folder.isin(again)).select("path").collect()
    return [f for f in folders if f.rstrip("/") not in mixed] + sorted(literal_path(r.path) for r in files)
