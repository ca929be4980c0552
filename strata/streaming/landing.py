"""Incremental landing → Bronze with Structured Streaming.

The batch Bronze job re-reads a date's landing folder and overwrites the date. This is the
same operator run incrementally: a file-source stream picks up only files it has not seen
(tracked in the checkpoint), stamps them with run metadata and the landing date taken from the
file's folder, and appends them to the Bronze table through the file sink's transaction log —
exactly once, also across restarts and lost executors. ``trigger(availableNow=True)`` drains
everything landed so far and stops, so the scheduler can still run it as a daily batch.

Contract difference to the batch job: Bronze is append-only here (a re-delivered file under a
new name is ingested again); reruns of a date are the batch job's job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.contract import PARTITION_COLUMNS
from strata.operators.bronze import attach_metadata
from strata.sources.readers import NO_LINES, PAGE_PARTITION_COLUMNS, landing_date_column, page_schema, unwrap_pages


def read_landing_stream(spark: SparkSession, landing_root: str, src: dict,
                        schema: T.StructType, max_files_per_trigger: int | None = None
                        ) -> DataFrame:
    """Streaming read of one registry source's landing folder (Hive-style ``landing_date=``
    folders); ``schema`` is the record schema (streams never infer). Adds ``landing_date``."""
    path = f"{landing_root.rstrip('/')}/{src['landing_subdir']}"
    reader = spark.readStream.option("recursiveFileLookup", True)
    if src.get("file_pattern"):
        reader = reader.option("pathGlobFilter", src["file_pattern"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    fmt = src["format"]
    if fmt == "json_pages":
        raw = (reader.schema(page_schema(schema)).options(**NO_LINES).json(path)
                     .withColumn("__file", F.col("_metadata.file_path")))
        df = unwrap_pages(raw)
    elif fmt == "csv":
        # A file with other columns stops the stream instead of being read by position.
        df = (reader.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
                    .option("multiLine", src.get("multi_line", True)).csv(path)
                    .withColumn("__file", F.col("_metadata.file_path")))
    elif fmt == "parquet":
        df = reader.schema(schema).parquet(path).withColumn("__file",
                                                           F.col("_metadata.file_path"))
    else:
        raise ValueError(f"Unsupported format: {fmt}")
    cols = [c for c in df.columns if c not in PAGE_PARTITION_COLUMNS and c != "__file"]
    return df.select(*cols, landing_date_column(F.col("__file")).alias("landing_date"))


def start_bronze_stream(spark: SparkSession, landing_root: str, bronze_root: str,
                        checkpoint: str, registry: Sequence[dict], schema: T.StructType,
                        run_id: str, ingested_at: str, available_now: bool = True,
                        max_files_per_trigger: int | None = None,
                        keep_source_column: bool = False) -> StreamingQuery:
    """One streaming query over all enabled sources (unioned), appending to Bronze partitioned
    by the landing date. The checkpoint must live in shared storage."""
    frames = []
    for src in registry:
        if not src.get("enabled", True):
            continue
        s = read_landing_stream(spark, landing_root, src, schema, max_files_per_trigger)
        frames.append(attach_metadata(s, run_id, src["source_system_label"],
                                      F.col("landing_date"), ingested_at,
                                      keep_source_column).drop("landing_date"))
    stream = frames[0]
    for f in frames[1:]:
        stream = stream.unionByName(f)
    writer = (stream.writeStream.format("parquet").outputMode("append")
                    .option("checkpointLocation", checkpoint)
                    .partitionBy(*PARTITION_COLUMNS))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start(bronze_root)


def run_bronze_stream(*args, **kwargs) -> StreamingQuery:
    """Start the stream with ``availableNow`` and wait until everything landed is ingested."""
    q = start_bronze_stream(*args, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
