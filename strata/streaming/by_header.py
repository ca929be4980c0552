"""Incremental landing → Bronze for files whose columns differ.

A CSV stream has one schema and reads by position, so it can only refuse a file with another header
(:mod:`strata.streaming.landing`). Here the stream is one of file names: every micro-batch hands its
new files to the batch reader, which groups them by header or footer and joins them by name
(:mod:`strata.sources.layouts`), and their rows are appended to Bronze by rename. File names carry the
source and the number of the micro-batch; a micro-batch that runs again replaces its own files, so
the append is exactly once, also across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.bronze import attach_metadata
from strata.sinks import writers
from strata.sources import layouts, readers

FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_files(spark: SparkSession, paths: list[str], src: dict, bronze_root: str, run_id: str, ingested_at: str,
                 tag: str, schema: T.StructType | None = None, keep_source_column: bool = False) -> None:
    """Append the rows of landed files (in ``landing_date=`` folders) to Bronze as files named by ``tag``."""
    df = readers.read_source(spark, paths, src, schema=schema, keep_file=True)
    dated = df.withColumn("landing_date", readers.landing_date_column(F.col("_source_file"))).drop("_source_file")
    rows = attach_metadata(dated, run_id, src["source_system_label"], F.col("landing_date"), ingested_at,
                           keep_source_column).drop("landing_date")
    with writers.staged_range(rows, bronze_root) as new:
        new.append(tag)


def start_stream(spark: SparkSession, landing_root: str, bronze_root: str, checkpoint: str, src: dict, run_id: str,
                 ingested_at: str, schema: T.StructType | None = None, max_files_per_trigger: int = 1000,
                 keep_source_column: bool = False) -> StreamingQuery:
    """One registry source as a stream of files (at most ``max_files_per_trigger`` names reach the
    driver at a time) that drains what has landed and stops."""
    reader = (spark.readStream.format("binaryFile").schema(FILES).options(**readers.source_options(src))
              .option("maxFilesPerTrigger", max_files_per_trigger))
    files = reader.load(f"{landing_root.rstrip('/')}/{src['landing_subdir']}").where("length > 0").select(
        F.col("_metadata.file_path").alias("file"))  # names only, contents are not read

    def ingest(batch: DataFrame, number: int) -> None:
        paths = sorted(layouts.literal_path(r.file) for r in batch.collect())
        if paths:
            ingest_files(batch.sparkSession, paths, src, bronze_root, run_id, ingested_at, f"{src['id']}-{number:08}",
                         schema, keep_source_column)

    return files.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()


def run_stream(*args, **kwargs) -> StreamingQuery:
    """Start the stream and wait until everything landed is ingested."""
    q = start_stream(*args, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q
