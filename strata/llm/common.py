"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

# White space of the word contract: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: later steps start from
    the files, so a lost executor costs no recomputation of what came before. ``options`` are the
    writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """What is written here frees its shuffles when it is written, not when the driver happens to
    collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage_parts(df: DataFrame, name: str, part: str) -> tuple[DataFrame, str]:
    """As ``stage``, with a folder for each value of the column ``part``; returns the rows and the
    path. A folder whose rows nothing will read again can be discarded (``discard_part``), the
    other rows are read as before if they are chosen by ``part``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(part).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard_part(spark: SparkSession, path: str, part: str, value: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}={value}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(col: str = "text") -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs."""
    return F.regexp_count(text_or_empty(col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def release_memory() -> None:
    """Give freed memory back to the system. A worker lives on after its task, beside the workers and
    the JVM that run the next one; what it keeps counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_slices(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
               rows: int = 512) -> DataFrame:
    """``mapInPandas`` by slices of an Arrow batch, so that the Python objects of a few hundred
    rows at a time exist, however many rows a batch has."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            out = None
            for at in range(0, batch.num_rows, rows):
                out = function(batch.slice(at, rows).to_pandas(integer_object_nulls=True))
                yield pa.RecordBatch.from_pandas(out[arrow.names], schema=arrow, preserve_index=False)
            del batch, out
            release_memory()

    return df.mapInArrow(run, schema)


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` (longs, any direction, repeats allowed) → ``(id, component)`` with the
    smallest reachable id, for every id that occurs in a link.

    Each round takes the smallest label among the neighbours and then the label of that label
    (pointer jumping), so long chains shrink geometrically. Labels are written to the shared
    scratch folder each round; only the number of changed labels reaches the driver. A hub's
    rows are on the probe side of plain equi-joins, which adaptive execution can split, and are
    pre-aggregated by the map side of ``min``.
    """
    pairs = links.where("a != b").select("a", "b")
    edges = stage(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "cc-edges")
    labels = stage(edges.groupBy(F.col("a").alias("id"))
                   .agg(F.min("b").alias("nb"))
                   .select("id", F.least("id", "nb").alias("component")), "cc-labels")
    while True:
        own = labels.select("id", "component", F.col("component").alias("old"))
        around = (edges.join(labels, edges.b == labels.id)
                  .select(F.col("a").alias("id"), "component", F.lit(None).cast("long").alias("old"))
                  .union(own).groupBy("id")
                  .agg(F.min("component").alias("near"), F.min("old").alias("old")))
        target = labels.select(F.col("id").alias("near"), F.col("component").alias("jump"))
        moved = stage(around.join(target, "near")
                      .select("id", F.least("near", "jump").alias("component"),
                              (F.least("near", "jump") != F.col("old")).alias("moved")), "cc-labels")
        labels = moved.select("id", "component")
        if not moved.where("moved").limit(1).count():
            return labels
