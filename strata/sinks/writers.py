"""Writers: partition publishing, metrics log, audit log, schema baselines, landing extracts.

Publishing contract: rerunning a date replaces exactly that date's partition and leaves every
other date alone. New partitions are written once, into ``<table>/_staging/<id>`` (a name that
readers of the table skip), and moved into place by rename:

* a date that is replaced is first set aside under ``<table>/_replaced/<id>`` and removed only when
  all dates of the publish are in place; if a step fails, everything is moved back. A date is
  missing for the time of one rename, never half there. (On stores whose rename is a copy it is
  as slow as that copy.) What a killed driver left behind is moved back by the next publish;
* an empty rerun publishes one footer-only file, so the date reads back as empty rather than
  keeping stale rows; dates of a range that the table holds but the new rows do not are emptied
  the same way, dates it never had need no folder;
* a range is staged with rows rebalanced by date (AQE splits a huge date across tasks and merges
  small ones). A table has one publisher at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from strata.contract import AUDIT_SCHEMA, PARTITION_COLUMNS
from strata.functions.columns import col_ref
from strata.functions.dates import parse_date
from strata.operators.quality import stamp


def leaf_path(root: str, execution_date: str) -> str:
    d = parse_date(execution_date)
    return f"{root.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}"


def publish_partition(df: DataFrame, root: str, execution_date: str) -> str:
    """Replace one date's partition with ``df`` (which must hold only that date's rows)."""
    with staged_date(df, root, execution_date) as new:
        new.publish(execution_date, execution_date)
    return leaf_path(root, execution_date)


_PART_DIR = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/?$")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a staged copy."""
    from strata.session import scratch_path
    return scratch_path(spark, f"stage-{name}")


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged copy that was published."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str, partitioned: bool = False, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder (``spark.checkpoint.dir``; at ``path`` if
    given) and return the re-read Parquet frame: cuts lineage so later actions — and a lost
    executor — start from files, not from the full upstream plan."""
    spark = df.sparkSession
    path = path or stage_path(spark, name)
    if partitioned:
        # One shuffle by date: AQE splits a huge date and merges small ones, so every staged
        # (and later published) file holds one date at about the advisory size instead of
        # every task writing a small file into every date.
        df.hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite") \
          .partitionBy(*PARTITION_COLUMNS).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    # The known schema avoids inference and keeps an empty staged frame readable.
    back = spark.read.schema(df.schema).parquet(path)
    return back.select(*df.columns)


# ---------------------------------------------------------------------------------------------
# Publishing by rename
# ---------------------------------------------------------------------------------------------

class _Files:
    """The file system of a table, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def rename(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.path(new).getParent())
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(name)))

    def copy(self, old: str, new: str) -> None:
        copied = self.jvm.org.apache.hadoop.fs.FileUtil.copy(
            self.fs, self.path(old), self.fs, self.path(new), False, self.conf)
        if not copied:
            raise OSError(f"{old} could not be copied to {new}")


def _leaf(date: tuple[int, int, int]) -> str:
    return "year={}/month={}/day={}".format(*date)


def replace_leaves(files: _Files, root: str, moves: Sequence[tuple[str, str]], run: str) -> None:
    """Move every staged folder to its leaf of the table, all or none: what was there is set aside
    and comes back if a step fails."""
    aside = f"{root}/_replaced/{run}"
    undo: list[tuple[str, str]] = []
    try:
        for new, leaf in moves:
            target = f"{root}/{leaf}"
            if files.exists(target):
                files.rename(target, f"{aside}/{leaf}")
                undo.append((f"{aside}/{leaf}", target))
            files.rename(new, target)
            undo.append((target, new))
    except BaseException:
        for old, new in reversed(undo):
            files.rename(old, new)
        raise
    files.delete(aside)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Move back the leaves that a publish set aside and, because its driver died, neither replaced
    nor removed. Returns them."""
    files, root = _Files(spark, root), root.rstrip("/")
    back = []
    for run in files.names(f"{root}/_replaced"):
        base = f"{root}/_replaced/{run}"
        for y in files.names(base):
            for m in files.names(f"{base}/{y}"):
                for d in files.names(f"{base}/{y}/{m}"):
                    leaf = f"{y}/{m}/{d}"
                    if not files.exists(f"{root}/{leaf}"):
                        files.rename(f"{base}/{leaf}", f"{root}/{leaf}")
                        back.append(leaf)
        files.delete(base)
    return back


@dataclass
class Staged:
    """New date partitions of the table ``root``, written once at ``at`` beside it; ``frame`` reads
    them."""

    frame: DataFrame
    root: str
    at: str

    @property
    def spark(self) -> SparkSession:
        return self.frame.sparkSession

    def dates(self, start: str, end: str) -> set[tuple[int, int, int]]:
        return table_dates(self.spark, self.at, start, end)

    def publish(self, start: str, end: str, only: set[tuple[int, int, int]] | None = None) -> list[str]:
        """Move the dates of [start, end] (or those ``only``) into the table and empty those that the
        table holds but the staged rows do not; returns the emptied leaves. Staged rows of other
        dates are not published; rows without a date belong to no partition and are an error."""
        files = _Files(self.spark, self.root)
        if any("__HIVE_DEFAULT_PARTITION__" in leaf for leaf in _leaves(files, self.at)):
            undated = self.frame.where(" OR ".join(f"{c} IS NULL" for c in PARTITION_COLUMNS)).count()
            raise ValueError(f"{undated} rows have no {'/'.join(PARTITION_COLUMNS)} and fit no partition")
        recover(self.spark, self.root)
        new, old = self.dates(start, end), table_dates(self.spark, self.root, start, end)
        if only is not None:
            new, old = new & only, old & only
        stale = sorted(old - new)
        if stale:
            empty = f"{self.at}/_empty"
            _without_date(self.frame).limit(0).write.mode("overwrite").parquet(empty)
            for date in stale:
                for name in files.names(empty):
                    files.copy(f"{empty}/{name}", f"{self.at}/{_leaf(date)}/{name}")
        leaves = [_leaf(d) for d in sorted(new | set(stale))]
        replace_leaves(files, self.root, [(f"{self.at}/{leaf}", leaf) for leaf in leaves], self.at.rsplit("/", 1)[1])
        return [f"{self.root}/{_leaf(d)}" for d in stale]

    def append(self, tag: str) -> None:
        """Add the staged files to the table's date folders under names that start with ``tag``. Files of
        that tag that are there already (from a run that was cut short) go first."""
        files = _Files(self.spark, self.root)
        for leaf in _leaves(files, self.at):
            if "__HIVE_DEFAULT_PARTITION__" in leaf:
                raise ValueError(f"rows have no {'/'.join(PARTITION_COLUMNS)} and fit no partition")
            for name in files.names(f"{self.root}/{leaf}"):
                if name.startswith(f"{tag}-"):
                    files.delete(f"{self.root}/{leaf}/{name}")
            parts = [n for n in files.names(f"{self.at}/{leaf}") if not n.startswith(("_", "."))]
            for i, name in enumerate(parts):
                files.rename(f"{self.at}/{leaf}/{name}", f"{self.root}/{leaf}/{tag}-{i:05}.parquet")


def _without_date(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in PARTITION_COLUMNS if c in df.columns])


def _leaves(files: _Files, at: str) -> list[str]:
    """The date folders ``year=…/month=…/day=…`` below ``at``."""
    return [f"{y}/{m}/{d}" for y in files.names(at) if y.startswith("year=")
            for m in files.names(f"{at}/{y}") if m.startswith("month=")
            for d in files.names(f"{at}/{y}/{m}") if d.startswith("day=")]


def _staging(root: str) -> str:
    return f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex[:12]}"


def _unstage(spark: SparkSession, root: str, at: str) -> None:
    """Remove a staged copy, and the working folders and the table's own that are empty then."""
    files = _Files(spark, root)
    files.delete(at)
    for folder in (f"{root}/_staging", f"{root}/_replaced", root):
        if files.exists(folder) and not files.names(folder):
            files.delete(folder)


@contextmanager
def staged_date(df: DataFrame, root: str, execution_date: str):
    """One date's rows written beside the table, to be checked and published; what was not
    published goes at the end. Partition columns that ``df`` lacks come from the date."""
    spark, at, root = df.sparkSession, _staging(root), root.rstrip("/")
    try:
        _without_date(df).write.parquet(leaf_path(at, execution_date))
        schema = StructType([f for f in df.schema.fields if f.name not in PARTITION_COLUMNS]
                            + [StructField(c, IntegerType()) for c in PARTITION_COLUMNS])
        columns = [*df.columns, *(c for c in PARTITION_COLUMNS if c not in df.columns)]
        yield Staged(spark.read.schema(schema).parquet(at).select(*[col_ref(c) for c in columns]), root, at)
    finally:
        _unstage(spark, root, at)


@contextmanager
def staged_range(df: DataFrame, root: str):
    """Rows of any dates written beside the table, one folder per date."""
    spark, at, root = df.sparkSession, _staging(root), root.rstrip("/")
    try:
        yield Staged(stage(df, "range", partitioned=True, path=at), root, at)
    finally:
        _unstage(spark, root, at)


def publish_range(df: DataFrame, root: str, start: str, end: str,
                  only: set[tuple[int, int, int]] | None = None) -> list[str]:
    """Replace every date partition of [start, end] with the rows of ``df`` for that date (see
    :meth:`Staged.publish`); returns the emptied leaves."""
    with staged_range(df, root) as new:
        return new.publish(start, end, only)


def table_dates(spark: SparkSession, root: str, start: str, end: str
                ) -> set[tuple[int, int, int]]:
    """Dates of [start, end] that have a folder in the table: one listing of date folders per
    month, no files and no job. A missing table has none."""
    from strata.sources.readers import existing_paths, range_globs
    folders = existing_paths(spark, range_globs(root.rstrip("/"), start, end))
    return {tuple(map(int, m.groups())) for f in folders if (m := _PART_DIR.search(f))}


def write_metrics_log(kpis: DataFrame, path: str, pipeline_run_id: str) -> None:
    """Append KPI rows + run id as JSON lines in one file (KPI rows are one per source/date)."""
    (kpis.withColumn("pipeline_run_id", F.lit(pipeline_run_id))
         .coalesce(1).write.mode("append").json(path))


def write_audit(results: DataFrame, path: str, pipeline_run_id: str, layer: str,
                execution_date: str, now: str) -> None:
    """Append stamped quality rows to the Parquet audit table (partitioned by layer)."""
    (stamp(results, pipeline_run_id, layer, execution_date, now)
        .select(*AUDIT_SCHEMA.fieldNames())
        .coalesce(1).write.mode("append").partitionBy("layer").parquet(path))


def append_audit(stamped: DataFrame, path: str) -> None:
    """Append already-stamped audit rows (small) to the Parquet audit table."""
    (stamped.select(*AUDIT_SCHEMA.fieldNames())
        .coalesce(1).write.mode("append").partitionBy("layer").parquet(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit rows; the explicit schema keeps an audit root that never got a row readable, and a
    root that does not exist yet reads as an empty audit."""
    from strata.sources.readers import is_missing_path
    try:
        df = spark.read.schema(AUDIT_SCHEMA).parquet(path)
        df.schema
        return df
    except AnalysisException as e:
        if is_missing_path(e):
            return spark.createDataFrame([], AUDIT_SCHEMA)
        raise


def write_audit_ndjson(results: DataFrame, path: str, pipeline_run_id: str, layer: str,
                       execution_date: str, now: str) -> None:
    """Append stamped quality rows as JSON lines under ``layer=…/execution_date=…``."""
    append_ndjson(stamp(results, pipeline_run_id, layer, execution_date, now), path)


def append_ndjson(stamped: DataFrame, path: str) -> None:
    """Append already-stamped audit rows as JSON lines (one small file per layer and date)."""
    (stamped.select(*AUDIT_SCHEMA.fieldNames())
        .coalesce(1).write.mode("append").partitionBy("layer", "execution_date").json(path))


def read_audit_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).json(path)


def baseline_path(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/{layer}_schema_ref"


def read_schema_baseline(spark: SparkSession, root: str, layer: str) -> list[str] | None:
    """Saved column names of a layer, or None when no baseline exists yet."""
    from strata.sources.readers import is_missing_path
    try:
        rows = spark.read.schema("column_name string").json(baseline_path(root, layer)).collect()
    except AnalysisException as e:
        if is_missing_path(e):
            return None
        raise
    return sorted(r[0] for r in rows)


def write_schema_baseline(spark: SparkSession, root: str, layer: str,
                          columns: Sequence[str]) -> None:
    """Baseline lives in its own folder (never inside a table folder)."""
    (spark.createDataFrame([(c,) for c in sorted(set(columns))], "column_name string")
          .coalesce(1).write.mode("overwrite").json(baseline_path(root, layer)))


def land_extract(df: DataFrame, path: str, max_rows_per_file: int = 0) -> int:
    """Write a source extract to the landing zone with the source's own parallelism (files of at
    most ``max_rows_per_file`` rows if given) and return its row count from the written files (no
    second read of the source). Warns on zero rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    n = df.sparkSession.read.parquet(path).count()
    if n == 0:
        import warnings
        warnings.warn("zero rows exported", stacklevel=2)
    return n
