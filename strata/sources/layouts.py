"""Files of one source that do not all have the same columns.

A delivery may add, drop, rename or reorder columns from one file to the next. Reading such files
in one go is wrong without an error for CSV (every file is read by position with one file's
header) and loses columns or fails for Parquet. Here the files are grouped by their columns
first, every group is read with its own schema, and the groups are joined by name.

* CSV: one distributed pass reads the first line of every file (a task per file stops after its
  first lines). Files are then grouped by header; the driver sees one row per folder, and file
  names only of folders that hold several headers.
* Parquet: the footers of all files are merged in one distributed job. Only if types contradict
  each other the files are halved, part by part in the same way, down to some 64 files whose
  footers are read one by one; files that agree are put together again. One change of types over
  a range costs a few jobs; files that alternate all the way cost a footer read for each file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_GLOB = re.compile(r"([\[\]{}*?\\])")
# Where types contradict each other, footers of so few files are read one by one, so many at once.
_ONE_BY_ONE, _AT_ONCE = 64, 16
# A file larger than this is split into several first-line tasks; only its first one counts.
_WHOLE_FILE = 1 << 40


def literal_path(uri: str) -> str:
    """A listed file's address as a path that readers take literally (no escapes, no globs)."""
    parts = urlsplit(uri)
    at = f"{parts.scheme}://{parts.netloc}" if parts.netloc else f"{parts.scheme}:" if parts.scheme else ""
    return at + _GLOB.sub(r"\\\1", unquote(uri[len(at):] if uri.startswith(at) else parts.path))


# ---------------------------------------------------------------------------------------------
# CSV
# ---------------------------------------------------------------------------------------------

def first_lines(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> DataFrame:
    """``path, line``: the first non-blank line of every file that has one."""
    from strata.sinks.writers import stage_path
    own = spark.newSession()  # file packing is a session setting: here every file is a task of its own
    own.conf.set("spark.sql.files.maxPartitionBytes", str(_WHOLE_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(_WHOLE_FILE))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    lines = own.read.options(**options).text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("at"))

    def first(batches):
        for batch in batches:
            for i, line in enumerate(batch.column("line").to_pylist()):
                if line.strip():
                    if batch.column("at")[i].as_py() == 0:
                        yield batch.slice(i, 1).select(["path", "line"])
                    return

    tasks = 4 * spark.sparkContext.defaultParallelism
    at = stage_path(spark, "first-lines")
    lines.mapInArrow(first, "path string, line string").coalesce(tasks).write.parquet(at)
    return spark.read.schema("path string, line string").parquet(at)


def header_names(line: str, separator: str = ",") -> list[str]:
    """Column names of a header line, made distinct the way the CSV reader does: a blank name is
    ``_c<i>``, repeated ones (case aside) get their place appended."""
    names = next(csv.reader([line.lstrip("﻿")], delimiter=separator))
    if line.count('"') % 2:
        raise ValueError(f"A CSV header goes over several lines: {line[:200]}")
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def _place(path: str) -> str:
    """The path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def header_groups(spark: SparkSession, paths: Sequence[str], options: dict[str, str]
                  ) -> list[tuple[str, list[str], bool]]:
    """``(header line, paths, whether the paths are single files)`` for every header found below
    ``paths``. Files without any line are left out."""
    heads = first_lines(spark, paths, options)
    lines = [r.line for r in heads.select("line").distinct().collect()]
    if len(lines) < 2:
        return [(line, list(paths), False) for line in lines]
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    found = heads.groupBy(folder.alias("folder")).agg(F.collect_set("line").alias("lines")).collect()
    folders = sorted(r.folder for r in found)
    nested = {a for a, b in zip(folders, folders[1:]) if b.startswith(a + "/")} if options.get(
        "recursiveFileLookup") == "true" else set()
    whole: dict[str, list[str]] = {}
    # Folders given as such are read whole; of others only the files that were given.
    given = tuple(_place(p).rstrip("/") + "/" for p in paths)
    mixed = []
    for r in found:
        if len(r.lines) > 1 or r.folder in nested or not (_place(literal_path(r.folder)) + "/").startswith(given):
            mixed.append(r.folder)
        else:
            whole.setdefault(r.lines[0], []).append(literal_path(r.folder))
    groups = [(line, sorted(at), False) for line, at in whole.items()]
    if mixed:
        files: dict[str, list[str]] = {}
        for r in heads.where(folder.isin(mixed)).collect():
            files.setdefault(r.line, []).append(literal_path(r.path))
        groups += [(line, sorted(at), True) for line, at in files.items()]
    return sorted(groups)


def read_csv_by_header(spark: SparkSession, paths: Sequence[str], options: dict[str, str],
                       schema: T.StructType | None, read: Callable[..., DataFrame]) -> list[DataFrame]:
    """One frame per header below ``paths``. ``read(paths, schema, options)`` opens files. Without
    ``schema`` all columns are text; with it every frame has its columns, found by name (case
    aside), NULL where a file has no such column."""
    frames = []
    for line, at, single in header_groups(spark, paths, options):
        names = header_names(line, options.get("sep", options.get("delimiter", ",")))
        wanted = {f.name.lower(): f for f in schema.fields} if schema is not None else {}
        fields = [T.StructField(n, wanted[n.lower()].dataType if n.lower() in wanted else T.StringType()) for n in names]
        own = {k: v for k, v in options.items() if not single or k not in ("recursiveFileLookup", "pathGlobFilter")}
        frames.append(read(at, T.StructType(fields), own))
    return frames


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` by name (case aside), NULL where ``df`` has none, and ``keep``."""
    from strata.functions.columns import col_ref
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(col_ref(have[f.name.lower()]) if f.name.lower() in have else F.lit(None).cast(f.dataType))
                       .alias(f.name) for f in schema.fields], *[col_ref(c) for c in keep])


# ---------------------------------------------------------------------------------------------
# Parquet
# ---------------------------------------------------------------------------------------------

def _merges(a: T.StructType, b: T.StructType) -> bool:
    types = {f.name.lower(): (f.name, f.dataType) for f in a.fields}
    return all(types.get(f.name.lower(), (f.name, f.dataType)) == (f.name, f.dataType) for f in b.fields)


def _merged(a: T.StructType, b: T.StructType) -> T.StructType:
    names = {f.name for f in a.fields}
    return T.StructType([*a.fields, *(f for f in b.fields if f.name not in names)])


def _footers(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> T.StructType | None:
    """The merged schema of all files below ``paths`` (one job over their footers); None if types
    contradict each other."""
    try:
        return spark.read.options(**options).option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:  # raised in a task or on the driver
        if "CANNOT_MERGE_SCHEMAS" in str(e) or "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" in str(e):
            return None
        raise


def schema_groups(spark: SparkSession, paths: Sequence[str], options: dict[str, str]
                  ) -> list[tuple[T.StructType, list[str], bool]]:
    """``(schema, paths, whether the paths are single files)``: the fewest groups found whose files
    can be read as one frame."""
    schema = _footers(spark, paths, options)
    if schema is not None:
        return [(schema, list(paths), False)]
    files = sorted(literal_path(f) for f in
                   spark.read.options(**options).schema("_ int").parquet(*paths).inputFiles())

    def add(groups: list[tuple[T.StructType, list[str], bool]], own: T.StructType, at: list[str]) -> None:
        k = next((i for i, g in enumerate(groups) if _merges(g[0], own)), None)
        if k is None:
            groups.append((own, at, True))
        else:
            groups[k] = (_merged(groups[k][0], own), groups[k][1] + at, True)

    def parts(part: list[str]) -> list[tuple[T.StructType, list[str], bool]]:
        groups: list[tuple[T.StructType, list[str], bool]] = []
        if len(part) <= _ONE_BY_ONE:
            with ThreadPoolExecutor(_AT_ONCE) as pool:
                for file, own in zip(part, pool.map(lambda f: spark.read.parquet(f).schema, part)):
                    add(groups, own, [file])
            return groups
        found = _footers(spark, part, {})
        if found is not None:
            return [(found, part, True)]
        for half in (part[:len(part) // 2], part[len(part) // 2:]):
            for own, at, _ in parts(half):
                add(groups, own, at)
        return groups

    return parts(files)
