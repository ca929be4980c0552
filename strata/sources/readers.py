"""Readers for landed files and layer tables.

Landing layouts: the documented daily drop ``<root>/<YYYYMMDD>/<subdir>/…`` (``layout="dated"``)
and a Hive-style ``<root>/<subdir>/landing_date=YYYYMMDD/…`` (``layout="hive"``), which lets one
read cover a whole date range with partition pruning instead of one job per day.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from strata.contract import SOURCE_REGISTRY
from strata.functions.columns import col_ref
from strata.functions.dates import date_range, parse_date, partition_predicate, partition_range_predicate
from strata.sources import layouts

FORMATS = ("csv", "json", "parquet")


def read_raw(spark: SparkSession, path: str | Sequence[str], fmt: str, *,
             schema: T.StructType | str | None = None, multi_line: bool = True,
             infer: bool = True, options: dict[str, str] | None = None) -> DataFrame:
    """Format dispatch (case-insensitive) for landed files; unknown format → ``ValueError``.

    CSV: header, inferred schema (unless ``schema`` is given), multi-line records, ``"`` escape.
    ``multi_line=False`` keeps big CSV files splittable. JSON: one record per line.
    ``infer=False`` reads CSV fields and JSON scalars as text (no inference pass over CSV).
    """
    f = fmt.lower()
    reader = spark.read.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    if f == "csv":
        return (reader.option("header", True).option("inferSchema", infer and schema is None)
                      .option("multiLine", multi_line).option("escape", '"').csv(paths))
    if f == "json":
        return (reader.option("multiLine", False)
                      .option("primitivesAsString", not infer and schema is None).json(paths))
    if f == "parquet":
        return reader.parquet(*paths)
    raise ValueError(f"Unsupported format: {fmt}")


def select_files(spark: SparkSession, path: str, fmt: str, pattern: str,
                 **kwargs) -> DataFrame:
    """Read only the files whose name matches ``pattern`` (e.g. ``crm_events_*2024-03-15*``),
    anywhere under ``path``."""
    opts = {"pathGlobFilter": pattern, "recursiveFileLookup": "true"}
    opts.update(kwargs.pop("options", None) or {})
    return read_raw(spark, path, fmt, options=opts, **kwargs)


# ---------------------------------------------------------------------------------------------
# Paths
# ---------------------------------------------------------------------------------------------

def is_missing_path(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def existing_paths(spark: SparkSession, globs: Sequence[str]) -> list[str]:
    """Files and folders that match the globs, from the file system's listing (no job)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for glob in globs:
        path = jvm.org.apache.hadoop.fs.Path(glob)
        for status in path.getFileSystem(conf).globStatus(path) or ():
            found.append(status.getPath().toString())
    return found


# ---------------------------------------------------------------------------------------------
# API pages
# ---------------------------------------------------------------------------------------------

PAGE_NUMBER = r"(?:page=|_page_)0*([0-9]+)"
# A page body is one record, held in memory: JSON has no raw control character but white space, so no
# file is cut by this. (``multiLine`` instead opens the file anew for every number read as text.)
NO_LINES = {"multiLine": "false", "lineSep": "\x00\x1e\x00"}
# Files are packed into tasks as if each had so many bytes more.
_PAGE_OPEN_BYTES = 1 << 16
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# Folder-derived columns of landed page files (not part of the records).
PAGE_PARTITION_COLUMNS = ("landing_date", "page")


def listing_tasks(spark: SparkSession) -> str:
    return str(4 * spark.sparkContext.defaultParallelism)


@contextmanager
def listed_in_bulk(spark: SparkSession):
    """Frames opened here list their folders with a few tasks a core, not with a task for every folder
    (a page has a folder of its own)."""
    before = spark.conf.get(_LISTING_TASKS, None)
    spark.conf.set(_LISTING_TASKS, listing_tasks(spark))
    try:
        yield
    finally:
        spark.conf.unset(_LISTING_TASKS) if before is None else spark.conf.set(_LISTING_TASKS, before)


def page_schema(record: T.StructType) -> T.StructType:
    """Schema of a page body for a record schema: bare-list pages yield records as rows, object
    pages one row with ``items``."""
    if "items" in record.fieldNames():
        return record
    return T.StructType(record.fields + [T.StructField("items", T.ArrayType(record))])


def unwrap_pages(raw: DataFrame, file_column: str = "__file") -> DataFrame:
    """Page bodies → records in one pass, for batch and streaming frames: an object page is one
    row with ``items``, a bare-list page is one row per record. A field that the two shapes type
    differently becomes text."""
    bare = [f for f in raw.schema.fields
            if f.name not in ("items", file_column) and f.name not in PAGE_PARTITION_COLUMNS]
    if "items" not in raw.columns:
        return raw.select(*[f.name for f in bare], file_column)
    kind = raw.schema["items"].dataType.elementType
    inner = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
    outer = {f.name: f.dataType for f in bare}
    types = {c: t if outer.get(c, t) == inner.get(c, t) else T.StringType()
             for c, t in {**outer, **inner}.items()}
    if not types:
        return raw.select(file_column).limit(0)

    def record(known, get) -> Column:
        return F.struct(*[(get(c) if c in known else F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    wrapped = F.transform("items", lambda x: record(inner, lambda c: x[c]))
    single = F.array(record(outer, F.col))
    any_field = F.coalesce(*[F.col(c).cast("string") for c in outer]) if outer else F.lit(None)
    rows = F.when(F.col("items").isNotNull(), wrapped).when(any_field.isNotNull(), single)
    return raw.select(F.explode(rows).alias("__r"), file_column).select("__r.*", file_column)


def read_api_pages(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | None = None, keep_file: bool = False,
                   options: dict[str, str] | None = None) -> DataFrame:
    """Records of landed API pages. A page file holds a whole response body: either an object
    ``{"items": [...]}`` or a bare list ``[...]``; both shapes are unwrapped into records. Without
    a record schema the scalars are read as text, so types do not depend on the pages read.
    ``keep_file`` keeps the page file path as ``_source_file``."""
    reader = spark.read.options(**(options or {})).options(**NO_LINES)
    reader = (reader.schema(page_schema(schema)) if schema is not None
              else reader.option("primitivesAsString", True))
    paths = [path] if isinstance(path, str) else list(path)
    with listed_in_bulk(spark):
        raw = reader.json(paths)
    out = unwrap_pages(raw.withColumn("__file", F.col("_metadata.file_path")))
    return (out.withColumnRenamed("__file", "_source_file") if keep_file
            else out.drop("__file"))


def api_page_counts(spark: SparkSession, path: str) -> DataFrame:
    """Records per landed page file (page number from the file path): both page shapes count, a page
    that holds a single object is one record, a blank or broken one holds none (a file without a byte
    is no page). The files are opened once, here; the counts are staged."""
    from strata.sinks.writers import stage_path
    own = spark.newSession()  # listing and file packing are session settings
    own.conf.set(_LISTING_TASKS, listing_tasks(spark))
    own.conf.set("spark.sql.files.openCostInBytes", str(_PAGE_OPEN_BYTES))
    body = F.col("content").cast("string")
    n = F.coalesce(F.json_array_length(body), F.json_array_length(F.get_json_object(body, "$.items")),
                   F.when(F.get_json_object(body, "$").isNotNull(), 1), F.lit(0))
    pages = (own.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select(F.col("_metadata.file_path").alias("file"), n.cast("long").alias("record_count")))
    counts = pages.select(landing_date_column(F.col("file")).alias("landing_date"),
                          F.regexp_extract("file", PAGE_NUMBER, 1).cast("int").alias("page"), "record_count")
    at = stage_path(spark, "page-files")
    counts.coalesce(4 * spark.sparkContext.defaultParallelism).write.parquet(at)
    return spark.read.schema(counts.schema).parquet(at)


def require_records(page_counts: DataFrame) -> int:
    """Total over pages; zero records for the date is a data error."""
    total = page_counts.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
    if total == 0:
        raise ValueError("Zero records returned from API pages")
    return total


# ---------------------------------------------------------------------------------------------
# Landing zone
# ---------------------------------------------------------------------------------------------

def landing_dir(root: str, execution_date: str, subdir: str, layout: str = "dated") -> str:
    d = parse_date(execution_date).strftime("%Y%m%d")
    if layout == "hive":
        return f"{root.rstrip('/')}/{subdir}/landing_date={d}"
    return f"{root.rstrip('/')}/{d}/{subdir}"


def landing_inventory(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files (path, bytes) under a landing folder, those whose name matches ``pattern`` if one is
    given; file contents are never read. A missing folder is an empty inventory."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        files = reader.load(path).select("path", "length")
        files.schema  # resolve now so a missing path surfaces here
        return files
    except AnalysisException as e:
        if is_missing_path(e):
            return spark.createDataFrame([], "path string, length long")
        raise


def landing_presence(spark: SparkSession, root: str, execution_date: str,
                     registry: Sequence[dict] = SOURCE_REGISTRY,
                     layout: str = "dated") -> DataFrame:
    """Per enabled source: number of landed files and bytes for the date (0 when absent)."""
    frames = []
    for src in registry:
        if not src.get("enabled", True):
            continue
        inv = landing_inventory(spark, landing_dir(root, execution_date, src["landing_subdir"],
                                                   layout), src.get("file_pattern"))
        frames.append(inv.agg(F.count(F.lit(1)).alias("files"),
                              F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
                         .select(F.lit(src["id"]).alias("source_id"), "files", "bytes"))
    if not frames:
        return spark.createDataFrame([], "source_id string, files long, bytes long, "
                                         "present boolean")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("present", F.col("files") > 0)


def as_text(df: DataFrame) -> DataFrame:
    """Scalars as text (binary and nested columns stay): a landed table's types then do not
    change from one delivery to the next, and no value is widened on the way."""
    keep = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    cols = {f.name: col_ref(f.name).cast("string") for f in df.schema.fields if not isinstance(f.dataType, keep)}
    return df.withColumns(cols) if cols else df


def source_options(src: dict) -> dict[str, str]:
    """Which files below a folder belong to a registry source."""
    pattern = {"pathGlobFilter": src["file_pattern"]} if src.get("file_pattern") else {}
    return {"recursiveFileLookup": "true", **pattern}


def read_source(spark: SparkSession, path: str | Sequence[str], src: dict, *,
                schema: T.StructType | None = None, keep_file: bool = False) -> DataFrame:
    """Read one registry source's landed files with the reader its format needs: the files below
    ``path`` whose name matches the entry's ``file_pattern`` (all without one).

    Columns are landed as text unless the entry (or the caller) gives a ``schema`` (DDL string or
    StructType), so Bronze has the same types on every date; Silver casts them. Files whose columns
    differ are read apart and joined by name (:mod:`strata.sources.layouts`). CSV entries may set
    ``multi_line=False`` (splittable). ``keep_file`` adds the landed file path as
    ``_source_file``."""
    fmt = src["format"]
    schema = schema if schema is not None else src.get("schema")
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    options = source_options(src)
    if fmt == "json_pages":
        return read_api_pages(spark, path, schema, keep_file=keep_file, options=options)
    paths = [path] if isinstance(path, str) else list(path)

    def read(at: Sequence[str], own: T.StructType | None, opts: dict[str, str]) -> DataFrame:
        df = read_raw(spark, at, fmt, schema=own, multi_line=src.get("multi_line", True), infer=False, options=opts)
        return df.withColumn("_source_file", F.col("_metadata.file_path")) if keep_file else df

    keep = ["_source_file"] if keep_file else []
    if fmt.lower() == "csv":
        frames = layouts.read_csv_by_header(spark, paths, options, schema, read)
        if schema is not None:
            frames = [layouts.conform(f, schema, keep) for f in frames]
    elif fmt.lower() == "parquet" and schema is None:
        frames = [read(at, own, {} if single else options)
                  for own, at, single in layouts.schema_groups(spark, paths, options)]
    else:
        frames = [read(paths, schema, options)]
    if not frames:  # files without a line
        empty = T.StructType([*(schema.fields if schema is not None else []),
                              *(T.StructField(c, T.StringType()) for c in keep)])
        return spark.createDataFrame([], empty)
    return union_sources([f if schema is not None else as_text(f) for f in frames])


_DATE_FOLDER = re.compile(r"/landing_date=[0-9]{8}/?$")


def range_folders(spark: SparkSession, root: str, src: dict, start: str, end: str) -> list[str]:
    """Date folders of one source for [start, end] that landed. Anything beside the date folders
    would be left out without a trace and is an error."""
    base = f"{root.rstrip('/')}/{src['landing_subdir']}"
    undated = [p for p in existing_paths(spark, [f"{base}/*"])
               if not _DATE_FOLDER.search(p) and not p.rsplit("/", 1)[1].startswith(("_", "."))]
    if undated:
        raise ValueError(f"{len(undated)} landed paths of {src['id']} have no date, such as {min(undated)}")
    days: dict[str, list[str]] = {}
    for d in date_range(start, end):
        days.setdefault(d.strftime("%Y%m"), []).append(d.strftime("%d"))
    return existing_paths(spark, [f"{base}/landing_date={month}{{{','.join(dd)}}}" for month, dd in days.items()])


def read_source_range(spark: SparkSession, root: str, src: dict, start: str, end: str,
                      schema: T.StructType | None = None, paths: Sequence[str] | None = None) -> DataFrame | None:
    """All landed files of one source in a Hive-style landing zone for [start, end], with
    ``landing_date`` (date) taken from the folder; ``None`` if no date of the range landed. Only
    the range's folders are opened (or the ``paths`` given in their stead)."""
    paths = range_folders(spark, root, src, start, end) if paths is None else paths
    if not paths:
        return None
    df = read_source(spark, paths, src, schema=schema, keep_file=True)
    return df.withColumn("landing_date", landing_date_column(F.col("_source_file"))).drop("_source_file")


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")
_FRACTIONAL = ("float", "double")


def _common_type(types: set[str]) -> str:
    if types <= set(_INTEGRAL):
        return "bigint"
    return "double" if types <= set(_FRACTIONAL) else "string"


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name. A column whose type differs between sources is widened within the
    integers (bigint) or the fractions (double) and else kept as text — never an integer as a
    double, which would change large ids; columns missing in a source are NULL."""
    types: dict[str, set] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    target = {c: _common_type(ts) for c, ts in types.items() if len(ts) > 1}
    aligned = [df.withColumns({c: F.col(c).cast(t) for c, t in target.items()
                               if c in df.columns})
               if target else df for df in frames]
    out = aligned[0]
    for df in aligned[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------------------------------------
# Layer tables
# ---------------------------------------------------------------------------------------------

def read_partition(spark: SparkSession, path: str, execution_date: str,
                   schema: T.StructType | None = None) -> DataFrame:
    """One execution-date slice of a (year, month, day)-partitioned table.

    Reads the date's leaf folder with ``basePath`` = the table root, so only that folder is
    listed (a table with years of dates is not listed on every daily run) while the partition
    columns are still recovered from the path. A date without a folder falls back to the
    root read with a partition filter, which yields an empty slice with the table's schema.
    """
    d = parse_date(execution_date)
    root = path.rstrip("/")
    leaf = f"{root}/year={d.year}/month={d.month}/day={d.day}"
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        df = reader.option("basePath", root).parquet(leaf)
        df.schema
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        df = reader.parquet(root)
    return df.where(partition_predicate(execution_date))


def range_globs(root: str, start: str, end: str) -> list[str]:
    """One glob per month of the range: ``…/year=Y/month=M/day={d1,d2,…}``."""
    months: dict[tuple[int, int], list[int]] = {}
    for d in date_range(start, end):
        months.setdefault((d.year, d.month), []).append(d.day)
    return [f"{root}/year={y}/month={m}/day={{{','.join(map(str, days))}}}"
            for (y, m), days in months.items()]


def read_range(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Inclusive date range of a partitioned table, with every column that any of its dates has
    (``mergeSchema``: a column first delivered on a later date is NULL before). Only the range's
    existing folders are opened; a range without any reads the root, for the schema."""
    root = path.rstrip("/")
    folders = existing_paths(spark, range_globs(root, start, end))
    reader = spark.read.option("mergeSchema", True)
    df = reader.option("basePath", root).parquet(*folders) if folders else reader.parquet(root)
    return df.where(partition_range_predicate(start, end))


def read_dimension(spark: SparkSession, dim_root: str, name: str = "dim_source",
                   columns: Sequence[str] = ("source_system", "source_label")) -> DataFrame:
    return spark.read.parquet(f"{dim_root.rstrip('/')}/{name}").select(*columns)


def landing_date_column(path_col: Column | None = None) -> Column:
    """``yyyy-MM-dd`` landing date parsed from a file path of either layout."""
    p = F.col("_metadata.file_path") if path_col is None else path_col
    d = F.regexp_extract(p, r"(?:landing_date=|/)([0-9]{8})(?:/|$)", 1)
    return F.to_date(F.nullif(d, F.lit("")), "yyyyMMdd")
