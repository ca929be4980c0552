"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The matching DuckDB SQL for every query lives in :mod:`strata.oracle`. Computed columns are
aliased identically on both sides; sums of amounts are rounded to cents because floating-point
sums depend on the order rows are added in, means are checked against them (`_round_money`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixtures
from strata.operators import gold, silver

# Fixed run stamps used by the registered queries so results are reproducible.
RUN_ID = "run-0001"
NOW = "2024-02-01T06:00:00Z"
EXECUTION_DATE = "2024-01-15"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def wall_clock(df: DataFrame) -> DataFrame:
    """Present ``timestamp`` columns as wall-clock ``timestamp_ntz`` values, so what a query
    returns does not depend on the session or client time zone (the layer tables keep the
    ``timestamp`` contract type)."""
    from pyspark.sql import types as T
    cols = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(cols) if cols else df


def _round_money(df: DataFrame, sums=(), means=None) -> DataFrame:
    """Presentation for engine-independent comparison: sums of 2-decimal amounts rounded to
    2 dp (float sums differ only far below a cent); a mean as ``rounded sum / count`` (one IEEE
    division of identical operands in every engine — rounding the mean itself would hit
    decimal ties such as x.xxxxxx5 that engines break differently), with ``<mean>_agrees``: the
    operator's own mean is within 1e-6 of it. ``means`` maps a mean column to its (sum column,
    count column); Silver amounts are never NULL, so the row count is the mean's divisor."""
    exact = {m: F.round(sc, 2) / F.col(nc) for m, (sc, nc) in (means or {}).items()}
    cols = {f"{m}_agrees": F.abs(F.col(m) - e) <= 1e-6 for m, e in exact.items()} | exact
    df = df.withColumns(cols) if cols else df
    return df.withColumns({c: F.round(c, 2) for c in sums}) if sums else df


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.cast_types(fixtures.raw_events(spark, sf_dir))


def deduped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.deduplicate(typed_events(spark, sf_dir))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.business_rules(deduped_events(spark, sf_dir))


@query
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01 (flagship): dirty landing → cast → dedup → rules → daily summary per source and date."""
    daily = gold.compute_daily(silver_events(spark, sf_dir), computed_at=NOW)
    return _round_money(daily, sums=["total_amount"], means={"avg_amount": ("total_amount", "total_records")})


# ---------------------------------------------------------------------------------------------
# Helpers shared by the write-type queries
# ---------------------------------------------------------------------------------------------

_SPANS: dict[tuple[str, str], tuple] = {}


def span(spark: SparkSession, sf_dir: str, beyond: int = 0) -> tuple[str, str]:
    """First and last date of the events (read once per session), ``beyond`` days wider: the dates
    outside the data must come out empty, not stale."""
    import datetime as dt
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SPANS:
        d = F.col("ts").cast("date")
        _SPANS[key] = fixtures.table(spark, sf_dir, "events").agg(F.min(d), F.max(d)).first()
    first, last = _SPANS[key]
    return (first - dt.timedelta(beyond)).isoformat(), (last + dt.timedelta(beyond)).isoformat()


ORDERS_DATE = "1995-03-15"
QUALITY_COLUMNS = ["check_name", "passed", "observed", "expected"]
API_PAGE_SIZE = 50


_LANDED: dict[tuple[str, str, int], str] = {}


def landed(spark: SparkSession, sf_dir: str, page_size: int = 500) -> str:
    """Landing zone with every date of the raw events (Hive layout), written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, page_size)
    if key not in _LANDED:
        root = _scratch(spark, "landing")
        fixtures.land_raw_events(fixtures.raw_events(spark, sf_dir), root, layout="hive", page_size=page_size)
        _LANDED[key] = root
    return _LANDED[key]


def _gated(results: DataFrame) -> DataFrame:
    """Evaluate the checks once, gate on the rows (at most one per check) and return them."""
    from strata.operators import quality
    rows = results.collect()
    quality.gate_rows(rows)
    return results.sparkSession.createDataFrame(rows, results.schema)


def _scratch(spark: SparkSession, name: str) -> str:
    from strata.session import scratch_path
    return scratch_path(spark, name)


def _paths(spark: SparkSession, name: str):
    from strata.plans.jobs import Paths
    return Paths.under(_scratch(spark, name))


def _quality_view(results: DataFrame, extra=()) -> DataFrame:
    """Quality rows with the numeric observation (text formatting is engine-specific)."""
    return results.select(*extra, "check_name", "passed",
                          "observed", "expected")


def bronze_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_events(spark, sf_dir, RUN_ID, NOW)


def enriched_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich_with_dimension(silver_events(spark, sf_dir), fixtures.dim_source(spark))


# ---------------------------------------------------------------------------------------------
# Projections, filters, deduplication, joins
# ---------------------------------------------------------------------------------------------

@query
def attach_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-01: run metadata stamped on every landed row (same-named columns replaced)."""
    from strata.operators.bronze import attach_metadata as attach
    return attach(fixtures.raw_events(spark, sf_dir), RUN_ID, "crm", EXECUTION_DATE, NOW)


@query
def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-02/03: contract casts, invalid text → NULL, lenient string → bigint."""
    return wall_clock(typed_events(spark, sf_dir))


@query
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-01: one deterministic survivor per (id, event_date, source_system)."""
    return wall_clock(deduped_events(spark, sf_dir))


@query
def deduplicate_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-01 on a natural key: (l_orderkey, l_linenumber) of lineitem."""
    li = fixtures.table(spark, sf_dir, "lineitem")
    return silver.deduplicate(li, keys=("l_orderkey", "l_linenumber"))


@query
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DED-02: rows before / after / removed from one aggregation."""
    return silver.dedup_report(typed_events(spark, sf_dir))


@query
def business_rules_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02: identifiers must be present."""
    return wall_clock(silver.not_null_rules(deduped_events(spark, sf_dir)))


@query
def business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-02/03: identifiers present and amount >= 0 (NULL amount dropped)."""
    return wall_clock(silver_events(spark, sf_dir))


@query
def enrich_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-01: left join to the source dimension (broadcast after a bounded count)."""
    return wall_clock(enriched_silver(spark, sf_dir))


@query
def enrich_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-01 on TPC-H-style tables: customer ⟕ nation."""
    cust = fixtures.table(spark, sf_dir, "customer")
    nation = fixtures.table(spark, sf_dir, "nation")
    return silver.enrich_with_dimension(cust, nation, key="c_nationkey", dim_key="n_nationkey",
                                        columns=("n_name",))


# ---------------------------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------------------------

@query
def gold_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02/03/04: KPIs per source over the whole Silver table."""
    k = gold.compute_kpis(silver_events(spark, sf_dir), EXECUTION_DATE, NOW)
    return _round_money(k, sums=["total_value"], means={"avg_value": ("total_value", "record_count")})


@query
def active_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04: share of active rows over all rows (NULL counts as inactive)."""
    t = typed_events(spark, sf_dir)
    return (t.groupBy("source_system")
             .agg(F.count(F.lit(1)).alias("rows"), gold.active_rate().alias("active_rate")))


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05/06: NULL count per contract column and the row count, one pass."""
    from strata.contract import CONTRACT_CASTS
    from strata.operators.quality import null_counts as nc
    return nc(typed_events(spark, sf_dir), [*CONTRACT_CASTS, "source_system"])


# ---------------------------------------------------------------------------------------------
# Data-quality operators
# ---------------------------------------------------------------------------------------------

def _expected_silver_schema():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()),
        T.StructField("event_date", T.DateType()), T.StructField("created_at", T.TimestampType()),
        T.StructField("is_active", T.BooleanType()), T.StructField("source_system", T.StringType()),
        T.StructField("source_label", T.StringType()), T.StructField("year", T.LongType()),
    ])


@query
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-01: expected fields present with exact types, and the rows that hold a value."""
    from strata.operators import quality
    s = silver_events(spark, sf_dir)
    res = quality.evaluate(s, quality.schema_checks(s.schema, _expected_silver_schema(), count_values=True))
    return res.select("check_name", "passed", "actual", "expected", "message", "observed")


@query
def dq_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-02: null rate per column against a threshold, one aggregation."""
    from strata.operators import quality
    d = deduped_events(spark, sf_dir)
    cols = ["id", "event_date", "source_system", "amount", "is_active"]
    res = quality.evaluate(d, quality.null_rate(cols, d.columns, 0.05))
    return _quality_view(res)


@query
def dq_null_rate_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-03: a missing column yields a failed `column_missing` row."""
    from strata.operators import quality
    d = deduped_events(spark, sf_dir)
    res = quality.evaluate(d, quality.null_rate(["id", "source_system", "customer_tier"],
                                                d.columns, 0.02))
    return res.select("check_name", "passed", "actual", "expected")


@query
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-04: row count within inclusive bounds (open upper bound allowed)."""
    from strata.operators import quality
    s = silver_events(spark, sf_dir)
    checks = [quality.row_count(1, label="silver"),
              quality.row_count(1, 5000, label="silver_bounded"),
              quality.row_count(0, label="silver_any")]
    return quality.evaluate(s, checks).select("check_name", "passed", "actual", "expected",
                                              "message")


@query
def dq_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-05: First run writes the baseline (from the typed frame); the next run, on the enriched
    silver frame, reports added / removed columns, each beside the frame's row count."""
    from strata.operators import quality
    from strata.sinks import writers
    root = _scratch(spark, "baselines")
    typed = typed_events(spark, sf_dir)
    first = quality.schema_drift(typed.columns, writers.read_schema_baseline(spark, root, "silver"),
                                 "silver")
    writers.write_schema_baseline(spark, root, "silver", typed.columns)
    enriched = enriched_silver(spark, sf_dir).drop("k")
    second = quality.schema_drift(enriched.columns,
                                  writers.read_schema_baseline(spark, root, "silver"), "silver")
    rows = quality.row_count(1, label="silver")
    res = quality.evaluate(typed, [first, rows]).withColumn("run", F.lit(1)).unionByName(
        quality.evaluate(enriched, [second, rows]).withColumn("run", F.lit(2)))
    return res.select("run", "check_name", "passed", "actual", "expected", "message")


def _staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.sinks import writers
    return writers.stage(silver_events(spark, sf_dir), "silver")


def _published_silver(spark: SparkSession, sf_dir: str) -> str:
    from strata.sinks import writers
    root = _scratch(spark, "silver")
    writers.publish_range(silver_events(spark, sf_dir), root, *span(spark, sf_dir))
    return root


@query
def dq_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-06: rows per expected date of a range (0 where a date is missing)."""
    from strata.operators import quality
    root = _published_silver(spark, sf_dir)
    return quality.partition_completeness(spark.read.parquet(root), *span(spark, sf_dir, 2))


@query
def exp_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-07: table row count between expectations."""
    from strata.operators import quality
    s = silver_events(spark, sf_dir)
    checks = [quality.expect_table_row_count_between(1, 50000000),
              quality.expect_table_row_count_between(0, None),
              quality.expect_table_row_count_between(20000, None)]
    return _quality_view(quality.evaluate(s, checks))


@query
def exp_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-09: not-null expectations with `mostly` over all rows."""
    from strata.operators import quality
    d = deduped_events(spark, sf_dir)
    checks = [quality.expect_not_null("id", d.columns, 1.0),
              quality.expect_not_null("event_date", d.columns, 0.98),
              quality.expect_not_null("source_system", d.columns, 0.95),
              quality.expect_not_null("amount", d.columns, 0.9)]
    return _quality_view(quality.evaluate(d, checks))


@query
def exp_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-10: regex expectations with `mostly` over non-NULL rows."""
    from strata.operators import quality
    r = fixtures.raw_events(spark, sf_dir)
    checks = [quality.expect_regex("created_at", r.columns,
                                   r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", 1.0),
              quality.expect_regex("id", r.columns, r"^[0-9]+$", 0.99),
              quality.expect_regex("event_date", r.columns, r"^\d{4}-\d{2}-\d{2}$", 0.95)]
    return _quality_view(quality.evaluate(r, checks))


@query
def exp_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-11: range expectations with `mostly` over non-NULL rows."""
    from strata.operators import quality
    t = typed_events(spark, sf_dir)
    checks = [quality.expect_between("amount", t.columns, 0, None, 0.95),
              quality.expect_between("amount", t.columns, 0, 500, 0.999),
              quality.expect_between("day", t.columns, 1, 31, 1.0)]
    return _quality_view(quality.evaluate(t, checks))


@query
def exp_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-12: compound uniqueness (its own aggregation) on three tables."""
    from strata.operators import quality
    t = typed_events(spark, sf_dir)
    li = fixtures.table(spark, sf_dir, "lineitem")
    orders = fixtures.table(spark, sf_dir, "orders")
    parts = [quality.evaluate(t, [quality.expect_compound_unique(
                 ["id", "event_date", "source_system"], t.columns)]),
             quality.evaluate(li, [quality.expect_compound_unique(
                 ["l_orderkey", "l_linenumber"], li.columns)]),
             quality.evaluate(orders, [quality.expect_compound_unique(
                 ["o_orderkey"], orders.columns)])]
    return _quality_view(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def exp_unique_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-12/DED-01: compound uniqueness of typed events and of deduplicated ones, each in a table
    bucketed by the business key: no shuffle of rows."""
    from strata.contract import BUSINESS_KEY
    from strata.operators import quality
    from strata.sinks import bucketed
    out = None
    for name, df in (("typed", typed_events(spark, sf_dir)), ("deduplicated", deduped_events(spark, sf_dir))):
        t = bucketed.append(df, _scratch(spark, f"bucketed-{name}"))
        checks = [quality.expect_compound_unique(list(BUSINESS_KEY), t.columns), quality.row_count(1, label=name)]
        res = _quality_view(quality.evaluate(t, checks)).withColumn("rows_of", F.lit(name))
        out = res if out is None else out.unionByName(res)
    return out


@query
def exp_suite_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-13: the Bronze expectation suite."""
    from strata.plans.jobs import run_suite
    return _quality_view(run_suite(bronze_frame(spark, sf_dir), "bronze"))


@query
def exp_suite_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-13: the Silver expectation suite, over Silver staged once (uniqueness is a second
    aggregation, which would otherwise repeat the dedup)."""
    from strata.plans.jobs import run_suite
    return _quality_view(run_suite(_staged_silver(spark, sf_dir), "silver"))


@query
def exp_suite_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-13: the Gold expectation suite on the daily summary."""
    from strata.plans.jobs import run_suite
    daily = gold.compute_daily(silver_events(spark, sf_dir), NOW)
    return _quality_view(run_suite(daily, "gold"))


def _profile_by_date(spark: SparkSession, layer: str, df: DataFrame, base_path: str):
    """Layer profile evaluated per date partition in one aggregation over the whole table, against
    a saved schema baseline."""
    from strata.operators import quality
    from strata.plans.jobs import profile_checks
    from strata.sinks import writers
    root = _scratch(spark, "baselines")
    writers.write_schema_baseline(spark, root, layer, df.columns)
    checks = profile_checks(layer, df, writers.read_schema_baseline(spark, root, layer), None, base_path)
    res = quality.evaluate(df, checks, by=["year", "month", "day"])
    return _quality_view(res, extra=("year", "month", "day"))


@query
def profile_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-05/06/15: failed rows of the Silver profile over a range wider than the data, against a
    baseline that knows other columns: drift on every date, missing partitions."""
    from strata.functions.dates import date_range
    from strata.operators import quality
    from strata.plans.jobs import profile_checks
    from strata.sinks import writers
    root, baselines = _published_silver(spark, sf_dir), _scratch(spark, "baselines")
    df = spark.read.parquet(root)
    writers.write_schema_baseline(spark, baselines, "silver", [*(c for c in df.columns if c != "k"), "legacy"])
    checks = profile_checks("silver", df, writers.read_schema_baseline(spark, baselines, "silver"), None, "/silver")
    have = writers.table_dates(spark, root, *span(spark, sf_dir, 2))
    missing = [d for d in date_range(*span(spark, sf_dir, 2)) if (d.year, d.month, d.day) not in have]
    res = quality.evaluate(df, checks, by=["year", "month", "day"]).unionByName(
        quality.empty_date_partitions(spark, missing, "/silver"))
    return _quality_view(quality.failures(res).where("check_name LIKE 'schema%' OR check_name LIKE 'part%'"),
                         extra=("year", "month", "day"))


@query
def gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14: the failures that the gate reports for the deduplicated rows under prod thresholds."""
    from strata.operators import quality
    from strata.plans.jobs import silver_checks
    d = deduped_events(spark, sf_dir)
    res = quality.evaluate(d, silver_checks(d.columns, "prod"))
    rows = res.collect()
    try:
        quality.gate_rows(rows)
        named = set()
    except quality.DataQualityError as e:
        named = {line.split("]")[0].strip(" [") for line in str(e).splitlines()[1:]}
    return spark.createDataFrame([r for r in rows if r["check_name"] in named], res.schema).select(
        *QUALITY_COLUMNS)


@query
def dq_profile_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-15: Bronze check profile, evaluated per date in one pass."""
    return _profile_by_date(spark, "bronze", bronze_frame(spark, sf_dir), "/bronze")


@query
def dq_profile_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-15: Silver check profile over the published table, per date."""
    root = _published_silver(spark, sf_dir)
    return _profile_by_date(spark, "silver", spark.read.parquet(root), "/silver")


@query
def dq_profile_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-15: Gold check profile on KPI rows, per date."""
    kpis = gold.compute_kpis(silver_events(spark, sf_dir), None, NOW,
                             keys=("source_system", "year", "month", "day"))
    return _profile_by_date(spark, "gold", kpis, "/gold/kpi_summary")


@query
def dq_env_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-16: One silver slice against the dev / staging / prod thresholds, in one pass."""
    from dataclasses import replace

    from strata.operators import quality
    from strata.plans.jobs import silver_checks
    s = silver_events(spark, sf_dir)
    checks = [replace(c, row=c.row.withField("check_name", F.concat(F.lit(f"{env}|"), c.row["check_name"])))
              for env in ("dev", "staging", "prod") for c in silver_checks(s.columns, env)]
    res = quality.evaluate(s, checks)
    parts = F.split("check_name", r"\|", 2)
    return _quality_view(res.withColumns({"env": parts[0], "check_name": parts[1]}), extra=("env",))


@query
def gate_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14/17: Bronze in-job gate (run-stamp null rates)."""
    from strata.contract import GATE_COLUMNS, THRESHOLDS
    from strata.operators import quality
    b = bronze_frame(spark, sf_dir)
    res = quality.evaluate(b, quality.null_rate(GATE_COLUMNS["bronze"], b.columns,
                                                THRESHOLDS["dev"]["bronze"]["max_null_rate"]))
    return _quality_view(_gated(res))


@query
def gate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14/17: Silver in-job gate (key null rates + row count)."""
    from strata.operators import quality
    from strata.plans.jobs import silver_checks
    s = enriched_silver(spark, sf_dir)
    res = quality.evaluate(s, silver_checks(s.columns, "dev"))
    return _quality_view(_gated(res))


@query
def gate_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14/17: Gold in-job gate (row counts of daily and KPI tables)."""
    from strata.operators import quality
    from strata.plans.jobs import gold_checks
    s = silver_events(spark, sf_dir)
    daily = gold.compute_daily(s, NOW)
    kpis = gold.compute_kpis(s, EXECUTION_DATE, NOW)
    res = quality.evaluate(daily, gold_checks("dev", "gold_daily")).unionByName(
        quality.evaluate(kpis, gold_checks("dev", "gold_kpis")))
    return _quality_view(_gated(res))


# ---------------------------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------------------------

def _landed_text_summary(df: DataFrame) -> DataFrame:
    """Per source: rows, non-NULL ids / amounts, amount total (amount re-typed leniently)."""
    amount = F.col("amount").cast("string").try_cast("double")
    return (df.groupBy("source_system")
              .agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"),
                   F.count(amount).alias("amounts"),
                   F.round(F.sum(amount), 2).alias("total_amount"),
                   F.count("created_at").alias("created")))


@query
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01: CSV landed with a header, read back with inferred schema."""
    from strata.sources.readers import read_raw
    path = _scratch(spark, "csv")
    fixtures.raw_events(spark, sf_dir).write.option("header", True).csv(path)
    return _landed_text_summary(read_raw(spark, path, "csv"))


@query
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-02: JSON lines landed and read back."""
    from strata.sources.readers import read_raw
    path = _scratch(spark, "json")
    fixtures.raw_events(spark, sf_dir).write.json(path)
    return _landed_text_summary(read_raw(spark, path, "json"))


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03/04: Parquet scan through the format dispatch (column-pruned)."""
    from strata.sources.readers import read_raw
    ev = read_raw(spark, f"{sf_dir.rstrip('/')}/events.parquet", "PARQUET")
    return (ev.groupBy("event_type")
              .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users"),
                   F.round(F.sum("value"), 2).alias("total_value")))


@query
def jdbc_date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05/FLT-05: half-open date slice (the JDBC extract's predicate)."""
    from strata.sources.jdbc import date_slice
    return date_slice(fixtures.table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_DATE)


@query
def jdbc_day_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-05: a day's slice of the events by the time ranges that split its extract, a row per range."""
    from strata.sources.jdbc import day_ranges
    events = fixtures.table(spark, sf_dir, "events")
    parts = [events.where(p).select(F.lit(i).alias("part"), "event_id", "ts")
             for i, p in enumerate(day_ranges("ts", EXECUTION_DATE, 5))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"),
                                   F.min("ts").cast("timestamp_ntz").alias("first"))


@query
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-06/FLT-01: one execution date of a partitioned table."""
    from strata.sinks import writers
    from strata.sources.readers import read_partition
    root = _scratch(spark, "bronze")
    writers.publish_range(bronze_frame(spark, sf_dir), root, *span(spark, sf_dir))
    return read_partition(spark, root, EXECUTION_DATE)


@query
def api_page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08: landed API pages (both body shapes) counted per page file."""
    from strata.sinks import writers
    from strata.sources.readers import api_page_counts as counts
    from strata.sources.readers import require_records
    pages = writers.stage(counts(spark, f"{landed(spark, sf_dir, API_PAGE_SIZE)}/api/events"), "page-counts")
    require_records(pages)
    return pages


@query
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08: per date, the checks of the landed API pages, from which the delivery lost pages 2 and 3
    of every date after the 10th and, after the 20th, delivered page 1 twice."""
    from strata.operators.pages import page_checks
    from strata.sources.readers import api_page_counts as counts
    pages = counts(spark, f"{landed(spark, sf_dir, API_PAGE_SIZE)}/api/events")
    day = F.dayofmonth("landing_date")
    kept = pages.where((day <= 10) | ~F.col("page").isin(2, 3))
    return page_checks(kept.unionByName(pages.where((day > 20) & (F.col("page") == 1))), API_PAGE_SIZE).select(
        "landing_date", "check_name", "passed", "message", "observed")


@query
def multi_source_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11: registry-driven read of three formats into one Bronze frame."""
    from strata.plans.jobs import land_range_to_bronze_frame
    b = land_range_to_bronze_frame(spark, landed(spark, sf_dir), *span(spark, sf_dir), RUN_ID, NOW)
    return (b.groupBy("source_system", "year", "month", "day")
             .agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"),
                  F.count_distinct("k").alias("keys")))


# ---------------------------------------------------------------------------------------------
# Sinks (write, then read back what was written)
# ---------------------------------------------------------------------------------------------

@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-01: Bronze published per date, read back."""
    from strata.sinks import writers
    root = _scratch(spark, "bronze")
    writers.publish_range(bronze_frame(spark, sf_dir), root, *span(spark, sf_dir, 2))
    return spark.read.parquet(root)


@query
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-02: Silver published per date, read back."""
    return wall_clock(spark.read.parquet(_published_silver(spark, sf_dir)))


@query
def gold_daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-03: daily summary published per date, read back."""
    from strata.sinks import writers
    root = _scratch(spark, "daily")
    daily = gold.compute_daily(silver_events(spark, sf_dir), NOW)
    writers.publish_range(daily, root, *span(spark, sf_dir))
    return _round_money(spark.read.parquet(root), sums=["total_amount"],
                        means={"avg_amount": ("total_amount", "total_records")})


@query
def gold_kpi_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-04: KPI rows partitioned by their execution date, read back."""
    from strata.sinks import writers
    root = _scratch(spark, "kpi")
    kpis = gold.compute_kpis(silver_events(spark, sf_dir), None, NOW,
                             keys=("source_system", "year", "month", "day"))
    writers.publish_range(kpis, root, *span(spark, sf_dir))
    return _round_money(spark.read.parquet(root), sums=["total_value"],
                        means={"avg_value": ("total_value", "record_count")})


@query
def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-05: KPI rows + run id appended as JSON lines, read back."""
    from strata.sinks import writers
    path = _scratch(spark, "metrics")
    kpis = gold.compute_kpis(silver_events(spark, sf_dir), EXECUTION_DATE, NOW)
    writers.write_metrics_log(kpis, path, RUN_ID)
    back = spark.read.json(path)
    return back.select("source_system", "record_count", "unique_entities",
                       F.round("total_value", 2).alias("total_value"),
                       "active_rate",
                       "execution_date", "pipeline_run_id")


def _audited(spark: SparkSession, sf_dir: str, env: str) -> str:
    """Bronze, silver and gold gate results of one run appended to a fresh audit table."""
    from strata.contract import GATE_COLUMNS, THRESHOLDS
    from strata.operators import quality
    from strata.plans.jobs import gold_checks, silver_checks
    from strata.sinks import writers
    path = _scratch(spark, "audit")
    b = bronze_frame(spark, sf_dir)
    s = silver_events(spark, sf_dir)
    daily = gold.compute_daily(s, NOW)
    writers.write_audit(quality.evaluate(b, quality.null_rate(
        GATE_COLUMNS["bronze"], b.columns, THRESHOLDS[env]["bronze"]["max_null_rate"])),
        path, RUN_ID, "bronze", EXECUTION_DATE, NOW)
    writers.write_audit(quality.evaluate(s, silver_checks(s.columns, env)), path, RUN_ID,
                        "silver", EXECUTION_DATE, NOW)
    writers.write_audit(quality.evaluate(daily, gold_checks(env, "gold_daily")), path, RUN_ID,
                        "gold", EXECUTION_DATE, NOW)
    return path


@query
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-06: stamped gate results appended to the audit table, read back."""
    from strata.sinks import writers
    a = writers.read_audit(spark, _audited(spark, sf_dir, "dev"))
    return _quality_view(a, extra=("layer", "pipeline_run_id", "execution_date"))


@query
def audit_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-04: failed checks of a run (prod thresholds)."""
    from strata.operators import quality
    from strata.sinks import writers
    a = writers.read_audit(spark, _audited(spark, sf_dir, "prod"))
    return _quality_view(quality.failures(a), extra=("layer",))


@query
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-07: checks and passed checks per layer and date."""
    from strata.sinks import writers
    a = writers.read_audit(spark, _audited(spark, sf_dir, "prod"))
    return (a.groupBy("layer", "execution_date")
             .agg(F.count(F.lit(1)).alias("checks"),
                  F.count(F.when(F.col("passed"), 1)).alias("passed_checks")))


# ---------------------------------------------------------------------------------------------
# Pipelines
# ---------------------------------------------------------------------------------------------

@query
def bronze_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-01: Land one execution date (documented daily layout) → Bronze job → read the partition."""
    from strata.plans.jobs import bronze_job
    paths = _paths(spark, "bronze-job")
    fixtures.land_raw_events(fixtures.raw_events(spark, sf_dir), paths.landing, layout="dated",
                             execution_date=EXECUTION_DATE)
    b = bronze_job(spark, paths, EXECUTION_DATE, RUN_ID, NOW)
    return (b.groupBy("source_system", "pipeline_run_id", "year", "month", "day")
             .agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"),
                  F.count_distinct("k").alias("keys")))


@query
def silver_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-02: Silver job for one date (cast, dedup, rules, dimension, gate)."""
    from strata.plans.jobs import silver_job
    from strata.sinks import writers
    from strata.sources.readers import read_dimension
    paths = _paths(spark, "silver-job")
    writers.publish_range(bronze_frame(spark, sf_dir), paths.bronze, *span(spark, sf_dir))
    dim_root = f"{paths.gold}_dims"
    fixtures.dim_source(spark).write.mode("overwrite").parquet(f"{dim_root}/dim_source")
    s = silver_job(spark, paths, EXECUTION_DATE, RUN_ID, NOW, dim=read_dimension(spark, dim_root))
    return wall_clock(s.drop("pipeline_run_id", "ingested_at"))


@query
def gold_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-03: Gold job for one date (fused daily + KPI aggregation, gate)."""
    from strata.plans.jobs import gold_job
    paths = _paths(spark, "gold-job")
    from strata.sinks import writers
    writers.publish_range(silver_events(spark, sf_dir), paths.silver, *span(spark, sf_dir))
    daily, _ = gold_job(spark, paths, EXECUTION_DATE, RUN_ID, NOW)
    return _round_money(daily, sums=["total_amount"], means={"avg_amount": ("total_amount", "total_records")})


@query
def medallion_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-04: Whole range: three landed sources → Bronze (one pass) → Silver + Gold backfill."""
    from dataclasses import replace

    from strata.plans.jobs import backfill, bronze_range_job
    paths = replace(_paths(spark, "e2e"), landing=landed(spark, sf_dir))
    bronze_range_job(spark, paths, *span(spark, sf_dir), RUN_ID, NOW)
    _, daily, _ = backfill(spark, paths, *span(spark, sf_dir), RUN_ID, NOW)
    return _round_money(daily, sums=["total_amount"], means={"avg_amount": ("total_amount", "total_records")})


@query
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-05: Silver + Gold for every date in one job per layer; dates without data come out empty."""
    from strata.plans.jobs import backfill
    from strata.sinks import writers
    paths = _paths(spark, "backfill")
    writers.publish_range(bronze_frame(spark, sf_dir), paths.bronze, *span(spark, sf_dir))
    _, _, kpis = backfill(spark, paths, *span(spark, sf_dir, 2), RUN_ID, NOW, enforce=False)
    return _round_money(kpis, sums=["total_value"], means={"avg_value": ("total_value", "record_count")})


@query
def idempotent_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-06: Publish all dates, rerun one date with the same rows, rerun another date empty."""
    from strata.functions.dates import partition_predicate
    from strata.sinks import writers
    root = _scratch(spark, "silver")
    s = silver_events(spark, sf_dir)
    writers.publish_range(s, root, *span(spark, sf_dir))
    writers.publish_partition(s.where(partition_predicate(EXECUTION_DATE)), root, EXECUTION_DATE)
    writers.publish_range(s.where(partition_predicate("2024-01-16")), root, "2024-01-20",
                          "2024-01-20")
    return (spark.read.parquet(root).groupBy("year", "month", "day")
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")))


@query
def quality_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-07: Silver and Gold published for every date, then the quality stage for one date."""
    from strata.plans.jobs import gold_backfill
    from strata.plans.jobs import quality_stage as stage_run
    from strata.sinks import writers
    paths = _paths(spark, "quality")
    writers.publish_range(silver_events(spark, sf_dir), paths.silver, *span(spark, sf_dir))
    gold_backfill(spark, paths, *span(spark, sf_dir), RUN_ID, NOW)
    res = stage_run(spark, paths, EXECUTION_DATE, RUN_ID, NOW)
    return _quality_view(res, extra=("layer", "execution_date"))


# ---------------------------------------------------------------------------------------------
# Streaming form of the landing → Bronze ingest
# ---------------------------------------------------------------------------------------------

LANDED_SCHEMA = ("k bigint, id string, amount string, event_date string, created_at string, "
                 "is_active string, source_system string")


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11 (streaming): All three sources landed (Hive layout) → one availableNow stream → Bronze (append)."""
    from pyspark.sql import types as T

    from strata.contract import SOURCE_REGISTRY
    from strata.streaming import run_bronze_stream
    root = _scratch(spark, "stream")
    schema = T._parse_datatype_string(LANDED_SCHEMA)
    run_bronze_stream(spark, landed(spark, sf_dir), f"{root}/bronze", f"{root}/checkpoint",
                      SOURCE_REGISTRY, schema, RUN_ID, NOW)
    b = spark.read.parquet(f"{root}/bronze")
    return (b.groupBy("source_system", "year", "month", "day")
             .agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"),
                  F.count_distinct("k").alias("keys")))


# ---------------------------------------------------------------------------------------------
# Suite summary, NDJSON audit, landing presence, extract to landing
# ---------------------------------------------------------------------------------------------

@query
def exp_suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-13: Checkpoint outcome per layer: success flag, evaluated and failed expectation counts."""
    from strata.operators import quality
    from strata.plans.jobs import run_suite
    s = _staged_silver(spark, sf_dir)
    frames = {"bronze": bronze_frame(spark, sf_dir), "silver": s,
              "gold": gold.compute_daily(s, NOW)}
    out = None
    for layer, df in frames.items():
        summ = quality.summarize(run_suite(df, layer)).select(F.lit(layer).alias("layer"), "*")
        out = summ if out is None else out.unionByName(summ)
    return out


@query
def audit_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-07: Gate results appended as JSON lines under layer=/execution_date= folders, read back."""
    from strata.contract import GATE_COLUMNS, THRESHOLDS
    from strata.operators import quality
    from strata.plans.jobs import silver_checks
    from strata.sinks import writers
    path = _scratch(spark, "audit-ndjson")
    b = bronze_frame(spark, sf_dir)
    s = silver_events(spark, sf_dir)
    writers.write_audit_ndjson(quality.evaluate(b, quality.null_rate(
        GATE_COLUMNS["bronze"], b.columns, THRESHOLDS["dev"]["bronze"]["max_null_rate"])),
        path, RUN_ID, "bronze", EXECUTION_DATE, NOW)
    writers.write_audit_ndjson(quality.evaluate(s, silver_checks(s.columns, "dev")), path, RUN_ID,
                               "silver", EXECUTION_DATE, NOW)
    a = writers.read_audit_ndjson(spark, path)
    return _quality_view(a, extra=("layer", "pipeline_run_id", "execution_date"))


@query
def landing_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10: Per registry source: files and bytes landed for the date (contents never read); a
    file that does not match a source's pattern is not one of its files."""
    from strata.sources.readers import landing_presence as presence
    root = _dated_landing(spark, sf_dir)
    return presence(spark, root, EXECUTION_DATE).select("source_id", "present", "files",
                                                        (F.col("bytes") > 0).alias("has_bytes"))


def _dated_landing(spark: SparkSession, sf_dir: str) -> str:
    """One date's landing, one file per CSV and Parquet delivery, and a stray CSV with other
    headers beside the CSV delivery."""
    from strata.sources.readers import landing_dir
    root = _scratch(spark, "landing")
    raw = fixtures.raw_events(spark, sf_dir)
    fixtures.land_raw_events(raw, root, layout="dated", execution_date=EXECUTION_DATE, page_size=API_PAGE_SIZE, files=1)
    stray = raw.select(F.col("k").alias("other_header"), F.lit("note").alias("id"))
    (stray.coalesce(1).write.mode("append").option("header", True)
     .option("mapreduce.output.basename", "README_other").csv(landing_dir(root, EXECUTION_DATE, "sftp/crm")))
    return root


@query
def landing_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09: rows per source of the files that match the registry's pattern; a stray file next
    to them is left out, with its columns."""
    from strata.contract import SOURCE_REGISTRY
    from strata.sources.readers import landing_dir, read_source
    root, out = _dated_landing(spark, sf_dir), None
    for src in SOURCE_REGISTRY:
        df = read_source(spark, landing_dir(root, EXECUTION_DATE, src["landing_subdir"]), src)
        row = df.agg(F.count(F.lit(1)).alias("rows"), F.count("id").alias("ids"),
                     F.count_distinct("k").alias("keys")).select(
            F.lit(src["id"]).alias("source_id"), "*", F.lit(len(df.columns)).alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def backfill_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-11/SNK-01/PIPE-05: the database extract delivers numbers until the 15th, then text and a
    further column; landed, backfilled and aggregated in one range it equals a run per date."""
    from strata.contract import SOURCE_REGISTRY
    from strata.plans.jobs import backfill, bronze_range_job
    paths = _paths(spark, "uneven")
    raw = fixtures.raw_events(spark, sf_dir)
    other = raw.where("source_system IS NULL OR source_system NOT IN ('crm', 'events_api')").withColumn(
        "landing_date", F.date_format(F.make_date("year", "month", "day"), "yyyyMMdd"))
    cols = [*fixtures.LANDED_COLUMNS, "landing_date"]
    early = other.where("day <= 15").select(*cols).withColumns(
        {"id": F.col("id").try_cast("int"), "amount": F.col("amount").try_cast("double")})
    late = other.where("day > 15").select(*cols, F.concat(F.lit("n"), "k").alias("note"))
    for part in (early, late):
        part.write.mode("append").partitionBy("landing_date").parquet(f"{paths.landing}/db/transactions")
    registry = [s for s in SOURCE_REGISTRY if s["format"] == "parquet"]
    bronze_range_job(spark, paths, *span(spark, sf_dir), RUN_ID, NOW, registry=registry)
    # One source has too few rows a date for thresholds meant for a whole date.
    s, _, _ = backfill(spark, paths, *span(spark, sf_dir), RUN_ID, NOW, enforce=False)
    return s.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count("note").alias("notes"),
        F.round(F.sum("amount"), 2).alias("total_amount"))


def _dated_rows(spark: SparkSession, sf_dir: str, where: str) -> DataFrame:
    return fixtures.raw_events(spark, sf_dir).where(where).withColumn(
        "landing_date", F.date_format(F.make_date("year", "month", "day"), "yyyyMMdd"))


def _range_of(spark: SparkSession, sf_dir: str, paths, fmt: str) -> DataFrame:
    """The Bronze table of one registry source after the range job."""
    from strata.contract import SOURCE_REGISTRY
    from strata.plans.jobs import bronze_range_job
    return bronze_range_job(spark, paths, *span(spark, sf_dir), RUN_ID, NOW,
                            registry=[s for s in SOURCE_REGISTRY if s["format"] == fmt])


def _land_uneven_csv(spark: SparkSession, sf_dir: str, landing_root: str, where: str = "true") -> None:
    """CSV deliveries whose headers change: from the 11th on the columns come in reverse with a further
    one, from the 21st on one is missing and every date holds files of two orders."""
    rows = _dated_rows(spark, sf_dir, "source_system = 'crm'").where(where).withColumn(
        "tier", F.concat(F.lit("t, "), "k"))
    cols = list(fixtures.LANDED_COLUMNS)
    short = [c for c in cols if c != "is_active"]
    for part, names in ((rows.where("day <= 10"), cols),
                        (rows.where("day BETWEEN 11 AND 20"), [*reversed(cols), "tier"]),
                        (rows.where("day > 20 AND k % 2 = 0"), short),
                        (rows.where("day > 20 AND k % 2 = 1"), [*reversed(short)])):
        (part.select(*names, "landing_date").write.mode("append").partitionBy("landing_date")
         .option("header", True).option("mapreduce.output.basename", "crm_events_export")
         .csv(f"{landing_root}/sftp/crm"))


def _uneven_csv_summary(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("k").cast("bigint")).alias("keys"), F.count("id").alias("ids"),
        F.count(F.col("id").try_cast("bigint")).alias("numbers"), F.count("is_active").alias("active_known"),
        F.count(F.when(F.col("tier") == F.concat(F.lit("t, "), "k"), 1)).alias("tiers"),
        F.round(F.sum(F.col("amount").try_cast("double")), 2).alias("total_amount"))


@query
def csv_header_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01/SRC-11: CSV deliveries of a range whose headers change: from the 11th on the columns come
    in reverse with a further one, from the 21st on one is missing and every date holds files of
    two orders; every value lands under its own name."""
    paths = _paths(spark, "csv-headers")
    _land_uneven_csv(spark, sf_dir, paths.landing)
    return _uneven_csv_summary(_range_of(spark, sf_dir, paths, "csv"))


@query
def stream_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-01/SRC-11 (streaming): the same deliveries as a stream of files, landed and drained in two
    steps."""
    from strata.contract import SOURCE_REGISTRY
    from strata.sources.readers import read_range
    from strata.streaming.by_header import run_stream
    root = _scratch(spark, "stream-headers")
    src = next(s for s in SOURCE_REGISTRY if s["format"] == "csv")
    for where in ("day < 15", "day >= 15"):
        _land_uneven_csv(spark, sf_dir, f"{root}/landing", where)
        run_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", src, RUN_ID, NOW)
    return _uneven_csv_summary(read_range(spark, f"{root}/bronze", *span(spark, sf_dir)))


@query
def parquet_schema_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-03/SRC-11: every date of a range holds Parquet files of two schemas: numbers, and text with a
    further column."""
    paths = _paths(spark, "parquet-schemas")
    rows = _dated_rows(spark, sf_dir, "source_system IS NULL OR source_system NOT IN ('crm', 'events_api')")
    cols = [*fixtures.LANDED_COLUMNS, "landing_date"]
    numbers = rows.where("k % 2 = 0").select(*cols).withColumns({"id": F.col("id").try_cast("int")})
    text = rows.where("k % 2 = 1").select(*cols, F.concat(F.lit("n"), "k").alias("note"))
    for part in (numbers, text):
        part.write.mode("append").partitionBy("landing_date").parquet(f"{paths.landing}/db/transactions")
    return _range_of(spark, sf_dir, paths, "parquet").groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("k").cast("bigint")).alias("keys"), F.count("id").alias("ids"),
        F.count("note").alias("notes"), F.round(F.sum(F.col("amount").try_cast("double")), 2).alias("total_amount"))


@query
def redelivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10/PIPE-06: the CSV files of one date are delivered again under other names, once on the
    same date and once on the next one, which a later run ingests; the ledger leaves both out."""
    from strata.contract import SOURCE_REGISTRY
    from strata.plans.jobs import bronze_range_job
    from strata.sinks.writers import _Files
    paths = _paths(spark, "redelivered")
    rows = _dated_rows(spark, sf_dir, "source_system = 'crm'")
    (rows.select(*fixtures.LANDED_COLUMNS, "landing_date").write.partitionBy("landing_date").option("header", True)
     .option("mapreduce.output.basename", "crm_events_export").csv(f"{paths.landing}/sftp/crm"))
    first, last = span(spark, sf_dir)
    files, base = _Files(spark, paths.landing), f"{paths.landing}/sftp/crm/landing_date="
    for name in files.names(base + "20240115"):
        for date in ("20240115", "20240116"):
            files.copy(f"{base}20240115/{name}", f"{base}{date}/crm_events_again_{name}")
    registry = [s for s in SOURCE_REGISTRY if s["format"] == "csv"]
    for start, end in ((first, EXECUTION_DATE), ("2024-01-16", last)):
        bronze_range_job(spark, paths, start, end, RUN_ID, NOW, registry=registry,
                         ledger_path=f"{paths.audit}_ledger")
    return spark.read.parquet(paths.bronze).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("k").alias("keys"))


@query
def range_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02/AGG-03/PIPE-05: KPIs of a range of dates from the states kept beside Gold: exact distinct
    ids over all its dates without reading Silver."""
    from strata.plans import jobs
    from strata.sinks import writers
    paths = _paths(spark, "states")
    writers.publish_range(silver_events(spark, sf_dir), paths.silver, *span(spark, sf_dir))
    jobs.state_backfill(spark, paths, *span(spark, sf_dir))
    k = jobs.range_kpis(spark, paths, "2024-01-05", "2024-01-25", NOW)
    return _round_money(k, sums=["total_value"], means={"avg_value": ("total_value", "record_count")})


@query
def backfill_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIPE-05/PIPE-06: three backfills over all dates: the first does every date, the second finds
    nothing changed, the third redoes the one date that lost half its Bronze rows."""
    from strata.functions.dates import date_range, partition_predicate
    from strata.plans.changes import backfill_changed as run
    from strata.sinks import writers
    paths, bronze = _paths(spark, "changed"), bronze_frame(spark, sf_dir)
    writers.publish_range(bronze, paths.bronze, *span(spark, sf_dir))
    done = [run(spark, paths, *span(spark, sf_dir), RUN_ID, NOW, enforce=False)]
    done.append(run(spark, paths, *span(spark, sf_dir), "run-0002", NOW, enforce=False))
    writers.publish_partition(bronze.where(partition_predicate(EXECUTION_DATE)).where("k % 2 = 1"), paths.bronze,
                              EXECUTION_DATE)
    done.append(run(spark, paths, *span(spark, sf_dir), "run-0003", NOW, enforce=False))
    times = spark.createDataFrame([(d, sum(d.isoformat() in x for x in done)) for d in date_range(*span(spark, sf_dir))],
                                  "date date, times int")
    daily = spark.read.parquet(paths.daily).withColumn("date", F.make_date("year", "month", "day"))
    return _round_money(daily.join(times, "date").select("date", "source_system", "total_records", "distinct_ids",
                                                         "total_amount", "times"), sums=["total_amount"])


@query
def db_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-08: Database date slice written to the landing zone as Parquet, read back."""
    from strata.sinks.writers import land_extract
    from strata.sources.jdbc import date_slice
    from strata.sources.readers import landing_dir
    path = landing_dir(_scratch(spark, "landing"), ORDERS_DATE, "db/transactions") \
        + "/db_export.parquet"
    land_extract(date_slice(fixtures.table(spark, sf_dir, "orders"), "o_orderdate",
                            ORDERS_DATE), path)
    return spark.read.parquet(path)


@query
def orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01 over ``orders`` mapped to the contract: ~2,400 dates × 3 statuses through the same
    cast → dedup → rules → fused daily aggregation."""
    s = silver.business_rules(silver.deduplicate(silver.cast_types(
        fixtures.orders_contract(spark, sf_dir))))
    daily = gold.daily_from_summaries(gold.compute_summaries(s), NOW)
    return _round_money(daily, sums=["total_amount"], means={"avg_amount": ("total_amount", "total_records")})
