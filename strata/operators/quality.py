"""Data-quality checks compiled to one Spark aggregation.

Every check of a layer contributes named aggregate expressions; all of them are evaluated by a
single ``df.agg(...)`` (one scan, partial aggregation on every executor, a one-row result). The
row is then turned into one quality row per check by ``explode`` over an array of result
structs — no driver round trip. Only compound uniqueness needs its own grouped aggregation (one
extra shuffle on the key columns); its result rows are unioned in. Schema-level checks (column
presence, types, drift) are metadata-only and become literal rows.

Result columns: ``check_name, passed, actual, expected, message, observed`` (``observed`` is the
numeric value behind the ``actual`` text). Expectation semantics (our reading of the public
contract of the expectation types used by the suites):

* not-null: non-NULL rows / *all* rows >= mostly;
* regex / between: matching rows / non-NULL rows >= mostly (NULLs are not evaluated);
* an empty denominator passes; compound uniqueness ignores rows whose keys are all NULL and
  counts every member of a duplicated key as unexpected.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contract import CHECK_NAMES, MESSAGES, QUALITY_SCHEMA, TEXTS
from strata.functions.columns import col_ref as _col


class DataQualityError(RuntimeError):
    """Raised by :func:`gate` when at least one check failed."""


ROWS = "__rows"


@dataclass
class Check:
    """One quality check: aggregates it needs and the result struct built from them."""

    name: str
    aggs: dict[str, Column] = field(default_factory=dict)
    row: Column | None = None
    separate: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None


def _text(template: str, **fields) -> Column | str:
    """Fill a fixed template. Literal fields are substituted now (a plain string comes back);
    Column fields are substituted in Spark through ``format_string``."""
    fmt, args = [], []
    for text, field, _, _ in string.Formatter().parse(template):
        fmt.append(text.replace("%", "%%"))
        if field is None:
            continue
        v = fields[field]
        if isinstance(v, Column):
            fmt.append("%s")
            args.append(v.cast("string"))
        else:
            fmt.append(str(v).replace("%", "%%"))
    if not args:
        return template.format(**fields)
    return F.format_string("".join(fmt), *args)


def _name(kind: str, **fields) -> Column | str:
    return _text(CHECK_NAMES[kind], **fields)


def _result(name, passed, actual, expected, message, observed=None, emit=True) -> Column:
    def as_col(v, cast):
        return v.cast(cast) if isinstance(v, Column) else F.lit(v).cast(cast)
    return F.struct(
        as_col(name, "string").alias("check_name"),
        as_col(passed, "boolean").alias("passed"),
        as_col(actual, "string").alias("actual"),
        as_col(expected, "string").alias("expected"),
        as_col(message, "string").alias("message"),
        as_col(observed, "double").alias("observed"),
        as_col(emit, "boolean").alias("emit"),
    )


def _rows_agg() -> dict[str, Column]:
    return {ROWS: F.count(F.lit(1))}


def _safe(name: str) -> str:
    """Alias-safe, collision-free token for a column name."""
    return "".join(ch if ch.isalnum() else "_" for ch in name) + f"_{zlib.crc32(name.encode())}"


def _pct(rate: Column) -> Column:
    return F.format_string("%.2f", rate * 100)


def _fmt_bound(v, default: str) -> str:
    return default if v is None else str(v)


# ---------------------------------------------------------------------------------------------
# Schema validation (metadata only)
# ---------------------------------------------------------------------------------------------

def schema_checks(schema: T.StructType, expected: T.StructType,
                  count_values: bool = False) -> list[Check]:
    """Per expected field: present? exact type? Names compare case-insensitively, nullability
    is ignored. ``count_values`` observes how many rows hold a value of a present field, in the
    same aggregation as the other checks of the frame."""
    actual = {f.name.lower(): f.dataType for f in schema.fields}
    spelled = {f.name.lower(): f.name for f in schema.fields}
    out = []
    for f in expected.fields:
        n, want = f.name.lower(), f.dataType.typeName()
        got = actual.get(n)
        if got is None:
            kind, ok, actual_text = "schema_present", False, TEXTS["missing"]
        elif got != f.dataType:
            kind, ok, actual_text = "schema_type", False, got.typeName()
        else:
            kind, ok, actual_text = "schema_ok", True, want
        name = _name(kind, column=n)
        msg = _text(MESSAGES[kind], column=n, actual=actual_text, expected=want)
        if count_values and got is not None:
            alias = f"__nn_{_safe(spelled[n])}"
            out.append(Check(name, aggs={alias: F.count(_col(spelled[n]))},
                             row=_result(name, ok, actual_text, want, msg, F.col(alias))))
        else:
            out.append(Check(name, row=_result(name, ok, actual_text, want, msg)))
    return out


def column_exists(columns: Sequence[str], column: str,
                  name: str | None = None) -> Check:
    ok = column in columns
    n = name or f"expect_column_to_exist.{column}"
    return Check(n, row=_result(n, ok, "present" if ok else TEXTS["missing"], "present",
                                f"Column '{column}' {'exists' if ok else 'is missing'}"))


# ---------------------------------------------------------------------------------------------
# Row count and null rate
# ---------------------------------------------------------------------------------------------

def row_count(min_rows: int = 0, max_rows: int | None = None, label: str = "dataset") -> Check:
    """``row_count.<label>``: min <= count <= max (inclusive, open upper bound if None)."""
    n = F.col(ROWS)
    rng = (TEXTS["at_least"].format(min=min_rows) if max_rows is None
           else TEXTS["between"].format(min=min_rows, max=max_rows))
    passed = n >= min_rows if max_rows is None else n.between(min_rows, max_rows)
    msg = F.when(passed, _text(MESSAGES["row_count_ok"], count=n, range=rng)).otherwise(
        _text(MESSAGES["row_count_bad"], count=n, range=rng))
    name = _name("row_count", label=label)
    return Check(name, aggs=_rows_agg(),
                 row=_result(name, passed, n, rng, msg, n))


def null_rate(columns: Sequence[str], present: Sequence[str], max_rate: float = 0.05,
              on_missing: str = "fail") -> list[Check]:
    """``null_rate.<c>``: NULL share of each column <= ``max_rate``.

    An empty frame yields no rows. A missing column yields a failed row with actual
    ``column_missing`` (``on_missing="fail"``) or raises (``on_missing="error"``).
    """
    out = []
    rows = F.col(ROWS)
    expected = TEXTS["at_most"].format(max=max_rate)
    for c in columns:
        name = _name("null_rate", column=c)
        if c not in present:
            missing_msg = _text(MESSAGES["column_missing"], column=c)
            if on_missing == "error":
                raise ValueError(missing_msg)
            out.append(Check(name, aggs=_rows_agg(), row=_result(
                name, False, TEXTS["column_missing"], expected, missing_msg, None, rows > 0)))
            continue
        alias = f"__nulls_{_safe(c)}"
        rate = F.col(alias).cast("double") / rows.cast("double")
        passed = rate <= F.lit(max_rate)
        msg = F.when(passed, _text(MESSAGES["null_rate_ok"], column=c, percent=_pct(rate))
                     ).otherwise(_text(MESSAGES["null_rate_bad"], column=c, percent=_pct(rate),
                                       threshold=f"{max_rate * 100:.2f}"))
        out.append(Check(name,
                         aggs={**_rows_agg(), alias: F.sum(_col(c).isNull().cast("long"))},
                         row=_result(name, passed, F.format_string("%.4f", rate), expected, msg,
                                     rate, rows > 0)))
    return out


def empty_date_row_counts(spark, dates: Iterable, min_rows: int, label: str) -> DataFrame:
    """``row_count.<label>`` rows for dates of a range that have no rows at all (a grouped
    evaluation has no group for them). ``dates`` is the short driver-side list of such dates."""
    rng = TEXTS["at_least"].format(min=min_rows)
    ok = 0 >= min_rows
    msg = MESSAGES["row_count_ok" if ok else "row_count_bad"].format(count=0, range=rng)
    rows = [(d.year, d.month, d.day, CHECK_NAMES["row_count"].format(label=label), ok, "0", rng,
             msg, 0.0) for d in dates]
    return spark.createDataFrame(rows, "year int, month int, day int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in QUALITY_SCHEMA.fields))


def empty_date_partitions(spark, dates: Iterable, base_path: str) -> DataFrame:
    """Failed ``partition_exists.<date>`` rows for dates of a range that have no rows at all."""
    rows = []
    for d in dates:
        spec = f"year={d.year}/month={d.month}/day={d.day}"
        path = f"{base_path.rstrip('/')}/{spec}"
        rows.append((d.year, d.month, d.day, CHECK_NAMES["partition_exists"].format(date=d.isoformat()), False,
                     TEXTS["missing"], spec, MESSAGES["partition_bad"].format(path=path), 0.0))
    return spark.createDataFrame(rows, "year int, month int, day int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in QUALITY_SCHEMA.fields))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULL count per column (0, not NULL, on an empty frame), plus the row count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.coalesce(F.sum(_col(c).isNull().cast("long")), F.lit(0)).alias(c)
                    for c in columns])


# ---------------------------------------------------------------------------------------------
# Schema drift (baseline comparison is on column names: metadata only)
# ---------------------------------------------------------------------------------------------

def schema_drift(columns: Iterable[str], baseline: Iterable[str] | None, layer: str) -> Check:
    cur = sorted(set(columns))
    name = _name("schema_drift", layer=layer)
    if baseline is None:
        return Check(name, row=_result(name, True, str(cur), TEXTS["baseline_written"],
                                       MESSAGES["drift_baseline"]))
    ref = sorted(set(baseline))
    added = sorted(set(cur) - set(ref))
    removed = sorted(set(ref) - set(cur))
    ok = not added and not removed
    msg = (MESSAGES["drift_ok"] if ok
           else _text(MESSAGES["drift_bad"], added=added, removed=removed))
    return Check(name, row=_result(name, ok, str(cur), str(ref), msg,
                                   float(len(added) + len(removed))))


# ---------------------------------------------------------------------------------------------
# Partition presence
# ---------------------------------------------------------------------------------------------

def partition_exists(execution_date: str | None, base_path: str) -> Check:
    """``partition_exists.<date>``: the date's slice holds at least one row (frame = the slice).

    With ``execution_date=None`` the check is meant for grouped evaluation by (year, month, day)
    and names each group's own partition.
    """
    rows = F.col(ROWS)
    ok = rows > 0
    root = base_path.rstrip("/")
    if execution_date is None:
        date = F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd")
        part = _text(TEXTS["partition_path"], root=root, year=F.col("year"),
                     month=F.col("month"), day=F.col("day"))
        name = _name("partition_exists", date=date)
    else:
        from strata.functions.dates import parse_date
        d = parse_date(execution_date)
        part = F.lit(TEXTS["partition_path"].format(root=root, year=d.year, month=d.month,
                                                    day=d.day))
        name = F.lit(_name("partition_exists", date=execution_date))
    msg = F.when(ok, _text(MESSAGES["partition_ok"], path=part)).otherwise(
        _text(MESSAGES["partition_bad"], path=part))
    spec = F.regexp_extract(part, r"(year=.*)$", 1)
    return Check("partition_exists", aggs=_rows_agg(), row=_result(
        name, ok, F.when(ok, part).otherwise(F.lit("missing")), spec, msg, rows))


def partition_completeness(table: DataFrame, start: str, end: str) -> DataFrame:
    """Row count per expected date in [start, end]; 0 for a date without data.

    The calendar is generated in Spark (``sequence``) and left-joined to the per-date counts;
    only the partition columns are read from the table.
    """
    from strata.functions.dates import partition_range_predicate
    spark = table.sparkSession
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"),
                                                     F.lit(end).cast("date"))).alias("d"))
    cal = cal.select(F.year("d").alias("year"), F.month("d").alias("month"),
                     F.dayofmonth("d").alias("day"),
                     F.date_format("d", "yyyy-MM-dd").alias("partition_date"))
    counts = (table.where(partition_range_predicate(start, end))
                   .groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("row_count")))
    return (cal.join(counts, ["year", "month", "day"], "left")
               .select("partition_date", "year", "month", "day",
                       F.coalesce("row_count", F.lit(0)).alias("row_count"),
                       (F.coalesce("row_count", F.lit(0)) > 0).alias("passed")))


# ---------------------------------------------------------------------------------------------
# Expectations
# ---------------------------------------------------------------------------------------------

def _fraction_check(name: str, num_alias: str, num: Column, den_alias: str, den: Column,
                    mostly: float, expected: str) -> Check:
    n, d = F.col(num_alias), F.col(den_alias)
    frac = F.when(d > 0, n.cast("double") / d.cast("double"))
    passed = (d == 0) | (frac >= F.lit(mostly))
    msg = F.format_string("%d of %d evaluated values as expected", n, d)
    return Check(name, aggs={num_alias: num, den_alias: den},
                 row=_result(name, passed,
                             F.coalesce(F.format_string("%.4f", frac), F.lit("n/a")),
                             expected, msg, frac))


def expect_table_row_count_between(min_value=None, max_value=None) -> Check:
    n = F.col(ROWS)
    lo = F.lit(True) if min_value is None else n >= min_value
    hi = F.lit(True) if max_value is None else n <= max_value
    rng = f"[{_fmt_bound(min_value, '-inf')}, {_fmt_bound(max_value, 'inf')}]"
    name = "expect_table_row_count_to_be_between"
    return Check(name, aggs=_rows_agg(),
                 row=_result(name, lo & hi, n, rng, F.format_string(f"%d rows, expected {rng}", n),
                             n))


def expect_not_null(column: str, present: Sequence[str], mostly: float = 1.0) -> Check:
    name = f"expect_column_values_to_not_be_null.{column}"
    if column not in present:
        return _missing_column(name, column, f"mostly >= {mostly}")
    s = _safe(column)
    return _fraction_check(name, f"__nn_{s}", F.count(_col(column)), ROWS, F.count(F.lit(1)),
                           mostly, f"mostly >= {mostly}")


def expect_regex(column: str, present: Sequence[str], regex: str, mostly: float = 1.0) -> Check:
    name = f"expect_column_values_to_match_regex.{column}"
    expected = f"{regex} mostly >= {mostly}"
    if column not in present:
        return _missing_column(name, column, expected)
    s = _safe(column)
    c = _col(column).cast("string")
    return _fraction_check(name, f"__rx_{s}_{zlib.crc32(regex.encode())}",
                           F.count(F.when(c.rlike(regex), 1)), f"__nn_{s}",
                           F.count(_col(column)), mostly, expected)


def expect_between(column: str, present: Sequence[str], min_value=None, max_value=None,
                   mostly: float = 1.0) -> Check:
    name = f"expect_column_values_to_be_between.{column}"
    rng = f"[{_fmt_bound(min_value, '-inf')}, {_fmt_bound(max_value, 'inf')}]"
    expected = f"{rng} mostly >= {mostly}"
    if column not in present:
        return _missing_column(name, column, expected)
    s = _safe(column)
    c = _col(column)
    cond = F.lit(True)
    if min_value is not None:
        cond = cond & (c >= F.lit(min_value))
    if max_value is not None:
        cond = cond & (c <= F.lit(max_value))
    return _fraction_check(name, f"__bt_{s}_{zlib.crc32(rng.encode())}",
                           F.count(F.when(c.isNotNull() & cond, 1)), f"__nn_{s}",
                           F.count(c), mostly, expected)


def expect_compound_unique(columns: Sequence[str], present: Sequence[str]) -> Check:
    """Rows whose key combination occurs more than once are unexpected; all-NULL keys ignored.

    Evaluated as its own aggregation: group by the key (map-side partial counts, one shuffle),
    then a global sum of the sizes of duplicated groups.
    """
    cols = list(columns)
    name = f"expect_compound_columns_to_be_unique.{','.join(cols)}"
    missing = [c for c in cols if c not in present]
    if missing:
        return _missing_column(name, ",".join(missing), "unique")

    def run(df: DataFrame, by: Sequence[str]) -> DataFrame:
        any_key = F.lit(False)
        for c in cols:
            any_key = any_key | _col(c).isNotNull()
        keys = list(by) + [c for c in cols if c not in by]
        groups = (df.where(any_key).groupBy(*[_col(k) for k in keys])
                    .agg(F.count(F.lit(1)).alias("n")))
        tot = groups.groupBy(*[_col(b) for b in by]).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("considered"),
            F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected"))
        u = F.col("unexpected")
        row = _result(name, u == 0, u, "0 duplicated rows",
                      F.format_string("%d of %d rows share a key", u, F.col("considered")), u)
        byc = [_col(b) for b in by]
        return tot.select(*byc, row.alias("r")).select(*byc, "r.*").drop("emit")

    return Check(name, separate=run)


def _missing_column(name: str, column: str, expected: str) -> Check:
    return Check(name, row=_result(name, False, TEXTS["column_missing"], expected,
                                   _text(MESSAGES["column_missing"], column=column)))


def compile_suite(suite: Sequence[dict], columns: Sequence[str]) -> list[Check]:
    """Expectation list (type + kwargs) → checks. Unknown types raise ``ValueError``."""
    checks = []
    for exp in suite:
        t, kw = exp["expectation_type"], dict(exp.get("kwargs", {}))
        mostly = kw.get("mostly", 1.0)
        if t == "expect_table_row_count_to_be_between":
            checks.append(expect_table_row_count_between(kw.get("min_value"), kw.get("max_value")))
        elif t == "expect_column_to_exist":
            checks.append(column_exists(columns, kw["column"]))
        elif t == "expect_column_values_to_not_be_null":
            checks.append(expect_not_null(kw["column"], columns, mostly))
        elif t == "expect_column_values_to_match_regex":
            checks.append(expect_regex(kw["column"], columns, kw["regex"], mostly))
        elif t == "expect_column_values_to_be_between":
            checks.append(expect_between(kw["column"], columns, kw.get("min_value"),
                                         kw.get("max_value"), mostly))
        elif t == "expect_compound_columns_to_be_unique":
            checks.append(expect_compound_unique(kw["column_list"], columns))
        else:
            raise ValueError(f"Unsupported expectation type: {t}")
    return checks


# ---------------------------------------------------------------------------------------------
# Evaluation, summary, gate, stamping
# ---------------------------------------------------------------------------------------------

def evaluate(df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """All inline checks in one aggregation pass; separate ones unioned in. Lazy.

    With ``by`` (e.g. the date partition columns of a backfill) every check is evaluated per
    group in the same single pass, and the result rows carry the ``by`` columns first.
    """
    by, aggs = list(by), _inline_aggs(checks)
    if by:
        base = df.groupBy(*by).agg(*[e.alias(a) for a, e in {**_rows_agg(), **aggs}.items()])
    else:
        base = df.agg(*[e.alias(a) for a, e in aggs.items()]) if aggs else None
    return _evaluated(df, checks, by, base)


def _evaluated(df: DataFrame, checks: Sequence[Check], by: list[str], base: DataFrame | None) -> DataFrame:
    """Result rows of the inline checks from the row (or row per group) ``base`` of their aggregates,
    and those of the separate checks from ``df``."""
    spark = df.sparkSession
    inline = [c for c in checks if c.separate is None]
    parts: list[DataFrame] = []
    if inline:
        base = base if base is not None else spark.range(1)
        rows = (base.select(*by, F.explode(F.array(*[c.row for c in inline])).alias("r"))
                    .select(*by, "r.*"))
        parts.append(rows.where(F.col("emit")).drop("emit"))
    for c in checks:
        if c.separate is not None:
            parts.append(c.separate(df, by))
    if not parts:
        return spark.createDataFrame([], QUALITY_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` with the aggregates of all inline checks observed on it: whatever is run on the frame
    that comes back, a write say, computes them on the way. The observation must sit above the
    last shuffle (directly before a write): there a task that runs again counts once."""
    aggs = _inline_aggs(checks)
    if not aggs:
        return df, None
    seen = Observation()
    return df.observe(seen, *[e.alias(a) for a, e in aggs.items()]), seen


def evaluate_observed(df: DataFrame, seen: Observation | None, checks: Sequence[Check]) -> DataFrame:
    """:func:`evaluate` from what :func:`observe` saw while ``df`` was written: no scan of ``df`` but for
    separate checks (compound uniqueness)."""
    aggs = _inline_aggs(checks)
    schema = df.agg(*[e.alias(a) for a, e in aggs.items()]).schema if aggs else T.StructType([])
    values = seen.get if seen is not None else {}
    base = df.sparkSession.createDataFrame([tuple(values[f.name] for f in schema.fields)], schema) if aggs else None
    return _evaluated(df, checks, [], base)


def _inline_aggs(checks: Sequence[Check]) -> dict[str, Column]:
    aggs: dict[str, Column] = {}
    for c in checks:
        if c.separate is None:
            aggs.update(c.aggs)
    return aggs


def summarize(results: DataFrame) -> DataFrame:
    """Suite outcome in one row: success, evaluated and failed counts."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count(F.when(~F.col("passed"), 1)).alias("failed"))


def stamp(results: DataFrame, pipeline_run_id: str, layer: str, execution_date: str | None,
          now: str) -> DataFrame:
    """Audit stamps; ``now`` is a parameter so reruns are reproducible. With
    ``execution_date=None`` the date comes from the rows' (year, month, day)."""
    date = (F.lit(execution_date) if execution_date is not None
            else F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd"))
    return results.withColumns({
        "checked_at": F.lit(now), "pipeline_run_id": F.lit(pipeline_run_id),
        "execution_date": date, "written_at": F.lit(now),
        "layer": F.lit(layer)})


def failures(results: DataFrame) -> DataFrame:
    return results.where(~F.col("passed"))


def gate(results: DataFrame) -> None:
    """Raise :class:`DataQualityError` listing ``[check] message`` if any check failed.

    Only failed rows reach the driver (at most one per check).
    """
    gate_rows(failures(results).select("passed", "check_name", "message").collect())


def gate_rows(rows) -> None:
    """:func:`gate` over already collected result rows."""
    failed = [r for r in rows if not r["passed"]]
    if failed:
        lines = "\n".join(f"  [{r['check_name']}] {r['message']}" for r in failed)
        head = MESSAGES["gate"].format(count=len(failed))
        raise DataQualityError(f"{head}\n{lines}")

