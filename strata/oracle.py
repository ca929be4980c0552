"""DuckDB SQL equivalents of :mod:`strata.queries` (the correctness oracle).

Each statement recomputes the query's result from the raw test tables; quality rows are
generated by the helpers below with the same names, thresholds and rounding as the Spark side.
"""

from __future__ import annotations

from strata.fixtures import RAW_EVENTS_SQL
from strata.queries import EXECUTION_DATE, NOW, ORDERS_DATE, RUN_ID

ORACLE: dict[str, str] = {}

# Extra CTEs: bronze as landed (missing source stamped with the extract's label), and silver
# rebuilt from bronze with the date in the dedup key (per-date runs / backfill).
EXTRA = f"""
, bronze AS (
  SELECT k, id, amount, event_date, created_at, is_active,
    coalesce(source_system, 'ops_db') AS source_system, year, month, day,
    '{RUN_ID}' AS pipeline_run_id, '{NOW}' AS ingested_at
  FROM raw),
btyped AS (
  SELECT k, TRY_CAST(id AS BIGINT) AS id, TRY_CAST(amount AS DOUBLE) AS amount,
    TRY_CAST(event_date AS DATE) AS event_date, TRY_CAST(created_at AS TIMESTAMP) AS created_at,
    TRY_CAST(is_active AS BOOLEAN) AS is_active, source_system, year, month, day,
    pipeline_run_id, ingested_at
  FROM bronze),
bsilver AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY id, event_date, source_system, year, month, day
      ORDER BY created_at DESC NULLS LAST, amount DESC NULLS LAST, k) AS rn FROM btyped) z
  WHERE rn = 1 AND id IS NOT NULL AND source_system IS NOT NULL AND amount >= 0),
daily AS (
  SELECT source_system, year, month, day, count(*) AS total_records,
    count(DISTINCT id) AS distinct_ids, sum(amount) AS total_amount, avg(amount) AS avg_amount,
    max(amount) AS max_amount, min(amount) AS min_amount, '{NOW}' AS computed_at
  FROM silver GROUP BY source_system, year, month, day)
"""

D = EXECUTION_DATE.split("-")
DATE_PRED = f"year = {int(D[0])} AND month = {int(D[1])} AND day = {int(D[2])}"


def _with(body: str) -> str:
    return f"WITH {RAW_EVENTS_SQL}{EXTRA}\n{body}"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rate(nulls: str, n: str) -> str:
    return f"CAST({nulls} AS DOUBLE) / CAST({n} AS DOUBLE)"


def _kpi_cols(round_: bool = True) -> str:
    return ("count(*) AS record_count, count(DISTINCT id) AS unique_entities, "
            "round(sum(amount), 2) AS total_value, "
            "round(sum(amount), 2) / count(*) AS avg_value, "
            "abs(avg(amount) - round(sum(amount), 2) / count(*)) <= 1e-6 AS avg_value_agrees, "
            "CAST(sum(CASE WHEN is_active = true THEN 1 ELSE 0 END) AS DOUBLE) / "
            "CAST(count(*) AS DOUBLE) AS active_rate")


def _daily_cols() -> str:
    return ("count(*) AS total_records, count(DISTINCT id) AS distinct_ids, "
            "round(sum(amount), 2) AS total_amount, round(sum(amount), 2) / count(*) AS avg_amount, "
            "abs(avg(amount) - round(sum(amount), 2) / count(*)) <= 1e-6 AS avg_amount_agrees, "
            f"max(amount) AS max_amount, min(amount) AS min_amount, '{NOW}' AS computed_at")


# --- quality-row generators -----------------------------------------------------------------
# Each returns SELECT statements over a relation ``src`` producing
# (…prefix, check_name, passed, observed, expected).

def null_rate_rows(src: str, cols, max_rate: float, prefix: str = "", group: str = "") -> list[str]:
    out = []
    gb = f" GROUP BY {group}" if group else ""
    for c in cols:
        r = _rate(f"count(*) - count({c})", "count(*)")
        out.append(f"SELECT {prefix}'null_rate.{c}' AS check_name, {r} <= {max_rate} AS passed, "
                   f"{r} AS observed, {_q(f'<= {max_rate}')} AS expected "
                   f"FROM {src}{gb} HAVING count(*) > 0")
    return out


def row_count_rows(src: str, label: str, lo: int, hi: int | None = None, prefix: str = "",
                   group: str = "") -> str:
    gb = f" GROUP BY {group}" if group else ""
    rng = f">= {lo}" if hi is None else f"[{lo}, {hi}]"
    cond = f"count(*) >= {lo}" if hi is None else f"count(*) BETWEEN {lo} AND {hi}"
    return (f"SELECT {prefix}'row_count.{label}' AS check_name, {cond} AS passed, "
            f"CAST(count(*) AS DOUBLE) AS observed, {_q(rng)} AS expected FROM {src}{gb}")


def table_count_row(src: str, lo, hi) -> str:
    rng = f"[{'-inf' if lo is None else lo}, {'inf' if hi is None else hi}]"
    conds = [c for c in (None if lo is None else f"count(*) >= {lo}",
                         None if hi is None else f"count(*) <= {hi}") if c] or ["true"]
    return (f"SELECT 'expect_table_row_count_to_be_between' AS check_name, "
            f"{' AND '.join(conds)} AS passed, CAST(count(*) AS DOUBLE) AS observed, "
            f"{_q(rng)} AS expected FROM {src}")


def exists_row(col: str) -> str:
    return (f"SELECT 'expect_column_to_exist.{col}' AS check_name, true AS passed, "
            f"CAST(NULL AS DOUBLE) AS observed, 'present' AS expected")


def fraction_row(name: str, src: str, num: str, den: str, mostly: float, expected: str) -> str:
    frac = f"CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE)"
    return (f"SELECT {_q(name)} AS check_name, ({den} = 0 OR {frac} >= {mostly}) AS passed, "
            f"CASE WHEN {den} > 0 THEN {frac} END AS observed, {_q(expected)} "
            f"AS expected FROM {src}")


def not_null_row(src: str, col: str, mostly: float) -> str:
    return fraction_row(f"expect_column_values_to_not_be_null.{col}", src, f"count({col})",
                        "count(*)", mostly, f"mostly >= {mostly}")


def regex_row(src: str, col: str, regex: str, mostly: float) -> str:
    return fraction_row(f"expect_column_values_to_match_regex.{col}", src,
                        f"count(CASE WHEN regexp_matches(CAST({col} AS VARCHAR), {_q(regex)}) "
                        "THEN 1 END)", f"count({col})", mostly, f"{regex} mostly >= {mostly}")


def between_row(src: str, col: str, lo, hi, mostly: float) -> str:
    conds = [f"{col} IS NOT NULL"]
    if lo is not None:
        conds.append(f"{col} >= {lo}")
    if hi is not None:
        conds.append(f"{col} <= {hi}")
    rng = f"[{'-inf' if lo is None else lo}, {'inf' if hi is None else hi}]"
    return fraction_row(f"expect_column_values_to_be_between.{col}", src,
                        f"count(CASE WHEN {' AND '.join(conds)} THEN 1 END)", f"count({col})",
                        mostly, f"{rng} mostly >= {mostly}")


def unique_row(src: str, cols) -> str:
    c = ", ".join(cols)
    anyk = " OR ".join(f"{x} IS NOT NULL" for x in cols)
    u = "coalesce(sum(CASE WHEN n > 1 THEN n END), 0)"
    return (f"SELECT 'expect_compound_columns_to_be_unique.{','.join(cols)}' AS check_name, "
            f"{u} = 0 AS passed, CAST({u} AS DOUBLE) AS observed, '0 duplicated rows' AS expected "
            f"FROM (SELECT {c}, count(*) AS n FROM {src} WHERE {anyk} GROUP BY {c}) g")


def union(parts) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


# --- suites ----------------------------------------------------------------------------------

def suite_rows(layer: str, src: str) -> list[str]:
    from strata.contract import SUITES
    out = []
    for e in SUITES[layer]:
        t, kw = e["expectation_type"], e["kwargs"]
        m = kw.get("mostly", 1.0)
        if t == "expect_table_row_count_to_be_between":
            out.append(table_count_row(src, kw.get("min_value"), kw.get("max_value")))
        elif t == "expect_column_to_exist":
            out.append(exists_row(kw["column"]))
        elif t == "expect_column_values_to_not_be_null":
            out.append(not_null_row(src, kw["column"], m))
        elif t == "expect_column_values_to_match_regex":
            out.append(regex_row(src, kw["column"], kw["regex"], m))
        elif t == "expect_column_values_to_be_between":
            out.append(between_row(src, kw["column"], kw.get("min_value"), kw.get("max_value"),
                                   m))
        elif t == "expect_compound_columns_to_be_unique":
            out.append(unique_row(src, kw["column_list"]))
    return out


def profile_rows(layer: str, src: str, base: str, group: str = "year, month, day",
                 prefix: str = "year, month, day, ", baseline: str | None = None) -> list[str]:
    from strata.contract import LAYER_PROFILES
    p = LAYER_PROFILES[layer]
    part = f"{_q('year=')} || year || '/month=' || month || '/day=' || day"
    date = "strftime(make_date(year, month, day), '%Y-%m-%d')"
    return ([row_count_rows(src, layer, p["min_rows"], prefix=prefix, group=group)]
            + null_rate_rows(src, p["columns"], p["max_null_rate"], prefix=prefix, group=group)
            + [f"SELECT {prefix}'schema_drift.{layer}' AS check_name, true AS passed, "
               f"CAST({'NULL' if baseline is None else '0'} AS DOUBLE) AS observed, "
               f"{_q('baseline written' if baseline is None else baseline)} AS expected "
               f"FROM {src} GROUP BY {group}",
               f"SELECT {prefix}'partition_exists.' || {date} AS check_name, count(*) > 0 AS "
               f"passed, CAST(count(*) AS DOUBLE) AS observed, {part} AS expected "
               f"FROM {src} GROUP BY {group}"])


# --- queries ---------------------------------------------------------------------------------

ORACLE["gold_daily"] = _with(
    f"SELECT source_system, year, month, day, {_daily_cols()} FROM silver "
    "GROUP BY source_system, year, month, day")

ORACLE["attach_metadata"] = _with(
    f"SELECT k, id, amount, event_date, created_at, is_active, '{RUN_ID}' AS pipeline_run_id, "
    f"'{NOW}' AS ingested_at, 'crm' AS source_system, {int(D[0])} AS year, {int(D[1])} AS month,"
    f" {int(D[2])} AS day FROM raw")
ORACLE["cast_types"] = _with("SELECT * FROM typed")
ORACLE["deduplicate"] = _with("SELECT * FROM ded")
ORACLE["deduplicate_lineitem"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST,
           l_extendedprice NULLS LAST, l_discount NULLS LAST, l_tax NULLS LAST,
           l_returnflag NULLS LAST, l_linestatus NULLS LAST, l_shipdate NULLS LAST) AS rn
  FROM lineitem) z WHERE rn = 1"""
ORACLE["dedup_report"] = _with("""
SELECT a.n AS rows_before, b.n AS rows_after, a.n - b.n AS rows_removed
FROM (SELECT count(*) AS n FROM typed) a,
     (SELECT count(*) AS n FROM (SELECT DISTINCT id, event_date, source_system FROM typed)) b""")
ORACLE["business_rules_not_null"] = _with(
    "SELECT * FROM ded WHERE id IS NOT NULL AND source_system IS NOT NULL")
ORACLE["business_rules"] = _with("SELECT * FROM silver")
ORACLE["enrich_dim"] = _with(
    "SELECT s.*, d.source_label FROM silver s LEFT JOIN dim d ON s.source_system = d.source_system")
ORACLE["enrich_nation"] = (
    "SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")

ORACLE["gold_kpis"] = _with(
    f"SELECT source_system, {_kpi_cols()}, '{EXECUTION_DATE}' AS execution_date, "
    f"'{NOW}' AS computed_at FROM silver GROUP BY source_system")
ORACLE["active_rate"] = _with(
    'SELECT source_system, count(*) AS "rows", CAST(sum(CASE WHEN is_active = true THEN 1 '
    "ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS active_rate FROM typed "
    "GROUP BY source_system")
ORACLE["null_counts"] = _with(
    "SELECT count(*) AS row_count, " + ", ".join(
        f"count(*) - count({c}) AS {c}" for c in
        ("id", "amount", "event_date", "created_at", "is_active", "source_system"))
    + " FROM typed")

ORACLE["dq_schema"] = _with("""
SELECT t.*, CAST(CASE replace(replace(check_name, 'schema.field_ok.', ''), 'schema.field_type.', '')
    WHEN 'id' THEN n_id WHEN 'amount' THEN n_amount WHEN 'event_date' THEN n_event_date
    WHEN 'created_at' THEN n_created_at WHEN 'is_active' THEN n_is_active
    WHEN 'source_system' THEN n_source_system WHEN 'year' THEN n_year END AS DOUBLE) AS observed
FROM (SELECT count(id) AS n_id, count(amount) AS n_amount, count(event_date) AS n_event_date,
        count(created_at) AS n_created_at, count(is_active) AS n_is_active,
        count(source_system) AS n_source_system, count(year) AS n_year FROM silver) n, (VALUES
  ('schema.field_ok.id', true, 'long', 'long', 'column ''id'' as expected'),
  ('schema.field_ok.amount', true, 'double', 'double', 'column ''amount'' as expected'),
  ('schema.field_ok.event_date', true, 'date', 'date', 'column ''event_date'' as expected'),
  ('schema.field_ok.created_at', true, 'timestamp', 'timestamp', 'column ''created_at'' as expected'),
  ('schema.field_ok.is_active', true, 'boolean', 'boolean', 'column ''is_active'' as expected'),
  ('schema.field_ok.source_system', true, 'string', 'string', 'column ''source_system'' as expected'),
  ('schema.field_present.source_label', false, 'missing', 'string',
   'no column ''source_label'''),
  ('schema.field_type.year', false, 'integer', 'long',
   'column ''year'' is integer, should be long')
) AS t(check_name, passed, actual, expected, message)""")

ORACLE["dq_null_rate"] = _with(union(null_rate_rows(
    "ded", ["id", "event_date", "source_system", "amount", "is_active"], 0.05)))

_r = _rate("count(*) - count({c})", "count(*)")
ORACLE["dq_null_rate_missing"] = _with(union([
    *[f"SELECT 'null_rate.{c}' AS check_name, {_r.format(c=c)} <= 0.02 AS passed, "
      f"printf('%.4f', {_r.format(c=c)}) AS actual, '<= 0.02' AS expected FROM ded "
      "HAVING count(*) > 0" for c in ("id", "source_system")],
    "SELECT 'null_rate.customer_tier' AS check_name, false AS passed, 'column_missing' AS actual,"
    " '<= 0.02' AS expected FROM ded HAVING count(*) > 0"]))


def _rc_full(label, lo, hi=None):
    rng = f">= {lo}" if hi is None else f"[{lo}, {hi}]"
    cond = f"count(*) >= {lo}" if hi is None else f"count(*) BETWEEN {lo} AND {hi}"
    return (f"SELECT 'row_count.{label}' AS check_name, {cond} AS passed, "
            f"CAST(count(*) AS VARCHAR) AS actual, {_q(rng)} AS expected, "
            f"CASE WHEN {cond} THEN count(*) || ' rows, allowed {rng}' "
            f"ELSE count(*) || ' rows, but allowed {rng}' END AS message "
            "FROM silver")


ORACLE["dq_row_count"] = _with(union([_rc_full("silver", 1), _rc_full("silver_bounded", 1, 5000),
                                      _rc_full("silver_any", 0)]))

_typed_cols = sorted(["k", "id", "amount", "event_date", "created_at", "is_active",
                      "source_system", "year", "month", "day"])
_enriched_cols = sorted([c for c in _typed_cols if c != "k"] + ["source_label"])
ORACLE["dq_schema_drift"] = _with(
    " UNION ALL ".join(
        f"SELECT {run} AS run, check_name, passed, actual, expected, message FROM "
        f"({_rc_full('silver', 1).replace('FROM silver', 'FROM ' + src)}) r{run}"
        for run, src in ((1, "typed"), (2, "silver")))
    + " UNION ALL SELECT * FROM (VALUES "
    f"(1, 'schema_drift.silver', true, {_q(str(_typed_cols))}, 'baseline written', "
    "'first run: columns saved as the baseline'), "
    f"(2, 'schema_drift.silver', false, {_q(str(_enriched_cols))}, {_q(str(_typed_cols))}, "
    f"{_q('columns differ from the baseline: new ' + str(['source_label']) + ', gone ' + str(['k']))})"
    ") AS t(run, check_name, passed, actual, expected, message)")

ORACLE["dq_partitions"] = _with("""
SELECT strftime(c.d, '%Y-%m-%d') AS partition_date, CAST(year(c.d) AS INT) AS year,
  CAST(month(c.d) AS INT) AS month, CAST(day(c.d) AS INT) AS day,
  coalesce(n.row_count, 0) AS row_count, coalesce(n.row_count, 0) > 0 AS passed
FROM (SELECT CAST(unnest(generate_series(min(ts)::DATE - INTERVAL 2 DAY, max(ts)::DATE + INTERVAL 2 DAY,
      INTERVAL 1 DAY)) AS DATE) AS d FROM events) c
LEFT JOIN (SELECT year, month, day, count(*) AS row_count FROM silver
           GROUP BY year, month, day) n
  ON n.year = year(c.d) AND n.month = month(c.d) AND n.day = day(c.d)""")

ORACLE["exp_row_count"] = _with(union([table_count_row("silver", 1, 50000000),
                                       table_count_row("silver", 0, None),
                                       table_count_row("silver", 20000, None)]))
ORACLE["exp_not_null"] = _with(union([not_null_row("ded", "id", 1.0),
                                      not_null_row("ded", "event_date", 0.98),
                                      not_null_row("ded", "source_system", 0.95),
                                      not_null_row("ded", "amount", 0.9)]))
ORACLE["exp_regex"] = _with(union([
    regex_row("raw", "created_at", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", 1.0),
    regex_row("raw", "id", r"^[0-9]+$", 0.99),
    regex_row("raw", "event_date", r"^\d{4}-\d{2}-\d{2}$", 0.95)]))
ORACLE["exp_between"] = _with(union([between_row("typed", "amount", 0, None, 0.95),
                                     between_row("typed", "amount", 0, 500, 0.999),
                                     between_row("typed", "day", 1, 31, 1.0)]))
ORACLE["exp_unique"] = _with(union([unique_row("typed", ["id", "event_date", "source_system"]),
                                    unique_row("lineitem", ["l_orderkey", "l_linenumber"]),
                                    unique_row("orders", ["o_orderkey"])]))
ORACLE["exp_suite_bronze"] = _with(union(suite_rows("bronze", "bronze")))
ORACLE["exp_suite_silver"] = _with(union(suite_rows("silver", "silver")))
ORACLE["exp_suite_gold"] = _with(union(suite_rows("gold", "daily")))

ORACLE["dq_profile_bronze"] = _with(union(profile_rows(
    "bronze", "bronze", "/bronze", baseline=str(sorted([*_typed_cols, "pipeline_run_id", "ingested_at"])))))
ORACLE["dq_profile_silver"] = _with(union(profile_rows(
    "silver", "silver", "/silver", baseline=str(_typed_cols))))
ORACLE["dq_profile_gold"] = _with(
    ", kpi AS (SELECT source_system, year, month, day, count(*) AS record_count, "
    "strftime(make_date(year, month, day), '%Y-%m-%d') AS execution_date FROM silver "
    "GROUP BY source_system, year, month, day) "
    + union(profile_rows("gold", "kpi", "/gold/kpi_summary", baseline=str(sorted(
        ["source_system", "year", "month", "day", "record_count", "unique_entities", "total_value",
         "avg_value", "active_rate", "execution_date", "computed_at"])))))


def _env_rows() -> list[str]:
    from strata.contract import GATE_COLUMNS, THRESHOLDS
    out = []
    for env in ("dev", "staging", "prod"):
        t = THRESHOLDS[env]["silver"]
        pre = f"'{env}' AS env, "
        out += null_rate_rows("silver", GATE_COLUMNS["silver"], t["max_null_rate"], prefix=pre)
        out.append(row_count_rows("silver", "silver", t["min_rows"], prefix=pre))
    return out


ORACLE["dq_env_thresholds"] = _with(union(_env_rows()))
ORACLE["gate_bronze"] = _with(union(null_rate_rows(
    "bronze", ["pipeline_run_id", "ingested_at", "source_system"], 0.0)))
ORACLE["gate_silver"] = _with(union(
    null_rate_rows("silver", ["id", "event_date", "source_system"], 0.05)
    + [row_count_rows("silver", "silver", 1)]))
ORACLE["gate_gold"] = _with(union([
    row_count_rows("daily", "gold_daily", 1),
    row_count_rows("(SELECT source_system FROM silver GROUP BY source_system) k", "gold_kpis",
                   1)]))

_landed_summary = _with(
    'SELECT source_system, count(*) AS "rows", count(id) AS ids, '
    "count(TRY_CAST(amount AS DOUBLE)) AS amounts, "
    "round(sum(TRY_CAST(amount AS DOUBLE)), 2) AS total_amount, count(created_at) AS created "
    "FROM raw GROUP BY source_system")
ORACLE["scan_csv"] = _landed_summary
ORACLE["scan_json"] = _landed_summary
ORACLE["scan_parquet"] = (
    'SELECT event_type, count(*) AS "rows", count(DISTINCT user_id) AS users, '
    "round(sum(value), 2) AS total_value FROM events GROUP BY event_type")
ORACLE["jdbc_date_slice"] = (
    f"SELECT * FROM orders WHERE o_orderdate >= DATE '{ORDERS_DATE}' "
    f"AND o_orderdate < DATE '{ORDERS_DATE}' + INTERVAL 1 DAY")
ORACLE["partition_scan"] = _with(f"SELECT * FROM bronze WHERE {DATE_PRED}")
ORACLE["api_page_counts"] = _with(
    "SELECT make_date(year, month, day) AS landing_date, page, count(*) AS record_count FROM "
    "(SELECT year, month, day, CAST(floor((row_number() OVER (PARTITION BY year, month, day "
    "ORDER BY k) - 1) / 50) + 1 AS INT) AS page FROM raw WHERE source_system = 'events_api') p "
    "GROUP BY year, month, day, page")
ORACLE["multi_source_bronze"] = _with(
    'SELECT source_system, year, month, day, count(*) AS "rows", count(id) AS ids, '
    "count(DISTINCT k) AS keys FROM bronze GROUP BY source_system, year, month, day")

ORACLE["bronze_roundtrip"] = _with("SELECT * FROM bronze")
ORACLE["silver_roundtrip"] = _with("SELECT * FROM silver")
ORACLE["gold_daily_roundtrip"] = ORACLE["gold_daily"]
ORACLE["gold_kpi_roundtrip"] = _with(
    f"SELECT source_system, year, month, day, {_kpi_cols()}, "
    "strftime(make_date(year, month, day), '%Y-%m-%d') AS execution_date, "
    f"'{NOW}' AS computed_at FROM silver GROUP BY source_system, year, month, day")
ORACLE["metrics_log"] = _with(
    "SELECT source_system, count(*) AS record_count, count(DISTINCT id) AS unique_entities, "
    "round(sum(amount), 2) AS total_value, CAST(sum(CASE WHEN is_active = true THEN 1 "
    "ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS active_rate, "
    f"'{EXECUTION_DATE}' AS execution_date, '{RUN_ID}' AS pipeline_run_id "
    "FROM silver GROUP BY source_system")


def _audit_rows(env: str) -> str:
    from strata.contract import GATE_COLUMNS, THRESHOLDS
    t = THRESHOLDS[env]
    stamp = f"'{RUN_ID}' AS pipeline_run_id, '{EXECUTION_DATE}' AS execution_date, "
    parts = ([f"SELECT 'bronze' AS layer, {stamp}* FROM ({p})" for p in null_rate_rows(
        "bronze", GATE_COLUMNS["bronze"], t["bronze"]["max_null_rate"])]
        + [f"SELECT 'silver' AS layer, {stamp}* FROM ({p})" for p in
           null_rate_rows("silver", GATE_COLUMNS["silver"], t["silver"]["max_null_rate"])
           + [row_count_rows("silver", "silver", t["silver"]["min_rows"])]]
        + [f"SELECT 'gold' AS layer, {stamp}* FROM "
           f"({row_count_rows('daily', 'gold_daily', t['gold']['min_rows'])})"])
    return union(parts)


ORACLE["audit_log"] = _with(_audit_rows("dev"))
ORACLE["audit_failures"] = _with(
    f"SELECT layer, check_name, passed, observed, expected FROM ({_audit_rows('prod')}) a "
    "WHERE NOT passed")
ORACLE["audit_counts"] = _with(
    f"SELECT layer, execution_date, count(*) AS checks, "
    f"count(CASE WHEN passed THEN 1 END) AS passed_checks FROM ({_audit_rows('prod')}) a "
    "GROUP BY layer, execution_date")

ORACLE["bronze_pipeline"] = _with(
    f"SELECT source_system, '{RUN_ID}' AS pipeline_run_id, {int(D[0])} AS year, "
    f"{int(D[1])} AS month, {int(D[2])} AS day, count(*) AS \"rows\", count(id) AS ids, "
    f"count(DISTINCT k) AS keys FROM bronze WHERE {DATE_PRED} GROUP BY source_system")
ORACLE["silver_pipeline"] = _with(
    "SELECT s.* EXCLUDE (pipeline_run_id, ingested_at), d.source_label FROM bsilver s "
    f"LEFT JOIN dim d ON s.source_system = d.source_system WHERE {DATE_PRED}")
ORACLE["gold_pipeline"] = _with(
    f"SELECT source_system, year, month, day, {_daily_cols()} FROM silver WHERE {DATE_PRED} "
    "GROUP BY source_system, year, month, day")
ORACLE["medallion_e2e"] = _with(
    f"SELECT source_system, year, month, day, {_daily_cols()} FROM bsilver "
    "GROUP BY source_system, year, month, day")
ORACLE["backfill_range"] = _with(
    f"SELECT source_system, year, month, day, {_kpi_cols()}, "
    "strftime(make_date(year, month, day), '%Y-%m-%d') AS execution_date, "
    f"'{NOW}' AS computed_at FROM bsilver GROUP BY source_system, year, month, day")
ORACLE["idempotent_rerun"] = _with(
    'SELECT year, month, day, count(*) AS "rows", count(DISTINCT id) AS ids FROM silver '
    "WHERE NOT (year = 2024 AND month = 1 AND day = 20) GROUP BY year, month, day")


def _quality_stage() -> str:
    pre = f"'{EXECUTION_DATE}' AS execution_date, "
    silver_slice = f"(SELECT * FROM silver WHERE {DATE_PRED}) s"
    daily_slice = f"(SELECT * FROM daily WHERE {DATE_PRED}) d"
    kpi_slice = (f"(SELECT source_system, year, month, day, '{EXECUTION_DATE}' AS execution_date "
                 f"FROM silver WHERE {DATE_PRED} GROUP BY source_system, year, month, day) k")
    parts = ([f"SELECT 'silver' AS layer, {pre}* FROM ({p})" for p in
              suite_rows("silver", silver_slice)
              + profile_rows("silver", silver_slice, "", prefix="")]
             + [f"SELECT 'gold' AS layer, {pre}* FROM ({p})" for p in
                suite_rows("gold", daily_slice) + profile_rows("gold", kpi_slice, "", prefix="")])
    return union(parts)


ORACLE["quality_stage"] = _with(_quality_stage())
ORACLE["stream_bronze"] = ORACLE["multi_source_bronze"]


def _suite_summary() -> str:
    parts = []
    for layer, src in (("bronze", "bronze"), ("silver", "silver"), ("gold", "daily")):
        rows = union(suite_rows(layer, src))
        parts.append(f"SELECT '{layer}' AS layer, coalesce(bool_and(passed), true) AS success, "
                     f"count(*) AS evaluated, count(CASE WHEN NOT passed THEN 1 END) AS failed "
                     f"FROM ({rows}) r")
    return union(parts)


ORACLE["exp_suite_summary"] = _with(_suite_summary())


def _ndjson_rows() -> str:
    stamp = f"'{RUN_ID}' AS pipeline_run_id, '{EXECUTION_DATE}' AS execution_date, "
    parts = ([f"SELECT 'bronze' AS layer, {stamp}* FROM ({p})" for p in null_rate_rows(
        "bronze", ["pipeline_run_id", "ingested_at", "source_system"], 0.0)]
        + [f"SELECT 'silver' AS layer, {stamp}* FROM ({p})" for p in
           null_rate_rows("silver", ["id", "event_date", "source_system"], 0.05)
           + [row_count_rows("silver", "silver", 1)]])
    return union(parts)


ORACLE["audit_ndjson"] = _with(_ndjson_rows())


def _presence() -> str:
    from strata.contract import SOURCE_REGISTRY
    parts = []
    files = {"crm": "1", "events_api": "CAST(ceil(count(*) / 50.0) AS BIGINT)", "ops_db": "1"}
    for src in SOURCE_REGISTRY:
        label = src["source_system_label"]
        cond = ("source_system IS NULL OR source_system NOT IN ('crm', 'events_api')"
                if label == "ops_db" else f"source_system = '{label}'")
        parts.append(f"SELECT '{src['id']}' AS source_id, count(*) > 0 AS present, {files[label]} AS files, "
                     f"count(*) > 0 AS has_bytes FROM raw "
                     f"WHERE {DATE_PRED} AND ({cond})")
    return union(parts)


ORACLE["landing_presence"] = _with(_presence())
ORACLE["landing_pattern"] = _with(
    "SELECT CASE source_system WHEN 'crm' THEN 'sftp_crm' WHEN 'events_api' THEN 'api_events' "
    "ELSE 'db_transactions' END AS source_id, count(*) AS \"rows\", count(id) AS ids, "
    f"count(DISTINCT k) AS keys, 7 AS columns FROM bronze WHERE {DATE_PRED} GROUP BY source_system")
ORACLE["backfill_uneven"] = _with(
    'SELECT year, month, day, count(*) AS "rows", count(DISTINCT id) AS ids, '
    "count(CASE WHEN day > 15 THEN 1 END) AS notes, round(sum(amount), 2) AS total_amount "
    "FROM bsilver WHERE source_system = 'ops_db' GROUP BY year, month, day")
ORACLE["csv_header_range"] = _with(
    'SELECT year, month, day, count(*) AS "rows", CAST(sum(k) AS BIGINT) AS keys, count(id) AS ids, '
    "count(TRY_CAST(id AS BIGINT)) AS numbers, count(CASE WHEN day <= 20 THEN is_active END) AS active_known, "
    "count(CASE WHEN day BETWEEN 11 AND 20 THEN 1 END) AS tiers, "
    "round(sum(TRY_CAST(amount AS DOUBLE)), 2) AS total_amount "
    "FROM raw WHERE source_system = 'crm' GROUP BY year, month, day")
ORACLE["stream_csv_headers"] = ORACLE["csv_header_range"]
ORACLE["parquet_schema_range"] = _with(
    'SELECT year, month, day, count(*) AS "rows", CAST(sum(k) AS BIGINT) AS keys, '
    "count(CASE WHEN k % 2 = 1 THEN id ELSE CAST(TRY_CAST(id AS INT) AS STRING) END) AS ids, "
    "count(CASE WHEN k % 2 = 1 THEN 1 END) AS notes, round(sum(TRY_CAST(amount AS DOUBLE)), 2) AS total_amount "
    "FROM bronze WHERE source_system = 'ops_db' GROUP BY year, month, day")
ORACLE["redelivered_files"] = _with(
    'SELECT year, month, day, count(*) AS "rows", count(DISTINCT k) AS keys '
    "FROM raw WHERE source_system = 'crm' GROUP BY year, month, day")
ORACLE["page_completeness"] = _with("""
SELECT landing_date, check_name, observed = 0 AS passed,
  CASE WHEN observed = 0 THEN '' WHEN check_name = 'api_pages.missing' THEN 'pages missing: ' || spans
       WHEN check_name = 'api_pages.repeated' THEN 'pages landed in several files'
       ELSE 'page ' || last_page || ' is full and the last one landed' END AS message, observed
FROM (
  SELECT d.*, c.check_name,
    CASE c.check_name WHEN 'api_pages.missing' THEN missing WHEN 'api_pages.repeated' THEN repeated
                      WHEN 'api_pages.after_end' THEN 0 ELSE (last_n >= 50)::INT END::DOUBLE AS observed
  FROM (
    SELECT landing_date, last_page, n - (last_page - 1) * 50 AS last_n, (day(landing_date) > 20)::INT AS repeated,
      CASE WHEN lost AND last_page > 3 THEN 2 ELSE 0 END AS missing, '2-3' AS spans
    FROM (
      SELECT make_date(year, month, day) AS landing_date, day > 10 AS lost, count(*) AS total,
        CASE WHEN day > 10 AND ceil(count(*) / 50.0) BETWEEN 2 AND 3 THEN 1 ELSE ceil(count(*) / 50.0) END::INT AS last_page,
        CASE WHEN day > 10 AND ceil(count(*) / 50.0) BETWEEN 2 AND 3 THEN 50 ELSE count(*) END
          + CASE WHEN day > 20 AND (count(*) <= 150 OR ceil(count(*) / 50.0) = 1) THEN least(count(*), 50) ELSE 0 END AS n
      FROM raw WHERE source_system = 'events_api' GROUP BY year, month, day)) d,
    (VALUES ('api_pages.missing'), ('api_pages.repeated'), ('api_pages.after_end'), ('api_pages.unfinished'))
      c(check_name))""")
ORACLE["range_kpis"] = _with(
    f"SELECT source_system, {_kpi_cols()}, '2024-01-25' AS execution_date, '{NOW}' AS computed_at "
    "FROM silver WHERE make_date(year, month, day) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' "
    "GROUP BY source_system")
# One date's rows are halved before the dedup, so it is done again for that date.
ORACLE["backfill_changed"] = _with(f"""
SELECT make_date(year, month, day) AS date, source_system, count(*) AS total_records, count(DISTINCT id) AS distinct_ids,
  round(sum(amount), 2) AS total_amount, (CASE WHEN {DATE_PRED} THEN 2 ELSE 1 END)::INT AS times
FROM (
  SELECT * FROM bsilver WHERE NOT ({DATE_PRED})
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY id, event_date, source_system, year, month, day
      ORDER BY created_at DESC NULLS LAST, amount DESC NULLS LAST, k) AS rn
    FROM btyped WHERE ({DATE_PRED}) AND k % 2 = 1) z
  WHERE rn = 1 AND id IS NOT NULL AND source_system IS NOT NULL AND amount >= 0) s
GROUP BY year, month, day, source_system""")
ORACLE["exp_unique_bucketed"] = _with(union([
    f"SELECT r.*, {_q(name)} AS rows_of FROM ({part}) r" for name, src in (("typed", "typed"), ("deduplicated", "ded"))
    for part in (unique_row(src, ["id", "event_date", "source_system"]), row_count_rows(src, name, 1))]))
ORACLE["jdbc_day_ranges"] = (
    "SELECT CAST(floor(date_diff('microsecond', DATE '2024-01-15'::TIMESTAMP, ts) / (86400000000 / 5)) AS INT) AS part, "
    'count(*) AS "rows", count(DISTINCT event_id) AS events, min(ts) AS first FROM events '
    "WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1")
ORACLE["gate_failures"] = _with(
    "SELECT * FROM (" + union(null_rate_rows("ded", ["id", "event_date", "source_system"], 0.01)
                              + [row_count_rows("ded", "silver", 1000)]) + ") r WHERE NOT passed")
ORACLE["profile_failures"] = _with(f"""
SELECT year, month, day, 'schema_drift.silver' AS check_name, false AS passed, 2.0::DOUBLE AS observed,
  {_q(str(sorted([*(c for c in _typed_cols if c != 'k'), 'legacy'])))} AS expected
FROM silver GROUP BY year, month, day
UNION ALL
SELECT CAST(year(c.d) AS INT), CAST(month(c.d) AS INT), CAST(day(c.d) AS INT),
  'partition_exists.' || strftime(c.d, '%Y-%m-%d'), false, 0.0::DOUBLE,
  'year=' || year(c.d) || '/month=' || month(c.d) || '/day=' || day(c.d)
FROM (SELECT CAST(unnest(generate_series(min(ts)::DATE - INTERVAL 2 DAY, max(ts)::DATE + INTERVAL 2 DAY,
      INTERVAL 1 DAY)) AS DATE) AS d FROM events) c
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.year = year(c.d) AND s.month = month(c.d) AND s.day = day(c.d))""")
ORACLE["db_extract"] = ORACLE["jdbc_date_slice"]
ORACLE["orders_daily"] = f"""
WITH o AS (
  SELECT o_orderkey AS id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS event_date,
    CAST(o_orderdate AS TIMESTAMP) AS created_at, o_orderstatus = 'O' AS is_active,
    o_orderstatus AS source_system, CAST(year(o_orderdate) AS INT) AS year,
    CAST(month(o_orderdate) AS INT) AS month, CAST(day(o_orderdate) AS INT) AS day
  FROM orders),
d AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY id, event_date, source_system
      ORDER BY created_at DESC NULLS LAST, amount DESC NULLS LAST, is_active NULLS LAST,
               year NULLS LAST, month NULLS LAST, day NULLS LAST) AS rn FROM o) z
  WHERE rn = 1),
s AS (SELECT * FROM d WHERE id IS NOT NULL AND source_system IS NOT NULL AND amount >= 0)
SELECT source_system, year, month, day, {_daily_cols()} FROM s
GROUP BY source_system, year, month, day"""
