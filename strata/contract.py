"""Data contract of the medallion layers: schemas, keys, thresholds, source registry, suites.

Everything in this module is a fixed value that must equal the behaviour we reproduce; it is
stated plainly as data so that the operators stay generic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Column contract of the event layers.
# ---------------------------------------------------------------------------------------------
PARTITION_COLUMNS = ("year", "month", "day")

# Silver casts, applied only to columns that are present.
CONTRACT_CASTS = {
    "id": "bigint",
    "amount": "double",
    "event_date": "date",
    "created_at": "timestamp",
    "is_active": "boolean",
}

# Business key for deduplication; the subset present in the frame is used.
BUSINESS_KEY = ("id", "event_date", "source_system")

# Survivor order inside a duplicate group: newest record, then largest amount.
SURVIVOR_ORDER = (("created_at", "desc"), ("amount", "desc"))

# Business rules: identifiers that must be present, and the non-negative amount column.
REQUIRED_NOT_NULL = ("id", "source_system")
NON_NEGATIVE_COLUMN = "amount"

# ---------------------------------------------------------------------------------------------
# Quality thresholds per environment and layer.
# ---------------------------------------------------------------------------------------------
THRESHOLDS = {
    "dev": {
        "bronze": {"max_null_rate": 0.0, "min_rows": 0},
        "silver": {"max_null_rate": 0.05, "min_rows": 1},
        "gold": {"max_null_rate": 0.0, "min_rows": 1},
    },
    "staging": {
        "bronze": {"max_null_rate": 0.0, "min_rows": 0},
        "silver": {"max_null_rate": 0.02, "min_rows": 100},
        "gold": {"max_null_rate": 0.0, "min_rows": 1},
    },
    "prod": {
        "bronze": {"max_null_rate": 0.0, "min_rows": 0},
        "silver": {"max_null_rate": 0.01, "min_rows": 1000},
        "gold": {"max_null_rate": 0.0, "min_rows": 10},
    },
}

# In-job gate columns per layer.
GATE_COLUMNS = {
    "bronze": ("pipeline_run_id", "ingested_at", "source_system"),
    "silver": ("id", "event_date", "source_system"),
}

# Post-transform custom check profile per layer (row-count floor, null-rate columns, max rate).
LAYER_PROFILES = {
    "bronze": {"min_rows": 0, "columns": ("pipeline_run_id", "source_system"), "max_null_rate": 0.0},
    "silver": {"min_rows": 1, "columns": ("id", "source_system"), "max_null_rate": 0.02},
    "gold": {"min_rows": 1, "columns": ("source_system", "execution_date"), "max_null_rate": 0.0},
}

# ---------------------------------------------------------------------------------------------
# Source registry (what lands where, in which format, under which label).
# ---------------------------------------------------------------------------------------------
SOURCE_REGISTRY = (
    {"id": "sftp_crm", "enabled": True, "format": "csv", "file_pattern": "crm_events_*.csv",
     "landing_subdir": "sftp/crm", "source_system_label": "crm"},
    {"id": "api_events", "enabled": True, "format": "json_pages", "page_size": 500,
     "landing_subdir": "api/events", "source_system_label": "events_api"},
    {"id": "db_transactions", "enabled": True, "format": "parquet",
     "landing_subdir": "db/transactions", "source_system_label": "ops_db"},
)

JDBC_FETCH_SIZE = 10000

# ---------------------------------------------------------------------------------------------
# Expectation suites per layer (type + kwargs).
# ---------------------------------------------------------------------------------------------
SUITES = {
    "bronze": [
        {"expectation_type": "expect_table_row_count_to_be_between",
         "kwargs": {"min_value": 0, "max_value": 50000000}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "pipeline_run_id"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "ingested_at"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "source_system"}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "pipeline_run_id", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "source_system", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_match_regex",
         "kwargs": {"column": "ingested_at", "regex": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}",
                    "mostly": 1.0}},
    ],
    "silver": [
        {"expectation_type": "expect_table_row_count_to_be_between",
         "kwargs": {"min_value": 1, "max_value": 50000000}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "id"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "event_date"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "amount"}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "id", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "source_system", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "amount", "min_value": 0, "mostly": 0.999}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "event_date", "mostly": 0.98}},
        {"expectation_type": "expect_compound_columns_to_be_unique",
         "kwargs": {"column_list": ["id", "event_date", "source_system"]}},
    ],
    "gold": [
        {"expectation_type": "expect_table_row_count_to_be_between",
         "kwargs": {"min_value": 1, "max_value": 1000000}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "source_system"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "total_records"}},
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "total_amount"}},
        {"expectation_type": "expect_column_values_to_not_be_null",
         "kwargs": {"column": "source_system", "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "total_records", "min_value": 1, "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "total_amount", "min_value": 0, "mostly": 1.0}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "avg_amount", "min_value": 0, "mostly": 1.0}},
    ],
}

# ---------------------------------------------------------------------------------------------
# Quality-check names, result texts and message formats. Fields in braces are
# filled per check; values computed in Spark are substituted by the quality compiler.
# ---------------------------------------------------------------------------------------------
CHECK_NAMES = {
    "schema_present": "schema.field_present.{column}",
    "schema_type": "schema.field_type.{column}",
    "schema_ok": "schema.field_ok.{column}",
    "row_count": "row_count.{label}",
    "null_rate": "null_rate.{column}",
    "schema_drift": "schema_drift.{layer}",
    "partition_exists": "partition_exists.{date}",
}

TEXTS = {
    "missing": "missing",
    "column_missing": "column_missing",
    "baseline_written": "baseline written",
    "at_least": ">= {min}",
    "between": "[{min}, {max}]",
    "at_most": "<= {max}",
    "partition_path": "{root}/year={year}/month={month}/day={day}",
}

# Wording of our own; nothing depends on it.
MESSAGES = {
    "schema_present": "no column '{column}'",
    "schema_type": "column '{column}' is {actual}, should be {expected}",
    "schema_ok": "column '{column}' as expected",
    "row_count_ok": "{count} rows, allowed {range}",
    "row_count_bad": "{count} rows, but allowed {range}",
    "null_rate_ok": "'{column}' is NULL in {percent}% of rows",
    "null_rate_bad": "'{column}' is NULL in {percent}% of rows, allowed {threshold}%",
    "column_missing": "no column '{column}' to check",
    "drift_baseline": "first run: columns saved as the baseline",
    "drift_ok": "columns as in the baseline",
    "drift_bad": "columns differ from the baseline: new {added}, gone {removed}",
    "partition_ok": "{path} has rows",
    "partition_bad": "{path} has no rows",
    "gate": "checks that failed: {count}",
}

# ---------------------------------------------------------------------------------------------
# Schemas of the tables we write.
# ---------------------------------------------------------------------------------------------
QUALITY_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("actual", T.StringType()),
    T.StructField("expected", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("observed", T.DoubleType()),
])

AUDIT_SCHEMA = T.StructType(QUALITY_SCHEMA.fields + [
    T.StructField("checked_at", T.StringType()),
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("execution_date", T.StringType()),
    T.StructField("written_at", T.StringType()),
    T.StructField("layer", T.StringType()),
])
