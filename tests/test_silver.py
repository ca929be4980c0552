import datetime as dt
import math

from pyspark.sql import functions as F

from strata.functions.casts import lenient_bigint
from strata.operators import silver

RAW = ("id string, amount string, event_date string, created_at string, is_active string, "
       "source_system string, year int, month int, day int")


def test_cast_types(spark):
    df = spark.createDataFrame(
        [("1", "19.99", "2024-03-15", "2024-03-15T10:00:00", "true", "sftp", 2024, 3, 15)], RAW)
    t = dict(silver.cast_types(df).dtypes)
    assert (t["id"], t["amount"], t["is_active"]) == ("bigint", "double", "boolean")
    assert (t["event_date"], t["created_at"]) == ("date", "timestamp")


def test_cast_types_absent_columns(spark):
    df = spark.createDataFrame([("api", 2024, 3, 1)], "source_system string, year int, month int, day int")
    assert silver.cast_types(df).columns == df.columns


def test_legacy_bigint_cast(spark):
    vals = ['1', '1.5', '.5', '1.', '-1.9', '+7', ' 7 ', '1e3', 'abc', '', '9223372036854775808',
            None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(lenient_bigint(F.col("s"))).collect()]
    assert got == [1, 1, 0, 1, -1, 7, 7, None, None, None, None, None]


def test_boolean_cast(spark):
    vals = ['TRUE', 't', 'yes', 'y', '1', 'no', '0', '2', '']
    df = spark.createDataFrame([(v,) for v in vals], "is_active string")
    got = [r[0] for r in silver.cast_types(df).collect()]
    assert got == [True, True, True, True, True, False, False, None, None]


def test_date_cast(spark):
    vals = ['2024-03-15T10:00:00', '2024-3-5', '2024', '2024-13-01']
    df = spark.createDataFrame([(v,) for v in vals], "event_date string")
    got = [r[0] for r in silver.cast_types(df).collect()]
    assert got == [dt.date(2024, 3, 15), dt.date(2024, 3, 5), dt.date(2024, 1, 1), None]


def test_deduplicate_business_key(spark):
    rows = [("10", "5.0", "2024-03-15", None, None, "sftp", 2024, 3, 15),
            ("10", "5.0", "2024-03-15", None, None, "sftp", 2024, 3, 15),
            ("11", "7.0", "2024-03-15", None, None, "sftp", 2024, 3, 15)]
    assert silver.deduplicate(spark.createDataFrame(rows, RAW)).count() == 2


def test_dedup_null_keys_compare_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")],
                               "id bigint, source_system string")
    assert silver.deduplicate(df).count() == 2


def test_dedup_survivor_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01 10:00:00", 5.0), (1, "a", "2024-01-01 11:00:00", 1.0),
         (1, "a", "2024-01-01 11:00:00", 3.0), (1, "a", None, 9.0)],
        "id bigint, source_system string, created_at string, amount double")
    out = silver.deduplicate(silver.cast_types(df)).collect()
    assert len(out) == 1 and out[0].amount == 3.0


def test_dedup_without_key_is_identity(spark):
    df = spark.createDataFrame([(1,), (1,)], "x int")
    assert silver.deduplicate(df).count() == 2


def test_dedup_plans_map_side_limit(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "id bigint, source_system string, amount double")
    plan = silver.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dedup_report(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")],
                               "id bigint, source_system string")
    r = silver.dedup_report(df).collect()[0]
    assert (r.rows_before, r.rows_after, r.rows_removed) == (3, 2, 1)


def test_rules_drop_null_id(spark):
    rows = [("1", "10.0", "2024-01-01", None, None, "api", 2024, 1, 1),
            (None, "5.0", "2024-01-01", None, None, "api", 2024, 1, 1),
            ("3", "2.0", "2024-01-01", None, None, "api", 2024, 1, 1)]
    assert silver.business_rules(spark.createDataFrame(rows, RAW)).count() == 2


def test_rules_drop_negative_keep_zero(spark):
    rows = [("1", "10.0", "2024-01-01", None, None, "api", 2024, 1, 1),
            ("2", "-5.0", "2024-01-01", None, None, "api", 2024, 1, 1),
            ("3", "0.0", "2024-01-01", None, None, "api", 2024, 1, 1)]
    df = silver.cast_types(spark.createDataFrame(rows, RAW))
    assert silver.business_rules(df).count() == 2


def test_amount_rule_three_valued(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-0.0,), (-1.0,)], "amount double")
    kept = [r.amount for r in silver.business_rules(df).collect()]
    assert len(kept) == 2 and math.isnan(kept[0]) and kept[1] == 0.0


def test_dimension_join(spark):
    fact = spark.createDataFrame([(1, "crm"), (2, "ops_db")], "id int, source_system string")
    dim = spark.createDataFrame([("crm", "CRM export")], "source_system string, source_label string")
    out = silver.enrich_with_dimension(fact, dim)
    assert out.columns == ["id", "source_system", "source_label"]
    assert {r.id: r.source_label for r in out.collect()} == {1: "CRM export", 2: None}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_dimension_fan_out(spark):
    fact = spark.createDataFrame([(1, "crm")], "id int, source_system string")
    dim = spark.createDataFrame([("crm", "A"), ("crm", "B")], "source_system string, source_label string")
    assert silver.enrich_with_dimension(fact, dim).count() == 2


def test_enriching_starts_no_job_and_leaves_the_join_to_the_planner(spark):
    fact = spark.createDataFrame([(1, "crm")], "id int, source_system string")
    dim = spark.createDataFrame([("crm", "A"), ("x", "B")], "source_system string, source_label string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("enrich", "no job expected")
    try:
        out = silver.enrich_with_dimension(fact, dim)
        assert not tracker.getJobIdsForGroup("enrich")
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert "hint" not in out._jdf.queryExecution().logical().toString().lower()
    assert out.count() == 1


def test_dotted_column_names_pass_through(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", "z")],
                               "id bigint, source_system string, `customer.name` string")
    out = silver.business_rules(silver.deduplicate(df))
    assert sorted((r.id, r["customer.name"]) for r in out.collect()) == [(1, "x"), (2, "z")]
    assert silver.dedup_report(df).first().rows_after == 2
