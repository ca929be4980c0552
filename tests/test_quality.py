import pytest
from pyspark.sql import types as T

from strata.contract import SUITES
from strata.operators import quality


def _rows(df):
    return {r.check_name: r for r in df.collect()}


def test_null_rate_empty_frame_no_rows(spark):
    df = spark.createDataFrame([], "id bigint")
    assert quality.evaluate(df, quality.null_rate(["id"], df.columns, 0.05)).count() == 0


def test_null_rate_missing_column(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    r = _rows(quality.evaluate(df, quality.null_rate(["id", "tier"], df.columns, 0.05)))
    assert r["null_rate.tier"].passed is False and r["null_rate.tier"].actual == "column_missing"
    assert r["null_rate.id"].passed is True and r["null_rate.id"].actual == "0.0000"
    with pytest.raises(ValueError):
        quality.null_rate(["tier"], df.columns, 0.05, on_missing="error")


def test_null_rate_values_and_message(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "id bigint")
    r = _rows(quality.evaluate(df, quality.null_rate(["id"], df.columns, 0.05)))["null_rate.id"]
    assert r.passed is False and r.actual == "0.2500" and r.expected == "<= 0.05"
    assert r.message == "'id' is NULL in 25.00% of rows, allowed 5.00%"


def test_row_count(spark):
    df = spark.range(5)
    r = _rows(quality.evaluate(df, [quality.row_count(1, label="a"),
                                    quality.row_count(1, 3, label="b")]))
    assert r["row_count.a"].passed and r["row_count.a"].expected == ">= 1"
    assert not r["row_count.b"].passed and r["row_count.b"].expected == "[1, 3]"
    assert r["row_count.b"].message == "5 rows, but allowed [1, 3]"


def test_all_checks_in_one_aggregation(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, s string")
    checks = (quality.null_rate(["id", "s"], df.columns, 0.5) + [quality.row_count(1)]
              + quality.compile_suite(SUITES["silver"][:8], df.columns))
    plan = quality.evaluate(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 1


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "x")], "ID int, name string")
    exp = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                        T.StructField("gone", T.DateType())])
    r = _rows(quality.evaluate(df, quality.schema_checks(df.schema, exp)))
    assert r["schema.field_type.id"].actual == "integer"
    assert r["schema.field_ok.name"].passed
    assert r["schema.field_present.gone"].actual == "missing"


def test_gate_raises_with_failures(spark):
    df = spark.createDataFrame([(None,)], "id bigint")
    res = quality.evaluate(df, quality.null_rate(["id"], df.columns, 0.0) + [quality.row_count(0)])
    with pytest.raises(quality.DataQualityError, match="checks that failed: 1"):
        quality.gate(res)
    ok = quality.evaluate(df, [quality.row_count(0)])
    quality.gate(ok)


def test_expectations(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00"), (None, "bad"), (5, None)],
                               "v bigint, ts string")
    checks = [quality.expect_not_null("v", df.columns, 0.6),
              quality.expect_regex("ts", df.columns, r"^\d{4}-\d{2}-\d{2}T", 0.5),
              quality.expect_between("v", df.columns, 0, 3, 0.5),
              quality.expect_between("v", df.columns, 0, 3, 0.6),
              quality.column_exists(df.columns, "zz")]
    r = quality.evaluate(df, checks).collect()
    got = [(x.check_name, x.passed, x.observed) for x in r]
    assert ("expect_column_values_to_not_be_null.v", True, pytest.approx(2 / 3)) in got
    assert ("expect_column_values_to_match_regex.ts", True, 0.5) in got
    assert [x.passed for x in r if x.check_name.endswith("between.v")] == [True, False]
    assert ("expect_column_to_exist.zz", False, None) in got


def test_empty_denominator_passes(spark):
    df = spark.createDataFrame([(None,)], "v bigint")
    r = quality.evaluate(df, [quality.expect_between("v", df.columns, 0, 1)]).collect()[0]
    assert r.passed and r.observed is None


def test_compound_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, None), (None, None)],
                               "a bigint, b string")
    r = quality.evaluate(df, [quality.expect_compound_unique(["a", "b"], df.columns)]).collect()[0]
    assert not r.passed and r.observed == 2.0


def test_unknown_expectation(spark):
    with pytest.raises(ValueError):
        quality.compile_suite([{"expectation_type": "expect_magic", "kwargs": {}}], [])


def test_grouped_evaluation(spark):
    df = spark.createDataFrame([(2024, 1, 1, None), (2024, 1, 2, 1)],
                               "year int, month int, day int, id bigint")
    res = quality.evaluate(df, quality.null_rate(["id"], df.columns, 0.0)
                           + [quality.partition_exists(None, "/t")], by=["year", "month", "day"])
    r = {(x.day, x.check_name): x for x in res.collect()}
    assert not r[(1, "null_rate.id")].passed and r[(2, "null_rate.id")].passed
    assert r[(2, "partition_exists.2024-01-02")].expected == "year=2024/month=1/day=2"


def test_schema_drift():
    first = quality.schema_drift(["a", "b"], None, "silver")
    assert first.name == "schema_drift.silver"
    c = quality.schema_drift(["a", "c"], ["a", "b"], "silver")
    assert c.row is not None


def test_summary(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    res = quality.evaluate(df, [quality.row_count(1), quality.row_count(5, label="x")])
    s = quality.summarize(res).collect()[0]
    assert (s.success, s.evaluated, s.failed) == (False, 2, 1)


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(None, 1), (2, 1)], "`a.b` bigint, `c d` int")
    checks = (quality.null_rate(["a.b", "c d"], df.columns, 0.6)
              + [quality.expect_between("a.b", df.columns, 0, 5),
                 quality.expect_compound_unique(["a.b", "c d"], df.columns)])
    r = {x.check_name: x for x in quality.evaluate(df, checks).collect()}
    assert r["null_rate.a.b"].observed == 0.5 and r["null_rate.c d"].observed == 0.0
    assert r["expect_column_values_to_be_between.a.b"].passed
    assert r["expect_compound_columns_to_be_unique.a.b,c d"].passed
