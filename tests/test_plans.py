"""The physical plans we rely on for scale."""

from strata import queries as Q
from strata.operators import quality
from strata.plans.jobs import run_suite

SF = "/root/testdata/sf0.001"


def plan(df):
    import re
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_daily_partial_aggregation_before_each_exchange(spark):
    p = plan(Q.gold_daily(spark, SF))
    assert p.count("Exchange hashpartitioning") == 3  # dedup, (keys,id), keys
    assert "partial_count(distinct id)" in p and "partial_sum(amount)" in p


def test_dedup_limits_map_side(spark):
    p = plan(Q.deduped_events(spark, SF))
    first_exchange = p.index("Exchange hashpartitioning(id")
    assert "WindowGroupLimit" in p[first_exchange:]  # below the exchange = map side


def test_dimension_is_broadcast(spark):
    df = Q.enrich_dim(spark, SF)
    df.collect()  # the planner decides by size, for a table without statistics at run time
    assert "BroadcastHashJoin" in plan(df)


def test_scans_per_query(spark):
    for name, scans in (("dq_env_thresholds", 1), ("dq_schema", 1), ("null_counts", 1), ("exp_suite_silver", 2)):
        assert plan(Q.QUERIES[name](spark, SF)).count("FileScan parquet") == scans, name


def test_suite_inline_checks_are_one_aggregate(spark):
    s = Q.silver_events(spark, SF)
    suite = [e for e in __import__("strata.contract", fromlist=["SUITES"]).SUITES["silver"]
             if e["expectation_type"] != "expect_compound_columns_to_be_unique"]
    p = plan(run_suite(s, "silver", suite))
    assert p.count("HashAggregate(keys=[], functions=[partial_count(1)") == 1


def test_rules_filter_pushed_below_dedup(spark):
    p = plan(Q.silver_events(spark, SF))
    scan = p[p.index("FileScan parquet"):]
    assert "DataFilters" in scan


def test_partition_scan_prunes(spark):
    p = plan(Q.partition_scan(spark, SF))
    assert "PartitionFilters: [isnotnull(year" in p


def test_column_pruning_on_scan(spark):
    p = plan(Q.scan_parquet(spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in p


def test_grouped_checks_single_pass(spark):
    b = Q.bronze_frame(spark, SF)
    res = quality.evaluate(b, quality.null_rate(["id", "source_system"], b.columns, 0.0),
                           by=["year", "month", "day"])
    p = plan(res)
    assert p.count("HashAggregate(keys=[year") == 2  # partial + final, one exchange



def test_gate_of_a_date_scans_nothing(spark, tmp):
    """The checks of a single date come from its write: between staging and publishing no plan
    reads the staged files."""
    from strata.operators import quality
    from strata.plans import jobs
    from strata.sinks import writers
    df = spark.range(100).selectExpr("id", "CAST(NULL AS DATE) AS event_date", "'a' AS source_system", "2024 AS year",
                                     "1 AS month", "2 AS day")
    checks = jobs.silver_checks(df.columns, "dev")
    observed, seen = quality.observe(df, checks)
    with writers.staged_date(observed, tmp, "2024-01-02") as new:
        results = quality.evaluate_observed(new.frame, seen, checks)
        plan = results._jdf.queryExecution().optimizedPlan().toString()
        assert "parquet" not in plan and "Range" not in plan and plan.count("__rows#") and "Join" not in plan
        want = quality.evaluate(new.frame, checks)
        assert "parquet" in want._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, results.collect())) == sorted(map(str, want.collect()))
        new.publish("2024-01-02", "2024-01-02")
    assert spark.read.parquet(tmp).count() == 100


def test_observed_checks_of_an_empty_frame_and_a_suite(spark, tmp):
    from strata.contract import SUITES
    from strata.operators import quality
    from strata.sinks import writers
    for n in (0, 7):
        df = spark.range(n).selectExpr("id", "CAST(id AS DOUBLE) AS amount", "CURRENT_DATE() AS event_date",
                                       "'s' AS source_system", "2024 AS year", "1 AS month", "2 AS day")
        checks = quality.compile_suite(SUITES["silver"], df.columns)
        observed, seen = quality.observe(df, checks)
        with writers.staged_date(observed, tmp, "2024-01-02") as new:
            got = quality.evaluate_observed(new.frame, seen, checks)
            assert sorted(map(str, got.collect())) == sorted(map(str, quality.evaluate(new.frame, checks).collect()))
