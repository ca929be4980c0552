import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import gold

SCHEMA = ("id bigint, amount double, event_date date, source_system string, is_active boolean, "
          "year int, month int, day int")
D = dt.date(2024, 3, 15)
ROWS = [(1, 100.0, D, "sftp", True, 2024, 3, 15), (2, 200.0, D, "sftp", False, 2024, 3, 15),
        (3, 50.0, D, "api", True, 2024, 3, 15), (4, 150.0, D, "api", True, 2024, 3, 15)]


def test_daily_sums(spark):
    out = gold.compute_daily(spark.createDataFrame(ROWS, SCHEMA), "now")
    assert out.count() == 2
    s = out.where("source_system = 'sftp'").collect()[0]
    assert (s.total_records, s.total_amount, s.max_amount) == (2, 300.0, 200.0)
    assert "computed_at" in out.columns


def test_kpis(spark):
    out = gold.compute_kpis(spark.createDataFrame(ROWS, SCHEMA), "2024-03-15", "now")
    rates = {r.source_system: r.active_rate for r in out.collect()}
    assert rates["sftp"] == pytest.approx(0.5) and rates["api"] == pytest.approx(1.0)
    assert out.agg(F.sum("unique_entities")).collect()[0][0] == 4
    assert {r.execution_date for r in out.collect()} == {"2024-03-15"}


def test_null_is_active_counts_inactive(spark):
    df = spark.createDataFrame([(1, 1.0, D, "a", None, 2024, 3, 15),
                                (2, 1.0, D, "a", True, 2024, 3, 15)], SCHEMA)
    assert gold.compute_kpis(df, "d", "n").collect()[0].active_rate == 0.5


def test_kpis_per_date_derive_execution_date(spark):
    out = gold.compute_kpis(spark.createDataFrame(ROWS, SCHEMA), None, "n",
                            keys=("source_system", "year", "month", "day"))
    assert {r.execution_date for r in out.collect()} == {"2024-03-15"}


def test_fused_summaries_equal_separate_aggregates(spark):
    from strata import queries as Q
    s = Q.silver_events(spark, "/root/testdata/sf0.001")
    summ = gold.compute_summaries(s)
    a = sorted(map(tuple, gold.daily_from_summaries(summ, "n").collect()))
    b = sorted(map(tuple, gold.compute_daily(s, "n").select(
        gold.daily_from_summaries(summ, "n").columns).collect()))
    assert a == b
    keys = ("source_system", "year", "month", "day")
    k1 = gold.kpis_from_summaries(summ, None, "n", keep_date=True)
    k2 = gold.compute_kpis(s, None, "n", keys=keys).select(k1.columns)
    assert sorted(map(tuple, k1.collect())) == sorted(map(tuple, k2.collect()))


def test_library_means_equal_sum_over_count(spark):
    """The registered queries present means as sum / count (engine-independent); the library's
    own avg columns must agree with that."""
    from strata import queries as Q
    s = Q.silver_events(spark, "/root/testdata/sf0.01")
    for r in gold.compute_daily(s, "n").collect():
        assert r.avg_amount == pytest.approx(r.total_amount / r.total_records, rel=1e-12)
    for r in gold.compute_kpis(s, "d", "n").collect():
        assert r.avg_value == pytest.approx(r.total_value / r.record_count, rel=1e-12)
