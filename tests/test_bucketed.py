"""Bucketed tables spare the shuffle; a day's extract is split into time ranges."""

import datetime as dt

import pytest

from strata.operators import quality, silver
from strata.sinks import bucketed
from strata.sources.jdbc import day_ranges, read_jdbc_date_slice


def _rows(spark):
    return spark.range(300).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE id % 90 END AS id", "date_add(DATE'2024-01-01', CAST(id % 2 AS INT)) AS event_date",
        "IF(id % 3 = 0, 'a b', 'c') AS source_system", "CAST(id AS DOUBLE) AS amount",
        "TIMESTAMP'2024-01-01 00:00:00' AS created_at")


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_unique_and_dedup_do_not_shuffle_rows(spark, tmp):
    df = _rows(spark)
    t = bucketed.append(df, tmp, buckets=4)
    check = quality.expect_compound_unique(["id", "event_date", "source_system"], t.columns)
    result = quality.evaluate(t, [check])
    assert "hashpartitioning" not in _plan(result)
    assert "hashpartitioning" in _plan(quality.evaluate(df, [check]))
    assert sorted(map(str, result.collect())) == sorted(map(str, quality.evaluate(df, [check]).collect()))
    once = silver.deduplicate(t)
    assert "Exchange" not in _plan(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, silver.deduplicate(df).collect()))


def test_append_keeps_buckets_and_columns_by_name(spark, tmp):
    df = _rows(spark)
    bucketed.append(df.where("amount < 100"), tmp, buckets=4)
    t = bucketed.append(df.where("amount >= 100").select(*reversed(df.columns)), tmp, buckets=4)
    assert sorted(map(str, t.collect())) == sorted(map(str, df.collect()))
    assert "Exchange" not in _plan(t.groupBy("id", "event_date", "source_system").count())
    empty = bucketed.append(df.limit(0), tmp + "-empty", buckets=2)
    assert empty.count() == 0


@pytest.mark.parametrize("parts", [1, 5, 7, 24])
def test_day_ranges_cover_the_day_once(spark, parts):
    day = dt.datetime(2024, 2, 29)
    steps = [dt.timedelta(0), dt.timedelta(microseconds=1), dt.timedelta(hours=23, minutes=59, seconds=59, microseconds=999999),
             *(dt.timedelta(days=i) / parts for i in range(parts)), *(dt.timedelta(minutes=37 * i) for i in range(39))]
    inside = {day + s for s in steps if s < dt.timedelta(days=1)}
    rows = spark.createDataFrame([(t,) for t in inside | {day - dt.timedelta(microseconds=1), day + dt.timedelta(days=1)}],
                                 "ts timestamp_ntz")
    got = [r.ts for p in day_ranges("ts", "2024-02-29", parts) for r in rows.where(p).collect()]
    assert len(got) == len(set(got)) and set(got) == inside


def test_day_ranges_are_checked(spark):
    for bad in (lambda: day_ranges("ts; --", "2024-01-01", 2), lambda: day_ranges("ts", "2024-01-01", 0),
                lambda: read_jdbc_date_slice(spark, "jdbc:x", "t", "d", "2024-01-01", partition_column="id", parts=2),
                lambda: read_jdbc_date_slice(spark, "jdbc:x", "t t", "d", "2024-01-01", parts=2)):
        with pytest.raises(ValueError):
            bad()
