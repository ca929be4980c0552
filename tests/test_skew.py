"""A key holding a third of all rows: results stay exact (checked by brute force in DuckDB)."""

import duckdb
from pyspark.sql import functions as F

from strata.operators import gold, quality, silver

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return ev.select(
        F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("event_id")).alias("id"),
        F.col("ts").cast("timestamp").alias("created_at"), F.col("value").alias("amount"),
        F.lit("hot").alias("source_system"), "event_id")


SKEW_SQL = """
SELECT CASE WHEN event_id % 3 = 0 THEN 7 ELSE event_id END AS id, ts AS created_at,
       value AS amount, 'hot' AS source_system, event_id
FROM read_parquet('{sf}/events.parquet')"""


def test_dedup_hot_key_exact(spark):
    got = sorted(tuple(r) for r in silver.deduplicate(_skewed(spark), keys=("id",))
                 .select("id", "event_id").collect())
    con = duckdb.connect()
    want = con.execute(f"""
        SELECT id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY id
          ORDER BY created_at DESC NULLS LAST, amount DESC NULLS LAST, event_id) rn
          FROM ({SKEW_SQL.format(sf=SF)})) WHERE rn = 1 ORDER BY 1, 2""").fetchall()
    assert got == sorted(want)


def test_hot_source_daily_and_uniqueness(spark):
    df = _skewed(spark).withColumns({"year": F.lit(2024), "month": F.lit(1), "day": F.lit(1)})
    d = gold.compute_daily(df, "n").collect()[0]
    con = duckdb.connect()
    n, ids = con.execute(f"SELECT count(*), count(DISTINCT id) FROM ({SKEW_SQL.format(sf=SF)})"
                         ).fetchone()
    assert (d.total_records, d.distinct_ids) == (n, ids)
    r = quality.evaluate(df, [quality.expect_compound_unique(["id"], df.columns)]).collect()[0]
    hot = con.execute(f"SELECT count(*) FROM ({SKEW_SQL.format(sf=SF)}) WHERE id = 7").fetchone()[0]
    assert r.observed == hot and not r.passed
