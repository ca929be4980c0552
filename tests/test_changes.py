"""States that add up, and backfills of changed dates only."""

import glob

from pyspark.sql import functions as F

from strata.operators import gold
from strata.plans import changes, jobs
from strata.plans.jobs import Paths
from strata.sinks import writers

ROW = ("id bigint, amount double, event_date date, created_at timestamp, is_active boolean, source_system string, "
       "pipeline_run_id string, ingested_at string, year int, month int, day int")
DAYS = ("2024-03-01", "2024-03-04")


def _rows(spark, stamp="r1"):
    return spark.range(40).selectExpr(
        "id - 10 AS id", "CAST(id AS DOUBLE) AS amount", "DATE'2024-03-01' AS event_date",
        "TIMESTAMP'2024-03-01 10:00:00' AS created_at", "id % 3 = 0 AS is_active", "IF(id % 2 = 0, 'a', 'b') AS source_system",
        f"'{stamp}' AS pipeline_run_id", f"'{stamp}' AS ingested_at", "2024 AS year", "3 AS month",
        "CAST(1 + id % 4 AS INT) AS day")


def test_states_equal_distinct_counts(spark):
    df = spark.range(5000).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL ELSE (id % 700) * 40009 - 9000000 END AS id", "id % 5 AS day", "2024 AS year",
        "1 AS month", "IF(id % 3 = 0, 'a', IF(id % 3 = 1, 'b', NULL)) AS source_system", "IF(id % 7 = 0, NULL, id / 4) AS amount",
        "id % 2 = 0 AS is_active")
    edge = spark.createDataFrame([(9223372036854775807,), (-9223372036854775807,), (0,), (1,), (32768,), (32769,), (-1,), (1,)],
                                 "id bigint").withColumn("g", F.lit(1))
    assert gold.count_ids(gold.id_state(edge, ["g"]), ["g"]).first().unique_entities == 7
    want = gold.compute_kpis(df, "2024-01-05", "now").drop("avg_value", "total_value", "active_rate")
    got = gold.kpis_from_states(gold.kpi_state(df), gold.id_state(df), "2024-01-05", "now")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    near = {r.source_system: r for r in gold.compute_kpis(df, "2024-01-05", "now").collect()}
    for r in got.collect():
        assert abs(r.avg_value - near[r.source_system].avg_value) < 1e-9
        assert r.active_rate == near[r.source_system].active_rate
    merged = gold.merge_ids(gold.id_state(df), ["source_system"])
    assert gold.count_ids(merged, []).first()[0] == df.agg(F.count_distinct("id")).first()[0]


def test_only_changed_dates_are_done_again(spark, local_tmp):
    paths = Paths.under(local_tmp)
    writers.publish_range(_rows(spark), paths.bronze, *DAYS)

    def run(name, now, env="dev"):
        return changes.backfill_changed(spark, paths, *DAYS, name, now, env, enforce=False)

    def files():
        return {day: frozenset(glob.glob(f"{local_tmp}/*/**/year=2024/month=3/day={day}/*.parquet", recursive=True))
                for day in range(1, 5)}

    silver_files = lambda: {d: {f for f in v if "/bronze/" not in f} for d, v in files().items()}
    assert run("r1", "t1") == [f"2024-03-0{d}" for d in range(1, 5)]
    first = silver_files()
    # The same rows with other stamps are no change.
    writers.publish_range(_rows(spark, "r2"), paths.bronze, *DAYS)
    assert run("r2", "t2") == [] and silver_files() == first
    writers.publish_partition(_rows(spark).where("day = 2 AND id > 0"), paths.bronze, "2024-03-02")
    assert run("r3", "t3") == ["2024-03-02"]
    third = silver_files()
    assert {d for d in third if third[d] != first[d]} == {2}
    assert spark.read.parquet(paths.silver).where("day = 2").count() == \
        _rows(spark).where("day = 2 AND id > 0").count()
    # A date that Bronze lost comes out empty; other thresholds are a change of every date.
    writers.publish_range(_rows(spark).where("day = 9"), paths.bronze, "2024-03-03", "2024-03-03")
    assert run("r4", "t4") == ["2024-03-03"]
    assert spark.read.parquet(paths.silver).where("day = 3").count() == 0
    assert run("r5", "t5") == []
    assert len(run("r6", "t6", "prod")) == 4


def test_fingerprints_tell_rows_apart(spark):
    base = _rows(spark)
    one = {r.day: r.fingerprint for r in changes.fingerprints(base).collect()}
    shuffled = {r.day: r.fingerprint for r in changes.fingerprints(base.repartition(7).select(*reversed(base.columns))).collect()}
    assert one == shuffled
    for other in (base.union(base.where("id = 5")), base.withColumn("amount", F.when(F.col("id") == 5, None).otherwise(F.col("amount"))),
                  base.withColumn("extra", F.lit("x"))):
        assert {r.day: r.fingerprint for r in changes.fingerprints(other).collect()} != one


def test_range_kpis_read_states_alone(spark, local_tmp):
    paths = Paths.under(local_tmp)
    writers.publish_range(_rows(spark), paths.silver, *DAYS)
    jobs.state_backfill(spark, paths, *DAYS)
    got = jobs.range_kpis(spark, paths, "2024-03-02", "2024-03-03", "now")
    want = gold.compute_kpis(_rows(spark).where("day IN (2, 3)"), "2024-03-03", "now")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "/silver" not in got._jdf.queryExecution().optimizedPlan().toString()
