import os

import pytest

from strata import fixtures
from strata.plans import jobs
from strata.session import scratch_path

E2E_CSV = """id,amount,event_date,created_at,is_active,source_system
1,100.0,2024-03-15,2024-03-15T08:00:00,true,sftp
2,200.0,2024-03-15,2024-03-15T09:00:00,false,sftp
3,50.0,2024-03-15,2024-03-15T10:00:00,true,api
3,50.0,2024-03-15,2024-03-15T10:00:00,true,api
4,-10.0,2024-03-15,2024-03-15T11:00:00,true,api
"""


def test_e2e_small_csv(spark):
    paths = jobs.Paths.under(scratch_path(spark, "e2e"))
    landed = paths.landing.replace("file:", "") + "/20240315/sftp/crm"
    os.makedirs(landed, exist_ok=True)
    with open(f"{landed}/crm_events_2024-03-15.csv", "w") as f:
        f.write(E2E_CSV)
    reg = [{"id": "sftp", "enabled": True, "format": "csv", "landing_subdir": "sftp/crm",
            "source_system_label": "sftp"}]
    b = jobs.bronze_job(spark, paths, "2024-03-15", "run", "2024-03-15T05:00:00Z", registry=reg)
    assert b.count() == 5
    s = jobs.silver_job(spark, paths, "2024-03-15", "run", "2024-03-15T05:00:00Z")
    assert s.count() == 3 and s.where("amount < 0").count() == 0
    daily, kpis = jobs.gold_job(spark, paths, "2024-03-15", "run", "2024-03-15T05:00:00Z")
    d = daily.collect()
    assert len(d) == 1 and d[0].total_records == 3 and d[0].total_amount == 350.0
    assert d[0].distinct_ids == 3 and d[0].max_amount == 200.0 and d[0].min_amount == 50.0
    assert kpis.collect()[0].active_rate == pytest.approx(2 / 3)
    audit = spark.read.parquet(paths.audit)
    assert {r.layer for r in audit.collect()} == {"bronze", "silver", "gold"}


def test_gate_blocks_publish(spark):
    from strata.operators.quality import DataQualityError
    from strata.sinks import writers
    paths = jobs.Paths.under(scratch_path(spark, "gate"))
    bad = spark.createDataFrame([("1", "5.0", None, "x", 2024, 3, 15)] * 3,
                                "id string, amount string, event_date string, "
                                "source_system string, year int, month int, day int")
    writers.publish_range(bad, paths.bronze, "2024-03-15", "2024-03-15")
    with pytest.raises(DataQualityError):
        jobs.silver_job(spark, paths, "2024-03-15", "run", "now")
    failed = spark.read.parquet(paths.audit).where("NOT passed").count()
    assert failed == 1
    assert not os.path.exists(paths.silver.replace("file:", ""))


def test_fixture_counts(spark):
    from strata import queries
    sf = "/root/testdata/sf0.001"
    assert fixtures.raw_events(spark, sf).count() == 1059
    assert queries.deduped_events(spark, sf).count() == 993
    assert queries.silver_events(spark, sf).count() == 875
    k = {r.source_system: r for r in queries.gold_kpis(spark, sf).collect()}
    assert (k["crm"].record_count, k["crm"].total_value) == (347, 17826.43)
    # FIXTURES.md publishes these to 6 decimals
    assert k["events_api"].active_rate == pytest.approx(0.428571, abs=1e-6)
    assert k["ops_db"].avg_value == pytest.approx(47.217602, abs=1e-6)


def test_backfill_equals_per_date(spark):
    """One backfill job over all dates equals separate per-date Silver + Gold runs."""
    from strata import queries
    from strata.sinks import writers
    sf = "/root/testdata/sf0.001"
    paths = jobs.Paths.under(scratch_path(spark, "perdate"))
    writers.publish_range(queries.bronze_frame(spark, sf), paths.bronze, *queries.span(spark, sf))
    bf_paths = jobs.Paths.under(scratch_path(spark, "bf"))
    writers.publish_range(queries.bronze_frame(spark, sf), bf_paths.bronze, *queries.span(spark, sf))
    _, bf_daily, _ = jobs.backfill(spark, bf_paths, *queries.span(spark, sf), "r", "n",
                                   enforce=False)
    bf = {(r.source_system, r.day): (r.total_records, r.distinct_ids, round(r.total_amount, 6))
          for r in bf_daily.collect()}
    for date in ("2024-01-15", "2024-01-16"):
        jobs.silver_job(spark, paths, date, "r", "n")
        daily, _ = jobs.gold_job(spark, paths, date, "r", "n", emit_metrics=False)
        for r in daily.collect():
            assert bf[(r.source_system, r.day)] == (r.total_records, r.distinct_ids,
                                                    round(r.total_amount, 6))


def test_backfill_empty_date_fails_row_count(spark):
    from strata.operators.quality import DataQualityError
    from strata.sinks import writers
    paths = jobs.Paths.under(scratch_path(spark, "bf-empty"))
    rows = spark.createDataFrame([("1", "5.0", "2024-03-15", "a", 2024, 3, 15)],
                                 "id string, amount string, event_date string, "
                                 "source_system string, year int, month int, day int")
    writers.publish_range(rows, paths.bronze, "2024-03-15", "2024-03-15")
    with pytest.raises(DataQualityError, match=r"row_count.silver"):
        jobs.backfill(spark, paths, "2024-03-15", "2024-03-16", "r", "n")
    audit = spark.read.parquet(paths.audit).where("NOT passed").collect()
    assert [(r.execution_date, r.check_name) for r in audit] == [("2024-03-16", "row_count.silver")]


def test_bronze_publishes_then_audits(spark, local_tmp):
    with open(f"{local_tmp}/x.csv", "w") as f:
        f.write("id,source_system\n1,\n2,crm\n")
    paths = jobs.Paths.under(scratch_path(spark, "bronze-gate"))
    b = jobs.bronze_path_job(spark, local_tmp, "csv", paths, "2024-03-15", "r", "n",
                             source_system="sftp", keep_source_column=True)
    assert sorted(r.source_system for r in b.collect()) == ["crm", "sftp"]
    audit = spark.read.parquet(paths.audit).collect()
    assert sorted(r.check_name for r in audit) == [
        "null_rate.ingested_at", "null_rate.pipeline_run_id", "null_rate.source_system"]
    assert all(r.passed for r in audit)


def test_medallion_run_single_date_matches_backfill(spark):
    """Land one date in the documented daily layout, run Bronze → Silver → Gold for it, and
    compare with a one-pass backfill of the same landed rows."""
    from strata import queries as Q
    sf = "/root/testdata/sf0.001"
    raw = fixtures.raw_events(spark, sf)
    paths = jobs.Paths.under(scratch_path(spark, "medallion"))
    fixtures.land_raw_events(raw, paths.landing, layout="dated", execution_date="2024-01-15")
    daily, kpis = jobs.medallion_run(spark, paths, "2024-01-15", "r", "n")
    got = {(r.source_system, r.total_records, r.distinct_ids) for r in daily.collect()}
    bf = jobs.Paths.under(scratch_path(spark, "medallion-bf"))
    from strata.sinks import writers
    writers.publish_range(Q.bronze_frame(spark, sf), bf.bronze, "2024-01-15", "2024-01-15")
    _, bf_daily, _ = jobs.backfill(spark, bf, "2024-01-15", "2024-01-15", "r", "n")
    want = {(r.source_system, r.total_records, r.distinct_ids) for r in bf_daily.collect()}
    assert got == want and len(got) == 3
    assert kpis.count() == 3
