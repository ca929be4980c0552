from strata.plans import cli, jobs
from strata.session import scratch_path

CSV = """id,amount,event_date,created_at,is_active,source_system
1,100.0,2024-03-15,2024-03-15T08:00:00,true,sftp
2,200.0,2024-03-15,2024-03-15T09:00:00,false,sftp
2,200.0,2024-03-15,2024-03-15T09:00:00,false,sftp
3,-1.0,2024-03-15,2024-03-15T10:00:00,true,sftp
"""


def test_cli_transform_and_quality(spark, local_tmp):
    with open(f"{local_tmp}/events_2024-03-15.csv", "w") as f:
        f.write(CSV)
    root = scratch_path(spark, "cli")
    args = ["--execution-date", "2024-03-15", "--root", root]
    assert cli.run(["transform", *args, "--input-path", local_tmp, "--format", "CSV",
                    "--source-system", "sftp"], spark) == 0
    paths = jobs.Paths.under(root)
    daily = spark.read.parquet(paths.daily).collect()
    assert len(daily) == 1 and daily[0].total_records == 2 and daily[0].total_amount == 300.0
    assert spark.read.json(paths.metrics).count() == 1
    # prod needs 1000 silver rows: the gate fails, exit status 1, audit still written
    assert cli.run(["silver", *args, "--env", "prod"], spark) == 1
    assert spark.read.parquet(paths.audit).where("NOT passed").count() >= 1


E2E = """id,amount,event_date,created_at,is_active,source_system
1,100.0,2024-03-15,2024-03-15T08:00:00,true,sftp
2,200.0,2024-03-15,2024-03-15T09:00:00,false,sftp
3,50.0,2024-03-15,2024-03-15T10:00:00,true,api
3,50.0,2024-03-15,2024-03-15T10:00:00,true,api
4,-10.0,2024-03-15,2024-03-15T11:00:00,true,api
"""


def test_cli_per_job_paths_like_the_surveyed_e2e(spark, local_tmp):
    import glob
    import os
    landing = f"{local_tmp}/landing/20240315/sftp"
    os.makedirs(landing)
    with open(f"{landing}/events_2024-03-15.csv", "w") as f:
        f.write(E2E)
    lake = scratch_path(spark, "cli-e2e")
    common = ["--env", "dev", "--execution-date", "2024-03-15", "--audit-path", f"{lake}/audit"]
    assert cli.run(["bronze", *common, "--input-path", landing, "--output-path",
                    f"{lake}/bronze", "--source-system", "sftp", "--format", "csv"], spark) == 0
    part = f"{lake}/bronze/year=2024/month=3/day=15".replace("file:", "")
    assert glob.glob(f"{part}/*.parquet")
    assert cli.run(["silver", *common, "--input-path", f"{lake}/bronze", "--output-path",
                    f"{lake}/silver"], spark) == 0
    silver = spark.read.parquet(f"{lake}/silver")
    assert silver.where("id = 3").count() == 1          # duplicate removed
    assert silver.where("amount < 0").count() == 0      # negative filtered
    assert cli.run(["gold", *common, "--input-path", f"{lake}/silver", "--output-path",
                    f"{lake}/gold", "--metrics-path", f"{lake}/gold/metrics"], spark) == 0
    daily = spark.read.parquet(f"{lake}/gold/daily_summary")
    assert daily.count() > 0 and {"total_records", "total_amount"} <= set(daily.columns)
    assert spark.read.parquet(f"{lake}/gold/kpi_summary").count() > 0
    assert spark.read.json(f"{lake}/gold/metrics").count() > 0


def test_cli_usage_errors(spark):
    import pytest
    with pytest.raises(SystemExit):
        cli.run(["backfill", "--root", "/nonexistent"], spark)
    with pytest.raises(SystemExit):
        cli.run(["silver", "--execution-date", "2024-03-15"], spark)


def test_cli_registry_bronze_transform(spark):
    from strata import fixtures
    from strata.functions.dates import partition_predicate
    root = scratch_path(spark, "cli-registry")
    raw = fixtures.raw_events(spark, "/root/testdata/sf0.001")
    fixtures.land_raw_events(raw, f"{root}/landing", layout="dated",
                             execution_date="2024-01-15")
    assert cli.run(["transform", "--execution-date", "2024-01-15", "--root", root], spark) == 0
    paths = jobs.Paths.under(root)
    bronze = spark.read.parquet(paths.bronze)
    assert bronze.count() == raw.where(partition_predicate("2024-01-15")).count()
    assert {r.source_system for r in bronze.select("source_system").distinct().collect()} == {
        "crm", "events_api", "ops_db"}
    assert spark.read.parquet(paths.daily).count() == 3
