import json
import os

import pytest

from strata.sources import readers
from strata.sources.jdbc import date_slice, slice_query


def test_api_pages_both_shapes(spark, local_tmp):
    with open(f"{local_tmp}/events_page_0001.json", "w") as f:
        json.dump({"items": [{"id": 1}, {"id": 2}]}, f, indent=2)
    with open(f"{local_tmp}/events_page_0002.json", "w") as f:
        json.dump([{"id": 3, "more": "x"}], f, indent=2)
    for page, body in ((3, []), (4, {"items": []}), (5, {"items": None})):
        with open(f"{local_tmp}/events_page_000{page}.json", "w") as f:
            json.dump(body, f)
    recs = readers.read_api_pages(spark, local_tmp)
    assert sorted((r.id, r.more) for r in recs.collect()) == [("1", None), ("2", None), ("3", "x")]
    assert recs._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    counts = {r.page: r.record_count for r in readers.api_page_counts(spark, local_tmp).collect()}
    assert {p: counts[p] for p in (1, 2, 3, 4)} == {1: 2, 2: 1, 3: 0, 4: 0}


def test_landing_presence_missing_is_zero(spark, local_tmp):
    os.makedirs(f"{local_tmp}/20240315/sftp/crm")
    with open(f"{local_tmp}/20240315/sftp/crm/crm_events_2024-03-15.csv", "w") as f:
        f.write("id\n1\n")
    p = {r.source_id: (r.files, r.present)
         for r in readers.landing_presence(spark, local_tmp, "2024-03-15").collect()}
    assert p["sftp_crm"] == (1, True) and p["api_events"] == (0, False)


def test_select_files_by_pattern(spark, local_tmp):
    for name, v in (("crm_events_2024-03-15.csv", 1), ("crm_events_2024-03-16.csv", 2)):
        with open(f"{local_tmp}/{name}", "w") as f:
            f.write(f"id\n{v}\n")
    df = readers.select_files(spark, local_tmp, "csv", "crm_events_*2024-03-15*")
    assert [r.id for r in df.collect()] == [1]


def test_union_sources_widens(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, 3.5)], "k bigint, v double")
    c = spark.createDataFrame([(3,)], "k bigint")
    u = readers.union_sources([a, b, c])
    assert dict(u.dtypes) == {"k": "bigint", "v": "string"}
    assert u.count() == 3


def test_partition_scan_prunes(spark, tmp):
    from strata.sinks.writers import publish_range
    df = spark.createDataFrame([(1, 2024, 3, 15), (2, 2024, 3, 16)],
                               "id int, year int, month int, day int")
    publish_range(df, tmp, "2024-03-15", "2024-03-16")
    s = readers.read_partition(spark, tmp, "2024-03-15")
    assert [r.id for r in s.collect()] == [1]
    assert "PartitionFilters: [isnotnull(year" in s._jdf.queryExecution().executedPlan().toString() \
        or "PartitionFilters" in s._jdf.queryExecution().executedPlan().toString()


def test_date_slice_pushdown(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    s = date_slice(o, "o_orderdate", "1995-03-15")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "1995-03-16" in slice_query("t", "created_at", "1995-03-15")


def test_registry_schema_skips_inference(spark, local_tmp):
    with open(f"{local_tmp}/a.csv", "w") as f:
        f.write("id,amount\n1,2.5\n")
    src = {"format": "csv", "schema": "id string, amount string", "multi_line": False}
    df = readers.read_source(spark, local_tmp, src)
    assert dict(df.dtypes) == {"id": "string", "amount": "string"}


def test_read_partition_lists_only_the_leaf(spark, tmp):
    from strata.sinks.writers import publish_range
    df = spark.createDataFrame([(1, 2024, 3, 15), (2, 2024, 3, 16)],
                               "id int, year int, month int, day int")
    publish_range(df, tmp, "2024-03-15", "2024-03-16")
    s = readers.read_partition(spark, tmp, "2024-03-16")
    assert [(r.id, r.day) for r in s.collect()] == [(2, 16)]
    assert all("day=16" in f for f in s.inputFiles())
    assert readers.read_partition(spark, tmp, "2024-03-17").count() == 0


def test_read_range_lists_only_the_range(spark, tmp):
    from strata.sinks.writers import publish_range
    df = spark.createDataFrame([(1, 2024, 1, 31), (2, 2024, 2, 1), (3, 2024, 2, 9)],
                               "id int, year int, month int, day int")
    publish_range(df, tmp, "2024-01-31", "2024-02-09")
    r = readers.read_range(spark, tmp, "2024-01-31", "2024-02-01")
    assert sorted(x.id for x in r.collect()) == [1, 2]
    assert not any("day=9" in f for f in r.inputFiles())
    assert sorted(x.id for x in readers.read_range(spark, tmp, "2024-01-30", "2024-02-09")
                  .collect()) == [1, 2, 3]


def test_api_pages_with_record_schema(spark, local_tmp):
    with open(f"{local_tmp}/events_page_0001.json", "w") as f:
        json.dump({"items": [{"id": "1"}, {"id": "2"}]}, f)
    with open(f"{local_tmp}/events_page_0002.json", "w") as f:
        json.dump([{"id": "3"}], f)
    src = {"format": "json_pages", "schema": "id string"}
    recs = readers.read_source(spark, local_tmp, src)
    assert sorted(r.id for r in recs.collect()) == ["1", "2", "3"]


def test_union_sources_mixed_numbers_become_text(spark):
    a = spark.createDataFrame([(1.5,)], "v double")
    for other in ("CAST(2.25 AS DECIMAL(10,2))", "9007199254740993L"):
        out = readers.union_sources([a, spark.sql(f"SELECT {other} AS v")])
        assert dict(out.dtypes) == {"v": "string"}
    assert sorted(r.v for r in out.collect()) == ["1.5", "9007199254740993"]
    floats = readers.union_sources([a, spark.createDataFrame([(2.5,)], "v float")])
    assert dict(floats.dtypes) == {"v": "double"}


CRM = {"id": "sftp_crm", "format": "csv", "file_pattern": "crm_events_*.csv", "landing_subdir": "sftp/crm",
       "source_system_label": "crm"}


def land_csv(root, date, name, text):
    folder = f"{root}/sftp/crm/landing_date={date}"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_file_pattern_leaves_strays_out(spark, local_tmp):
    land_csv(local_tmp, "20240101", "crm_events_1.csv", "id,amount\n1,2\n")
    land_csv(local_tmp, "20240101", "README_other.csv", "title\nhello\n")
    df = readers.read_source_range(spark, local_tmp, CRM, "2024-01-01", "2024-01-01")
    assert df.columns == ["id", "amount", "landing_date"] and df.count() == 1


def test_range_read_is_text_and_opens_only_its_dates(spark, local_tmp):
    land_csv(local_tmp, "20240101", "crm_events_1.csv", "id\n9007199254740993\n")
    land_csv(local_tmp, "20240601", "crm_events_2.csv", "id\nabc\n")
    df = readers.read_source_range(spark, local_tmp, CRM, "2024-01-01", "2024-01-31")
    assert dict(df.dtypes)["id"] == "string" and [r.id for r in df.collect()] == ["9007199254740993"]
    assert all("landing_date=20240101" in f for f in df.inputFiles())
    assert readers.read_source_range(spark, local_tmp, CRM, "2023-01-01", "2023-01-31") is None


def test_undated_landing_is_an_error(spark, local_tmp):
    land_csv(local_tmp, "20240101", "crm_events_1.csv", "id\n1\n")
    with open(f"{local_tmp}/sftp/crm/crm_events_0.csv", "w") as f:
        f.write("id\n2\n")
    with pytest.raises(ValueError, match="1 landed paths of sftp_crm have no date"):
        readers.read_source_range(spark, local_tmp, CRM, "2024-01-01", "2024-01-02")


def test_range_keeps_source_column(spark, local_tmp):
    from strata.plans.jobs import land_range_to_bronze_frame
    land_csv(local_tmp, "20240101", "crm_events_1.csv", "id,source_system\n1,partner\n2,\n")
    for keep, want in ((True, ["crm", "partner"]), (False, ["crm", "crm"])):
        b = land_range_to_bronze_frame(spark, local_tmp, "2024-01-01", "2024-01-02", "r", "now", [CRM], keep)
        assert sorted(r.source_system for r in b.collect()) == want


def test_read_range_sees_columns_that_come_later(spark, tmp):
    from strata.sinks.writers import publish_partition
    publish_partition(spark.createDataFrame([("1",)], "id string"), tmp, "2024-01-01")
    publish_partition(spark.createDataFrame([("2", "x")], "id string, extra string"), tmp, "2024-01-02")
    out = readers.read_range(spark, tmp, "2023-12-30", "2024-01-05")
    assert sorted((r.id, r.extra) for r in out.collect()) == [("1", None), ("2", "x")]


def test_jdbc_options_are_checked(spark):
    from strata.sources.jdbc import read_jdbc_date_slice, slice_query
    with pytest.raises(ValueError):
        slice_query("t; DROP TABLE t", "d", "2024-01-01")
    with pytest.raises(ValueError):
        read_jdbc_date_slice(spark, "jdbc:x", "t", "d", "2024-01-01", partition_column="id")
