"""Landed page files: each is listed in bulk, opened once and written by a share of the tasks."""

import glob
import json
import os
import re

import pytest

from strata import fixtures
from strata.sources import readers


def _put_pages(root, pages, records=1):
    for p in range(1, pages + 1):
        folder = f"{root}/landing_date=20240101/page={p}"
        os.makedirs(folder)
        items = [{"id": p * 1000 + i, "amount": 1.5} for i in range(records)]
        with open(f"{folder}/part-0.txt", "w") as f:
            json.dump({"items": items} if p % 2 else items, f, indent=1)


def _most_tasks(spark, group, work):
    """``work()``, and the tasks of the largest stage that it ran."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, max(s.numTasks for s in stages if s)


def _bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_page_folders_are_listed_by_few_tasks(spark, local_tmp):
    _put_pages(local_tmp, 90)
    few = 4 * spark.sparkContext.defaultParallelism
    counts, tasks = _most_tasks(spark, "count-pages", lambda: readers.api_page_counts(spark, local_tmp).collect())
    assert tasks <= few and sorted(r.page for r in counts) == list(range(1, 91))
    records, tasks = _most_tasks(spark, "read-pages", lambda: readers.read_api_pages(
        spark, local_tmp, options={"recursiveFileLookup": "true"}).collect())
    assert tasks <= few and len(records) == 90
    assert spark.conf.get(readers._LISTING_TASKS) == "10000"


def test_counts_open_the_pages_once(spark, local_tmp):
    _put_pages(local_tmp, 3)
    counts = readers.api_page_counts(spark, local_tmp)
    assert "binaryfile" not in counts._jdf.queryExecution().executedPlan().toString().lower()


def test_numbers_of_a_page_are_read_with_the_page(spark, local_tmp):
    _put_pages(local_tmp, 2, records=400)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{local_tmp}/*/*/*"))
    records = readers.read_api_pages(spark, local_tmp, options={"recursiveFileLookup": "true"})
    before = _bytes_read(spark)
    assert records.selectExpr("sum(id)", "sum(amount)").first()[:] == (2 * 79800 + 400 * 3000, 1200.0)
    assert _bytes_read(spark) - before < 5 * size


def test_numbers_keep_their_text(spark, local_tmp):
    with open(f"{local_tmp}/events_page_0001.json", "w") as f:
        f.write('﻿{"items":\n [{"id": 1.50, "n": 1e400, "o": {"a": [1.0 ,2]}},\r\n {"id": 12345678901234567890123, "n": true}]}\n')
    with open(f"{local_tmp}/events_page_0002.json", "w") as f:
        f.write('[{"id": -0.0, "n": "a\\u0000\\u001e\\u0000b"}, {"id": null}]\n\n')
    got = sorted((r.id, r.n) for r in readers.read_api_pages(spark, local_tmp).collect() if r.id)
    assert got == [("-0.0", "a\0\x1e\0b"), ("1.50", "1e400"), ("12345678901234567890123", "true")]


def test_pages_are_written_by_many_tasks(spark, local_tmp):
    rows = spark.range(400).selectExpr(
        "id AS k", "string(id) AS id", "'1.5' AS amount", "'2024-01-01' AS event_date", "'2024-01-01 00:00:00' AS created_at",
        "'true' AS is_active", "'events_api' AS source_system", "2024 AS year", "1 AS month", "int(id % 2) + 1 AS day")
    fixtures.land_raw_events(rows, local_tmp, page_size=5)
    files = glob.glob(f"{local_tmp}/api/events/landing_date=*/page=*/part-*")
    assert len(files) == 80
    assert len({re.search(r"part-(\d+)", f).group(1) for f in files}) > 4


def _events(spark, last, note="1.5"):
    return spark.range(last).selectExpr(
        "id AS k", "string(id) AS id", f"'{note}' AS amount", "'2024-01-01' AS event_date", "'2024-01-01 00:00:00' AS created_at",
        "'true' AS is_active", "'events_api' AS source_system", "2024 AS year", "1 AS month", "int(id % 2) + 1 AS day")


def _bodies(root):
    return {f.removeprefix(f"{root}/").rsplit("/", 1)[0]: open(f).read() for f in glob.glob(f"{root}/**/part-*", recursive=True)}


def test_a_page_is_a_single_file(spark, local_tmp):
    fixtures.land_raw_events(_events(spark, 60), local_tmp, page_size=5)
    folders = glob.glob(f"{local_tmp}/api/events/landing_date=*/page=*")
    assert len(folders) == 12 and all(len(os.listdir(f)) == 1 for f in folders)
    assert sorted(os.listdir(f"{local_tmp}/api/events")) == ["landing_date=20240101", "landing_date=20240102"]


def test_landing_again_replaces_the_pages_it_brings(spark, local_tmp):
    for layout, root in (("hive", "api/events"), ("dated", "20240101/api/events")):
        land = {"layout": layout, "execution_date": "2024-01-01", "page_size": 5}
        fixtures.land_raw_events(_events(spark, 60), local_tmp, **land)
        before = _bodies(f"{local_tmp}/{root}")
        fixtures.land_raw_events(_events(spark, 19, "2.5").where("day = 1"), local_tmp, **land)
        after = _bodies(f"{local_tmp}/{root}")
        date = "landing_date=20240101/" if layout == "hive" else ""
        new = {f"{date}page=1", f"{date}page=2"}
        assert after.keys() == before.keys() and {f for f in after if after[f] != before[f]} == new
        assert all('"2.5"' in after[f] and '"1.5"' not in after[f] for f in new)
        counts = readers.api_page_counts(spark, f"{local_tmp}/{root}").collect()
        assert len(counts) == len(before) and {r.record_count for r in counts} == {5}


def test_pages_stay_if_the_new_ones_cannot_be_written(spark, local_tmp):
    bodies = spark.range(20).selectExpr("'[1]' AS value", "int(id) AS page")
    fixtures.write_page_files(bodies, local_tmp, ["page"])
    broken = bodies.selectExpr("IF(page = 13, raise_error('broken'), '[2]') AS value", "page")
    with pytest.raises(Exception, match="broken"):
        fixtures.write_page_files(broken, local_tmp, ["page"])
    assert set(_bodies(local_tmp).values()) == {"[1]\n"}
    assert sorted(os.listdir(local_tmp)) == sorted(f"page={p}" for p in range(20))


def test_pages_of_no_rows_are_an_empty_folder(spark, local_tmp):
    fixtures.land_raw_events(_events(spark, 0), local_tmp, page_size=5)
    assert readers.api_page_counts(spark, f"{local_tmp}/api/events").count() == 0


def test_pages_land_where_only_hadoop_reaches(spark, local_tmp):
    os.makedirs(f"{local_tmp}/a")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.pages.link./at", f"file://{local_tmp}/a")
    root = "viewfs://pages/at"
    assert fixtures.local_folder(spark, root) is None and fixtures.local_folder(spark, f"file://{local_tmp}/a b") == f"{local_tmp}/a b"
    fixtures.land_raw_events(_events(spark, 60), root, page_size=5)
    fixtures.land_raw_events(_events(spark, 60), f"{local_tmp}/b", page_size=5)
    want = readers.api_page_counts(spark, f"{local_tmp}/b/api/events").collect()
    assert sorted(readers.api_page_counts(spark, f"{root}/api/events").collect()) == sorted(want) and len(want) == 12
