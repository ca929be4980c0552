"""Files of one source whose columns differ: by header for CSV, by footer for Parquet."""

import os

import pytest
from pyspark.sql import functions as F

from strata.sources import layouts, readers

SRC = {"id": "crm", "format": "csv", "landing_subdir": "sftp/crm", "source_system_label": "crm"}


def _put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _uneven(root):
    base = f"{root}/sftp/crm/landing_date="
    _put(base + "20240301", "a.csv", "id,amount\n1,10\n2,20\n")
    _put(base + "20240302", "a.csv", "amount,id,note\n30,3,x\n")
    _put(base + "20240303", "a.csv", "id\n4\n")
    _put(base + "20240303", "b.csv", "\nID,amount\n5,50\n")  # another header in the same folder
    _put(base + "20240304", "empty.csv", "")
    _put(base + "20240304", "c d{1}.csv", 'id,amount\n"6, or\n7",60\n')
    _put(base + "20240304", "e.csv", "note,id\ny,8\n")


WANT = {("1", "10", None), ("2", "20", None), ("3", "30", "x"), ("4", None, None), ("5", "50", None),
        ("6, or\n7", "60", None), ("8", None, "y")}


def test_range_reads_follow_each_header(spark, local_tmp):
    _uneven(local_tmp)
    df = readers.read_source_range(spark, local_tmp, SRC, "2024-03-01", "2024-03-31")
    assert {tuple(r) for r in df.select("id", "amount", "note").collect()} == WANT
    assert {r.landing_date.day: r["count"] for r in df.groupBy("landing_date").count().collect()} == \
        {1: 2, 2: 1, 3: 2, 4: 2}
    one = readers.read_source_range(spark, local_tmp, SRC, "2024-03-02", "2024-03-02")
    assert [tuple(r) for r in one.select("id", "amount", "note").collect()] == [("3", "30", "x")]


def test_a_given_schema_is_matched_by_name(spark, local_tmp):
    _uneven(local_tmp)
    df = readers.read_source_range(spark, local_tmp, {**SRC, "schema": "amount double, note string, id string"},
                                   "2024-03-01", "2024-03-31")
    assert df.drop("landing_date").dtypes == [("amount", "double"), ("note", "string"), ("id", "string")]
    got = {(r.id, None if r.amount is None else str(int(r.amount)), r.note) for r in df.collect()}
    assert got == WANT


def test_one_header_reads_folders_and_no_file_names(spark, local_tmp):
    for d in ("20240301", "20240302"):
        for f in "abc":
            _put(f"{local_tmp}/sftp/crm/landing_date={d}", f + ".csv", "id,amount\n1,2\n")
    groups = layouts.header_groups(spark, [f"{local_tmp}/sftp/crm"], {"recursiveFileLookup": "true"})
    assert groups == [("id,amount", [f"{local_tmp}/sftp/crm"], False)]
    assert readers.read_source_range(spark, local_tmp, SRC, "2024-03-01", "2024-03-02").count() == 6


def test_folders_inside_folders_are_not_read_twice(spark, local_tmp):
    _put(f"{local_tmp}/x", "a.csv", "id,amount\n1,2\n")
    _put(f"{local_tmp}/x/y", "b.csv", "amount,id\n4,3\n")
    got = readers.read_source(spark, f"{local_tmp}/x", SRC).collect()
    assert sorted((r.id, r.amount) for r in got) == [("1", "2"), ("3", "4")]


def test_files_given_by_name_are_read_alone(spark, local_tmp):
    for name, text in (("a.csv", "id,amount\n1,2\n"), ("b.csv", "amount,id\n4,3\n"), ("c.csv", "id,amount\n5,6\n")):
        _put(f"{local_tmp}/x", name, text)
    _put(f"{local_tmp}/x2", "d.csv", "amount,id\n8,7\n")
    for paths in ([f"{local_tmp}/x/a.csv", f"{local_tmp}/x2"], [f"file:{local_tmp}/x/a.csv", f"file:{local_tmp}/x2/"]):
        got = readers.read_source(spark, paths, SRC).collect()
        assert sorted((r.id, r.amount) for r in got) == [("1", "2"), ("7", "8")]
    got = readers.read_source(spark, [f"{local_tmp}/x/b.csv", f"{local_tmp}/x/c.csv"], SRC).collect()
    assert sorted((r.id, r.amount) for r in got) == [("3", "4"), ("5", "6")]


def test_first_lines_do_not_read_whole_files(spark, local_tmp):
    _put(local_tmp, "big.csv", "id,amount\n" + "1,2\n" * 400_000)
    lines = layouts.first_lines(spark, [local_tmp], {})
    assert [r.line for r in lines.collect()] == ["id,amount"]


def test_files_without_a_line(spark, local_tmp):
    _put(local_tmp, "a.csv", "")
    assert readers.read_source(spark, local_tmp, SRC).columns == []
    typed = readers.read_source(spark, local_tmp, {**SRC, "schema": "id long"})
    assert typed.dtypes == [("id", "bigint")] and typed.count() == 0


def test_header_names():
    assert layouts.header_names("﻿id,,ID,\"a,b\"") == ["id0", "_c1", "ID2", "a,b"]
    with pytest.raises(ValueError, match="several lines"):
        layouts.header_names('id,"am')


def test_parquet_types_that_contradict_inside_a_date(spark, local_tmp):
    src = {**SRC, "id": "db", "format": "parquet"}
    base = f"{local_tmp}/sftp/crm/landing_date="
    first = spark.createDataFrame([(1, 1.5)], "id int, amount double")
    second = spark.createDataFrame([("2", "2.5", "n")], "id string, amount string, note string")
    third = spark.createDataFrame([(3, True)], "id int, active boolean")
    for d, frames in (("20240301", [first, second]), ("20240302", [third]), ("20240303", [second, third])):
        for f in frames:
            f.coalesce(1).write.mode("append").parquet(base + d)
    df = readers.read_source_range(spark, local_tmp, src, "2024-03-01", "2024-03-03")
    got = {(str(r.landing_date)[-2:], r.id, r.amount, r.note, r.active) for r in df.collect()}
    assert got == {("01", "1", "1.5", None, None), ("01", "2", "2.5", "n", None), ("02", "3", None, None, "true"),
                   ("03", "2", "2.5", "n", None), ("03", "3", None, None, "true")}
    groups = layouts.schema_groups(spark, [base + d for d in ("20240301", "20240302", "20240303")], {})
    assert sorted(len(files) for _, files, _ in groups) == [2, 3]


def test_parquet_with_more_columns_is_one_read(spark, local_tmp):
    spark.range(2).coalesce(1).write.mode("append").parquet(local_tmp)
    spark.range(3).withColumn("note", F.lit("n")).coalesce(1).write.mode("append").parquet(local_tmp)
    groups = layouts.schema_groups(spark, [local_tmp], {})
    assert len(groups) == 1 and sorted(groups[0][0].names) == ["id", "note"]
