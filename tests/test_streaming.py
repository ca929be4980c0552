from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixtures
from strata.contract import SOURCE_REGISTRY
from strata.functions.dates import partition_predicate
from strata.queries import LANDED_SCHEMA
from strata.session import scratch_path
from strata.streaming import run_bronze_stream

SF = "/root/testdata/sf0.001"


def test_stream_is_incremental_and_exactly_once(spark):
    root = scratch_path(spark, "stream-test")
    raw = fixtures.raw_events(spark, SF)
    schema = T._parse_datatype_string(LANDED_SCHEMA)
    args = (f"{root}/landing", f"{root}/bronze", f"{root}/ckpt", SOURCE_REGISTRY, schema, "r",
            "2024-01-31T00:00:00Z")
    fixtures.land_raw_events(raw.where(partition_predicate("2024-01-15")), f"{root}/landing")
    run_bronze_stream(spark, *args)
    first = spark.read.parquet(f"{root}/bronze").count()
    assert first == raw.where(partition_predicate("2024-01-15")).count()
    # a rerun with nothing new appends nothing
    run_bronze_stream(spark, *args)
    assert spark.read.parquet(f"{root}/bronze").count() == first
    # a new landing date is picked up on its own
    fixtures.land_raw_events(raw.where(partition_predicate("2024-01-16")), f"{root}/landing")
    run_bronze_stream(spark, *args)
    b = spark.read.parquet(f"{root}/bronze")
    got = {r.day: r["count"] for r in b.groupBy("day").count().collect()}
    assert got == {15: first, 16: raw.where(partition_predicate("2024-01-16")).count()}
    assert b.where(F.col("source_system").isNull()).count() == 0


def test_stream_refuses_another_header(spark, local_tmp):
    """A file with other columns stops the stream; nothing is read by position."""
    import os

    import pytest
    src = [{"id": "crm", "format": "csv", "landing_subdir": "sftp/crm", "source_system_label": "crm"}]
    schema = T._parse_datatype_string("id string, amount string")

    def land(date, text):
        os.makedirs(f"{local_tmp}/landing/sftp/crm/landing_date={date}")
        with open(f"{local_tmp}/landing/sftp/crm/landing_date={date}/a.csv", "w") as f:
            f.write(text)

    args = (f"{local_tmp}/landing", f"{local_tmp}/bronze", f"{local_tmp}/ckpt", src, schema, "r", "now")
    land("20240101", "id,amount\n1,10\n")
    run_bronze_stream(spark, *args)
    land("20240102", "amount,id\n20,2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        run_bronze_stream(spark, *args)
    assert [tuple(r) for r in spark.read.parquet(f"{local_tmp}/bronze").select("id", "amount").collect()] == [("1", "10")]


def test_stream_of_files_follows_headers_once(spark, local_tmp, monkeypatch):
    import os

    from strata.sinks import writers
    from strata.sources import readers
    from strata.streaming.by_header import run_stream
    src = {"id": "crm", "format": "csv", "landing_subdir": "sftp/crm", "source_system_label": "crm"}

    def land(date, name, text):
        os.makedirs(f"{local_tmp}/landing/sftp/crm/landing_date={date}", exist_ok=True)
        with open(f"{local_tmp}/landing/sftp/crm/landing_date={date}/{name}", "w") as f:
            f.write(text)

    def rows():
        df = readers.read_range(spark, f"{local_tmp}/bronze", "2024-01-01", "2024-01-31")
        return sorted((r.day, r.id, r.amount, getattr(r, "note", None)) for r in df.collect())

    args = (f"{local_tmp}/landing", f"{local_tmp}/bronze", f"{local_tmp}/ckpt", src, "r", "now")
    land("20240101", "a b.csv", "id,amount\n1,10\n")
    land("20240101", "empty.csv", "")
    run_stream(spark, *args)
    assert rows() == [(1, "1", "10", None)]
    land("20240102", "b.csv", "note,amount,id\nx,20,2\n")
    land("20240101", "late.csv", "amount,id\n30,3\n")
    # The append is cut short after its first file; the micro-batch runs again and leaves each row once.
    real, calls = writers._Files.rename, []

    def rename(self, old, new):
        calls.append(new)
        if len(calls) == 2:
            raise OSError("no")
        real(self, old, new)

    monkeypatch.setattr(writers._Files, "rename", rename)
    try:
        run_stream(spark, *args)
        raise AssertionError("the stream should have failed")
    except AssertionError:
        raise
    except Exception:
        assert len(rows()) == 2, (calls, rows())
    monkeypatch.setattr(writers._Files, "rename", real)
    run_stream(spark, *args)
    want = [(1, "1", "10", None), (1, "3", "30", None), (2, "2", "20", "x")]
    assert rows() == want
    run_stream(spark, *args)
    assert rows() == want
