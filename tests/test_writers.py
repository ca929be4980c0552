import pytest

from strata.sinks import writers


def _day(spark, d, n=1):
    return spark.createDataFrame([(i, 2024, 3, d) for i in range(n)],
                                 "id int, year int, month int, day int")


def test_second_date_keeps_first(spark, tmp):
    writers.publish_partition(_day(spark, 15), tmp, "2024-03-15")
    writers.publish_partition(_day(spark, 16), tmp, "2024-03-16")
    got = {r.day for r in spark.read.parquet(tmp).collect()}
    assert got == {15, 16}


def test_rerun_replaces_only_its_date(spark, tmp):
    writers.publish_partition(_day(spark, 15, 3), tmp, "2024-03-15")
    writers.publish_partition(_day(spark, 16, 2), tmp, "2024-03-16")
    writers.publish_partition(_day(spark, 15, 1), tmp, "2024-03-15")
    counts = {r.day: r["count"] for r in spark.read.parquet(tmp).groupBy("day").count().collect()}
    assert counts == {15: 1, 16: 2}


def test_empty_rerun_empties_date(spark, tmp):
    writers.publish_partition(_day(spark, 15, 3), tmp, "2024-03-15")
    writers.publish_partition(_day(spark, 15).limit(0), tmp, "2024-03-15")
    assert spark.read.parquet(tmp).count() == 0


def test_range_publish_dynamic_and_cleanup(spark, tmp):
    writers.publish_range(_day(spark, 15, 2).union(_day(spark, 16, 2)), tmp, "2024-03-15",
                          "2024-03-16")
    writers.publish_range(_day(spark, 16, 1), tmp, "2024-03-16", "2024-03-17")
    counts = {r.day: r["count"] for r in spark.read.parquet(tmp).groupBy("day").count().collect()}
    assert counts == {15: 2, 16: 1}


def test_audit_append_and_empty_root(spark, tmp):
    from strata.operators import quality
    df = spark.range(3)
    assert writers.read_audit(spark, tmp).count() == 0
    res = quality.evaluate(df, [quality.row_count(1, label="x")])
    writers.write_audit(res, tmp, "r1", "silver", "2024-03-15", "now")
    writers.write_audit(res, tmp, "r2", "gold", "2024-03-15", "now")
    a = writers.read_audit(spark, tmp)
    assert a.count() == 2 and {r.layer for r in a.collect()} == {"silver", "gold"}


def test_schema_baseline(spark, tmp):
    assert writers.read_schema_baseline(spark, tmp, "silver") is None
    writers.write_schema_baseline(spark, tmp, "silver", ["b", "a"])
    assert writers.read_schema_baseline(spark, tmp, "silver") == ["a", "b"]


def test_metrics_log_appends(spark, tmp):
    k = spark.createDataFrame([("crm", 1)], "source_system string, record_count long")
    writers.write_metrics_log(k, tmp, "r1")
    writers.write_metrics_log(k, tmp, "r2")
    assert {r.pipeline_run_id for r in spark.read.json(tmp).collect()} == {"r1", "r2"}


def test_land_extract_counts(spark, tmp):
    assert writers.land_extract(spark.range(7), tmp) == 7


def test_audit_ndjson_partitions(spark, tmp):
    from strata.operators import quality
    res = quality.evaluate(spark.range(2), [quality.row_count(1, label="x")])
    writers.write_audit_ndjson(res, tmp, "r1", "silver", "2024-03-15", "now")
    writers.write_audit_ndjson(res, tmp, "r2", "silver", "2024-03-16", "now")
    a = writers.read_audit_ndjson(spark, tmp)
    assert sorted(r.execution_date for r in a.collect()) == ["2024-03-15", "2024-03-16"]
    import glob
    assert glob.glob(tmp.replace("file:", "") + "/layer=silver/execution_date=2024-03-15/*.json")


def test_range_publish_clears_only_stale_dates(spark, tmp):
    import os
    writers.publish_range(_day(spark, 15, 2).union(_day(spark, 16, 3)), tmp, "2024-03-15",
                          "2024-03-16")
    emptied = writers.publish_range(_day(spark, 15, 1), tmp, "2024-03-15", "2024-03-17")
    assert [p.rsplit("/", 1)[-1] for p in emptied] == ["day=16"]
    counts = {r.day: r["count"] for r in spark.read.parquet(tmp).groupBy("day").count().collect()}
    assert counts == {15: 1}
    assert not os.path.exists(tmp.replace("file:", "") + "/year=2024/month=3/day=17")
    assert writers.table_dates(spark, tmp, "2024-03-14", "2024-03-17") == {(2024, 3, 15),
                                                                          (2024, 3, 16)}


def test_range_publish_refuses_rows_without_a_date(spark, tmp):
    df = spark.createDataFrame([(1, 2024, 1, 1), (2, None, None, None), (3, 2025, 1, 1)],
                               "id int, year int, month int, day int")
    with pytest.raises(ValueError, match="1 rows have no year/month/day"):
        writers.publish_range(df, tmp, "2024-01-01", "2024-01-31")


def test_staged_copies_go_after_publishing(spark, tmp):
    rows = spark.createDataFrame([(1, 2024, 1, 1)], "id int, year int, month int, day int")
    with writers.staged_range(rows, tmp) as new:
        assert new.dates("2024-01-01", "2024-01-31") == {(2024, 1, 1)}
        assert writers.table_dates(spark, tmp, "2024-01-01", "2024-01-31") == set()
        new.publish("2024-01-01", "2024-01-31")
    assert new.dates("2024-01-01", "2024-01-31") == set()
    assert spark.read.parquet(tmp).count() == 1
    assert writers._Files(spark, tmp).names(f"{tmp}/_staging") == []


def _counts(spark, root):
    return {r.day: r["count"] for r in spark.read.parquet(root).groupBy("day").count().collect()}


@pytest.mark.parametrize("fails_at", range(1, 7))
def test_a_publish_that_fails_leaves_every_old_date(spark, tmp, monkeypatch, fails_at):
    writers.publish_range(_day(spark, 15, 2).union(_day(spark, 16, 3)).union(_day(spark, 17, 4)), tmp,
                          "2024-03-15", "2024-03-17")
    new = _day(spark, 15, 5).union(_day(spark, 16, 6)).union(_day(spark, 17, 7))
    real, calls = writers._Files.rename, []

    def rename(self, old, to):
        calls.append(to)
        if len(calls) == fails_at:
            raise OSError("no")
        real(self, old, to)

    monkeypatch.setattr(writers._Files, "rename", rename)
    with pytest.raises(OSError, match="no"):
        writers.publish_range(new, tmp, "2024-03-15", "2024-03-17")
    assert _counts(spark, tmp) == {15: 2, 16: 3, 17: 4}
    monkeypatch.setattr(writers._Files, "rename", real)
    writers.publish_range(new, tmp, "2024-03-15", "2024-03-17")
    assert _counts(spark, tmp) == {15: 5, 16: 6, 17: 7}
    assert writers._Files(spark, tmp).names(f"{tmp}/_replaced") == []


def test_what_a_killed_driver_left_is_moved_back(spark, tmp):
    writers.publish_range(_day(spark, 15, 2).union(_day(spark, 16, 3)), tmp, "2024-03-15", "2024-03-16")
    files = writers._Files(spark, tmp)
    files.rename(f"{tmp}/year=2024/month=3/day=15", f"{tmp}/_replaced/dead/year=2024/month=3/day=15")
    assert _counts(spark, tmp) == {16: 3}
    writers.publish_partition(_day(spark, 17, 1), tmp, "2024-03-17")
    assert _counts(spark, tmp) == {15: 2, 16: 3, 17: 1}


def test_rows_are_written_once(spark, tmp):
    """A publish moves the staged files: same names, same contents."""
    import glob
    with writers.staged_range(_day(spark, 15, 3).union(_day(spark, 16, 2)), tmp) as new:
        base = new.at.removeprefix("file:")
        staged = {p.removeprefix(base) for p in glob.glob(f"{base}/year=*/**/*.parquet", recursive=True)}
        new.publish("2024-03-15", "2024-03-16")
    table = tmp.removeprefix("file:")
    assert staged == {p.removeprefix(table) for p in glob.glob(f"{table}/year=*/**/*.parquet", recursive=True)}


def test_readers_skip_what_is_staged(spark, tmp):
    writers.publish_partition(_day(spark, 15, 2), tmp, "2024-03-15")
    with writers.staged_range(_day(spark, 16, 9), tmp):
        assert _counts(spark, tmp) == {15: 2}
    with writers.staged_date(_day(spark, 15, 9), tmp, "2024-03-15") as new:
        assert new.frame.count() == 9 and _counts(spark, tmp) == {15: 2}
