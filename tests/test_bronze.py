import pytest
from pyspark.sql import Row

from strata.operators.bronze import attach_metadata
from strata.sources.readers import read_raw


def test_attach_metadata_adds_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, value string")
    out = attach_metadata(df, "run-001", "test-src", "2024-03-15", "2024-03-15T01:00:00Z")
    assert {"pipeline_run_id", "ingested_at", "source_system", "year", "month", "day"} <= set(
        out.columns)
    row = out.collect()[0]
    assert (row.pipeline_run_id, row.source_system) == ("run-001", "test-src")
    assert (row.year, row.month, row.day) == (2024, 3, 15)
    assert dict(out.dtypes)["year"] == "int"


def test_attach_metadata_preserves_columns(spark):
    df = spark.createDataFrame([(100, 9.99), (200, 19.5)], "customer_id bigint, amount double")
    out = attach_metadata(df, "run-002", "crm", "2024-01-01", "t")
    assert {"customer_id", "amount"} <= set(out.columns)
    assert out.count() == 2


def test_source_column_overwritten_unless_kept(spark):
    df = spark.createDataFrame([(1, "api"), (2, None)], "id int, source_system string")
    over = attach_metadata(df, "r", "sftp", "2024-03-15", "t")
    assert {r.source_system for r in over.collect()} == {"sftp"}
    kept = attach_metadata(df, "r", "sftp", "2024-03-15", "t", keep_source_column=True)
    assert sorted(r.source_system for r in kept.collect()) == ["api", "sftp"]


def test_read_csv_infers_schema(spark, local_tmp):
    with open(f"{local_tmp}/sample.csv", "w") as f:
        f.write("id,name,amount\n1,Alice,10.5\n2,Bob,20.0\n")
    df = read_raw(spark, local_tmp, "csv")
    assert df.count() == 2
    assert {"id", "name", "amount"} <= set(df.columns)
    assert dict(df.dtypes)["amount"] == "double"


def test_unsupported_format_raises(spark, local_tmp):
    with pytest.raises(ValueError, match="Unsupported format: xlsx"):
        read_raw(spark, local_tmp, "xlsx")


def test_format_is_case_insensitive(spark):
    df = read_raw(spark, "/root/testdata/sf0.001/region.parquet", "PARQUET")
    assert df.count() == 5


def test_partitioned_roundtrip(spark, tmp):
    from strata.sinks.writers import publish_range
    df = spark.createDataFrame([Row(id=1, value="x", year=2024, month=3, day=15)])
    publish_range(df, tmp, "2024-03-15", "2024-03-15")
    assert spark.read.parquet(tmp).count() == 1
