"""Layer tables bucketed by the business key.

Rows are dealt to buckets by their key once, when they are written, and are sorted by it there. What
groups by the key later (uniqueness checks, deduplication, joins on the key of two tables bucketed
alike) finds them together and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.contract import BUSINESS_KEY
from strata.functions.columns import col_ref


def _name(path: str) -> str:
    return "bucketed_" + "".join(c if c.isalnum() else "_" for c in path)[-80:].lower()


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def attach(spark: SparkSession, path: str, schema: str, keys: Sequence[str] = BUSINESS_KEY,
           buckets: int | None = None) -> str:
    """Name of the session's table over ``path``, made empty if there is none. ``schema`` (DDL), ``keys``
    and ``buckets`` must be those that it was made with."""
    name = _name(path)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({_quoted(keys)}) "
              f"SORTED BY ({_quoted(keys)}) INTO {n} BUCKETS LOCATION '{path}'")
    return name


def append(df: DataFrame, path: str, keys: Sequence[str] = BUSINESS_KEY, buckets: int | None = None) -> DataFrame:
    """Append ``df`` to the table at ``path`` (made if there is none) with one file per bucket; returns the
    whole table. A hot key is one bucket's: its rows are together by design."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    name = attach(spark, path, schema, keys, n)
    by = [col_ref(k) for k in keys]
    df.select(*[col_ref(c) for c in spark.table(name).columns]).repartition(n, *by).sortWithinPartitions(*by) \
      .write.insertInto(name)
    spark.catalog.refreshTable(name)
    return spark.table(name)
