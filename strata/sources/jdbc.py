"""JDBC date-slice extract.

``DATE(col) = 'd'`` defeats indexes and cannot be pushed down as a range, so the slice is the
half-open predicate ``col >= d AND col < d + 1``, pushed into the source query. ``parts`` splits the
day into as many time ranges, a query and a task each, on the same indexed column and without
knowing bounds; with ``partition_column`` + bounds the read is split on another column; otherwise
it is a single connection (what a one-table daily extract usually is).

Not exercised against a live database here: the only databases available would be in-process
ones that executors on a cluster could not reach.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession

from strata.contract import JDBC_FETCH_SIZE
from strata.functions.dates import day_slice, parse_date


_NAME = re.compile(r"[A-Za-z_][\w$]*(\.[A-Za-z_][\w$]*)*")


def slice_query(table: str, date_column: str, execution_date: str) -> str:
    """The date's slice as a derived table. Names are plain (possibly dotted) identifiers."""
    for name in (table, date_column):
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain SQL name: {name!r}")
    d = parse_date(execution_date)
    nxt = d + _dt.timedelta(days=1)
    return (f"(SELECT * FROM {table} WHERE {date_column} >= '{d.isoformat()}' "
            f"AND {date_column} < '{nxt.isoformat()}') t")


def day_ranges(date_column: str, execution_date: str, parts: int) -> list[str]:
    """``parts`` half-open predicates on the date column that cover the day: every row of the slice
    satisfies exactly one."""
    if not _NAME.fullmatch(date_column):
        raise ValueError(f"not a plain SQL name: {date_column!r}")
    if parts < 1:
        raise ValueError("parts must be at least 1")
    day = _dt.datetime.combine(parse_date(execution_date), _dt.time())
    whole = _dt.timedelta(days=1)
    cuts = [(day + whole * i / parts).isoformat(" ") for i in range(parts + 1)]
    return [f"{date_column} >= '{a}' AND {date_column} < '{b}'" for a, b in zip(cuts, cuts[1:])]


def read_jdbc_date_slice(spark: SparkSession, url: str, table: str, date_column: str,
                         execution_date: str, *, user: str | None = None,
                         password: str | None = None, fetchsize: int = JDBC_FETCH_SIZE,
                         partition_column: str | None = None, lower_bound=None,
                         upper_bound=None, num_partitions: int | None = None,
                         driver: str | None = None, parts: int | None = None) -> DataFrame:
    if parts is not None:
        if partition_column is not None:
            raise ValueError("parts and partition_column exclude each other")
        if not _NAME.fullmatch(table):
            raise ValueError(f"not a plain SQL name: {table!r}")
        given = {"fetchsize": str(fetchsize), "user": user, "password": password, "driver": driver}
        return spark.read.jdbc(url, table, predicates=day_ranges(date_column, execution_date, parts),
                               properties={k: v for k, v in given.items() if v is not None})
    opts = {"url": url, "dbtable": slice_query(table, date_column, execution_date),
            "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return spark.read.format("jdbc").options(**opts).load()


def date_slice(df: DataFrame, date_column: str, execution_date: str) -> DataFrame:
    """The same half-open slice over any DataFrame (parquet scans get it as pushed filters)."""
    return df.where(day_slice(date_column, execution_date))
