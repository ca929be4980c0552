"""Silver: typed casts, deterministic deduplication, business rules, dimension enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contract import (BUSINESS_KEY, CONTRACT_CASTS, NON_NEGATIVE_COLUMN,
                             REQUIRED_NOT_NULL, SURVIVOR_ORDER)
from strata.functions.casts import cast_columns
from strata.functions.columns import col_ref

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def cast_types(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """Cast the contract columns that are present; invalid text becomes NULL."""
    return cast_columns(df, CONTRACT_CASTS if casts is None else casts)


def present_key(df: DataFrame, keys: Sequence[str] = BUSINESS_KEY) -> list[str]:
    return [k for k in keys if k in df.columns]


def survivor_order(df: DataFrame, keys: Sequence[str],
                   order: Sequence[tuple[str, str]] = SURVIVOR_ORDER) -> list[Column]:
    """Total order inside a duplicate group: the preferred columns first (NULLs last), then
    every remaining orderable column ascending (NULLs last) so the survivor never depends on
    task scheduling."""
    cols: list[Column] = []
    used = set(keys)
    for name, direction in order:
        if name in df.columns and name not in used:
            c = col_ref(name)
            cols.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
            used.add(name)
    for f in df.schema.fields:
        if f.name not in used and not isinstance(f.dataType, _UNORDERABLE):
            cols.append(col_ref(f.name).asc_nulls_last())
    return cols


def deduplicate(df: DataFrame, keys: Sequence[str] = BUSINESS_KEY,
                order: Sequence[tuple[str, str]] = SURVIVOR_ORDER) -> DataFrame:
    """One row per key (NULL keys compare equal); the survivor is the first row of a total order.

    Plans as a map-side ``WindowGroupLimit`` (top-1 per key per input partition) before the
    single hash exchange on the key, so a hot key ships at most one row per map task.
    No key column present → the frame is returned unchanged.
    """
    k = present_key(df, keys)
    if not k:
        return df
    ordering = survivor_order(df, k, order)
    if not ordering:
        # Every column is part of the key: duplicates are identical, any survivor is the same.
        return df.dropDuplicates(k)
    w = Window.partitionBy(*[col_ref(c) for c in k]).orderBy(*ordering)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def dedup_report(df: DataFrame, keys: Sequence[str] = BUSINESS_KEY) -> DataFrame:
    """Rows before / after deduplication and removed, from one aggregation (NULL keys count as a
    group because the key struct itself is never NULL)."""
    k = present_key(df, keys)
    after = F.count_distinct(F.struct(*[col_ref(c) for c in k])) if k else F.count(F.lit(1))
    return (df.agg(F.count(F.lit(1)).alias("rows_before"), after.alias("rows_after"))
              .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))


def business_rules(df: DataFrame, required: Sequence[str] = REQUIRED_NOT_NULL,
                   non_negative: str | None = NON_NEGATIVE_COLUMN) -> DataFrame:
    """Drop rows with a NULL identifier, then rows whose amount is not ``>= 0``.

    Three-valued logic is kept on purpose: a NULL amount is dropped, ``-0.0`` and NaN are kept.
    Each rule applies only if its column is present.
    """
    cond = None
    for c in required:
        if c in df.columns:
            cond = (col_ref(c).isNotNull() if cond is None
                    else cond & col_ref(c).isNotNull())
    if non_negative and non_negative in df.columns:
        c = col_ref(non_negative)
        if not isinstance(df.schema[non_negative].dataType, T.NumericType):
            c = c.try_cast("double")  # un-cast text: compare leniently, bad text is dropped
        rule = c >= 0
        cond = rule if cond is None else cond & rule
    return df if cond is None else df.where(cond)


def not_null_rules(df: DataFrame, required: Sequence[str] = REQUIRED_NOT_NULL) -> DataFrame:
    """Only the identifier half of the rules."""
    return business_rules(df, required, non_negative=None)


def enrich_with_dimension(df: DataFrame, dim: DataFrame, key: str = "source_system",
                          dim_key: str | None = None, columns: Sequence[str] = ("source_label",)
                          ) -> DataFrame:
    """Left outer equi-join to a dimension on ``key``; adds ``columns``, drops the dim key.

    The dimension is pruned to key + wanted columns, its key renamed so it cannot clash. Whether
    it is broadcast is the planner's choice by its size in bytes, also at run time (AQE); beyond
    ``spark.sql.autoBroadcastJoinThreshold`` it is a sort-merge join whose hot keys AQE splits.
    Unmatched rows keep NULL labels; a repeated dimension key fans rows out, as in SQL.
    """
    dk = dim_key or key
    side = dim.select(col_ref(dk).alias("__dim_key"), *[col_ref(c) for c in columns])
    return df.join(side, col_ref(key) == side["__dim_key"], "left").drop("__dim_key")
