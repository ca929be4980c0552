"""Gold: daily summary per (source_system, date) and KPIs per source_system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_KEYS = ("source_system", "year", "month", "day")


def compute_daily(df: DataFrame, computed_at: str, keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """count(*), exact distinct ids, sum/avg/max/min of amount per key.

    Plans as partial aggregation on (keys, id) → exchange → partial on keys → exchange → final,
    so a dominant source_system never funnels raw rows into one task.
    """
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("total_records"),
                   F.count_distinct("id").alias("distinct_ids"),
                   F.sum("amount").alias("total_amount"),
                   F.avg("amount").alias("avg_amount"),
                   F.max("amount").alias("max_amount"),
                   F.min("amount").alias("min_amount"))
              .withColumn("computed_at", F.lit(computed_at)))


def active_rate() -> F.Column:
    """Share of rows with is_active = true over *all* rows (NULL counts as inactive)."""
    active = F.sum(F.when(F.col("is_active") == F.lit(True), 1).otherwise(0))
    return active.cast("double") / F.count(F.lit(1)).cast("double")


def compute_kpis(df: DataFrame, execution_date: str | None, computed_at: str,
                 keys: Sequence[str] = ("source_system",)) -> DataFrame:
    """KPIs per source_system for one execution-date slice.

    For a multi-date frame pass ``keys=("source_system", "year", "month", "day")`` and
    ``execution_date=None``: the date string is then derived from each group's partition.
    """
    out = (df.groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("record_count"),
                  F.count_distinct("id").alias("unique_entities"),
                  F.sum("amount").alias("total_value"),
                  F.avg("amount").alias("avg_value"),
                  active_rate().alias("active_rate")))
    if execution_date is None:
        date_col = F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd")
    else:
        date_col = F.lit(execution_date)
    return out.withColumns({"execution_date": date_col, "computed_at": F.lit(computed_at)})


def compute_summaries(df: DataFrame, keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """Daily and KPI measures in **one** aggregation per (source_system, date).

    On a one-date slice (a daily run) and in a backfill, the daily summary and the KPIs group
    by the same keys, so both tables are projections of this single aggregate: one scan and one
    shuffle of Silver instead of two.
    """
    return (df.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("total_records"),
                   F.count_distinct("id").alias("distinct_ids"),
                   F.sum("amount").alias("total_amount"),
                   F.avg("amount").alias("avg_amount"),
                   F.max("amount").alias("max_amount"),
                   F.min("amount").alias("min_amount"),
                   active_rate().alias("active_rate")))


def daily_from_summaries(summaries: DataFrame, computed_at: str) -> DataFrame:
    return summaries.select(*DAILY_KEYS, "total_records", "distinct_ids", "total_amount",
                            "avg_amount", "max_amount", "min_amount",
                            F.lit(computed_at).alias("computed_at"))


def kpis_from_summaries(summaries: DataFrame, execution_date: str | None, computed_at: str,
                        keep_date: bool = False) -> DataFrame:
    """KPI rows from per-(source, date) summaries. ``execution_date=None`` derives the date of
    each row; ``keep_date`` keeps year/month/day (multi-date frames)."""
    date_col = (F.lit(execution_date) if execution_date is not None
                else F.date_format(F.make_date("year", "month", "day"), "yyyy-MM-dd"))
    extra = ["year", "month", "day"] if keep_date else []
    return summaries.select("source_system", *extra,
                            F.col("total_records").alias("record_count"),
                            F.col("distinct_ids").alias("unique_entities"),
                            F.col("total_amount").alias("total_value"),
                            F.col("avg_amount").alias("avg_value"), "active_rate",
                            date_col.alias("execution_date"),
                            F.lit(computed_at).alias("computed_at"))


# ---------------------------------------------------------------------------------------------
# States: what KPIs of any range can be added up from without reading Silver again
# ---------------------------------------------------------------------------------------------

def kpi_state(df: DataFrame, keys: Sequence[str] = DAILY_KEYS) -> DataFrame:
    """The measures of the KPIs that add up, per key: rows, amounts and their sum, active rows."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("amount").alias("total_value"),
        F.count("amount").alias("value_count"),
        F.count(F.when(F.col("is_active") == F.lit(True), 1)).alias("active_count"))


def id_state(df: DataFrame, keys: Sequence[str] = DAILY_KEYS, id_column: str = "id") -> DataFrame:
    """The distinct ids per key as bitmaps: a row per key and ``bucket`` of 32,768 neighbouring ids that
    has any, with a ``bitmap`` of 4 KB (mostly zeros compress away; ids spread thinly over 64 bits
    cost up to a bitmap each). Any 64-bit id, negative ones too; NULL ids do not count."""
    ids = df.where(F.col(id_column).isNotNull()).select(
        *keys, F.bitmap_bucket_number(id_column).alias("bucket"), F.bitmap_bit_position(id_column).alias("_pos"))
    return ids.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("_pos").alias("bitmap"))


def merge_ids(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of finer keys (dates, say) merged to ``keys``: bitmaps of a bucket are or-ed."""
    return states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_ids(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact number of distinct ids per key: ``keys…, unique_entities``."""
    return merge_ids(states, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("unique_entities"))


def kpis_from_states(measures: DataFrame, ids: DataFrame, execution_date: str, computed_at: str) -> DataFrame:
    """KPIs per source over all keys of the states, equal to :func:`compute_kpis` on the rows that
    the states were made from."""
    total = measures.groupBy("source_system").agg(
        F.sum("record_count").alias("record_count"), F.sum("total_value").alias("total_value"),
        F.sum("value_count").alias("_values"), F.sum("active_count").alias("_active"))
    unique = count_ids(ids, ["source_system"]).withColumnRenamed("source_system", "_source")
    return total.join(unique, F.col("source_system").eqNullSafe(F.col("_source")), "left").select(
        "source_system", "record_count", F.coalesce("unique_entities", F.lit(0)).alias("unique_entities"), "total_value",
        F.try_divide("total_value", "_values").alias("avg_value"),
        (F.col("_active").cast("double") / F.col("record_count").cast("double")).alias("active_rate"),
        F.lit(execution_date).alias("execution_date"), F.lit(computed_at).alias("computed_at"))
