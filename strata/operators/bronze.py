"""Bronze: stamp landed rows with run metadata. No business logic, source columns unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import parse_date


def attach_metadata(df: DataFrame, pipeline_run_id: str, source_system: str,
                    execution_date: str | Column, ingested_at: str,
                    keep_source_column: bool = False) -> DataFrame:
    """Add ``pipeline_run_id, ingested_at, source_system, year, month, day``.

    Same-named input columns are replaced (the run's ``source_system`` wins) unless
    ``keep_source_column`` is set, in which case a non-NULL value from the file survives.
    ``year/month/day`` are the *processing* date as int literals, never derived from the data.
    ``ingested_at`` is passed in (ISO string) so reruns are reproducible. For a multi-date landing
    read ``execution_date`` may be a date Column (the landing date of each file).
    """
    if isinstance(execution_date, Column):
        y, m, dd = (F.year(execution_date), F.month(execution_date),
                    F.dayofmonth(execution_date))
    else:
        d = parse_date(execution_date)
        y, m, dd = F.lit(d.year), F.lit(d.month), F.lit(d.day)
    source = F.lit(source_system)
    if keep_source_column and "source_system" in df.columns:
        source = F.coalesce(F.col("source_system").cast("string"), source)
    return df.withColumns({
        "pipeline_run_id": F.lit(pipeline_run_id),
        "ingested_at": F.lit(ingested_at),
        "source_system": source,
        "year": y.cast("int"),
        "month": m.cast("int"),
        "day": dd.cast("int"),
    })
