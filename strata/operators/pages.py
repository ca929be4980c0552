"""Completeness of landed API pages.

An API run asks for page after page until one comes back empty. What was landed of a date is
complete if its page numbers run from 1 without a gap, no page came twice, nothing follows the
empty page, and the run came to its end: its last page is empty or not full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_islands(counts: DataFrame) -> DataFrame:
    """Page counts (``landing_date, page, record_count``, a row per file) → runs of neighbouring pages:
    ``landing_date, first_page, last_page, landed, pages, records``, with a row that is not ``landed``
    for every gap before, or between, the landed ones. Pages without a number are left out."""
    pages = (counts.where("page IS NOT NULL").groupBy("landing_date", "page")
             .agg(F.sum("record_count").alias("n")))
    by_page = Window.partitionBy("landing_date").orderBy("page")
    # In a run of neighbours page - place is constant.
    runs = pages.withColumn("island", F.col("page") - F.row_number().over(by_page))
    landed = runs.groupBy("landing_date", "island").agg(
        F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.sum("n").alias("records"))
    by_first = Window.partitionBy("landing_date").orderBy("first_page")
    before = landed.withColumn("gap_from", F.coalesce(F.lag("last_page").over(by_first), F.lit(0)) + 1)

    def row(first, last, is_landed, records):
        return F.struct(first.alias("first_page"), last.alias("last_page"), F.lit(is_landed).alias("landed"),
                        (last - first + 1).cast("long").alias("pages"), records.cast("long").alias("records"))

    own = row(F.col("first_page"), F.col("last_page"), True, F.col("records"))
    gap = row(F.col("gap_from"), F.col("first_page") - 1, False, F.lit(0))
    both = F.when(F.col("gap_from") < F.col("first_page"), F.array(gap, own)).otherwise(F.array(own))
    return before.select("landing_date", F.explode(both).alias("r")).select("landing_date", "r.*")


def page_checks(counts: DataFrame, page_size: int) -> DataFrame:
    """Quality rows per date: ``landing_date, check_name, passed, actual, expected, message, observed``
    for missing pages, pages that came in several files, records after an empty page, and a run
    that did not come to its end."""
    gaps = (page_islands(counts).where("NOT landed")
            .withColumn("span", F.when(F.col("pages") == 1, F.col("first_page").cast("string"))
                        .otherwise(F.concat_ws("-", "first_page", "last_page")))
            .groupBy("landing_date").agg(
                F.sum("pages").alias("missing"),
                F.transform(F.array_sort(F.collect_list(F.struct("first_page", "span"))), lambda x: x["span"]).alias("spans")))
    pages = (counts.where("page IS NOT NULL").groupBy("landing_date", "page")
             .agg(F.sum("record_count").alias("n"), F.count(F.lit(1)).alias("files")))
    dates = pages.groupBy("landing_date").agg(
        F.count(F.when(F.col("files") > 1, 1)).alias("repeated"),
        F.min(F.when(F.col("n") == 0, F.col("page"))).alias("end_page"),
        F.max(F.when(F.col("n") > 0, F.col("page"))).alias("last_full"),
        F.max(F.struct("page", "n")).alias("last"))
    dates = dates.join(gaps, "landing_date", "left").withColumns({
        "missing": F.coalesce("missing", F.lit(0)),
        "after": F.when(F.col("end_page") < F.col("last_full"), F.col("last_full") - F.col("end_page")).otherwise(0)})

    def row(name, observed, expected, message):
        passed = observed == 0
        return F.struct(F.lit(f"api_pages.{name}").alias("check_name"), passed.alias("passed"),
                        observed.cast("string").alias("actual"), F.lit(expected).alias("expected"),
                        F.when(passed, F.lit("")).otherwise(message).alias("message"),
                        observed.cast("double").alias("observed"))

    unfinished = (F.col("last.n") >= page_size).cast("int")
    rows = F.array(
        row("missing", F.col("missing"), "0 missing pages", F.concat(F.lit("pages missing: "), F.array_join("spans", ", "))),
        row("repeated", F.col("repeated"), "0 repeated pages", F.lit("pages landed in several files")),
        row("after_end", F.col("after"), "0 pages after the end", F.concat(
            F.lit("page "), F.col("end_page").cast("string"), F.lit(" is empty, later ones are not"))),
        row("unfinished", unfinished, "a last page that is empty or not full", F.concat(
            F.lit("page "), F.col("last.page").cast("string"), F.lit(" is full and the last one landed"))))
    return dates.select("landing_date", F.explode(rows).alias("r")).select("landing_date", "r.*")
