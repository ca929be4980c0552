import random

from strata import fixtures


def test_dense_positions_multi_level(spark):
    rnd = random.Random(7)
    rows = [(g, k) for g in ("a", "b", "c") for k in rnd.sample(range(10_000), 300)]
    df = spark.createDataFrame(rows, "g string, k long")
    got = {(r.g, r.k): r.position
           for r in fixtures.dense_positions(df, ["g"], "k", block=4, fanout=3).collect()}
    want = {}
    for g in ("a", "b", "c"):
        for i, k in enumerate(sorted(k for gg, k in rows if gg == g)):
            want[(g, k)] = i
    assert got == want


def test_landing_pages_are_per_date_and_bounded(spark):
    from pyspark.sql import functions as F

    from strata.session import scratch_path
    from strata.sources.readers import api_page_counts
    root = scratch_path(spark, "pages")
    raw = fixtures.raw_events(spark, "/root/testdata/sf0.01")
    fixtures.land_raw_events(raw, root, page_size=50)
    pages = api_page_counts(spark, f"{root}/api/events")
    assert pages.agg(F.max("record_count")).first()[0] == 50
    per_date = pages.groupBy("landing_date").agg(F.max("page").alias("p"),
                                                 F.sum("record_count").alias("n"))
    assert all(r.p == (r.n + 49) // 50 for r in per_date.collect())
