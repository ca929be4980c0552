"""Write PLANS.md: final (post-AQE) formatted physical plans of the key operators.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from strata import queries as Q  # noqa: E402
from strata.contract import SUITES  # noqa: E402
from strata.operators import gold, quality  # noqa: E402
from strata.plans.jobs import run_suite  # noqa: E402
from strata.session import build_session  # noqa: E402

NOTES = {
    "gold_daily": "dedup: map-side WindowGroupLimit before the key exchange; daily: partial "
                  "aggregation on (keys, id) and on keys before each exchange.",
    "gold_summaries": "the fused daily + KPI aggregate used by the Gold jobs.",
    "enrich_dim": "dimension pruned to two columns; the planner broadcasts it by its size.",
    "exp_suite_silver": "all inline checks in one HashAggregate; uniqueness in its own "
                        "aggregation.",
    "partition_scan": "only the date's leaf folder is listed; PartitionFilters on the scan.",
    "jdbc_date_slice": "half-open date range pushed to the Parquet scan.",
    "dq_partitions": "calendar left-joined to per-date counts; only partition columns read.",
}


def frames(spark, sf):
    yield "gold_daily", Q.gold_daily(spark, sf)
    yield "gold_summaries", gold.compute_summaries(Q.silver_events(spark, sf))
    yield "enrich_dim", Q.enrich_dim(spark, sf)
    yield "exp_suite_silver", run_suite(Q.silver_events(spark, sf), "silver", SUITES["silver"])
    yield "partition_scan", Q.partition_scan(spark, sf)
    yield "jdbc_date_slice", Q.jdbc_date_slice(spark, sf)
    yield "dq_partitions", Q.dq_partitions(spark, sf)
    yield "dedup_report", Q.dedup_report(spark, sf)
    yield "null_rate_by_date", quality.evaluate(
        Q.bronze_frame(spark, sf), quality.null_rate(["id", "source_system"],
                                                     Q.bronze_frame(spark, sf).columns, 0.0),
        by=["year", "month", "day"])


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    out = ["# PLANS", "", f"Final physical plans (after AQE) at `{sf}`, `local[8]`, generated by "
           "`tools/plan_report.py`. Expression ids are stripped.", ""]
    for name, df in frames(spark, sf):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = re.sub(r"#\d+L?", "", buf.getvalue())
        text = re.sub(r"file:/[^ ,\]]*/strata/", "<scratch>/", text)
        head, _, rest = text.partition("\n\n(1)")
        details = []
        for sec in ("(1)" + rest).split("\n\n"):
            lines = sec.strip().split("\n")
            title = lines[0]
            if not re.search(r"Scan|Exchange|WindowGroupLimit|BroadcastHashJoin|HashAggregate|"
                             r"SortMergeJoin|Window \(", title):
                continue
            keep = [ln for ln in lines[1:] if re.match(
                r"(Arguments|PushedFilters|PartitionFilters|ReadSchema|Keys|Functions|"
                r"Left keys|Right keys|Join type|Location)", ln)]
            details.append("\n".join([title] + [k[:220] for k in keep]))
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", head.strip(), "```", "",
                "```", "\n\n".join(details), "```", ""]
    open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w").write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
