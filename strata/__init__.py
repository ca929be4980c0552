"""strata — medallion (bronze / silver / gold) analytics on PySpark.

Public entry points::

    from strata import operators, sources, sinks, plans, streaming
    from strata.operators.silver import cast_types, deduplicate, business_rules
    from strata.operators.gold import compute_daily, compute_kpis
    from strata.operators.quality import evaluate, compile_suite, gate
    from strata.plans.jobs import bronze_job, silver_job, gold_job, backfill, quality_stage
"""

__version__ = "0.1.0"
