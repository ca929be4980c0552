"""Training-data operators: deduplication, language-model scoring, text extraction, toxicity,
mixing, sharding, archives and tokenisation as Spark jobs.

Nothing outside this subpackage imports it. Each module is one operator with its own interface;
:mod:`strata.llm.queries` registers one query per operator.
"""
