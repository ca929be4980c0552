"""The corpus pipeline: toxic documents go, exact and near copies go, what stays is mixed to the
sources' weights and encoded.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, all but the last one with the columns of ``docs``. ``run`` writes each stage as
Parquet to the shared folder and reads it back as the next one's input, so a lost executor never
costs more than the stage it was working on.

Defined cases: those of the operators. A table without rows passes through; columns that
``documents`` does not have are carried by every stage but the last; rows that repeat as a whole
are exact copies; rows that share an id but not the text are judged row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, curriculum, exact_dedup, hamming_dedup, toxicity
from strata.llm.common import stage, table
from strata.llm.queries import tokenizer_file

# Near copies: shingles of five words, Jaccard similarity in per cent.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "_toxicity").where("NOT _toxicity.rejected").select(*_columns(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each exact text (white space aside), admitted to a fresh digest index."""
    decisions = exact_dedup.new_index(spark).admit(docs)
    return exact_dedup.keep_first(docs, decisions)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return hamming_dedup.keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: a row for each pass that takes a document, in order of training position."""
    return curriculum.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row of the mix: ``doc_id, source, lang, n_tokens, ids``."""
    return bpe.encode(docs.select("doc_id", "source", "lang", "text"), tokenizer_file()).select(
        "doc_id", "source", "lang", "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Classifier, MinHash components and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
