"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity grades are ordered (0 clean, 1 toxic, 2 toxic and of low quality). One weight vector is
shared by all thresholds: ``P(grade <= k) = sigmoid(theta_k - w.x)`` with increasing thetas. The
features of a text are the words it contains and their prefixes, present or not; the model keeps
those that labelled texts associate with toxicity. The expected grade is the severity.

Fitting reads at most ``max_rows`` labelled documents (a documented bound; the rows with the
smallest hashes of their ids) and at most ``max_features`` features; only those, as feature
numbers, reach the driver. Scoring reads every whole text.

Defined cases: a null or empty text has no features; rows with a null label are not learned
from; a null quality counts as good; texts that repeat are learned from once; without labelled
rows nothing is rejected; repeated and null ids are scored like any row; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_slices, release_memory, stage, text_or_empty

GRADES = 3
PREFIXES = (4, 5, 6)
MAX_ROWS = 30_000
MAX_FEATURES = 4_096
MIN_Z = 3.0          # significance of the association with toxicity
MIN_ODDS = 3.0       # and its size
REJECT_AT = 0.5      # probability of being toxic at all
_WORD = re.compile(r"\w+")


def features(text: str) -> set[str]:
    """Words, and prefixes (marked by a trailing hyphen) of longer words."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "-" for w in words for n in PREFIXES if len(w) > n}


@dataclass
class OrdinalModel:
    weights: dict[str, float]
    thetas: list[float]

    def at_least(self, text: str) -> list[float]:
        """P(grade >= k) for k = 1, 2, …"""
        known = self.weights
        words = set(_WORD.findall(text.lower()))
        found = {w for w in words if w in known}
        for n in PREFIXES:
            found.update(p for p in {w[:n] + "-" for w in words if len(w) > n} if p in known)
        score = sum(known[f] for f in sorted(found))
        return [float(1 / (1 + np.exp(np.clip(t - score, -500, 500)))) for t in self.thetas]


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int,
                grades_total: int = GRADES, ridge: float = 0.1, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch Adam on the penalised likelihood. ``(rows, cols)``:
    the features that are present in each row."""
    n, k = len(grades), grades_total - 1
    p = np.concatenate([np.zeros(n_features), [1.0], np.zeros(k - 1)])  # weights, theta_1, log gaps
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, steps + 1):
        gaps = np.exp(np.clip(p[n_features + 1:], -5, 5))
        theta = p[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, p[:n_features][cols], n)
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        upper, lower = sigmoid(cut[grades + 1] - score), sigmoid(cut[grades] - score)
        mass = np.maximum(upper - lower, 1e-12)
        d_up, d_low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        g_score = d_up - d_low  # d(-log mass) / d score
        g_theta = np.bincount(grades, -d_up, grades_total)[:k] + np.bincount(grades, d_low, grades_total)[1:]
        g = np.concatenate([np.bincount(cols, g_score[rows], n_features) + ridge * p[:n_features],
                            [g_theta.sum() + 0.01 * p[n_features]],
                            [g_theta[j:].sum() * gaps[j - 1] + 0.1 * p[n_features + j] for j in range(1, k)]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    gaps = np.exp(np.clip(p[n_features + 1:], -5, 5))
    return p[:n_features], p[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
          max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit on the labelled rows of ``docs(doc_id, text)``; ``labels(doc_id, quality, toxic)``."""
    toxic, poor = F.col("toxic").cast("int") > 0, F.coalesce(F.col("quality").cast("int"), F.lit(1)) <= 0
    graded = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
              .groupBy(F.col("doc_id").alias("id"))
              .agg(F.max(F.when(toxic & poor, 2).when(toxic, 1).otherwise(0)).alias("grade")))
    sample = graded.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    chosen = (docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
              .join(F.broadcast(sample), "id")  # at most max_rows pairs of numbers
              .dropDuplicates(["text"]).select("text", "grade"))

    def extract(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"grade": pdf["grade"], "found": [sorted(features(t)) for t in pdf["text"]]})

    seen = stage(map_slices(chosen, extract, "grade int, found array<string>", 128)
                 .withColumn("row", F.monotonically_increasing_id()), "toxicity-features")
    sizes = seen.agg(F.count(F.when(F.col("grade") > 0, 1)), F.count(F.when(F.col("grade") == 0, 1))).first()
    n_toxic, n_clean = float(sizes[0]), float(sizes[1])
    counts = (seen.select((F.col("grade") > 0).alias("bad"), F.explode("found").alias("feature"))
              .groupBy("feature").agg(F.count(F.when(F.col("bad"), 1)).alias("a"),
                                      F.count(F.when(~F.col("bad"), 1)).alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n_toxic + 1 - a)) - F.log(b / (n_clean + 1 - b))
    best = (counts.withColumns({"odds": odds, "z": odds / F.sqrt(1 / a + 1 / b)})
            .where((F.col("z") >= MIN_Z) & (F.col("odds") >= float(np.log(MIN_ODDS))))
            .orderBy(F.col("z").desc(), "feature").limit(max_features).select("feature"))
    names = sorted(r.feature for r in best.collect())  # at most max_features strings
    if not names:
        return OrdinalModel({}, [10.0 + k for k in range(GRADES - 1)])
    numbers = docs.sparkSession.createDataFrame(list(enumerate(names)), "col int, feature string")
    cells = (seen.select("row", F.explode("found").alias("feature")).join(F.broadcast(numbers), "feature")
             .select("row", "col").orderBy("row", "col").toPandas())  # of the kept features only
    graded_rows = seen.select("row", "grade").orderBy("row").toPandas()
    rows = np.searchsorted(graded_rows["row"].to_numpy(), cells["row"].to_numpy())
    weights, thetas = fit_ordinal(rows, cells["col"].to_numpy(), graded_rows["grade"].to_numpy(), len(names))
    return OrdinalModel(dict(zip(names, weights.tolist())), thetas.tolist())


def score(docs: DataFrame, model: OrdinalModel, name: str = "toxicity") -> DataFrame:
    """``docs`` with a struct of that name: ``severity`` (expected grade), ``p_toxic``, ``grade``
    (the most probable one) and ``rejected``."""
    @F.pandas_udf("severity double, p_toxic double, grade int, rejected boolean")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            above = np.array([model.at_least(t) for t in texts]).reshape(len(texts), len(model.thetas))
            each = np.diff(np.column_stack([np.zeros(len(texts)), 1 - above, np.ones(len(texts))]), axis=1)
            yield pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0],
                                "grade": each.argmax(axis=1).astype("int32"),
                                "rejected": above[:, 0] >= REJECT_AT})
            del texts, above, each
            release_memory()
    return docs.withColumn(name, rate(text_or_empty()))
