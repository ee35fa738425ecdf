"""Quality classifier: a regularised quadratic discriminant over transformed text statistics.

Each class has a mean and a shrunken covariance, S_k(a, b) = (1-b) [(1-a) S_k + a S_pooled] + b diag;
the score is the logistic of the difference of the log-densities (Mahalanobis distances through cached
Cholesky factors) plus the log prior odds.  Labels are learned from a bounded sample of rows
(`sample_per_class` rows of each class outside the held-out fold, in order of a hash of the id);
every whole text is scored in one pass, without a shuffle.  Only the text enters a score.

Null text: empty.  Empty text: statistics of nought, scored like any other.  Null labels are not
learned from; several labels of an id: the highest; several texts of an id: the one of the least statistics.  Repeated rows: one result each.  Fewer than two
classes to learn from: score 1 for every row.  Empty tables: an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.llm.shared import each, fold_of, give_back, text_bytes
from docledger.llm.textstats import text_stats


def features(text: bytes) -> list[float]:
    """Statistics, transformed so that clean prose is roughly normal."""
    s = text_stats(text)
    n, letters = s.n_words + 1.0, s.n_upper + s.n_lower + 1.0
    log = lambda share: np.log(share + 1e-3)
    return [
        np.log(n),
        s.word_chars / n,
        log(s.n_symbols / n),
        log(s.n_upper / letters),
        log(s.n_exclaim / n),
        log(s.n_digits / (s.word_chars + 1.0)),
        np.log((s.n_distinct + 1.0) / n),
        log(s.n_adjacent / n),
        log(s.n_top / n),
        log(s.n_repeat_words / n),
        log(s.n_dup_lines / (s.n_lines + 1.0)),
        np.log((s.n_lines + 1.0) / n),
    ]


@dataclass(frozen=True)
class QuadraticModel:
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]  # of each class, the inverse of its covariance's Cholesky factor
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(self.means) < 2:
            return np.ones(len(x))
        density = []
        for mean, low in zip(self.means, self.factors):
            z = (x - mean) @ low.T  # `low` whitens: the inverse of the Cholesky factor
            density.append(-0.5 * (z * z).sum(1) + np.log(np.diag(low)).sum())
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -500, 500)))


def fit_quadratic(x: np.ndarray, y: np.ndarray, priors: tuple[float, float], pooled: float = 0.1, ridge: float = 0.02) -> QuadraticModel:
    if len(set(y.tolist())) < 2:
        return QuadraticModel((), (), 0.0)
    parts = [x[y == k] for k in (0, 1)]
    means = tuple(p.mean(0) for p in parts)
    spread = [(p - m).T @ (p - m) / max(1, len(p) - 1) for p, m in zip(parts, means)]
    both = sum(s * (len(p) - 1) for s, p in zip(spread, parts)) / max(1, len(x) - 2)
    scale = np.diag(np.maximum(np.diag(both), 1e-6))
    shrunk = [(1 - ridge) * ((1 - pooled) * s + pooled * both) + ridge * scale for s in spread]
    return QuadraticModel(means, tuple(np.linalg.inv(np.linalg.cholesky(s)) for s in shrunk), float(np.log(priors[1] / priors[0])))


def quality_model(documents: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", folds=5, held_out_fold=0, sample_per_class=4000) -> QuadraticModel:
    """Learn from labels outside the held-out fold only."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold_of(id_col, folds) != held_out_fold))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return QuadraticModel((), (), 0.0)
    pick = lambda k: known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(sample_per_class)
    chosen = pick(0).unionAll(pick(1))  # at most 2 * sample_per_class rows
    docs = documents.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    found = docs.join(F.broadcast(chosen), "id").select("id", "label", statistics(F.col("text")).alias("x")).groupBy("id", "label").agg(F.min("x").alias("x"))
    rows = sorted(found.collect())
    if not rows:
        return QuadraticModel((), (), 0.0)
    total = sum(counts.values())
    return fit_quadratic(np.array([r.x for r in rows]), np.array([r.label for r in rows]), (counts[0] / total, counts[1] / total))


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(text: pa.Array) -> pa.Array:
    return pa.array([features(t) for t in each(text)], pa.list_(pa.float64()))


def score_column(model: QuadraticModel, text_col: str = "text"):
    @F.arrow_udf(T.DoubleType())
    def scored(text: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in each(text)], float).reshape(len(text), -1)
        give_back()
        return pa.array(model.score(x), pa.float64())

    return scored(text_bytes(text_col))


def score_quality(documents: DataFrame, model: QuadraticModel, id_col="doc_id", text_col="text", folds=5, held_out_fold=0, threshold=0.3) -> DataFrame:
    """id, held_out, score, predicted; a row for each row."""
    out = documents.select(F.col(id_col), (fold_of(id_col, folds) == held_out_fold).alias("held_out"), score_column(model, text_col).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(documents: DataFrame, model: QuadraticModel, text_col="text", threshold=0.3) -> DataFrame:
    """The rows, whole and unchanged, that the classifier doesn't reject."""
    return documents.where(score_column(model, text_col) >= threshold)
