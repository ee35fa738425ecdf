"""Toxicity: a cumulative-link ordinal regression over sparse word features.

P(severity > k) = sigmoid(w . x - theta_k), k = 0 .. K-2, with one weight vector w shared by all
ordered thresholds theta_0 < theta_1 < ...; the score is the expected severity, sum_k P(severity > k).

x is sparse: log(1 + count) of the words and word beginnings (four code points) whose document frequency differs between graded and
ungraded training rows: all those that a false-discovery rate of `fdr` lets through (Benjamini and Hochberg), in five
training rows at least; `min_z`, where given, is a fixed number of standard errors instead.  Training reads a bounded sample
(`sample_per_side` rows on each side of the first threshold, the first in order of a hash of the id);
scoring reads every whole text once, without a shuffle, and ships only the word weights, whose number
is bounded by the words of the sample.

Null text: empty.  Empty text: no features, the score of the thresholds alone.  Null grades are not
learned from; several grades of one id: the highest; several texts of one id: the least.  Repeated rows: scored alike, one row each.
Empty tables: an empty result; no graded row: severity 0 for every row.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.shared import each, give_back, text_bytes

#: Lower-case A-Z, and every other ASCII character that is no digit or letter is white space.
_TABLE = bytes(c if c > 127 or chr(c).isdigit() or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def parts(term: bytes) -> tuple[bytes, bytes]:
    """The features of a word: itself, and its first four code points behind a caret."""
    return term, b"^" + term.decode("utf-8", "replace")[:4].encode()


def feature_counts(text: bytes) -> Counter:
    out: Counter = Counter()
    for term, n in Counter(terms(text)).items():
        for f in parts(term):
            out[f] += n
    return out


class _Hits(dict):
    """Word -> its features that the model weighs; remembered up to a bound."""

    def __init__(self, weights: dict[bytes, float], bound: int = 300_000):
        super().__init__()
        self.weights, self.bound = weights, bound

    def __missing__(self, term: bytes) -> tuple[bytes, ...]:
        if len(self) >= self.bound:
            self.clear()
        self[term] = out = tuple(f for f in parts(term) if f in self.weights)
        return out


@dataclass(frozen=True)
class SeverityModel:
    weights: dict[bytes, float]
    thresholds: tuple[float, ...]
    flag_at: float = 0.5

    def score(self, text: bytes, hits: _Hits | None = None) -> tuple[float, float]:
        """(expected severity, probability of any severity)."""
        if not self.thresholds:
            return 0.0, 0.0
        weights, hits = self.weights, _Hits(self.weights) if hits is None else hits
        found = Counter([f for fs in filter(None, map(hits.__getitem__, terms(text))) for f in fs])
        at = sum(weights[f] * math.log1p(n) for f, n in sorted(found.items()))
        above = [1 / (1 + math.exp(-max(-60.0, min(60.0, at - x)))) for x in self.thresholds]
        return sum(above), above[0]


def _sample(documents: DataFrame, grades: DataFrame, id_col: str, text_col: str, per_side: int) -> list:
    g = grades.where("grade is not null and id is not null").groupBy("id").agg(F.max("grade").alias("grade"))
    pick = lambda rows: rows.orderBy(F.xxhash64("id"), "id").limit(per_side)
    chosen = pick(g.where("grade > 0")).unionAll(pick(g.where("grade <= 0")))  # at most 2 * per_side rows
    docs = documents.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    found = docs.join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))

    def counted(batches):
        for b in batches:
            out = [b" ".join(b"%s %d" % x for x in sorted(feature_counts(t).items())) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["grade", "terms"])

    rows = found.select("grade", "text").mapInArrow(counted, "grade long, terms binary").collect()
    return [(r.grade, dict(zip((x := bytes(r.terms).split())[::2], map(int, x[1::2])))) for r in rows]


def _z_bound(z: dict[bytes, float], min_z: float | None, fdr: float) -> float:
    """The least |z| that is kept: `min_z`, or where at most a share `fdr` of the kept features is expected by chance."""
    if min_z is not None:
        return min_z
    far = sorted(map(abs, z.values()), reverse=True)
    passed = [x for i, x in enumerate(far, 1) if math.erfc(x / math.sqrt(2)) <= fdr * i / len(far)]
    return math.nextafter(passed[-1], 0) if passed else math.inf


def _z_scores(rows: list[tuple[int, dict]]) -> dict[bytes, float]:
    n = [max(1, sum(g <= 0 for g, _ in rows)), max(1, sum(g > 0 for g, _ in rows))]
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for g, x in rows:
        seen[g > 0].update(x.keys())
    out = {}
    for w in seen[0].keys() | seen[1].keys():
        a, b = seen[0][w], seen[1][w]
        if a + b >= 5:
            p = (a + b + 1) / (n[0] + n[1] + 2)
            out[w] = (b / n[1] - a / n[0]) / math.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1]))
    return out


def _thresholds(raw: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first, then steps up."""
    return raw[0] + np.r_[0.0, np.cumsum(np.exp(raw[1:]))]


def _loss(params: np.ndarray, dot, back, y: np.ndarray, top: int, ridge: float) -> tuple[float, np.ndarray]:
    """Minus the mean log-likelihood of the cumulative-link model, with the ridge, and its gradient.

    P(y = k) = F(w x - theta_(k-1)) - F(w x - theta_k), F the logistic function, F = 1 below the first grade and 0 above the last.
    `dot(w)` gives w x of all rows, `back(d)` the sum over rows of d x.
    """
    n = len(params) - top
    w, raw = params[:n], params[n:]
    theta = _thresholds(raw)
    above = 1 / (1 + np.exp(-np.clip(dot(w)[:, None] - theta[None, :], -60, 60)))
    above = np.c_[np.ones(len(y)), above, np.zeros(len(y))]  # P(grade >= 0), ..., P(grade > top)
    rows = np.arange(len(y))
    a, b = above[rows, y], above[rows, y + 1]
    p = np.maximum(a - b, 1e-300)
    d_eta = -(1 - a - b) / len(y)
    g_theta = np.zeros(top + 2)
    np.add.at(g_theta, y, a * (1 - a) / p / len(y))
    np.add.at(g_theta, y + 1, -b * (1 - b) / p / len(y))
    g_theta = g_theta[1:-1]
    g_raw = np.r_[g_theta.sum(), np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(raw[1:])]
    return float(-np.log(p).mean() + ridge * (w @ w) / 2), np.r_[back(d_eta) + ridge * w, g_raw]


def fit_severity(rows: list[tuple[int, dict]], min_z: float | None = None, fdr: float = 0.01, ridge: float = 1e-5, steps: int = 800) -> SeverityModel:
    """Maximum likelihood of the ordinal model, with a ridge on the weights, by Adam.

    Grades are 0, 1, 2, ...; those features take part that tell the graded from the ungraded rows.
    """
    top = max((g for g, _ in rows), default=0)
    if top < 1 or all(g > 0 for g, _ in rows):
        return SeverityModel({}, ())
    z = _z_scores(rows)
    bound = _z_bound(z, min_z, fdr)
    words = sorted((w for w in z if abs(z[w]) > bound), key=lambda w: (-abs(z[w]), w))
    at = {w: i for i, w in enumerate(words)}
    cells = [(i, at[w], math.log1p(n)) for i, (_, counts) in enumerate(rows) for w, n in counts.items() if w in at]
    row, col, x = map(np.array, zip(*cells)) if cells else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    dot = lambda w: np.bincount(row, x * w[col], len(rows))
    y = np.maximum([g for g, _ in rows], 0).astype(int)
    params = np.zeros(len(words) + top)
    params[len(words)] = 1.0
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        _, grad = _loss(params, dot, lambda d: np.bincount(col, x * d[row], len(words)), y, top, ridge)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))  # less and less in the second half
        params -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    w, theta = params[: len(words)], _thresholds(params[len(words) :])
    # A row counts as toxic from the probability that parts the training rows best, one half at most.
    p = 1 / (1 + np.exp(-np.clip(dot(w) - theta[0], -60, 60)))
    marks = np.r_[np.unique(p[y > 0]), 0.5]
    gain = [(p[y > 0] >= t).mean() - (p[y == 0] >= t).mean() for t in marks]
    best = marks[int(np.argmax(gain))]
    below = p[(y == 0) & (p < best)].max(initial=0.0)
    flag_at = min(0.5, (best + below) / 2) if max(gain) > 0.1 else 0.5
    return SeverityModel({k: float(x) for k, x in zip(words, w)}, tuple(map(float, theta)), float(flag_at))


def severity_model(documents: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", grade_col="toxic", graver_col: str | None = None, sample_per_side=3000, min_z=None, fdr=0.01) -> SeverityModel:
    """Grades are the numbers of `grade_col`.  Where that is a yes or no, `graver_col` may tell the graver ones of its ones
    (0: graver), so that there are two thresholds; the grades never depend on the words they are learned from."""
    grade = F.col(grade_col).cast("long")
    if graver_col:
        grade = grade + F.when((grade > 0) & F.coalesce(F.col(graver_col) == 0, F.lit(False)), 1).otherwise(0)
    rows = _sample(documents, labels.select(F.col(id_col).alias("id"), grade.alias("grade")), id_col, text_col, sample_per_side)
    rows.sort(key=lambda r: (r[0], sorted(r[1].items())[:50]))
    return fit_severity(rows, min_z, fdr)


def score_severity(documents: DataFrame, model: SeverityModel, id_col="doc_id", text_col="text") -> DataFrame:
    """id, expected_severity, p_toxic (severity of 1 or more), toxic (p_toxic at least the fitted mark); a row for each row."""

    @F.arrow_udf("struct<expected_severity: double, p_toxic: double>")
    def scored(text: pa.Array) -> pa.Array:
        hits = _Hits(model.weights)
        both = [model.score(t, hits) for t in each(text)]
        give_back()
        return pa.StructArray.from_arrays([pa.array([b[i] for b in both], pa.float64()) for i in (0, 1)], ["expected_severity", "p_toxic"])

    return documents.select(F.col(id_col), scored(text_bytes(text_col)).alias("s")).select(id_col, "s.expected_severity", "s.p_toxic", (F.col("s.p_toxic") >= model.flag_at).alias("toxic"))
