"""Quality classifier: regularised quadratic discriminant analysis over transformed statistics of whole texts.

Each class has a normal density whose covariance is shrunk towards the pooled one and towards a floor on the diagonal.
All labelled rows that may be learned from take part: the table only sends sums, so a fit needs two rows on the driver
however many labels there are. Scores are the logistic of the tempered difference of log densities, with the Mahalanobis
terms taken from Cholesky factors that are computed once and become literals of a native expression.

Nulls: a null text is empty and scored as such; null ids are never learned from; null labels don't count. Of several
labels of one id the least counts. Repeated rows are scored alike. An empty table, or one without labels of both
classes, still scores: by the classes that exist, 0.5 if there are none. A column named score is replaced; others may
have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import need, written
from .text_stats import fields, style_statistics, with_statistics


@dataclass(frozen=True)
class Shrinkage:
    """pooled: share of the pooled covariance; floor: standard deviation added to each statistic."""

    pooled: float = 0.05
    floor: float = 0.02
    temper: float = 3.0


@dataclass(frozen=True)
class Discriminant:
    """Per class 0 and 1: log prior less half the log determinant, mean, and inverse of the Cholesky factor."""

    offsets: tuple[float, float]
    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    temper: float


def vector() -> dict[str, Column]:
    """Ratios held towards a prior of 50 words, as roots or logs, so that texts of any length are comparable."""
    n = lambda name: F.col("__s")[name]
    words, chars = n("n_words") + 50.0, n("word_chars") + 300.0
    return {
        "x_length": F.log(chars / words),
        "x_symbols": F.sqrt(n("n_symbols") / chars),
        "x_upper": F.sqrt(n("n_upper") / chars),
        "x_marks": F.sqrt(n("n_marks") / chars),
        "x_codes": F.sqrt(n("n_codes") / chars),
        "x_variety": F.log(n("n_distinct_words") + 50.0) / F.log(words),
        "x_echo": F.sqrt(n("n_echo_words") / words),
        "x_lines": F.sqrt(n("n_dup_lines") / words),
    }


X = ["x_length", "x_symbols", "x_upper", "x_marks", "x_codes", "x_variety", "x_echo", "x_lines"]


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` as the struct __doc, and the transformed statistics, written once."""
    need(docs, text)
    counted = with_statistics(docs, style_statistics, text)
    kept = F.struct(*fields(counted, "__doc", text)).alias("__doc")
    return written(counted.select(kept, *[c.alias(n) for n, c in vector().items()]))


def fit(rows: DataFrame, label: str, shrinkage: Shrinkage = Shrinkage()) -> Discriminant:
    """From rows with the statistics and a label of 0 or 1: one aggregation of sums by class."""
    pairs = [(i, j) for i in range(len(X)) for j in range(i + 1)]
    sums = (
        rows.where(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("c"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in pairs],
        )
        .collect()
    )
    p, by = len(X), {r["c"]: r for r in sums}
    counts, means, covs = [0, 0], [np.zeros(p), np.zeros(p)], [np.zeros((p, p)), np.zeros((p, p))]
    for c, r in by.items():
        counts[c], means[c] = r["n"], np.array([r[f"s{i}"] for i in range(p)]) / r["n"]
        for i, j in pairs:
            covs[c][i, j] = covs[c][j, i] = r[f"s{i}_{j}"] / r["n"] - means[c][i] * means[c][j]
    total = max(1, sum(counts))
    pooled = sum(n * s for n, s in zip(counts, covs, strict=True)) / total
    whiten, offsets = [], []
    for n, s in zip(counts, covs, strict=True):
        own = n / (n + p)  # few rows lean on the pooled covariance
        share = shrinkage.pooled * own + (1 - own)
        factor = np.linalg.cholesky((1 - share) * s + share * pooled + shrinkage.floor**2 * np.eye(p))
        whiten.append(np.linalg.inv(factor))
        offsets.append(float(np.log((n + 1) / (total + 2)) - np.log(np.diag(factor)).sum()))
    if not all(counts):  # one class or none: the prior alone
        means, whiten = [means[0], means[0]], [whiten[0], whiten[0]]
        offsets = [float(np.log((n + 1) / (total + 1))) for n in counts]
    return Discriminant(tuple(offsets), tuple(means), tuple(whiten), shrinkage.temper)


def _log_density(model: Discriminant, c: int) -> Column:
    far = F.lit(0.0)
    for i in range(len(X)):
        y = sum(
            ((F.col(X[j]) - float(model.means[c][j])) * float(model.whiten[c][i, j]) for j in range(i + 1)), F.lit(0.0)
        )
        far = far + F.pow(y, 2)
    return F.lit(model.offsets[c]) - far / 2


def score(model: Discriminant) -> Column:
    """The score (0 to 1) of transformed statistics; a native expression."""
    odds = (_log_density(model, 1) - _log_density(model, 0)) / model.temper
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    may_learn: Column,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    shrinkage: Shrinkage = Shrinkage(),
) -> DataFrame:
    """``docs`` without ``text`` and with score; learns from labelled rows for which ``may_learn`` (of the key) holds."""
    need(docs, key, text)
    need(labels, key, label)
    rows = statistics(docs, text)
    model = _learned(rows, labels, may_learn, label, key, shrinkage)
    return rows.select(*fields(rows, "__doc", "score"), score(model).alias("score"))


def _learned(rows: DataFrame, labels: DataFrame, may_learn: Column, label: str, key: str, shrinkage: Shrinkage) -> Discriminant:
    known = labels.where(may_learn & F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("__label"))
    return fit(rows.select(F.col("__doc")[key].alias(key), *X).join(known, key), "__label", shrinkage)


def accepted(
    docs: DataFrame, labels: DataFrame, may_learn: Column, least: float, label: str = "quality", key: str = "doc_id",
    text: str = "text", shrinkage: Shrinkage = Shrinkage(),
) -> DataFrame:
    """``docs`` whose score is at least ``least``, unchanged: a fit, then one pass over the texts without a shuffle."""
    need(docs, key, text)
    known = labels.where(may_learn & F.col(label).isNotNull()).select(key).distinct()
    rows = statistics(docs.select(key, text).join(known, key), text)
    model = _learned(rows, labels, may_learn, label, key, shrinkage)
    df = with_statistics(docs, style_statistics, text).select("__doc", *[c.alias(n) for n, c in vector().items()])
    return df.where(score(model) >= least).select(*fields(df, "__doc"))
