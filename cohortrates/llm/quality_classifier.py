"""Document quality by regularised quadratic discriminant analysis of text statistics.

Each class has a mean and a covariance of its own; the covariance is shrunk towards the pooled one and
towards a multiple of the identity. A score is the logistic of the difference of log-densities, each a
Mahalanobis distance through the cached inverse of a Cholesky factor. Counts, sums and sums of products
per class are one aggregate over all labelled rows, and the score is an expression of the statistics,
so documents are neither sampled nor moved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled, sheltered
from .quality_rules import text_statistics

#: Statistics after transformation: logarithms of sizes, roots of shares.
FEATURES = {
    "size": "ln(1 + n_words)",
    "word_length": "ln(1 + word_chars / (n_words + 1D))",
    "line_length": "ln(1 + n_words / double(n_lines))",
    "symbols": "sqrt(n_symbols / (word_chars + 1D))",
    "repeats": "sqrt(n_repeat_words / (n_words + 1D))",
    "dup_lines": "sqrt(n_dup_lines / double(n_lines))",
    "capitals": "sqrt(n_capitals / (word_chars + 1D))",
    "marks": "sqrt(n_marks / (n_words + 1D))",
}

#: Weight of the pooled covariance, and of the identity, in each class's own.
POOLED, SPHERE = 0.5, 0.1

#: A score from which a document counts as good.
THRESHOLD = 0.7


@dataclass(frozen=True)
class Gaussian:
    """A class: log of its share, mean, and inverse Cholesky factor and log-determinant of its covariance."""

    log_share: float
    mean: np.ndarray
    whiten: np.ndarray
    log_det: float


@dataclass(frozen=True)
class Discriminant:
    bad: Gaussian
    good: Gaussian

    def score(self) -> Column:
        """The probability of the good class, of a row that has the feature columns."""

        def density(g: Gaussian) -> str:
            names = list(FEATURES)
            rows = []
            for i in range(len(names)):
                terms = " + ".join(f"{float(g.whiten[i, j])!r}D * (f_{names[j]} - {float(g.mean[j])!r}D)" for j in range(i + 1))
                rows.append(f"power({terms}, 2)")
            return f"({g.log_share - g.log_det / 2!r}D - 0.5D * ({' + '.join(rows)}))"

        gap = f"least(500D, greatest(-500D, {density(self.bad)} - {density(self.good)}))"
        return F.expr(f"1D / (1D + exp({gap}))")


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and one column per feature. An empty or null text has features like any other."""
    stats = text_statistics(docs, keep)
    return stats.select(*[F.col(f"`{c}`") for c in keep], *[F.expr(e).alias(f"f_{n}") for n, e in FEATURES.items()])


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id's text leaves 2 when divided by 4; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(rows: DataFrame, labels: DataFrame, pooled: float = POOLED, sphere: float = SPHERE) -> Discriminant:
    """Learn from rows (doc_id and features) that have a label and are not held out.

    Null labels are left out; a label given twice counts once. A class without rows gets the pooled
    covariance and mean, so that only the shares decide.
    """
    names = [f"f_{n}" for n in FEATURES]
    labels, _ = sheltered(labels, "doc_id", "quality")
    known = labels.where("quality IN (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    train = rows.where(~held_out(F.col("doc_id"))).join(known, "doc_id")
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = train.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(n).alias(f"s_{n}") for n in names],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p_{i}_{j}") for i, j in pairs],
    )
    d = len(names)
    count, total, product = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for r in sums.collect():  # two rows at most
        k = r.quality
        count[k], total[k] = r.n, [r[f"s_{n}"] for n in names]
        for i, j in pairs:
            product[k, i, j] = product[k, j, i] = r[f"p_{i}_{j}"]
    all_n = max(count.sum(), 1)
    mean = np.array([total[k] / count[k] if count[k] else total.sum(0) / all_n for k in range(2)])
    scatter = np.array([product[k] - count[k] * np.outer(mean[k], mean[k]) for k in range(2)])
    common = scatter.sum(0) / all_n + 1e-6 * np.eye(d)
    made = []
    for k in range(2):
        own = scatter[k] / count[k] if count[k] else common
        cov = (1 - pooled - sphere) * own + pooled * common + sphere * np.trace(common) / d * np.eye(d)
        factor = np.linalg.cholesky(cov)
        made.append(Gaussian(float(np.log((count[k] + 1) / (count.sum() + 2))), mean[k], np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum())))
    return Discriminant(*made)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted. Only doc_id and text are read.

    Texts are read once; labels meet the statistics, not the texts. Equal rows get equal scores; an
    empty table gives none.
    """
    docs, _ = sheltered(docs, "doc_id", "text")
    rows = settled(features(docs, ["doc_id"]), "document-features")
    score = fit(rows, labels).score()
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns whatever their names."""
    docs, restored = sheltered(docs, "doc_id", "text")
    # written with the texts: the statistics take longer than that, and are needed twice
    rows = settled(features(docs, docs.columns), "documents-with-features")
    return restored(rows.where(fit(rows, labels).score() >= threshold))
