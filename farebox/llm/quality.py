"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import whole_text
from farebox.llm.rules import statistics
from farebox.session import checkpointed

#: How far a class covariance is drawn towards that of both classes, and then towards a multiple of unity.
POOLED, SHRINKAGE = 0.3, 0.02
FLOOR = 1e-3
THRESHOLD = 0.3


class Model(NamedTuple):
    """Per class (0, 1): mean, inverse of the covariance's Cholesky factor, log of prior over density scale.

    ``constant`` replaces the score where a class has no examples to learn from.
    """

    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]
    constant: float | None


def features(text: Column) -> dict[str, Column]:
    """Statistics of the whole text, made nearly normal by logarithms; all are finite, also without words.

    A few words or lines more in every denominator keep shares of short texts from running wild.
    """
    s = F.col("s")
    n = F.greatest(s["w"]["n_words"], F.lit(1))
    lines = F.greatest(s["l"]["n_lines"], F.lit(1))
    chars = F.greatest(s["word_chars"], F.lit(1))

    def share(part: Column, whole: Column, more: int) -> Column:
        return F.log(part / (whole + more) + 0.01)

    return {
        "x_words": F.log1p(s["w"]["n_words"]),
        "x_word_chars": F.log1p(s["word_chars"] / n),
        "x_symbols": share(s["n_symbols"], n, 5),
        "x_shouts": share(s["shouts"], n, 5),
        "x_upper": share(s["upper"], chars, 30),
        "x_digits": share(s["digits"], chars, 30),
        "x_plain": share(s["alphabetic"], n, 0),
        "x_stops": share(s["w"]["stop_words"], n, 5),
        "x_repeats": share(s["w"]["n_repeat_words"], n, 5),
        "x_dup_lines": share(s["l"]["n_dup_lines"], lines, 2),
        "x_line_words": F.log1p(n / lines),
    }


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every row, in one projection; the text is the only input."""
    text = whole_text(docs)
    counted = docs.select(
        docs["doc_id"],
        F.transform(
            F.array(statistics(text)),
            lambda s: s.withField("upper", F.regexp_count(text, F.lit("[A-Z]"))).withField(
                "digits", F.regexp_count(text, F.lit("[0-9]"))
            ),
        )[0].alias("s"),
    )
    return counted.select("doc_id", *[v.cast("double").alias(k) for k, v in features(F.col("s")).items()])


def fit(rows: DataFrame, label: str, names: list[str], pooled: float = POOLED, shrinkage: float = SHRINKAGE) -> Model:
    """Class means and covariances from sums of the rows; a class is a fixed number of sums for the driver.

    Covariances are those of features divided by their overall deviation. Each is drawn towards that of
    both classes by ``pooled`` and towards the mean of its diagonal by ``shrinkage``, and ``FLOOR`` is
    added, so that it has a Cholesky factor.
    """
    d = len(names)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.count("*").alias("n")]
    sums += [F.sum(names[i]).alias(f"s{i}") for i in range(d)]
    sums += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]
    got = {int(r[label]): r for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(*sums).collect()}
    count = [got[c]["n"] if c in got else 0 for c in (0, 1)]
    total = sum(count)
    if min(count) < 2:
        return Model(np.ones(d), [], [], [], (count[1] + 1) / (total + 2))
    means, covs = [], []
    for c in (0, 1):
        mean = np.array([got[c][f"s{i}"] for i in range(d)]) / count[c]
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = got[c][f"p{i}_{j}"] / count[c]
        means.append(mean)
        covs.append(second - np.outer(mean, mean))
    middle = sum(count[c] * means[c] for c in (0, 1)) / total
    spread = sum(count[c] * (np.diag(covs[c]) + (means[c] - middle) ** 2) for c in (0, 1)) / total
    scale = np.sqrt(np.where(spread > 1e-9, spread, 1.0))  # a constant feature tells nothing
    factors, offsets = [], []
    both = sum(count[c] * covs[c] for c in (0, 1)) / total
    for c in (0, 1):
        cov = ((1 - pooled) * covs[c] + pooled * both) / np.outer(scale, scale)
        cov = (1 - shrinkage) * cov + (shrinkage * np.trace(cov) / d + FLOOR) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        offsets.append(math.log(count[c] / total) - float(np.log(np.diag(lower)).sum()))
    return Model(scale, [m / scale for m in means], factors, offsets, None)


def score(model: Model, names: list[str]) -> Column:
    """Probability of label 1: the logistic of the difference of the two log densities."""
    if model.constant is not None:
        return F.lit(model.constant)

    def log_density(c: int) -> Column:
        off = [F.col(n) / float(s) - float(m) for n, s, m in zip(names, model.scale, model.means[c])]
        distance = F.lit(0.0)
        for i, row in enumerate(model.factors[c]):
            z = F.lit(0.0)
            for j in range(i + 1):
                z = z + float(row[j]) * off[j]
            distance = distance + z * z
        return F.lit(model.offsets[c]) - distance / 2

    return 1 / (1 + F.exp(F.least(log_density(0) - log_density(1), F.lit(700.0))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Learns from all labelled rows that are not held out. A null text scores as an empty one; null labels
    teach nothing; a null doc_id has no label and is not held out; without two examples of each label
    every score is the smoothed share of label 1.
    """
    x = checkpointed(described(docs))
    names = [c for c in x.columns if c.startswith("x_")]
    marks = labels.select(labels["doc_id"].alias("labelled"), labels["quality"].alias("quality"))
    known = x.where(~held_out(F.col("doc_id"))).join(marks, F.col("doc_id") == F.col("labelled"))
    model = fit(known, "quality", names)
    result = x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, names).alias("score"))
    return result.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
