"""A fixed linear scorer: a stated formula in place of a fitted model.

Useful where a score must be reproducible outside Spark ML, e.g. to test the
batch and streaming serving paths, or as a hand-set baseline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class LinearScorer:
    """P(class 1) = 1 / (1 + exp(-(intercept + sum of weight x input))), null inputs as 0."""

    def __init__(self, intercept: float, weights: dict[str, float]):
        self.intercept, self.weights = intercept, dict(weights)

    def transform(self, df: DataFrame, prob: str) -> DataFrame:
        z = F.lit(self.intercept)
        for c, w in self.weights.items():
            z = z + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        return df.select("*", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(prob))
