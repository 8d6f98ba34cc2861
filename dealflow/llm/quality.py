"""Document quality from line marginals of a conditional random field."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dealflow.llm.common import add_columns
from dealflow.llm.crf import Crf, fit_on_labels, line_features, weighted
from dealflow.llm.toxicity import logistic


class QualityModel:
    """A CRF over lines and the calibration of its length-weighted mean marginal."""

    def __init__(self, crf: Crf, good: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.crf, self.weights = crf, None
        if len(y) and 0 < y.mean() < 1:
            self.weights = logistic(self.inputs(good), y, weight, ridge=1e-2)

    @staticmethod
    def inputs(good: np.ndarray) -> np.ndarray:
        p = np.clip(good, 1e-4, 1 - 1e-4)
        return np.stack([np.log(p / (1 - p)), np.ones(len(p))], 1)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        x, chars, first = line_features(texts)
        p = self.crf.marginals(x, first)
        good = weighted(p, chars, first)
        score = good if self.weights is None else 1 / (1 + np.exp(-np.clip(self.inputs(good) @ self.weights, -30, 30)))
        return score, np.split(p, first[1:-1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", max_train: int = 8_000) -> QualityModel:
    """See ``fit_on_labels``; without rows of both labels the score is the uncalibrated mean."""
    return QualityModel(*fit_on_labels(docs, labels, text, label, max_train))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", prefix: str = "", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``lines``, P(good) of each line by forward-backward.

    A null or empty text is one empty line and scores as the model judges such a line. Texts
    are taken whole, in time and memory linear in their length. Repeated rows score alike.
    Columns named like the new ones (``prefix`` goes before them) are replaced; ``keep`` names
    the columns to return. No rows give no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some dozens of numbers

    def make():
        def compute(texts):
            score, lines = shared.value.scores(texts)
            return [score.tolist(), [p.tolist() for p in lines]]

        return compute

    return add_columns(docs, text, [(prefix + "score", T.DoubleType()), (prefix + "lines", T.ArrayType(T.DoubleType()))], make, keep)
