"""Scoring of stored rows with a model of the tenant."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_BYTES = 256 * 1024 * 1024


Predict = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class LinearModel:
    """Intercept plus weighted features; it can run as a plain column expression."""

    intercept: float
    weights: Mapping[str, float]

    def column(self) -> Column:
        result = F.lit(float(self.intercept))
        for name, weight in self.weights.items():
            result = result + F.col(name).cast("double") * F.lit(float(weight))
        return result

    def predictor(self) -> Predict:
        """The same as a function of a matrix with a column per feature."""
        intercept, weights = float(self.intercept), [float(weight) for weight in self.weights.values()]

        def predict(features: np.ndarray) -> np.ndarray:
            result = np.full(len(features), intercept)
            for position, weight in enumerate(weights):
                result = result + features[:, position] * weight
            return result

        return predict


def score(df: DataFrame, model: LinearModel, output: str = "score") -> DataFrame:
    """A linear model needs no Python at all."""
    return df.withColumn(output, model.column())


def score_batches(df: DataFrame, predict: Predict, features: Sequence[str], output: str = "score") -> DataFrame:
    """Any model, given as a function such as ``model.predict``: Arrow batches go through it.

    The model is broadcast once, if it is small enough. Rows with a missing feature get a NULL score.
    """
    packed = cloudpickle.dumps(predict)
    if len(packed) > MODEL_BYTES:
        raise ValueError(f"model of {len(packed)} bytes is too large to broadcast; let predict() load it from storage")
    shared = df.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = pickle.loads(shared.value)
        for columns in batches:
            matrix = np.column_stack([column.to_numpy(dtype="float64", na_value=np.nan) for column in columns])
            whole = ~np.isnan(matrix).any(axis=1)
            scores = np.full(len(matrix), np.nan)
            if whole.any():
                scores[whole] = model(matrix[whole])
            yield pd.Series(scores).where(whole)

    return df.withColumn(output, scored(*[F.col(name).cast("double") for name in features]))
