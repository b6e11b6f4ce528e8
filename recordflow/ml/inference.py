"""Batched model inference with a pluggable loader."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, types as T


def batch_predictor(
    load: Callable[[], Callable[[np.ndarray], np.ndarray]],
    width: int,
    return_type: T.DataType | None = None,
    batch_size: int = 4096,
) -> Callable[[Column], Column]:
    """A column function that scores array columns of ``width`` numbers in Arrow batches.

    ``load`` runs once per Python worker and returns the model: a function from a matrix of
    inputs to one output row per input. The record id simply stays a column next to the result.
    """
    return predict_batch_udf(
        load,
        return_type=return_type or T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[width]],
    )


def linear_model(weights: list[float], bias: float = 0.0):
    """Loader for a linear model given by its weights."""

    def load():
        w = np.asarray(weights, dtype=np.float64)
        return lambda x: np.asarray(x, dtype=np.float64) @ w + bias

    return load


def affine_encoder(matrix: list[list[float]], bias: list[float]):
    """Loader for an encoder given by outside weights: one latent vector per input."""

    def load():
        m, b = np.asarray(matrix, dtype=np.float64), np.asarray(bias, dtype=np.float64)
        return lambda x: np.asarray(x, dtype=np.float64) @ m + b

    return load
