"""Element-wise activation functions as Column -> Column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed constants of the GeLU tanh approximation.
GELU_C = math.sqrt(2.0 / math.pi)
GELU_CUBIC = 0.044715


def relu(x: Column) -> Column:
    return F.when(x > 0, x).otherwise(F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def tanh(x: Column) -> Column:
    return F.tanh(x)


def gelu(x: Column) -> Column:
    return F.lit(0.5) * x * (F.lit(1.0) + F.tanh(F.lit(GELU_C) * (x + F.lit(GELU_CUBIC) * x * x * x)))


ACTIVATIONS = {"relu": relu, "sigmoid": sigmoid, "tanh": tanh, "gelu": gelu}
