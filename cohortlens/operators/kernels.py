"""Polynomial kernels by tensor sketches: features whose dot products estimate (gamma x.y + shift)^degree.

Each of ``degree`` count sketches sends every component, with a sign, to one of
``width`` cells. Their convolution, a product of Fourier transforms, is a count
sketch of the full expansion, whose columns, millions at degree 5, are never
written out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from cohortlens.operators.passes import matrix
from cohortlens.operators.supervised import fit_predict, linear_svm
from cohortlens.session import checkpointed

#: Costs fitted at a time, each with its own cached blocks of the training rows.
PARALLEL_FITS = 4


@dataclass
class TensorSketch:
    """The draws of a sketch; the same seed gives the same features everywhere."""

    degree: int
    inputs: int
    width: int
    gamma: float = 1.0
    shift: float = 1.0
    seed: int = 1

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        size = self.inputs + 1  # the shift is one more component
        self.waves = []
        for _ in range(self.degree):
            plane = np.zeros((size, self.width))
            plane[np.arange(size), rng.integers(0, self.width, size)] = rng.choice([-1.0, 1.0], size)
            self.waves.append(np.fft.rfft(plane, axis=1))

    def widened(self, x: np.ndarray) -> np.ndarray:
        return np.c_[math.sqrt(self.gamma) * x, np.full(len(x), math.sqrt(self.shift))]

    def features(self, x: np.ndarray) -> np.ndarray:
        z, product = self.widened(x), 1
        for wave in self.waves:
            product = product * (z @ wave)
        return np.fft.irfft(product, n=self.width, axis=1)

    def kernel(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The kernel itself, row by row."""
        return (self.gamma * (x * y).sum(axis=1) + self.shift) ** self.degree

    def spread(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """A bound on the standard deviation of the estimate: sqrt((2 + 3^degree) / width) |x|^degree |y|^degree."""
        sizes = [(self.widened(v) ** 2).sum(axis=1) ** (self.degree / 2) for v in (x, y)]
        return math.sqrt((2 + 3 ** self.degree) / self.width) * sizes[0] * sizes[1]


def polynomial_sketch(df: DataFrame, sketch: TensorSketch, source: str = "features") -> DataFrame:
    """Add ``vector`` of the sketch's features."""
    @F.pandas_udf("array<double>")
    def lift(rows: pd.Series) -> pd.Series:
        return pd.Series(list(sketch.features(matrix(rows))))

    return df.withColumn("vector", array_to_vector(lift(F.col(source))))


def estimates(pairs: DataFrame, sketch: TensorSketch, left: str = "x", right: str = "y") -> DataFrame:
    """Add ``kernel``, ``estimate`` and ``spread`` (three times the bound holds eight pairs of nine) to pairs of arrays."""
    @F.pandas_udf("struct<kernel: double, estimate: double, spread: double>")
    def judged(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        x, y = matrix(a), matrix(b)
        return pd.DataFrame({"kernel": sketch.kernel(x, y), "spread": sketch.spread(x, y),
                             "estimate": (sketch.features(x) * sketch.features(y)).sum(axis=1)})

    return pairs.withColumn("found", judged(left, right)).select(*pairs.columns, "found.*")


def polynomial_svc_sweep(train: DataFrame, test: DataFrame, key: str, inputs: int, degrees: Sequence[int],
                         costs: Sequence[float], width: int = 512, gamma: float = 1.0, rounds: int = 20) -> DataFrame:
    """(degree, cost, rows, errors): test errors of a linear machine on the sketch for every degree and cost.

    The cost weighs the sum of hinge losses, so the penalty is 1 / (cost * rows).
    Each degree's features are worked out once. Its costs are fitted
    ``PARALLEL_FITS`` at a time, since every step of a solver is a short job.
    """
    rows, out = train.count(), None
    for degree in degrees:
        sketch = TensorSketch(degree, inputs, width, gamma)
        halves = [checkpointed(polynomial_sketch(half.drop("vector"), sketch).select(key, "label", "vector")) for half in (train, test)]

        def judged(cost: float) -> DataFrame:
            found = fit_predict(linear_svm(maxIter=rounds, regParam=1 / (cost * max(rows, 1))), *halves, key)
            return found.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") != F.col("prediction")).alias("errors")).select(
                F.lit(degree).alias("degree"), F.lit(float(cost)).alias("cost"), "rows", "errors")

        with ThreadPool(PARALLEL_FITS) as pool:
            for row in pool.map(inheritable_thread_target(train.sparkSession)(judged), costs):
                out = row if out is None else out.unionByName(row)
    return out
