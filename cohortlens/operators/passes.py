"""Data passes that reduce a frame to a few small arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, functions as F

Matrix = np.ndarray


def matrix(column: pd.Series) -> Matrix:
    return np.asarray(column.to_list(), dtype=float)


def summed(df: DataFrame, columns: list[str], part: Callable[[pd.DataFrame], Matrix],
           shape: tuple[int, ...]) -> Matrix:
    """Sum over all batches of ``part(batch)``, an array of the given small shape.

    Each task adds up its batches; positions are then summed across tasks, so
    the driver receives one array, whatever the number of tasks.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for batch in batches:
            if len(batch):
                total += part(batch)
        yield pd.DataFrame({"cells": [total.ravel()]})

    cells = df.select(*columns).mapInPandas(run, "cells array<double>")
    sums = (cells.select(F.posexplode("cells").alias("at", "v"))
            .groupBy("at").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(int(np.prod(shape)))
    for row in sums:
        out[row["at"]] = row["v"]
    return out.reshape(shape)


def mapped(df: DataFrame, keep: list[str], source: str, rule: Callable[[Matrix], Matrix],
           out: str = "features") -> DataFrame:
    """Replace array column ``source`` by ``rule`` applied to whole batches of rows."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    schema = ", ".join([*kept, f"`{out}` array<double>"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch[keep].assign(**{out: list(rule(matrix(batch[source])))})

    columns = keep if source in keep else [*keep, source]
    return df.select(*columns).mapInPandas(run, schema)


def moments(df: DataFrame, source: str = "features") -> tuple[int, Matrix, Matrix]:
    """(rows, mean, covariance) of an array column, computed in the JVM."""
    vectors = df.select(array_to_vector(source).alias("v"))
    stats = vectors.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s"))
    row = stats.select("s.count", "s.mean", "s.variance").first()
    sd = np.sqrt(row["variance"].toArray())
    corr = np.nan_to_num(Correlation.corr(vectors, "v").first()[0].toArray())
    np.fill_diagonal(corr, 1.0)
    return row["count"], row["mean"].toArray(), corr * np.outer(sd, sd)
