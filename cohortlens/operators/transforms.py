"""Scaling, encoding, projections and their reconstruction errors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.functions.columns import indicators, uniform_of
from cohortlens.operators.features import vector_rows
from cohortlens.operators.ordering import with_row_number
from cohortlens.operators.passes import mapped, matrix, moments, summed
from cohortlens.session import checkpointed


# --- scaling and encoding -------------------------------------------------

def standardise(df: DataFrame, source: str = "features") -> DataFrame:
    """Centre by the mean and divide by the sample deviation."""
    vectors = df.withColumn("__v", array_to_vector(source))
    model = StandardScaler(inputCol="__v", outputCol="__s", withMean=True, withStd=True).fit(vectors)
    return model.transform(vectors).withColumn(source, vector_to_array("__s")).drop("__v", "__s")


def min_max_scale(train: DataFrame, columns: Sequence[str], *others: DataFrame) -> list[DataFrame]:
    """Scale by the train set's extremes; a constant column becomes 0.

    Other columns stay as they are. Returns the train set, then the others.
    """
    ends = train.agg(*[F.min(c).alias(f"lo_{c}") for c in columns],
                     *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    rules = {c: F.coalesce(F.try_divide(F.col(c) - F.lit(ends[f"lo_{c}"]),
                                        F.lit(float(ends[f"hi_{c}"] - ends[f"lo_{c}"]))), F.lit(0.0))
             for c in columns}
    return [df.withColumns(rules) for df in (train, *others)]


def encoder(factors: Sequence[str], numbers: Sequence[str], out: str = "features") -> Pipeline:
    """Index and one-hot every factor, all levels kept, and assemble with the numbers."""
    stages = [StringIndexer(inputCols=list(factors), outputCols=[f"{c}_ix" for c in factors],
                            stringOrderType="alphabetAsc", handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}_ix" for c in factors],
                            outputCols=[f"{c}_hot" for c in factors], dropLast=True),
              VectorAssembler(inputCols=[*[f"{c}_hot" for c in factors], *numbers], outputCol=out)]
    return Pipeline(stages=stages if factors else stages[2:])


def one_hot(df: DataFrame, factor: str, levels: Sequence | None = None,
            max_levels: int = 10_000) -> DataFrame:
    """A 0/1 column for each level of a factor; the number of levels is checked."""
    if levels is None:
        rows = df.select(factor).distinct().limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"{factor} has more than {max_levels} levels")
        levels = sorted(r[0] for r in rows if r[0] is not None)
    return df.select("*", *indicators(factor, levels, factor))


def one_hot_vectors(df: DataFrame, key: str, factors: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """((key, features), (factor, level, idx)): sparse 0/1 vectors of any number of levels.

    Levels are numbered over all factors, in the order of factors and levels,
    by one distributed count; the dictionary is a table and never reaches the
    driver, so that a factor may have as many levels as rows. A null has no
    position. Keys must be unique; every row has a vector, if need be an empty one.
    """
    long = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(c).alias("factor"), F.col(c).cast("string").alias("level"))
        for i, c in enumerate(factors)])).alias("c")).select(key, "c.*")
    levels = long.where(F.col("level").isNotNull()).select("place", "factor", "level").distinct()
    numbered = with_row_number(levels, ["place", "level"], "idx").withColumn("idx", F.col("idx") - 1)
    dictionary = checkpointed(numbered.select("place", "factor", "level", "idx"))
    cells = long.join(dictionary.select("place", "level", "idx"), ["place", "level"], "left").withColumn("value", F.lit(1.0))
    return vector_rows(cells, dictionary.count(), key), dictionary.select("factor", "level", "idx")


def tag_union(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Union with a ``split`` tag, so that all parts share one encoding."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn("split", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def cluster_features(assignments: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Join several clusterings on the row key and one-hot each of them."""
    out = None
    for name, df in assignments.items():
        one = df.select(key, F.col("cluster").alias(name))
        out = one if out is None else out.join(one, key)
    for name in assignments:
        out = one_hot(out, name).drop(name)
    return out


# --- linear projections ---------------------------------------------------

@dataclass(frozen=True)
class Projection:
    """x -> (x - mean) @ weights, and back through ``mixing``."""
    mean: np.ndarray
    weights: np.ndarray            # features x components
    mixing: np.ndarray             # components x features
    variances: np.ndarray | None = None
    shares: np.ndarray | None = None

    def transform(self, df: DataFrame, keep: list[str], source: str = "features") -> DataFrame:
        mean, weights = self.mean, self.weights
        return mapped(df, keep, source, lambda x: (x - mean) @ weights)

    def components_table(self, spark: SparkSession) -> DataFrame:
        """(component, variance, share): one row per component."""
        rows = [(i + 1, float(v), float(s)) for i, (v, s) in enumerate(zip(self.variances, self.shares))]
        return spark.createDataFrame(rows, "component int, variance double, share double")

    def loadings(self, spark: SparkSession) -> DataFrame:
        rows = [(c + 1, f, float(self.weights[f, c])) for c in range(self.weights.shape[1])
                for f in range(self.weights.shape[0])]
        return spark.createDataFrame(rows, "component int, feature int, loading double")


def pca(df: DataFrame, components: int | None = None, source: str = "features") -> Projection:
    """Principal components of centred data; signs fixed by the largest loading."""
    _, mean, cov = moments(df, source)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    vectors = vectors * signs
    n = components or len(values)
    return Projection(mean, vectors[:, :n], vectors[:, :n].T, values[:n], values[:n] / values.sum())


def reconstruction_errors(df: DataFrame, projection: Projection, sizes: Sequence[int],
                          source: str = "features") -> DataFrame:
    """Half the squared error of rebuilding rows from the first n components."""
    mean, weights, mixing, sizes = projection.mean, projection.weights, projection.mixing, list(sizes)

    def part(batch: pd.DataFrame) -> np.ndarray:
        x = matrix(batch[source]) - mean
        z = x @ weights
        return np.array([((x - z[:, :n] @ mixing[:n]) ** 2).sum() / 2 for n in sizes])

    errors = summed(df, [source], part, (len(sizes),))
    return df.sparkSession.createDataFrame(
        [(int(n), float(e)) for n, e in zip(sizes, errors)], "components int, error double")


def normal_draws(seed: int, rows: int, columns: int) -> np.ndarray:
    """Standard normal numbers that any engine can repeat: two MD5 draws of (row, column) each, as radius and angle."""
    def draw(what: str) -> np.ndarray:
        return np.array([[uniform_of(seed, what, i, j) for j in range(columns)] for i in range(rows)])

    return np.sqrt(-2 * np.log(1 - draw("radius"))) * np.cos(2 * np.pi * draw("angle"))


def random_projection(n_features: int, components: int, seed: int) -> Projection:
    """Seeded Gaussian projection, scaled to keep lengths on average."""
    weights = normal_draws(seed, n_features, components) / np.sqrt(components)
    return Projection(np.zeros(n_features), weights, weights.T)


def random_projection_errors(df: DataFrame, n_features: int, components: Sequence[int],
                             repeats: int, seed: int = 1, source: str = "features") -> DataFrame:
    """Reconstruction error of every (size, repeat), in one pass over the data."""
    cells = [(n, r) for n in components for r in range(repeats)]
    weights = [random_projection(n_features, n, seed + 1000 * n + r).weights for n, r in cells]

    def part(batch: pd.DataFrame) -> np.ndarray:
        x = matrix(batch[source])
        return np.array([((x - (x @ w) @ w.T) ** 2).sum() / 2 for w in weights])

    errors = summed(df, [source], part, (len(cells),))
    return df.sparkSession.createDataFrame(
        [(int(n), int(r), float(e)) for (n, r), e in zip(cells, errors)],
        "components int, repeat int, error double")


CONTRASTS = {
    "logcosh": lambda u: (np.tanh(u), 1 - np.tanh(u) ** 2),
    "exp": lambda u: (u * np.exp(-u ** 2 / 2), (1 - u ** 2) * np.exp(-u ** 2 / 2)),
    "kur": lambda u: (u ** 3, 3 * u ** 2),
}


def ica(df: DataFrame, components: int, contrast: str = "logcosh", max_rounds: int = 100,
        tolerance: float = 1e-6, seed: int = 1, source: str = "features") -> Projection:
    """Independent components by symmetric fixed-point rounds on whitened data.

    A round is one pass that adds up a components x components matrix; only that
    and the covariance reach the driver. ``shares`` is variance accounted for.
    """
    base = pca(df, components, source)
    if (base.variances <= 1e-12).any():
        raise ValueError("more components than the data has dimensions")
    whiten = base.weights / np.sqrt(base.variances)
    mean, score = base.mean, CONTRASTS[contrast]
    white = checkpointed(mapped(df, [], source, lambda x: (x - mean) @ whiten, "z"))
    rows = white.count()

    def decorrelate(w: np.ndarray) -> np.ndarray:
        u, _, v = np.linalg.svd(w)
        return u @ v

    w = decorrelate(np.random.default_rng(seed).normal(size=(components, components)))
    for _ in range(max_rounds):
        def part(batch: pd.DataFrame, w: np.ndarray = w) -> np.ndarray:
            z = matrix(batch["z"])
            g, slope = score(z @ w.T)
            return np.column_stack([g.T @ z, slope.sum(axis=0)])

        sums = summed(white, ["z"], part, (components, components + 1)) / rows
        fresh = decorrelate(sums[:, :-1] - sums[:, -1:] * w)
        change = np.abs(np.abs((fresh * w).sum(axis=1)) - 1).max()
        w = fresh
        if change < tolerance:
            break
    unmix = whiten @ w.T
    mix = w @ (base.weights * np.sqrt(base.variances)).T
    accounted = (mix ** 2).sum(axis=1)
    total = base.variances.sum() / base.shares.sum()
    order = np.argsort(accounted)[::-1]
    return Projection(mean, unmix[:, order], mix[order], accounted[order], accounted[order] / total)
