"""Splits and bags. Draws are fixed by row key and seed, so retries repeat them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortlens.functions.columns import uniform


def random_split(df: DataFrame, key: str, shares: Sequence[float], seed: int = 7) -> DataFrame:
    """Add ``part`` 0..n-1 with the given shares."""
    total, edge = float(sum(shares)), 0.0
    draw, part = uniform(seed, key), F.lit(len(shares) - 1)
    edges = []
    for share in shares[:-1]:
        edge += share / total
        edges.append(edge)
    for i in reversed(range(len(edges))):
        part = F.when(draw <= edges[i], i).otherwise(part)
    return df.withColumn("part", part)


def route(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(training, testing): a row goes to testing when its draw is within the share."""
    tagged = random_split(df, key, [test_share, 1 - test_share], seed)
    return (tagged.where(F.col("part") == 1).drop("part"),
            tagged.where(F.col("part") == 0).drop("part"))


def bernoulli_bags(df: DataFrame, key: str, bags: int, share: float, seed: int = 7) -> DataFrame:
    """One copy of the row for each bag it falls into, each with probability ``share``."""
    fanned = df.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))))
    return fanned.where(uniform(seed, key, "bag") < share)


def bootstrap_bags(df: DataFrame, key: str, bags: int = 20, share: float = 0.6,
                   seed: int = 7) -> DataFrame:
    """Sampling with replacement as Poisson(``share``) counts: ``times`` per row and bag.

    ``share`` is the mean count; beyond 500 the distribution function starts
    below what a double can tell from zero, so larger means raise an error.
    """
    fanned = df.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))))
    if not 0 <= share <= 500:
        raise ValueError("share must lie in [0, 500]")
    # the distribution function up to where it can no longer be told from one
    steps, below, term, n = [], 0.0, math.exp(-share), 0
    while n <= share or term > 2.0 ** -54:
        below += term
        n += 1
        term *= share / n
        steps.append(below)
    draw = uniform(seed, key, "bag")
    times = F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= draw))
    return fanned.withColumn("times", times).where(F.col("times") > 0)
