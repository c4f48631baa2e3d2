"""Clustering of feature rows and of similarity graphs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from cohortlens.functions.columns import argmax, uniform
from cohortlens.operators.passes import matrix, moments, summed
from cohortlens.operators.profile import purity
from cohortlens.session import checkpointed

NMF_EPS = 2e-15
ROUNDS_PER_CHECKPOINT = 10


def _vectors(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("__v", array_to_vector(source))


def kmeans(df: DataFrame, k: int = 3, max_rounds: int = 20, seed: int = 0,
           source: str = "features") -> DataFrame:
    """Add ``cluster`` 0..k-1."""
    rows = _vectors(df, source)
    model = KMeans(k=k, maxIter=max_rounds, seed=seed, featuresCol="__v",
                   predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("__v")


def elbow(df: DataFrame, ks: Sequence[int], max_rounds: int = 20, seed: int = 0,
          source: str = "features") -> DataFrame:
    """Within-cluster sum of squares per k; k=1 in closed form."""
    rows = _vectors(df, source).select("__v")
    out = []
    for k in ks:
        if k == 1:
            n, _, cov = moments(df, source)
            cost = (n - 1) * float(np.trace(cov))
        else:
            cost = KMeans(k=k, maxIter=max_rounds, seed=seed, featuresCol="__v").fit(rows).summary.trainingCost
        out.append((int(k), float(cost)))
    return df.sparkSession.createDataFrame(out, "k int, within_ss double")


def purity_by_k(df: DataFrame, ks: Sequence[int], label: str, source: str = "features",
                seed: int = 0) -> DataFrame:
    out = None
    for k in ks:
        one = purity(kmeans(df, k, seed=seed, source=source), "cluster", label).select(
            F.lit(int(k)).alias("k"), "purity")
        out = one if out is None else out.unionByName(one)
    return out


def gaussian_mixture(df: DataFrame, k: int = 3, max_rounds: int = 20, seed: int = 0,
                     source: str = "features") -> DataFrame:
    """Add ``cluster``, the most likely component."""
    rows = _vectors(df, source)
    model = GaussianMixture(k=k, maxIter=max_rounds, seed=seed, featuresCol="__v",
                            predictionCol="cluster", probabilityCol="__p").fit(rows)
    return model.transform(rows).drop("__v", "__p")


def mixture_bic(df: DataFrame, ks: Sequence[int], max_rounds: int = 20, seed: int = 0,
                source: str = "features") -> DataFrame:
    """2 * log likelihood - parameters * ln(n) per number of components; larger is better.

    One component is a plain Gaussian, so its likelihood is in closed form.
    """
    rows = _vectors(df, source).select("__v").persist()
    n, _, cov = moments(df, source)
    d = len(cov)
    out = []
    for k in ks:
        if k == 1:
            spread = np.linalg.slogdet(cov * (n - 1) / n)[1]
            likelihood = -n / 2 * (d * np.log(2 * np.pi) + spread + d)
        else:
            fit = GaussianMixture(k=k, maxIter=max_rounds, seed=seed, featuresCol="__v").fit(rows)
            likelihood = fit.summary.logLikelihood
        parameters = (k - 1) + k * d + k * d * (d + 1) // 2
        out.append((int(k), float(2 * likelihood - parameters * np.log(n))))
    rows.unpersist()
    return df.sparkSession.createDataFrame(out, "k int, bic double").orderBy(F.desc("bic"))


def _packed(rows: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(rows)]


def _unpacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=float).reshape(len(column), -1)


def nmf(df: DataFrame, key: str, k: int = 3, rounds: int = 100, seed: int = 0,
        source: str = "features") -> tuple[DataFrame, np.ndarray, list[float]]:
    """Non-negative factors by multiplicative updates: (rows with ``w``, H, losses).

    W stays distributed next to its row; H (k x features) is the only model
    state. A row's W depends on that row and the H of the rounds since the last
    checkpoint alone, so each round is a single pass without a shuffle of rows:
    it replays those rounds and adds up W'V and W'W. Rows are stored as the bytes
    of their numbers, so that a round copies them to its task as they are.
    """
    start = F.array(*[uniform(seed + i, key) + 1e-6 for i in range(k)])
    plain = df.select(key, F.col(source).alias("v"), start.alias("w"))
    name = f"`{key}` {plain.schema[key].dataType.simpleString()}"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(v=_packed(matrix(batch["v"])), w=_packed(matrix(batch["w"])))

    rows = checkpointed(plain.mapInPandas(pack, f"{name}, v binary, w binary"))
    width = len(rows.first()["v"]) // 8
    h = np.random.default_rng(seed).random((k, width)) + 1e-6
    history: list[np.ndarray] = []
    losses: list[float] = []

    def replay(v: np.ndarray, w: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
        for one in factors:
            w = w * (v @ one.T) / (w @ (one @ one.T) + NMF_EPS)
        return w

    for step in range(1, rounds + 1):
        history.append(h)

        def part(batch: pd.DataFrame, factors: list[np.ndarray] = list(history)) -> np.ndarray:
            v = _unpacked(batch["v"])
            w = replay(v, _unpacked(batch["w"]), factors)
            loss = ((v - w @ factors[-1]) ** 2).sum()
            return np.column_stack([w.T @ v, w.T @ w, np.full((k, 1), loss / k)])

        sums = summed(rows, ["v", "w"], part, (k, width + k + 1))
        losses.append(float(sums[:, -1].sum()))
        wtv, wtw = sums[:, :width], sums[:, width:width + k]
        h = h * wtv / (wtw @ h + NMF_EPS)
        if step % ROUNDS_PER_CHECKPOINT == 0 or step == rounds:
            schema = rows.schema

            def advance(batches: Iterator[pd.DataFrame],
                        factors: list[np.ndarray] = list(history)) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    if len(batch):
                        w = replay(_unpacked(batch["v"]), _unpacked(batch["w"]), factors)
                        yield batch.assign(w=_packed(w))

            rows = checkpointed(rows.mapInPandas(advance, schema))
            history = []

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(w=list(_unpacked(batch["w"])))

    return rows.select(key, "w").mapInPandas(unpack, f"{name}, w array<double>"), h, losses


def nmf_clusters(df: DataFrame, key: str, k: int = 3, rounds: int = 100, seed: int = 0,
                 source: str = "features") -> DataFrame:
    """Cluster = largest component of the row's W."""
    w, _, _ = nmf(df, key, k, rounds, seed, source)
    return w.select(key, argmax("w").alias("cluster"))


def power_iteration(pairs: DataFrame, k: int = 3, max_rounds: int = 100, src: str = "patient_a",
                    dst: str = "patient_b", weight: str = "similarity") -> DataFrame:
    """(id, cluster) from pair similarities."""
    pic = PowerIterationClustering(k=k, maxIter=max_rounds, initMode="degree",
                                   srcCol=src, dstCol=dst, weightCol=weight)
    return pic.assignClusters(pairs.select(src, dst, weight))


def power_iteration_sets(members: DataFrame, similar: DataFrame, k: int = 3, max_rounds: int = 100,
                         tolerance: float = 1e-5, seed: int = 0) -> DataFrame:
    """(id, cluster, rounds, converged) from distinct code sets, as ``graph.jaccard_sets`` gives them.

    Power iteration on the graph of patients, of which equal ones are never
    spelled out: they have equal values in every round, so a set stands for its
    ``n`` members, is linked to itself with weight n - 1, and counts n times in
    sums. The start is the degree; the rounds end when the change of the
    vector changes by less than ``tolerance`` per patient. Patients without a
    link are in no cluster.
    """
    sizes = members.groupBy("set_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    ends = F.explode(F.array(F.struct(F.col("patient_a").alias("src"), F.col("patient_b").alias("dst")),
                             F.struct(F.col("patient_b").alias("src"), F.col("patient_a").alias("dst"))))
    between = similar.select(ends.alias("e"), "similarity").select("e.src", "e.dst", "similarity")
    own = sizes.where("n > 1").select(F.col("set_id").alias("src"), F.col("set_id").alias("dst"),
                                      ((F.col("n") - 1) / F.col("n")).alias("similarity"))
    weighted = (between.unionByName(own).join(sizes.withColumnRenamed("set_id", "dst"), "dst")
                .select("src", "dst", (F.col("similarity") * F.col("n")).alias("w")))
    links = checkpointed(weighted)
    degree = links.groupBy("src").agg(F.sum("w").alias("degree"))
    sets = checkpointed(degree.join(sizes.withColumnRenamed("set_id", "src"), "src").select(F.col("src").alias("set_id"), "degree", "n"))
    total = sets.agg(F.sum(F.col("degree") * F.col("n"))).first()[0]
    if not total:
        return members.select(F.col("patient_id").alias("id"), F.lit(0).alias("cluster"), F.lit(0).alias("rounds"),
                              F.lit(True).alias("converged")).limit(0)
    state = sets.withColumn("v", F.col("degree") / total)
    change, done, rounds = None, False, 0
    while rounds < max_rounds and not done:
        rounds += 1
        sent = state.select(F.col("set_id").alias("dst"), "v")
        received = links.join(sent, "dst").groupBy(F.col("src").alias("set_id")).agg(F.sum(F.col("w") * F.col("v")).alias("got"))
        state = checkpointed(state.withColumnRenamed("v", "old").join(received, "set_id")
                             .select("set_id", "degree", "n", "old", (F.col("got") / F.col("degree")).alias("v")))
        size = state.agg(F.sum(F.col("n") * F.col("v")).alias("s")).first()[0]
        moved, patients = state.agg(F.sum(F.col("n") * F.abs(F.col("v") / size - F.col("old"))), F.sum("n")).first()
        done = change is not None and abs(change - moved) < max(tolerance / patients, 1e-8)
        change = moved
        state = state.select("set_id", "degree", "n", (F.col("v") / size).alias("v"))
    vectors = state.withColumn("features", F.array(F.col("v") * patients))
    model = KMeans(k=k, seed=seed, weightCol="n", featuresCol="vector").fit(vectors.withColumn("vector", array_to_vector("features")))
    found = model.transform(vectors.withColumn("vector", array_to_vector("features"))).select("set_id", F.col("prediction").alias("cluster"))
    return (members.join(found, "set_id").select(F.col("patient_id").alias("id"), "cluster", F.lit(rounds).alias("rounds"),
                                                 F.lit(done).alias("converged")))


def cluster_reduced(spaces: Mapping[str, DataFrame], ks: Sequence[int], label: str,
                    mixture_spaces: Mapping[str, int] | None = None, seed: int = 0) -> DataFrame:
    """Purity of k-means on each reduced space, and of a mixture where asked."""
    out = None
    jobs = [(name, "kmeans", k) for name in spaces for k in ks]
    jobs += [(name, "mixture", k) for name, k in (mixture_spaces or {}).items()]
    for name, method, k in jobs:
        fit = kmeans if method == "kmeans" else gaussian_mixture
        one = purity(fit(spaces[name], k, seed=seed), "cluster", label).select(
            F.lit(name).alias("space"), F.lit(method).alias("method"), F.lit(int(k)).alias("k"), "purity")
        out = one if out is None else out.unionByName(one)
    return out
