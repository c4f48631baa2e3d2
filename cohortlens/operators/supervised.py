"""Classifiers and regressors: built-in learners, boosting, bags, neighbours.

Predictions keep the row key: (key, label, prediction, probability of class 1).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
    MultilayerPerceptronClassifier, OneVsRest)
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.functions.columns import sigmoid, uniform
from cohortlens.operators.neighbours import BLOCK_ROWS, nearest
from cohortlens.operators.passes import matrix, summed
from cohortlens.session import checkpointed, staging_path

# Fixed value: the seed of the published runs.
SEED = 545510477
BOOST_ROUNDS_PER_CHECKPOINT = 5


def with_vector(df: DataFrame, source: str = "features") -> DataFrame:
    return df.withColumn("vector", array_to_vector(source))


def _positive(model_output: DataFrame) -> DataFrame:
    """Scalar probability of class 1: from the model, or the margin's sigmoid."""
    if "probability" in model_output.columns:
        return model_output.withColumn("probability", vector_to_array("probability")[1])
    if "rawPrediction" in model_output.columns:
        return model_output.withColumn("probability", sigmoid(vector_to_array("rawPrediction")[1]))
    return model_output.withColumn("probability", F.lit(None).cast("double"))


def fit_predict(estimator, train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Fit on ``vector``/``label`` of train; scored rows of test."""
    model = estimator.fit(train)
    return _positive(model.transform(test)).select(
        key, F.col("label").cast("double").alias("label"), "prediction", "probability")


def logistic_regression(**options) -> LogisticRegression:
    return LogisticRegression(featuresCol="vector", **options)


def linear_svm(**options) -> LinearSVC:
    return LinearSVC(featuresCol="vector", **options)


def decision_tree(max_depth: int = 5, leaf_rows: int = 1, **options) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol="vector", maxDepth=max_depth, impurity="entropy",
                                  minInstancesPerNode=leaf_rows, seed=SEED, **options)


def gradient_boosting(trees: int = 200, max_depth: int = 6, **options) -> GBTClassifier:
    return GBTClassifier(featuresCol="vector", maxIter=trees, maxDepth=max_depth, seed=SEED, **options)


def network(inputs: int, hidden: Sequence[int], classes: int = 2,
            **options) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(featuresCol="vector", layers=[inputs, *hidden, classes],
                                          seed=SEED, **options)


def one_vs_rest(classifier) -> OneVsRest:
    return OneVsRest(classifier=classifier, featuresCol="vector")


def nearest_mean(train: DataFrame, columns: Sequence[str], label: str = "label",
                 pulls: Sequence[float] = ()) -> Callable[[DataFrame], DataFrame]:
    """Predictor of the class whose mean over ``columns`` is nearest; ties go to the smallest label.

    Only one row per class reaches the driver. ``pulls`` multiply the squared
    distances to the classes in the order of their labels; missing ones are 1.
    Null values and labels do not count in means; a row with a null value gets
    a null prediction.
    """
    means = train.where(F.col(label).isNotNull()).groupBy(label).agg(*[F.avg(c).alias(c) for c in columns]).orderBy(label).collect()
    if not means:
        raise ValueError("no labelled row to learn from")
    pulls = [*pulls, *[1.0] * (len(means) - len(pulls))]
    far = F.array(*[pull * sum(((F.col(c) - F.lit(row[c])) * (F.col(c) - F.lit(row[c])) for c in columns), F.lit(0.0))
                    for pull, row in zip(pulls, means)])
    classes = F.array(*[F.lit(row[label]) for row in means])
    nearest_class = F.get(classes, (F.array_position(far, F.array_min(far)) - 1).cast("int"))
    return lambda df: df.withColumn("prediction", nearest_class)


# --- kernels --------------------------------------------------------------

def polynomial_features(df: DataFrame, degree: int) -> DataFrame:
    """Replace ``vector`` by its polynomial expansion."""
    expanded = PolynomialExpansion(degree=degree, inputCol="vector", outputCol="__poly").transform(df)
    return expanded.drop("vector").withColumnRenamed("__poly", "vector")


def radial_features(df: DataFrame, width: int, gamma: float, n_features: int, seed: int = 1,
                    source: str = "features") -> DataFrame:
    """Add ``vector`` of random Fourier features for exp(-gamma * distance^2)."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(scale=math.sqrt(2 * gamma), size=(n_features, width))
    phases = rng.uniform(0, 2 * math.pi, size=width)

    @F.pandas_udf("array<double>")
    def lift(rows: pd.Series) -> pd.Series:
        return pd.Series(list(math.sqrt(2.0 / width) * np.cos(matrix(rows) @ directions + phases)))

    return df.withColumn("vector", array_to_vector(lift(F.col(source))))


# --- boosting -------------------------------------------------------------

def adaboost(train: DataFrame, test: DataFrame, key: str, rounds: int = 50, variant: str = "discrete",
             rate: float = 1.0, max_depth: int = 1, seed: int = SEED) -> DataFrame:
    """Boosted trees on a 0/1 label: ``discrete``, ``real``, ``gentle`` or ``m1``.

    Each round reweights rows by one column expression; train rows carry their
    weight and test rows their running score, checkpointed every few rounds. A
    round scores its rows once and keeps them with the tree's answer, from which
    its error, its total weight and the rows of the next round are read. The
    last round leaves no rows behind.
    """
    sign = F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
    n = train.count()
    rows = train.select("vector", "label", F.lit(1.0 / n).alias("weight"))
    target = test.select(key, "vector", "label", F.lit(0.0).alias("score"))
    rows, target = checkpointed(rows).persist(), checkpointed(target)
    kept = rows
    if variant == "real":
        p = F.greatest(F.least(vector_to_array("__p")[1], F.lit(1 - 1e-6)), F.lit(1e-6))
        answer = 0.5 * F.log(p / (1 - p))
    else:
        answer = F.col("__f")

    for step in range(1, rounds + 1):
        if variant == "gentle":
            tree = DecisionTreeRegressor(featuresCol="vector", labelCol="__y", weightCol="weight",
                                         maxDepth=max_depth, seed=seed + step, predictionCol="__f")
            model = tree.fit(rows.withColumn("__y", sign))
        else:
            tree = DecisionTreeClassifier(featuresCol="vector", labelCol="label", weightCol="weight",
                                          maxDepth=max_depth, seed=seed + step, predictionCol="__f",
                                          probabilityCol="__p", rawPredictionCol="__r")
            model = tree.fit(rows)
        scored = model.transform(rows).select("vector", "label", "weight", answer.alias("__answer"))
        if step < rounds:
            scored = scored.persist()
        vote, miss = F.col("__answer"), None
        if variant in ("discrete", "m1"):
            miss = scored.agg(
                (F.sum(F.when(F.col("__answer") != F.col("label"), F.col("weight")).otherwise(0.0))
                 / F.sum("weight")).alias("e")).first()["e"]
            if miss >= 0.5 and variant == "m1":
                scored.unpersist()
                break
            odds = math.log(max(1 - miss, 1e-10) / max(miss, 1e-10))
            alpha = odds if variant == "m1" else odds / 2
            vote = alpha * F.when(F.col("__answer") == 1, 1.0).otherwise(-1.0)
        vote = rate * vote
        target = model.transform(target).withColumn("__answer", answer).select(
            key, "vector", "label", (F.col("score") + vote).alias("score"))
        if step == rounds or miss == 0:
            scored.unpersist()
            break
        gain = F.exp(-vote * sign) if variant != "m1" else F.exp(
            F.when(vote * sign < 0, F.abs(vote)).otherwise(0.0))
        weight = F.col("weight") * gain
        total = scored.agg(F.sum(weight)).first()[0]
        kept.unpersist()
        kept = scored
        rows = scored.select("vector", "label", (weight / F.lit(total)).alias("weight"))
        if step % BOOST_ROUNDS_PER_CHECKPOINT == 0:
            rows, target = checkpointed(rows).persist(), checkpointed(target)
            kept.unpersist()
            kept = rows
    kept.unpersist()
    return target.select(key, F.col("label").cast("double").alias("label"),
                         F.when(F.col("score") > 0, 1.0).otherwise(0.0).alias("prediction"),
                         sigmoid(2 * F.col("score")).alias("probability"))


# --- bags -----------------------------------------------------------------

def bagged_trees(train: DataFrame, test: DataFrame, key: str, trees: int = 15, leaf_rows: int = 25,
                 max_depth: int = 10, target: str = "target", seed: int = SEED) -> DataFrame:
    """Mean of regression trees on 60 percent bags, one random feature per split."""
    forest = RandomForestRegressor(featuresCol="vector", labelCol=target, numTrees=trees,
                                   subsamplingRate=0.6, featureSubsetStrategy="1",
                                   minInstancesPerNode=leaf_rows, maxDepth=max_depth, seed=seed)
    return forest.fit(train).transform(test).select(key, target, "prediction")


def sgd_weights(rows: DataFrame, key: str, width: int, bags: int = 5, share: float = 0.6,
                eta: float = 0.5, mu: float = 0.0, seed: int = 7, steps: int = 20, passes: int = 1) -> DataFrame:
    """(bag, weights): logistic weights of each bag after ``passes`` passes of ``steps`` minibatches.

    Rows have ``features`` and ``label``. Bag and minibatch of a row follow from
    its key. A step adds up the gradients of its minibatch over all tasks, for
    all bags at once, w += eta * (mean((y - p) x) - 2 mu w), so any number of
    tasks works on it and the layout of the rows does not matter. Rows are
    stored by minibatch; a step reads its own only.
    """
    member = F.array(*[(uniform(seed, F.col(key), F.lit(b)) < share) for b in range(bags)])
    batch = F.floor(uniform(seed, F.col(key), F.lit("batch")) * steps).cast("int")
    path = staging_path(rows.sparkSession, "minibatches")
    tagged = rows.select(batch.alias("batch"), F.col("features").cast("array<double>").alias("features"),
                         F.col("label").cast("double").alias("label"), member.alias("member"), F.xxhash64(key).alias("deal"))
    tagged.repartitionByRange("batch", "deal").drop("deal").write.partitionBy("batch").parquet(path)
    stored = rows.sparkSession.read.schema(tagged.drop("deal").schema).parquet(path)
    w = np.zeros((bags, width))

    def gradients(part: pd.DataFrame) -> np.ndarray:
        x, on = matrix(part["features"]), matrix(part["member"])
        missed = (part["label"].to_numpy()[:, None] - 1 / (1 + np.exp(-(x @ w.T)))) * on
        return np.c_[missed.T @ x, on.sum(axis=0)]

    for step in range(steps * passes):
        found = summed(stored.where(F.col("batch") == step % steps), ["features", "label", "member"], gradients, (bags, width + 1))
        w = w + eta * (found[:, :width] / np.maximum(found[:, width:], 1) - 2 * mu * w)
    return rows.sparkSession.createDataFrame([(b, [float(v) for v in w[b]]) for b in range(bags)], "bag int, weights array<double>")


def sgd_scores(rows: DataFrame, weights: DataFrame, keep: list[str]) -> DataFrame:
    """Mean probability over the bags; ``weights`` is one row per bag."""
    w = np.array([r["weights"] for r in weights.orderBy("bag").collect()])

    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        return pd.Series((1 / (1 + np.exp(-(matrix(features) @ w.T)))).mean(axis=1))

    p = score(F.col("features"))
    return rows.select(*keep, p.alias("probability")).withColumn(
        "prediction", F.when(F.col("probability") > 0.5, 1.0).otherwise(0.0))


# --- nearest neighbours ---------------------------------------------------

def knn_vote(train: DataFrame, test: DataFrame, key: str, k: int = 1,
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Majority label of the ``k`` nearest; ties go to the smaller label."""
    votes = nearest(train, test, key, k, block_rows).groupBy(key, F.col("label").alias("vote")).agg(
        F.count(F.lit(1)).alias("n"))
    won = votes.groupBy(key).agg(F.max_by(F.col("vote"), F.struct("n", -F.col("vote"))).alias("prediction"))
    return test.select(key, F.col("label").cast("double").alias("label")).join(won, key)
