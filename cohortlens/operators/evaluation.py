"""Metrics, ROC, cross-validation, sweeps and learning curves."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.operators.ordering import ROWS_PER_BUCKET, first_n, fold_of, with_running_sums
from cohortlens.session import checkpointed
from cohortlens.operators.sampling import random_split

Scorer = Callable[[DataFrame, DataFrame], DataFrame]


def _share(hits: Column, base: Column) -> Column:
    return F.try_divide(F.sum(F.when(hits, 1.0).otherwise(0.0)), F.sum(F.when(base, 1.0).otherwise(0.0)))


def binary_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label",
                   by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, AUC of hard labels, precision, recall, F1, specificity in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    rates = df.groupBy(*by).agg(
        F.avg(F.when(p == y, 1.0).otherwise(0.0)).alias("accuracy"),
        _share((p == 1) & (y == 1), p == 1).alias("precision"),
        _share((p == 1) & (y == 1), y == 1).alias("recall"),
        _share((p == 0) & (y == 0), y == 0).alias("specificity"))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rates.select(*by, "accuracy", ((F.col("recall") + F.col("specificity")) / 2).alias("auc"),
                        "precision", "recall", "specificity", f1.alias("f1"))


def roc_points(df: DataFrame, score: str = "score", label: str = "label",
               rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One (threshold, fpr, tpr) per distinct score, thresholds descending."""
    positive = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    counts = (df.groupBy(F.col(score).alias("threshold"))
              .agg(positive.alias("pos"), F.count(F.lit(1)).alias("n"))
              .withColumn("neg", F.col("n") - F.col("pos")).withColumn("__order", -F.col("threshold")))
    counts = checkpointed(counts)
    totals = counts.agg(F.sum("pos"), F.sum("neg")).first()
    running = with_running_sums(counts, ["__order"], {"tp": F.col("pos"), "fp": F.col("neg")},
                                rows_per_bucket, store=False)
    return running.select("threshold", F.try_divide(F.col("fp"), F.lit(float(totals[1] or 0))).alias("fpr"),
                          F.try_divide(F.col("tp"), F.lit(float(totals[0] or 0))).alias("tpr"),
                          "pos", "neg", "tp", "fp")


def roc_area(df: DataFrame, score: str = "score", label: str = "label",
             rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Trapezoid area: every step adds its negatives times the mean of both heights."""
    points = roc_points(df, score, label, rows_per_bucket)
    step = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    return points.agg(F.try_divide(F.sum(step), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def multiclass_auc(df: DataFrame, prediction: str, label: str,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Mean over class pairs of the rank AUC of predicted positions.

    Per pair the direction follows the class medians. Rows become counts of
    each class per distinct prediction, in one global order over ranges; the
    running counts give both the medians, as order statistics of each class,
    and the wins of every class over every other one, an array per class that is
    added up before any shuffle. So predictions may be continuous, and one of
    them may hold most rows. The classes are columns here: their number is
    taken to be far below that of rows. Rows without a prediction or a label do
    not count; fewer than two classes give null.
    """
    position = F.col(prediction).cast("double")
    rows = df.select(F.col(label).alias("c"), position.alias("p")).dropna()
    pairs = checkpointed(rows.groupBy("c", "p").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["c"]: r["n"] for r in pairs.groupBy("c").agg(F.sum("n").alias("n")).orderBy("c").collect()}
    if len(sizes) < 2:
        return df.sparkSession.createDataFrame([(None,)], "auc double")
    k = range(len(sizes))
    counts = pairs.groupBy("p").agg(*[
        F.sum(F.when(F.col("c") == F.lit(c), F.col("n")).otherwise(0)).alias(f"n{i}") for i, c in enumerate(sizes)])
    running = with_running_sums(counts, ["p"], {f"upto{i}": F.col(f"n{i}") for i in k}, rows_per_bucket)

    def middle(i: int, size: int) -> Column:
        """The mean of the one or two middle predictions of a class."""
        at = lambda place: F.max(F.when((F.col(f"upto{i}") > place) & (F.col(f"upto{i}") - F.col(f"n{i}") <= place), F.col("p")))
        return (at((size - 1) // 2) + at(size // 2)) / 2

    medians = running.agg(*[middle(i, size).alias(f"m{i}") for i, size in enumerate(sizes.values())]).first()
    # a row of class b beats the rows of class a below it, and half of those beside it
    below = F.array(*[(F.col(f"upto{i}") - F.col(f"n{i}") / 2.0) for i in k])
    held = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("b"), F.col(f"n{i}").alias("nb")) for i in k]), lambda x: x["nb"] > 0))
    wins = running.select(below.alias("below"), held.alias("x")).select("x.b", "x.nb", F.posexplode("below").alias("a", "below"))
    won = wins.where("a < b").groupBy("a", "b").agg(F.sum(F.col("nb") * F.col("below")).alias("won"))
    size = F.array(*[F.lit(float(n)) for n in sizes.values()])
    median = F.array(*[F.lit(float(medians[f"m{i}"])) for i in k])
    auc = F.col("won") / F.get(size, F.col("a")) / F.get(size, F.col("b"))
    return won.agg(F.avg(F.when(F.get(median, F.col("a")) > F.get(median, F.col("b")), 1 - auc).otherwise(auc)).alias("auc"))


# --- validation -----------------------------------------------------------

def k_fold(df: DataFrame, key: str, score: Scorer, k: int = 5) -> DataFrame:
    """Accuracy and AUC per contiguous fold; ``score(train, test)`` gives predictions."""
    folds = checkpointed(fold_of(df, key, k))
    out = _stack((i, score(folds.where(F.col("fold") != i), folds.where(F.col("fold") == i)))
                 for i in range(k))
    return binary_metrics(out, by=["run"]).select("run", "accuracy", "auc")


def repeated_holdout(df: DataFrame, key: str, score: Scorer, repeats: int = 5, test_share: float = 0.2,
                     seed: int = 7) -> DataFrame:
    """Accuracy and AUC of repeated random hold-outs."""
    def run(i: int) -> DataFrame:
        tagged = random_split(df, key, [test_share, 1 - test_share], seed + i)
        return score(tagged.where(F.col("part") == 1), tagged.where(F.col("part") == 0))

    return binary_metrics(_stack((i, run(i)) for i in range(repeats)), by=["run"]).select(
        "run", "accuracy", "auc")


def mean_scores(runs: DataFrame) -> DataFrame:
    return runs.agg(F.avg("accuracy").alias("accuracy"), F.avg("auc").alias("auc"))


def _stack(runs: Iterable[tuple[object, DataFrame]]) -> DataFrame:
    out = None
    for name, df in runs:
        one = df.select(F.lit(name).alias("run"), F.col("label").cast("double").alias("label"),
                        F.col("prediction").cast("double").alias("prediction"))
        out = one if out is None else out.unionByName(one)
    return out


def train_test_table(runs: Mapping[object, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(value, train_accuracy, test_accuracy) from (train, test) predictions per value."""
    train = _stack((v, p[0]) for v, p in runs.items())
    test = _stack((v, p[1]) for v, p in runs.items())
    right = F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0))
    a = train.groupBy(F.col("run").alias("value")).agg(right.alias("train_accuracy"))
    b = test.groupBy(F.col("run").alias("value")).agg(right.alias("test_accuracy"))
    return a.join(b, "value")


def parameter_sweep(values: Sequence, train: DataFrame, test: DataFrame,
                    fit: Callable[[object, DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Fit once per value; ``fit(value, train)`` returns a predictor of frames."""
    runs = {}
    for value in values:
        predict = fit(value, train)
        runs[value] = (predict(train), predict(test))
    return train_test_table(runs)


def feature_subsets(features: Sequence[str]) -> dict[str, list[str]]:
    """Each feature alone, growing prefixes, and all but one."""
    names = list(features)
    subsets = {f"only:{f}": [f] for f in names}
    subsets |= {f"first:{i}": names[:i] for i in range(1, len(names) + 1)}
    subsets |= {f"without:{f}": [g for g in names if g != f] for f in names}
    return subsets


def feature_ablation(features: Sequence[str], train: DataFrame, test: DataFrame,
                     fit: Callable[[object, DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    subsets = {n: s for n, s in feature_subsets(features).items() if s}
    return parameter_sweep(list(subsets), train, test, lambda name, df: fit(subsets[name], df))


def learning_curve(sizes: Sequence[int], train: DataFrame, test: DataFrame, key: str,
                   fit: Callable[[object, DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Fit on the first n rows of one fixed order for every size."""
    ordered = checkpointed(first_n(train, key, max(sizes)))
    return parameter_sweep(list(sizes), train, test,
                           lambda n, _: fit(n, ordered.where(F.col("position") <= n)))
