import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import evaluation, ordering, profile, sampling, transforms


@pytest.mark.parametrize("rows", [10_000_000, 40])
def test_row_numbers_in_buckets(spark, rows):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    found = ordering.with_row_number(df, ["k"], "n", rows).collect()
    assert sorted((r["k"], r["n"]) for r in found) == [(i, i + 1) for i in range(1000)]


def test_many_split_points(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("k"), F.lit(2).alias("v"))
    found = ordering.with_running_sums(df, ["k"], {"s": F.col("v")}, rows_per_bucket=10).collect()
    assert all(r["s"] == 2 * (r["k"] + 1) for r in found)


def test_text_and_mixed_keys_in_buckets(spark):
    rng = random.Random(0)
    rows = [(rng.choice("abc"), rng.random(), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, x double, id long")
    found = ordering.with_row_number(df, ["g", "x", "id"], "n", 25).collect()
    want = {r[2]: i + 1 for i, r in enumerate(sorted(rows))}
    assert {r["id"]: r["n"] for r in found} == want


def test_hot_score_is_split_by_the_tiebreak(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 900).alias("s"))
    kept = ordering.top_fraction(df, "s", "id", 0.3, rows_per_bucket=50).collect()
    rows = sorted(((0.5 if i % 3 == 0 else i / 900), -i) for i in range(900))[::-1][:270]
    assert {r["id"] for r in kept} == {-i for _, i in rows}


def test_folds_match_contiguous_rule(spark):
    found = ordering.fold_of(spark.range(23), "id", 5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in found] == [5, 5, 5, 4, 4]


def test_summary_matches_pandas(spark):
    rng = np.random.default_rng(0)
    data = pd.DataFrame({"a": rng.normal(size=301), "b": rng.integers(0, 9, 301).astype(float)})
    for bins in (profile.BINS, 2):
        found = {r["column"]: r for r in profile.column_summary(spark.createDataFrame(data), ["a", "b"], bins).collect()}
        for c in data:
            assert found[c]["q1"] == pytest.approx(data[c].quantile(0.25))
            assert found[c]["median"] == pytest.approx(data[c].median())
            assert found[c]["sd"] == pytest.approx(data[c].std())
            z = (data[c] - data[c].mean()) / data[c].std(ddof=0)
            assert found[c]["kurtosis"] == pytest.approx((z ** 4).mean())


def test_quantiles_of_odd_columns(spark):
    tiny = 5e-324
    data = {"wide": [-1e308, -1.0, 0.0, tiny, 1e-300, 1.0, 1e308], "tiny": [0.0, tiny, tiny, 2 * tiny, None, None, None],
            "ends": [-math.inf, 1.0, 2.0, 3.0, 4.0, 5.0, math.inf], "hot": [7.0] * 5 + [8.0, None], "none": [None] * 7}
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data))
    wanted = {"low": 0.0, "q": 1 / 3, "mid": 0.5, "top": 1.0}
    found = {(r["column"], r["name"]): r["value"] for r in profile.quantiles(df, list(data), wanted, 4).collect()}
    assert {c for c, _ in found} == set(data) - {"none"}
    for c in set(data) - {"none"}:
        values = sorted(v for v in data[c] if v is not None)
        for name, p in wanted.items():
            h = p * (len(values) - 1)
            low, high = values[math.floor(h)], values[math.ceil(h)]
            assert found[c, name] == (low if low == high else low + (h - math.floor(h)) * (high - low)), (c, name)
    assert profile.quantiles(df.limit(0), ["wide"], wanted).count() == 0


def test_quantiles_of_distinct_values(spark):
    df = spark.range(20_000).select((F.col("id") * 0.37).alias("v"))
    assert profile.quantiles(df, ["v"], {"median": 0.5}).first()["value"] == pytest.approx(19_999 * 0.37 / 2)


def test_purity_bounds(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (0, 2), (1, 2)], "cluster int, label int")
    assert profile.purity(df, "cluster", "label").first()[0] == 0.75


def test_information_measures(spark):
    rows = [("x", "p", 0), ("x", "q", 0), ("y", "p", 1), ("y", "q", 1)] * 3
    df = spark.createDataFrame(rows, "a string, b string, label int")
    gains = {r["column"]: r["gain"] for r in profile.information_gain(df, ["a", "b"], "label").collect()}
    assert gains["a"] == pytest.approx(math.log(2)) and gains["b"] == pytest.approx(0.0)
    assert [r["column"] for r in profile.positive_gain(profile.information_gain(df, ["a", "b"], "label"), 1).collect()] == ["a"]
    info = {(r[0], r[1]): r[2] for r in profile.mutual_information(df.withColumn("c", F.col("a")), ["a", "b", "c"]).collect()}
    assert info[("a", "c")] == pytest.approx(math.log(2)) and info[("a", "b")] == pytest.approx(0.0)


def test_constant_column_in_min_max(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    other = spark.createDataFrame([(5.0, 6.0)], "a double, b double")
    train, test = transforms.min_max_scale(df, ["a", "b"], other)
    assert sorted(tuple(r) for r in train.collect()) == [(0.0, 0.0), (1.0, 0.0)]
    assert test.first()["a"] == 2.0      # the train set's extremes are used


def test_draws_repeat_and_hit_their_shares(spark):
    df = spark.range(20_000)
    one = sampling.random_split(df, "id", [0.2, 0.8]).where("part = 0")
    two = sampling.random_split(df.repartition(7), "id", [0.2, 0.8]).where("part = 0")
    assert one.exceptAll(two).count() == 0 and abs(one.count() - 4000) < 300
    train, test = sampling.route(df, "id")
    assert train.count() + test.count() == 20_000 and train.join(test, "id").count() == 0
    bags = sampling.bernoulli_bags(df, "id", 4, 0.5).groupBy("bag").count().collect()
    assert len(bags) == 4 and all(abs(b["count"] - 10_000) < 500 for b in bags)
    mean = sampling.bootstrap_bags(df, "id", 2, 0.6).agg(F.sum("times")).first()[0] / 40_000
    assert abs(mean - 0.6) < 0.02


@pytest.mark.parametrize("size", [1_000_000, 30])
def test_multiclass_auc_of_hot_and_continuous_scores(spark, size):
    rng = random.Random(3)
    # a third of all rows share one score; class d is a single row, class a lies above the others
    rows = [(c, 0.25 if rng.random() < 0.33 else rng.random() + (c == "a") / 2) for c in rng.choices("abc", k=240)]
    rows.append(("d", 0.25))
    df = spark.createDataFrame([*rows, (None, 0.5), ("b", None)], "label string, score double")
    of = {c: [s for l, s in rows if l == c] for c in "abcd"}
    areas = []
    for i, a in enumerate("abcd"):
        for b in "abcd"[i + 1:]:
            area = np.mean([(y > x) + 0.5 * (y == x) for x in of[a] for y in of[b]])
            areas.append(1 - area if np.median(of[a]) > np.median(of[b]) else area)
    assert evaluation.multiclass_auc(df, "score", "label", size).first()[0] == pytest.approx(np.mean(areas))


def test_multiclass_auc_needs_two_classes(spark):
    df = spark.createDataFrame([("a", 0.5), (None, 0.1)], "label string, score double")
    assert evaluation.multiclass_auc(df, "score", "label").collect()[0][0] is None
    assert evaluation.multiclass_auc(df.limit(0), "score", "label").collect()[0][0] is None


def test_roc_against_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0, 1]), round(rng.random(), 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    for size in (1_000_000, 2):
        assert evaluation.roc_area(df, rows_per_bucket=size).first()[0] == pytest.approx(want)
    last = evaluation.roc_points(df).orderBy("threshold").first()
    assert last["fpr"] == 1.0 and last["tpr"] == 1.0


def test_metrics_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 1), (0, 0)], "prediction int, label int")
    found = evaluation.binary_metrics(df).first()
    assert found["precision"] is None and found["recall"] == 0.0 and found["specificity"] == 1.0


def test_one_hot_vectors_of_wide_factors_with_nulls(spark):
    from cohortlens.operators import features, transforms

    rows = spark.createDataFrame([(1, "b", "x"), (2, "a", None), (3, None, None), (4, "b", "y")], "k int, f string, g string")
    vectors, levels = transforms.one_hot_vectors(rows, "k", ["f", "g"])
    assert sorted(tuple(r) for r in levels.collect()) == [("f", "a", 0), ("f", "b", 1), ("g", "x", 2), ("g", "y", 3)]
    found = {r.k: (r.features.size, [int(i) for i in r.features.indices]) for r in vectors.collect()}
    assert found == {1: (4, [1, 2]), 2: (4, [0]), 3: (4, []), 4: (4, [1, 3])}
    assert features.vector_cells(vectors, "k").count() == 5
    empty = transforms.one_hot_vectors(rows.where("k > 9"), "k", ["f"])
    assert empty[0].count() == 0 and empty[1].count() == 0
