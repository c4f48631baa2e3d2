import math
import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortlens.functions.columns import uniform
from cohortlens.operators import clustering, evaluation, kernels, neighbours, passes, supervised as sv, transforms
from cohortlens.operators.neighbours import nearest
from cohortlens.plans import exact_queries, model_queries, tables, workloads
from cohortlens.session import SHUFFLE_CLEANUP_CONF, checkpointed, shared_dir
from cohortlens.sources import delimited, models, svmlight


def points(spark, n=240, d=5, seed=0):
    """Two classes four deviations apart along the first axis."""
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    x = rng.normal(size=(n, d))
    x[:, 0] += 4 * label
    return spark.createDataFrame([(i, [float(v) for v in x[i]], int(label[i])) for i in range(n)],
                                 "id long, features array<double>, label int"), x, label


def accuracy(df):
    return df.agg(F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0))).first()[0]


def halves(spark):
    df = sv.with_vector(points(spark)[0])
    return df.where("id % 3 > 0"), df.where("id % 3 = 0")


def test_pca_matches_numpy(spark):
    df, x, _ = points(spark)
    found = transforms.pca(df)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(found.variances, values) and np.all(np.diff(found.shares) <= 1e-12)
    errors = {r[0]: r[1] for r in transforms.reconstruction_errors(df, found, [1, 5]).collect()}
    assert errors[1] == pytest.approx(values[1:].sum() * (len(x) - 1) / 2) and errors[5] == pytest.approx(0, abs=1e-9)


def test_pca_scores_keep_the_row_key(spark):
    df, x, _ = points(spark)
    found = transforms.pca(df, 2)
    rows = {r["id"]: r["features"] for r in found.transform(df.repartition(5), ["id"]).collect()}
    assert np.allclose(rows[17], (x[17] - found.mean) @ found.weights)


def test_ica_separates_sources(spark):
    rng = np.random.default_rng(0)
    s = np.column_stack([rng.uniform(-1, 1, 1500), rng.laplace(size=1500)])
    x = s @ np.array([[1.0, 0.5], [0.4, 1.0]])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, features array<double>")
    found = transforms.ica(df, 2, max_rounds=50)
    y = (x - found.mean) @ found.weights
    c = np.abs(np.corrcoef(y.T, s.T)[:2, 2:])
    assert c.max(axis=1).min() > 0.95 and found.shares.sum() == pytest.approx(1.0)


def test_random_projection_is_seeded(spark):
    a, b = transforms.random_projection(5, 3, 9), transforms.random_projection(5, 3, 9)
    assert np.array_equal(a.weights, b.weights)
    df, x, _ = points(spark)
    found = transforms.random_projection_errors(df, 5, [2, 4], 3).collect()
    assert len(found) == 6 and all(r["error"] > 0 for r in found)


def test_nmf_follows_the_multiplicative_updates(spark):
    rng = np.random.default_rng(0)
    v = rng.random((90, 2)) @ rng.random((2, 6))
    df = spark.createDataFrame([(i, [float(c) for c in row]) for i, row in enumerate(v)], "id long, features array<double>")
    found, h, losses = clustering.nmf(df, "id", 2, rounds=23)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    first = {r["id"]: r["w"] for r in df.select("id", F.array(*[uniform(i, "id") + 1e-6 for i in range(2)]).alias("w")).collect()}
    w, g = np.array([first[i] for i in range(90)]), np.random.default_rng(0).random((2, 6)) + 1e-6
    for _ in range(23):
        w = w * (v @ g.T) / (w @ g @ g.T + clustering.NMF_EPS)
        g = g * (w.T @ v) / (w.T @ w @ g + clustering.NMF_EPS)
    rows = {r["id"]: r["w"] for r in found.collect()}
    assert np.allclose([rows[i] for i in range(90)], w) and np.allclose(h, g)


def test_nmf_rounds_read_packed_rows(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(clustering, "checkpointed", lambda df: stored.append(df.schema) or checkpointed(df))
    rng = np.random.default_rng(4)
    v = rng.integers(0, 5, (40, 6))
    df = spark.createDataFrame([(f"k{i}", [int(c) for c in row]) for i, row in enumerate(v)], "`the key` string, features array<int>")
    for rounds in (0, 12):
        found, _, _ = clustering.nmf(df, "the key", 2, rounds=rounds)
        assert found.dtypes == [("the key", "string"), ("w", "array<double>")]
        got = {r["the key"]: r["w"] for r in found.collect()}
        assert sorted(got) == sorted(f"k{i}" for i in range(40)) and all(len(w) == 2 for w in got.values())
    assert stored and all(s["v"].dataType.simpleString() == s["w"].dataType.simpleString() == "binary" for s in stored)


def test_clusterings_label_every_row(spark):
    df, _, _ = points(spark)
    for found in (clustering.kmeans(df, 2), clustering.gaussian_mixture(df, 2)):
        assert found.count() == 240 and set(r[0] for r in found.select("cluster").distinct().collect()) <= {0, 1}
    cost = {r[0]: r[1] for r in clustering.elbow(df, [1, 2, 4]).collect()}
    assert cost[1] > cost[2] > cost[4]
    bic = clustering.mixture_bic(df, [1, 2]).collect()
    assert bic[0]["bic"] >= bic[1]["bic"]
    x = np.array([r["features"] for r in df.collect()])
    cov = np.cov(x.T, bias=True)
    z = x - x.mean(axis=0)
    density = -0.5 * ((z @ np.linalg.inv(cov)) * z).sum(axis=1) - 0.5 * np.log(np.linalg.det(2 * np.pi * cov))
    assert {r["k"]: r["bic"] for r in bic}[1] == pytest.approx(2 * density.sum() - 20 * np.log(240))


@pytest.mark.parametrize("variant", ["discrete", "real", "gentle", "m1"])
def test_boosting_learns(spark, variant):
    found = sv.adaboost(*halves(spark), "id", rounds=3, variant=variant)
    assert found.count() == 80 and accuracy(found) > 0.9


def test_learners(spark):
    train, test = halves(spark)
    for model, least in ((sv.logistic_regression(), 0.9), (sv.linear_svm(maxIter=10), 0.9), (sv.decision_tree(), 0.9),
                         (sv.gradient_boosting(3, 3), 0.9), (sv.network(5, [4], maxIter=60), 0.8)):
        found = sv.fit_predict(model, train, test, "id")
        assert found.count() == 80 and accuracy(found) > least, model
        assert found.where("probability < 0 or probability > 1").count() == 0


def test_neighbours_in_blocks_match_brute_force(spark):
    df, x, label = points(spark, 150)
    train, test = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    one = nearest(train, test, "id", 4).collect()
    many = nearest(train, test, "id", 4, block_rows=20).collect()
    key = lambda rows: sorted((r["id"], r["rank"], r["neighbour"]) for r in rows)
    assert key(one) == key(many)
    ids = np.arange(0, 150, 2)
    want = ids[np.argsort(((x[ids] - x[7]) ** 2).sum(axis=1), kind="stable")[:4]]
    assert [r["neighbour"] for r in sorted(many, key=lambda r: r["rank"]) if r["id"] == 7] == list(want)
    assert accuracy(sv.knn_vote(train, test, "id", 3, 20)) > 0.9


@pytest.mark.parametrize("pivots, k", [(1, 3), (12, 1), (12, 7), (40, 500)])
def test_neighbours_over_pivots_match_brute_force(spark, pivots, k):
    rng = np.random.default_rng(4)
    centres = rng.normal(scale=30, size=(6, 5))
    x = np.round(centres[rng.integers(0, 6, 400)] + rng.normal(size=(400, 5)), 1)
    x[100:160] = x[100]  # ties, many rows in one place
    df = spark.createDataFrame([(i, r.tolist(), float(i % 3)) for i, r in enumerate(x)], "id bigint, features array<double>, label double")
    train, test = df.where("id < 320").repartition(5), df.where("id >= 320 OR id = 100")
    got = sorted((r["id"], r["rank"], r["neighbour"]) for r in nearest(train, test, "id", k, 30, pivots).collect())
    want = []
    for i in [100, *range(320, 400)]:
        d = np.sqrt(((x[:320] - x[i]) ** 2).sum(axis=1))
        want += [(i, n + 1, int(j)) for n, j in enumerate(np.argsort(d, kind="stable")[:k])]
    assert got == sorted(want)
    assert nearest(train.limit(0), test, "id", k).count() == 0 and nearest(train, test.limit(0), "id", k).count() == 0


def test_few_partitions_are_compared(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(scale=40, size=(10, 4))[rng.integers(0, 10, 1500)] + rng.normal(size=(1500, 4))
    df = spark.createDataFrame([(i, r.tolist(), 0.0) for i, r in enumerate(x)], "id bigint, features array<double>, label double")
    train, test = df.where("id < 1400"), df.where("id >= 1400")
    _, parts = neighbours.partitioned(train, "id", 40)
    first = neighbours.visits(test, parts, "id", 5, False).count()
    limits = nearest(train, test, "id", 5, pivots=40).groupBy("id").agg({"distance": "max"}).toDF("id", "limit")
    more = neighbours.visits(test.join(limits, "id"), parts, "id", 5, True).count()
    assert parts.count.sum() == 1400 and first + more < 0.3 * 100 * 40


def test_neighbours_far_from_the_origin_are_exact(spark):
    rng = np.random.default_rng(2)
    x = 1e6 + rng.normal(size=(600, 8))
    rows = [(i, [float(v) for v in r], float(i % 2)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, features array<double>, label double")
    train, test = df.where("id >= 20"), df.where("id < 20")
    found = {(r["id"], r["rank"]): r for r in nearest(train, test, "id", 3, block_rows=10_000).collect()}
    for i in range(20):
        d = np.sqrt(((x[20:] - x[i]) ** 2).sum(axis=1))
        best = np.argsort(d, kind="stable")[:3]
        assert [found[(i, k + 1)]["neighbour"] for k in range(3)] == (best + 20).tolist()
        assert np.allclose([found[(i, k + 1)]["distance"] for k in range(3)], d[best])


@pytest.mark.parametrize("offset, scale", [(0.0, 1.0), (1e6, 1.0), (1e9, 1e-5), (0.0, 1e-30), (0.0, 1e20), (0.0, 1e160)])
def test_pairs_by_products_are_those_of_direct_differences(offset, scale):
    rng = np.random.default_rng(6)
    x, y = (offset + scale * np.round(rng.normal(size=(n, 4)), 1) for n in (60, 5000))  # ties, more than one block of columns
    y[::50] = x[0]
    with np.errstate(over="ignore"):
        far = neighbours.distances(x, y)
    for n, limit in ((3, np.full(60, np.inf)), (8, np.sort(far, axis=1)[:, 11]), (5000, np.sort(far, axis=1)[:, 3])):
        rows, columns, distance = neighbours.closest_pairs(x, y, n, limit)
        got = [(i, j, d) for i, j, d in zip(rows, columns, distance) if d <= limit[i]]
        assert got == [(i, j, far[i, j]) for i in range(60) for j in np.argsort(far[i], kind="stable")[:n] if far[i, j] <= limit[i]]


def test_rows_that_reach_all_partitions_are_copied_once_a_group(spark, monkeypatch):
    x = np.random.default_rng(7).normal(size=(900, 24))  # nothing can be ruled out
    df = spark.createDataFrame([(i, r.tolist(), float(i % 2)) for i, r in enumerate(x)], "id bigint, features array<double>, label double")
    train, test = df.where("id < 800"), df.where("id >= 800")
    asked, compared = [], neighbours._compared
    monkeypatch.setattr(neighbours, "_compared", lambda visits, *rest: asked.append(visits.count()) or compared(visits, *rest))
    found = nearest(train, test, "id", 3, block_rows=200, pivots=40).collect()
    assert asked[0] <= 200 and asked[1] <= 100 * 4
    for r in found:
        far = np.sqrt(((x[:800] - x[r["id"]]) ** 2).sum(axis=1))
        assert r["neighbour"] == np.argsort(far, kind="stable")[r["rank"] - 1] and r["distance"] == pytest.approx(far[r["neighbour"]])
    assert len(found) == 300


def test_groups_of_partitions_hold_neighbours():
    rng = np.random.default_rng(8)
    places, count = np.repeat(np.arange(8.0), 30)[:, None] * 100 + rng.normal(size=(240, 3)), rng.integers(1, 20, 240)
    groups = neighbours.Pivots(places, count, None, None).groups(math.ceil(count.sum() / 8))
    assert len(np.unique(groups)) == 8 and np.bincount(groups, weights=count).max() < 2 * count.sum() / 8
    assert np.median([np.ptp(places[groups == g], axis=0).max() for g in range(8)]) < 120
    one = neighbours.Pivots(places[:1], np.array([500]), None, None)
    assert list(one.groups(20)) == [0] and len(neighbours.Pivots(np.zeros((0, 0)), *[np.zeros(0)] * 3).groups(20)) == 0


def test_rows_without_key_or_number_keep_their_first_neighbours(spark):
    rows = [(i, [float(i), 0.0], 0.0) for i in range(20)]
    train = spark.createDataFrame(rows, "id bigint, features array<double>, label double")
    test = spark.createDataFrame([(None, [3.2, 0.0], 0.0), (50, [float("nan"), 0.0], 0.0), (51, [7.2, 0.0], 0.0)], train.schema)
    found = {(r["id"], r["rank"]): r["neighbour"] for r in nearest(train, test, "id", 2, pivots=3).collect()}
    assert len(found) == 6 and [found[(51, n)] for n in (1, 2)] == [7, 8] and [found[(None, n)] for n in (1, 2)] == [3, 4]


def test_bootstrap_counts_have_no_ceiling(spark):
    from cohortlens.operators import sampling

    counts = [r["times"] for r in sampling.bootstrap_bags(spark.range(3000), "id", 1, 20.0).collect()]
    assert abs(np.mean(counts) - 20) < 0.5 and max(counts) > 30


def test_sgd_equals_a_loop_over_minibatches(spark):
    df, x, label = points(spark, 90)
    draws = df.select("id", F.floor(uniform(7, "id", F.lit("batch")) * 6).alias("batch"),
                      F.array(*[uniform(7, "id", F.lit(b)) < 0.6 for b in range(3)]).alias("on")).orderBy("id").collect()
    batch, on = np.asarray([r["batch"] for r in draws]), np.asarray([r["on"] for r in draws])
    w = np.zeros((3, 5))
    for step in range(12):
        for b in range(3):
            rows = (batch == step % 6) & on[:, b]
            p = 1 / (1 + np.exp(-x[rows] @ w[b]))
            w[b] += 0.3 * ((label[rows] - p) @ x[rows] / max(rows.sum(), 1) - 2 * 0.01 * w[b])
    for layout in (2, 40):
        found = sv.sgd_weights(df.repartition(layout), "id", 5, bags=3, eta=0.3, mu=0.01, steps=6, passes=2).orderBy("bag").collect()
        assert np.allclose([r["weights"] for r in found], w, rtol=1e-10, atol=1e-12)
    assert accuracy(sv.sgd_scores(df, sv.sgd_weights(df, "id", 5, passes=3), ["id", "label"])) > 0.7


@pytest.mark.parametrize("degree", [2, 3, 4, 5])
def test_tensor_sketch_estimates_the_kernel(degree):
    rng = np.random.default_rng(degree)
    x, y = (rng.normal(size=(300, 8)) / 3 for _ in range(2))
    means = []
    for width in (256, 4096):
        found = [kernels.TensorSketch(degree, 8, width, 0.7, 1.3, seed) for seed in range(30)]
        errors = np.asarray([(s.features(x) * s.features(y)).sum(axis=1) - s.kernel(x, y) for s in found])
        assert (np.abs(errors) <= 3 * found[0].spread(x, y)).mean() >= 8 / 9
        assert (errors ** 2).mean() <= (found[0].spread(x, y) ** 2).mean()
        means.append(np.abs(errors).mean())
    assert means[1] < 0.4 * means[0]  # sixteen times the width, a quarter of the error


def test_polynomial_sweep_separates_rings(spark):
    rng = np.random.default_rng(1)
    angle, ring = rng.uniform(0, 2 * np.pi, 240), rng.integers(0, 2, 240)
    x = np.c_[np.cos(angle), np.sin(angle)] * (0.5 + ring)[:, None]
    df = sv.with_vector(spark.createDataFrame([(i, [float(v) for v in x[i]], int(ring[i])) for i in range(240)],
                                              "id long, features array<double>, label int"))
    found = kernels.polynomial_svc_sweep(df.where("id % 3 > 0"), df.where("id % 3 = 0"), "id", 2, [2, 3], [0.001, 100.0], 64)
    errors = {(r["degree"], r["cost"]): (r["errors"], r["rows"]) for r in found.collect()}
    assert set(errors) == {(2, 0.001), (2, 100.0), (3, 0.001), (3, 100.0)}
    assert errors[(2, 100.0)][0] <= 4 and all(rows == 80 for _, rows in errors.values())


def test_polynomial_sweep_fits_costs_together(spark, monkeypatch):
    met, fit = threading.Barrier(2), kernels.fit_predict

    def meeting(*args):
        met.wait(60)  # breaks if no other fit begins
        return fit(*args)

    monkeypatch.setattr(kernels, "fit_predict", meeting)
    df = spark.createDataFrame([(i, [i / 60, (i % 7) / 7], int(i >= 30)) for i in range(60)], "id long, features array<double>, label int")
    found = kernels.polynomial_svc_sweep(df.where("id % 3 > 0"), df.where("id % 3 = 0"), "id", 2, [2, 3], [100.0, 0.001], 64)
    assert [(r["degree"], r["cost"], r["rows"]) for r in found.collect()] == [(2, 100.0, 20), (2, 0.001, 20), (3, 100.0, 20), (3, 0.001, 20)]


def test_validation_tables(spark):
    df = sv.with_vector(points(spark)[0])
    score = lambda train, test: sv.fit_predict(sv.logistic_regression(maxIter=5), train, test, "id")
    runs = evaluation.k_fold(df, "id", score, 3)
    assert runs.count() == 3 and evaluation.mean_scores(runs).first()["accuracy"] > 0.9
    assert evaluation.repeated_holdout(df, "id", score, 2).count() == 2
    assert len(evaluation.feature_subsets(["a", "b"])) == 6


def test_kernels(spark):
    df, _, _ = points(spark)
    rows = sv.radial_features(df, 60, 0.2, 5)
    found = sv.fit_predict(sv.linear_svm(maxIter=10), rows.where("id % 3 > 0"), rows.where("id % 3 = 0"), "id")
    assert accuracy(found) > 0.8
    assert sv.polynomial_features(sv.with_vector(df), 2).first()["vector"].size == 20


def test_encoding_keeps_all_levels(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "f string, x double")
    rows = transforms.encoder(["f"], ["x"]).fit(df).transform(df)
    assert rows.first()["features"].size == 4
    assert transforms.one_hot(df, "f").columns[-3:] == ["f_a", "f_b", "f_c"]
    with pytest.raises(ValueError):
        transforms.one_hot(df, "f", max_levels=2)


def test_sums_do_not_depend_on_partitions(spark):
    df, x, _ = points(spark)
    total = passes.summed(df.repartition(6), ["features"], lambda b: passes.matrix(b["features"]).sum(axis=0), (5,))
    assert np.allclose(total, x.sum(axis=0))


def test_svmlight_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0.5), (1, 2, 1.0), (2, 1, 0.25)], "patient_id long, idx long, value double")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "patient_id long, label int")
    lines = svmlight.labelled_lines(svmlight.sparse_text(rows, base=1), labels)
    svmlight.write_lines(lines, str(tmp_path / "rows"))
    read = {r["label"]: r["features"] for r in svmlight.read_svmlight(spark, str(tmp_path / "rows"), 4).collect()}
    assert read[1.0] == Vectors.sparse(4, {0: 0.5, 2: 1.0}) and read[0.0] == Vectors.sparse(4, {1: 0.25})


def test_bad_values_become_null(spark, tmp_path):
    (tmp_path / "e.csv").write_text("1,LAB1,desc,2000-01-02,3.5\nx,LAB2,desc,not-a-date,oops\n")
    rows = delimited.load_delimited(spark, str(tmp_path / "e.csv"), delimited.EVENT_SCHEMA).orderBy("event_id").collect()
    assert rows[0]["value"] == 3.5 and rows[1]["patient_id"] is None and rows[1]["etimestamp"] is None


def test_names_and_views(spark, tmp_path):
    assert delimited.table_name("data/medication_orders.csv") == "medication_orders"
    assert delimited.table_name("/a/b/labs") == "labs"
    (tmp_path / "people.csv").write_text("id,name\n1,Ann\n")
    delimited.load_csv_table(spark, str(tmp_path / "people.csv"))
    assert spark.table("people").first()["name"] == "Ann"


def test_saved_pipeline(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1)], "f string, x double, label int")
    model = transforms.encoder(["f"], ["x"]).fit(df)
    models.save_model(model, str(tmp_path / "m"))
    assert models.load_model(str(tmp_path / "m")).transform(df).count() == 2


def test_checkpoints_go_to_the_named_folder(spark):
    folder = shared_dir(spark)
    current = spark.sparkContext.getCheckpointDir()
    assert current.startswith(("file:" + folder, folder)) and shared_dir(spark) in (folder, current)
    assert checkpointed(spark.range(3)).count() == 3


def test_phenotype_purity_workload(spark, sf_dir):
    found = workloads.phenotype_purity(
        tables.diagnostics(spark, sf_dir), tables.medications(spark, sf_dir), tables.labs(spark, sf_dir),
        tables.RULES, nmf_rounds=5)
    assert not found.inputFiles()  # the labels come from the stored rows, no table is read for them again
    found = found.collect()
    assert {r["method"] for r in found} == {"kmeans", "mixture", "nmf"}
    assert all(1 / 3 <= r["purity"] <= 1 for r in found)


def test_nearest_mean_with_ties_pulls_and_nulls(spark):
    train = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0), (1, None), (None, 4.0)], "label int, x double")
    rows = spark.createDataFrame([(3.4,), (3.5,), (3.6,), (None,)], "x double")
    assert [r.prediction for r in sv.nearest_mean(train, ["x"])(rows).collect()] == [0, 0, 1, None]
    assert [r.prediction for r in sv.nearest_mean(train, ["x"], pulls=[1.0, 2.0])(rows).collect()] == [0, 0, 0, None]
    with pytest.raises(ValueError):
        sv.nearest_mean(train.where("label > 1"), ["x"])


def test_normal_draws_repeat_and_look_normal():
    draws = transforms.normal_draws(3, 200, 50)
    assert (draws == transforms.normal_draws(3, 200, 50)).all() and (draws != transforms.normal_draws(4, 200, 50)).any()
    assert abs(draws.mean()) < 0.05 and abs(draws.std() - 1) < 0.05


def test_uniform_of_equals_the_column(spark):
    from cohortlens.functions.columns import uniform, uniform_of

    rows = spark.createDataFrame([(1, "a"), (2, "é")], "i int, s string")
    assert [r.u for r in rows.select(uniform(5, "i", "s").alias("u")).collect()] == [uniform_of(5, 1, "a"), uniform_of(5, 2, "é")]


def test_visits_of_many_pivots_leave_in_small_frames():
    class Rows:
        schema = StructType([StructField("id", LongType())])

        def mapInPandas(self, plan, schema):
            return plan

    rng = np.random.default_rng(0)
    pivots = neighbours.Pivots(rng.normal(size=(600, 4)), np.full(600, 3), np.zeros(600), np.full(600, 50.0))
    rows = pd.DataFrame({"id": np.arange(40), "features": list(rng.normal(size=(40, 4))), "limit": np.full(40, 9.0)})
    frames = list(neighbours.visits(Rows(), pivots, "id", 5, True)(iter([rows])))
    assert max(len(f) for f in frames) <= 8192
    found = pd.concat(frames)
    # two partitions hold five rows; all others are visited afterwards, each once
    assert len(found) == 40 * 598 and not found.duplicated(["id", "pivot"]).any()
    assert all((f == rows["features"][i]).all() for i, f in zip(found["id"], found["features"]))


@pytest.mark.parametrize("query", ["feature_ablation", "param_sweep"])
def test_rows_of_many_fits_are_joined_once(spark, tmp_path, monkeypatch, query):
    spark.range(40).selectExpr("id AS o_orderkey", "id % 4 AS o_custkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus",
                               "date'1995-01-01' AS o_orderdate", "id * 10000.0D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(4).selectExpr("id AS c_custkey", "'AUTO' AS c_mktsegment", "id AS c_nationkey", "id * 1.0D AS c_acctbal").write.parquet(
        f"{tmp_path}/customer.parquet")
    seen = []
    for name in ("feature_ablation", "parameter_sweep"):
        monkeypatch.setattr(evaluation, name, lambda values, train, test, fit: seen.extend([train, test]))
    model_queries.QUERIES[query](spark, str(tmp_path))
    assert sum(df.count() for df in seen) == 40
    assert all("Join" not in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)


def test_boosting_keeps_the_rows_of_a_round(spark, monkeypatch):
    df = sv.with_vector(points(spark, 60)[0])
    kept, fit = [], sv.DecisionTreeClassifier.fit
    # the last plan steps above the kept rows are only the new weights
    monkeypatch.setattr(sv.DecisionTreeClassifier, "fit", lambda tree, rows: kept.append(
        "InMemoryRelation" in rows._jdf.queryExecution().withCachedData().toString()) or fit(tree, rows))
    assert sv.adaboost(df, df, "id", rounds=3, variant="real").count() == 60
    assert kept == [True] * 3


@pytest.mark.parametrize("variant", ["discrete", "real", "gentle", "m1"])
def test_boosting_scores_the_rows_once_a_round(spark, monkeypatch, variant):
    train, test = halves(spark)
    model = type((sv.DecisionTreeRegressor(labelCol="label", featuresCol="vector") if variant == "gentle"
                  else sv.DecisionTreeClassifier(featuresCol="vector")).fit(train))
    scored, transform = [], model.transform
    monkeypatch.setattr(model, "transform", lambda tree, df: scored.append("id" in df.columns) or transform(tree, df))
    assert sv.adaboost(train, test, "id", rounds=3, variant=variant).count() == 80
    # train rows carry no key; the others are the test rows
    assert scored.count(False) == 3 and scored.count(True) == 3


def test_rows_of_the_learners_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(exact_queries, "ROWS_PER_TASK", 100)
    one = spark.range(400).coalesce(1)
    size = lambda df: sorted(len(p) for p in df.rdd.glom().collect())
    parts = size(exact_queries._dealt(one))
    assert sum(parts) == 400 and len(parts) == 4 and parts[0] > 50
    monkeypatch.setattr(exact_queries, "MOST_ROWS_PER_TASK", 40)
    assert len(size(exact_queries._dealt(one))) == 10
    assert size(exact_queries._dealt(spark.range(3))) == [3] and size(exact_queries._dealt(one.limit(0))) in ([], [0])


def test_learners_are_fitted_several_at_a_time(spark, monkeypatch, tmp_path):
    spark.range(50).selectExpr("id + 1.0D AS l_quantity", "int(id % 7) + 1 AS l_linenumber").write.parquet(f"{tmp_path}/lineitem.parquet")
    meet = threading.Barrier(exact_queries.PARALLEL_FITS)

    class Learner:
        def fit(self, train):
            meet.wait(60)  # broken, if they come one after the other
            return self

        def transform(self, test):
            return test.withColumn("prediction", F.lit(1.0))

    for name in ("linear_svm", "logistic_regression", "one_vs_rest", "decision_tree", "gradient_boosting", "network"):
        monkeypatch.setattr(sv, name, lambda *a, **b: Learner())
    both = lambda train, test, *a, **b: Learner().fit(train).transform(test)
    monkeypatch.setattr(sv, "adaboost", both)
    monkeypatch.setattr(sv, "bagged_trees", lambda train, test, key: test.withColumn("prediction", F.lit(1.0)))
    found = exact_queries.QUERIES["band_majorities"](spark, str(tmp_path))
    assert found.count() == 13 * 5 and found.select("learner").distinct().count() == 13 and found.where("prediction = 1").count() == 65


def test_checkpoints_of_several_threads_leave_the_setting_as_it_was(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    stored, errors = [], []

    def store(n):
        try:
            stored.append(checkpointed(spark.range(n).groupBy((F.col("id") % 3).alias("g")).count()).count())
        except Exception as x:
            errors.append(x)

    threads = [threading.Thread(target=store, args=(100 + i,)) for i in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors and stored == [3] * 6 and spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == before
