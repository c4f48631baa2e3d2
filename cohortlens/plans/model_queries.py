"""Fitted transforms, clusterings and models over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators import (
    clustering, evaluation, kernels, ordering, profile, random_trees, sampling, supervised as sv, timeseries as ts, transforms)
from cohortlens.plans import tables as t, workloads
from cohortlens.sources import models, svmlight
from cohortlens.session import checkpointed, staging_path

N = 64
SGD_STEPS = 20
DEGREES = (2, 3, 4, 5)
COSTS = tuple(10.0 ** e for e in range(-3, 4))
#: Scale of the dot products in polynomial kernels of the embeddings.
GAMMA = 1.0
SKETCH_WIDTH = 512


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return t.feature_rows(spark, d)


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two-class rows with ``vector``, tagged to train and test by key."""
    rows = sv.with_vector(_rows(spark, d).withColumn("label", F.when(F.col("label") >= 5, 1).otherwise(0)))
    tagged = sampling.random_split(rows, "vec_id", [0.7, 0.3])
    return tagged.where(F.col("part") == 0), tagged.where(F.col("part") == 1)


def _classify(estimator):
    return lambda s, d: sv.fit_predict(estimator(), *_halves(s, d), "vec_id")


def _mixed_halves(spark: SparkSession, d: str, numbers=("nation", "balance", "year", "month")):
    # stored: every fit reads the rows several times, and their join would run each time
    rows = checkpointed(t.mixed(spark, d))
    encoding = transforms.encoder(["segment", "priority", "status"], list(numbers), "vector").fit(rows)
    tagged = sampling.random_split(encoding.transform(rows), "row_id", [0.7, 0.3])
    return tagged.where(F.col("part") == 0), tagged.where(F.col("part") == 1)


def _pca_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = transforms.standardise(_rows(spark, d))
    return transforms.pca(rows, 10).transform(rows, ["vec_id", "label"])


def _pca_variances(spark: SparkSession, d: str) -> DataFrame:
    table = transforms.pca(_rows(spark, d)).components_table(spark)
    return ordering.with_running_sums(table, ["component"], {"cumulative": F.col("share")})


def _pca_loadings(spark: SparkSession, d: str) -> DataFrame:
    return (transforms.pca(_rows(spark, d), 3).loadings(spark).where(F.col("component") == 1)
            .orderBy(F.desc("loading"), "feature").limit(5))


def _reconstruction(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    return transforms.reconstruction_errors(rows, transforms.pca(rows), [1, 5, 10, 20, 40, N])


def _ica(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d)
    found = transforms.ica(rows, 3, max_rounds=20)
    parts = found.transform(rows, ["vec_id"])
    wide = parts.select("vec_id", *[F.col("features")[i].alias(f"c{i + 1}") for i in range(3)])
    summary = profile.stack(wide, ["c1", "c2", "c3"]).groupBy("column").agg((F.kurtosis("value") + 3).alias("kurtosis"))
    shares = found.components_table(spark).select(F.concat(F.lit("c"), "component").alias("column"), "share")
    return summary.join(shares, "column")


def _reduced(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    rows = _rows(spark, d)
    keep = ["vec_id", "label"]
    wide = rows.select(*keep, *[F.col("features")[i].alias(f"f{i}") for i in range(N)])
    names = [f"f{i}" for i in range(N)]
    gains = profile.information_gain(profile.equal_width_bins(wide, names), names, "label")
    best = [int(r["column"][1:]) for r in profile.positive_gain(gains, 20).collect()]
    return {
        "pca": transforms.pca(rows, 10).transform(rows, keep),
        "ica": transforms.ica(rows, 5, max_rounds=10).transform(rows, keep),
        "random": transforms.random_projection(N, 10, 1).transform(rows, keep),
        "gain": rows.select(*keep, F.array(*[F.col("features")[i] for i in best]).alias("features")),
    }


def _reduced_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clustering.cluster_reduced(_reduced(spark, d), [3, 10], "label", {"pca": 3})


def _cluster_features(spark: SparkSession, d: str) -> DataFrame:
    spaces = _reduced(spark, d)
    return transforms.cluster_features(
        {name: clustering.kmeans(space, 3) for name, space in spaces.items()}, "vec_id")


def _nmf(spark: SparkSession, d: str) -> DataFrame:
    rows = _rows(spark, d).withColumn("features", F.transform("features", lambda v: F.abs(v)))
    return clustering.nmf_clusters(rows, "vec_id", 3, rounds=20)


def _kernel(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        if kind == "radial":
            halves = [sv.radial_features(h.drop("vector"), 100, 0.05, N) for h in _halves(spark, d)]
        else:
            halves = [sv.polynomial_features(h, 2) for h in _halves(spark, d)]
        return sv.fit_predict(sv.linear_svm(maxIter=20), *halves, "vec_id")
    return run


def _polynomial_sweep(spark: SparkSession, d: str) -> DataFrame:
    return kernels.polynomial_svc_sweep(*_halves(spark, d), "vec_id", N, DEGREES, COSTS, SKETCH_WIDTH, GAMMA)


def _sketch_errors(spark: SparkSession, d: str) -> DataFrame:
    """Per degree: pairs of neighbouring ids, their mean kernel, and whether eight of nine estimates lie in three spreads."""
    rows = _rows(spark, d)
    pairs = (rows.select("vec_id", F.col("features").alias("x"))
             .join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("features").alias("y")), "vec_id"))
    out = None
    for degree in DEGREES:
        found = kernels.estimates(pairs, kernels.TensorSketch(degree, N, SKETCH_WIDTH, GAMMA))
        close = F.abs(F.col("estimate") - F.col("kernel")) <= 3 * F.col("spread")
        row = found.agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("kernel"), 6).alias("mean_kernel"),
                        (F.avg(close.cast("int")) >= 8 / 9).alias("within")).select(F.lit(degree).alias("degree"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _one_vs_rest(spark: SparkSession, d: str) -> DataFrame:
    rows = sv.with_vector(_rows(spark, d).withColumn("label", F.col("label") % 3))
    tagged = sampling.random_split(rows, "vec_id", [0.7, 0.3])
    model = sv.one_vs_rest(sv.linear_svm(maxIter=10, labelCol="label"))
    return sv.fit_predict(model, tagged.where(F.col("part") == 0), tagged.where(F.col("part") == 1), "vec_id").drop("probability")


def _sgd(spark: SparkSession, d: str) -> DataFrame:
    train, test = _halves(spark, d)
    scored = sv.sgd_scores(test, sv.sgd_weights(train, "vec_id", N, steps=SGD_STEPS), ["vec_id", "label"])
    return scored.withColumn("probability", F.round("probability", 6))


def _price_features(spark: SparkSession, d: str) -> DataFrame:
    """Signals that predict the ten-day return, one row per symbol and day."""
    w = ts.by_symbol()
    found = ts.rsi(ts.ema(t.prices(spark, d), [30, 200]))
    rows = found.select("symbol", "trade_date", "price", F.try_divide("price", "ema_30").alias("r30"),
                        F.try_divide("price", "ema_200").alias("r200"), "rsi",
                        ts.forward_return("price", 10, w).alias("target"))
    complete = rows.dropna()
    return sv.with_vector(complete.withColumn("features", F.array("r30", "r200", "rsi"))).withColumn(
        "day_key", F.concat_ws(":", "symbol", "trade_date"))


def _bagged(spark: SparkSession, d: str) -> DataFrame:
    rows = _price_features(spark, d)
    return sv.bagged_trees(rows, rows, "day_key")


def _random_split(spark: SparkSession, d: str) -> DataFrame:
    """Trees on the symbols' price ratios and the market's RSI."""
    found = workloads.price_features(t.prices(spark, d), t.MARKET).dropna()
    rows = found.withColumn("features", F.array("r30", "r200", "rsi")).withColumn("day_key", F.concat_ws(":", "symbol", "trade_date"))
    return random_trees.random_split_trees(rows, rows, "day_key", trees=15, leaf_rows=50)


def _logistic(train: DataFrame, test: DataFrame) -> DataFrame:
    return sv.fit_predict(sv.logistic_regression(maxIter=20), train, test, "vec_id")


def _all_rows(spark: SparkSession, d: str) -> DataFrame:
    return sv.with_vector(_rows(spark, d).withColumn("label", F.when(F.col("label") >= 5, 1).otherwise(0)))


def _tree_fit(leaf_rows: int, train: DataFrame):
    model = sv.decision_tree(leaf_rows=leaf_rows).fit(train)
    return lambda df: model.transform(df).select("label", "prediction")


def _sweep(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.parameter_sweep([1, 5, 10], *_mixed_halves(spark, d), _tree_fit)


def _ablation(spark: SparkSession, d: str) -> DataFrame:
    numbers = ["nation", "balance", "month"]
    rows = sampling.random_split(checkpointed(t.mixed(spark, d)), "row_id", [0.7, 0.3])

    def fit(names, train):
        encoding = transforms.encoder([], names, "vector").fit(train)
        model = sv.decision_tree().fit(encoding.transform(train))
        return lambda df: model.transform(encoding.transform(df)).select("label", "prediction")

    return evaluation.feature_ablation(numbers, rows.where(F.col("part") == 0), rows.where(F.col("part") == 1), fit)


def _curve(spark: SparkSession, d: str) -> DataFrame:
    train, test = _mixed_halves(spark, d)
    total = train.count()
    sizes = [total // 4, total // 2, total]
    return evaluation.learning_curve(sizes, train, test, "row_id", lambda n, df: _tree_fit(1, df))


def _saved(spark: SparkSession, d: str) -> DataFrame:
    """A fitted encoding and model, written, read back and used for a submission."""
    rows = t.mixed(spark, d)
    encoding = transforms.encoder(["segment", "priority"], ["balance", "month"], "vector")
    encoding.setStages([*encoding.getStages(), sv.logistic_regression(maxIter=10)])
    path = staging_path(spark, "model")
    models.save_model(encoding.fit(rows), path)
    scored = sv._positive(models.load_model(path).transform(rows))
    return svmlight.submission(scored, "row_id")


QUERIES = {
    "pca_scores": _pca_scores,
    "pca_variances": _pca_variances,
    "pca_top_loadings": _pca_loadings,
    "pca_reconstruction": _reconstruction,
    "ica_components": _ica,
    "random_projection": lambda s, d: transforms.random_projection(N, 10, 1).transform(_rows(s, d), ["vec_id"]),
    "random_projection_errors": lambda s, d: transforms.random_projection_errors(_rows(s, d), N, [10, 50], 5),
    "kmeans_clusters": lambda s, d: clustering.kmeans(_rows(s, d)).select("vec_id", "label", "cluster"),
    "kmeans_purity_by_k": lambda s, d: clustering.purity_by_k(_rows(s, d), [3, 10], "label"),
    "kmeans_elbow": lambda s, d: clustering.elbow(_rows(s, d), [1, 2, 5]),
    "gmm_clusters": lambda s, d: clustering.gaussian_mixture(_pca_scores(s, d)).select("vec_id", "label", "cluster"),
    "gmm_bic": lambda s, d: clustering.mixture_bic(_pca_scores(s, d), [1, 2]),
    "nmf_clusters": _nmf,
    "reduced_space_clusters": _reduced_clusters,
    "cluster_features": _cluster_features,
    "logreg": _classify(lambda: sv.logistic_regression(maxIter=20)),
    "linear_svc": _classify(lambda: sv.linear_svm(maxIter=20)),
    "kernel_svc": _kernel("radial"),
    "polynomial_svc": _kernel("polynomial"),
    "polynomial_svc_sweep": _polynomial_sweep,
    "polynomial_sketch_errors": _sketch_errors,
    "one_vs_rest_svc": _one_vs_rest,
    "decision_tree": _classify(sv.decision_tree),
    "decision_tree_mixed": lambda s, d: sv.fit_predict(sv.decision_tree(), *_mixed_halves(s, d), "row_id"),
    "gbt": _classify(lambda: sv.gradient_boosting(trees=5, max_depth=4)),
    "adaboost": lambda s, d: sv.adaboost(*_halves(s, d), "vec_id", rounds=5),
    "adaboost_real": lambda s, d: sv.adaboost(*_halves(s, d), "vec_id", rounds=3, variant="real"),
    "adaboost_gentle": lambda s, d: sv.adaboost(*_halves(s, d), "vec_id", rounds=3, variant="gentle"),
    "adaboost_m1": lambda s, d: sv.adaboost(*_halves(s, d), "vec_id", rounds=5, variant="m1"),
    "mlp": _classify(lambda: sv.network(N, [8], maxIter=30)),
    "sgd_ensemble": _sgd,
    "bagged_trees": _bagged,
    "random_split_trees": _random_split,
    "kfold_scores": lambda s, d: evaluation.k_fold(_all_rows(s, d), "vec_id", _logistic, 3),
    "holdout_cv": lambda s, d: evaluation.repeated_holdout(_all_rows(s, d), "vec_id", _logistic, 3),
    "param_sweep": _sweep,
    "feature_ablation": _ablation,
    "learning_curve": _curve,
    "saved_model_submission": _saved,
}


def _sgd_sql() -> str:
    """Every minibatch step of every bag, one after the other."""
    steps = "".join(f""",
        z{n} AS MATERIALIZED (SELECT m.vec_id, m.bag, m.y - 1 / (1 + exp(-sum(c.v * w.w))) AS missed
                FROM members m JOIN cells c USING (vec_id) JOIN w{n} w ON w.bag = m.bag AND w.pos = c.pos
                WHERE m.batch = {n} GROUP BY m.vec_id, m.bag, m.y),
        w{n + 1} AS MATERIALIZED (SELECT w.bag, w.pos, w.w + 0.5 * coalesce(g.g, 0) AS w FROM w{n} w LEFT JOIN (
                SELECT z.bag, c.pos, avg(z.missed * c.v) AS g FROM z{n} z JOIN cells c USING (vec_id) GROUP BY 1, 2) g
                ON g.bag = w.bag AND g.pos = w.pos)""" for n in range(SGD_STEPS))
    return t.with_tables("cells", f"""
        , halves AS (SELECT vec_id, CAST(label >= 5 AS INT) AS y, {t.uniform_sql(7, "vec_id")} <= 0.7 AS train FROM embeddings),
        members AS MATERIALIZED (
            SELECT vec_id, y, bag, CAST(floor({t.uniform_sql(7, "vec_id", "'batch'")} * {SGD_STEPS}) AS INT) AS batch
            FROM halves, range(5) AS b(bag) WHERE train AND {t.uniform_sql(7, "vec_id", "bag")} < 0.6),
        w0 AS (SELECT bag, pos, 0.0 AS w FROM range(5) AS b(bag), range(1, {N + 1}) AS p(pos)){steps},
        scores AS (SELECT h.vec_id, h.y, w.bag, 1 / (1 + exp(-sum(c.v * w.w))) AS p
                   FROM halves h JOIN cells c USING (vec_id) JOIN w{SGD_STEPS} w USING (pos) WHERE NOT h.train GROUP BY 1, 2, 3)
        SELECT vec_id, y AS label, round(avg(p), 6) AS probability, CAST(avg(p) > 0.5 AS DOUBLE) AS prediction
        FROM scores GROUP BY vec_id, y""")


ORACLES = {
    "polynomial_sketch_errors": t.with_tables("cells", f"""
        , dots AS (SELECT a.vec_id, {GAMMA} * sum(a.v * b.v) + 1 AS dot FROM cells a JOIN cells b
                   ON b.vec_id = a.vec_id + 1 AND a.pos = b.pos GROUP BY a.vec_id)
        SELECT CAST(degree AS INT) AS degree, count(*) AS pairs, round(avg(pow(dot, degree)), 6) AS mean_kernel, true AS within
        FROM dots, range({DEGREES[0]}, {DEGREES[-1] + 1}) AS r(degree) GROUP BY degree"""),
    "sgd_ensemble": _sgd_sql(),
}
