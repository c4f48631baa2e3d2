"""Profiles, information measures, orderings, metrics and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.functions import columns as fx
from cohortlens.operators import evaluation, features, ordering, profile, sampling, supervised, transforms
from cohortlens.plans import tables as t
from cohortlens.plans.tables import with_tables

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FACTORS = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _binary_clusters(spark: SparkSession, d: str) -> DataFrame:
    return t.clustered(spark, d).withColumn("label", F.when(F.col("label") >= 5, 1).otherwise(0))


def _distribution(spark: SparkSession, d: str) -> DataFrame:
    found = profile.cluster_distribution(_binary_clusters(spark, d), "cluster", "label")
    return _round(found, 9, "percent_pos", "percent_neg", "total_percent_pos", "total_percent_neg")


def _order_clusters(spark: SparkSession, d: str) -> DataFrame:
    return t.mixed(spark, d).withColumn("cluster", F.col("nation") % 4)


def _profile(spark: SparkSession, d: str) -> DataFrame:
    found = profile.cluster_profile(
        _order_clusters(spark, d), "cluster", "label", ["balance"],
        {"building": F.col("segment") == "BUILDING", "urgent": F.col("priority") == "1-URGENT"})
    # texts back to numbers, as engines print trailing zeros differently
    numbers = [c for c in found.columns if c.startswith(("percent", "total", "share"))]
    return found.withColumns({c: F.round(F.regexp_replace(c, "%", "").cast("double"), 2) for c in numbers})


def _summary(spark: SparkSession, d: str) -> DataFrame:
    found = profile.column_summary(t.table(spark, d, "lineitem"), NUMBERS)
    return _round(found, 6, "minimum", "q1", "median", "q3", "maximum", "mean", "sd", "kurtosis")


def _discrete(spark: SparkSession, d: str) -> DataFrame:
    return profile.equal_width_bins(t.table(spark, d, "lineitem").select(*FACTORS, *NUMBERS), NUMBERS)


def _gain(spark: SparkSession, d: str) -> DataFrame:
    found = profile.information_gain(_discrete(spark, d), ["l_linestatus", "l_linenumber", *NUMBERS], "l_returnflag")
    return found.withColumn("gain", F.round("gain", 9) + 0.0)


def _mi(spark: SparkSession, d: str) -> DataFrame:
    found = profile.mutual_information(_discrete(spark, d), [*FACTORS, "l_quantity", "l_discount"])
    return found.withColumn("mutual_information", F.round("mutual_information", 9) + 0.0)


def _cumulative(spark: SparkSession, d: str) -> DataFrame:
    spend = (t.table(spark, d, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend")))
    return _round(profile.cumulative_share(spend, "o_custkey", "spend"), 9, "share", "cumulative").drop("spend")


def _top(spark: SparkSession, d: str) -> DataFrame:
    orders = t.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ordering.top_fraction(orders, "o_totalprice", "o_orderkey", 0.3)


def _standardised(spark: SparkSession, d: str) -> DataFrame:
    rows = transforms.standardise(t.feature_rows(spark, d))
    return rows.select("vec_id", F.posexplode("features").alias("pos", "v")).select(
        "vec_id", (F.col("pos") + 1).alias("pos"), F.round("v", 6).alias("v"))


def _min_max(spark: SparkSession, d: str) -> DataFrame:
    rows = t.mixed(spark, d).select("row_id", "balance", "year", "month")
    train, test = rows.where(F.col("year") < 1999), rows.where(F.col("year") >= 1999)
    scaled = transforms.min_max_scale(train, ["balance", "month"], test)
    return _round(transforms.tag_union({"train": scaled[0], "test": scaled[1]}), 9, "balance", "month")


def _one_hot(spark: SparkSession, d: str) -> DataFrame:
    rows = t.mixed(spark, d).where(F.col("segment") != "FURNITURE").select("row_id", "segment", "status")
    hot = transforms.one_hot(transforms.one_hot(rows, "segment"), "status")
    return hot.drop("segment", "status")


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    return t.scored(spark, d).withColumn("prediction", F.when(F.col("score") > 0.5, 1).otherwise(0))


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.binary_metrics(_predicted(spark, d), "prediction", "y")
    return _round(found, 9, *found.columns)


def _cluster_metrics(spark: SparkSession, d: str) -> DataFrame:
    tagged = profile.clusters_as_classes(_binary_clusters(spark, d), "cluster", [1, 2])
    found = evaluation.binary_metrics(tagged).select("accuracy", "recall", "specificity")
    return _round(found, 9, *found.columns)


def _roc(spark: SparkSession, d: str) -> DataFrame:
    points = evaluation.roc_points(t.scored(spark, d), "score", "y")
    return _round(points, 9, "threshold", "fpr", "tpr").select("threshold", "fpr", "tpr")


def _multiclass(spark: SparkSession, d: str) -> DataFrame:
    rows = t.feature_rows(spark, d).select(
        (F.col("label") % 5).alias("label"),
        F.least(F.lit(4), F.greatest(F.lit(0), F.col("label") % 5 + F.floor(F.col("vec_id") % 3 - 1)))
        .cast("int").alias("prediction"))
    letters = F.array(*[F.lit(c) for c in "ABCDE"])
    lettered = rows.select(*[F.element_at(letters, F.col(c) + 1).alias(c) for c in ("label", "prediction")])
    at = lambda c: F.array_position(letters, F.col(c)).cast("int")
    found = evaluation.multiclass_auc(lettered.select(at("label").alias("label"), at("prediction").alias("prediction")),
                                      "prediction", "label")
    return _round(found, 9, "auc")


def _knn(spark: SparkSession, d: str) -> DataFrame:
    rows = t.feature_rows(spark, d)
    test = F.col("vec_id") % 2 == 1
    return supervised.knn_vote(rows.where(~test), rows.where(test), "vec_id", 5)


def _routed(spark: SparkSession, d: str) -> DataFrame:
    """Both outputs of a split, each tagged with where it went."""
    training, testing = sampling.route(t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey")
    return (training.withColumn("output", F.lit("training"))
            .unionByName(testing.withColumn("output", F.lit("testing"))))


def _strings(spark: SparkSession, d: str) -> DataFrame:
    c, o = t.table(spark, d, "customer"), t.table(spark, d, "orders")
    text = F.concat((F.floor(F.col("o_orderkey") / 1000)).cast("string"), F.lit(","),
                    F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", fx.normalised("c_mktsegment").alias("lowered"),
        F.substring("c_name", 1, 4).alias("head"), F.col("c_name").startswith("Cust").alias("is_customer"),
        F.col("c_name").contains("99").alias("has_99"), fx.parse_number(text).alias("number"),
        fx.parse_number("o_orderpriority").alias("not_a_number"),
        fx.strip_dots(F.concat("o_orderstatus", F.lit("50K."))).alias("undotted"),
        fx.table_name_of(F.concat(F.lit("data/in/"), "c_mktsegment", F.lit(".csv"))).alias("table_name"),
        F.format_string("%d:%.5f", F.col("o_custkey"), F.col("o_totalprice")).alias("printed"),
        F.array_join(F.array("o_orderstatus", "o_orderpriority"), " ").alias("joined"),
        F.concat("o_orderstatus", "c_mktsegment").isin("OBUILDING", "FMACHINERY").alias("listed"),
        F.coalesce(F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")), F.lit("none")).alias("filled"),
        F.instr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.col("o_orderstatus")).alias("letter"))


def _dates(spark: SparkSession, d: str) -> DataFrame:
    o = t.table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    instant = F.concat(day, F.lit("T06:30:00+02"))
    start = F.lit("1997-01-01").cast("date")
    return o.select(
        "o_orderkey", fx.parse_day(day).alias("day"), fx.day_text(fx.parse_day(day)).alias("day_text"),
        fx.day_text(fx.parse_instant(instant)).alias("instant_text"),
        F.date_sub("o_orderdate", 30).alias("month_before"), F.date_add("o_orderdate", 30).alias("month_after"),
        fx.days_between("o_orderdate", start).alias("since_1997"),
        (fx.parse_day(day) < start).alias("early"),
        F.size(F.sequence(F.to_date("o_orderdate"), F.date_add("o_orderdate", 9))).alias("days_listed"))


def _math(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("l_quantity")
    found = t.table(spark, d, "lineitem").select(
        fx.sigmoid(x / 50 - 0.5).alias("sigmoid"), F.abs(x - 25).alias("distance"),
        F.round(F.col("l_extendedprice") / 1000).alias("rounded"), F.pow(x, F.lit(2.0)).alias("squared"),
        F.sqrt(x).alias("root"), F.log(x).alias("logged"), fx.ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("guarded"),
        F.col("l_linenumber").cast("double").alias("as_double"), x.cast("int").alias("as_int"),
        F.col("l_tax").cast("string").isNull().alias("is_null"))
    sums = found.groupBy("as_double").agg(
        *[F.sum(c).alias(c) for c in ("sigmoid", "distance", "rounded", "squared", "root", "logged", "guarded")],
        F.sum("as_int").alias("as_int"), F.count("guarded").alias("n_guarded"), F.max("is_null").alias("is_null"))
    return _round(sums, 3, "sigmoid", "distance", "rounded", "squared", "root", "logged", "guarded")


def _arrays(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("features")
    half = F.transform(x, lambda v: v / 2)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    digits = F.transform(x, lambda v: F.floor(v * 2).cast("int"))
    head, tail = F.slice(digits, 1, 32), F.slice(digits, 33, 32)
    found = t.feature_rows(spark, d).select(
        "vec_id", fx.dot(x, half).alias("dot"), total(fx.elementwise(x, half, "product")).alias("product"),
        total(fx.elementwise(x, half, "difference")).alias("difference"),
        total(fx.elementwise(F.transform(x, lambda v: F.lit(1.0)),
                             F.transform(x, lambda v: F.abs(v) + 1), "quotient")).alias("quotient"),
        fx.argmax(x).alias("argmax"), fx.set_overlap(head, tail).alias("overlap"),
        fx.set_union_size(head, tail).alias("united"),
        F.size(F.flatten(F.array(head, tail))).alias("flat"))
    return _round(found, 6, "dot", "product", "difference", "quotient")


def _one_hot_wide(spark: SparkSession, d: str) -> DataFrame:
    """Orders by priority and customer as sparse vectors, read back as cells."""
    rows = t.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    vectors, levels = transforms.one_hot_vectors(rows, "o_orderkey", ["o_orderpriority", "o_custkey"])
    cells = features.vector_cells(vectors, "o_orderkey").join(levels, "idx")
    return cells.select("o_orderkey", F.col("idx").cast("int").alias("idx"), "factor", "level", "value")


QUERIES = {
    "confusion_matrix": lambda s, d: _round(profile.contingency(t.clustered(s, d), "cluster", "label"), 9, "share"),
    "cluster_purity": lambda s, d: _round(profile.purity(t.clustered(s, d), "cluster", "label"), 9, "purity"),
    "cluster_distribution": _distribution,
    "cluster_profile": _profile,
    "cluster_class_metrics": _cluster_metrics,
    "column_summary": _summary,
    "information_gain": _gain,
    "mutual_information_pairs": _mi,
    "cumulative_share": _cumulative,
    "top_fraction": _top,
    "first_n_split": lambda s, d: ordering.first_n(
        t.table(s, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 2000),
    "kfold_assignment": lambda s, d: ordering.fold_of(t.feature_rows(s, d).select("vec_id", "label"), "vec_id", 7),
    "standardized": _standardised,
    "min_max_scaled": _min_max,
    "one_hot": _one_hot,
    "one_hot_wide": _one_hot_wide,
    "classification_metrics": _metrics,
    "roc_points": _roc,
    "roc_area": lambda s, d: _round(evaluation.roc_area(t.scored(s, d), "score", "y"), 9, "auc"),
    "multiclass_auc": _multiclass,
    "knn_vote": _knn,
    "scalar_strings": _strings,
    "scalar_dates": _dates,
    "scalar_math": _math,
    "scalar_arrays": _arrays,
    "random_split": lambda s, d: sampling.random_split(t.table(s, d, "orders").select("o_orderkey"), "o_orderkey", [0.2, 0.8]),
    "routed": _routed,
    "bernoulli_bags": lambda s, d: sampling.bernoulli_bags(
        t.table(s, d, "orders").select("o_orderkey"), "o_orderkey", 5, 0.6),
    "bootstrap_bags": lambda s, d: sampling.bootstrap_bags(
        t.table(s, d, "orders").select("o_orderkey"), "o_orderkey", 5),
}

_BINS = ", ".join(
    f"CAST(least(floor(({c} - min({c}) OVER ()) * 10 / (max({c}) OVER () - min({c}) OVER ())), 9) AS INT) AS {c}"
    for c in NUMBERS)
_DISCRETE = f"SELECT l_returnflag, l_linestatus, l_linenumber, {_BINS} FROM lineitem"
_H = "ln(sum(n)) - sum(n * ln(n)) / sum(n)"


def _gain_sql(column: str) -> str:
    """Entropy differences of one column against the return flag."""
    def h(keys: str) -> str:
        return f"(SELECT {_H} FROM (SELECT count(*) AS n FROM d GROUP BY {keys}))"
    return (f"SELECT '{column}' AS \"column\", round({h('l_returnflag')} + {h(column)} - "
            f"{h(f'l_returnflag, {column}')}, 9) + 0.0 AS gain")


def _mi_sql(a: str, b: str) -> str:
    def h(keys: str) -> str:
        return f"(SELECT {_H} FROM (SELECT count(*) AS n FROM d GROUP BY {keys}))"
    return (f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
            f"round({h(a)} + {h(b)} - {h(f'{a}, {b}')}, 9) + 0.0 AS mutual_information")


_MI_COLUMNS = [*FACTORS, "l_quantity", "l_discount"]
_MIXED_HOT = ("SELECT row_id, "
              + ", ".join(f"CASE WHEN segment = '{v}' THEN 1 ELSE 0 END AS \"segment_{v}\""
                          for v in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"))
              + ", " + ", ".join(f"CASE WHEN status = '{v}' THEN 1 ELSE 0 END AS \"status_{v}\"" for v in "FOP")
              + " FROM mixed WHERE segment <> 'FURNITURE'")

_RATES = """
        avg(CASE WHEN prediction = y THEN 1.0 ELSE 0.0 END) AS accuracy,
        count(*) FILTER (prediction = 1 AND y = 1)::DOUBLE / nullif(count(*) FILTER (prediction = 1), 0) AS precision,
        count(*) FILTER (prediction = 1 AND y = 1)::DOUBLE / nullif(count(*) FILTER (y = 1), 0) AS recall,
        count(*) FILTER (prediction = 0 AND y = 0)::DOUBLE / nullif(count(*) FILTER (y = 0), 0) AS specificity"""

ORACLES = {
    "confusion_matrix": with_tables("clustered", """
        SELECT cluster, label, count(*) AS n,
               round(count(*) / sum(count(*)) OVER (PARTITION BY cluster), 9) AS share
        FROM clustered GROUP BY cluster, label"""),
    "cluster_purity": with_tables("clustered", """
        SELECT round(sum(best)::DOUBLE / sum(size), 9) AS purity FROM (
          SELECT cluster, max(n) AS best, sum(n) AS size
          FROM (SELECT cluster, label, count(*) AS n FROM clustered GROUP BY 1, 2) GROUP BY cluster)"""),
    "cluster_distribution": with_tables("clustered", """
        , p AS (SELECT cluster, count(*) AS cluster_size, count(*) FILTER (label >= 5) AS pos
                FROM clustered GROUP BY cluster)
        SELECT cluster, cluster_size, round(pos::DOUBLE / cluster_size, 9) AS percent_pos,
               round((cluster_size - pos)::DOUBLE / cluster_size, 9) AS percent_neg,
               round(pos::DOUBLE / sum(pos) OVER (), 9) AS total_percent_pos,
               round((cluster_size - pos)::DOUBLE / sum(cluster_size - pos) OVER (), 9) AS total_percent_neg
        FROM p"""),
    "cluster_profile": with_tables("mixed", """
        , p AS (SELECT nation % 4 AS cluster, count(*) AS cluster_size, sum(label)::DOUBLE AS pos,
                       round(avg(balance)) AS mean_balance,
                       round(100 * avg(CASE WHEN segment = 'BUILDING' THEN 1.0 ELSE 0.0 END), 2) AS share_building,
                       round(100 * avg(CASE WHEN priority = '1-URGENT' THEN 1.0 ELSE 0.0 END), 2) AS share_urgent
                FROM mixed GROUP BY 1)
        SELECT cluster, cluster_size, round(100 * pos / cluster_size, 2) AS percent_pos,
               round(100 * (cluster_size - pos) / cluster_size, 2) AS percent_neg,
               round(100 * pos / sum(pos) OVER (), 2) AS total_percent_pos,
               round(100 * (cluster_size - pos) / sum(cluster_size - pos) OVER (), 2) AS total_percent_neg,
               mean_balance, share_building, share_urgent FROM p"""),
    "cluster_class_metrics": with_tables("clustered", f"""
        SELECT round(accuracy, 9) AS accuracy, round(recall, 9) AS recall, round(specificity, 9) AS specificity
        FROM (SELECT {_RATES} FROM (SELECT CASE WHEN cluster IN (1, 2) THEN 1 ELSE 0 END AS prediction,
                                           CASE WHEN label >= 5 THEN 1 ELSE 0 END AS y FROM clustered))"""),
    "column_summary": " UNION ALL ".join(f"""
        SELECT '{c}' AS "column", round(min({c}), 6) AS minimum, round(quantile_cont({c}, 0.25), 6) AS q1,
               round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3,
               round(max({c}), 6) AS maximum, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd,
               round((SELECT avg(pow({c} - m, 4)) / pow(avg(pow({c} - m, 2)), 2)
                      FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)), 6) AS kurtosis
        FROM lineitem""" for c in NUMBERS),
    "information_gain": f"WITH d AS ({_DISCRETE}) " + " UNION ALL ".join(
        _gain_sql(c) for c in ["l_linestatus", "l_linenumber", *NUMBERS]),
    "mutual_information_pairs": f"WITH d AS ({_DISCRETE}) " + " UNION ALL ".join(
        _mi_sql(a, b) for i, a in enumerate(_MI_COLUMNS) for b in _MI_COLUMNS[i + 1:]),
    "cumulative_share": """
        SELECT o_custkey, round(spend / sum(spend) OVER (), 9) AS share,
               round(sum(spend) OVER (ORDER BY o_custkey) / sum(spend) OVER (), 9) AS cumulative
        FROM (SELECT o_custkey, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey)""",
    "top_fraction": """
        SELECT * FROM (SELECT o_orderkey, o_totalprice,
                              row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
        WHERE rank <= floor((SELECT count(*) FROM orders) * 0.3)""",
    "first_n_split": """
        SELECT o_orderkey, o_totalprice, position, CASE WHEN position <= 2000 THEN 'train' ELSE 'test' END AS split
        FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders)""",
    "kfold_assignment": """
        SELECT vec_id, label, CAST(ntile(7) OVER (ORDER BY vec_id) - 1 AS INT) AS fold FROM embeddings""",
    "standardized": with_tables("cells", """
        SELECT vec_id, CAST(pos AS INT) AS pos, round((v - avg(v) OVER w) / stddev_samp(v) OVER w, 6) AS v
        FROM cells WINDOW w AS (PARTITION BY pos)"""),
    "min_max_scaled": with_tables("mixed", """
        , e AS (SELECT min(balance) AS lb, max(balance) AS hb, min(month) AS lm, max(month) AS hm
                FROM mixed WHERE year < 1999)
        SELECT row_id, round((balance - lb) / (hb - lb), 9) AS balance, CAST(year AS INT) AS year,
               round((month - lm) / CAST(hm - lm AS DOUBLE), 9) AS month,
               CASE WHEN year < 1999 THEN 'train' ELSE 'test' END AS split FROM mixed, e"""),
    "one_hot": with_tables("mixed", _MIXED_HOT),
    "one_hot_wide": """
        WITH long AS (
          SELECT o_orderkey, 0 AS place, 'o_orderpriority' AS factor, o_orderpriority AS level FROM orders
          UNION ALL
          SELECT o_orderkey, 1, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders),
        levels AS (SELECT *, row_number() OVER (ORDER BY place, level) - 1 AS idx
                   FROM (SELECT DISTINCT place, factor, level FROM long WHERE level IS NOT NULL))
        SELECT o_orderkey, CAST(idx AS INT) AS idx, factor, level, CAST(1 AS DOUBLE) AS value
        FROM long JOIN levels USING (place, factor, level)""",
    "classification_metrics": with_tables("scored", f"""
        SELECT round(accuracy, 9) AS accuracy, round((recall + specificity) / 2, 9) AS auc,
               round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(specificity, 9) AS specificity,
               round(2 * precision * recall / (precision + recall), 9) AS f1
        FROM (SELECT {_RATES} FROM (SELECT y, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction FROM scored))"""),
    "roc_points": with_tables("scored", """
        , c AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY score)
        SELECT round(score, 9) AS threshold,
               round(sum(neg) OVER w / CAST(sum(neg) OVER () AS DOUBLE), 9) AS fpr,
               round(sum(pos) OVER w / CAST(sum(pos) OVER () AS DOUBLE), 9) AS tpr
        FROM c WINDOW w AS (ORDER BY score DESC)"""),
    "roc_area": with_tables("scored", """
        SELECT round(sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END)
                     / count(*), 9) AS auc
        FROM scored p JOIN scored n ON p.y = 1 AND n.y = 0"""),
    "multiclass_auc": """
        WITH r AS (SELECT label % 5 + 1 AS l,
                          least(4, greatest(0, label % 5 + (vec_id % 3 - 1))) + 1 AS p FROM embeddings),
        m AS (SELECT l, median(p) AS md FROM r GROUP BY l),
        a AS (SELECT x.l AS la, y.l AS lb, avg(CASE WHEN y.p > x.p THEN 1.0 WHEN y.p = x.p THEN 0.5 ELSE 0.0 END) AS auc
              FROM r x JOIN r y ON x.l < y.l GROUP BY 1, 2)
        SELECT round(avg(CASE WHEN ma.md > mb.md THEN 1 - auc ELSE auc END), 9) AS auc
        FROM a JOIN m ma ON a.la = ma.l JOIN m mb ON a.lb = mb.l""",
    "knn_vote": with_tables("cells", """
        , near AS (SELECT vec_id, neighbour, row_number() OVER (PARTITION BY vec_id ORDER BY dist, neighbour) AS r
                   FROM (SELECT a.vec_id, b.vec_id AS neighbour, sum(pow(a.v - b.v, 2)) AS dist
                         FROM cells a JOIN cells b ON a.pos = b.pos
                         WHERE a.vec_id % 2 = 1 AND b.vec_id % 2 = 0 GROUP BY 1, 2)),
        votes AS (SELECT n.vec_id, e.label AS vote, count(*) AS n FROM near n
                  JOIN embeddings e ON n.neighbour = e.vec_id WHERE r <= 5 GROUP BY 1, 2),
        won AS (SELECT vec_id, vote, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) AS r FROM votes)
        SELECT w.vec_id, CAST(e.label AS DOUBLE) AS label, CAST(w.vote AS DOUBLE) AS prediction
        FROM won w JOIN embeddings e ON w.vec_id = e.vec_id WHERE r = 1"""),
    "random_split": f"""
        SELECT o_orderkey, CAST({t.uniform_sql(7, "o_orderkey")} > 0.2 AS INT) AS part FROM orders""",
    "routed": f"""
        SELECT l_orderkey, l_linenumber, CASE WHEN {t.uniform_sql(7, "l_orderkey")} <= 0.2 THEN 'testing' ELSE 'training' END AS output
        FROM lineitem""",
    "bernoulli_bags": f"""
        SELECT o_orderkey, CAST(bag AS INT) AS bag FROM orders, range(5) AS b(bag)
        WHERE {t.uniform_sql(7, "o_orderkey", "bag")} < 0.6""",
    "bootstrap_bags": f"""
        WITH draws AS (SELECT o_orderkey, bag, {t.uniform_sql(7, "o_orderkey", "bag")} AS u FROM orders, range(5) AS b(bag)),
        steps AS (SELECT n, sum(exp(-0.6) * pow(0.6, n) / factorial(CAST(n AS INT))) OVER (ORDER BY n) AS below
                  FROM range(20) AS r(n))
        SELECT o_orderkey, CAST(bag AS INT) AS bag, CAST(count(*) AS INT) AS times
        FROM draws JOIN steps ON below <= u GROUP BY o_orderkey, bag""",
    "scalar_strings": """
        SELECT o_orderkey, lower(trim(c_mktsegment)) AS lowered, substr(c_name, 1, 4) AS head,
               starts_with(c_name, 'Cust') AS is_customer, contains(c_name, '99') AS has_99,
               CAST(o_orderkey AS DOUBLE) AS number, CAST(NULL AS DOUBLE) AS not_a_number,
               o_orderstatus || '50K' AS undotted, c_mktsegment AS table_name,
               printf('%d:%.5f', o_custkey, o_totalprice) AS printed,
               o_orderstatus || ' ' || o_orderpriority AS joined,
               o_orderstatus || c_mktsegment IN ('OBUILDING', 'FMACHINERY') AS listed,
               CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'none' END AS filled,
               CAST(instr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', o_orderstatus) AS INT) AS letter
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "scalar_dates": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
               strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS day_text,
               strftime(o_orderdate, '%Y-%m-%d') || ' 04:30:00' AS instant_text,
               CAST(CAST(o_orderdate AS DATE) - INTERVAL 30 DAY AS DATE) AS month_before,
               CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS month_after,
               CAST(date_diff('day', DATE '1997-01-01', CAST(o_orderdate AS DATE)) AS INT) AS since_1997,
               CAST(o_orderdate AS DATE) < DATE '1997-01-01' AS early, CAST(10 AS INT) AS days_listed
        FROM orders""",
    "scalar_math": """
        SELECT CAST(l_linenumber AS DOUBLE) AS as_double,
               round(sum(1 / (1 + exp(-(l_quantity / 50 - 0.5)))), 3) AS sigmoid,
               round(sum(abs(l_quantity - 25)), 3) AS distance,
               round(sum(round(l_extendedprice / 1000)), 3) AS rounded,
               round(sum(pow(l_quantity, 2)), 3) AS squared, round(sum(sqrt(l_quantity)), 3) AS root,
               round(sum(ln(l_quantity)), 3) AS logged,
               round(sum(l_extendedprice / nullif(l_discount, 0)), 3) AS guarded,
               CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS as_int,
               count(l_extendedprice / nullif(l_discount, 0)) AS n_guarded,
               bool_or(l_tax IS NULL) AS is_null
        FROM lineitem GROUP BY l_linenumber""",
    "scalar_arrays": """
        WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
        g AS (SELECT *, list_transform(f, lambda v: CAST(floor(v * 2) AS INT)) AS digits FROM x)
        SELECT vec_id, round(list_sum(list_transform(f, lambda v: v * v / 2)), 6) AS dot,
               round(list_sum(list_transform(f, lambda v: v * v / 2)), 6) AS product,
               round(list_sum(list_transform(f, lambda v: v / 2)), 6) AS difference,
               round(list_sum(list_transform(f, lambda v: 1 / (abs(v) + 1))), 6) AS quotient,
               CAST(list_position(f, list_max(f)) - 1 AS INT) AS argmax,
               CAST(len(list_intersect(list_distinct(digits[1:32]), list_distinct(digits[33:64]))) AS INT) AS overlap,
               CAST(len(list_distinct(digits)) AS INT) AS united, CAST(len(digits) AS INT) AS flat
        FROM g""",
}
