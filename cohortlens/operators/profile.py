"""Contingency, purity, cluster reports, column summaries, information measures."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.functions.columns import percent_text
from cohortlens.operators.ordering import with_running_sums

#: Bins of one histogram of an open interval.
BINS = 1024


# --- clusters against classes ---------------------------------------------

def contingency(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Counts per (cluster, label) and the label's share of its cluster."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(cluster))
    return counts.withColumn("share", F.col("n") / whole)


def purity(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Sum over clusters of the largest class count, over all rows."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(cluster).agg(F.max("n").alias("best"), F.sum("n").alias("size"))
    return best.agg((F.sum("best") / F.sum("size")).alias("purity"))


def cluster_distribution(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Size and positive share of each cluster, and its share of each class."""
    per = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"),
                                  F.sum(F.col(label).cast("long")).alias("positives"))
    everything = Window.partitionBy(F.lit(1))  # one row per cluster by now
    negatives = F.col("cluster_size") - F.col("positives")
    return per.select(
        cluster, "cluster_size",
        (F.col("positives") / F.col("cluster_size")).alias("percent_pos"),
        (negatives / F.col("cluster_size")).alias("percent_neg"),
        F.try_divide(F.col("positives"), F.sum("positives").over(everything)).alias("total_percent_pos"),
        F.try_divide(negatives, F.sum(negatives).over(everything)).alias("total_percent_neg"))


def cluster_profile(df: DataFrame, cluster: str, label: str, means: Sequence[str],
                    shares: Mapping[str, Column]) -> DataFrame:
    """The distribution as text with mean columns and shares of indicator columns."""
    extra = df.groupBy(cluster).agg(
        *[F.round(F.avg(c)).alias(f"mean_{c}") for c in means],
        *[percent_text(F.avg(F.when(e, 1.0).otherwise(0.0))).alias(f"share_{n}")
          for n, e in shares.items()])
    spread = cluster_distribution(df, cluster, label)
    texts = ["percent_pos", "percent_neg", "total_percent_pos", "total_percent_neg"]
    return (spread.select(cluster, "cluster_size", *[percent_text(c).alias(c) for c in texts])
            .join(extra, cluster))


def clusters_as_classes(df: DataFrame, cluster: str, positive: Sequence[int]) -> DataFrame:
    """Call the listed clusters class 1, the others class 0."""
    return df.withColumn("prediction", F.when(F.col(cluster).isin(list(positive)), 1).otherwise(0))


# --- column summaries -----------------------------------------------------

def stack(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
          kind: str = "double") -> DataFrame:
    """Long form (keep..., column, value), nulls left out."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value"))
                                for c in columns])).alias("cell")
    return (df.select(*keep, cells).select(*keep, "cell.column", "cell.value")
            .where(F.col("value").isNotNull()))


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float],
              bins: int = BINS) -> DataFrame:
    """Exact interpolated (type 7) quantiles per column, as (column, name, value).

    The order statistics behind a quantile are closed in on by histograms: a
    pass counts the values of every open interval in ``bins`` bins of equal
    width, the bin that holds the wanted place becomes the next interval, from
    its least to its greatest value, until both are the same. The ends of an
    interval fall into different bins, so each pass narrows it. Only bins are
    shuffled and reach the driver, at most columns x statistics x ``bins`` rows,
    never the values.
    A column without values has no row. NaN is above every number, as in Spark's
    order; an infinity beside numbers is set apart by its own bin.
    """
    cells = stack(df, columns)
    ends = cells.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    places = {r["column"]: {name: float(p) * (r["n"] - 1) for name, p in probabilities.items()} for r in ends}
    # (column, place) -> (lowest, highest, rows of the column below the interval)
    open_ = {(r["column"], at): (r["lo"], r["hi"], 0) for r in ends
             for h in places[r["column"]].values() for at in (math.floor(h), math.ceil(h))}
    found: dict[tuple[str, int], float] = {}
    while True:
        for key, (lo, hi, _) in list(open_.items()):
            if lo == hi or (lo != lo and hi != hi):
                found[key] = lo
                del open_[key]
        if not open_:
            break
        # statistics that share an interval share its histogram
        asked = sorted({(column, lo, hi) for (column, _), (lo, hi, _) in open_.items()}, key=str)
        intervals = df.sparkSession.createDataFrame(asked, "column string, lo double, hi double")
        lo, hi, v = F.col("lo"), F.col("hi"), F.col("value")
        share = F.try_divide(v / bins - lo / bins, hi / bins - lo / bins)
        # the ends have bins of their own, so an infinite or NaN end leaves the others in the middle
        place = F.when(v == lo, -1).when(v == hi, bins).otherwise(
            F.when(share.isNull() | F.isnan(share), bins // 2).otherwise(F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(share * bins)))))
        # one row per column and open statistic, so the broadcast is bounded by the request
        counted = (cells.join(F.broadcast(intervals), "column").where(v.between(lo, hi))
                   .groupBy("column", "lo", "hi", place.cast("int").alias("bin"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("least"), F.max(v).alias("greatest")))
        histograms: dict[tuple, list] = {}
        for r in sorted(counted.collect(), key=lambda r: r["bin"]):
            histograms.setdefault((r["column"], str(r["lo"]), str(r["hi"])), []).append(r)
        for (column, at), (low, high, below) in list(open_.items()):
            for r in histograms[(column, str(low), str(high))]:
                if at < below + r["n"]:
                    open_[(column, at)] = (r["least"], r["greatest"], below)
                    break
                below += r["n"]
    rows = []
    for column, names in places.items():
        for name, h in names.items():
            low, high = found[(column, math.floor(h))], found[(column, math.ceil(h))]
            rows.append((column, name, low if low == high else low + (h - math.floor(h)) * (high - low)))
    return df.sparkSession.createDataFrame(rows, "column string, name string, value double")


def column_summary(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Quartiles, mean, sample deviation and Pearson kurtosis per column."""
    names = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    points = (quantiles(df, columns, names, bins)
              .groupBy("column").pivot("name", list(names)).agg(F.first("value")))
    moments = stack(df, columns).groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"),
        (F.kurtosis("value") + 3).alias("kurtosis"))
    return points.join(moments, "column")


def cumulative_share(df: DataFrame, order: str, value: str) -> DataFrame:
    """Each row's share of the total and the running share in ``order``."""
    total = df.agg(F.sum(value)).first()[0]
    share = F.col(value) / F.lit(total)
    return with_running_sums(df.withColumn("share", share), [order], {"cumulative": F.col("share")})


# --- information ----------------------------------------------------------

def equal_width_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Numeric columns to bin numbers 0..bins-1 between their minimum and maximum."""
    ends = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns],
                  *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    out = {}
    for c in columns:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        scaled = F.try_divide((F.col(c) - F.lit(lo)) * bins, F.lit(hi) - F.lit(lo))
        out[c] = F.least(F.coalesce(F.floor(scaled), F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.withColumns(out)


def _entropy(counts: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Natural-log entropy of count column ``n`` within each key."""
    return (counts.groupBy(*keys)
            .agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log("n")).alias("s"))
            .select(*keys, (F.log("t") - F.col("s") / F.col("t")).alias(out)))


def information_gain(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """H(class) + H(attribute) - H(class, attribute) of discrete columns, best first."""
    long = stack(df, columns, keep=[label], kind="string")
    joint = long.groupBy("column", "value", label).agg(F.count(F.lit(1)).alias("n"))
    values = joint.groupBy("column", "value").agg(F.sum("n").alias("n"))
    classes = joint.groupBy("column", label).agg(F.sum("n").alias("n"))
    gain = (_entropy(joint, ["column"], "hj").join(_entropy(values, ["column"], "hv"), "column")
            .join(_entropy(classes, ["column"], "hc"), "column"))
    return gain.select("column", (F.col("hc") + F.col("hv") - F.col("hj")).alias("gain")).orderBy(
        F.desc("gain"), "column")


def positive_gain(gains: DataFrame, top: int | None = None) -> DataFrame:
    """Attributes that carry information, or the best ``top`` of them."""
    useful = gains.where(F.col("gain") > 0)
    return useful.orderBy(F.desc("gain"), "column").limit(top) if top else useful


def mutual_information(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Natural-log mutual information of every pair of discrete columns."""
    cell = lambda a, b: F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                                 F.col(a).cast("string").alias("va"), F.col(b).cast("string").alias("vb"))
    # the combinations of the columns of one row, not of rows
    long = df.select(F.explode(F.array(*[cell(a, b) for a, b in combinations(columns, 2)])).alias("c"))
    joint = long.select("c.*").groupBy("column_a", "column_b", "va", "vb").agg(
        F.count(F.lit(1)).alias("n"))
    pair = ["column_a", "column_b"]
    one = joint.groupBy(*pair, "va").agg(F.sum("n").alias("n"))
    two = joint.groupBy(*pair, "vb").agg(F.sum("n").alias("n"))
    info = (_entropy(joint, pair, "hj").join(_entropy(one, pair, "ha"), pair)
            .join(_entropy(two, pair, "hb"), pair))
    return info.select(*pair, (F.col("ha") + F.col("hb") - F.col("hj")).alias("mutual_information"))
