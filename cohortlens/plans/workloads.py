"""Whole jobs: the chains of operators a user runs end to end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortlens.operators import (
    clustering, cohort, features, graph, phenotype, profile, supervised, timeseries as ts, transforms)
from cohortlens.session import checkpointed
from cohortlens.sources import svmlight


def mortality_svmlight(events: DataFrame, mortality: DataFrame, how: str = "count",
                       with_id: bool = False) -> DataFrame:
    """Events and deaths to labelled SVMLight lines.

    The aggregated features are the one stored stage; ids, maxima, lines and
    labels are derived from it.
    """
    index = cohort.index_dates(events, mortality)
    counted = checkpointed(features.window_features(events, index, how))
    scaled, _ = features.indexed_and_scaled(counted)
    return svmlight.labelled_lines(svmlight.sparse_text(scaled), features.labels(counted, index),
                                   with_id=with_id)


def phenotype_purity(diagnostics: DataFrame, medications: DataFrame, labs: DataFrame,
                     rules: phenotype.PhenotypeRules, components: int = 10, k: int = 3,
                     nmf_rounds: int = 100, candidates: Sequence[str] | None = None) -> DataFrame:
    """Purity of k-means, mixture and NMF clusters against phenotype labels.

    Features are standardised and reduced for the first two; NMF takes the raw
    non-negative features. ``candidates`` keeps only those features.
    """
    labels = phenotype.phenotype_labels(diagnostics, medications, labs, rules)
    tuples = features.feature_tuples(diagnostics, medications, labs).dropna()
    if candidates is not None:
        tuples = features.keep_candidates(tuples, "feature", candidates)
    tuples = checkpointed(tuples)
    dictionary = features.feature_dictionary(tuples, "feature")
    width = dictionary.count()
    rows = features.dense_rows(features.map_to_ids(tuples, dictionary, "feature"), width)
    rows = checkpointed(rows.join(labels, "patient_id"))
    scaled = transforms.standardise(rows)
    reduced = checkpointed(transforms.pca(scaled, min(components, width)).transform(scaled, ["patient_id", "label"]))
    found = {
        "kmeans": clustering.kmeans(reduced, k),
        "mixture": clustering.gaussian_mixture(reduced, k),
        # the stored rows hold the labels, which are not worked out again
        "nmf": clustering.nmf_clusters(rows, "patient_id", k, nmf_rounds).join(rows.select("patient_id", "label"), "patient_id"),
    }
    out = None
    for name, df in found.items():
        one = profile.purity(df, "cluster", "label").select(F.lit(name).alias("method"), "purity")
        out = one if out is None else out.unionByName(one)
    return out


def patient_similarity(records: DataFrame, patients: DataFrame, patient_id: int, min_similarity: float,
                       steps: int = 100, k: int = 3) -> dict[str, DataFrame]:
    """Jaccard ranking, similar pairs, walk ranking and graph clusters."""
    pairs = checkpointed(records.select("patient_id", F.concat_ws(":", "kind", "code").alias("code")).distinct())
    edges = graph.graph_edges(records, patients)
    similar = checkpointed(graph.jaccard_pairs(pairs, min_similarity))
    return {
        "jaccard": graph.jaccard_one_vs_all(pairs, patient_id, patients),
        "pairs": similar,
        "walk": graph.ranked_patients(graph.push_walk(edges, patient_id, steps), patients, patient_id),
        "clusters": clustering.power_iteration(similar, k),
    }


def trading_strategy(prices: DataFrame, signal: Callable[[DataFrame], DataFrame] | None = None,
                     start_value: float = 100_000.0, max_leverage: float | None = 3.0) -> DataFrame:
    """Signals to trades to an equity curve beside buy-and-hold, both rebased.

    ``signal`` maps prices to (symbol, trade_date, score); the default is the
    prediction of bagged trees on price/EMA ratios and RSI. Without a
    ``max_leverage`` every order is booked, by the plain ledger. Both curves
    start at 1 on the symbol's first order.
    """
    scores = (signal or predicted_returns)(prices)
    actions = checkpointed(scores.select("symbol", "trade_date", ts.action(F.col("score")).alias("action")))
    calendar = prices.join(actions.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_semi")
    orders = ts.order_list(ts.thin_signals(actions), calendar).withColumn("account", F.col("symbol"))
    if max_leverage is None:
        curve = ts.ledger(orders, calendar, start_value).select(
            F.col("account").alias("symbol"), "trade_date", F.col("total_value").alias("strategy_value"))
    else:
        curve = (ts.capped_ledger(orders, calendar, start_value, max_leverage)
                 # the day's last order closes the day
                 .groupBy("account", "trade_date").agg(F.max_by("total_value", "seq").alias("strategy_value"))
                 .withColumnRenamed("account", "symbol"))
    both = ts.buy_and_hold(calendar, start_value=start_value).join(curve, ["symbol", "trade_date"])
    return ts.rebase(ts.rebase(both, "strategy_value", "strategy"), "buy_hold_value", "benchmark")


def price_features(prices: DataFrame, market: str | None = None) -> DataFrame:
    """(symbol, trade_date, r30, r200, rsi, target): price over its averages, RSI, and the ten-day return ahead.

    With ``market``, the RSI of that symbol on the same day stands for every
    symbol; days on which it has none give null.
    """
    found = ts.ema(prices, [30, 200]).select(
        "symbol", "trade_date", "price", F.try_divide("price", "ema_30").alias("r30"),
        F.try_divide("price", "ema_200").alias("r200"), ts.forward_return("price", 10, ts.by_symbol()).alias("target"))
    if market is None:
        return ts.rsi(found).select("symbol", "trade_date", "r30", "r200", "rsi", "target")
    index = ts.rsi(prices.where(F.col("symbol") == market)).select("trade_date", "rsi")
    return found.join(index, "trade_date", "left").select("symbol", "trade_date", "r30", "r200", "rsi", "target")


def predicted_returns(prices: DataFrame, trees: int = 15, market: str | None = None) -> DataFrame:
    """(symbol, trade_date, score): ten-day returns predicted by bagged trees on ``price_features``."""
    rows = checkpointed(price_features(prices, market))
    usable = supervised.with_vector(rows.dropna(subset=["r30", "r200", "rsi"]).withColumn(
        "features", F.array("r30", "r200", "rsi"))).withColumn("day_key", F.struct("symbol", "trade_date"))
    scored = supervised.bagged_trees(usable.where(F.col("target").isNotNull()), usable, "day_key", trees)
    return scored.select("day_key.symbol", "day_key.trade_date", F.col("prediction").alias("score"))
