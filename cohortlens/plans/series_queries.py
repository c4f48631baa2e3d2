"""Price-series signals, trades and ledgers over the derived prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators import timeseries as ts
from cohortlens.plans import tables as t, workloads
from cohortlens.plans.tables import MARKET, with_tables
from cohortlens.sources.prices import price_panel

SPANS = (30, 50, 200)
START = 100_000.0


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _signals(spark: SparkSession, d: str) -> DataFrame:
    score = ts.backward_change("price", 10, ts.by_symbol())
    return t.prices(spark, d).select("symbol", "trade_date", ts.action(score).alias("action"))


def _orders(spark: SparkSession, d: str) -> DataFrame:
    thinned = ts.thin_signals(_signals(spark, d))
    return ts.order_list(thinned, t.prices(spark, d)).withColumn("shares", F.col("shares").cast("long"))


def _account_orders(spark: SparkSession, d: str) -> DataFrame:
    return _orders(spark, d).withColumn("account", F.col("symbol"))


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return price_panel(t.prices(spark, d), ["N1", "N2", "N3"], MARKET, "1995-06-01", "1997-12-31")


def _range(spark: SparkSession, d: str) -> DataFrame:
    ends = t.prices(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b"))
    return ends.select("symbol", ts.calendar_range(F.col("a"), F.col("b")).alias("day"))


def _emas(spark: SparkSession, d: str) -> DataFrame:
    return _round(ts.ema(t.prices(spark, d), SPANS), 6, *[f"ema_{s}" for s in SPANS]).drop("price")


def _ema_ratio(spark: SparkSession, d: str) -> DataFrame:
    found = ts.ema(t.prices(spark, d), SPANS)
    return _round(found.select("symbol", "trade_date", *[
        F.try_divide("price", f"ema_{s}").alias(f"ratio_{s}") for s in SPANS]), 6, *[f"ratio_{s}" for s in SPANS])


def _strategy(spark: SparkSession, d: str) -> DataFrame:
    """The ten-day change as signal, every order booked, beside buy-and-hold."""
    change = lambda prices: prices.select("symbol", "trade_date", ts.backward_change("price", 10, ts.by_symbol()).alias("score"))
    found = workloads.trading_strategy(t.prices(spark, d), change, START, None)
    return _round(found, 9, "strategy", "benchmark").select("symbol", "trade_date", "strategy", "benchmark")


def _market_rsi(spark: SparkSession, d: str) -> DataFrame:
    return _round(workloads.price_features(t.prices(spark, d), MARKET).select("symbol", "trade_date", "rsi"), 6, "rsi")


QUERIES = {
    "strategy_curves": _strategy,
    "market_rsi_feature": _market_rsi,
    "price_panel": _panel,
    "calendar_days": _range,
    "roc_10_day": lambda s, d: _round(t.prices(s, d).select(
        "symbol", "trade_date", ts.backward_change("price", 10, ts.by_symbol()).alias("roc")), 9, "roc"),
    "forward_return": lambda s, d: _round(t.prices(s, d).select(
        "symbol", "trade_date", ts.forward_return("price", 10, ts.by_symbol()).alias("ten_days_out")),
        9, "ten_days_out"),
    "ema_30": _emas,
    "price_ema_ratio": _ema_ratio,
    "rsi_14": lambda s, d: _round(ts.rsi(t.prices(s, d)), 6, "rsi").drop("price"),
    "thinned_signals": lambda s, d: ts.thin_signals(_signals(s, d)),
    "order_shares": lambda s, d: ts.order_shares(ts.thin_signals(_signals(s, d))),
    "order_list": _orders,
    "ledger": lambda s, d: _round(ts.ledger(_account_orders(s, d), t.prices(s, d), START), 3,
                                  "cash", "equity"),
    "ledger_leverage_cap": lambda s, d: _round(ts.capped_ledger(
        _account_orders(s, d), t.prices(s, d), START), 3, "cash", "equity"),
    "buy_hold": lambda s, d: _round(ts.buy_and_hold(t.prices(s, d)), 5, "buy_hold_value").drop("price"),
    "rebased": lambda s, d: _round(ts.rebase(ts.buy_and_hold(t.prices(s, d)), "buy_hold_value", "rebased"),
                                   9, "rebased").select("symbol", "trade_date", "rebased"),
}


def _ema_sql(select: str) -> str:
    """Weighted sums over each row's whole history, weights (1 - alpha)^age."""
    parts = ", ".join(f"""
          CASE WHEN a.ix >= {s} - 2 THEN sum(b.price * pow(1 - 2.0 / {s + 1}, a.ix - b.ix))
               / sum(pow(1 - 2.0 / {s + 1}, a.ix - b.ix)) END AS e{s}""" for s in SPANS)
    return with_tables("numbered", f"""
        SELECT symbol, trade_date, {select} FROM (
          SELECT a.symbol, a.trade_date, a.price, {parts}
          FROM numbered a JOIN numbered b ON a.symbol = b.symbol AND b.ix <= a.ix
          GROUP BY a.symbol, a.trade_date, a.price, a.ix)""")


_DAYS = """
        , span AS (SELECT symbol, min(trade_date) AS first_day, max(trade_date) AS last_day
                   FROM order_list GROUP BY symbol)"""

_BOOKED = _DAYS + """
        , net AS (SELECT symbol, trade_date, sum(CASE side WHEN 'BUY' THEN shares WHEN 'SELL' THEN -shares
                                                 ELSE 0 END) AS s FROM order_list GROUP BY 1, 2),
        days AS (SELECT p.symbol, p.trade_date, p.price, coalesce(n.s, 0) AS s
                 FROM prices p JOIN span USING (symbol) LEFT JOIN net n USING (symbol, trade_date)
                 WHERE p.trade_date BETWEEN first_day AND last_day),
        run AS (SELECT *, 100000 - sum(s * price) OVER w AS cash, price * sum(s) OVER w AS equity
                FROM days WINDOW w AS (PARTITION BY symbol ORDER BY trade_date))"""

_RSI = """
        SELECT symbol, trade_date, round(CASE WHEN ix < 14 THEN NULL WHEN loss = 0 THEN 100
                                              ELSE 100 - 100 / (1 + gain / loss) END, 6) AS rsi
        FROM (SELECT symbol, trade_date, ix,
                     sum(greatest(coalesce(move, 0), 0)) OVER w AS gain,
                     sum(greatest(coalesce(-move, 0), 0)) OVER w AS loss
              FROM (SELECT *, price - lag(price) OVER (PARTITION BY symbol ORDER BY ix) AS move FROM numbered)
              WINDOW w AS (PARTITION BY symbol ORDER BY ix ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))"""

ORACLES = {
    "strategy_curves": with_tables("order_list numbered prices", _BOOKED + """
        , hold AS (SELECT symbol, trade_date, price * 500 + (100000 - 500 * first(price) OVER (PARTITION BY symbol ORDER BY ix)) AS held
                   FROM numbered)
        SELECT symbol, trade_date, round(round(cash + equity, 4) / first(round(cash + equity, 4)) OVER w, 9) AS strategy,
               round(held / first(held) OVER w, 9) AS benchmark
        FROM hold JOIN run USING (symbol, trade_date) WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)"""),
    "price_panel": with_tables("prices", """
        SELECT trade_date, s.symbol, p.price
        FROM (SELECT trade_date FROM prices WHERE symbol = 'ALL'
              AND trade_date BETWEEN DATE '1995-06-01' AND DATE '1997-12-31') m
        CROSS JOIN (VALUES ('ALL'), ('N1'), ('N2'), ('N3')) s(symbol)
        LEFT JOIN prices p USING (symbol, trade_date)"""),
    "calendar_days": with_tables("prices", """
        SELECT symbol, CAST(unnest(generate_series(min(trade_date), max(trade_date), INTERVAL 1 DAY)) AS DATE) AS day
        FROM prices GROUP BY symbol"""),
    "roc_10_day": with_tables("numbered", """
        SELECT symbol, trade_date,
               round(price / lag(price, 10) OVER (PARTITION BY symbol ORDER BY ix) - 1, 9) AS roc
        FROM numbered"""),
    "forward_return": with_tables("numbered", """
        SELECT symbol, trade_date,
               round(1 - price / lead(price, 10) OVER (PARTITION BY symbol ORDER BY ix), 9) AS ten_days_out
        FROM numbered"""),
    "ema_30": _ema_sql(", ".join(f"round(e{s}, 6) AS ema_{s}" for s in SPANS)),
    "price_ema_ratio": _ema_sql(", ".join(f"round(price / e{s}, 6) AS ratio_{s}" for s in SPANS)),
    "rsi_14": with_tables("numbered", _RSI),
    "market_rsi_feature": with_tables("numbered", f"""
        SELECT n.symbol, n.trade_date, m.rsi FROM numbered n
        LEFT JOIN ({_RSI}) m ON m.symbol = '{MARKET}' AND m.trade_date = n.trade_date"""),
    "thinned_signals": with_tables("thinned", "SELECT symbol, trade_date, action FROM thinned"),
    "order_shares": with_tables("moves", """
        SELECT symbol, trade_date, action, CAST(held AS INT) AS held, CAST(change AS INT) AS change,
               CAST(abs(change) AS INT) AS shares FROM moves"""),
    "order_list": with_tables("order_list", """
        SELECT symbol, trade_date, side, CAST(shares AS BIGINT) AS shares, CAST(seq AS INT) AS seq
        FROM order_list"""),
    "ledger": with_tables("order_list prices", _BOOKED + """
        SELECT symbol AS account, trade_date, round(cash, 3) AS cash, round(equity, 3) AS equity,
               round(cash + equity, 4) AS total_value FROM run"""),
    "ledger_leverage_cap": with_tables("order_list prices", _DAYS + """
        , rows_of AS (SELECT p.symbol, p.trade_date, coalesce(o.seq, 0) AS seq, p.price,
                             CASE o.side WHEN 'BUY' THEN o.shares WHEN 'SELL' THEN -o.shares ELSE 0 END AS s,
                             row_number() OVER (PARTITION BY p.symbol ORDER BY p.trade_date, coalesce(o.seq, 0)) AS n
                      FROM prices p JOIN span USING (symbol) LEFT JOIN order_list o USING (symbol, trade_date)
                      WHERE p.trade_date BETWEEN first_day AND last_day),
        fold AS (
          SELECT symbol, CAST(0 AS BIGINT) AS n, CAST(100000 AS DOUBLE) AS cash, CAST(0 AS DOUBLE) AS position,
                 TRUE AS accepted FROM span
          UNION ALL
          SELECT r.symbol, r.n, CASE WHEN t.ok THEN f.cash - r.price * r.s ELSE f.cash END,
                 CASE WHEN t.ok THEN f.position + r.s ELSE f.position END, t.ok
          FROM fold f JOIN rows_of r ON r.symbol = f.symbol AND r.n = f.n + 1,
               LATERAL (SELECT coalesce(abs((f.position + r.s) * r.price)
                 / nullif(abs((f.position + r.s) * r.price) + f.cash - r.price * r.s, 0), 0) < 3 AS ok) t)
        SELECT r.symbol AS account, r.trade_date, CAST(r.seq AS INT) AS seq, round(f.cash, 3) AS cash,
               round(f.position * r.price, 3) AS equity,
               round(f.cash + f.position * r.price, 4) AS total_value, f.accepted
        FROM fold f JOIN rows_of r ON r.symbol = f.symbol AND r.n = f.n"""),
    "buy_hold": with_tables("numbered", """
        SELECT symbol, trade_date, round(price * 500 + (100000 - 500 * first(price) OVER (
                 PARTITION BY symbol ORDER BY ix)), 5) AS buy_hold_value FROM numbered"""),
    "rebased": with_tables("numbered", """
        SELECT symbol, trade_date, round((price * 500 + (100000 - 500 * first(price) OVER w)) / 100000, 9) AS rebased
        FROM numbered WINDOW w AS (PARTITION BY symbol ORDER BY ix)"""),
}
