"""Daily price signals, thinned trades and portfolio ledgers.

Frames hold one row per (symbol, day), so the calendar bounds the rows of every
symbol; windows and folds run per symbol or account.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from cohortlens.operators.thinning import BUY, FLIPS, HOLD, SELL, thin_signals
from cohortlens.session import checkpointed


def by_symbol(key: str = "symbol", date: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(date)


def backward_change(price: str, n: int, w: WindowSpec) -> Column:
    return F.try_divide(F.col(price), F.lag(price, n).over(w)) - 1


def forward_return(price: str, n: int, w: WindowSpec) -> Column:
    """1 - x[t] / x[t+n]: the future price is the divisor."""
    return 1 - F.try_divide(F.col(price), F.lead(price, n).over(w))


def rsi(prices: DataFrame, n: int = 14, out: str = "rsi") -> DataFrame:
    """Simple-average relative strength, over the ``n`` changes ending the day before.

    Null for the first ``n`` days; 100 when there was no losing day.
    """
    w = by_symbol()
    lagged = w.rowsBetween(-n, -1)
    moved = prices.withColumn("__move", F.col("price") - F.lag("price").over(w))
    gain = F.sum(F.greatest(F.col("__move"), F.lit(0.0))).over(lagged) / n
    loss = F.sum(F.greatest(-F.col("__move"), F.lit(0.0))).over(lagged) / n
    strength = F.try_divide(gain, loss)
    value = F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + strength))
    return (moved.withColumn(out, F.when(F.row_number().over(w) > n, value)).drop("__move"))


def _folded(values: Column, fade: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a * fade + v)


def ema(prices: DataFrame, spans: Sequence[int], block: int = 64) -> DataFrame:
    """Adjusted exponential moving averages ``ema_<span>``, null for span-2 rows; span 1 is the price.

    A symbol's rows are cut into blocks. The decayed sum at a row is that of its
    block so far plus what the blocks before it carry on; carries fade below
    1e-20 after a number of blocks that the span fixes. Blocks stay so short
    that no inverse power leaves the range of a double.
    """
    w = by_symbol()
    keep = {s: 1 - 2 / (s + 1) for s in spans if s > 1}
    block = min([block, *(int(200 / -math.log(r)) for r in keep.values())])
    placed = (prices.select("symbol", "trade_date", "price")
              .withColumn("__n", F.row_number().over(w) - 1)
              .withColumn("__block", F.floor(F.col("__n") / block)).withColumn("__at", F.col("__n") % block))
    inside = Window.partitionBy("symbol", "__block").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    out = placed
    for s, r in keep.items():
        scaled = F.sum(F.col("price") * F.pow(F.lit(r), -F.col("__at"))).over(inside)
        out = out.withColumn(f"__sum_{s}", scaled * F.pow(F.lit(r), "__at"))
    ends = placed.groupBy("symbol", "__block").agg(*[
        F.sum(F.col("price") * F.pow(F.lit(r), F.lit(block - 1) - F.col("__at"))).alias(f"__total_{s}") for s, r in keep.items()])
    for s, r in keep.items():
        reach = max(1, math.ceil(46 / (block * -math.log(r))))
        earlier = F.collect_list(f"__total_{s}").over(Window.partitionBy("symbol").orderBy("__block").rowsBetween(-reach, -1))
        fade = F.lit(r ** block)
        ends = ends.withColumn(f"__carry_{s}", _folded(earlier, fade))
    out = out.join(ends.select("symbol", "__block", *[f"__carry_{s}" for s in keep]), ["symbol", "__block"])
    for s in spans:
        if s not in keep:
            out = out.withColumn(f"ema_{s}", F.col("price").cast("double"))
            continue
        r = keep[s]
        weight = (1 - F.pow(F.lit(r), F.col("__n") + 1)) / (1 - r)
        total = F.col(f"__sum_{s}") + F.pow(F.lit(r), F.col("__at") + 1) * F.col(f"__carry_{s}")
        out = out.withColumn(f"ema_{s}", F.when(F.col("__n") + 1 >= s - 1, total / weight))
    return out.select("symbol", "trade_date", "price", *[f"ema_{s}" for s in spans])


def action(score: Column, buy_at: float = 0.01, sell_at: float = -0.01) -> Column:
    return F.when(score >= buy_at, BUY).when(score <= sell_at, SELL).otherwise(HOLD)


def order_shares(thinned: DataFrame, lot: int = 500) -> DataFrame:
    """Share moves between held positions: BUY holds +lot, anything else -lot."""
    w = by_symbol()
    held = F.when(F.col("action") == BUY, lot).otherwise(-lot)
    return (thinned.withColumn("held", held)
            .withColumn("change", F.col("held") - F.lag("held", 1, 0).over(w))
            .withColumn("shares", F.abs("change")))


def order_list(thinned: DataFrame, calendar: DataFrame, lot: int = 500) -> DataFrame:
    """Trades that move shares plus a closing trade on each symbol's last day."""
    moves = order_shares(thinned, lot)
    trades = moves.where(F.col("shares") != 0).select(
        "symbol", "trade_date", F.col("action").alias("side"), "shares", F.lit(0).alias("seq"))
    last_day = calendar.groupBy("symbol").agg(F.max("trade_date").alias("trade_date"))
    closing = (moves.groupBy("symbol").agg(F.sum("change").alias("position"))
               .join(last_day, "symbol")
               .select("symbol", "trade_date",
                       F.when(F.col("position") == lot, SELL).otherwise(BUY).alias("side"),
                       F.lit(lot).alias("shares"), F.lit(1).alias("seq")))
    return trades.unionByName(closing)


def signed(side: Column, amount: Column) -> Column:
    return F.when(side == BUY, amount).when(side == SELL, -amount).otherwise(0)


def ledger(orders: DataFrame, prices: DataFrame, start_value: float = 1_000_000.0) -> DataFrame:
    """Cash, equity and total per account and day.

    ``orders`` has account, symbol, trade_date, side, shares. A day's orders net
    per account and symbol before the running sums, so days bound each window;
    these nets are stored, so orders and prices are read once each.
    """
    net = checkpointed(orders.groupBy("account", "symbol", "trade_date")
                       .agg(F.sum(signed(F.col("side"), F.col("shares"))).alias("shares")))
    # one row per account and symbol by now; an account's days end with its last order in any symbol
    span = net.groupBy("account", "symbol").agg(F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last")).select(
        "account", "symbol", "first_day", F.max("last").over(Window.partitionBy("account")).alias("last_day"))
    held_days = (prices.join(span, "symbol")
                 .where(F.col("trade_date").between(F.col("first_day"), F.col("last_day")))
                 .select("account", "symbol", "trade_date", "price"))
    w = Window.partitionBy("account", "symbol").orderBy("trade_date")
    positions = (held_days.join(net, ["account", "symbol", "trade_date"], "left")
                 .withColumn("shares", F.coalesce("shares", F.lit(0)))
                 .withColumn("position", F.sum("shares").over(w)))
    days = positions.groupBy("account", "trade_date").agg(
        F.sum(F.col("shares") * F.col("price")).alias("spent"),
        F.sum(F.col("position") * F.col("price")).alias("equity"))
    run = Window.partitionBy("account").orderBy("trade_date")
    cash = F.lit(float(start_value)) - F.sum("spent").over(run)
    return (days.withColumn("cash", cash)
            .select("account", "trade_date", "cash", "equity",
                    F.round(F.col("cash") + F.col("equity"), 4).alias("total_value")))


def capped_ledger(orders: DataFrame, prices: DataFrame, start_value: float = 1_000_000.0,
                  max_leverage: float = 3.0) -> DataFrame:
    """The ledger of single-symbol accounts where an order that would reach
    ``max_leverage`` is ignored.

    leverage = |position value| / (|position value| + cash), so a negative value
    passes. Each decision depends on the one before: rows of an account stream
    past in date order with a constant-size state, never as one collected group.
    """
    span = orders.groupBy("account").agg(F.min("symbol").alias("symbol"), F.max("symbol").alias("other"),
                                         F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day"))
    several = F.raise_error(F.concat(F.lit("the capped ledger takes one symbol per account: "), "account"))
    span = span.withColumn("symbol", F.when(F.col("symbol") == F.col("other"), F.col("symbol")).otherwise(several.cast("string")))
    days = (prices.join(span, "symbol")
            .where(F.col("trade_date").between(F.col("first_day"), F.col("last_day")))
            .select("account", "symbol", "trade_date", "price"))
    change = signed(F.col("side"), F.col("shares")).cast("double")
    rows = (days.join(orders.select("account", "symbol", "trade_date", "seq", change.alias("change")),
                      ["account", "symbol", "trade_date"], "left")
            .select("account", "trade_date", F.coalesce("seq", F.lit(0)).alias("seq"), "price",
                    F.coalesce("change", F.lit(0.0)).alias("change")))
    schema = ("account string, trade_date date, seq int, cash double, equity double, "
              "total_value double, accepted boolean")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        account, cash, position = None, 0.0, 0.0
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.account != account:
                    account, cash, position = row.account, float(start_value), 0.0
                new_cash = cash - row.price * row.change
                exposure = abs((position + row.change) * row.price)
                base = exposure + new_cash
                accepted = base == 0 or exposure / base < max_leverage
                if accepted:
                    cash, position = new_cash, position + row.change
                equity = position * row.price
                out.append((account, row.trade_date, row.seq, cash, equity,
                            round(cash + equity, 4), accepted))
            yield pd.DataFrame(out, columns=["account", "trade_date", "seq", "cash", "equity",
                                             "total_value", "accepted"])

    return (rows.repartition("account").sortWithinPartitions("account", "trade_date", "seq")
            .mapInPandas(walk, schema))


def buy_and_hold(prices: DataFrame, lot: int = 500, start_value: float = 100_000.0) -> DataFrame:
    first = F.first("price").over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    return prices.withColumn("buy_hold_value",
                             F.col("price") * lot + (F.lit(start_value) - first * lot))


def rebase(df: DataFrame, value: str, out: str, key: str = "symbol") -> DataFrame:
    first = F.first(value).over(by_symbol(key).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(out, F.try_divide(F.col(value), first))


def calendar_range(start: Column, end: Column) -> Column:
    """One row per day from ``start`` to ``end``, both included."""
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))
