import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import timeseries as ts
from cohortlens.plans.workloads import trading_strategy
from cohortlens.sources import prices as price_sources


def series(spark, values, symbol="S"):
    rows = [(symbol, dt.date(2000, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, price double")


def walk_values(n, seed=1):
    rng, out = random.Random(seed), [100.0]
    for _ in range(n - 1):
        out.append(out[-1] * (1 + rng.uniform(-0.05, 0.05)))
    return out


def ordered(df, column):
    return [r[column] for r in df.orderBy("trade_date").collect()]


def test_changes(spark):
    values = walk_values(30)
    w = ts.by_symbol()
    df = series(spark, values).select("trade_date", ts.backward_change("price", 10, w).alias("b"),
                                      ts.forward_return("price", 10, w).alias("f"))
    pandas = pd.Series(values)
    back, ahead = pandas.pct_change(10), pandas.pct_change(-10) * -1
    for got, want in ((ordered(df, "b"), back), (ordered(df, "f"), ahead)):
        assert [None if pd.isna(v) else round(v, 9) for v in want] == [None if v is None else round(v, 9) for v in got]


def test_ema_null_rows_and_values(spark):
    values = walk_values(80)
    got = ordered(ts.ema(series(spark, values), [30]), "ema_30")
    assert got[:28] == [None] * 28 and got[28] is not None
    alpha = 2 / 31
    weights = [(1 - alpha) ** (79 - i) for i in range(80)]
    assert abs(got[79] - sum(w * v for w, v in zip(weights, values)) / sum(weights)) < 1e-9


def test_rsi_is_lagged_one_day(spark):
    values = walk_values(40, 3)
    got = ordered(ts.rsi(series(spark, values), 14), "rsi")
    assert got[:14] == [None] * 14
    for t in range(14, 40):
        moves = [values[i] - values[i - 1] for i in range(max(t - 14, 1), t)]
        gain, loss = sum(m for m in moves if m > 0), -sum(m for m in moves if m < 0)
        assert abs(got[t] - (100 - 100 / (1 + gain / loss))) < 1e-9


def test_rsi_without_a_losing_day_and_short_series(spark):
    assert ordered(ts.rsi(series(spark, range(1, 20))), "rsi")[14:] == [100.0] * 5
    assert ordered(ts.rsi(series(spark, range(1, 10))), "rsi") == [None] * 9


def test_action_thresholds(spark):
    df = spark.createDataFrame([(0.01,), (-0.01,), (0.0099,), (None,)], "s double")
    assert [r[0] for r in df.select(ts.action(F.col("s"))).collect()] == ["BUY", "SELL", "DO NOTHING", "DO NOTHING"]


def thin_by_hand(actions, hold=10):
    keep, last, at = [0], actions[0], hold
    while at < len(actions):
        if actions[at] + last in ts.FLIPS:
            keep.append(at)
            last, at = actions[at], at + hold
        else:
            at += 1
    return keep


@pytest.mark.parametrize("seed", range(4))
def test_thinning_matches_loop(spark, seed):
    rng = random.Random(seed)
    actions = [rng.choice(["BUY", "SELL", "DO NOTHING"]) for _ in range(120)]
    start = dt.date(2000, 1, 1)
    df = spark.createDataFrame([("S", start + dt.timedelta(i), a) for i, a in enumerate(actions)],
                               "symbol string, trade_date date, action string")
    kept = ts.thin_signals(df).orderBy("trade_date").collect()
    assert [(r["trade_date"] - start).days for r in kept] == thin_by_hand(actions)


@pytest.mark.parametrize("block, fan, hold", [(7, 3, 10), (5, 2, 1), (64, 1024, 3)])
def test_thinning_over_blocks_matches_loop(spark, block, fan, hold):
    rng, start, rows = random.Random(block), dt.date(2000, 1, 1), []
    want = set()
    for symbol, days in (("A", 250), ("B", 1), ("C", 40)):
        actions = rng.choices(["BUY", "SELL", "DO NOTHING"], [1, 1, 3], k=days)
        rows += [(symbol, start + dt.timedelta(i), a) for i, a in enumerate(actions)]
        want |= {(symbol, start + dt.timedelta(i), actions[i]) for i in thin_by_hand(actions, hold)}
    df = spark.createDataFrame(rows, "symbol string, trade_date date, action string").repartition(5)
    found = [tuple(r) for r in ts.thin_signals(df, hold, block, fan).collect()]
    assert len(found) == len(want) and set(found) == want
    assert ts.thin_signals(df.limit(0), hold).count() == 0


def test_unknown_actions_never_flip(spark):
    start = dt.date(2000, 1, 1)
    df = spark.createDataFrame([("S", start + dt.timedelta(i), a) for i, a in enumerate([None, "BUY", "SELL"])],
                               "symbol string, trade_date date, action string")
    assert [r["action"] for r in ts.thin_signals(df, 1).collect()] == [None]


def test_ema_of_one_day_is_the_price(spark):
    found = ts.ema(series(spark, [10, 12, 11, 14]), [1, 2], block=500)
    assert ordered(found, "ema_1") == [10.0, 12.0, 11.0, 14.0]
    assert all(v is not None and v == v for v in ordered(found, "ema_2"))


def test_orders_move_and_close(spark):
    start = dt.date(2000, 1, 1)
    kept = spark.createDataFrame([("S", start, "BUY"), ("S", start + dt.timedelta(10), "SELL")],
                                 "symbol string, trade_date date, action string")
    found = ts.order_list(kept, series(spark, range(1, 31))).orderBy("trade_date").collect()
    assert [(r["side"], r["shares"]) for r in found] == [("BUY", 500), ("SELL", 1000), ("BUY", 500)]
    assert found[-1]["trade_date"] == dt.date(2000, 1, 30)


ORDERS = "account string, symbol string, trade_date date, side string, shares int, seq int"


def ledger_by_hand(values, orders, start, limit):
    cash, held, out = start, 0, []
    for i, price in enumerate(values):
        for change in orders.get(i, [0]):
            new_cash, exposure = cash - price * change, abs((held + change) * price)
            if exposure + new_cash == 0 or exposure / (exposure + new_cash) < limit:
                cash, held = new_cash, held + change
            out.append(round(cash + held * price, 4))
    return out


def test_capped_ledger_matches_loop(spark):
    values = walk_values(40, 5)
    rng = random.Random(5)
    moves = {i: [rng.choice([-1500, 500, 1000, 2500])] for i in range(0, 40, 3)}
    rows = [("A", "S", dt.date(2000, 1, 1) + dt.timedelta(i), "BUY" if m[0] > 0 else "SELL", abs(m[0]), 0)
            for i, m in moves.items()]
    orders = spark.createDataFrame(rows, ORDERS)
    got = ts.capped_ledger(orders, series(spark, values), 100_000.0).orderBy("trade_date", "seq").collect()
    assert [r["total_value"] for r in got] == ledger_by_hand(values, moves, 100_000.0, 3.0)
    assert not all(r["accepted"] for r in got)


def test_plain_ledger(spark):
    orders = spark.createDataFrame([("A", "S", dt.date(2000, 1, 1), "BUY", 10, 0),
                                    ("A", "S", dt.date(2000, 1, 3), "SELL", 4, 0)], ORDERS)
    got = ts.ledger(orders, series(spark, [10, 11, 12, 13]), 1000.0).orderBy("trade_date").collect()
    assert [(r["cash"], r["equity"], r["total_value"]) for r in got] == [
        (900.0, 100.0, 1000.0), (900.0, 110.0, 1010.0), (948.0, 72.0, 1020.0)]


def test_plain_ledger_reads_its_inputs_once(spark, tmp_path):
    days = [dt.date(2020, 1, 1) + dt.timedelta(n) for n in range(4)]
    spark.createDataFrame([("A", "S", days[0], "BUY", 5), ("A", "T", days[2], "BUY", 1), ("A", "S", days[1], "SELL", 5)],
                          "account string, symbol string, trade_date date, side string, shares long").write.parquet(str(tmp_path / "orders"))
    spark.createDataFrame([(s, d, 2.0) for s in "ST" for d in days], "symbol string, trade_date date, price double").write.parquet(str(tmp_path / "prices"))
    orders, prices = (spark.read.parquet(str(tmp_path / name)) for name in ("orders", "prices"))
    found = ts.ledger(orders, prices, 100.0)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("LogicalRDD") == 2
    assert [(r["cash"], r["equity"]) for r in found.orderBy("trade_date").collect()] == [(90.0, 10.0), (100.0, 0.0), (98.0, 2.0)]


def test_panel_keeps_market_days_only(spark):
    market = series(spark, [1, 2, 3], "MKT")
    late = series(spark, [5, 6, 7, 8, 9], "X").where("trade_date <> date'2000-01-02'")
    panel = price_sources.price_panel(market.unionByName(late), ["X"], "MKT")
    wide = price_sources.wide_panel(panel, ["MKT", "X"]).orderBy("trade_date").collect()
    assert [(r["MKT"], r["X"]) for r in wide] == [(1.0, 5.0), (2.0, None), (3.0, 7.0)]


def test_strategy_runs_end_to_end(spark):
    both = series(spark, walk_values(260, 7), "P").unionByName(series(spark, walk_values(260, 8), "Q"))
    momentum = lambda p: p.select("symbol", "trade_date", ts.backward_change("price", 10, ts.by_symbol()).alias("score"))
    found = trading_strategy(both, momentum).where("trade_date = date'2000-01-01'").collect()
    assert {r["symbol"] for r in found} <= {"P", "Q"} and all(r["benchmark"] == 1.0 for r in found)


def test_capped_ledger_refuses_two_symbols(spark):
    day = dt.date(2020, 1, 2)
    orders = spark.createDataFrame([("x", "A", day, 1, "BUY", 100), ("x", "B", day, 2, "BUY", 100)],
                                   "account string, symbol string, trade_date date, seq int, side string, shares int")
    prices = spark.createDataFrame([("A", day, 10.0), ("B", day, 20.0)], "symbol string, trade_date date, price double")
    with pytest.raises(Exception, match="one symbol per account"):
        ts.capped_ledger(orders, prices, 10_000.0).collect()


def test_ticker_folder_round_trip_prunes_symbols(spark, tmp_path):
    rows = series(spark, [1.5, 2.5], "A").unionByName(series(spark, [3.0], "B.C"))
    price_sources.write_ticker_folder(rows, str(tmp_path / "all"))
    read = price_sources.read_ticker_folder(spark, str(tmp_path / "all"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))
    assert read.columns == ["symbol", "trade_date", "price"]
