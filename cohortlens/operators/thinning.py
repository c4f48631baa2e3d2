"""Thinning of daily signals by an associative scan.

What a stretch of days does is a table from the state before it to the state
after it: how many days no flip may follow yet, and the last action kept.
Tables compose, so the days of a symbol are cut into blocks whose tables are
worked out apart, composed over the blocks in levels, and each block then keeps
its days from the state it starts in. No step sees a whole symbol.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cohortlens.operators.ordering import with_row_number
from cohortlens.session import checkpointed

BUY, SELL, HOLD = "BUY", "SELL", "DO NOTHING"
# Pairs (action, last action) that end the current position.
FLIPS = ("BUYSELL", "SELLBUY", "BUYDO NOTHING", "SELLDO NOTHING")
BLOCK_DAYS = 2048
#: Blocks whose tables are composed at once.
FAN = 1024
_ACTIONS = (BUY, SELL, HOLD)


class Scan:
    """States are ``wait * 4 + last action`` (3: none of the three), the last one means that no day has been seen."""

    def __init__(self, hold: int):
        self.hold = hold
        self.initial = (hold + 1) * 4

    def next_flips(self, actions: np.ndarray) -> np.ndarray:
        """(last action, day) -> the first day from there on whose action ends a position of that action."""
        days, out = len(actions), np.full((4, len(actions) + 1), len(actions))
        for last, name in enumerate((*_ACTIONS, "")):
            flips = np.flatnonzero([a < 3 and _ACTIONS[a] + name in FLIPS for a in actions])
            at = np.searchsorted(flips, np.arange(days))
            out[last, :days] = np.append(flips, days)[at]
        return out

    def walk(self, actions: np.ndarray, flips: np.ndarray, state: int, kept: list[int] | None = None) -> int:
        """The state after the block; ``kept`` collects the days kept."""
        days = len(actions)
        if state == self.initial:
            if not days:
                return state
            wait, last = self.hold, int(actions[0])
            if kept is not None:
                kept.append(0)
        else:
            wait, last = divmod(state, 4)
        while wait < days:
            at = int(flips[last, wait])
            if at >= days:
                wait = days
                break
            if kept is not None:
                kept.append(at)
            wait, last = at + self.hold, int(actions[at])
        return min(max(wait - days, 0), self.hold) * 4 + last

    def table(self, actions: np.ndarray) -> list[int]:
        flips = self.next_flips(actions)
        return [self.walk(actions, flips, state) for state in range(self.initial + 1)]


def _codes(actions: object) -> np.ndarray:
    return np.asarray([_ACTIONS.index(a) if a in _ACTIONS else 3 for a in actions], dtype=np.int64)


def _starts(tables: DataFrame, scan: Scan, fan: int, kind: str) -> DataFrame:
    """(symbol, block, start) from (symbol, block, table): the state in which each block starts."""
    last = tables.agg(F.max("block")).first()[0] or 0
    if last == 0:
        return tables.select("symbol", "block", F.lit(scan.initial).alias("start"))
    grouped = tables.withColumn("above", F.floor(F.col("block") / fan).cast("bigint"))

    def compose(rows: pd.DataFrame) -> pd.DataFrame:
        table = np.arange(scan.initial + 1)
        for step in rows.sort_values("block")["table"]:
            table = np.asarray(step)[table]
        return pd.DataFrame({"symbol": rows["symbol"].iloc[:1], "block": rows["above"].iloc[:1], "table": [table.tolist()]})

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        state, starts = int(rows["start"].iloc[0]), []
        for step in rows["table"]:
            starts.append(state)
            state = int(step[state])
        return pd.DataFrame({"symbol": rows["symbol"], "block": rows["block"], "start": starts})

    upper = checkpointed(grouped.groupBy("symbol", "above").applyInPandas(compose, f"symbol {kind}, block bigint, table array<int>"))
    above = _starts(upper, scan, fan, kind).withColumnRenamed("block", "above")
    return (grouped.join(above, ["symbol", "above"]).groupBy("symbol", "above")
            .applyInPandas(follow, f"symbol {kind}, block bigint, start int"))


def thin_signals(signals: DataFrame, hold: int = 10, block_days: int = BLOCK_DAYS, fan: int = FAN) -> DataFrame:
    """Keep a symbol's first row, then each flip at least ``hold`` rows apart.

    From row ``hold`` on a row is kept when its action with the last kept one is
    in ``FLIPS``; the scan then jumps ``hold`` rows. One row per symbol and day;
    null and other actions never flip, and nothing flips them.
    """
    scan = Scan(hold)
    kind, day = (signals.schema[c].dataType.simpleString() for c in ("symbol", "trade_date"))
    numbered = with_row_number(signals.select("symbol", "trade_date", "action"), ["symbol", "trade_date"], "place")
    first = numbered.groupBy("symbol").agg(F.min("place").alias("first"))
    blocks = (numbered.join(first, "symbol")
              .withColumn("block", F.floor((F.col("place") - F.col("first")) / block_days).cast("bigint"))
              .groupBy("symbol", "block").agg(F.sort_array(F.collect_list(F.struct("place", "trade_date", "action"))).alias("days"))
              .select("symbol", "block", F.col("days.trade_date").alias("dates"), F.col("days.action").alias("actions")))
    blocks = checkpointed(blocks)

    def tabled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["symbol", "block"]].assign(table=[scan.table(_codes(a)) for a in batch["actions"]])

    tables = checkpointed(blocks.select("symbol", "block", "actions")
                          .mapInPandas(tabled, f"symbol {kind}, block bigint, table array<int>"))
    started = blocks.join(_starts(tables, scan, fan, kind), ["symbol", "block"])

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            days = []
            for actions, start in zip(batch["actions"], batch["start"]):
                codes, found = _codes(actions), []
                scan.walk(codes, scan.next_flips(codes), int(start), found)
                days.append(found)
            yield batch[["symbol", "block"]].assign(kept=days)

    found = started.select("symbol", "block", "actions", "start").mapInPandas(kept, f"symbol {kind}, block bigint, kept array<int>")
    chosen = F.explode(F.transform("kept", lambda i: F.struct(F.get("dates", i).alias("trade_date"), F.get("actions", i).alias("action"))))
    return (blocks.join(found, ["symbol", "block"]).select("symbol", chosen.alias("day"))
            .select("symbol", F.col("day.trade_date").cast(day).alias("trade_date"), "day.action"))
