"""Daily price panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.functions.columns import parse_day


def read_ticker_files(spark: SparkSession, folder: str, symbols: Sequence[str],
                      price_column: str = "Adj Close") -> DataFrame:
    """``<SYMBOL>.csv`` files or folders -> long (symbol, trade_date, price)."""
    raw = spark.read.csv([f"{folder}/{s}.csv" for s in symbols], header=True)
    stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)\.csv(?:/[^/]*)?$", 1)
    return raw.select(stem.alias("symbol"), parse_day("Date").alias("trade_date"),
                      F.col(price_column).try_cast("double").alias("price")).dropna()


def write_ticker_folder(prices: DataFrame, folder: str, price_column: str = "Adj Close") -> None:
    """One CSV folder ``file=<SYMBOL>.csv`` per symbol, all in one job: rows are dealt by symbol and year first."""
    rows = prices.select(F.concat("symbol", F.lit(".csv")).alias("file"), F.col("trade_date").alias("Date"),
                         F.col("price").alias(price_column))
    (rows.repartition("file", F.year("Date")).write.partitionBy("file").option("header", True)
     .option("dateFormat", "yyyy-MM-dd").csv(folder))


def read_ticker_folder(spark: SparkSession, folder: str, price_column: str = "Adj Close") -> DataFrame:
    """All that ``write_ticker_folder`` wrote, in one scan -> long (symbol, trade_date, price).

    The symbol is the partition's value, so a filter on it prunes the other
    symbols' files. Rows without a readable date or price do not count.
    """
    raw = spark.read.schema(f"Date string, `{price_column}` string, file string").csv(folder, header=True)
    return raw.select(F.regexp_replace("file", r"\.csv$", "").alias("symbol"), parse_day("Date").alias("trade_date"),
                      F.col(price_column).try_cast("double").alias("price")).dropna()


def daily(prices: DataFrame) -> DataFrame:
    """One row per (symbol, day): the calendar then bounds every symbol's rows."""
    return prices.groupBy("symbol", "trade_date").agg(F.avg("price").alias("price"))


def price_panel(prices: DataFrame, symbols: Sequence[str], market: str,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """Symbols plus the market symbol, on days the market traded.

    Every requested symbol has a row for each of those days; the price is null
    when it did not trade itself.
    """
    wanted = list(dict.fromkeys([market, *symbols]))
    rows = prices.where(F.col("symbol").isin(wanted))
    if start is not None:
        rows = rows.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.where(F.col("trade_date") <= F.lit(end).cast("date"))
    # a day's row fans out to the short list of symbols the caller asked for
    grid = (rows.where(F.col("symbol") == market).select("trade_date").distinct()
            .withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in wanted]))))
    return grid.join(rows, ["symbol", "trade_date"], "left")


def wide_panel(panel: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return panel.groupBy("trade_date").pivot("symbol", list(symbols)).agg(F.first("price"))


