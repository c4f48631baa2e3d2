"""Writers and readers, exercised over whole derived tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.plans import cohort_queries as cq, tables as t
from cohortlens.plans.tables import with_tables
from cohortlens.session import staging_path
from cohortlens.sources import delimited, prices, svmlight


def _event_rows(spark: SparkSession, d: str) -> DataFrame:
    return t.clinical_events(spark, d).select(
        "patient_id", "event_id", F.lower("event_id").alias("event_description"), "etimestamp", "value")


def _named_table(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "named")
    rows = t.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    delimited.store(rows, path, header=True)
    delimited.load_csv_table(spark, path, "customer_text")
    return spark.sql("SELECT c_custkey, c_name, lower(c_mktsegment) AS segment FROM customer_text "
                     "WHERE c_name <> ''")


def _headerless(spark: SparkSession, d: str) -> DataFrame:
    """A non-number in the value column turns null on loading."""
    path = staging_path(spark, "headerless")
    rows = _event_rows(spark, d).withColumn("value", F.coalesce(F.col("value").cast("string"), F.lit("n/a")))
    delimited.store(rows, path)
    return delimited.load_delimited(spark, path, delimited.EVENT_SCHEMA)


def _external(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "external")
    delimited.store(_event_rows(spark, d), path)
    view = delimited.external_table(
        spark, "events_external", "patient_id STRING, event_id STRING, event_description STRING, "
                                  "time DATE, value DOUBLE", path)
    return view.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"),
                                        F.min("time").alias("first_day"))


def _three_files(spark: SparkSession, d: str) -> DataFrame:
    folder = staging_path(spark, "event-tables")
    events = _event_rows(spark, d).withColumnRenamed("etimestamp", "timestamp")
    deaths = t.mortality(spark, d).withColumnRenamed("mtimestamp", "timestamp")
    delimited.store(events, f"{folder}/events.csv", header=True)
    delimited.store(deaths, f"{folder}/mortality_events.csv", header=True)
    codes = events.select("event_id").distinct().withColumn("idx", F.substring("event_id", -1, 1).cast("long"))
    delimited.store(codes.select("idx", "event_id"), f"{folder}/event_feature_map.csv", header=True)
    read, dead, mapping = delimited.load_event_tables(spark, folder)
    per = read.join(mapping, "event_id").groupBy("patient_id").agg(
        F.count("value").alias("n_values"), F.max("etimestamp").alias("last_day"), F.sum("idx").alias("idx_sum"))
    return per.join(dead, "patient_id", "left")


def _dropped(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "wide")
    delimited.store(t.table(spark, d, "lineitem"), path, header=True)
    return delimited.drop_leading(delimited.load_csv_table(spark, path, "lines_text"), 6)


def _value_list(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "values")
    svmlight.write_lines(t.table(spark, d, "customer").select(F.col("c_mktsegment").alias("line")), path)
    return delimited.value_list(spark, path)


def _ticker_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of every symbol, written and read; the result has the columns of the SQL."""
    folder = staging_path(spark, "tickers")
    rows = t.prices(spark, d)
    names = sorted(r["symbol"] for r in rows.select("symbol").distinct().collect())
    for name in names:
        one = rows.where(F.col("symbol") == name).select(
            F.col("trade_date").alias("Date"), F.col("price").alias("Adj Close"))
        delimited.store(one, f"{folder}/{name}.csv", header=True)
    long = prices.read_ticker_files(spark, folder, names)
    wide = prices.wide_panel(prices.price_panel(prices.daily(long), names, "ALL"), names)
    return wide.select("trade_date", *[F.round(n, 6).alias(n) for n in ("ALL", "N1", "N2")])


def _ticker_folder(spark: SparkSession, d: str) -> DataFrame:
    """Every symbol on every day of the market, from files written in one job and read in one scan."""
    folder = staging_path(spark, "ticker-folder")
    prices.write_ticker_folder(t.prices(spark, d), folder)
    long = prices.read_ticker_folder(spark, folder)
    names = [r["symbol"] for r in long.select("symbol").distinct().collect()]
    panel = prices.price_panel(prices.daily(long), names, t.MARKET)
    return panel.select("symbol", "trade_date", F.round("price", 6).alias("price"))


def _matrix_file(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "matrix")
    rows = t.feature_rows(spark, d)
    delimited.store(rows.select(*[F.col("features")[i].alias(f"f{i}") for i in range(64)], "label"), path)
    read = delimited.feature_matrix(spark, path, 64)
    return read.select("label", F.round(F.aggregate("features", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


def _svmlight_file(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "svmlight")
    labels = cq.QUERIES["window_labels"](spark, d)
    lines = svmlight.sparse_text(cq._scaled(spark, d), base=1)
    svmlight.write_lines(svmlight.labelled_lines(lines, labels), path)
    read = svmlight.read_svmlight(spark, path, 120)
    rows = read.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("f"))
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.aggregate("f", F.lit(0.0), lambda a, v: a + v)), 3).alias("total"))


QUERIES = {
    "csv_named_table": _named_table,
    "csv_headerless_typed": _headerless,
    "csv_external_table": _external,
    "csv_event_tables": _three_files,
    "csv_drop_leading": _dropped,
    "text_value_list": _value_list,
    "ticker_files": _ticker_files,
    "ticker_folder": _ticker_folder,
    "csv_feature_matrix": _matrix_file,
    "svmlight_file": _svmlight_file,
}

ORACLES = {
    "csv_named_table": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, lower(c_mktsegment) AS segment FROM customer""",
    "csv_headerless_typed": with_tables("clinical_events", """
        SELECT patient_id, event_id, lower(event_id) AS event_description, etimestamp, value
        FROM clinical_events"""),
    "csv_external_table": with_tables("clinical_events", """
        SELECT event_id, count(*) AS n, sum(value) AS total, min(etimestamp) AS first_day
        FROM clinical_events GROUP BY event_id"""),
    "csv_event_tables": with_tables("mortality", """
        SELECT e.*, m.mtimestamp, m.label FROM (
          SELECT patient_id, count(value) AS n_values, max(etimestamp) AS last_day,
                 CAST(sum(CAST(right(event_id, 1) AS INT)) AS BIGINT) AS idx_sum
          FROM clinical_events GROUP BY patient_id) e LEFT JOIN mortality m ON e.patient_id = m.patient_id"""),
    "csv_drop_leading": """
        SELECT CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax, l_returnflag,
               l_linestatus, strftime(CAST(l_shipdate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.000') AS l_shipdate FROM lineitem""",
    "text_value_list": "SELECT DISTINCT lower(c_mktsegment) AS value FROM customer",
    "ticker_files": with_tables("prices", """
        SELECT m.trade_date, round(m.price, 6) AS "ALL", round(a.price, 6) AS "N1", round(b.price, 6) AS "N2"
        FROM prices m LEFT JOIN prices a ON a.symbol = 'N1' AND a.trade_date = m.trade_date
        LEFT JOIN prices b ON b.symbol = 'N2' AND b.trade_date = m.trade_date WHERE m.symbol = 'ALL'"""),
    "ticker_folder": with_tables("prices", """
        SELECT s.symbol, m.trade_date, round(p.price, 6) AS price
        FROM prices m JOIN (SELECT DISTINCT symbol FROM prices) s ON true
        LEFT JOIN prices p ON p.symbol = s.symbol AND p.trade_date = m.trade_date WHERE m.symbol = 'ALL'"""),
    "csv_feature_matrix": """
        SELECT CAST(label AS DOUBLE) AS label,
               round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
    "svmlight_file": with_tables("scaled filtered", """
        SELECT label, count(*) AS n, round(sum(total), 3) AS total FROM (
          SELECT patient_id, sum(CAST(printf('%.6f', value) AS DOUBLE)) AS total FROM scaled GROUP BY patient_id)
        JOIN (SELECT DISTINCT patient_id, label FROM filtered) USING (patient_id) GROUP BY label"""),
}
