"""Delimited text: named tables, typed headerless files, value lists, outputs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cohortlens.functions.columns import parse_day

EVENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("event_description", T.StringType()),
    T.StructField("etimestamp", T.DateType()),
    T.StructField("value", T.DoubleType()),
])
MORTALITY_SCHEMA = T.StructType([
    T.StructField("patient_id", T.LongType()),
    T.StructField("mtimestamp", T.DateType()),
    T.StructField("label", T.IntegerType()),
])
FEATURE_MAP_SCHEMA = T.StructType([
    T.StructField("idx", T.LongType()),
    T.StructField("event_id", T.StringType()),
])


def table_name(path: str) -> str:
    """Last word of the path, without ``.csv``."""
    return re.search(r"(\w+)(?:\.csv)?/?$", path).group(1)


def load_csv_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """CSV with a header, all text, registered under a name taken from the path."""
    df = spark.read.csv(path, header=True)
    df.createOrReplaceTempView(name or table_name(path))
    return df


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = False) -> DataFrame:
    """Declared types; a value that does not parse becomes null."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header,
                          mode="PERMISSIVE", dateFormat="yyyy-MM-dd")


def external_table(spark: SparkSession, name: str, ddl: str, path: str,
                   sep: str = ",") -> DataFrame:
    """A view over delimited files in place; a view of that name is replaced."""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} ({ddl}) USING csv "
              f"OPTIONS (path '{location}', sep '{sep}')")
    return spark.table(name)


def load_event_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``events.csv``, ``mortality_events.csv`` and ``event_feature_map.csv``."""
    events = (spark.read.csv(f"{folder}/events.csv", header=True)
              .select(F.col("patient_id").cast("long"), "event_id", "event_description",
                      parse_day("timestamp").alias("etimestamp"),
                      F.col("value").try_cast("double").alias("value")))
    mortality = (spark.read.csv(f"{folder}/mortality_events.csv", header=True)
                 .select(F.col("patient_id").cast("long"),
                         parse_day("timestamp").alias("mtimestamp"),
                         F.col("label").cast("int")))
    mapping = load_delimited(spark, f"{folder}/event_feature_map.csv", FEATURE_MAP_SCHEMA,
                             header=True)
    return events, mortality, mapping


def drop_leading(df: DataFrame, n: int) -> DataFrame:
    return df.select(*df.columns[n:])


def value_list(spark: SparkSession, path: str) -> DataFrame:
    """One candidate value per line, lower-cased, each once."""
    return spark.read.text(path).select(F.lower("value").alias("value")).distinct()


def feature_matrix(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """Headerless numbers with the label last -> ``features`` array and ``label``."""
    fields = [T.StructField(f"f{i}", T.DoubleType()) for i in range(n_features)]
    fields.append(T.StructField("label", T.DoubleType()))
    raw = load_delimited(spark, path, T.StructType(fields))
    return raw.select(F.array(*[f"f{i}" for i in range(n_features)]).alias("features"), "label")


def store(df: DataFrame, path: str, sep: str = ",", header: bool = False,
          order: Sequence[str] = ()) -> None:
    """Write delimited text; ``order`` gives range-sorted part files."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").csv(path, sep=sep, header=header)


def named_views(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
