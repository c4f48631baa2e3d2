"""SVMLight text: ``label idx:value ...`` lines, written and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def sparse_text(features: DataFrame, entity: str = "patient_id", idx: str = "idx",
                value: str = "value", base: int = 0) -> DataFrame:
    """One line of ``idx:value`` pairs per entity, ascending ``idx``, six decimals.

    Exact halves round to even, as C and Python formatting do.

    ``features`` holds one row per (entity, idx), so a bag is never larger than
    the feature dictionary.
    """
    bag = F.sort_array(F.collect_list(F.struct(F.col(idx).cast("long").alias("idx"),
                                               F.col(value).cast("double").alias("value"))))
    return (features.groupBy(entity).agg(bag.alias("bag"))
            .select(entity, F.array_join(
                F.transform("bag", lambda p: F.format_string("%d:%.6f", p["idx"] + base, F.bround(p["value"], 6))),
                " ").alias("sparse_feature")))


def labelled_lines(lines: DataFrame, labels: DataFrame, entity: str = "patient_id",
                   with_id: bool = False) -> DataFrame:
    """``label pairs`` or, with ``with_id``, ``id label.0 pairs``."""
    joined = lines.join(labels.select(entity, "label").distinct(), entity)
    if with_id:
        head = F.concat_ws(" ", F.col(entity).cast("string"),
                           F.format_string("%.1f", F.col("label").cast("double")))
    else:
        head = F.col("label").cast("string")
    return joined.select(entity, "label",
                         F.concat_ws(" ", head, F.col("sparse_feature")).alias("line"))


def unlabelled_lines(lines: DataFrame, entity: str = "patient_id") -> DataFrame:
    """``id pairs`` for entities whose label is to be predicted."""
    return lines.select(entity, F.concat_ws(
        " ", F.col(entity).cast("string"), F.col("sparse_feature")).alias("line"))


def write_lines(lines: DataFrame, path: str, column: str = "line") -> None:
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def read_svmlight(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """``label`` and a vector of fixed width; indices in the file start at 1."""
    return spark.read.format("libsvm").option("numFeatures", n_features).load(path)


def submission(scored: DataFrame, entity: str = "patient_id",
               probability: str = "probability") -> DataFrame:
    """(entity, probability) taken from the same row, never paired by position."""
    return scored.select(F.col(entity).alias("patient_id"), F.col(probability).alias("label"))
