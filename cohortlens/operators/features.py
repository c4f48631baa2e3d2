"""Observation-window event features, from events to sparse rows.

Events are first counted and summed per (patient, code, day). That partial
aggregate is what meets the index dates, so a patient holding a large share of
the events is spread over many tasks and reaches the join with at most one row
per code and day.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from cohortlens.functions.columns import days_between, is_present
from cohortlens.operators.ordering import with_row_number

WINDOW_DAYS = 2000
#: Rows of daily totals that one task joins with the index dates and sums per code.
ROWS_PER_TASK = 500_000


def in_window(days: Column, longest: int = WINDOW_DAYS) -> Column:
    return days.between(0, longest)


def events_before_index(events: DataFrame, index: DataFrame) -> DataFrame:
    """Every event with its label and the days from it to the index date."""
    return (events.join(index, "patient_id")
            .select("patient_id", "event_id", "value", "label",
                    days_between("index_date", "etimestamp").alias("time_difference")))


def window_events(events: DataFrame, index: DataFrame, longest: int = WINDOW_DAYS) -> DataFrame:
    """Events with a value, 0 to ``longest`` days before the index date."""
    return (events_before_index(events.where(is_present("value")), index)
            .where(in_window(F.col("time_difference"), longest)))


def daily_totals(events: DataFrame) -> DataFrame:
    return (events.where(is_present("value")).groupBy("patient_id", "event_id", "etimestamp")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


def _measure(how: str) -> Column:
    n, total = F.sum("n").cast("double"), F.sum("total")
    measures = {
        "count": n,
        "sum": total,
        "avg": total / n,
        "lab_count_else_sum": F.when(F.col("event_id").startswith("LAB"), n).otherwise(total),
    }
    return measures[how]


def window_features(events: DataFrame, index: DataFrame, how: str = "count",
                    longest: int = WINDOW_DAYS, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(patient, code, value) over the observation window.

    A task holds its rows' sort and the tables of both sums at once, so totals
    are dealt to as many tasks as the events ask for, whatever their stored size.
    """
    tasks = max(1, -(-events.where(is_present("value")).count() // rows_per_task))
    totals = daily_totals(events).repartition(tasks, "patient_id").join(index.select("patient_id", "index_date"), "patient_id")
    inside = totals.where(in_window(days_between("index_date", "etimestamp"), longest))
    return inside.groupBy("patient_id", "event_id").agg(_measure(how).alias("value"))


def unwindowed_features(events: DataFrame, how: str = "lab_count_else_sum") -> DataFrame:
    """The unlabelled test variant: all events, no window."""
    return daily_totals(events).groupBy("patient_id", "event_id").agg(_measure(how).alias("value"))


def count_per_code(records: DataFrame, entity: str, code: str) -> DataFrame:
    return records.groupBy(entity, code).agg(F.count(F.lit(1)).cast("double").alias("value"))


def average_per_code(records: DataFrame, entity: str, code: str, value: str) -> DataFrame:
    return records.groupBy(entity, code).agg(F.avg(value).alias("value"))


def keep_candidates(records: DataFrame, column: str, candidates: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose code is a candidate: a short literal list or a table of values."""
    if isinstance(candidates, DataFrame):
        return records.join(candidates.select(F.col("value").alias(column)).distinct(),
                            column, "left_semi")
    return records.where(F.col(column).isin(list(candidates)))


def feature_tuples(diagnostics: DataFrame, medications: DataFrame, labs: DataFrame) -> DataFrame:
    """(patient, feature, value): code counts, medicine counts, lab averages."""
    parts = [
        count_per_code(diagnostics, "patient_id", "code").withColumnRenamed("code", "feature"),
        average_per_code(labs, "patient_id", "test_name", "value").withColumnRenamed("test_name", "feature"),
        count_per_code(medications, "patient_id", "medicine").withColumnRenamed("medicine", "feature"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def feature_dictionary(features: DataFrame, code: str = "event_id") -> DataFrame:
    """Zero-based ids of the distinct codes in code order."""
    distinct = features.select(code).where(F.col(code).isNotNull()).distinct()
    return with_row_number(distinct, [code], "idx").select((F.col("idx") - 1).alias("idx"), code)


def map_to_ids(features: DataFrame, dictionary: DataFrame, code: str = "event_id",
               keep_unmapped: bool = False) -> DataFrame:
    """Replace codes with ids. Codes without an id vanish unless kept as null."""
    return (features.join(dictionary, code, "left" if keep_unmapped else "inner")
            .select("patient_id", "idx", "value"))


def scale_by_max(features: DataFrame, idx: str = "idx") -> DataFrame:
    """value / largest value of the feature; null where that maximum is zero."""
    largest = features.groupBy(idx).agg(F.max("value").alias("__max"))
    return (features.join(largest, idx)
            .withColumn("value", F.try_divide("value", "__max")).drop("__max")
            .select("patient_id", idx, "value"))


def indexed_and_scaled(features: DataFrame, code: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(scaled rows by id, dictionary with each code's maximum) in one join.

    Both come from one pass over ``features``, which should be checkpointed when
    it is costly to compute.
    """
    stats = features.groupBy(code).agg(F.max("value").alias("max_value"))
    dictionary = (with_row_number(stats, [code], "idx")
                  .select((F.col("idx") - 1).alias("idx"), code, "max_value"))
    scaled = (features.join(dictionary, code)
              .select("patient_id", "idx", F.try_divide("value", "max_value").alias("value")))
    return scaled, dictionary


def labels(features: DataFrame, index: DataFrame) -> DataFrame:
    """(patient, label) of the patients that have a feature in the window."""
    return features.select("patient_id").distinct().join(index.select("patient_id", "label"), "patient_id")


def dense_rows(features: DataFrame, width: int, entity: str = "patient_id",
               idx: str = "idx") -> DataFrame:
    """One array of ``width`` numbers per entity, zeros where it has no value; an id beyond it fails."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(idx).cast("int").alias("i"), F.col("value").cast("double").alias("v"))))
    # every value is followed by the zeros up to the next one: linear in the width
    after = lambda i: F.coalesce(F.get("cells", i + 1)["i"], F.lit(width))
    filled = F.flatten(F.transform("cells", lambda c, i: F.concat(
        F.array(c["v"]), F.array_repeat(F.lit(0.0), F.greatest(after(i) - c["i"] - 1, F.lit(0)).cast("int")))))
    dense = F.concat(F.array_repeat(F.lit(0.0), F.get("cells", F.lit(0))["i"]), filled)
    last = F.element_at("cells", -1)["i"]
    checked = F.when(last >= width, F.raise_error(F.concat(F.lit("feature id beyond the width: "), last.cast("string")))
                     .cast("array<double>")).otherwise(dense)
    return features.groupBy(entity).agg(cells.alias("cells")).select(entity, checked.alias("features"))


def vector_rows(features: DataFrame, width: int, entity: str = "patient_id",
                idx: str = "idx") -> DataFrame:
    """One sparse ML vector of ``width`` per entity; its size in memory follows its values, not the width.

    The sorted ids and values of an entity become the vector's own arrays,
    batch by batch, with no dense form in between. A null value is 0; ids that
    are null count for nothing, an entity with no other gets an empty vector. An id
    outside the width or twice in one entity fails.
    """
    at = F.col(idx).cast("bigint")
    cell = F.when(at.isNotNull(), F.struct(at.alias("i"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("v")))
    cells = features.groupBy(entity).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    ids = F.transform("cells", lambda c: c["i"])
    outside = F.when(F.array_min(ids) < 0, F.array_min(ids)).when(F.array_max(ids) >= width, F.array_max(ids))
    fault = F.when(outside.isNotNull(), F.concat(F.lit("feature id beyond the width: "), outside.cast("string"))).when(
        F.size(F.array_distinct(ids)) < F.size(ids), F.lit("feature id twice in one entity"))
    checked = F.when(fault.isNotNull(), F.raise_error(fault).cast("array<int>")).otherwise(ids.cast("array<int>"))
    arrays = cells.select(entity, checked.alias("indices"), F.transform("cells", lambda c: c["v"]).alias("values"))
    schema = StructType([arrays.schema[entity], StructField("features", VectorUDT())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            # the stored form of a sparse vector: kind 0, size, ids, values
            vectors = pa.StructArray.from_arrays(
                [pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)), batch.column("indices"), batch.column("values")],
                names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column(entity), vectors], names=[entity, "features"])

    return arrays.mapInArrow(run, schema)


def vector_cells(rows: DataFrame, entity: str = "patient_id", column: str = "features") -> DataFrame:
    """(entity, idx, value) of the values that a vector column stores; a dense vector stores all of its positions.

    Reads the stored arrays as they are, so sparse vectors of any width stay small. Null vectors give no rows.
    """
    schema = StructType([rows.schema[entity], StructField("indices", ArrayType(IntegerType())), StructField("values", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stored = batch.column(column)
            yield pa.RecordBatch.from_arrays([batch.column(entity), *[stored.field(n) for n in ("indices", "values")]],
                                             names=[entity, "indices", "values"])

    stored = rows.where(F.col(column).isNotNull()).select(entity, column).mapInArrow(run, schema)
    ids = F.coalesce("indices", F.sequence(F.lit(0), F.size("values") - 1))
    cells = F.explode(F.arrays_zip(ids.alias("idx"), F.col("values").alias("value"))).alias("c")
    return stored.where(F.size("values") > 0).select(entity, cells).select(entity, "c.idx", "c.value")
