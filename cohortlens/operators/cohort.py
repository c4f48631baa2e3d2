"""Alive/dead cohorts and their statistics.

Events collapse to one row per patient before meeting the mortality table, so a
patient that owns a large part of all events costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def deaths(mortality: DataFrame) -> DataFrame:
    """One row per known dead patient; null keys dropped, earliest date kept."""
    return (mortality.where(F.col("patient_id").isNotNull())
            .groupBy("patient_id").agg(F.min("mtimestamp").alias("mtimestamp")))


def alive_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    return events.join(deaths(mortality), "patient_id", "left_anti")


def dead_events(events: DataFrame, mortality: DataFrame) -> DataFrame:
    return events.join(deaths(mortality), "patient_id", "left_semi")


def with_cohort(df: DataFrame, mortality: DataFrame) -> DataFrame:
    """Add ``cohort``: dead when the patient is in the mortality table."""
    dead = deaths(mortality).select("patient_id", F.lit("dead").alias("cohort"))
    return (df.join(dead, "patient_id", "left")
            .withColumn("cohort", F.coalesce("cohort", F.lit("alive"))))


def _spread(per_patient: DataFrame, mortality: DataFrame, value: str) -> DataFrame:
    return with_cohort(per_patient, mortality).groupBy("cohort").agg(
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.avg(value).alias("avg_value"))


def event_count_stats(events: DataFrame, mortality: DataFrame) -> DataFrame:
    counts = events.groupBy("patient_id").agg(F.count("event_id").alias("n"))
    return _spread(counts, mortality, "n")


def encounter_stats(events: DataFrame, mortality: DataFrame) -> DataFrame:
    days = events.groupBy("patient_id").agg(F.countDistinct("etimestamp").alias("n"))
    return _spread(days, mortality, "n")


def record_length_stats(events: DataFrame, mortality: DataFrame) -> DataFrame:
    spans = events.groupBy("patient_id").agg(
        F.datediff(F.max("etimestamp"), F.min("etimestamp")).alias("n"))
    return _spread(spans, mortality, "n")


def top_codes(events: DataFrame, mortality: DataFrame, classes: Sequence[str] = ("DIAG", "LAB", "DRUG"),
              n: int = 5) -> DataFrame:
    """The ``n`` most frequent codes per cohort and code class, ties by code."""
    kind = F.lit(None).cast("string")
    for name in classes:
        kind = F.when(F.col("event_id").startswith(name), name).otherwise(kind)
    counts = (with_cohort(events.select("patient_id", "event_id"), mortality)
              .groupBy("cohort", "event_id").agg(F.count(F.lit(1)).alias("n_events"))
              .withColumn("code_class", kind).where(F.col("code_class").isNotNull()))
    # rows here are distinct codes, not events
    w = Window.partitionBy("cohort", "code_class").orderBy(F.desc("n_events"), "event_id")
    return (counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("cohort", "code_class", "event_id", "n_events", "rank"))


def last_event(events: DataFrame) -> DataFrame:
    return events.groupBy("patient_id").agg(F.max("etimestamp").alias("last_event"))


def index_dates(events: DataFrame, mortality: DataFrame, lead_days: int = 30) -> DataFrame:
    """Death minus ``lead_days`` for the dead, the last event for the alive."""
    dead = deaths(mortality)
    alive_index = (last_event(events).join(dead, "patient_id", "left_anti")
                   .select("patient_id", F.col("last_event").alias("index_date"),
                           F.lit(0).alias("label")))
    dead_index = dead.select("patient_id", F.date_sub("mtimestamp", lead_days).alias("index_date"),
                             F.lit(1).alias("label"))
    return alive_index.unionByName(dead_index)
