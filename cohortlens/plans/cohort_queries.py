"""Cohort statistics, observation-window features and the phenotype."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators import cohort, features, phenotype
from cohortlens.plans import tables as t, workloads
from cohortlens.plans.tables import with_tables
from cohortlens.session import checkpointed
from cohortlens.sources import svmlight
from cohortlens.sources.delimited import named_views


def _both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return t.clinical_events(spark, d), t.mortality(spark, d)


def _index(spark: SparkSession, d: str) -> DataFrame:
    return cohort.index_dates(*_both(spark, d))


def _counted(spark: SparkSession, d: str) -> DataFrame:
    return features.window_features(t.clinical_events(spark, d), _index(spark, d))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """The counted features as a stored stage, read by several later ones."""
    return checkpointed(_counted(spark, d))


def _scaled(spark: SparkSession, d: str) -> DataFrame:
    return features.indexed_and_scaled(_stored(spark, d))[0]


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    counted = _stored(spark, d)
    return features.map_to_ids(counted, features.feature_dictionary(counted), keep_unmapped=True)


def _scaled_by_id(spark: SparkSession, d: str) -> DataFrame:
    return features.scale_by_max(_mapped(spark, d))


def _rounded(df: DataFrame, *columns: str, digits: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _stats(operator):
    return lambda spark, d: _rounded(operator(*_both(spark, d)).withColumns(
        {"min_value": F.col("min_value").cast("long"), "max_value": F.col("max_value").cast("long")}),
        "avg_value", digits=6)


def _stats_sql(measure: str) -> str:
    return with_tables("cohorts", f"""
        SELECT cohort, CAST(min(v) AS BIGINT) AS min_value, CAST(max(v) AS BIGINT) AS max_value,
               round(avg(v), 6) AS avg_value
        FROM (SELECT cohort, e.patient_id, {measure} AS v FROM clinical_events e
              JOIN cohorts c ON e.patient_id = c.patient_id GROUP BY cohort, e.patient_id)
        GROUP BY cohort""")


def _svmlight(spark: SparkSession, d: str, with_id: bool = False) -> DataFrame:
    return workloads.mortality_svmlight(*_both(spark, d), with_id=with_id)


def _unlabelled(spark: SparkSession, d: str) -> DataFrame:
    found = checkpointed(features.unwindowed_features(t.clinical_events(spark, d)))
    return svmlight.unlabelled_lines(svmlight.sparse_text(features.indexed_and_scaled(found)[0]))


def _cohort_views(spark: SparkSession, d: str) -> DataFrame:
    """Both cohorts as named views, counted by plain SQL."""
    events, dead = _both(spark, d)
    named_views({"alive_events": cohort.alive_events(events, dead), "dead_events": cohort.dead_events(events, dead)})
    return spark.sql("""
        SELECT 'alive' AS cohort, event_id, count(*) AS n_events FROM alive_events GROUP BY event_id
        UNION ALL SELECT 'dead', event_id, count(*) FROM dead_events GROUP BY event_id""")


def _width(found: DataFrame) -> int:
    return found.agg(F.coalesce(F.max("idx"), F.lit(-1)) + 1).first()[0]


def _sparse(spark: SparkSession, d: str) -> DataFrame:
    found = _scaled(spark, d)
    rows = features.vector_rows(found, _width(found)).withColumn("f", vector_to_array("features"))
    return rows.select("patient_id", F.round(F.aggregate("f", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


def _positions(spark: SparkSession, d: str) -> DataFrame:
    """Every value a patient's sparse vector stores, by its position."""
    found = _scaled(spark, d)
    return _rounded(features.vector_cells(features.vector_rows(found, _width(found))), "value")


def _feature_tuples(spark: SparkSession, d: str) -> DataFrame:
    found = features.feature_tuples(t.diagnostics(spark, d), t.medications(spark, d), t.labs(spark, d))
    return _rounded(found, "value")


def _dense(spark: SparkSession, d: str) -> DataFrame:
    found = _scaled(spark, d)
    rows = features.dense_rows(found, _width(found))
    return rows.select("patient_id", F.size("features").alias("width"),
                       F.round(F.aggregate("features", F.lit(0.0), lambda a, v: a + v), 6).alias("total"),
                       F.size(F.filter("features", lambda v: v > 0)).alias("filled"))


def _encounters(spark: SparkSession, d: str) -> DataFrame:
    orders = t.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("member_id"),
        F.to_date("o_orderdate").alias("date"))
    lines = t.table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    parts = t.table(spark, d, "part").select("p_partkey", "p_brand")
    codes = lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("l_orderkey").alias("encounter_id"), F.col("p_brand").alias("code"))
    return phenotype.encounter_diagnostics(orders, codes)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Diagnoses in a candidate list kept as a table: codes of large parts."""
    wanted = (t.table(spark, d, "part").where(F.col("p_size") > 45)
              .select(F.concat(F.lit("DIAG"), (F.col("p_partkey") % 40).cast("string")).alias("value"))
              .where(F.col("value").isin("DIAG1", "DIAG2", "DIAG3", "DIAG5", "DIAG8")))
    kept = features.keep_candidates(t.diagnostics(spark, d), "code", wanted)
    return features.count_per_code(kept, "patient_id", "code")


def _phenotype(spark: SparkSession, d: str) -> DataFrame:
    return phenotype.phenotype_labels(t.diagnostics(spark, d), t.medications(spark, d),
                                      t.labs(spark, d), t.RULES)


def _lab_text(spark: SparkSession, d: str) -> DataFrame:
    """Lab results as they arrive in files: text with commas, ISO instants."""
    lines = t.table(spark, d, "lineitem")
    amount = F.when(F.col("l_linenumber") == 7, "").otherwise(
        F.format_number(F.col("l_extendedprice"), 2))
    raw = lines.select(
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("member"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
        F.concat(F.lit("Test "), F.col("l_returnflag")).alias("test"), amount.alias("result"))
    parsed = phenotype.parse_labs(raw, "member", "at", "test", "result")
    return (parsed.groupBy("patient_id", "test_name")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"),
                 F.to_date(F.max("date")).alias("last_day")))


def _medication_text(spark: SparkSession, d: str) -> DataFrame:
    """Medication orders as they arrive in files: mixed case, ISO instants, some of them missing."""
    at = F.when(F.col("l_linenumber") < 7, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    raw = t.table(spark, d, "lineitem").select(
        F.concat(F.lit("M"), F.col("l_suppkey").cast("string")).alias("member"), at.alias("at"),
        F.concat(F.lit("Drug "), F.col("l_returnflag"), F.col("l_linestatus")).alias("medicine"))
    parsed = phenotype.parse_medications(raw, "member", "at", "medicine")
    return (parsed.groupBy("patient_id", "medicine")
            .agg(F.count(F.lit(1)).alias("n"), F.count("date").alias("dated"), F.to_date(F.min("date")).alias("first_day")))


def _phenotype_purity(spark: SparkSession, d: str) -> DataFrame:
    return workloads.phenotype_purity(t.diagnostics(spark, d), t.medications(spark, d), t.labs(spark, d), t.RULES)


QUERIES = {
    "parsed_medications": _medication_text,
    "phenotype_purity": _phenotype_purity,
    "cohort_event_count_stats": _stats(cohort.event_count_stats),
    "cohort_encounter_stats": _stats(cohort.encounter_stats),
    "cohort_record_length": _stats(cohort.record_length_stats),
    "top_codes_by_cohort": lambda s, d: cohort.top_codes(*_both(s, d)),
    "alive_events_anti": lambda s, d: cohort.alive_events(*_both(s, d)),
    "dead_events_semi": lambda s, d: cohort.dead_events(*_both(s, d)),
    "cohort_views": _cohort_views,
    "sparse_feature_rows": _sparse,
    "sparse_vector_cells": _positions,
    "event_cohorts": lambda s, d: cohort.with_cohort(*_both(s, d)).groupBy("cohort", "patient_id").agg(
        F.count(F.lit(1)).alias("n_events")),
    "last_event": lambda s, d: cohort.last_event(t.clinical_events(s, d)),
    "index_dates": _index,
    "events_before_index": lambda s, d: features.events_before_index(t.clinical_events(s, d), _index(s, d)),
    "window_filtered_events": lambda s, d: features.window_events(t.clinical_events(s, d), _index(s, d)),
    "feature_counts": _counted,
    "lab_count_else_sum": lambda s, d: features.window_features(
        t.clinical_events(s, d), _index(s, d), "lab_count_else_sum"),
    "lab_avg_features": lambda s, d: _rounded(features.average_per_code(
        t.labs(s, d), "patient_id", "test_name", "value"), "value"),
    "feature_tuples": _feature_tuples,
    "feature_dictionary": lambda s, d: features.feature_dictionary(_counted(s, d)),
    "features_mapped": _mapped,
    "features_scaled": lambda s, d: _rounded(_scaled_by_id(s, d), "value"),
    "svmlight_rows": _svmlight,
    "svmlight_rows_with_id": lambda s, d: _svmlight(s, d, with_id=True),
    "svmlight_unlabelled": _unlabelled,
    "dense_feature_rows": _dense,
    "window_labels": lambda s, d: features.labels(_counted(s, d), _index(s, d)),
    "candidate_code_filter": _candidates,
    "candidate_literal_filter": lambda s, d: features.count_per_code(
        features.keep_candidates(t.medications(s, d), "medicine", ["DRUG3", "DRUG7", "DRUG11"]),
        "patient_id", "medicine"),
    "encounter_dx_join": _encounters,
    "parsed_lab_results": _lab_text,
    "phenotype_labels": _phenotype,
    "first_med_order": lambda s, d: phenotype.first_medication_dates(t.medications(s, d), t.RULES),
}

_LINE = """
        SELECT patient_id, string_agg(printf('%d:%.6f', idx, value), ' ' ORDER BY idx) AS pairs
        FROM scaled GROUP BY patient_id"""

ORACLES = {
    "parsed_medications": """
        SELECT 'm' || CAST(l_suppkey AS VARCHAR) AS patient_id, lower('Drug ' || l_returnflag || l_linestatus) AS medicine, count(*) AS n,
               count(CASE WHEN l_linenumber <> 7 THEN 1 END) AS dated,
               CAST(min(CASE WHEN l_linenumber <> 7 THEN l_shipdate END) AS DATE) AS first_day
        FROM lineitem GROUP BY 1, 2""",
    "cohort_event_count_stats": _stats_sql("count(e.event_id)"),
    "cohort_encounter_stats": _stats_sql("count(DISTINCT e.etimestamp)"),
    "cohort_record_length": _stats_sql("date_diff('day', min(e.etimestamp), max(e.etimestamp))"),
    "top_codes_by_cohort": with_tables("cohorts", """
        SELECT cohort, code_class, event_id, n_events, CAST(rank AS INT) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY cohort, code_class
                                       ORDER BY n_events DESC, event_id) AS rank
          FROM (SELECT cohort, regexp_extract(event_id, '^[A-Z]+') AS code_class, event_id,
                       count(*) AS n_events
                FROM clinical_events e JOIN cohorts c ON e.patient_id = c.patient_id
                GROUP BY 1, 2, 3))
        WHERE rank <= 5"""),
    "alive_events_anti": with_tables("mortality", """
        SELECT * FROM clinical_events WHERE patient_id NOT IN (SELECT patient_id FROM mortality)"""),
    "dead_events_semi": with_tables("mortality", """
        SELECT * FROM clinical_events WHERE patient_id IN (SELECT patient_id FROM mortality)"""),
    "cohort_views": with_tables("cohorts", """
        SELECT cohort, event_id, count(*) AS n_events FROM clinical_events e
        JOIN cohorts c ON e.patient_id = c.patient_id GROUP BY 1, 2"""),
    "sparse_feature_rows": with_tables("scaled", """
        SELECT patient_id, round(sum(value), 6) AS total FROM scaled GROUP BY patient_id"""),
    "sparse_vector_cells": with_tables("scaled", """
        SELECT patient_id, CAST(idx AS INT) AS idx, round(value, 9) AS value FROM scaled"""),
    "event_cohorts": with_tables("cohorts", """
        SELECT cohort, e.patient_id, count(*) AS n_events FROM clinical_events e
        JOIN cohorts c ON e.patient_id = c.patient_id GROUP BY 1, 2"""),
    "last_event": with_tables("clinical_events", """
        SELECT patient_id, max(etimestamp) AS last_event FROM clinical_events GROUP BY patient_id"""),
    "index_dates": with_tables("index_dates", "SELECT * FROM index_dates"),
    "events_before_index": with_tables("index_dates", """
        SELECT e.patient_id, event_id, value, label,
               CAST(date_diff('day', etimestamp, index_date) AS INT) AS time_difference
        FROM clinical_events e JOIN index_dates i ON e.patient_id = i.patient_id"""),
    "window_filtered_events": with_tables("filtered", """
        SELECT patient_id, event_id, value, label, CAST(time_difference AS INT) AS time_difference
        FROM filtered"""),
    "feature_counts": with_tables("counted", "SELECT * FROM counted"),
    "lab_count_else_sum": with_tables("filtered", """
        SELECT patient_id, event_id,
               CASE WHEN event_id LIKE 'LAB%' THEN CAST(count(*) AS DOUBLE) ELSE sum(value) END AS value
        FROM filtered GROUP BY patient_id, event_id"""),
    "lab_avg_features": with_tables("clinical_events", """
        SELECT patient_id, CASE WHEN event_id IN ('LAB0', 'LAB1', 'LAB2') THEN 'glucose ' || event_id
                                ELSE event_id END AS test_name, round(avg(value), 9) AS value
        FROM clinical_events WHERE event_id LIKE 'LAB%' GROUP BY 1, 2"""),
    "feature_tuples": with_tables("clinical_events", """
        SELECT patient_id, CASE WHEN event_id IN ('LAB0', 'LAB1', 'LAB2') THEN 'glucose ' || event_id
                                ELSE event_id END AS feature,
               round(CASE WHEN event_id LIKE 'LAB%' THEN avg(value)
                          ELSE CAST(count(*) AS DOUBLE) END, 9) AS value
        FROM clinical_events GROUP BY patient_id, event_id"""),
    "feature_dictionary": with_tables("dictionary", "SELECT * FROM dictionary"),
    "features_mapped": with_tables("counted dictionary", """
        SELECT patient_id, idx, value FROM counted LEFT JOIN dictionary USING (event_id)"""),
    "features_scaled": with_tables("scaled", """
        SELECT patient_id, idx, round(value, 9) AS value FROM scaled"""),
    "svmlight_rows": with_tables("scaled", f"""
        SELECT patient_id, label, CAST(label AS VARCHAR) || ' ' || pairs AS line
        FROM ({_LINE}) JOIN (SELECT DISTINCT patient_id, label FROM filtered) USING (patient_id)"""),
    "svmlight_rows_with_id": with_tables("scaled", f"""
        SELECT patient_id, label,
               CAST(patient_id AS VARCHAR) || ' ' || printf('%.1f', CAST(label AS DOUBLE)) || ' ' || pairs AS line
        FROM ({_LINE}) JOIN (SELECT DISTINCT patient_id, label FROM filtered) USING (patient_id)"""),
    "svmlight_unlabelled": with_tables("clinical_events", """
        , totals AS (SELECT patient_id, event_id,
                            CASE WHEN event_id LIKE 'LAB%' THEN CAST(count(*) AS DOUBLE) ELSE sum(value) END AS v
                     FROM clinical_events WHERE value IS NOT NULL GROUP BY patient_id, event_id),
        ids AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx
                FROM (SELECT DISTINCT event_id FROM totals)),
        part_of AS (SELECT patient_id, idx, v / max(v) OVER (PARTITION BY idx) AS value
                    FROM totals JOIN ids USING (event_id))
        SELECT patient_id, CAST(patient_id AS VARCHAR) || ' '
               || string_agg(printf('%d:%.6f', idx, value), ' ' ORDER BY idx) AS line
        FROM part_of GROUP BY patient_id"""),
    "dense_feature_rows": with_tables("scaled", """
        SELECT patient_id, CAST(120 AS INT) AS width, round(sum(value), 6) AS total,
               CAST(count(*) AS INT) AS filled FROM scaled GROUP BY patient_id"""),
    "window_labels": with_tables("filtered", "SELECT DISTINCT patient_id, label FROM filtered"),
    "candidate_code_filter": with_tables("clinical_events", """
        SELECT patient_id, event_id AS code, CAST(count(*) AS DOUBLE) AS value FROM clinical_events
        WHERE event_id IN (SELECT 'DIAG' || CAST(p_partkey % 40 AS VARCHAR) FROM part WHERE p_size > 45)
          AND event_id IN ('DIAG1', 'DIAG2', 'DIAG3', 'DIAG5', 'DIAG8')
        GROUP BY patient_id, event_id"""),
    "candidate_literal_filter": with_tables("clinical_events", """
        SELECT patient_id, event_id AS medicine, CAST(count(*) AS DOUBLE) AS value FROM clinical_events
        WHERE event_id IN ('DRUG3', 'DRUG7', 'DRUG11') GROUP BY patient_id, event_id"""),
    "encounter_dx_join": """
        SELECT CAST(o_custkey AS VARCHAR) AS patient_id, CAST(o_orderdate AS DATE) AS date,
               lower(p_brand) AS code
        FROM orders LEFT JOIN (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
          ON o_orderkey = l_orderkey""",
    "parsed_lab_results": """
        SELECT 'm' || CAST(l_suppkey AS VARCHAR) AS patient_id, 'test ' || lower(l_returnflag) AS test_name,
               count(*) AS n, round(sum(l_extendedprice), 2) AS total,
               CAST(max(l_shipdate) AS DATE) AS last_day
        FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1, 2""",
    "phenotype_labels": with_tables("clinical_events", """
        , dx AS (SELECT patient_id, bool_or(event_id = 'DIAG0') AS t1,
                        bool_or(event_id IN ('DIAG10', 'DIAG11', 'DIAG12')) AS t2,
                        bool_or(event_id IN ('DIAG10', 'DIAG11', 'DIAG12') OR event_id LIKE '%AG20%') AS rel
                 FROM clinical_events WHERE event_id LIKE 'DIAG%' GROUP BY patient_id),
        m1 AS (SELECT patient_id, min(etimestamp) AS f1 FROM clinical_events
               WHERE event_id IN ('DRUG0', 'DRUG1') GROUP BY patient_id),
        m2 AS (SELECT patient_id, min(etimestamp) AS f2 FROM clinical_events
               WHERE event_id IN ('DRUG10', 'DRUG11') GROUP BY patient_id),
        ok AS (SELECT DISTINCT patient_id, TRUE AS normal FROM clinical_events
               WHERE event_id IN ('LAB0', 'LAB1', 'LAB2') AND value < 25)
        SELECT patient_id, CAST(CASE WHEN NOT t1 AND t2 AND (f1 IS NULL OR f2 IS NULL OR f2 < f1) THEN 1
                                     WHEN coalesce(normal, FALSE) AND NOT rel THEN 2 ELSE 3 END AS INT) AS label
        FROM dx LEFT JOIN m1 USING (patient_id) LEFT JOIN m2 USING (patient_id)
        LEFT JOIN ok USING (patient_id)"""),
    "first_med_order": with_tables("clinical_events", """
        SELECT patient_id, min(CASE WHEN event_id IN ('DRUG0', 'DRUG1') THEN etimestamp END) AS first_type1,
               min(CASE WHEN event_id IN ('DRUG10', 'DRUG11') THEN etimestamp END) AS first_type2
        FROM clinical_events WHERE event_id IN ('DRUG0', 'DRUG1', 'DRUG10', 'DRUG11')
        GROUP BY patient_id"""),
}
