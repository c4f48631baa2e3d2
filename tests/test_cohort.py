import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cohort, features, phenotype
from cohortlens.plans.workloads import mortality_svmlight
from cohortlens.sources import svmlight

D = dt.date
EVENTS = "patient_id long, event_id string, etimestamp date, value double"
DEATHS = "patient_id long, mtimestamp date, label int"


def day(n):
    return D(2000, 1, 1) + dt.timedelta(n)


def frames(spark):
    events = spark.createDataFrame([
        (1, "DIAG1", day(0), 1.0), (1, "LAB1", day(2000), 2.0), (1, "LAB1", day(2000), 4.0),
        (2, "DIAG1", day(0), 1.0), (2, "DRUG1", day(2001), 5.0),
        (3, "LAB1", day(100), None), (3, "LAB1", day(101), float("nan")), (3, "DRUG1", day(50), 7.0),
    ], EVENTS)
    deaths = spark.createDataFrame([(3, day(131), 1), (3, day(131), 1), (None, day(5), 1)], DEATHS)
    return events, deaths


def test_null_key_in_mortality_keeps_the_alive(spark):
    events, deaths = frames(spark)
    assert {r[0] for r in cohort.alive_events(events, deaths).select("patient_id").collect()} == {1, 2}
    assert cohort.dead_events(events, deaths).count() == 3


def test_index_dates(spark):
    found = {r["patient_id"]: (r["index_date"], r["label"]) for r in cohort.index_dates(*frames(spark)).collect()}
    assert found == {1: (day(2000), 0), 2: (day(2001), 0), 3: (day(101), 1)}


def test_window_includes_both_ends_and_drops_missing(spark):
    events, deaths = frames(spark)
    kept = features.window_events(events, cohort.index_dates(events, deaths)).collect()
    found = sorted((r["patient_id"], r["event_id"], r["time_difference"]) for r in kept)
    # 2000 days before is inside, 2001 is not; null and NaN values go
    assert found == [(1, "DIAG1", 2000), (1, "LAB1", 0), (1, "LAB1", 0), (2, "DRUG1", 0), (3, "DRUG1", 51)]


def test_counts_and_sums(spark):
    events, deaths = frames(spark)
    index = cohort.index_dates(events, deaths)
    count = {(r[0], r[1]): r[2] for r in features.window_features(events, index).collect()}
    mixed = {(r[0], r[1]): r[2] for r in features.window_features(events, index, "lab_count_else_sum").collect()}
    average = {(r[0], r[1]): r[2] for r in features.window_features(events, index, "avg").collect()}
    assert count[(1, "LAB1")] == mixed[(1, "LAB1")] == 2.0 and average[(1, "LAB1")] == 3.0
    assert mixed[(3, "DRUG1")] == 7.0 and count[(3, "DRUG1")] == 1.0


def test_svmlight_lines(spark):
    lines = {r["patient_id"]: r["line"] for r in mortality_svmlight(*frames(spark)).collect()}
    assert lines == {1: "0 0:1.000000 2:1.000000", 2: "0 1:1.000000", 3: "1 1:1.000000"}
    ids = {r["patient_id"]: r["line"] for r in mortality_svmlight(*frames(spark), with_id=True).collect()}
    assert ids[3] == "3 1.0 1:1.000000"


def test_scale_by_zero_maximum_is_null(spark):
    rows = spark.createDataFrame([(1, 0, 0.0), (2, 0, 0.0), (1, 1, 2.0)], "patient_id long, idx long, value double")
    found = {(r[0], r[1]): r[2] for r in features.scale_by_max(rows).collect()}
    assert found == {(1, 0): None, (2, 0): None, (1, 1): 1.0}


def test_unmapped_codes_vanish_or_stay_null(spark):
    rows = spark.createDataFrame([(1, "A", 1.0), (1, "B", 2.0)], "patient_id long, event_id string, value double")
    ids = spark.createDataFrame([(0, "A")], "idx long, event_id string")
    assert features.map_to_ids(rows, ids).count() == 1
    assert features.map_to_ids(rows, ids, keep_unmapped=True).where("idx is null").count() == 1


def test_dense_rows(spark):
    rows = spark.createDataFrame([(1, 2, 5.0), (1, 0, 1.0), (2, 1, 3.0)], "patient_id long, idx long, value double")
    found = {r[0]: r[1] for r in features.dense_rows(rows, 3).collect()}
    assert found == {1: [1.0, 0.0, 5.0], 2: [0.0, 3.0, 0.0]}
    assert features.vector_rows(rows, 3).first()["features"].size == 3


def test_vector_rows_store_ids_and_values(spark):
    wide = 2_000_000_000
    rows = spark.createDataFrame([(1, wide - 1, 5.0), (1, 0, 1.0), (2, 7, None), (3, None, 2.0), (4, 9, -1.0)],
                                 "patient_id long, idx long, value double")
    vectors = features.vector_rows(rows, wide)
    found = {r[0]: r[1] for r in vectors.collect()}
    assert {k: (v.size, list(v.indices), list(v.values)) for k, v in found.items()} == {
        1: (wide, [0, wide - 1], [1.0, 5.0]), 2: (wide, [7], [0.0]), 3: (wide, [], []), 4: (wide, [9], [-1.0])}
    cells = features.vector_cells(vectors).collect()
    assert sorted(tuple(r) for r in cells) == [(1, 0, 1.0), (1, wide - 1, 5.0), (2, 7, 0.0), (4, 9, -1.0)]
    assert features.vector_rows(rows.limit(0), 5).count() == 0
    for bad in ([(1, 5, 1.0)], [(1, -1, 1.0)], [(1, -1, 1.0), (1, 2, 1.0)], [(1, 2, 1.0), (1, 2, 3.0)]):
        with pytest.raises(Exception, match="feature id"):
            features.vector_rows(spark.createDataFrame(bad, rows.schema), 5).collect()


def test_vectors_feed_the_learners(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer
    rows = spark.createDataFrame([(1, 2, 5.0), (2, 0, 1.0), (2, 1, 3.0)], "patient_id long, idx long, value double")
    vectors = features.vector_rows(rows, 3)
    assert {r[0]: r[1] for r in vectors.select("patient_id", vector_to_array("features")).collect()} == {1: [0.0, 0.0, 5.0], 2: [1.0, 3.0, 0.0]}
    assert list(vectors.select(Summarizer.mean(F.col("features"))).first()[0]) == [0.5, 1.5, 2.5]


def test_submission_keeps_ids(spark):
    scored = spark.createDataFrame([(7, 0.25)], "patient_id long, probability double")
    assert svmlight.submission(scored).collect() == [(7, 0.25)]


# --- phenotype ------------------------------------------------------------

def labels(spark, dx, meds=(), labs=()):
    dx = spark.createDataFrame(list(dx), "patient_id string, code string")
    meds = spark.createDataFrame([(p, m, day(n)) for p, m, n in meds], "patient_id string, medicine string, date date")
    labs = spark.createDataFrame(list(labs), "patient_id string, test_name string, value double")
    return {r[0]: r[1] for r in phenotype.phenotype_labels(dx, meds, labs).collect()}


def test_cases(spark):
    dx = [("none", "250.00"), ("only1", "250.00"), ("t2first", "250.00"), ("t1first", "250.00"),
          ("sameday", "250.00"), ("type1", "250.01"), ("type1", "250.00")]
    meds = [("only1", "lantus", 1), ("t2first", "lantus", 5), ("t2first", "metformin", 4),
            ("t1first", "lantus", 3), ("t1first", "metformin", 4), ("sameday", "lantus", 3), ("sameday", "actos", 3)]
    assert labels(spark, dx, meds) == {"none": 1, "only1": 1, "t2first": 1, "t1first": 3, "sameday": 3, "type1": 3}


def test_controls_and_case_wins(spark):
    dx = [("ok", "401.9"), ("high", "401.9"), ("related", "790.21"), ("contains", "v250.0x"), ("nolab", "401.9"),
          ("both", "250.2"), ("edge", "401.9"), ("plain", "401.9")]
    labs = [("ok", "glucose", 90.0), ("high", "fasting glucose", 110.0), ("related", "glucose", 90.0),
            ("contains", "glucose", 90.0), ("both", "glucose", 90.0), ("edge", "glucose", 110.0),
            ("plain", "hba1c", 5.0)]
    assert labels(spark, dx, (), labs) == {"ok": 2, "high": 3, "related": 3, "contains": 3, "nolab": 3,
                                           "both": 1, "edge": 2, "plain": 3}


def test_encounter_without_code_keeps_null(spark):
    enc = spark.createDataFrame([(1, 10, day(0)), (2, 11, day(1))], "encounter_id int, member_id int, date date")
    dx = spark.createDataFrame([(1, "V77.1")], "encounter_id int, code string")
    found = {r["patient_id"]: r["code"] for r in phenotype.encounter_diagnostics(enc, dx).collect()}
    assert found == {"10": "v77.1", "11": None}


def test_lab_text(spark):
    raw = spark.createDataFrame([("M1", "2010-01-02T03:04:05Z", "Glucose", "1,234.5"),
                                 ("M1", "2010-01-02T03:04:05Z", "Glucose", "")], "m string, t string, n string, v string")
    rows = phenotype.parse_labs(raw, "m", "t", "n", "v").collect()
    assert len(rows) == 1 and rows[0]["value"] == 1234.5 and rows[0]["test_name"] == "glucose"


def test_hot_patient_is_spread_before_the_join(spark):
    """A third of all events on one patient: the counts stay whole."""
    events = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("patient_id"),
        F.concat(F.lit("LAB"), (F.col("id") % 7).cast("string")).alias("event_id"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("etimestamp"),
        F.lit(1.0).alias("value"))
    deaths = spark.createDataFrame([], DEATHS)
    found = features.window_features(events, cohort.index_dates(events, deaths))
    assert found.agg(F.sum("value")).first()[0] == 30_000


def test_feature_beyond_the_width_fails(spark):
    rows = spark.createDataFrame([(1, 5, 2.0)], "patient_id int, idx int, value double")
    assert features.dense_rows(rows, 6).first()["features"] == [0.0] * 5 + [2.0]
    with pytest.raises(Exception, match="beyond the width"):
        features.dense_rows(rows, 5).collect()


def test_window_features_deal_totals_by_rows(spark):
    rows = [(p, f"LAB{p % 3}", dt.date(2020, 1, 1 + day), 1.0) for p in range(40) for day in range(5)]
    events = spark.createDataFrame(rows, "patient_id long, event_id string, etimestamp date, value double")
    index = spark.createDataFrame([(p, dt.date(2020, 1, 20), 0) for p in range(40)], "patient_id long, index_date date, label int")
    found = features.window_features(events, index, "sum", rows_per_task=10)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    assert {(r["patient_id"], r["value"]) for r in found.collect()} == {(p, 5.0) for p in range(40)}
