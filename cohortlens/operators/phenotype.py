"""Rule-based type-2 diabetes phenotype and the records it reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.columns import is_present, parse_instant, parse_number

CASE, CONTROL, OTHER = 1, 2, 3

# Published type-2 diabetes phenotype criteria.
TYPE1_DX = (
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33",
    "250.41", "250.43", "250.51", "250.53", "250.61", "250.63", "250.71", "250.73",
    "250.81", "250.83", "250.91", "250.93",
)
TYPE2_DX = (
    "250.00", "250.02", "250.2", "250.22", "250.3", "250.32", "250.4", "250.42", "250.5",
    "250.52", "250.6", "250.62", "250.7", "250.72", "250.8", "250.82", "250.9", "250.92",
)
TYPE1_MEDS = (
    "insulin aspart", "insulin detemir", "insulin glargine", "insulin lente",
    "insulin nph", "insulin reg", "insulin,ultralente", "lantus",
)
TYPE2_MEDS = (
    "acarbose", "acetohexamide", "actos", "amaryl", "avandia", "chlorpropamide", "diabanase",
    "diabeta", "diabetamide", "diabinase", "diabinese", "exenatide", "glimepiride",
    "glipizide", "glucatrol", "glucotrol", "glucotrol xl", "glyburide", "glynase",
    "metformin", "micronase", "miglitol", "nateglinide", "pioglitazone", "prandin",
    "repaglinide", "rosiglitazone", "sitagliptin", "tolazamide", "tolbutamide", "troglitazone",
)
DIABETES_DX = (
    "256.4", "277.7", "648", "648.01", "648.02", "648.03", "648.04", "648.81", "648.82",
    "648.83", "648.84", "790.2", "790.21", "790.22", "790.29", "791.5", "v77.1",
)
# (test name, comparison, limit): a value that satisfies the comparison is flagged
GLUCOSE_LIMITS = (
    ("fasting blood glucose", ">=", 110.0),
    ("fasting glucose", ">=", 110.0),
    ("fasting plasma glucose", ">", 110.0),
    ("glucose", ">", 110.0),
    ("glucose, serum", ">", 110.0),
)


@dataclass(frozen=True)
class PhenotypeRules:
    type1_dx: tuple[str, ...] = TYPE1_DX
    type2_dx: tuple[str, ...] = TYPE2_DX
    type1_meds: tuple[str, ...] = TYPE1_MEDS
    type2_meds: tuple[str, ...] = TYPE2_MEDS
    diabetes_dx: tuple[str, ...] = DIABETES_DX
    diabetes_dx_contains: str | None = "250.0"
    lab_name_contains: str = "glucose"
    lab_limits: tuple[tuple[str, str, float], ...] = GLUCOSE_LIMITS


def flagged(test_name: Column, value: Column, limits: tuple[tuple[str, str, float], ...]) -> Column:
    """True where the test's limit rule fires; tests without a rule never fire."""
    out = F.lit(False)
    for name, comparison, limit in limits:
        hit = value >= limit if comparison == ">=" else value > limit
        out = F.when(test_name == name, hit).otherwise(out)
    return out


def first_medication_dates(medications: DataFrame, rules: PhenotypeRules) -> DataFrame:
    """Per patient, the first date of each medication set (null when none)."""
    in1 = F.col("medicine").isin(list(rules.type1_meds))
    in2 = F.col("medicine").isin(list(rules.type2_meds))
    return (medications.where(in1 | in2).groupBy("patient_id")
            .agg(F.min(F.when(in1, F.col("date"))).alias("first_type1"),
                 F.min(F.when(in2, F.col("date"))).alias("first_type2")))


def phenotype_labels(diagnostics: DataFrame, medications: DataFrame, labs: DataFrame,
                     rules: PhenotypeRules = PhenotypeRules()) -> DataFrame:
    """(patient, label) for every patient with a diagnosis; a case beats a control.

    Each input shrinks to one row of flags per patient before the joins.
    """
    code = F.col("code")
    related = code.isin(list(rules.diabetes_dx))
    if rules.diabetes_dx_contains:
        related = related | code.contains(rules.diabetes_dx_contains)
    dx = diagnostics.groupBy("patient_id").agg(
        F.max(F.coalesce(code.isin(list(rules.type1_dx)), F.lit(False))).alias("type1_dx"),
        F.max(F.coalesce(code.isin(list(rules.type2_dx)), F.lit(False))).alias("type2_dx"),
        F.max(F.coalesce(related, F.lit(False))).alias("related_dx"))
    meds = first_medication_dates(medications, rules)
    normal = (labs.where(F.col("test_name").contains(rules.lab_name_contains))
              .where(is_present("value"))
              .where(~flagged(F.col("test_name"), F.col("value"), rules.lab_limits))
              .select("patient_id").distinct().withColumn("normal_lab", F.lit(True)))
    case = (~F.col("type1_dx") & F.col("type2_dx")
            & (F.col("first_type1").isNull() | F.col("first_type2").isNull()
               | (F.col("first_type2") < F.col("first_type1"))))
    control = F.coalesce("normal_lab", F.lit(False)) & ~F.col("related_dx")
    return (dx.join(meds, "patient_id", "left").join(normal, "patient_id", "left")
            .select("patient_id",
                    F.when(case, CASE).when(control, CONTROL).otherwise(OTHER).alias("label")))


def encounter_diagnostics(encounters: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Encounters with their codes; an encounter without one keeps a null code."""
    return (encounters.join(diagnoses, "encounter_id", "left")
            .select(F.lower(F.col("member_id").cast("string")).alias("patient_id"), "date",
                    F.lower("code").alias("code")))


def parse_medications(raw: DataFrame, member: str, ordered_at: str, medicine: str) -> DataFrame:
    return raw.select(F.lower(member).alias("patient_id"), parse_instant(ordered_at).alias("date"),
                      F.lower(medicine).alias("medicine"))


def parse_labs(raw: DataFrame, member: str, taken_at: str, test: str, value: str) -> DataFrame:
    """Lab rows with a result; thousands commas removed."""
    return (raw.where(is_present(value, "string"))
            .select(F.lower(member).alias("patient_id"), parse_instant(taken_at).alias("date"),
                    F.lower(test).alias("test_name"), parse_number(value).alias("value")))
