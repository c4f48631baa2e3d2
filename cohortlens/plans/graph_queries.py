"""Patient-code graph, similarity and random walk over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators import clustering, graph
from cohortlens.plans import tables as t
from cohortlens.plans.tables import with_tables

# three shared parts out of two sets of forty
SIMILAR = 0.03
#: Largest sum by which pushed ranks may fall short of a hundred full rounds.
TOLERANCE = 1e-4


def _source(spark: SparkSession, d: str) -> int:
    """The first patient that has a code."""
    return t.clinical_events(spark, d).agg(F.min("patient_id")).first()[0]


def _one_vs_all(spark: SparkSession, d: str) -> DataFrame:
    ranked = graph.jaccard_one_vs_all(t.patient_codes(spark, d), _source(spark, d), t.patients(spark, d))
    return ranked.withColumn("similarity", F.round("similarity", 9))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    found = graph.jaccard_pairs(t.patient_parts(spark, d), SIMILAR)
    return (found.withColumn("similarity", F.round("similarity", 9))
            .orderBy(F.desc("similarity"), "patient_a", "patient_b"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_edges(t.code_records(spark, d), t.patients(spark, d))


def _walk(spark: SparkSession, d: str, steps: int = 3) -> DataFrame:
    ranks = graph.random_walk(_edges(spark, d), _source(spark, d), steps)
    return ranks.withColumn("rank", F.round("rank", 12))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    source = _source(spark, d)
    ranks = graph.push_walk(_edges(spark, d), source, tolerance=TOLERANCE)
    ranked = graph.ranked_patients(ranks.withColumn("rank", F.round("rank", 12)), t.patients(spark, d), source)
    # the SQL works out the full rounds and holds the shortfall against the tolerance
    return ranked.withColumn("score", F.round("score", 10)).withColumn("within", F.lit(True))


def _pic(spark: SparkSession, d: str) -> DataFrame:
    return clustering.power_iteration_sets(*graph.jaccard_sets(t.patient_parts(spark, d), SIMILAR), k=3)


QUERIES = {
    "latest_record_per_code": lambda s, d: graph.latest_records(
        t.code_records(s, d), ["patient_id", "kind", "code"], "date", ["value"]),
    "graph_vertices": lambda s, d: graph.graph_vertices(t.code_records(s, d), t.patients(s, d)),
    "graph_edges": _edges,
    "jaccard_one_vs_all": _one_vs_all,
    "jaccard_all_pairs": _pairs,
    "random_walk_3_steps": _walk,
    "random_walk_ranked": _ranked,
    "pic_clusters": _pic,
}

_STEP = """
        r{n} AS (SELECT r.id, coalesce(CASE WHEN r.id = (SELECT src FROM source) THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
                                       + 0.85::DOUBLE * m.received, r.rank) AS rank
                 FROM r{p} r LEFT JOIN (
                   SELECT e.dst, sum(r.rank / d.degree) AS received FROM pairs e
                   JOIN degrees d ON e.src = d.src JOIN r{p} r ON e.src = r.id GROUP BY e.dst) m
                 ON r.id = m.dst)"""

def _push_sql(steps: int = 100) -> str:
    """The pushes round by round, beside the full rounds they are held against."""
    pushes, full = "", ""
    for n in range(steps + 1):
        looked = n - n % graph.ROUNDS_PER_CHECKPOINT
        pushes += f""",
        s{n + 1} AS MATERIALIZED (
            SELECT s.id, s.degree, s.rank + CASE WHEN s.sends THEN 0.15::DOUBLE * s.residual ELSE 0 END AS rank,
                   CASE WHEN s.sends THEN 0 ELSE s.residual END + coalesce(m.got, 0) AS residual
            FROM (SELECT *, residual > (SELECT per_edge FROM setting) * degree AND (SELECT sum(residual) FROM s{looked}) > {TOLERANCE}::DOUBLE AS sends
                  FROM s{n}) s LEFT JOIN (
                SELECT e.dst, sum(0.85::DOUBLE * x.residual / x.degree) AS got FROM pairs e JOIN s{n} x ON e.src = x.id
                WHERE x.residual > (SELECT per_edge FROM setting) * x.degree AND (SELECT sum(residual) FROM s{looked}) > {TOLERANCE}::DOUBLE GROUP BY e.dst) m
            ON s.id = m.dst)"""
        if n:
            full += f""",
        f{n} AS MATERIALIZED (
            SELECT f.id, f.degree, CASE WHEN f.id = (SELECT src FROM source) THEN 0.15::DOUBLE ELSE 0 END + 0.85::DOUBLE * m.got AS rank
            FROM f{n - 1} f JOIN (SELECT e.dst, sum(x.rank / x.degree) AS got FROM pairs e JOIN f{n - 1} x ON e.src = x.id GROUP BY e.dst) m
            ON f.id = m.dst)"""
    return with_tables("edges patient_codes", f"""
        , source AS (SELECT min(patient_id) AS src FROM patient_codes),
        pairs AS MATERIALIZED (SELECT src, dst FROM edges),
        setting AS (SELECT {TOLERANCE}::DOUBLE / 2 / count(*) AS per_edge FROM pairs),
        s0 AS MATERIALIZED (SELECT src AS id, count(*) AS degree, 0.0::DOUBLE AS rank,
                                   CASE WHEN src = (SELECT src FROM source) THEN 1.0::DOUBLE ELSE 0 END AS residual FROM pairs GROUP BY src),
        f0 AS MATERIALIZED (SELECT id, degree, 0.15::DOUBLE * residual AS rank FROM s0){pushes}{full},
        short AS (SELECT min(f.rank - s.rank) >= -1e-12 AND sum(f.rank - s.rank) <= {TOLERANCE}::DOUBLE AS within
                  FROM s{steps + 1} s JOIN f{steps} f USING (id)),
        ranked AS (SELECT id, round(rank, 12) AS score FROM s{steps + 1} JOIN customer ON id = c_custkey
                   WHERE id <> (SELECT src FROM source))
        SELECT id AS patient_id, round(score, 10) AS score, row_number() OVER (ORDER BY score DESC, id) AS rank, within
        FROM ranked, short""")


ORACLES = {
    "random_walk_ranked": _push_sql(),
    "latest_record_per_code": with_tables("latest", "SELECT * FROM latest"),
    "graph_vertices": with_tables("code_ids", """
        SELECT id, kind, code AS key FROM code_ids
        UNION ALL SELECT c_custkey, 'patient', CAST(c_custkey AS VARCHAR) FROM customer"""),
    "graph_edges": with_tables("edges", "SELECT * FROM edges"),
    "jaccard_one_vs_all": with_tables("patient_codes", """
        , source AS (SELECT min(patient_id) AS src FROM patient_codes),
        own AS (SELECT code FROM patient_codes WHERE patient_id = (SELECT src FROM source)),
        sizes AS (SELECT p.patient_id, count(*) AS size, count(o.code) AS shared
                  FROM patient_codes p LEFT JOIN own o ON p.code = o.code GROUP BY p.patient_id),
        scores AS (SELECT c_custkey AS patient_id,
                          coalesce(CAST(shared AS DOUBLE) / (size + (SELECT count(*) FROM own) - shared), 0) AS s
                   FROM customer LEFT JOIN sizes ON c_custkey = patient_id
                   WHERE c_custkey <> (SELECT src FROM source))
        SELECT patient_id, round(s, 9) AS similarity,
               row_number() OVER (ORDER BY s DESC, patient_id) AS rank FROM scores"""),
    "jaccard_all_pairs": with_tables("patient_parts", f"""
        , sizes AS (SELECT patient_id, count(*) AS size FROM patient_parts GROUP BY patient_id),
        shared AS (SELECT a.patient_id AS patient_a, b.patient_id AS patient_b, count(*) AS n_shared
                   FROM patient_parts a JOIN patient_parts b ON a.code = b.code AND a.patient_id < b.patient_id GROUP BY 1, 2),
        graded AS (SELECT s.patient_a, s.patient_b, n_shared,
                          CAST(n_shared AS DOUBLE) / (x.size + y.size - n_shared) AS similarity
                   FROM shared s JOIN sizes x ON s.patient_a = x.patient_id JOIN sizes y ON s.patient_b = y.patient_id)
        SELECT patient_a, patient_b, CAST(n_shared AS INT) AS n_shared, round(similarity, 9) AS similarity
        FROM graded WHERE similarity >= {SIMILAR}"""),
    "random_walk_3_steps": with_tables("edges patient_codes", """
        , source AS (SELECT min(patient_id) AS src FROM patient_codes),
        pairs AS (SELECT src, dst FROM edges),
        degrees AS (SELECT src, count(*) AS degree FROM pairs GROUP BY src),
        r0 AS (SELECT DISTINCT src AS id, CASE WHEN src = (SELECT src FROM source) THEN 0.15::DOUBLE
                                               ELSE 0.0::DOUBLE END AS rank FROM pairs),"""
        + ",".join(_STEP.format(n=i, p=i - 1) for i in (1, 2, 3))
        + " SELECT id, round(rank, 12) AS rank FROM r3"),
}
