"""Inputs derived from the given tables, as DataFrames and as SQL texts.

Each derived input has one definition per side; ``with_tables`` puts the SQL
ones a query needs in front of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortlens.operators.phenotype import PhenotypeRules

MARKET = "ALL"
# Prices in about thousands; a prime, so that no price ends on a rounding tie.
PRICE_UNIT = 997

# Trial sets of the phenotype on derived codes.
RULES = PhenotypeRules(
    type1_dx=("DIAG0",), type2_dx=("DIAG10", "DIAG11", "DIAG12"),
    type1_meds=("DRUG0", "DRUG1"), type2_meds=("DRUG10", "DRUG11"),
    diabetes_dx=("DIAG10", "DIAG11", "DIAG12"), diabetes_dx_contains="AG20",
    lab_name_contains="glucose",
    lab_limits=(("glucose LAB0", ">=", 25.0), ("glucose LAB1", ">=", 25.0),
                ("glucose LAB2", ">=", 25.0)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clinical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    prefix = (F.when(F.col("l_returnflag") == "A", "DIAG").when(F.col("l_returnflag") == "N", "LAB")
              .otherwise("DRUG"))
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
            .select(F.col("o_custkey").alias("patient_id"),
                    F.concat(prefix, (F.col("l_partkey") % 40).cast("string")).alias("event_id"),
                    F.to_date("l_shipdate").alias("etimestamp"),
                    F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("value")))


def mortality(spark: SparkSession, sf_dir: str) -> DataFrame:
    owing = (table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
             .select(F.col("c_custkey").alias("patient_id")))
    return (clinical_events(spark, sf_dir).join(owing, "patient_id").groupBy("patient_id")
            .agg(F.date_add(F.max("etimestamp"), 20).alias("mtimestamp"), F.lit(1).alias("label")))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"))


def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = clinical_events(spark, sf_dir)
    return e.where(F.col("event_id").startswith("DIAG")).select(
        "patient_id", F.col("event_id").alias("code"), F.col("etimestamp").alias("date"))


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = clinical_events(spark, sf_dir)
    return e.where(F.col("event_id").startswith("DRUG")).select(
        "patient_id", F.col("event_id").alias("medicine"), F.col("etimestamp").alias("date"))


def labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = clinical_events(spark, sf_dir)
    glucose = F.col("event_id").isin("LAB0", "LAB1", "LAB2")
    name = F.when(glucose, F.concat(F.lit("glucose "), F.col("event_id"))).otherwise(F.col("event_id"))
    return e.where(F.col("event_id").startswith("LAB")).select(
        "patient_id", name.alias("test_name"), F.col("etimestamp").alias("date"), "value")


def code_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(patient, kind, code, date, value) of all three kinds."""
    kind = (F.when(F.col("event_id").startswith("DIAG"), "diagnostic")
            .when(F.col("event_id").startswith("LAB"), "lab").otherwise("medication"))
    return clinical_events(spark, sf_dir).select(
        "patient_id", kind.alias("kind"), F.col("event_id").alias("code"),
        F.col("etimestamp").alias("date"), F.coalesce("value", F.lit(-1.0)).alias("value"))


def patient_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clinical_events(spark, sf_dir).select("patient_id", F.col("event_id").alias("code")).distinct()


def patient_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
            .select(F.col("o_custkey").alias("patient_id"), F.col("l_partkey").alias("code")).distinct())


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean order value by nation, and over all nations as the market."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = (orders.join(customers, orders.o_custkey == customers.c_custkey)
            .groupBy(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("symbol"),
                     F.to_date("o_orderdate").alias("trade_date"))
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
                 F.count(F.lit(1)).alias("n")))
    market = sums.groupBy("trade_date").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    both = sums.unionByName(market.withColumn("symbol", F.lit(MARKET)))
    return both.select("symbol", "trade_date",
                       (F.col("total").cast("double") / F.col("n") / PRICE_UNIT).alias("price"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", F.col("quality").alias("y"),
        (F.col("n_chars").cast("double") / (F.col("n_chars") + 2000)).alias("score"))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features, label 0-9) from the embeddings."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", (F.col("vec_id") % 3).cast("int").alias("cluster"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors and numbers per order with a two-class label."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    return (orders.join(customers, orders.o_custkey == customers.c_custkey)
            .select(F.col("o_orderkey").alias("row_id"), F.col("c_mktsegment").alias("segment"),
                    F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
                    F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.col("o_totalprice").alias("amount"),
                    F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("label")))


SQL = {
    "clinical_events": """
        SELECT o_custkey AS patient_id,
               CASE l_returnflag WHEN 'A' THEN 'DIAG' WHEN 'N' THEN 'LAB' ELSE 'DRUG' END
                 || CAST(l_partkey % 40 AS VARCHAR) AS event_id,
               CAST(l_shipdate AS DATE) AS etimestamp,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS value
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "mortality": """
        SELECT patient_id, CAST(max(etimestamp) + INTERVAL 20 DAY AS DATE) AS mtimestamp, 1 AS label
        FROM clinical_events JOIN customer ON patient_id = c_custkey
        WHERE c_acctbal < 0 GROUP BY patient_id""",
    "cohorts": """
        SELECT DISTINCT e.patient_id,
               CASE WHEN m.patient_id IS NULL THEN 'alive' ELSE 'dead' END AS cohort
        FROM clinical_events e LEFT JOIN mortality m ON e.patient_id = m.patient_id""",
    "index_dates": """
        SELECT patient_id, max(etimestamp) AS index_date, 0 AS label FROM clinical_events
        WHERE patient_id NOT IN (SELECT patient_id FROM mortality) GROUP BY patient_id
        UNION ALL
        SELECT patient_id, CAST(mtimestamp - INTERVAL 30 DAY AS DATE), 1 FROM mortality""",
    "filtered": """
        SELECT e.patient_id, e.event_id, e.value, i.label,
               date_diff('day', e.etimestamp, i.index_date) AS time_difference
        FROM clinical_events e JOIN index_dates i ON e.patient_id = i.patient_id
        WHERE e.value IS NOT NULL
          AND date_diff('day', e.etimestamp, i.index_date) BETWEEN 0 AND 2000""",
    "counted": """
        SELECT patient_id, event_id, CAST(count(*) AS DOUBLE) AS value
        FROM filtered GROUP BY patient_id, event_id""",
    "dictionary": """
        SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx, event_id
        FROM (SELECT DISTINCT event_id FROM counted)""",
    "scaled": """
        SELECT patient_id, idx, value / max(value) OVER (PARTITION BY idx) AS value
        FROM counted JOIN dictionary USING (event_id)""",
    "code_records": """
        SELECT patient_id, CASE WHEN event_id LIKE 'DIAG%' THEN 'diagnostic'
                                WHEN event_id LIKE 'LAB%' THEN 'lab' ELSE 'medication' END AS kind,
               event_id AS code, etimestamp AS date, coalesce(value, -1) AS value
        FROM clinical_events""",
    "code_ids": """
        SELECT kind, code, (SELECT max(c_custkey) FROM customer) + row_number() OVER (
                 ORDER BY CASE kind WHEN 'diagnostic' THEN 1 WHEN 'lab' THEN 2 ELSE 3 END, code) AS id
        FROM (SELECT DISTINCT kind, code FROM code_records)""",
    "latest": """
        SELECT patient_id, kind, code, date, value FROM (
          SELECT *, row_number() OVER (PARTITION BY patient_id, kind, code
                                       ORDER BY date DESC, value DESC) AS n FROM code_records)
        WHERE n = 1""",
    "edges": """
        SELECT patient_id AS src, id AS dst, kind, date, value FROM latest JOIN code_ids USING (kind, code)
        UNION ALL
        SELECT id, patient_id, kind, date, value FROM latest JOIN code_ids USING (kind, code)""",
    "patient_codes": "SELECT DISTINCT patient_id, event_id AS code FROM clinical_events",
    "patient_parts": """
        SELECT DISTINCT o_custkey AS patient_id, l_partkey AS code
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "nation_sums": """
        SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS trade_date,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "prices": """
        SELECT symbol, trade_date, CAST(total AS DOUBLE) / n / 997 AS price FROM nation_sums
        UNION ALL
        SELECT 'ALL', trade_date, CAST(sum(total) AS DOUBLE) / sum(n) / 997
        FROM nation_sums GROUP BY trade_date""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) - 1 AS ix FROM prices""",
    "signals": """
        SELECT symbol, trade_date, ix, price,
               CASE WHEN change >= 0.01 THEN 'BUY' WHEN change <= -0.01 THEN 'SELL'
                    ELSE 'DO NOTHING' END AS action
        FROM (SELECT *, price / lag(price, 10) OVER (PARTITION BY symbol ORDER BY ix) - 1 AS change
              FROM numbered)""",
    "walk": """
        SELECT symbol, CAST(0 AS BIGINT) AS ix, action AS last_action, TRUE AS keep,
               CAST(10 AS BIGINT) AS next_ix
        FROM signals WHERE ix = 0
        UNION ALL
        SELECT s.symbol, s.ix, CASE WHEN f.flip THEN s.action ELSE w.last_action END, f.flip,
               CASE WHEN f.flip THEN s.ix + 10 ELSE s.ix + 1 END
        FROM walk w JOIN signals s ON s.symbol = w.symbol AND s.ix = w.next_ix,
             LATERAL (SELECT s.action || w.last_action IN
               ('BUYSELL', 'SELLBUY', 'BUYDO NOTHING', 'SELLDO NOTHING') AS flip) f""",
    "thinned": """
        SELECT s.symbol, s.trade_date, s.action FROM walk w
        JOIN signals s ON s.symbol = w.symbol AND s.ix = w.ix WHERE w.keep""",
    "moves": """
        SELECT *, held - coalesce(lag(held) OVER (PARTITION BY symbol ORDER BY trade_date), 0) AS change
        FROM (SELECT *, CASE WHEN action = 'BUY' THEN 500 ELSE -500 END AS held FROM thinned)""",
    "order_list": """
        SELECT symbol, trade_date, action AS side, abs(change) AS shares, 0 AS seq
        FROM moves WHERE change <> 0
        UNION ALL
        SELECT m.symbol, p.last_day, CASE WHEN m.position = 500 THEN 'SELL' ELSE 'BUY' END, 500, 1
        FROM (SELECT symbol, sum(change) AS position FROM moves GROUP BY symbol) m
        JOIN (SELECT symbol, max(trade_date) AS last_day FROM prices GROUP BY symbol) p
          ON m.symbol = p.symbol""",
    "scored": """
        SELECT l.doc_id, l.quality AS y, CAST(d.n_chars AS DOUBLE) / (d.n_chars + 2000) AS score
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "clustered": "SELECT vec_id, label, CAST(vec_id % 3 AS INT) AS cluster FROM embeddings",
    "cells": """
        SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS pos,
               CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings""",
    "mixed": """
        SELECT o_orderkey AS row_id, c_mktsegment AS segment, o_orderpriority AS priority,
               o_orderstatus AS status, c_nationkey AS nation, c_acctbal AS balance,
               year(o_orderdate) AS year, month(o_orderdate) AS month, o_totalprice AS amount,
               CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS label
        FROM orders JOIN customer ON o_custkey = c_custkey""",
}

NEEDS = {
    "mortality": ["clinical_events"], "cohorts": ["clinical_events", "mortality"],
    "index_dates": ["clinical_events", "mortality"], "filtered": ["clinical_events", "index_dates"],
    "counted": ["filtered"], "dictionary": ["counted"], "scaled": ["counted", "dictionary"],
    "code_records": ["clinical_events"], "code_ids": ["code_records"], "latest": ["code_records"],
    "edges": ["latest", "code_ids"], "patient_codes": ["clinical_events"], "prices": ["nation_sums"],
    "numbered": ["prices"], "signals": ["numbered"], "walk": ["signals"], "thinned": ["walk", "signals"],
    "moves": ["thinned"], "order_list": ["moves", "prices"],
}


def uniform_sql(seed: int, *keys: str) -> str:
    """The draw of ``functions.columns.uniform`` in SQL; keys are SQL expressions."""
    name = " || ':' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST('0x' || substr(md5({name}), 1, 13) AS BIGINT) / 4503599627370496.0)"


def with_tables(names: str, body: str) -> str:
    """``body`` behind the WITH list of the named inputs and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    recursive = "RECURSIVE " if "walk" in order else ""
    listed = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    return f"WITH {recursive}{listed}\n{body}"
