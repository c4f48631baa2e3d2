"""Cross-site boilerplate lines by HyperLogLog sketches and exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored, text_or_empty

MIN_SITES = 10
#: Lines whose estimate lies within this share of the threshold are counted exactly. Twelve standard
#: errors of a sketch of 2^12 registers lie within it.
MARGIN = 0.25
LOG_REGISTERS = 12
BLANKS = " \t\r"


def _parts(text: Column) -> Column:
    return F.split(text, "\n")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, site, line_no, h1, h2) of every line that is not blank."""
    bare = F.trim(F.col("line"), F.lit(BLANKS))
    return (docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"),
                        F.posexplode(_parts(text_or_empty())).alias("line_no", "line"))
            .select("doc_id", "site", "line_no", bare.alias("line")).where("line <> ''")
            .select("doc_id", "site", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("2"), "line").alias("h2")))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN,
                log_registers: int = LOG_REGISTERS) -> DataFrame:
    """(h1, h2, first) of the lines that stand on at least ``min_sites`` distinct sites.

    One sketch of sites per 128-bit line hash, merged by aggregation; estimates
    clear of the threshold decide, the others are counted exactly. ``first`` is
    the line's first place (doc_id, line_no).
    """
    lines = _lines(docs)
    spread = (lines.groupBy("h1", "h2")
              .agg(F.hll_sketch_agg("site", log_registers).alias("sites"), F.count(F.lit(1)).alias("n"),
                   F.min(F.struct("doc_id", "line_no")).alias("first"))
              .where(F.col("n") >= min_sites)
              .select("h1", "h2", "first", F.hll_sketch_estimate("sites").alias("n_sites"))
              .where(F.col("n_sites") >= min_sites * (1 - margin)))
    spread = stored(spread, "line-sites")
    sure = F.col("n_sites") > min_sites * (1 + margin)
    near = spread.where(~sure)
    counted = (lines.join(near.select("h1", "h2"), ["h1", "h2"])
               .groupBy("h1", "h2").agg(F.count_distinct("site").alias("exact")).where(F.col("exact") >= min_sites))
    return stored(spread.where(sure).select("h1", "h2", "first")
                  .unionByName(near.join(counted, ["h1", "h2"]).select("h1", "h2", "first")), "line-boilerplate")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN, keep_first: bool = True,
                       log_registers: int = LOG_REGISTERS, counts: bool = False) -> DataFrame:
    """``docs`` with the lines of ``boilerplate`` taken out of ``text``; no document is dropped.

    A line is what stands between line feeds, compared without surrounding
    spaces, tabs and carriage returns; blank lines are never removed. A site is
    a ``source``; null counts as one site. With ``keep_first`` a line stays at
    its first place (smallest doc_id, then line), so that nothing vanishes from
    the corpus. ``n_chars``, where there is one, follows a changed text.
    ``counts`` adds ``n_lines`` and ``n_removed``.

    Null text stays null, empty text empty. Repeated rows of one doc_id are
    treated alike. Other columns are passed on as they are. An empty table gives
    an empty result.
    """
    found = boilerplate(docs, min_sites, margin, log_registers)
    hits = _lines(docs).join(found, ["h1", "h2"])
    if keep_first:
        hits = hits.where(F.struct("doc_id", "line_no") != F.col("first"))
    places = stored(hits.groupBy(F.col("doc_id").alias("found_in")).agg(F.collect_set("line_no").alias("taken")), "line-places")

    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(places.hint("merge"), F.col("row.doc_id") == F.col("found_in"), "left")
    parts = _parts(F.col("row.text"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("taken"))
    cut = F.concat_ws("\n", F.transform(staying, lambda k: F.col("parts")[k]))
    joined = joined.withColumn("parts", parts)
    changed = F.col("taken").isNotNull()
    text = F.when(changed, cut).otherwise(F.col("row.text"))
    out = [text.alias("text") if c == "text" else
           F.when(changed, F.length(text)).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
           F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if counts:
        out += [F.greatest(F.coalesce(F.size("parts"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_lines"),
                F.greatest(F.coalesce(F.size("taken"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_removed")]
    return joined.select(*out)
