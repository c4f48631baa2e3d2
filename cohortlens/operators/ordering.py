"""Row numbers and running sums over one global order, without one global task.

Rows are dealt to ranges of the order key, and each is tagged with its range and
stored. Totals of the ranges give each its starting offset (one row per range)
and the running part is a window inside the range. Any cut gives the exact
result, and all sizes take the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.session import checkpointed

ROWS_PER_BUCKET = 1_000_000
_BUCKET = "__bucket"


def with_running_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column],
                      rows_per_bucket: int = ROWS_PER_BUCKET, store: bool = True) -> DataFrame:
    """Add ``sum(expr)`` over all rows up to and including this one, by ``keys``.

    ``keys`` must be unique and non-null, all ascending. The frame is read
    twice: ``store`` materialises it first, right for aggregates that are small
    beside their input; pass False for a plain scan.
    """
    if store:
        df = checkpointed(df)
    order = [F.col(k).asc() for k in keys]
    ranges = max(2, -(-df.count() // rows_per_bucket))
    # stored, since a partition's number holds for this dealing only
    tagged = checkpointed(df.repartitionByRange(ranges, *keys).withColumn(_BUCKET, F.spark_partition_id()))
    totals = tagged.groupBy(_BUCKET).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_BUCKET, *[
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__before_{n}") for n in sums])
    w = (Window.partitionBy(_BUCKET).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = tagged.join(offsets, _BUCKET)
    return joined.select(*df.columns, *[
        (F.sum(e).over(w) + F.col(f"__before_{n}")).alias(n) for n, e in sums.items()])


def with_row_number(df: DataFrame, keys: Sequence[str], out: str = "row_number",
                    rows_per_bucket: int = ROWS_PER_BUCKET, store: bool = True) -> DataFrame:
    """Add the one-based position of each row in the order of ``keys``."""
    numbered = with_running_sums(df, keys, {out: F.lit(1).cast("bigint")}, rows_per_bucket, store)
    return numbered.withColumn(out, F.col(out).cast("bigint"))


def top_fraction(df: DataFrame, score: str, tiebreak: str, share: float,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The best ``floor(n * share)`` rows by ``score`` descending."""
    keep = int(df.count() * share)
    ranked = with_row_number(df.withColumn("__neg", -F.col(score)), ["__neg", tiebreak],
                             "rank", rows_per_bucket, store=False)
    return ranked.where(F.col("rank") <= keep).drop("__neg")


def first_n(df: DataFrame, key: str, n: int,
            rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Tag the first ``n`` rows in key order as train, the rest as test."""
    numbered = with_row_number(df, [key], "position", rows_per_bucket, store=False)
    return numbered.withColumn("split", F.when(F.col("position") <= n, "train").otherwise("test"))


def fold_of(df: DataFrame, key: str, k: int,
            rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Contiguous folds in key order; the first ``n % k`` folds hold one row more."""
    total = df.count()
    base, extra = divmod(total, k)
    numbered = with_row_number(df, [key], "position", rows_per_bucket, store=False)
    at = F.col("position") - 1
    long_rows = extra * (base + 1)
    fold = F.when(at < long_rows, F.floor(at / (base + 1))).otherwise(
        extra + F.floor((at - long_rows) / max(base, 1)))
    return numbered.withColumn("fold", fold.cast("int")).drop("position")
