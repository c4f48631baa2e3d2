"""Connected components by repeated contraction, without collecting links or hot vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) of every end of ``edges`` (a, b); component_id is the smallest id reachable.

    Each round sends every vertex to the smallest of itself and its neighbours,
    follows these pointers twice, and replaces links by those between where
    their ends went. Minima are aggregated before the shuffle, links that become
    equal are merged, and a smallest vertex is never sent away, so the rounds
    end with one vertex per component. Links to oneself and nulls are ignored.
    """
    links = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a < b").distinct(), "links")
    labels: DataFrame | None = None
    while not links.isEmpty():
        ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("a").alias("to")),
                                              F.struct(F.col("b").alias("id"), F.col("a").alias("to")))).alias("e"))
        pointer = stored(ends.groupBy("e.id").agg(F.min("e.to").alias("to")), "pointers")
        for _ in range(2):
            onward = pointer.select(F.col("id").alias("to"), F.col("to").alias("further"))
            pointer = pointer.join(onward, "to").select("id", F.col("further").alias("to"))
        pointer = stored(pointer, "pointers")
        sent = [pointer.select(F.col("id").alias(c), F.col("to").alias(f"new_{c}")) for c in ("a", "b")]
        moved = links.join(sent[0], "a").join(sent[1], "b")
        links = stored(moved.select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
                       .where("a < b").distinct(), "links")
        if labels is None:
            labels = pointer.select("id", F.col("to").alias("component_id"))
        else:
            step = pointer.select(F.col("id").alias("component_id"), F.col("to").alias("next_id"))
            labels = stored(labels.join(step, "component_id", "left")
                            .select("id", F.coalesce("next_id", "component_id").alias("component_id")), "labels")
    if labels is None:
        kind = links.schema["a"].dataType
        return links.select(F.col("a").cast(kind).alias("id"), F.col("a").cast(kind).alias("component_id"))
    return labels
