"""Minimax contiguous sharding of atomic groups by bytes.

Groups of equal texts stand in one fixed order, by a 60-bit hash of their text.
The smallest capacity that lets the shards take them in that order, whole and
in contiguous runs, is found by binary search over a greedy check, and the
order is cut there.

The driver never holds the groups, only a bounded table of hash ranges with
their bytes. Cuts at the known range borders give a capacity that suffices. No
partition within that capacity can cut outside a narrow zone around each shard's
share, so only ranges that meet a zone are split further, by one aggregate a
round, until each of them is a single group. The result is that of the full list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored, text_or_empty
from cohortlens.operators.ordering import with_row_number

KEY_BITS = 60
#: Ranges of the first look, and the most ranges that one round brings to the driver.
FIRST_BITS = 12
MAX_RANGES = 1 << 16


@dataclass
class Cuts:
    """First key of every shard but the first of the ordinary groups, the groups that fill a shard each, the capacity."""

    lone: list[int]
    borders: list[int]
    capacity: int


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """The least capacity for which the greedy check needs at most ``shards`` runs."""
    if not len(sizes):
        return 0
    ends = np.cumsum(sizes, dtype=np.int64)
    low, high = max(int(sizes.max()), -(-int(ends[-1]) // shards)), int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if _runs(ends, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def _runs(ends: np.ndarray, capacity: int, shards: int) -> bool:
    """Whether filling each run as far as it goes reaches the end."""
    done = 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, done + capacity, side="right"))
        if at == len(ends):
            return True
        done = int(ends[at - 1]) if at else 0
    return False


def even_cuts(sizes: np.ndarray, shards: int, capacity: int) -> list[int]:
    """Where the runs after the first begin: of the cuts that keep to the capacity, the one nearest to an even share."""
    ends = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    total, latest = int(ends[-1]), [len(sizes)]
    for _ in range(shards - 1):  # from here on the remaining runs suffice
        latest.append(int(np.searchsorted(ends, ends[latest[-1]] - capacity, side="left")))
    earliest, cuts, at = latest[::-1], [], 0
    for k in range(1, shards):
        furthest = int(np.searchsorted(ends, ends[at] + capacity, side="right")) - 1
        ideal = ends[at] + (total - ends[at]) / (shards - k + 1)
        near = int(np.searchsorted(ends, ideal))
        if near and ideal - ends[near - 1] <= ends[min(near, len(sizes))] - ideal:
            near -= 1
        at = min(max(near, earliest[k], at), max(furthest, at))
        cuts.append(at)
    return cuts


def _lone_groups(groups: DataFrame, shards: int, total: int) -> list[tuple[int, int]]:
    """Groups of at least an even share of what is left, the largest first: each fills a shard of its own."""
    largest = groups.orderBy(F.desc("bytes"), "key").limit(shards - 1).collect()
    lone: list[tuple[int, int]] = []
    for row in largest:
        left = shards - len(lone)
        if left < 2 or row["bytes"] * left < total:
            break
        lone.append((row["key"], row["bytes"]))
        total -= row["bytes"]
    return lone


def find_cuts(groups: DataFrame, shards: int, first_bits: int = FIRST_BITS, max_ranges: int = MAX_RANGES) -> Cuts:
    """The minimax cuts of ``groups`` (key, bytes), keys from 0 below 2^60 in their order."""
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    lone = _lone_groups(groups, shards, total)
    rest, runs = groups.where(~F.col("key").isin([k for k, _ in lone])) if lone else groups, shards - len(lone)

    def looked_at(bits: int, parents: np.ndarray | None, parent_bits: int) -> np.ndarray:
        """(first key, groups, bytes) of the non-empty ranges of 2^(60-bits) keys, in order; within the parents only."""
        frame = rest
        if parents is not None:
            spark = groups.sparkSession
            wanted = spark.createDataFrame([(int(p),) for p in parents >> (KEY_BITS - parent_bits)], "parent bigint")
            frame = rest.withColumn("parent", F.shiftright("key", KEY_BITS - parent_bits)).join(wanted, "parent", "left_semi")
        width = KEY_BITS - bits
        rows = (frame.groupBy(F.shiftright("key", width).alias("r"))
                .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect())
        out = np.asarray([(r["r"] << width, r["first"], r["n"], r["bytes"]) for r in rows], dtype=np.int64).reshape(-1, 4)
        return out[np.argsort(out[:, 0])]

    # (range start, first key, groups, bytes) and the bits of each range
    bits = min(first_bits, KEY_BITS)
    known = looked_at(bits, None, 0)
    known = np.c_[known, np.full(len(known), bits)]
    while True:
        capacity = smallest_capacity(known[:, 3], runs)
        ends = np.cumsum(known[:, 3])
        starts = ends - known[:, 3]
        size = int(ends[-1]) if len(ends) else 0
        open_range = known[:, 2] > 1
        meets = np.zeros(len(known), dtype=bool)
        for k in range(1, runs):
            meets |= (ends > size - (runs - k) * capacity) & (starts < k * capacity)
        wanted = np.flatnonzero(open_range & meets)
        if not len(wanted):
            break
        # the coarsest of them first, in as many parts as the driver may take
        coarsest = int(known[wanted, 4].min())
        wanted = wanted[known[wanted, 4] == coarsest][:max_ranges // 2]
        finer = min(KEY_BITS, coarsest + max(1, int(np.log2(max_ranges / len(wanted)))))
        parts = looked_at(finer, known[wanted, 0], coarsest)
        known = np.r_[np.delete(known, wanted, axis=0), np.c_[parts, np.full(len(parts), finer)]]
        known = known[np.argsort(known[:, 0])]
    borders = [int(known[c, 1]) if c < len(known) else 1 << KEY_BITS
               for c in even_cuts(known[:, 3], runs, capacity)] if runs > 1 else []
    return Cuts([k for k, _ in lone], borders, max([capacity, *(b for _, b in lone)]))


def shard_of(cuts: Cuts, key: Column) -> Column:
    """Lone groups take the first shards; the others follow between the borders."""
    count = F.lit(len(cuts.lone))
    for border in cuts.borders:
        count = count + (key >= F.lit(border)).cast("int")
    for n, lone in enumerate(cuts.lone):
        count = F.when(key == F.lit(lone), n).otherwise(count)
    return count.cast("int")


def key_of(text: Column) -> Column:
    """The first 60 bits of the text's MD5 digest; equal texts have equal keys."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def shards_by_bytes(docs: DataFrame, shards: int = 16, first_bits: int = FIRST_BITS,
                    max_ranges: int = MAX_RANGES) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    A row's size is its text's UTF-8 bytes and one; null text has none and stands
    with the empty text. Rows of equal text, however many, share a shard. (So do
    texts whose 60-bit keys meet: they count as one group.) A group
    of at least an even share of what is left has a shard of its own; the other
    groups lie in key order in contiguous runs whose largest is as small as can
    be, cut as evenly as that allows. Shards may be empty where groups are few.
    ``slot`` numbers the rows of a shard from 0 by key and doc_id; null ids come first, and
    equal rows take any order among themselves. An empty table gives no row;
    other columns are ignored. Texts of any length are only hashed where they lie.
    """
    text = text_or_empty()
    rows = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                              (F.octet_length(text) + F.lit(1).cast("bigint")).alias("size"),
                              F.crc32(text.cast("binary")).alias("text_crc32"), key_of(text).alias("key")), "shard-rows")
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    cuts = find_cuts(groups, shards, first_bits, max_ranges)
    placed = rows.withColumn("shard", shard_of(cuts, F.col("key")))
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    before = F.lit(0).cast("bigint")
    for shard in sorted(counts):
        before = before + F.when(F.col("shard") > shard, counts[shard]).otherwise(0)
    numbered = with_row_number(placed, ["shard", "key", "doc_id"], "position", store=False)
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           (F.col("position") - 1 - before).cast("bigint").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
