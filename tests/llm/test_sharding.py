"""Sharding against a plain minimax over all cuts."""
import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cohortlens.llm import sharding
from cohortlens.llm.queries import op13_sharding


def least_largest(sizes, runs):
    """Over every way to cut, by dynamic programming."""
    ends = np.r_[0, np.cumsum(sizes)]
    best = ends.astype(float)
    for _ in range(runs - 1):
        best = np.asarray([min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(len(ends))])
    return best[-1]


@pytest.mark.parametrize("seed", range(6))
def test_capacity_and_cuts_of_lists(seed):
    rng = np.random.default_rng(seed)
    for runs, n in itertools.product((1, 2, 5, 16), (1, 2, 9, 40)):
        sizes = np.ceil(rng.pareto(1.2, n) * 10 + 1).astype(np.int64)
        capacity = sharding.smallest_capacity(sizes, runs)
        assert capacity == least_largest(sizes, runs)
        cuts = [0, *sharding.even_cuts(sizes, runs, capacity), n]
        assert len(cuts) == runs + 1 and cuts == sorted(cuts)
        assert max(sizes[a:b].sum() for a, b in itertools.pairwise(cuts)) <= capacity


def frame(spark, texts):
    rows = [(i, t, "q", -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, shard int")


def check(rows, texts, shards):
    """Returns the bytes of the shards."""
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    home, slots, size = {}, defaultdict(list), defaultdict(int)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.size == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        assert home.setdefault(text, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [size[s] for s in range(shards)]


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_groups_stay_whole_and_capacity_is_the_least(spark, shards):
    rng = np.random.default_rng(3)
    texts = [None, "", "", "é" * 50] + ["copy"] * 30 + [f"{i} " * int(rng.pareto(1.0) * 20 + 1) for i in range(150)]
    docs = frame(spark, texts)
    got = check(sharding.shards_by_bytes(docs, shards, first_bits=3, max_ranges=16).collect(), texts, shards)
    # the same rows in key order, cut by the plain rule
    keys = docs.select(sharding.text_or_empty().alias("text"), sharding.key_of(sharding.text_or_empty()).alias("key")).distinct()
    sums = defaultdict(int)
    for t in texts:
        sums[t or ""] += len((t or "").encode()) + 1
    order = [sums[r.text] for r in keys.orderBy("key").collect()]
    left, lone, total = list(order), [], sum(order)
    while len(lone) < shards - 1 and max(left) * (shards - len(lone)) >= total:
        lone.append(max(left))
        total -= lone[-1]
        left.remove(lone[-1])
    assert got[:len(lone)] == lone
    assert max(got[len(lone):]) == least_largest(left, shards - len(lone))


def test_hot_group_few_groups_and_no_rows(spark):
    texts = ["hot " * 200] * 50 + [f"other {i}" for i in range(20)]
    got = check(sharding.shards_by_bytes(frame(spark, texts), 4).collect(), texts, 4)
    assert got[0] == 50 * 801 and max(got[1:]) - min(got[1:]) <= 20
    got = check(sharding.shards_by_bytes(frame(spark, ["a", "b"]), 16).collect(), ["a", "b"], 16)
    assert sorted(got)[-3:] == [0, 2, 2]
    assert sharding.shards_by_bytes(frame(spark, ["a"]).limit(0), 16).count() == 0


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (1, "b" * 9000)], "doc_id bigint, text string")
    rows = sharding.shards_by_bytes(docs, 2).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, 0), (1, 0), (1, 1), (1, 2)]


def test_registered_query(spark, sf_dir):
    rows = op13_sharding(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    size = check(rows, texts, 16)
    groups = defaultdict(int)
    for r in rows:
        groups[texts[r.doc_id]] += r.size
    assert max(size) <= max(max(groups.values()), sum(size) / 16 + max(groups.values()))
