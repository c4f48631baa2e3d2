"""Bagged regression trees whose splits are the mean of two drawn rows.

All open nodes of all bags grow by one level at a time: one aggregate finds, per
node, two drawn rows and what tells whether they split it, and the rows follow
the small table of nodes. Rows to predict travel along. A node with few enough
rows is finished where it stands, by one task, with the same draws, so where a
subtree is finished does not change the tree.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.functions.columns import UNIFORM_BITS, uniform
from cohortlens.session import checkpointed

#: Rows of a node that one task takes over, both to learn and to predict.
LOCAL_ROWS = 50_000
#: Tables of open nodes up to this size are copied to the tasks.
BROADCAST_NODES = 50_000
#: Draws tried on a node in one pass, and passes before the middle of a feature's range is taken.
DRAWS, PASSES = 4, 8
# Fixed value: modulus of the hashes that pick rows.
_PRIME = 2 ** 31 - 1


def _draws(seed: int, bag: Column, path: Column, turn: Column, width: int) -> Column:
    """The next draws of a node: a feature and the two factors of a hash over the rows."""
    def one(n: int) -> Column:
        at = turn * DRAWS + n
        number = lambda what, top: F.floor(uniform(seed, bag, path, at, F.lit(what)) * top)
        return F.struct(number("feature", width).cast("int").alias("i"), (number("a", _PRIME - 1) + 1).alias("a"),
                        number("b", _PRIME).alias("b"))

    return F.array(*[one(n) for n in range(DRAWS)])


def _nodes(state: DataFrame, seed: int, width: int, leaf_rows: int, local_rows: int) -> DataFrame:
    """One row per open node: what becomes of it, its mean, its split, the draws of what follows."""
    fit, bag, path, turn = F.col("fit"), F.col("bag"), F.col("path"), F.col("turn")
    seen, found = [], []
    for n in range(DRAWS):
        draw = F.col("draws")[n]
        value = F.get("x", draw["i"])
        picked = F.when(fit, F.struct(((draw["a"] * F.col("u") + draw["b"]) % _PRIME).alias("h"),
                                      F.col("key").cast("string").alias("k"), value.alias("v")))
        seen += [F.min(picked).alias(f"one{n}"), F.max(picked).alias(f"two{n}"), F.first(draw["i"]).alias(f"i{n}"),
                 F.min(F.when(fit, value)).alias(f"low{n}"), F.max(F.when(fit, value)).alias(f"top{n}")]
        one, two, low, top = F.col(f"one{n}.v"), F.col(f"two{n}.v"), F.col(f"low{n}"), F.col(f"top{n}")
        middle = lambda a, b: F.when(((a + b) / 2 >= F.least(a, b)) & ((a + b) / 2 < F.greatest(a, b)),
                                     (a + b) / 2).otherwise(F.least(a, b))
        split = lambda at: F.struct(F.col(f"i{n}").alias("i"), at.alias("at"))
        found.append((F.when(middle(one, two) < top, split(middle(one, two))),
                      F.when((turn >= PASSES - 1) & (low < top), split(middle(low, top)))))
    nodes = state.groupBy("bag", "path").agg(
        F.count(F.when(fit, 1)).alias("n"), F.count(F.lit(1)).alias("rows"), F.max("turn").alias("turn"),
        F.avg(F.when(fit, F.col("y"))).alias("mean"), F.min(F.when(fit, F.col("y"))).alias("y0"),
        F.max(F.when(fit, F.col("y"))).alias("y1"), F.min(F.when(fit, F.col("x"))).alias("x0"),
        F.max(F.when(fit, F.col("x"))).alias("x1"), *seen)
    leaf = (F.col("n") <= F.lit(leaf_rows)) | (F.col("y0") == F.col("y1")) | (F.col("x0") == F.col("x1"))
    nodes = nodes.withColumn("split", F.coalesce(*[f[0] for f in found], *[f[1] for f in found]))
    kind = (F.when(leaf, "leaf").when(F.col("rows") <= local_rows, "local")
            .when(F.col("split").isNotNull(), "split").otherwise("again"))
    follow = lambda to, at: _draws(seed, bag, to, at, width)
    return nodes.withColumn("kind", kind).select(
        "bag", "path", "kind", "mean", "split",
        F.when(F.col("kind") == "split", follow(F.concat(path, F.lit("0")), F.lit(0)))
        .when(F.col("kind") == "again", follow(path, turn + 1)).alias("left"),
        F.when(F.col("kind") == "split", follow(F.concat(path, F.lit("1")), F.lit(0))).alias("right"))


def _number(*keys: object) -> float:
    """What ``uniform`` draws for the keys, inside a task."""
    digest = hashlib.md5(":".join(map(str, keys)).encode()).hexdigest()
    return int(digest[:UNIFORM_BITS // 4], 16) / (1 << UNIFORM_BITS)


def _middle(a: float, b: float) -> float:
    with np.errstate(over="ignore"):
        mean = (a + b) / 2
    return mean if min(a, b) <= mean < max(a, b) else min(a, b)


def _local_split(seed: int, bag: int, path: str, x: np.ndarray, u: np.ndarray, keys: np.ndarray) -> tuple[int, float]:
    """The split of one node whose features differ somewhere."""
    turn = 0
    while True:
        spare = None
        for n in range(turn * DRAWS, (turn + 1) * DRAWS):
            number = lambda what: _number(seed, bag, path, n, what)
            i = int(number("feature") * x.shape[1])
            hashed = ((int(number("a") * (_PRIME - 1)) + 1) * u + int(number("b") * _PRIME)) % _PRIME
            ends = []
            for extreme, pick in ((hashed.min(), min), (hashed.max(), max)):
                ends.append(x[pick(np.flatnonzero(hashed == extreme), key=lambda row: keys[row]), i])
            low, top = x[:, i].min(), x[:, i].max()
            if _middle(*ends) < top:
                return i, _middle(*ends)
            if spare is None and low < top:
                spare = i, _middle(low, top)
        if turn >= PASSES - 1 and spare is not None:
            return spare
        turn += 1


def random_split_trees(train: DataFrame, test: DataFrame, key: str, trees: int = 15, leaf_rows: int = 50,
                       share: float = 0.6, target: str = "target", seed: int = 7,
                       local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(key, target, prediction): mean over ``trees`` bags of ``share`` of the rows each.

    Rows have ``features`` and ``target``; ``key`` is unique in each input. A
    node draws a feature and two different rows, by hashes of seed, bag, node
    and row, and splits at the mean of their values; where that leaves a side
    empty it draws anew, after ``PASSES * DRAWS`` draws the middle of the drawn
    feature's range is taken. Nodes of at most ``leaf_rows`` rows, of one target
    or of equal features are leaves and predict their mean.

    Training rows with a null, infinite or NaN number are left out. Rows to predict
    may have any: what is not at most the split goes right. A bag without rows
    does not count; without any training rows predictions are null.
    """
    number = lambda c: F.col(c).cast("double")
    finite = lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))
    bags = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("bag")

    def rows(df: DataFrame, fit: bool) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.col("features").cast("array<double>").alias("x"),
                         number(target).alias("y"), F.lit(fit).alias("fit"), bags)

    widths = train.agg(F.max(F.size("features"))).first()[0]
    usable = finite(F.col("y")) & F.forall("x", finite) & (F.size("x") == F.lit(widths or 0))
    learn = rows(train, True).where(usable & (uniform(seed, "key", "bag") < share))
    width = max(widths or 1, 1)
    state = learn.unionByName(rows(test, False)).select(
        "*", F.floor(uniform(seed, "key", "bag", F.lit("row")) * _PRIME).alias("u"), F.lit("").alias("path"), F.lit(0).alias("turn"))
    state = checkpointed(state.withColumn("draws", _draws(seed, F.col("bag"), F.col("path"), F.col("turn"), width)))
    kind_of_key = dict(state.dtypes)["key"]

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        bag, start = int(group["bag"].iloc[0]), group["path"].iloc[0]
        learns = group["fit"].to_numpy(bool)
        known, asked = group[learns], group[~learns]
        x, y, u = np.vstack(known["x"].to_list()), known["y"].to_numpy(float), known["u"].to_numpy(np.int64)
        keys = known["key"].astype(str).to_numpy(object)
        # a missing feature compares like NaN: it goes right
        to = np.full((len(asked), width), np.nan)
        for at, values in enumerate(asked["x"]):
            if values is not None:
                given = np.asarray(values, dtype=float)[:width]
                to[at, :len(given)] = given
        out = np.full(len(asked), np.nan)
        nodes = [(start, np.arange(len(x)), np.arange(len(asked)))]
        while nodes:
            path, mine, theirs = nodes.pop()
            if not len(theirs):
                continue
            if len(mine) <= leaf_rows or y[mine].min() == y[mine].max() or (x[mine] == x[mine[0]]).all():
                out[theirs] = y[mine].mean()
                continue
            i, at = _local_split(seed, bag, path, x[mine], u[mine], keys[mine])
            left, goes = x[mine, i] <= at, to[theirs, i] <= at
            nodes += [(path + "0", mine[left], theirs[goes]), (path + "1", mine[~left], theirs[~goes])]
        return pd.DataFrame({"key": asked["key"].to_numpy(), "y": asked["y"].to_numpy(), "value": out})

    parts: list[DataFrame] = []
    while True:
        nodes = checkpointed(_nodes(state, seed, width, leaf_rows, local_rows))
        kinds = {r["kind"]: r["count"] for r in nodes.groupBy("kind").count().collect()}
        # beyond that size adaptive execution splits the rows of large nodes
        held = F.broadcast(nodes) if sum(kinds.values()) <= BROADCAST_NODES else nodes
        joined = state.join(held, ["bag", "path"])
        if "leaf" in kinds:
            parts.append(checkpointed(joined.where("kind = 'leaf' AND NOT fit").select("key", "y", F.col("mean").alias("value"))))
        if "local" in kinds:
            here = joined.where("kind = 'local'").select("key", "bag", "path", "fit", "x", "y", "u")
            parts.append(checkpointed(here.groupBy("bag", "path").applyInPandas(finish, f"key {kind_of_key}, y double, value double")))
        if not kinds.keys() & {"split", "again"}:
            break
        left = F.coalesce(F.get("x", F.col("split.i")) <= F.col("split.at"), F.lit(False))
        splits = F.col("kind") == "split"
        state = checkpointed(joined.where(F.col("kind").isin("split", "again")).select(
            "key", "x", "y", "fit", "bag", "u",
            F.when(splits, F.concat("path", F.when(left, "0").otherwise("1"))).otherwise(F.col("path")).alias("path"),
            F.when(splits, 0).otherwise(F.col("turn") + 1).alias("turn"),
            F.when(splits & ~left, F.col("right")).otherwise(F.col("left")).alias("draws")))
    if not parts:
        return test.select(key, target).withColumn("prediction", F.lit(None).cast("double"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("key").agg(F.first("y").alias(target), F.avg("value").alias("prediction")).withColumnRenamed("key", key)
