"""Exact nearest neighbours over pivot partitions.

Train rows belong to their nearest pivot; a partition's count and its inner and
outer radius are kept. By the triangle inequality a partition can hold no row
nearer to a test row than the distance to its pivot allows. A test row first
visits the partitions around it that hold k rows together. Its k-th distance
there is its limit. Partitions that lie together form groups of about a block of
rows, and the row then visits the groups that hold a partition whose bound does
not exceed the limit, so it is copied once a group, however many it reaches.

Squared distances are worked out as one matrix product with a bound on its
rounding. Only pairs that the bound leaves in doubt are compared by direct
differences, whose results are the ones that count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from cohortlens.operators.passes import matrix
from cohortlens.session import checkpointed

BLOCK_ROWS = 20_000
#: The most pivots; every task holds them.
MAX_PIVOTS = 2048
#: Rows whose distances to all pivots a task holds at once, and visits it writes at once.
PLAN_ROWS = 1024
VISIT_ROWS = 8192
_CELLS = 500_000
#: Test and train rows of one matrix product, and pairs compared directly at a time.
PRODUCT_ROWS = 1024
PRODUCT_COLUMNS = 2048
PAIR_ROWS = 8192
#: Rounding of a distance, as a share of it: bounds are widened by that much.
_SLACK = 1e-9


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Direct differences at any size: the expanded square loses what large means cancel."""
    out = np.empty((len(x), len(y)))
    step = max(1, _CELLS // max(1, y.size))
    for at in range(0, len(x), step):
        wide = max(1, _CELLS // max(1, step * x.shape[1]))
        for j in range(0, len(y), wide):
            out[at:at + step, j:j + wide] = ((x[at:at + step, None, :] - y[None, j:j + wide, :]) ** 2).sum(axis=2)
    return np.sqrt(out)


def _rounding(dims: int, sizes: np.ndarray, kind: type) -> np.ndarray:
    """Bound on the error of squared distances by a product, and of direct ones, for vectors of ``sizes`` together.

    A sum of n products is off by n roundings of the product of lengths at most; the
    factor covers centring, norms and the direct sum. The rest is for what underflows.
    """
    return 8 * (dims + 8) * np.finfo(kind).eps * sizes ** 2 + 8 * (dims + 8) * float(np.finfo(kind).tiny)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def bounds(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances, from one product; both are the distances where it overflows."""
    with np.errstate(over="ignore", invalid="ignore"):
        centre = y.mean(axis=0)
        x0, y0 = x - centre, y - centre
        a, b = _lengths(x0), _lengths(y0)
        error = _rounding(x.shape[1], a[:, None] + b, float)
        squares = (a ** 2)[:, None] + b ** 2 - 2 * (x0 @ y0.T)
        if not (np.isfinite(squares).all() and np.isfinite(error).all()):
            far = distances(x, y)
            return far, far
        return np.sqrt(np.maximum(squares - error, 0)), np.sqrt(np.maximum(squares, 0) + error)


def _first_of_each(rows: np.ndarray, columns: np.ndarray, far: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs sorted by row, distance and column, ``n`` of each row at most."""
    order = np.lexsort((columns, far, rows))
    rows = rows[order]
    begins = np.r_[0, np.flatnonzero(np.diff(rows)) + 1] if len(rows) else np.zeros(0, dtype=int)
    place = np.arange(len(rows)) - np.repeat(begins, np.diff(np.r_[begins, len(rows)]))
    return rows[place < n], columns[order][place < n], far[order][place < n]


def closest_pairs(x: np.ndarray, y: np.ndarray, n: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance): the ``n`` nearest rows within the row's limit; ties go to the first row of y."""
    def pairs(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for at in range(0, len(rows), PAIR_ROWS):
            some = slice(at, at + PAIR_ROWS)
            out[some] = ((x[rows[some]] - y[columns[some]]) ** 2).sum(axis=1)
        return np.sqrt(out)

    dims, found = x.shape[1], []
    with np.errstate(over="ignore", invalid="ignore"):
        centre = y.mean(axis=0)
        x0, y0 = x - centre, y - centre
        a, b = _lengths(x0), _lengths(y0)
        sizes = a + b.max()
        exact = not np.isfinite(sizes ** 2).all()
    if exact:  # what is not a number, or overflows, is told by direct differences alone
        for at in range(0, len(x), 256):
            far = distances(x[at:at + 256], y)
            best = np.argsort(far, axis=1, kind="stable")[:, :n]
            found.append((np.repeat(np.arange(at, at + len(far)), n), best.ravel(), np.take_along_axis(far, best, axis=1).ravel()))
    else:
        # single precision where its rounding is small beside the limits and nothing leaves its range
        single = 1e-10 < sizes.max() < 1e15 and (_rounding(dims, sizes, np.float32) <= 0.01 * limit ** 2).mean() > 0.5
        kind = np.float32 if single else float
        error = _rounding(dims, sizes, kind)
        left, right = np.c_[-2 * x0, np.ones(len(x))].astype(kind), np.c_[y0, b ** 2].astype(kind)
        for at in range(0, len(x), PRODUCT_ROWS):
            own = slice(at, at + PRODUCT_ROWS)
            off, wide = (a ** 2)[own], error[own]
            most = limit[own] ** 2 * (1 + 1e-14)
            rows, columns, far = np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
            for j in range(0, len(y), PRODUCT_COLUMNS):
                product = left[own] @ right[j:j + PRODUCT_COLUMNS].T  # squared distance less that of x from the centre
                if not j and n <= product.shape[1]:
                    most = np.minimum(most, np.partition(product, n - 1, axis=1)[:, n - 1] + off + wide)
                reach = np.nextafter((most - off + wide).astype(kind), kind(np.inf))
                row, column = np.divmod(np.flatnonzero((product <= reach[:, None]).ravel()), product.shape[1])
                if len(row):
                    rows, columns, far = _first_of_each(
                        np.r_[rows, row], np.r_[columns, column + j], np.r_[far, pairs(row + at, column + j)], n)
                    held = np.bincount(rows, minlength=len(most))
                    last = np.cumsum(held)[held == n] - 1
                    most[held == n] = np.minimum(most[held == n], far[last] ** 2 * (1 + 1e-14))
            found.append((rows + at, columns, far))
    return tuple(np.concatenate(part) for part in zip(*found))


@dataclass
class Pivots:
    """Per pivot its place, the rows of its partition, and their inner and outer radius."""

    places: np.ndarray
    count: np.ndarray
    inner: np.ndarray
    outer: np.ndarray

    def first(self, x: np.ndarray, k: int) -> np.ndarray:
        """Mask: the nearest partitions that hold ``k`` rows together."""
        order = np.argsort(bounds(x, self.places)[0], axis=1, kind="stable")
        before = np.cumsum(self.count[order], axis=1) - self.count[order]
        mask = np.zeros(order.shape, dtype=bool)
        np.put_along_axis(mask, order, before < k, axis=1)
        return mask & (self.count > 0)

    def reachable(self, x: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Mask: partitions that may hold a row within the limit."""
        least, most = bounds(x, self.places)
        nearest = np.maximum(least - self.outer, self.inner - most)
        widest = most + self.outer + np.where(np.isfinite(limit), limit, 0)[:, None]
        return (self.count > 0) & (nearest <= limit[:, None] + _SLACK * widest)

    def groups(self, rows: int) -> np.ndarray:
        """The group of each partition: neighbouring ones of about ``rows`` rows together, by halving along the widest axis."""
        out, found = np.zeros(len(self.count), dtype=np.int64), 0
        open_parts = [(np.arange(len(self.count)), math.ceil(self.count.sum() / rows))]
        while open_parts:
            part, pieces = open_parts.pop()
            if pieces <= 1 or len(part) <= 1:
                out[part], found = found, found + 1
                continue
            part = part[np.argsort(self.places[part, np.ptp(self.places[part], axis=0).argmax()], kind="stable")]
            half = pieces // 2
            held = np.cumsum(self.count[part])
            cut = min(max(1, int(np.searchsorted(held, held[-1] * half / pieces))), len(part) - 1)
            open_parts += [(part[:cut], half), (part[cut:], pieces - half)]
        return out


def partitioned(train: DataFrame, key: str, pivots: int | None = None, seed: int = 11) -> tuple[DataFrame, Pivots]:
    """Train rows (key, features, label, pivot), and the pivots.

    Pivots are train rows drawn by the hash of their key; equal rows may be drawn, then one of them stays empty.
    """
    train = train.select(key, "features", F.col("label").cast("double").alias("label"))
    wanted = pivots or min(MAX_PIVOTS, math.ceil(math.sqrt(train.count() or 1)))
    drawn = train.select("features", F.xxhash64(F.lit(seed), F.col(key)).alias("draw"), key).orderBy("draw", key).limit(wanted)
    centres = np.asarray([r["features"] for r in drawn.collect()], dtype=float)
    if not len(centres):
        return train.withColumn("pivot", F.lit(0)), Pivots(np.zeros((0, 0)), *[np.zeros(0)] * 3)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                for at in range(0, len(batch), PLAN_ROWS):
                    some = batch.iloc[at:at + PLAN_ROWS]
                    x = matrix(some["features"])
                    home = bounds(x, centres)[0].argmin(axis=1)
                    yield some.assign(pivot=home.astype(np.int32), spread=np.sqrt(((x - centres[home]) ** 2).sum(axis=1)))

    kind = train.schema[key].dataType.simpleString()
    rows = checkpointed(train.mapInPandas(assign, f"{key} {kind}, features array<double>, label double, pivot int, spread double"))
    count, inner, outer = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres)), np.zeros(len(centres))
    for r in rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("spread").alias("a"), F.max("spread").alias("b")).collect():
        count[r["pivot"]], inner[r["pivot"]], outer[r["pivot"]] = r["n"], r["a"], r["b"]
    return rows.drop("spread"), Pivots(centres, count, inner, outer)


def visits(test: DataFrame, pivots: Pivots, key: str, k: int, limited: bool, groups: np.ndarray | None = None) -> DataFrame:
    """(key, features, pivot): which partitions each test row visits, first or, given its ``limit``, after that.

    With ``groups`` of the partitions, ``pivot`` is the number of a group that holds any partition within the limit,
    those of the first visits among them, and the limit comes along.
    """
    limit = ["limit"] if groups is not None else []
    members = [np.flatnonzero(groups == g) for g in range(groups.max(initial=-1) + 1)] if limit else []

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) and len(pivots.count):
                for at in range(0, len(batch), PLAN_ROWS):
                    some = batch.iloc[at:at + PLAN_ROWS]
                    x = matrix(some["features"])
                    mask = pivots.reachable(x, some["limit"].to_numpy(dtype=float)) if limited else pivots.first(x, k)
                    if limited:
                        mask = (np.stack([mask[:, own].any(axis=1) for own in members], axis=1) if limit
                                else mask & ~pivots.first(x, k))
                    given = {c: some[c].to_numpy() for c in (key, "features", *limit)}
                    rows, visited = np.nonzero(mask)
                    # a row may visit all pivots: its features are copied for few visits at a time
                    for begin in range(0, len(rows), VISIT_ROWS):
                        row, pivot = rows[begin:begin + VISIT_ROWS], visited[begin:begin + VISIT_ROWS]
                        yield pd.DataFrame({c: v[row] for c, v in given.items()} | {"pivot": pivot.astype(np.int32)})

    kind = test.schema[key].dataType.simpleString()
    return test.mapInPandas(plan, f"{key} {kind}, features array<double>, {'limit double, ' * len(limit)}pivot int")


def _compared(asked: DataFrame, rows: DataFrame, held: np.ndarray, key: str, k: int, block_rows: int) -> DataFrame:
    """(key, neighbour, label, distance): the ``k`` nearest of each visit, block by block of both sides.

    ``held`` has the train rows of each partition; a ``limit`` of the visits drops what lies beyond.
    """
    spark = asked.sparkSession
    kind = asked.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, neighbour {kind}, label double, distance double"
    many = {r["pivot"]: r["count"] for r in asked.groupBy("pivot").count().collect()}
    sizes = [(p, math.ceil(n / block_rows), math.ceil(int(held[p]) / block_rows)) for p, n in many.items()]
    # one row per visited pivot
    blocks = F.broadcast(spark.createDataFrame(sizes, "pivot int, test_blocks int, train_blocks int"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Rows of a pivot cut into blocks, each copied to all blocks of the other side."""
        own_block = F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_block")
        copies = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return df.join(blocks, "pivot").select(*df.columns, own_block, copies)

    def closest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({key: [], "neighbour": [], "label": [], "distance": []})
        b = b.sort_values(key, ignore_index=True)
        limit = a["limit"].to_numpy(dtype=float) if "limit" in a else np.full(len(a), np.inf)
        row, best, far = closest_pairs(matrix(a["features"]), matrix(b["features"]), min(k, len(b)), limit)
        return pd.DataFrame({key: a[key].to_numpy()[row], "neighbour": b[key].to_numpy()[best],
                             "label": b["label"].to_numpy(dtype=float)[best], "distance": far})

    groups = ["pivot", "test_block", "train_block"]
    return (dealt(asked, "test", "train").groupBy(*groups).cogroup(dealt(rows, "train", "test").groupBy(*groups))
            .applyInPandas(closest, schema))


def nearest(train: DataFrame, test: DataFrame, key: str, k: int, block_rows: int = BLOCK_ROWS,
            pivots: int | None = None) -> DataFrame:
    """The ``k`` nearest train rows of each test row: (key, neighbour, label, distance, rank).

    Euclidean distance of ``features``, equal to comparing all rows; ties go to
    the smaller train key. Keys are unique on each side. Fewer than ``k`` train
    rows are all neighbours. A pivot's rows are cut into blocks of about
    ``block_rows``, so a hot partition is compared by many tasks.
    """
    test = test.select(key, F.col("features").cast("array<double>").alias("features"))
    rows, found = partitioned(train, key, pivots)
    best = Window.partitionBy(key).orderBy("distance", "neighbour")

    def kept(near: DataFrame) -> DataFrame:  # at most k rows per visited block and test row reach this window
        return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = _compared(checkpointed(visits(test, found, key, k, False)), rows, found.count, key, k, block_rows)
    near = checkpointed(kept(first).withColumn("limit", F.max("distance").over(Window.partitionBy(key))))
    # a row without a key or with a limit that is no number goes no further
    ends = F.col(key).isNull() | F.col("limit").isNull() | F.isnan("limit")
    groups = found.groups(block_rows)
    held = np.bincount(groups, weights=found.count, minlength=1)
    limits = near.where(~ends & (F.col("rank") == 1)).select(key, "limit")
    again = checkpointed(visits(test.join(limits, key), found, key, k, True, groups))
    of_group = rows.withColumn("pivot", F.get(F.lit([int(g) for g in groups] or [0]), F.col("pivot")))
    # the groups around a row hold its first partitions too
    more = _compared(again, of_group, held, key, k, block_rows)
    return kept(more.unionByName(near.where(ends).drop("rank", "limit")))
