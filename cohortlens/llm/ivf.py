"""Near-duplicate vectors by an inverted multi-index over a product of two codebooks.

Each half of a unit vector has a codebook of its own, and the pair of nearest
codewords is the vector's cell in the product grid. A vector visits cells in
multi-sequence order, by growing lower bound of the distance to anything in
them, until the bound passes what the sample showed to be needed for the target
recall. Cells are compared block by block, so that none of them has to fit one
task, and only counts and one link per vector and block leave a comparison.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored
from cohortlens.llm.components import components

COSINE = 0.95
#: Bound of the sample that codebooks and the stopping bound are fitted on.
SAMPLE_ROWS = 20_000
#: The product grid has about one cell for so many distinct vectors, and at most so many codewords a half.
ROWS_PER_CELL = 64
MAX_CODEWORDS = 1024
TARGET_RECALL = 0.995
#: The stopping bound is fitted on at most so many similar pairs of the sample; below FEW_PAIRS on copies in its directions too.
MAX_PAIRS = 50_000
FEW_PAIRS = 2_000
#: Vectors of one block of a cell.
BLOCK = 1024


def normalised(values: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """(place, unit vectors in double precision) of the vectors that can be linked with anything."""
    place, rows = [], []
    for at, value in enumerate(values):
        if value is None or not len(value) or any(v is None for v in value):
            continue
        x = np.asarray(value, dtype=np.float64)
        peak = np.abs(x).max()
        if not np.isfinite(peak) or peak == 0:
            continue
        x = x / peak
        place.append(at)
        rows.append(x / np.sqrt(x @ x))
    return np.asarray(place, dtype=np.int64), rows


def codebook(points: np.ndarray, size: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Centroids of Lloyd's rounds from distinct random points."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centers = points[rng.permutation(len(points))[:size]]
    for _ in range(rounds):
        near = _distances(points, centers).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(1)[:, None] - 2 * points @ centers.T + (centers ** 2).sum(1)[None, :], 0)


@dataclass
class MultiIndex:
    """Two codebooks and the squared bound at which a traversal may stop."""

    first: np.ndarray
    second: np.ndarray
    stop: float

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return x[:, :cut], x[:, cut:]

    def bounds(self, points: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Squared lower bound of the distance of each point to the region of each codeword.

        The region of another codeword lies beyond the plane halfway between it
        and the nearest one.
        """
        d = _distances(points, book)
        nearest = d.argmin(axis=1)
        apart = np.sqrt(_distances(book, book))[nearest]
        gap = (d - d[np.arange(len(d)), nearest][:, None]) / np.maximum(2 * apart, 1e-12)
        gap[np.arange(len(d)), nearest] = 0
        return np.maximum(gap, 0) ** 2

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return _distances(a, self.first).argmin(1) * len(self.second) + _distances(b, self.second).argmin(1)

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) in multi-sequence order for every cell within the stopping bound."""
        a, b = self.halves(x)
        left, right = self.bounds(a, self.first), self.bounds(b, self.second)
        order_a, order_b = left.argsort(axis=1, kind="stable"), right.argsort(axis=1, kind="stable")
        rows, cells = [], []
        for row in range(len(x)):
            u, v = left[row, order_a[row]], right[row, order_b[row]]
            queue, seen = [(u[0] + v[0], 0, 0)], {(0, 0)}
            while queue:
                bound, i, j = heapq.heappop(queue)
                if bound > self.stop:
                    break
                rows.append(row)
                cells.append(order_a[row, i] * len(self.second) + order_b[row, j])
                for following in ((i + 1, j), (i, j + 1)):
                    if following[0] < len(u) and following[1] < len(v) and following not in seen:
                        seen.add(following)
                        heapq.heappush(queue, (u[following[0]] + v[following[1]], *following))
        return np.asarray(rows, dtype=np.int64), np.asarray(cells, dtype=np.int64)


def similar_pairs(x: np.ndarray, places: np.ndarray, cosine: float, most: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A uniform draw of at most ``most`` pairs of one of ``places`` and any other row with a cosine of at least ``cosine``."""
    first, second, draw = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    for at in range(0, len(places), 256):
        part = places[at:at + 256]
        near = x[part] @ x.T >= cosine
        near[np.arange(len(part)), part] = False
        i, j = np.nonzero(near)
        first, second, draw = np.r_[first, part[i]], np.r_[second, j], np.r_[draw, rng.random(len(i))]
        if len(draw) > most:
            lowest = np.argpartition(draw, most)[:most]
            first, second, draw = first[lowest], second[lowest], draw[lowest]
    return first, second


def fit(x: np.ndarray, codewords: int, cosine: float = COSINE, target: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks from a sample, and the bound within which ``target`` of its similar pairs find each other.

    The bound is the largest one needed by the sample's own similar pairs, by
    copies at exactly the threshold in random directions and, where the sample has
    fewer than FEW_PAIRS pairs, by copies in the directions in which the sample and
    the neighbours in it vary. No bound above the distance of the threshold itself
    is ever needed, and a target of 1 takes that one.
    """
    cut = x.shape[1] // 2
    index = MultiIndex(codebook(x[:, :cut], codewords, 1), codebook(x[:, cut:], codewords, 2), 2 - 2 * cosine)
    if target >= 1:
        return index
    rng = np.random.default_rng(3)
    places = rng.permutation(len(x))[:2000]
    some = x[places]

    def toward(p, q, book):
        return index.bounds(p, book)[np.arange(len(p)), _distances(q, book).argmin(1)]

    def needed(left: np.ndarray, right: np.ndarray) -> float:
        needs = []
        for at in range(0, len(left), 2000):
            (a, b), (c, d) = index.halves(left[at:at + 2000]), index.halves(right[at:at + 2000])
            # either side of a pair may find the other
            needs.append(np.minimum(toward(a, c, index.first) + toward(b, d, index.second),
                                    toward(c, a, index.first) + toward(d, b, index.second)))
        return float(np.quantile(np.concatenate(needs), target, method="higher"))

    def copies(directions: np.ndarray) -> np.ndarray:
        across = directions - (directions * some).sum(1)[:, None] * some
        across /= np.maximum(np.sqrt((across ** 2).sum(1)), 1e-12)[:, None]
        return cosine * some + np.sqrt(1 - cosine ** 2) * across

    stops = [needed(some, copies(rng.normal(size=some.shape)))]
    i, j = similar_pairs(x, places, cosine, MAX_PAIRS, rng)
    if len(i):
        stops.append(needed(x[i], x[j]))
    if len(i) < FEW_PAIRS and len(x) > 1:
        stops.append(needed(some, copies(rng.normal(size=(len(some), len(some))) @ (some - some.mean(0)))))
        nearest = []
        for at in range(0, len(places), 256):
            dots = x[places[at:at + 256]] @ x.T
            dots[np.arange(len(dots)), places[at:at + 256]] = -2
            nearest.append(dots.argmax(1))
        stops.append(needed(some, copies(x[np.concatenate(nearest)] - some)))
    index.stop = float(min(max(stops) + 1e-12, 2 - 2 * cosine))
    return index


def _units(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit array<double>) of the linkable vectors; a vector of one component gets a zero beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, rows = normalised(batch.column(1).to_pylist())
            rows = [r if len(r) > 1 else np.r_[r, 0.0] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(place, pa.int64())), pa.array(rows, pa.list_(pa.float64()))], ["vec_id", "unit"])

    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
            .mapInArrow(run, "vec_id bigint, unit array<double>"))


def _placed(units: DataFrame, index: MultiIndex) -> DataFrame:
    """(vec_id, copies, unit, cell, home) of every cell a vector visits, its own included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.asarray(part.column(2).to_pylist(), dtype=np.float64)
                own = index.cells(x)
                rows, cells = index.visits(x)
                taken = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(taken), part.column(1).take(taken), part.column(2).take(taken),
                     pa.array(cells, pa.int64()), pa.array(own[rows], pa.int64())],
                    ["vec_id", "copies", "unit", "cell", "home"])

    return units.mapInArrow(run, "vec_id bigint, copies bigint, unit array<double>, cell bigint, home bigint")


def compared(visitors: tuple, residents: tuple, cell: int, index: MultiIndex, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(counts, links) between (ids, copies, units, homes) of a block of visitors and a block of residents of a cell.

    A pair that can meet in both its cells is taken in the one of the smaller
    number only; within a cell the smaller id is the visitor. ``links`` connects
    what the similar pairs of the block connect, with fewer rows than vectors.
    """
    ids, copies, x, homes = visitors
    others, other_copies, y, _ = residents
    near = np.zeros((len(x), len(y)), dtype=bool)
    for at in range(0, len(x), 1024):
        dots = x[at:at + 1024] @ y.T
        near[at:at + 1024] = dots >= cosine
        for i, j in zip(*np.nonzero(np.abs(dots - cosine) < 1e-12)):  # rounding of a block product must not decide
            near[at + i, j] = float((x[at + i] * y[j]).sum()) >= cosine
    a, b = index.halves(y)
    width = len(index.second)
    both = index.bounds(a, index.first)[:, homes // width] + index.bounds(b, index.second)[:, homes % width] <= index.stop
    away = homes[:, None] != cell
    near &= np.where(away, ~both.T | (homes[:, None] < cell), ids[:, None] < others[None, :])
    counts = np.concatenate([np.c_[ids, near @ other_copies], np.c_[others, near.T @ copies]])
    # a vector points to the smallest it is linked with, and the smallest of both sides to each other, until all agree
    label, other = ids.astype(np.int64).copy(), others.astype(np.int64).copy()
    top = np.iinfo(np.int64).max
    while True:
        down = np.minimum(other, np.where(near, label[:, None], top).min(axis=0, initial=top))
        up = np.minimum(label, np.where(near, down[None, :], top).min(axis=1, initial=top))
        if (down == other).all() and (up == label).all():
            break
        label, other = up, down
    links = np.concatenate([np.c_[ids, label], np.c_[others, other]])
    return counts[counts[:, 1] > 0], links[links[:, 0] != links[:, 1]]


def _linked(units: DataFrame, index: MultiIndex, cosine: float, block: int) -> DataFrame:
    """(kind, a, b): number of links b of a (kind 0), links of a with b (kind 1), block by block."""
    placed = stored(_placed(units, index), "vector-cells")
    resident = F.col("cell") == F.col("home")
    sizes = placed.groupBy("cell").agg(F.ceil(F.sum(resident.cast("int")) / block).cast("int").alias("rows"),
                                       F.ceil(F.count(F.lit(1)) / block).cast("int").alias("columns")).where("rows > 0")
    dealt = placed.join(stored(sizes, "vector-blocks"), "cell")
    # visitor block i meets resident block j: each goes to all blocks of the other kind
    visitors = (dealt.withColumn("i", F.pmod(F.xxhash64("vec_id"), F.col("columns")).cast("int"))
                .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("side", F.lit(0)))
    residents = (dealt.where(resident).withColumn("j", F.pmod(F.xxhash64("vec_id"), F.col("rows")).cast("int"))
                 .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("side", F.lit(1)))
    names = ["cell", "i", "j", "side", "vec_id", "copies", "unit", "home"]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for side in (0, 1):
            part = rows[rows["side"] == side]
            x = np.stack(part["unit"].to_numpy()) if len(part) else np.empty((0, index.first.shape[1] + index.second.shape[1]))
            sides.append((part["vec_id"].to_numpy(), part["copies"].to_numpy(), x, part["home"].to_numpy()))
        counts, links = compared(sides[0], sides[1], int(key[0]), index, cosine)
        both = np.concatenate([np.c_[np.zeros(len(counts)), counts], np.c_[np.ones(len(links)), links]]).astype(np.int64)
        return pd.DataFrame(both, columns=["kind", "a", "b"])

    return (visitors.select(names).unionByName(residents.select(names)).groupBy("cell", "i", "j")
            .applyInPandas(run, "kind bigint, a bigint, b bigint"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, target: float = TARGET_RECALL,
                 rows_per_cell: int = ROWS_PER_CELL, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    Two vectors are linked if the cosine in double precision is at least
    ``cosine``; component_id is the smallest vec_id that links lead to. Equal
    vectors are looked up once and counted as often as they occur. Null, empty
    and zero vectors and those with null or non-finite components are linked with
    nothing, and vectors of different length are never linked. vec_id must be
    unique; other columns are ignored. An empty table gives an empty result.
    """
    units = _units(vectors).select("vec_id", "unit", F.xxhash64("unit").alias("h1"), F.xxhash64(F.lit("2"), "unit").alias("h2"))
    units = stored(units, "vector-units")
    classes = units.groupBy("h1", "h2").agg(F.min("vec_id").alias("head"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "vector-classes")
    heads = units.join(classes.select(F.col("head").alias("vec_id"), "copies"), "vec_id").select("vec_id", "copies", "unit")
    heads = stored(heads, "vector-heads")
    found = None
    for dimension, count in sorted((r[0], r[1]) for r in heads.groupBy(F.size("unit")).count().collect()):
        alike = heads.where(F.size("unit") == dimension)
        draw = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
        sample = alike.where(draw < min(1.0, SAMPLE_ROWS / count)).orderBy("vec_id").select("unit").collect() if count > 1 else []
        if len(sample) < 2:
            sample = alike.orderBy("vec_id").limit(2).select("unit").collect()
        codewords = min(max(int(np.ceil(np.sqrt(count / rows_per_cell))), 1), MAX_CODEWORDS)
        index = fit(np.asarray([r[0] for r in sample], dtype=np.float64), codewords, cosine, target)
        part = _linked(alike, index, cosine, block)
        found = part if found is None else found.unionByName(part)
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"))
    if found is None:
        return base.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "vector-links")
    counts = stored(found.where("kind = 0").groupBy(F.col("a").alias("head")).agg(F.sum("b").alias("n")), "vector-counts")
    joined = components(found.where("kind = 1").select("a", "b")).select(F.col("id").alias("head"), "component_id")
    of_head = stored(classes.join(counts, "head", "left").join(joined, "head", "left")
                     .select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                             F.coalesce("component_id", "head").alias("component_id")), "vector-results")
    linked = units.select("vec_id", "h1", "h2").join(of_head, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    return base.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"))
