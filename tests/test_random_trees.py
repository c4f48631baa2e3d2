import hashlib
import math

import numpy as np
import pytest

from cohortlens.operators import random_trees
from cohortlens.operators.random_trees import random_split_trees

P = 2 ** 31 - 1


def drawn(*keys):
    return int(hashlib.md5(":".join(map(str, keys)).encode()).hexdigest()[:13], 16) / 2 ** 52


def by_hand(train, test, trees, leaf, seed=7):
    """Plain recursion, row by row, fed the same draws."""
    def grow(rows, path, bag):
        ys, xs = [y for _, _, y in rows], [x for _, x, _ in rows]
        if len(rows) <= leaf or len(set(ys)) == 1 or all(x == xs[0] for x in xs):
            return sum(ys) / len(ys) if ys else None
        n = 0
        while True:
            i = math.floor(drawn(seed, bag, path, n, "feature") * len(xs[0]))
            a, b = 1 + math.floor(drawn(seed, bag, path, n, "a") * (P - 1)), math.floor(drawn(seed, bag, path, n, "b") * P)
            order = sorted(rows, key=lambda r: ((a * math.floor(drawn(seed, r[0], bag, "row") * P) + b) % P, str(r[0])))
            at = (order[0][1][i] + order[-1][1][i]) / 2
            left, right = [r for r in rows if r[1][i] <= at], [r for r in rows if r[1][i] > at]
            if left and right:
                return i, at, grow(left, path + "0", bag), grow(right, path + "1", bag)
            n += 1

    def ask(node, x):
        while isinstance(node, tuple):
            i, at, left, right = node
            node = left if x[i] is not None and x[i] <= at else right
        return node

    grown = [grow([r for r in train if drawn(seed, r[0], bag) < 0.6], "", bag) for bag in range(trees)]
    out = {}
    for k, x, _ in test:
        values = [v for v in (ask(tree, x) for tree in grown) if v is not None]
        out[k] = sum(values) / len(values) if values else None
    return out


def table(n=160):
    rng = np.random.default_rng(5)
    # the second feature is the same for most rows, and rows come twice
    rows = [(i, [float(rng.normal()), float(rng.random() < 0.04), float(rng.integers(0, 3))], float(rng.normal())) for i in range(n)]
    return rows + [(n + i, x, y) for i, x, y in rows[:30]]


SCHEMA = "id long, features array<double>, target double"


@pytest.mark.parametrize("local", [0, 60, 1_000_000])
def test_equals_plain_recursion(spark, local):
    rows = table()
    asked = [*rows[:50], (1000, [None, 0.0, 1.0], None), (1001, [math.nan, math.inf, -math.inf], 1.0)]
    train, test = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(asked, SCHEMA)
    found = {r["id"]: r["prediction"] for r in random_split_trees(train, test, "id", 2, 20, local_rows=local).collect()}
    assert found == pytest.approx(by_hand(rows, asked, 2, 20))


def test_odd_rows(spark):
    rows = table(20)
    bad = [(900, [1.0, None, 1.0], 1.0), (901, [1.0, 1.0, 1.0], None), (902, [math.inf, 1.0, 1.0], 5.0), (903, None, 1.0)]
    test = spark.createDataFrame(rows, SCHEMA)
    found = {r["id"]: r["prediction"] for r in random_split_trees(spark.createDataFrame([*rows, *bad], SCHEMA), test, "id", 2, 5).collect()}
    assert found == pytest.approx(by_hand(rows, rows, 2, 5))
    nothing = random_split_trees(test.limit(0), test, "id", 2, 5).collect()
    assert len(nothing) == len(rows) and {r["prediction"] for r in nothing} == {None}
    assert random_split_trees(test, test.limit(0), "id", 2, 5).count() == 0


def test_middle_keeps_both_sides():
    for a, b in ((5e-324, 1e-323), (1e308, 1.7e308), (-1e308, -1.7e308), (1.0, math.nextafter(1.0, 2))):
        assert min(a, b) <= random_trees._middle(a, b) < max(a, b)
