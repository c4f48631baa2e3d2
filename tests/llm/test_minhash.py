"""Near duplicates against brute force over all pairs of small tables."""
import random

import numpy as np
import pytest

from cohortlens.llm import minhash
from cohortlens.llm.components import components
from cohortlens.llm.shingles import shingle_hashes


def plain_sets(texts):
    out = []
    for t in texts:
        words = (t or "").split()
        out.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set()))
    return out


def classes_of(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def similar_pairs(texts, threshold=0.8):
    sets = plain_sets(texts)
    return [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
            and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]


def family(rng, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def corpus():
    rng = random.Random(5)
    new = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = ["", None, "one two", "one two", "one  two", "a b c d e", "   ", "line\n" * 50 + "x y z"]
    texts += family(rng, new(60), 60, [1, 2])        # variants linked through the base or not at all
    texts += [" ".join(new(60))] + family(rng, new(40), 40, [0, 1, 1, 2, 3])
    texts += family(rng, new(300), 30, [1, 5, 12])
    step = new(120)
    for _ in range(25):                              # a chain: each text is similar to the one before only
        step = step[6:] + new(6)
        texts.append(" ".join(step))
    texts += [" ".join(new(50)) for _ in range(40)] + ["hot copy of five words and more"] * 60
    rng.shuffle(texts)
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shingles string, n int").repartition(3)
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    want = classes_of(len(texts), similar_pairs(texts))
    assert len(got) == len(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    assert all(r.kept == (r.doc_id == r.class_id) and r.class_size == want.count(r.class_id) for r in got.values())
    kept = {r.doc_id for r in minhash.keep_one(docs).collect()}
    assert kept == set(want)


def test_difference_groups_lose_nothing(spark):
    """All members of one bucket: classes come from centres and differences alone."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(44)]
    texts = family(rng, base, 60, [1, 1, 2]) + [" ".join(base)]
    for v in range(4):  # families within the family, far from the base but close to each other
        sub = list(base)
        for k in range(0, 40, 8):
            sub[k + v] = f"sub{v}{k}"
        texts += [" ".join(sub)] + family(rng, sub, 8, [1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    one = spark.createDataFrame([(i, [7]) for i in range(len(texts))], "doc_id bigint, bands array<bigint>")
    links = minhash.near_links(docs, one).collect()
    sets = plain_sets(texts)
    for r in links:
        assert r.similarity == pytest.approx(len(sets[r.a] & sets[r.b]) / len(sets[r.a] | sets[r.b]))
        assert r.similarity >= 0.8
    pairs = [p for p in similar_pairs(texts) if sets[p[0]] != sets[p[1]]]
    got = classes_of(len(texts), [(r.a, r.b) for r in links])
    assert got == classes_of(len(texts), pairs + [p for p in similar_pairs(texts) if sets[p[0]] == sets[p[1]]])


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    b = np.r_[a[:300], rng.integers(0, 1 << 63, 50).astype(np.uint64)]
    wa, wb = rng.integers(1, 9, 400).astype(float), np.r_[rng.integers(1, 9, 350)].astype(float)
    got = minhash.prob_minhash([a, b], [wa, wb], 4096)
    x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    keys = set(x) | set(y)
    want = sum(1 / sum(max(x.get(k, 0) / x[c], y.get(k, 0) / y[c]) for k in keys) for c in set(x) & set(y))
    assert (got[0] == got[1]).mean() == pytest.approx(want, abs=0.03)
    again = minhash.prob_minhash([a], [wa * 7], 4096)  # only proportions count
    assert (again[0] == got[0]).all()


def test_passages_repeated_in_one_copy(spark):
    """Plain similarity 0.8 or 1; one text of a pair repeats a part of its words many times."""
    rng = random.Random(12)
    texts = []
    for i in range(60):
        words = [f"p{rng.randrange(10 ** 6)}" for _ in range(100)]
        ring = words[40:70] * 100
        texts.append(" ".join(words + ring))
        texts.append(" ".join((words + words[40:70] * 2) if i % 2 else (words[14:] + words[40:70] * 2)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    sets = plain_sets(texts)
    for a in range(0, len(texts), 2):
        assert len(sets[a] & sets[a + 1]) / len(sets[a] | sets[a + 1]) >= 0.8
        assert got[a + 1].class_id == a
        assert (got[a + 1].text_class == a) == (sets[a] == sets[a + 1])


def test_shingles():
    one, two, three, none, same = shingle_hashes(["a b c d e f", "x a b c d e", "a b", " \n", "a  b"])
    assert len(one) == 2 and len(two) == 2 and two[1] == one[0] and len(three) == 1 and not len(none)
    assert same[0] == three[0]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (5, 5)] + [(100, 100 + i) for i in range(1, 50)]
    edges += [(i, i + 1) for i in range(300, 340)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 1 for i in (1, 2, 3, 7, 8, 9)) and got[21] == 20 and 5 not in got
    assert all(got[i] == 100 for i in range(100, 150)) and all(got[i] == 300 for i in range(300, 341))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.near_duplicates(docs).count() == 0
    assert minhash.keep_one(docs).count() == 0
