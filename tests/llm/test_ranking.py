"""Ranked search against plain scoring of every document."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return Counter(TERM.findall((text or "").translate(CAPITALS)))


def plain(docs, items, k):
    counts = [terms(t) for _, t in docs]
    sizes = [c.total() for c in counts]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = set()
    for item, text in items:
        scores = []
        for (doc, _), c, size in zip(docs, counts, sizes):
            if size:
                m = 75 + 25 * size * n // length
                score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                            * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in terms(text).items() if t in c)
                scores += [(-score, doc)] if score > 0 else []
        out |= {(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)] + ["Été", "ÀB", "日本", "naïve", "x_y", "A1"]
    chance = 1 / np.arange(1, len(words) + 1)
    draw = lambda n: " ".join(rng.choice(words, n, p=chance / chance.sum()))
    docs = [draw(int(rng.integers(1, 120))) for _ in range(300)]
    docs += [None, "", " ,.; ", "same words here"] + ["same words here"] * 30 + ["w0 " * 700 + "w399", draw(30_000), "W1,w1;W1"]
    items = [draw(int(rng.integers(1, 25))) for _ in range(25)] + ["same words", "nowhere", "", None, "w0 w0 W0 été ÉTÉ 日本"]
    return list(enumerate(docs)), list(enumerate(items))


@pytest.mark.parametrize("folds, cells, k, block", [(3, 4, 20, 1 << 20), (1, 1, 3, 60), (2, 2, 500, 400)])
def test_equals_plain_scoring(spark, corpus, folds, cells, k, block):
    docs, items = corpus
    frame = spark.createDataFrame([(i, t, "q", 1.0) for i, t in docs], "doc_id bigint, text string, sketch string, score double")
    index = ranking.stored(ranking.build_index(frame.repartition(5), folds, cells), "index")
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id bigint, text string, n int")
    got = ranking.search(index, asked, k, folds, block)
    assert {(r.item_id, r["rank"], r.doc_id, r.score) for r in got.collect()} == plain(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


def test_long_texts_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(ranking, "_BLOCK", 7)
    text = "One, two; ünf-one " * 50 + "end"
    assert ranking.term_counts(text) == {t.encode(): n for t, n in terms(text).items()}


def test_bounds_are_never_below_scores(corpus):
    docs, items = corpus
    counts = [ranking.term_counts(t) for _, t in docs]
    df = Counter(t for c in counts for t in c)
    lookup = ranking.Lookup([(i, t) for i, t in items if t], df, len(docs), sum(c.total() for c in counts), 2)
    for (_, text), found in zip(docs, counts):
        bits, cells = ranking.sketch(found, 2, 1)
        n = np.asarray([found.total()])
        assert (lookup.bounds(np.frombuffer(cells, np.uint8), bits, n)[0] >= lookup.scores(text, int(n[0]))).all()


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, "a b"), (7, "a b"), (7, "c"), (8, "c d e f g")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a"), (1, "a"), (2, "zz")], "item_id bigint, text string")
    index = ranking.build_index(docs)
    rows = ranking.search(index, items).collect()
    assert sorted((r.item_id, r["rank"], str(r.doc_id)) for r in rows) == [(1, 1, "None"), (1, 2, "None"), (1, 3, "7"), (1, 4, "7")]
    assert ranking.search(index.limit(0), items).count() == 0 and ranking.search(index, items.limit(0)).count() == 0
