"""Repeated strings against brute force, and suffix arrays against sorting."""
import hashlib
import random
import sys

import numpy as np
import pytest

from cohortlens.llm import suffix


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    body = rng.integers(1, [3, 5, 200][seed % 3], rng.integers(0, 400)).astype(np.int32)
    if seed > 2:
        body = np.r_[body, body[:100], np.full(50, 2, np.int32), body].astype(np.int32)
    s = np.r_[body, 0].astype(np.int32)
    sa = suffix.suffix_array(s)
    text = s.tolist()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    got = suffix.common_prefixes(s, sa, 30)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()):
        n = 0
        while n < 30 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
            n += 1
        assert got[b] == n


@pytest.mark.parametrize("symbols", [3, 250, 5000])
def test_suffix_array_takes_no_step_per_symbol(symbols):
    rng = np.random.default_rng(symbols)
    core, parts = rng.integers(2, symbols, 400), []
    for _ in range(60):  # near copies, as the segments of a core are
        near = core.copy()
        near[rng.integers(0, 400)] = 1
        parts += [near, [1]]
    s = np.concatenate([*parts, [0]]).astype(np.int32)
    lines = 0

    def count(frame, event, arg):
        nonlocal lines
        lines += event == "line"
        return count if frame.f_code.co_filename == suffix.__file__ else None

    sys.settrace(count)
    try:
        sa = suffix.suffix_array(s)
    finally:
        sys.settrace(None)
    text = s.tolist()
    assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    assert lines < len(s)


def test_suffix_array_of_long_runs():
    for body in (np.full(700, 7), np.tile([3, 5], 300), np.r_[np.full(300, 2), np.full(300, 9), np.full(300, 2)], np.arange(1, 6000)):
        s = np.r_[body, 0].astype(np.int32)
        text = s.tolist()
        assert suffix.suffix_array(s).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(texts, length):
    seen = {}
    data = [(t or "").encode() for t in texts]
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]] = seen.get(d[p:p + length], 0) + 1
    out = []
    for i, d in enumerate(data):
        gone = np.zeros(len(d) + 1, dtype=bool)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = True
        rest = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), len(d) - len(rest), len(suffix.runs(gone)), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("crowd,shard", [(1024, 1 << 20), (2, 500)])
def test_repeats_equal_brute_force(spark, crowd, shard):
    rng = random.Random(3)
    new = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage, base = new(70), new(300)
    texts = ["", None, "short", base, base, "x" * 90, new(40) + "x" * 70 + new(10), new(39), "hot passage " * 9]
    for k in range(25):
        near = list(base)
        near[rng.randrange(300)] = "#"
        texts += ["".join(near), new(k) + passage[k % 7:] + new(30), new(50)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, core int").repartition(3)
    got = suffix.remove_repeats(docs, 40, 16, 8, shard, crowd).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute(texts, 40)


def test_empty_table(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
