"""Exact duplicates against a plain dictionary, also with fingerprints that collide."""
import hashlib

import numpy as np
import pytest

from cohortlens.llm import exact

TEXTS = ["", None, "", "abc", "abd", "abc", "x" * 1000, "x" * 1000, "x" * 999 + "y", "é", "é", "  abc", "ABC"] + ["hot"] * 40


def test_fingerprints_compose():
    mark = exact.Fingerprint(chunk_bytes=64)
    data = np.random.default_rng(1).integers(0, 256, 1000, dtype=np.uint8).tobytes()
    whole = mark.of(data)
    left, right = mark.of(data[:333]), mark.of(data[333:])
    assert whole == [exact.combine(a, b, 667, base, prime)
                     for a, b, base, prime in zip(left, right, exact.BASES, exact.PRIMES)]
    plain = 0
    for byte in data:
        plain = (plain * exact.BASES[0] + byte) % exact.PRIMES[0]
    assert whole[0] == plain


@pytest.mark.parametrize("primes,chunk", [(exact.PRIMES, 1 << 16), ((2, 3), 7)])
def test_groups(spark, primes, chunk):
    rows = [(i, t, "s", 5) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, keep_id string, n int").repartition(3)
    got = exact.equal_texts(docs, primes, chunk, members_per_salt=8).collect()
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(t or "", []).append(i)
    want = {(i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert {tuple(r) for r in got} == want and len(got) == len(TEXTS)


def test_chunks_hashed_apart_give_the_fingerprint_of_the_whole(spark):
    rng = np.random.default_rng(2)
    texts = ["", None, "short", "é" * 200, "".join(map(chr, rng.integers(32, 900, 5000))), "z" * (1 << 20), "z" * 64, "z" * 65]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in exact.fingerprints(docs, chunk_bytes=64).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        data = (text or "").encode()
        plain = [0, 0]
        for byte in data:
            plain = [(h * b + byte) % p for h, b, p in zip(plain, exact.BASES, exact.PRIMES)]
        assert (got[i].n_bytes, got[i].fp) == (len(data), plain[0] << 31 | plain[1])
        assert got[i].text_sha256 == hashlib.sha256(data).hexdigest()


def test_empty_table(spark):
    assert exact.equal_texts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
