"""BPE and packing against the tokenizers library and plain loops."""
import hashlib
import os
import zlib

import numpy as np
import pytest

from cohortlens.llm import bpe, packing
from cohortlens.llm.queries import vocabulary_path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TEXTS = ["", None, "a b  c\n\n d \t x\x1c y\x85z　w  ", "I'm don't  it's   ok\r\n .foo !!bar;;'s 3.5,6 ,xЀy aЀ,",
         "<|endoftext|>a b<|endoftext|>  c", "日本語 ñ é 🎉🎉 ½²", "x" * 5000 + "  \n", "    ", "same text here", "same text here",
         "the quick brown fox jumps over the lazy dog. " * 200]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, "x", 1, "y") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, ids string, n int, part string")


def ids_of(library, text):
    return np.asarray(library.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


def test_round_trip_equals_the_library(docs, library):
    got = {r.doc_id: r for r in bpe.round_trip(docs, vocabulary_path()).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = ids_of(library, text)
        decoded = library.decode(ids.tolist(), skip_special_tokens=False)
        assert got[i].n_tokens == len(ids), text
        assert got[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_encoded_keeps_ids_and_text(docs, library):
    for row in bpe.encoded(docs, vocabulary_path()).collect():
        assert bytes(row.ids) == ids_of(library, TEXTS[row.doc_id]).tobytes()
        assert row.decoded == (TEXTS[row.doc_id] or "")


def test_stale_entries_and_long_words():
    merges = {(0 << 32 | 0): (0 << 32 | 1), (1 << 32 | 1): (1 << 32 | 2), (1 << 32 | 0): (2 << 32 | 3)}
    assert bpe.merge_word(b"aaaaa", [0] * 256, merges) == [2, 0]
    assert bpe.merge_word(b"aaa", [0] * 256, merges) == [3]
    assert bpe.merge_word(b"a", [0] * 256, merges) == [0]


def test_empty_table(docs):
    assert bpe.round_trip(docs.limit(0), vocabulary_path()).count() == 0
    assert packing.pack(docs.limit(0), vocabulary_path()).count() == 0


def check_pieces(rows, library, window=1024):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(TEXTS)))
    for doc, pieces in by_doc.items():
        ids = np.append(ids_of(library, TEXTS[doc]), 0).astype("<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start:at].tobytes())
        assert at == len(ids)
    fill = []
    for number in sorted(by_sequence):
        at = 0
        for r in sorted(by_sequence[number], key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        fill.append(at)
    assert sorted(by_sequence) == list(range(len(fill)))
    assert all(n == window for n in fill[:-1]) and 0 < fill[-1] <= window
    return by_sequence


@pytest.mark.parametrize("window,packet,queues", [(1024, 32, 4096), (64, 4, 4096), (16, 1, 2), (128, 32, 1)])
def test_pieces_cover_and_fill(docs, library, window, packet, queues):
    pieces = packing.pack(docs.repartition(3), vocabulary_path(), window=window, packet=packet, max_queues=queues).collect()
    check_pieces(pieces, library, window)


def test_given_mixture_is_met(docs, library):
    weights = {"": 1.0, "s0": 3.0}
    rows = packing.pack(docs, vocabulary_path(), weights, window=64, packet=4).collect()
    sequences = check_pieces(rows, library, 64)
    queue = {r.doc_id: r.queue for r in rows}
    # while both queues last, every window holds a quarter of the one and three quarters of the other
    first = {q: sum(r.length for r in sequences[0] if queue[r.doc_id] == q) for q in set(queue.values())}
    assert sorted(first.values())[-2:] == [16, 48]


def test_weights_of_small_sources_are_kept(docs, library):
    weights = {"": 1.0, "s0": 3.0}
    few = packing.pack(docs, vocabulary_path(), weights, window=64, packet=4, max_queues=1).collect()
    sequences = check_pieces(few, library, 64)
    sources = {r.doc_id: r.source or "" for r in docs.select("doc_id", "source").collect()}
    first = {s: sum(r.length for r in sequences[0] if sources[r.doc_id] == s) for s in weights}
    assert first == {"": 16, "s0": 48}
    queues = {}
    for r in few:
        queues.setdefault(sources[r.doc_id], set()).add(r.queue)
    assert all(len(queues[s]) == 1 for s in weights) and queues[""] != queues["s0"]


def test_deficits_against_a_plain_loop():
    rng = np.random.default_rng(7)
    totals = rng.integers(1, 3000, 5)
    mixture = packing.Mixture(totals, rng.random(5), 64, 4)
    earned, served, stream = np.zeros(5, dtype=object), np.zeros(5, dtype=int), []
    while served.sum() < totals.sum():
        for q in range(5):
            earned[q] += int(mixture.quanta[q])
            take = min(int(earned[q] // mixture.unit) * 4, int(totals[q] - served[q]))
            earned[q] -= earned[q] // mixture.unit * mixture.unit
            stream += [(q, served[q] + k) for k in range(take)]
            served[q] += take
    where = {token: place for place, token in enumerate(stream)}
    for q in range(5):
        for begin, size in ((0, int(totals[q])), (int(totals[q]) // 3, int(totals[q]) // 2)):
            starts, lengths, places = mixture.pieces(q, begin, size, 64)
            assert lengths.sum() == size
            for s, n, p in zip(starts, lengths, places):
                assert [where[(q, s + k)] for k in range(n)] == list(range(p, p + n))
                assert p // 64 == (p + n - 1) // 64
