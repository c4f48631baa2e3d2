"""Word shingles of whole texts as 64-bit hashes, worked out for many texts at a time."""

from __future__ import annotations

import numpy as np

WORDS = 5
_GOLDEN, _M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    if len(_POWERS[0]) < count:
        out = np.full(max(count, 1024), _BASE, dtype=np.uint64)
        out[0] = 1
        _POWERS[0] = np.multiply.accumulate(out)
    return _POWERS[0][:count]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every run of bytes without ASCII white space."""
    b = np.frombuffer(data, dtype=np.uint8)
    word = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    sizes = ends - starts
    inside = np.flatnonzero(word)
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    place = np.arange(len(inside)) - np.repeat(first, sizes)
    terms = (b[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[place]
    return mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64) * _GOLDEN), starts


def shingle_hashes(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Hashes of the shingles of each text, in order and with repeats.

    A text of fewer words than a shingle has one shingle of all its words; a
    text without words has none.
    """
    parts = [t.encode("utf-8", "replace") for t in texts]
    bounds = np.r_[0, np.cumsum([len(p) + 1 for p in parts])]
    hashes, starts = word_hashes(b"\n".join(parts))
    of_text = np.searchsorted(starts, bounds)
    rolled = np.zeros(max(len(hashes) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        rolled = mix(rolled * _GOLDEN + hashes[k:k + len(rolled)] + np.uint64(k + 1))
    out = []
    for low, high in zip(of_text[:-1], of_text[1:]):
        if high - low >= words:
            out.append(rolled[low:high - words + 1])
        elif high > low:
            one = np.zeros(1, dtype=np.uint64)
            for k in range(low, high):
                one = mix(one * _GOLDEN + hashes[k] + np.uint64(k - low + 1))
            out.append(one)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def slices(texts: list[str | None], chars: int = 1 << 20):
    """(first, texts) pieces of a batch of about ``chars`` characters, nulls read as empty."""
    at, held, size = 0, [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= chars:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held
