"""Removal of long repeated byte strings by suffix arrays over shards of shared content.

Every string of LENGTH bytes chooses an anchor, the place of the smallest hash of
GRAM bytes among its first WINDOW places, so equal strings choose alike. The
strings of a text with one anchor form a segment; all of them contain the same
core of LENGTH - WINDOW + 1 bytes from the anchor on. Segments whose core occurs
once hold no repeated string. Segments that occur as a whole more than once
repeat in full. All others meet the different segments of the same core in a
shard, whose suffix array is built by induced sorting; permuted common prefixes
then tell the repeated strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored, text_or_empty

LENGTH = 400
WINDOW = 256
GRAM = 16
#: Bytes of the segments that share a suffix array; a core's segments are never separated.
SHARD_BYTES = 1 << 20
#: Cores with more different segments are refined to the hashes of their single strings.
MAX_SEGMENTS = 1024
#: From this symbol on suffixes are not passed symbol by symbol.
MANY_SYMBOLS = 1 << 12
_PLACE_BITS = np.uint64(27)
_BLOCK = 1 << 22
_P = np.uint64(0x9E3779B97F4A7C15)


def _gram_keys(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` (a power of two) bytes in the high bits, its place in the low bits."""
    h, size = b.astype(np.uint64) + np.uint64(1), 1
    while size < gram:
        h = (h[:-size] * _P) ^ (h[size:] + (h[:-size] >> np.uint64(29)))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        size *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    return (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)


def segments(data: bytes, length: int = LENGTH, window: int = WINDOW, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(first start, last start, anchor) of each run of strings with one anchor; window a power of two.

    Long texts are read in overlapping blocks; a run that a block cuts is joined again.
    """
    out: list[tuple[int, int, int]] = []
    whole = np.frombuffer(data, dtype=np.uint8)
    starts = len(whole) - length + 1
    for at in range(0, max(starts, 0), _BLOCK):
        b = whole[at:at + _BLOCK + length - 1]
        low = _gram_keys(b, gram)
        span = 1
        while span < window:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        anchor = (low[:len(b) - length + 1] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.r_[first[1:], len(anchor)] - 1
        for f, g, a in zip((first + at).tolist(), (last + at).tolist(), (anchor[first] + at).tolist()):
            if out and out[-1][2] == a:
                out[-1] = (out[-1][0], g, a)
            else:
                out.append((f, g, a))
    return out


def _segment_rows(docs: DataFrame, length: int, window: int, gram: int) -> DataFrame:
    """(core, seg, doc_id, lo, n): hashes of core and segment, first start and number of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_size = length - window + 1
        for batch in batches:
            cores, segs, ids, lows, sizes = [], [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode()
                if len(data) < length:
                    continue
                found = segments(data, length, window, gram)
                cores += [xxhash.xxh3_64_intdigest(data[a:a + core_size]) for _, _, a in found]
                segs += [xxhash.xxh3_64_intdigest(data[f:g + length], a - f) for f, g, a in found]
                lows += [f for f, _, _ in found]
                sizes += [g - f + 1 for f, g, _ in found]
                ids += [doc] * len(found)
            hashes = [pa.array(np.asarray(h, dtype=np.uint64).view(np.int64)) for h in (cores, segs)]
            yield pa.RecordBatch.from_arrays([*hashes, pa.array(ids, pa.int64()), pa.array(lows, pa.int32()), pa.array(sizes, pa.int32())],
                                             ["core", "seg", "doc_id", "lo", "n"])

    return docs.mapInArrow(run, "core bigint, seg bigint, doc_id bigint, lo int, n int")


# --- suffix arrays ----------------------------------------------------------

def _dealt(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, symbols in it, place of each among its like, places of the first of each symbol) of a stable sort."""
    order = np.argsort(symbols, kind="stable")
    found = symbols[order]
    first = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return order, found, np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)])), first


def _induced(s: np.ndarray, stype: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from that of the leftmost-smaller ones.

    Symbols are passed one by one, all suffixes of one at a time: those that a
    suffix of the same symbol brings in are the next batch of that symbol, as many
    batches as its longest run; the others are dealt to their symbols in order.
    """
    sa = np.full(len(s), -1, dtype=np.int64)
    begins, present = np.r_[0, ends[:-1]], np.flatnonzero(np.diff(ends, prepend=0)).tolist()
    marks = np.bincount(s[lms], minlength=len(ends))
    _, symbols, among, _ = _dealt(s[lms])
    sa[(ends - marks)[symbols] + among] = lms
    before = np.r_[0, s[:-1]].astype(np.uint16)
    kind_before = np.r_[False, stype[:-1]]
    larger = ~kind_before
    larger[0] = False  # nothing comes before the first place
    head = begins.copy()
    for c in present:  # larger suffixes, from the left
        at, seen = begins[c], []
        while at < head[c]:
            batch = sa[at:head[c]]
            at = head[c]
            batch = batch[larger[batch]]
            own = before[batch] == c
            inner = batch[own] - 1
            sa[at:at + len(inner)] = inner
            head[c] += len(inner)
            seen.append(batch[~own])
        seen.append(sa[ends[c] - marks[c]:ends[c]])
        batch = np.concatenate(seen)
        batch = batch[larger[batch]]
        if len(batch):
            order, symbols, among, first = _dealt(before[batch])
            sa[head[symbols] + among] = batch[order] - 1
            head[symbols[first]] += np.diff(np.r_[first, len(symbols)])
    tail = ends.copy()
    for c in reversed(present):  # smaller suffixes, from the right
        at, seen = ends[c], []
        while at > tail[c]:
            batch = sa[tail[c]:at][::-1]
            at = tail[c]
            batch = batch[kind_before[batch]]
            own = before[batch] == c
            inner = batch[own] - 1
            sa[at - len(inner):at] = inner[::-1]
            tail[c] -= len(inner)
            seen.append(batch[~own])
        seen.append(sa[begins[c]:head[c]][::-1])
        batch = np.concatenate(seen)
        batch = batch[kind_before[batch]]
        if len(batch):
            order, symbols, among, first = _dealt(before[batch])
            sa[tail[symbols] - 1 - among] = batch[order] - 1
            tail[symbols[first]] -= np.diff(np.r_[first, len(symbols)])
    return sa


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array of many different symbols, the last one the only smallest: sorted by twice as many symbols each round.

    A suffix's rank is the number of suffixes before its group of ties; only
    groups of more than one go on.
    """
    bits = int(s.max() + 1).bit_length()
    depth = max(1, 62 // bits)
    padded, key = np.r_[s.astype(np.int64) + 1, np.zeros(depth, dtype=np.int64)], np.zeros(len(s), dtype=np.int64)
    for k in range(depth):
        key = key << bits | padded[k:k + len(s)]
    rank, rows = np.zeros(len(s), dtype=np.int64), np.arange(len(s))
    while True:
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        old = rank[rows]
        group = np.r_[True, old[1:] != old[:-1]]
        fresh = group | np.r_[True, key[1:] != key[:-1]]
        place = np.arange(len(rows))
        rank[rows] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        rows = rows[~fresh | np.r_[~fresh[1:], False]]
        if not len(rows):
            break
        key = rank[rows] << 32 | rank[rows + depth]  # tied suffixes do not reach the last symbol
        depth *= 2
    out = np.empty(len(s), dtype=np.int64)
    out[rank] = np.arange(len(s))
    return out


def _named(marked: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranks of the substrings [begin, end] of symbols marked with their types; equal ones share a rank.

    As many symbols as fit one word are compared at a time, and only substrings
    that are longer and not yet told from all others go on. With their types no
    substring is the beginning of another one.
    """
    bits = int(marked.max() + 1).bit_length()
    each = max(1, 62 // bits)
    padded = np.r_[marked + 1, np.zeros(each, dtype=np.int64)]
    rank, open_rows, at = np.zeros(len(begin), dtype=np.int64), np.arange(len(begin)), begin.copy()
    while True:
        key = np.zeros(len(open_rows), dtype=np.int64)
        for k in range(each):
            place = at[open_rows] + k
            key = key << bits | np.where(place <= end[open_rows], padded[np.minimum(place, len(padded) - 1)], 0)
        # the first rank of a group grows by how many of the group come before
        order = np.lexsort((key, rank[open_rows]))
        rows, key = open_rows[order], key[order]
        old = rank[rows]
        group = np.r_[True, old[1:] != old[:-1]]
        fresh = group | np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(group, np.arange(len(rows)), 0))
        start = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))
        rank[rows] = old + start - first
        sizes = np.diff(np.r_[np.flatnonzero(fresh), len(rows)])
        shared = np.repeat(sizes > 1, sizes)
        at[rows] += each
        open_rows = rows[shared & (at[rows] <= end[rows])]
        if not len(open_rows):
            break
    return (np.unique(rank, return_inverse=True)[1]).astype(np.int32)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of an int32 array that ends in its only 0, by induced sorting.

    Suffixes are classified as smaller or larger than the next one; substrings
    between leftmost-smaller places are named by a sort of their packed symbols;
    the names, if they are not distinct, are sorted by doubling; their order
    induces that of all suffixes, which is linear. Arrays of many symbols are
    sorted by doubling as a whole.
    """
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    if s.max() >= MANY_SYMBOLS:
        return _doubled(s)
    ends = np.cumsum(np.bincount(s))
    differs = np.where(s[:-1] != s[1:], np.arange(n - 1), n)
    deciding = np.minimum.accumulate(differs[::-1])[::-1]
    stype = np.r_[s[deciding] < s[deciding + 1], True]
    is_lms = stype.copy()
    is_lms[0] = False
    is_lms[1:] &= ~stype[:-1]
    lms = np.flatnonzero(is_lms)
    names = _named(s.astype(np.int64) * 2 + stype, lms, np.r_[lms[1:], n - 1])
    if names.max() + 1 == len(lms):
        ranked = np.empty(len(lms), dtype=np.int64)
        ranked[names] = np.arange(len(lms))
    else:
        ranked = _doubled(names)
    return _induced(s, stype, lms[ranked], ends)


def common_prefixes(s: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """Permuted common prefixes: how much each suffix shares with the one before it in order, up to ``cap``.

    The value at a place is at least that of any place before it less the way
    between them, so places are filled in from a coarse grid to a fine one.
    """
    n = len(s)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    padded = np.r_[s.astype(np.uint16), np.zeros(8, np.uint16)]
    words = np.ndarray((n + 4,), dtype="<u8", buffer=padded.tobytes(), strides=(2,))
    out = np.zeros(n, dtype=np.int64)
    step = 64
    while step:
        todo = np.arange(0, n, step) if step == 64 else np.arange(step, n, 2 * step)
        start = np.zeros(len(todo), dtype=np.int64) if step == 64 else np.maximum(out[todo - step] - step, 0)
        todo, start = todo[before[todo] >= 0], start[before[todo] >= 0]
        a, b, size = todo, before[todo], start
        while len(a):  # four symbols at a time, then what is left one by one
            room = np.minimum(n - a - size, n - b - size)
            more = (size < cap) & (room >= 4)
            more[more] = words[(a + size)[more]] == words[(b + size)[more]]
            out[a] = size
            a, b, size = a[more], b[more], size[more] + 4
        a, b, size = todo, before[todo], out[todo]
        while len(a):
            more = (size < cap) & (a + size < n) & (b + size < n)
            more[more] = s[(a + size)[more]] == s[(b + size)[more]]
            out[a] = size
            a, b, size = a[more], b[more], size[more] + 1
        step //= 2
    return np.minimum(out, cap)


def repeated_starts(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string, whether the string of ``length`` bytes at each start occurs at another place of any of them."""
    gap = np.ones(1, dtype=np.int32)
    pieces = [x for p in parts for x in (np.frombuffer(p, dtype=np.uint8).astype(np.int32) + 2, gap)]
    s = np.concatenate([*pieces, np.zeros(1, dtype=np.int32)])
    sa = suffix_array(s)
    shared = common_prefixes(s, sa, length)
    hit = np.zeros(len(s), dtype=bool)
    long = np.flatnonzero(shared[sa[1:]] >= length) + 1
    hit[sa[long]] = True
    hit[sa[long - 1]] = True
    out, at = [], 0
    for p in parts:
        out.append(hit[at:at + max(len(p) - length + 1, 0)])
        at += len(p) + 1
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


# --- the operator -----------------------------------------------------------

def _cut(texts: DataFrame, wanted: DataFrame, length: int, max_segments: int) -> DataFrame:
    """Bytes of the wanted segments, or for crowded cores the hashes of their single strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("core", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                            ("lo", pa.int32()), ("once", pa.bool_()), ("data", pa.binary())])
        for batch in batches:
            rows, size = [], 0
            for doc, text, spots in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data = text.as_py().encode()
                for spot in spots.as_py():
                    lo, n = spot["lo"], spot["n"]
                    if spot["crowd"] <= max_segments:
                        rows.append((spot["core"], None, None, doc, lo, spot["once"], data[lo:lo + n - 1 + length]))
                        size += n + length
                        continue
                    for p in range(lo, lo + n):
                        digest = xxhash.xxh3_128_digest(data[p:p + length])
                        h1, h2 = (int.from_bytes(digest[k:k + 8], "little", signed=True) for k in (0, 8))
                        rows.append((spot["core"], h1, h2, doc, p, spot["once"], None))
                if size > 8 << 20 or len(rows) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    spots = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("core", "lo", "n", "once", "crowd")).alias("spots"))
    return (texts.join(spots.hint("merge"), "doc_id").select("doc_id", "text", "spots")
            .mapInArrow(run, "core bigint, h1 bigint, h2 bigint, doc_id bigint, lo int, once boolean, data binary"))


def _sharded(pieces: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(doc_id, lo, hi): repeated starts of the segments that occur once, shard by shard."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        out = []
        for (doc, lo, once, _), flags in zip(held, repeated_starts([h[3] for h in held], length)):
            if once:
                out += [(doc, lo + a, lo + b) for a, b in runs(flags)]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())],
                                          ["doc_id", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, core = [], 0, None
        for batch in batches:
            for key, doc, lo, once, data in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if key != core and size >= shard_bytes:
                    yield flush(held)
                    held, size = [], 0
                core = key
                held.append((doc, lo, once, data))
                size += len(data)
        if held:
            yield flush(held)

    return (pieces.where(F.col("data").isNotNull()).select("core", "doc_id", "lo", "once", "data")
            .repartition("core").sortWithinPartitions("core", "doc_id", "lo").mapInArrow(run, "doc_id bigint, lo int, hi int"))


def repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
            max_segments: int = MAX_SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, lo, hi) ranges of starts of repeated strings, and (doc_id, text) of all texts that may have any."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    rows = stored(_segment_rows(plain, length, window, gram), "repeat-segments")
    cores = rows.groupBy("core").agg(F.count(F.lit(1)).alias("uses"), F.min("seg").alias("low"), F.max("seg").alias("high"))
    cores = stored(cores.where("uses > 1").select("core", (F.col("low") != F.col("high")).alias("mixed")), "repeat-cores")
    shared = stored(rows.join(cores.hint("merge"), "core"), "repeat-shared")
    distinct = stored(shared.groupBy("core", "seg", "mixed").agg(F.count(F.lit(1)).alias("uses"), F.min(F.struct("doc_id", "lo", "n")).alias("at")),
                      "repeat-distinct")
    whole = distinct.where("uses > 1").select("core", "seg")
    in_full = shared.join(stored(whole, "repeat-whole").hint("merge"), ["core", "seg"]).select("doc_id", "lo", (F.col("lo") + F.col("n") - 1).alias("hi"))
    crowds = stored(distinct.where("mixed").groupBy("core").agg(F.count(F.lit(1)).alias("crowd"), F.min("uses").alias("least"))
                    .where("least = 1").select("core", "crowd"), "repeat-crowds")
    wanted = (distinct.where("mixed").join(crowds, "core")
              .select("core", "at.*", (F.col("uses") == 1).alias("once"), "crowd"))
    wanted = stored(wanted, "repeat-wanted")
    affected = stored(shared.select("doc_id").distinct(), "repeat-affected")
    texts = stored(plain.join(affected.hint("merge"), "doc_id", "left_semi"), "repeat-texts")
    pieces = stored(_cut(texts, wanted, length, max_segments), "repeat-pieces")
    single = pieces.where(F.col("data").isNull())
    often = stored(single.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1").select("h1", "h2"), "repeat-often")
    alone = single.where("once").join(often, ["h1", "h2"], "left_semi").select("doc_id", "lo", F.col("lo").alias("hi"))
    ranges = in_full.unionByName(_sharded(pieces, length, shard_bytes)).unionByName(alone)
    return stored(ranges, "repeat-ranges"), texts


def remove_repeats(docs: DataFrame, length: int = LENGTH, window: int = WINDOW, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every document; ``kept`` is null where nothing was removed.

    A byte goes if a string of ``length`` bytes that covers it also starts at
    another place of the same or any other document; strings never cross
    documents and are judged on the input. Null text counts as empty; texts
    shorter than ``length`` stay whole. doc_id must be unique; other columns are
    ignored. An empty table gives an empty result.
    """
    ranges, texts = repeats(docs, length, window, gram, shard_bytes, max_segments)
    gathered = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                data, merged = text.as_py().encode(), []
                for lo, hi in sorted((s["lo"], s["hi"] + length) for s in spans.as_py()):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                edges = [0, *(e for m in merged for e in m), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((doc, len(data) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["changed_id", "removed", "spans", "sha", "kept"])

    changed = (texts.join(gathered.hint("merge"), "doc_id").select("doc_id", "text", "spans")
               .mapInArrow(run, "changed_id bigint, removed bigint, spans bigint, sha string, kept binary"))
    data = text_or_empty().cast("binary")
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.length(data).cast("bigint").alias("n_bytes"),
                       F.sha2(data, 256).alias("own_sha"))
    return (base.join(changed.hint("merge"), F.col("doc_id") == F.col("changed_id"), "left")
            .select("doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed"),
                    F.coalesce("spans", F.lit(0)).cast("bigint").alias("n_spans"),
                    F.coalesce("sha", "own_sha").alias("kept_sha256"), "kept"))
