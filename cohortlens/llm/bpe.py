"""Byte-level BPE: a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import text_or_empty

#: White space as the tokenizer's patterns understand it, and its word pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
         r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
#: Chunks that words never cross: plain words and plain marks with a sure end, else all up to the next space.
_LETTERS, _MARKS = r"A-Za-zÀ-ÖØ-öø-ž", r".,;:!?"
CHUNKS = (r" ?[" + _LETTERS + r"]+(?=[ \n" + _MARKS + r"]|\Z)| ?[" + _MARKS + r"]+(?=[ \n" + _LETTERS + r"]|\Z)"
          r"| ?[^" + SPACE + r"]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
CACHED_CHUNKS = 600_000
CACHED_CHARS = 64
_SHIFT = 32


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of each byte: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Vocabulary:
    """Vocabulary, merges and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        of_symbol = {s: b for b, s in byte_symbols().items()}
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.strings = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for symbols, number in vocab.items():
            self.strings[number] = bytes(of_symbol[s] for s in symbols) if symbols not in self.special else symbols.encode()
        for content, number in self.special.items():
            self.strings[number] = content.encode()
        self.of_byte = [vocab[s] for _, s in sorted(byte_symbols().items())]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[left] << _SHIFT | vocab[right], rank << _SHIFT | vocab[left + right])
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(names) + ")") if names else None
        self.in_merge_order = all(m >> _SHIFT == (m & 0xFFFFFFFF) - 256 for m in self.merges.values())


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_word(word: bytes, of_byte: list[int], merges: dict[int, int]) -> list[int]:
    """Ids of one word.

    The queue holds rank and place of each neighbouring pair; the lowest rank,
    then the leftmost place, is merged first. A popped entry is stale, and
    skipped, when its place is dead or its pair no longer has that rank.
    """
    symbols = [of_byte[b] for b in word]
    size = len(symbols)
    if size == 1:
        return symbols
    following, before = list(range(1, size + 1)), list(range(-1, size))
    queue = []
    for at in range(size - 1):
        merge = merges.get(symbols[at] << _SHIFT | symbols[at + 1])
        if merge is not None:
            queue.append(merge >> _SHIFT << _SHIFT | at)
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        at = entry & 0xFFFFFFFF
        left, right = symbols[at], following[at]
        if left < 0 or right == size:
            continue
        merge = merges.get(left << _SHIFT | symbols[right])
        if merge is None or merge >> _SHIFT != entry >> _SHIFT:
            continue
        symbols[at] = left = merge & 0xFFFFFFFF
        symbols[right] = -1
        after = following[at] = following[right]
        if after < size:
            before[after] = at
            merge = merges.get(left << _SHIFT | symbols[after])
            if merge is not None:
                heapq.heappush(queue, merge >> _SHIFT << _SHIFT | at)
        previous = before[at]
        if previous >= 0:
            merge = merges.get(symbols[previous] << _SHIFT | left)
            if merge is not None:
                heapq.heappush(queue, merge >> _SHIFT << _SHIFT | previous)
    return [s for s in symbols if s >= 0]


class ChunkIds(dict):
    """Little-endian 32-bit ids of chunks, worked out on first sight; emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        ids = np.asarray(self.encode(chunk), dtype="<u4").tobytes()
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class Codec:
    """Encode and decode whole texts; ``encode_chunk`` turns one chunk into ids."""

    def __init__(self, vocab: Vocabulary, encode_chunk):
        self.vocab, self.cache = vocab, ChunkIds(encode_chunk)
        self.chunks = re.compile(CHUNKS).findall

    def encode(self, text: str) -> bytes:
        special = self.vocab.special
        if not any(s in text for s in special):
            return b"".join(map(self.cache.__getitem__, self.chunks(text)))
        parts = []
        for part in self.vocab.split_special.split(text):
            if part in special:
                parts.append(np.asarray([special[part]], dtype="<u4").tobytes())
            elif part:
                parts += map(self.cache.__getitem__, self.chunks(part))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        strings = self.vocab.strings
        return b"".join(map(strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def queue_codec(path: str) -> Codec:
    """A codec whose chunks are merged by the priority queue."""
    vocab = vocabulary(path)
    words, of_byte, merges = regex.compile(WORDS).findall, vocab.of_byte, vocab.merges

    def encode_chunk(chunk: str) -> list[int]:
        return [i for word in words(chunk) for i in merge_word(word.encode(), of_byte, merges)]

    return Codec(vocab, encode_chunk)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids binary, decoded string): ids as little-endian unsigned 32-bit integers.

    A special token's string in a text becomes its id, no other token is added.
    Null text counts as empty and gives no ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = queue_codec(path)
        for batch in batches:
            ids = [codec.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([codec.decode(i) for i in ids], pa.string())],
                ["doc_id", "ids", "decoded"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), each whole text encoded and decoded in its task.

    Null and empty texts have no token and the digests of the empty string.
    Repeated rows give repeated results, an empty table none; other columns are
    ignored. A text of any length is one unit of work, its words are independent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = queue_codec(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = codec.encode(text.as_py())
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
