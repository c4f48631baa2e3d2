"""Exact duplicates by composable polynomial fingerprints and chunkwise comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored, text_or_empty

#: Two primes below 2^31: a byte times a power stays below 2^39, so that 2^24 products fit in 64 bits.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1597334677)
CHUNK_BYTES = 1 << 16
MEMBERS_PER_SALT = 256


def powers(base: int, prime: int, count: int) -> np.ndarray:
    """base^0 .. base^(count-1) modulo the prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    step = base % prime
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(prime)])
        step = step * step % prime
    return out[:count]


def combine(left: int, right: int, right_length: int, base: int, prime: int) -> int:
    """The fingerprint of a concatenation from those of its parts."""
    return (left * pow(base, right_length, prime) + right) % prime


class Fingerprint:
    """Polynomial hashes of byte strings, chunk by chunk; chunks may be hashed anywhere and combined."""

    def __init__(self, primes=PRIMES, bases=BASES, chunk_bytes: int = CHUNK_BYTES):
        self.primes, self.bases, self.chunk = primes, bases, chunk_bytes
        self.falling = [powers(b, p, chunk_bytes)[::-1].copy() for b, p in zip(bases, primes)]

    def chunk_hashes(self, data: np.ndarray) -> list[int]:
        wide = data.astype(np.uint64)
        return [int((wide * f[self.chunk - len(wide):]).sum() % np.uint64(p)) if len(wide) else 0
                for f, p in zip(self.falling, self.primes)]

    def of(self, data: bytes) -> list[int]:
        view, total = np.frombuffer(data, dtype=np.uint8), [0] * len(self.primes)
        for at in range(0, len(view), self.chunk):
            part = view[at:at + self.chunk]
            total = [combine(t, h, len(part), b, p)
                     for t, h, b, p in zip(total, self.chunk_hashes(part), self.bases, self.primes)]
        return total


def _cut(chunk_bytes: int):
    """The numbered chunks of the bytes in ``data``; empty bytes are one empty chunk."""
    last = F.greatest(F.ceil(F.length("data") / chunk_bytes), F.lit(1)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(F.col("data"), k * chunk_bytes + 1, chunk_bytes))


def _whole(texts: DataFrame, primes, chunk_bytes: int) -> DataFrame:
    """Marks of texts that are hashed where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = Fingerprint(primes, BASES, chunk_bytes)
        for batch in batches:
            size, fp, sha = [], [], []
            for text in batch.column(1):
                data = text.as_py()
                high, low = mark.of(data)
                size.append(len(data))
                fp.append(high << 31 | low)
                sha.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_bytes", "fp", "text_sha256"])

    return texts.mapInArrow(run, "doc_id bigint, n_bytes bigint, fp bigint, text_sha256 string")


def _combined(texts: DataFrame, primes, chunk_bytes: int) -> DataFrame:
    """Marks of texts of several chunks: chunks are dealt over all tasks, hashed, shifted by the bytes after them and added up."""
    size = F.length("data").cast("bigint")
    chunks = (texts.select("doc_id", size.alias("n_bytes"), F.sha2("data", 256).alias("text_sha256"),
                           F.posexplode(_cut(chunk_bytes)).alias("chunk_no", "chunk"))
              .withColumn("after", F.greatest(F.col("n_bytes") - (F.col("chunk_no") + 1).cast("bigint") * chunk_bytes, F.lit(0)))
              .repartition("doc_id", "chunk_no"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = Fingerprint(primes, BASES, chunk_bytes)
        for batch in batches:
            shifted = [[combine(h, 0, after, b, p) for h, b, p in zip(mark.chunk_hashes(np.frombuffer(chunk, np.uint8)), BASES, primes)]
                       for chunk, after in zip(batch.column("chunk").to_pylist(), batch.column("after").to_pylist())]
            parts = [pa.array([pair[i] for pair in shifted], pa.int64()) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "n_bytes", "text_sha256")], *parts],
                                             ["doc_id", "n_bytes", "text_sha256", "high", "low"])

    hashed = chunks.mapInArrow(run, "doc_id bigint, n_bytes bigint, text_sha256 string, high bigint, low bigint")
    high, low = [F.sum(c) % p for c, p in zip(("high", "low"), primes)]
    return (hashed.groupBy("doc_id", "n_bytes", "text_sha256").agg(high.alias("high"), low.alias("low"))
            .select("doc_id", "n_bytes", F.shiftleft("high", 31).bitwiseOR(F.col("low")).alias("fp"), "text_sha256"))


def fingerprints(docs: DataFrame, primes=PRIMES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, fp, text_sha256) of every document; null text counts as empty.

    A text of one chunk is hashed where it lies. The chunks of a longer one are
    rows of their own, hashed in parallel, whose fingerprints are combined by
    length-shifted arithmetic in an aggregate; any order gives the same sum.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("data"))
    short = F.length("data") <= chunk_bytes
    return _whole(texts.where(short), primes, chunk_bytes).unionByName(_combined(texts.where(~short), primes, chunk_bytes))


def _chunks(docs: DataFrame, wanted: DataFrame, chunk_bytes: int) -> DataFrame:
    """The numbered chunks of the wanted documents' bytes."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("data"))
    # the wanted ids grow with the corpus: never broadcast
    return (texts.join(wanted.hint("merge"), "doc_id")
            .select(*wanted.columns, F.posexplode(_cut(chunk_bytes)).alias("chunk_no", "chunk")))


def equal_texts(docs: DataFrame, primes=PRIMES, chunk_bytes: int = CHUNK_BYTES,
                members_per_salt: int = MEMBERS_PER_SALT) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal when their bytes are. The largest doc_id of a group stays.
    Documents of equal length and fingerprint are compared chunk by chunk with
    the group's largest one; those that differ from it, fingerprint collisions,
    are grouped again among themselves until none is left. A group's largest
    document is copied to as many salts as the group has members_per_salt, so
    that a group of any size is compared by many tasks, and only chunks of
    chunk_bytes meet.

    Null text counts as empty; empty texts are equal. An empty table gives an
    empty result. Rows are told apart by doc_id, which must be unique. Other
    columns are ignored.
    """
    marks = stored(fingerprints(docs, primes, chunk_bytes), "exact-marks")
    key = ["n_bytes", "fp"]
    groups = stored(marks.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1"), "exact-groups")
    found = marks.join(groups, key, "left")
    settled = found.where(F.col("keep_id").isNull()).select("doc_id", F.col("doc_id").alias("keep_id"))
    open_rows = stored(found.where(F.col("keep_id").isNotNull()).select("doc_id", *key, "keep_id", "n"), "exact-open")
    while True:
        # the texts meet the list of wanted ids once
        pieces = stored(_chunks(docs, open_rows.select("doc_id", "keep_id", "n"), chunk_bytes), "exact-chunks")
        salts = F.ceil(F.col("n") / members_per_salt).cast("int")
        heads = open_rows.where("doc_id = keep_id")
        members = pieces.where("doc_id <> keep_id").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts).cast("int"))
        copies = (pieces.where("doc_id = keep_id").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
                  .select("keep_id", "salt", "chunk_no", F.col("chunk").alias("head_chunk")))
        compared = (members.join(copies.hint("merge"), ["keep_id", "salt", "chunk_no"], "left")
                    .groupBy("doc_id", F.col("keep_id").alias("head_id"))
                    .agg(F.min(F.coalesce(F.col("chunk") == F.col("head_chunk"), F.lit(False))).alias("same")))
        compared = stored(compared, "exact-compared")
        settled = (settled.unionByName(heads.select("doc_id", "keep_id"))
                   .unionByName(compared.where("same").select("doc_id", F.col("head_id").alias("keep_id"))))
        left = compared.where("NOT same").select("doc_id").join(open_rows.select("doc_id", *key), "doc_id")
        regrouped = stored(left, "exact-left")
        if regrouped.isEmpty():
            break
        heads_left = regrouped.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        open_rows = stored(regrouped.join(stored(heads_left, "exact-heads"), key), "exact-open")
    settled = stored(settled, "exact-settled")
    sizes = stored(settled.groupBy("keep_id").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1"),
                   "exact-sizes")
    return (marks.select("doc_id", "text_sha256").join(settled, "doc_id").join(sizes, "keep_id", "left")
            .select("doc_id", "keep_id", F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                    (F.col("doc_id") == F.col("keep_id")).alias("kept"), "text_sha256"))
