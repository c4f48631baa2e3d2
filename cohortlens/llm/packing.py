"""Mixture-controlled packing: deficit round-robin over source queues.

A queue is the stream of one source's tokens. In each round a queue earns its
share of a window, rounded down to whole packets; what it earned beyond that is
its deficit and is carried on. What round r has served of a queue is therefore
``min(total, packet * floor(r * quantum / packet))``: any task can compute it
for any round, which carries deficits across windows and partitions without a
sequential pass. Rounds follow each other, queues within a round stand in a
fixed order, and the resulting stream is cut into windows.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.bpe import Codec, Vocabulary, queue_codec, vocabulary
from cohortlens.llm.common import stored, text_or_empty

WINDOW = 1024
PACKET = 32
#: Quanta are counted in 2^-16 tokens.
FRACTION = 16
#: The largest sources with a queue of their own, as have all with a given weight; all others share one more queue.
MAX_QUEUES = 4096
_CELLS = 1 << 21

PIECE_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                "sequence_id bigint, offset bigint, queue int")


class WholeTexts(Codec):
    """Whole texts at once by a compiled encoder, with the special strings in their places."""

    def __init__(self, vocab: Vocabulary, encoding):
        super().__init__(vocab, encoding.encode_ordinary)
        self.encoding = encoding

    def encode(self, text: str) -> bytes:
        special = self.vocab.special
        parts = self.vocab.split_special.split(text) if any(s in text for s in special) else [text]
        return b"".join(np.asarray([special[p]], dtype="<u4").tobytes() if p in special else
                        self.encoding.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in parts if p)


@functools.lru_cache(maxsize=2)
def fast_codec(path: str) -> Codec:
    """The same ids by the compiled BPE, where the file's ids stand in merge order."""
    import tiktoken

    vocab = vocabulary(path)
    if not vocab.in_merge_order:
        return queue_codec(path)
    taken = set(vocab.special.values())
    ranks = {s: n for n, s in enumerate(vocab.strings) if n not in taken}
    words = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return WholeTexts(vocab, tiktoken.Encoding("packing", pat_str=words, mergeable_ranks=ranks, special_tokens={}))


class Mixture:
    """Totals and quanta of the queues; all arithmetic in 64-bit integers."""

    def __init__(self, totals: np.ndarray, shares: np.ndarray, window: int, packet: int):
        self.totals = totals.astype(np.int64)
        shares = np.maximum(shares.astype(np.float64), 0)
        if len(shares) and shares.sum() <= 0:
            shares = np.ones(len(shares))
        scaled = shares / shares.sum() * (window << FRACTION) if len(shares) else shares
        self.quanta = np.maximum(np.floor(scaled).astype(np.int64), 1)
        self.packet, self.unit = packet, packet << FRACTION

    def served(self, rounds: np.ndarray, queues: slice | np.ndarray = slice(None)) -> np.ndarray:
        """Tokens served of each queue before each round."""
        return np.minimum(self.totals[queues], rounds * self.quanta[queues] // self.unit * self.packet)

    def round_of(self, queue: int, packets: np.ndarray) -> np.ndarray:
        """The round in which a queue's packet is served."""
        quantum = int(self.quanta[queue])
        return -(-((packets + 1) * self.unit) // quantum) - 1

    def positions(self, queue: int, rounds: np.ndarray) -> np.ndarray:
        """Where in the stream a queue's first token of each round stands."""
        later = np.arange(len(self.totals)) < queue
        out = np.empty(len(rounds), dtype=np.int64)
        step = max(_CELLS // max(len(self.totals), 1), 1)
        for at in range(0, len(rounds), step):
            part = rounds[at:at + step]
            out[at:at + step] = self.served(part[:, None] + later[None, :]).sum(axis=1)
        return out

    def pieces(self, queue: int, begin: int, size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cut tokens [begin, begin + size) of a queue: start in the queue, length, position in the stream."""
        if size == 0:
            return (np.empty(0, np.int64),) * 3
        packets = np.arange(begin // self.packet, (begin + size - 1) // self.packet + 1, dtype=np.int64)
        rounds = self.round_of(queue, packets)
        first = np.flatnonzero(np.r_[True, rounds[1:] != rounds[:-1]])
        rounds = rounds[first]
        starts = np.maximum(packets[first] * self.packet, begin)
        ends = np.r_[starts[1:], begin + size]
        served = self.served(rounds, np.full(len(rounds), queue))
        places = self.positions(queue, rounds) + starts - served
        while True:  # a piece that crosses the end of its window goes on in the next one
            room = window - places % window
            cut = np.flatnonzero(ends - starts > room)
            if not len(cut):
                return starts, ends - starts, places
            starts = np.insert(starts, cut + 1, starts[cut] + room[cut])
            places = np.insert(places, cut + 1, places[cut] + room[cut])
            ends = np.r_[starts[1:], begin + size]


def _tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Ids of every document with its closing id, and its start among its source's tokens of this partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part, before = fast_codec(path), TaskContext.get().partitionId(), {}
        closing = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            sources, values, sizes, starts = batch.column(1).to_pylist(), [], [], []
            for source, text in zip(sources, batch.column(2)):
                ids = codec.encode(text.as_py()) + closing
                values.append(ids)
                sizes.append(len(ids) // 4)
                starts.append(before.get(source, 0))
                before[source] = starts[-1] + sizes[-1]
            offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            flat = np.frombuffer(b"".join(values), dtype="<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([part] * len(sizes), pa.int32()),
                 pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), lists],
                ["doc_id", "source", "part", "start", "n", "ids"])

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), text_or_empty().alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, source string, part int, start bigint, n bigint, ids array<int>")


def pack(docs: DataFrame, path: str, weights: Mapping[str, float] | None = None, window: int = WINDOW,
         packet: int = PACKET, end_id: int = 0, max_queues: int = MAX_QUEUES) -> DataFrame:
    """One row per piece of a document in a sequence, see PIECE_SCHEMA.

    Every document's ids and ``end_id`` lie in exactly one piece each. Windows
    hold the sources in the proportions of ``weights``, by default those of the
    whole corpus, to within a packet per queue; a queue that runs dry leaves its
    share to the others, so every sequence but the last is full.

    The ``max_queues`` largest sources and all sources named in ``weights`` have a
    queue each, in order of size and name; all others share one more queue, so
    that the mixture stays small enough for each task. That queue is weighted by
    the sum of its sources, or not at all where weights are given, and within it
    sources follow each other by partition and name, not in proportion. A null source is the source
    named by the empty string. Null and empty texts consist of ``end_id`` alone.
    Repeated rows are packed as often as they occur. An empty table gives no
    piece; other columns are ignored. Texts of any length are cut freely.
    """
    tokens = stored(_tokenised(docs, path, end_id), "packing-tokens")
    spread = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    spread = stored(spread, "packing-spread")
    sizes = spread.groupBy("source").agg(F.sum("n").alias("n"))
    top = sizes.orderBy(F.desc("n"), "source").limit(max_queues).collect()
    if weights:  # a given weight is never lost in the queue of the others
        taken = {r["source"] for r in top}
        given = docs.sparkSession.createDataFrame([(s,) for s in weights], "source string")
        more = sizes.join(given, "source", "left_semi").collect()
        top += sorted((r for r in more if r["source"] not in taken), key=lambda r: (-r["n"], r["source"]))
    names = [r["source"] for r in top]
    total = spread.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    totals = [r["n"] for r in top]
    rest = total - sum(totals)
    if rest:
        totals.append(rest)
    shares = [float((weights or {}).get(s, 0.0)) for s in names] if weights else [float(t) for t in totals]
    if weights and rest:
        shares.append(0.0)
    mixture = Mixture(np.asarray(totals, dtype=np.int64), np.asarray(shares), window, packet)

    # tokens before each (queue, partition): a window over counts, one row per source and partition
    queue = docs.sparkSession.createDataFrame(list(zip(names, range(len(names)))), "source string, queue int")
    queued = spread.join(queue, "source", "left").withColumn("queue", F.coalesce("queue", F.lit(len(names))))
    ordered = Window.partitionBy("queue").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(queued.select("source", "part", "queue", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("before")),
                     "packing-offsets")
    placed = (tokens.join(offsets, ["source", "part"])
              .select("doc_id", "queue", (F.col("before") + F.col("start")).alias("begin"), "ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False).astype("<u4")
            columns: list[list[np.ndarray]] = [[] for _ in range(8)]
            for doc, line, begin, low, high in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                   batch.column(2).to_pylist(), edges[:-1], edges[1:]):
                size = int(high - low)
                starts, lengths, places = mixture.pieces(line, begin, size, window)
                starts = starts - begin
                view = memoryview(flat[low:high].tobytes())
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), (starts + lengths).tolist())]
                count = len(starts)
                for column, value in zip(columns, (
                        np.full(count, doc), starts, lengths, np.asarray(crc, dtype=np.int64), np.full(count, size),
                        places // window, places % window, np.full(count, line, dtype=np.int32))):
                    column.append(value)
            if columns[0]:
                kinds = [pa.int64()] * 7 + [pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)],
                                                 [f.split()[0] for f in PIECE_SCHEMA.split(", ")])

    return placed.mapInArrow(run, PIECE_SCHEMA)
