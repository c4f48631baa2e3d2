"""Ranked lexical search by hashed max-sketches.

For one document a term's impact grows with its frequency. A sketch folds the
frequencies into cells chosen by hash, each cell keeping its maximum, in several
independent folds; the least of a term's cells is never below its frequency, so
the impacts read from a sketch sum up to an upper bound of the score.

A search looks all query terms up in blocks of sketches at once. The documents
of the highest bounds are scored from their texts first; their k-th score is a
threshold, and only documents whose bound reaches it are scored at all, in
descending order of bounds, while the threshold rises. No document is left out
that could be among the best, so the ranking is exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import stored

TOP = 20
#: Independent folds of a sketch, and their cells for each different term of the document, at least.
FOLDS = 3
CELLS_PER_TERM = 4
#: Frequencies from here on are not told apart by a sketch; their bound is that of endless repetition.
MOST = 255
#: Texts of items that are looked up together, in bytes.
ITEMS_BLOCK_BYTES = 4 << 20
_BLOCK = 1 << 20
_CELLS = 1 << 22
#: Rows of the index that leave a task together.
_ROWS = 512
_IMPACT = 10 ** 9
#: Bytes of terms: letters and digits of ASCII, capitals folded, and all bytes of other characters.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(text: str | None) -> Counter:
    """How often each term occurs in the whole text, read in blocks that end between terms."""
    folded, counts, at = (text or "").encode("utf-8", "replace").translate(_TERM), Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + _BLOCK)
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def _hashes(terms: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), dtype=np.uint64, count=len(terms))


def _cells(hashes: np.ndarray, fold: int, bits: int) -> np.ndarray:
    """The cell of each term in one fold: two halves of the hash, combined."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
    mixed = (low + np.uint64(fold) * (high | np.uint64(1))) & np.uint64(0xFFFFFFFF)
    mixed = (mixed ^ (mixed >> np.uint64(15))) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
    return (mixed >> np.uint64(32 - bits)).astype(np.int64)


def sketch(counts: Counter, folds: int = FOLDS, cells_per_term: int = CELLS_PER_TERM) -> tuple[int, bytes]:
    """(bits of a fold's length, the folds' cells one after the other)."""
    bits = max(6, math.ceil(math.log2(max(len(counts), 1) * cells_per_term)))
    hashes = _hashes(list(counts))
    often = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    order = np.argsort(often, kind="stable")  # of the terms in a cell the most frequent is written last
    hashes, often = hashes[order], np.minimum(often[order], MOST).astype(np.uint8)
    out = np.zeros((folds, 1 << bits), dtype=np.uint8)
    for fold in range(folds):
        out[fold, _cells(hashes, fold, bits)] = often
    return bits, out.tobytes()


def build_index(docs: DataFrame, folds: int = FOLDS, cells_per_term: int = CELLS_PER_TERM) -> DataFrame:
    """(doc_id, n, bits, sketch, text) of every row: number of terms, max-sketch, and the text to score it from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, _ROWS) for whole in batches for at in range(0, whole.num_rows, _ROWS)):
            sizes, bits, cells = [], [], []
            for text in batch.column(1):
                counts = term_counts(text.as_py())
                sizes.append(counts.total())
                for column, value in zip((bits, cells), sketch(counts, folds, cells_per_term)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bits, pa.int32()), pa.array(cells, pa.binary()),
                 batch.column(1)], ["doc_id", "n", "bits", "sketch", "text"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id bigint, n bigint, bits int, sketch binary, text string"))


def document_frequencies(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms occurs; tasks add up before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(terms.intersection(term_counts(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                         ["term", "df"])

    rows = index.select("text").mapInArrow(run, "term binary, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in rows.collect()}


class Lookup:
    """The terms of a block of items, with their weights, and what documents score for them."""

    def __init__(self, items: list[tuple], df: dict[bytes, int], documents: int, terms: int, folds: int):
        counts = [term_counts(text) for _, text in items]
        self.ids, self.documents, self.terms, self.folds = [i for i, _ in items], documents, max(terms, 1), folds
        self.vocabulary = {t: n for n, t in enumerate(sorted(set().union(*counts) & df.keys()))}
        self.known = self.vocabulary.keys()
        self.weights = np.asarray([math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                                   for t in self.vocabulary], dtype=np.int64)
        asked = sorted((self.vocabulary[t], q, c) for q, found in enumerate(counts) for t, c in found.items() if t in self.known)
        self.asked = np.asarray(asked, dtype=np.int64).reshape(-1, 3)
        self.first = np.searchsorted(self.asked[:, 0], np.arange(len(self.vocabulary) + 1))
        self.hashes = _hashes(list(self.vocabulary))

    def _sums(self, rows: int, row: np.ndarray, term: np.ndarray, often: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Scores (rows, items) from frequencies; all values stay below 2^53, so the sums are exact."""
        norm = 75 + 25 * n * self.documents // self.terms
        part = _IMPACT * often // (1000 * often + 12 * norm[row])
        gained = self.weights[term] * part
        many = self.first[term + 1] - self.first[term]
        at = np.repeat(self.first[term] - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(int(many.sum()))
        asked = self.asked[at]
        cell = np.repeat(row, many) * len(self.ids) + asked[:, 1]
        gained = np.repeat(gained, many) * asked[:, 2]
        return np.bincount(cell, weights=gained, minlength=rows * len(self.ids)).reshape(rows, -1)

    def bounds(self, sketches: np.ndarray, bits: int, n: np.ndarray) -> np.ndarray:
        """Upper bounds (documents, items) of documents whose folds have 2^bits cells."""
        cells = sketches.reshape(len(n), self.folds, 1 << bits)
        least = cells[:, 0].take(_cells(self.hashes, 0, bits), axis=1)
        for fold in range(1, self.folds):
            np.minimum(least, cells[:, fold].take(_cells(self.hashes, fold, bits), axis=1), out=least)
        row, term = np.nonzero(least)
        often = least[row, term].astype(np.int64)
        often[often == MOST] = _IMPACT  # as good as endless
        return self._sums(len(n), row, term, often, n)

    def scores(self, text: str | None, n: int) -> np.ndarray:
        """Exact scores of one document for every item."""
        counts = term_counts(text)
        found = self.known & counts.keys()
        term = np.fromiter((self.vocabulary[t] for t in found), dtype=np.int64, count=len(found))
        often = np.fromiter((counts[t] for t in found), dtype=np.int64, count=len(found))
        return self._sums(1, np.zeros(len(found), np.int64), term, often, np.asarray([n]))[0]

    def blocks(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows of the batch, their bounds), sketches of one length at a time."""
        n = batch.column(1).to_numpy(zero_copy_only=False)
        bits, sketches = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3)
        for size in np.unique(bits):
            rows = np.flatnonzero((bits == size) & (n > 0))
            step = max(1, _CELLS // max(len(self.vocabulary), len(self.ids), self.folds << int(size), 1))
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                joined = np.frombuffer(b"".join(sketches[int(r)].as_py() for r in part), dtype=np.uint8)
                yield part, self.bounds(joined, int(size), n[part])


def _highest_bounds(index: DataFrame, lookup: Lookup, k: int) -> DataFrame:
    """(doc_id): for each item the ``k`` documents of the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(lookup.ids)
        best, doc = np.zeros((items, k)), np.zeros((items, k), dtype=np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for rows, bounds in lookup.blocks(batch):
                both = np.concatenate([best, bounds.T], axis=1)
                docs = np.concatenate([doc, np.broadcast_to(ids[rows], (items, len(rows)))], axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best, doc = np.take_along_axis(both, top, 1), np.take_along_axis(docs, top, 1)
        item, place = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc[item, place]), pa.array(best[item, place])],
                                         ["item", "doc_id", "bound"])

    rows = (index.where(F.col("doc_id").isNotNull()).select("doc_id", "n", "bits", "sketch")
            .mapInArrow(run, "item int, doc_id bigint, bound double"))
    for keys in (["item", F.pmod(F.col("doc_id"), F.lit(64))], ["item"]):  # first within shares of the documents
        order = Window.partitionBy(*keys).orderBy(F.desc("bound"), "doc_id")
        rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
    return rows.select("doc_id").distinct()


def _scored(index: DataFrame, lookup: Lookup, k: int, least: np.ndarray) -> DataFrame:
    """(item, doc_id, score) of all documents that can be among the ``k`` best and score ``least`` or more.

    Each task scores in descending order of bounds until they fall below its
    threshold, the larger of ``least`` and its own ``k``-th score so far.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple[int, int]]] = [[] for _ in lookup.ids]
        limit = np.maximum(least, 1)
        for batch in batches:
            ids, n, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4)
            for rows, bounds in lookup.blocks(batch):
                exact: dict[int, np.ndarray] = {}
                for item in np.flatnonzero((bounds >= limit).any(axis=0)).tolist():
                    heap, column = heaps[item], bounds[:, item]
                    open_rows = np.flatnonzero(column >= limit[item])
                    for at in open_rows[np.argsort(-column[open_rows], kind="stable")].tolist():
                        if column[at] < limit[item]:
                            break
                        if at not in exact:
                            row = int(rows[at])
                            exact[at] = lookup.scores(texts[row].as_py(), n[row])
                        score = int(exact[at][item])
                        if score < limit[item]:
                            continue
                        doc = ids[int(rows[at])]
                        entry = (score, -doc if doc is not None else float("inf"))
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        else:
                            heapq.heappushpop(heap, entry)
                        if len(heap) == k:
                            limit[item] = max(limit[item], heap[0][0])
        found = [(item, None if doc == float("inf") else -doc, score) for item, heap in enumerate(heaps) for score, doc in heap]
        yield pa.RecordBatch.from_arrays([pa.array([f[j] for f in found], kind) for j, kind in
                                          enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item int, doc_id bigint, score bigint")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = TOP, folds: int = FOLDS,
           block_bytes: int = ITEMS_BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of the stored ``index`` for each of ``items`` (item_id, text).

    Exact; equal scores rank by ascending doc_id, null ids first. Documents without terms
    (null, empty, marks alone) are never found, nor are scores of 0; an item
    without a known term has no row. Repeated rows of the index are documents
    of their own; equal rows of ``items`` count once, rows of one id and
    different texts are ranked apart. Empty tables give no row. Texts of any
    length are read whole. Items are looked up in blocks of ``block_bytes`` of
    text, so that neither the driver nor a task holds more.
    """
    spark = index.sparkSession
    n, length = index.agg(F.sum((F.col("n") > 0).cast("bigint")), F.sum("n")).first()
    asked = items.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    blocks = 1 + (asked.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0) // block_bytes
    item_type = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id bigint, score bigint")
    if not n:
        return out
    for block in range(blocks):
        share = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        wanted = [(r["item_id"], r["text"]) for r in asked.where(share).collect()]
        terms = set().union(*(term_counts(text) for _, text in wanted))
        df = document_frequencies(index, terms) if terms else {}
        if not df:
            continue
        lookup = Lookup(wanted, df, n, length, folds)
        # at most k documents an item
        first = stored(_highest_bounds(index, lookup, k), "ranking-first")
        seeds = _ranked(_scored(index.join(F.broadcast(first), "doc_id", "left_semi"), lookup, k, np.zeros(len(wanted))), k)
        least = np.zeros(len(wanted))
        for row in seeds.where(F.col("rank") == k).collect():
            least[row["item"]] = row["score"]
        found = _ranked(_scored(index, lookup, k, least), k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(wanted)], f"item int, item_id {item_type}")
        out = out.unionByName(found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
