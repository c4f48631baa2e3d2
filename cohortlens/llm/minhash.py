"""Near duplicates by ProbMinHash, banding, and exact verification around centres.

Sketches of weighted shingles come from exponential arrivals: a shingle of
weight w sends hits at rate w to random slots, a slot keeps its earliest hit,
and a shingle stops as soon as its next hit comes later than every slot's. Two
texts agree in a slot with the probability Jaccard similarity of their weights.
Every shingle of a text weighs the same here, however often it occurs: then that
is the plain Jaccard similarity by which pairs are judged.

Buckets are verified against centres instead of pair by pair. A text is tested
against the centre of each of its buckets. Where a bucket still has members of
several components, its texts are grouped again by their rarest shingles: texts
of similarity p/q or more share one of the first n - ceil(p n / q) + 1 of their n
shingles in any common order. A passage that fills a bucket is common and so
comes last in the order; only texts that share rare shingles meet again. These
groups take more centres each round, and end with one component or with every
member tested, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored
from cohortlens.llm.components import components
from cohortlens.llm.shingles import WORDS, mix, shingle_hashes, slices

SIMILARITY = 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8^4)^24, 3 in a million.
BANDS, ROWS = 24, 4
MEMBERS_PER_SALT = 64
#: Each round over the groups of rare shingles has so many times the centres of the one before.
MORE_CENTERS = 16
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def prob_minhash(sets: list[np.ndarray], weights: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` winning shingles for each non-empty weighted set."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    item = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    rate = np.concatenate(weights) if sets else np.empty(0)
    earliest = np.full(len(sets) * slots, np.inf)
    winner = np.zeros(len(sets) * slots, dtype=np.uint64)
    clock, turn = np.zeros(len(item)), 0
    while len(item):
        turn += 1
        draw = mix(item + np.uint64(turn * int(_GOLDEN) & (1 << 64) - 1))
        clock = clock - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        slot = owner * slots + (mix(draw ^ _GOLDEN) % np.uint64(slots)).astype(np.int64)
        np.minimum.at(earliest, slot, clock)
        won = clock == earliest[slot]
        winner[slot[won]] = item[won]
        latest = earliest.reshape(len(sets), slots).max(axis=1)
        going = clock < latest[owner]
        owner, item, rate, clock = owner[going], item[going], rate[going], clock[going]
    return winner.reshape(len(sets), slots)


def band_keys(winners: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each row and band."""
    rows = winners.reshape(len(winners), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, rows.shape[:2])
    for k in range(rows.shape[2]):
        key = mix(key + rows[:, :, k])
    return key.view(np.int64)


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """(doc_id, fp_high, fp_low, bands): fingerprint of the distinct shingles and band keys; both null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, texts in slices(batch.column(1).to_pylist()):
                marks, sets, weights = [], [], []
                for hashes in shingle_hashes(texts, words):
                    if not len(hashes):
                        marks.append(None)
                        continue
                    distinct = np.unique(hashes)
                    marks.append(xxhash.xxh3_128_intdigest(distinct.tobytes()))
                    sets.append(distinct)
                    weights.append(np.ones(len(distinct)))
                keys = iter(band_keys(prob_minhash(sets, weights, bands * rows), bands) if sets else ())
                signed = [(m >> s) & (1 << 64) - 1 if m is not None else None for s in (64, 0) for m in marks]
                signed = [v - (1 << 64) if v is not None and v >> 63 else v for v in signed]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(texts)), pa.array(signed[:len(texts)], pa.int64()), pa.array(signed[len(texts):], pa.int64()),
                     pa.array([None if m is None else next(keys) for m in marks], pa.list_(pa.int64()))],
                    ["doc_id", "fp_high", "fp_low", "bands"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id bigint, fp_high bigint, fp_low bigint, bands array<bigint>"))


def shingle_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, shingles): the distinct shingle hashes of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1).to_pylist()):
                sets = [np.unique(h).view(np.int64) for h in shingle_hashes(texts, words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def _stars(members: DataFrame) -> DataFrame:
    """(center, member) for bucket members (key, doc_id, rank): the one of highest rank against the others."""
    best = members.groupBy("key").agg(F.max(F.struct("rank", (-F.col("doc_id")).alias("id"))).alias("best"))
    best = stored(best.select("key", (-F.col("best.id")).alias("center")), "near-centers")
    return members.join(best, "key").where("doc_id <> center").select("center", F.col("doc_id").alias("member")).distinct()


def _verified(stars: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """(center, member, similarity, linked) by intersecting exact sets.

    A centre with many members is copied to one salt for every MEMBERS_PER_SALT of them.
    """
    salts = stored(stars.groupBy("center").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_SALT).cast("int").alias("salts")), "near-salts")
    left = (stars.join(salts, "center")
            .select("center", "member", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int").alias("salt"))
            .join(sets.select(F.col("doc_id").alias("member"), F.col("shingles").alias("mine")), "member"))
    right = (salts.join(sets.select(F.col("doc_id").alias("center"), F.col("shingles").alias("theirs")), "center")
             .select("center", "theirs", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    met = left.join(right, ["center", "salt"]).select(
        "center", "member", F.size(F.array_intersect("mine", "theirs")).alias("n_shared"),
        (F.size("mine") + F.size("theirs")).alias("n_both"))
    n_all = F.col("n_both") - F.col("n_shared")
    return met.select("center", "member", (F.col("n_shared") / n_all).alias("similarity"),
                      (q * F.col("n_shared") >= p * n_all).alias("linked"))


def _rare_groups(members: DataFrame, labels: DataFrame, sets: DataFrame, p: int, q: int) -> DataFrame:
    """(key, doc_id, place, n): texts of buckets with several components, by each of their rarest shingles.

    Shingles are ordered by the number of such texts that have them, then by
    hash. Those of one text alone come first and group nothing, so only the
    others are put in order; ``place`` counts all. Of groups with the same
    members the first one in the order is kept, which holds the first common
    shingle of each pair if any of them does.
    """
    labelled = members.join(labels.select(F.col("id").alias("doc_id"), "component_id"), "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    opened = labelled.groupBy("key").agg(F.min(component).alias("low"), F.max(component).alias("high")).where("low < high")
    ids = stored(members.join(opened.select("key"), "key", "left_semi").select("doc_id").distinct(), "near-open")
    rows = (sets.join(ids.hint("merge"), "doc_id", "left_semi")
            .select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("key")))
    common = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "near-common")
    first = F.col("n") - F.expr(f"({p} * n + {q - 1}) div {q}") + 1
    own = F.col("n") - F.size("shared")
    ordered = (rows.join(common, "key").groupBy("doc_id", "n")
               .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("shared"))
               .select("doc_id", "n", own.alias("own"),
                       F.posexplode(F.slice("shared", F.lit(1), F.greatest(first - own, F.lit(0)).cast("int"))).alias("at", "e"))
               .select("e.key", "e.df", "doc_id", (F.col("own") + F.col("at") + 1).alias("place"), "n"))
    groups = stored(ordered, "near-rare")
    wanted = (groups.groupBy("key").agg(F.first("df").alias("df"), F.count(F.lit(1)).alias("size"),
                                        F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("members"))
              .where("size > 1").groupBy("size", "members").agg(F.min(F.struct("df", "key")).alias("first")))
    return groups.join(stored(wanted.select("first.key"), "near-wanted"), "key", "left_semi").select("key", "doc_id", "place", "n")


def _untested(groups: DataFrame, labels: DataFrame, centers: int, p: int, q: int) -> tuple[DataFrame, DataFrame]:
    """(center, member) of different components that may be similar, and the groups without these centres.

    A group has up to ``centers`` centres, the members of highest rank of a
    hashed slot each. A centre meets all members of other components, so it can
    leave the group. Sizes, and the places of the shingle that a pair has in
    common first, bound its similarity.
    """
    labelled = stored(groups.join(labels.select(F.col("id").alias("doc_id"), "component_id"), "doc_id", "left")
                      .withColumn("component", F.coalesce("component_id", "doc_id")).drop("component_id"), "near-labelled")
    opened = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rows = stored(labelled.join(opened.select("key"), "key", "left_semi")
                  .withColumn("slot", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(centers))), "near-groups")
    best = rows.groupBy("key", "slot").agg(F.max(F.struct("rank", (-F.col("doc_id")).alias("id"), "component", "place", "n")).alias("best"))
    best = stored(best.select("key", (-F.col("best.id")).alias("center"), F.col("best.component").alias("c_component"),
                              F.col("best.place").alias("c_place"), F.col("best.n").alias("c_n")), "near-centers")
    room = 1 + F.least(F.col("n") - F.col("place"), F.col("c_n") - F.col("c_place"))
    pairs = (rows.join(best, "key").where("component <> c_component")
             .where((q * F.least("n", "c_n") >= p * F.greatest("n", "c_n")) & ((p + q) * room >= p * (F.col("n") + F.col("c_n"))))
             .select("center", F.col("doc_id").alias("member")).distinct())
    left = rows.join(best.select("key", F.col("center").alias("doc_id")), ["key", "doc_id"], "left_anti")
    return pairs, left.select("key", "doc_id", "place", "n", "rank")


def near_links(docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(a, b, similarity): links that join all representatives connected by Jaccard similarity >= ``similarity``.

    Not every similar pair is listed: members of one centre are linked to it
    alone. Two representatives are connected through the listed links when
    similar pairs of them that share a band connect them, and all links are
    similar pairs.
    """
    share = Fraction(str(similarity)).limit_denominator(1000)
    p, q = share.numerator, share.denominator
    buckets = signed.select("doc_id", F.explode("bands").alias("key"))
    sizes = stored(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-buckets")
    members = stored(buckets.join(sizes, "key"), "near-members")
    # a text from which others were derived shares a bucket with most of them
    rank = stored(members.groupBy("doc_id").agg(F.sum("n").alias("rank")), "near-rank")
    wanted = docs.join(rank.select("doc_id").hint("merge"), "doc_id", "left_semi")  # grows with the corpus: never broadcast
    sets = stored(shingle_sets(wanted, words), "near-sets")
    members = stored(members.select("key", "doc_id").join(rank, "doc_id"), "near-ranked")
    tested = stored(_verified(stored(_stars(members), "near-stars"), sets, p, q), "near-tested")
    labels = stored(components(_links(tested).select("a", "b")), "near-labels")
    groups = stored(_rare_groups(members, labels, sets, p, q).join(rank, "doc_id"), "near-groups")
    centers = 1
    while not groups.isEmpty():
        pairs, groups = _untested(groups, labels, centers, p, q)
        stars = stored(pairs.join(tested.select("center", "member"), ["center", "member"], "left_anti"), "near-stars")
        groups, centers = stored(groups, "near-left"), centers * MORE_CENTERS
        if stars.isEmpty():
            continue
        fresh = stored(_verified(stars, sets, p, q), "near-tested")
        tested = tested.unionByName(fresh)
        if not fresh.where("linked").isEmpty():
            labels = stored(components(_links(tested).select("a", "b")), "near-labels")
    return stored(_links(tested).distinct(), "near-links")


def _links(tested: DataFrame) -> DataFrame:
    return tested.where("linked").select(F.least("center", "member").alias("a"), F.greatest("center", "member").alias("b"), "similarity")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, text_class, class_id, class_size, kept): the near-duplicate class of every document.

    Similarity is the Jaccard similarity of the sets of shingles of ``words``
    words, a word being what stands between ASCII white space. Texts with the
    same distinct shingles form one text class, named by its smallest doc_id;
    text classes that links connect form one class, named likewise, whose
    smallest document is kept. A text shorter than a shingle is one shingle of
    all its words. Null texts and texts without words stand alone. doc_id must be
    unique; other columns are ignored. An empty table gives an empty result.
    """
    signed = stored(sketches(docs, bands, rows, words), "near-sketches")
    marked = signed.where(F.col("fp_high").isNotNull())
    classes = stored(marked.groupBy("fp_high", "fp_low").agg(F.min("doc_id").alias("text_class"), F.count(F.lit(1)).alias("n")),
                     "near-classes")
    copies = classes.where("n > 1")
    member_of = (signed.select("doc_id", "fp_high", "fp_low").join(copies, ["fp_high", "fp_low"], "left")
                 .select("doc_id", F.coalesce("text_class", "doc_id").alias("text_class")))
    member_of = stored(member_of, "near-membership")
    heads = signed.join(member_of.where("doc_id = text_class").select("doc_id"), "doc_id", "left_semi")
    heads = stored(heads.where(F.col("bands").isNotNull()).select("doc_id", "bands"), "near-heads")
    links = near_links(docs, heads, similarity, words)
    joined = components(links.select("a", "b")).select(F.col("id").alias("text_class"), "component_id")
    placed = stored(member_of.join(joined, "text_class", "left")
                    .select("doc_id", "text_class", F.coalesce("component_id", "text_class").alias("class_id")), "near-placed")
    sizes = stored(placed.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")).where("class_size > 1"), "near-sizes")
    return placed.join(sizes, "class_id", "left").select(
        "doc_id", "text_class", "class_id", F.coalesce("class_size", F.lit(1)).cast("bigint").alias("class_size"),
        (F.col("doc_id") == F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without all but the smallest document of each near-duplicate class; columns as they are."""
    dropped = stored(near_duplicates(docs, similarity).where(~F.col("kept")).select(F.col("doc_id").alias("dropped_id")), "near-dropped")
    return docs.join(dropped.hint("merge"), docs["doc_id"] == dropped["dropped_id"], "left_anti")
