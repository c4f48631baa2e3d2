"""Patient-code graph, Jaccard similarity and random walk with restart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.operators.ordering import with_row_number
from cohortlens.session import checkpointed

CODE_KINDS = ("diagnostic", "lab", "medication")
#: Prefix rows of one code that one task joins.
HEAVY_ROWS = 20_000
#: Prefix rows dealt by code at a time; about a gigabyte of shuffle files for sets of up to ``WHOLE_CODES`` codes.
ROWS_PER_PASS = 10_000_000
#: Sets up to this size are compared where they meet; larger ones by signature first.
WHOLE_CODES = 128
EDGES_PER_SPLIT = 1_000_000
#: A vertex with more edges out is pushed to its receivers' tasks; there is at most one for so many edges.
HEAVY_EDGES = 10_000
#: Links that one task of a push round holds.
LINKS_PER_TASK = 1_000_000
ROUNDS_PER_CHECKPOINT = 5
SIGNATURE_WORDS = 4


# --- graph construction ---------------------------------------------------

def latest_records(records: DataFrame, keys: Sequence[str], date: str,
                   payload: Sequence[str]) -> DataFrame:
    """The record with the greatest date per key; ties go to the greatest payload."""
    newest = F.max(F.struct(F.col(date), *[F.col(c) for c in payload])).alias("r")
    return records.groupBy(*keys).agg(newest).select(
        *keys, F.col(f"r.{date}").alias(date), *[F.col(f"r.{c}").alias(c) for c in payload])


def code_vertices(records: DataFrame, patients: DataFrame) -> DataFrame:
    """(id, kind, key) of the codes, numbered after the largest patient id of both inputs.

    ``records`` has ``kind`` and ``code``; kinds follow each other in
    ``CODE_KINDS`` order, codes in code order, so id ranges never collide.
    """
    ids = patients.select("patient_id").unionByName(records.select("patient_id"))
    start = ids.agg(F.max("patient_id")).first()[0] or 0
    place = F.array_position(F.array(*[F.lit(k) for k in CODE_KINDS]), F.col("kind"))
    distinct = records.select("kind", "code").distinct().withColumn("place", place.cast("int"))
    numbered = with_row_number(distinct, ["place", "code"], "n")
    return numbered.select((F.col("n") + F.lit(start)).alias("id"), "kind", F.col("code").alias("key"))


def graph_vertices(records: DataFrame, patients: DataFrame) -> DataFrame:
    ids = patients.select("patient_id").unionByName(records.select("patient_id"))
    people = ids.where(F.col("patient_id").isNotNull()).select(F.col("patient_id").alias("id"), F.lit("patient").alias("kind"),
                             F.col("patient_id").cast("string").alias("key")).distinct()
    return people.unionByName(code_vertices(records, patients))


def graph_edges(records: DataFrame, patients: DataFrame) -> DataFrame:
    """Latest record per patient and code as an edge in both directions."""
    latest = latest_records(records, ["patient_id", "kind", "code"], "date", ["value"])
    codes = code_vertices(records, patients).withColumnRenamed("key", "code")
    joined = latest.join(codes, ["kind", "code"])
    ends = F.explode(F.array(
        F.struct(F.col("patient_id").alias("src"), F.col("id").alias("dst")),
        F.struct(F.col("id").alias("src"), F.col("patient_id").alias("dst"))))
    return (joined.select(ends.alias("e"), "kind", "date", "value")
            .select("e.src", "e.dst", "kind", "date", "value"))


# --- Jaccard --------------------------------------------------------------

def jaccard_one_vs_all(pairs: DataFrame, patient_id: int,
                       patients: DataFrame | None = None) -> DataFrame:
    """Everyone else ranked by Jaccard similarity of their codes to one patient's.

    ``pairs`` holds distinct (patient_id, code). Patients without codes score 0.
    """
    own = checkpointed(pairs.where(F.col("patient_id") == patient_id).select("code", F.lit(1).alias("hit")))
    own_size = own.count()
    counts = (pairs.join(own, "code", "left").groupBy("patient_id")
              .agg(F.count(F.lit(1)).alias("size"), F.count("hit").alias("n_shared")))
    if patients is not None:
        counts = patients.select("patient_id").distinct().join(counts, "patient_id", "left")
    union = F.col("size") + F.lit(own_size) - F.col("n_shared")
    scored = (counts.where(F.col("patient_id") != patient_id)
              .select("patient_id", F.coalesce(F.try_divide(F.col("n_shared").cast("double"), union),
                                               F.lit(0.0)).alias("similarity")))
    return rank_by(scored, "similarity", "patient_id")


def rank_by(df: DataFrame, score: str, tiebreak: str) -> DataFrame:
    return (with_row_number(df.withColumn("__neg", -F.col(score)), ["__neg", tiebreak], "rank")
            .drop("__neg"))


def code_sets(pairs: DataFrame) -> DataFrame:
    """(patient_id, tokens, size): each patient's codes as sorted numbers.

    Codes are numbered from the rarest to the most common, so the head of
    ``tokens`` is the set's rarest codes.
    """
    frequency = pairs.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    tokens = with_row_number(frequency, ["n", "code"], "token").select("code", "token")
    sets = (pairs.join(tokens, "code").groupBy("patient_id")
            .agg(F.sort_array(F.collect_list("token")).alias("tokens")))
    return sets.withColumn("size", F.size("tokens"))


def distinct_sets(sets: DataFrame) -> DataFrame:
    """Each code set once, named by the smallest patient that has it."""
    return sets.groupBy("tokens", "size").agg(F.min("patient_id").alias("set_id"),
                                              F.count(F.lit(1)).alias("n_members"))


def _signature_word(word: int) -> Column:
    """Bits of the tokens that fall into one 64-bit word of the set's signature."""
    def put(acc: Column, token: Column) -> Column:
        here = F.floor(F.pmod(token, F.lit(64 * SIGNATURE_WORDS)) / 64) == word
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(token, F.lit(64)).cast("int"))
        return F.when(here, acc.bitwiseOR(bit)).otherwise(acc)
    return F.aggregate("tokens", F.lit(0).cast("bigint"), put)


def similar_sets(distinct: DataFrame, min_similarity: float, heavy_rows: int = HEAVY_ROWS,
                 rows_per_pass: int = ROWS_PER_PASS) -> DataFrame:
    """All pairs of distinct sets with Jaccard similarity >= ``min_similarity`` > 0.

    Exact prefix-filtered join. Two sets of sizes a and b reaching similarity t
    share at least o = ceil(t/(1+t) * (a+b)) codes, hence one among the rarest
    a-o+1 of the one and b-o+1 of the other. Only those prefixes are joined.
    The most common code is last in its set, so it is joined on only where one
    shared code already makes a result.

    A row of a set of at most ``WHOLE_CODES`` codes carries the codes that
    follow its own, so two such sets are compared where they meet: at their
    first shared code the followers tell the whole number, and only pairs that
    pass are written. Larger sets carry a signature instead, which keeps rows
    short; its differing bits, and the number of shared prefix codes plus what
    can still follow the last of them outside one of the prefixes, leave few
    pairs to intersect.

    Both sides read one dealing of the rows by code. A code in more than
    ``heavy_rows`` prefixes is met in a grid: its rows are cut by the hash of
    their set into blocks of about that size, and each cell of the grid joins
    one block of either side.

    Codes are dealt in passes of about ``rows_per_pass`` rows, each of which
    stores what it met per pair, so the shuffle files of one pass at a time lie
    on disk.
    """
    if not 0 < min_similarity <= 1:
        raise ValueError("min_similarity must lie in (0, 1]")
    t = float(min_similarity)
    words = [f"w{w}" for w in range(SIGNATURE_WORDS)]

    def overlap_needed(a: Column, b: Column) -> Column:
        return F.greatest(F.ceil(F.lit(t / (1 + t)) * (a + b) - 1e-9), F.lit(1))

    size = F.col("size")
    whole = size <= WHOLE_CODES
    smallest = F.greatest(F.ceil(F.lit(t) * size - 1e-9), F.lit(1)).cast("int")
    keep = (size - overlap_needed(size, smallest) + 1).cast("int")
    sets = checkpointed(distinct.select("set_id", "tokens", "size"))
    signed = sets.select("set_id", "size", "tokens", keep.alias("keep"),
                         *[F.when(~whole, _signature_word(w)).alias(name) for w, name in enumerate(words)])
    followers = F.when(whole, F.slice("tokens", F.col("pos") + 2, F.greatest(size - F.col("pos") - 1, F.lit(0))))
    rows = (signed.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.col("keep"))).alias("pos", "token"))
            .select("token", "set_id", "size", "pos", (size - F.col("keep")).cast("int").alias("rest"),
                    F.transform(followers, lambda x: x.cast("int")).alias("after"), *words))
    # at most one in ``heavy_rows`` of the rows
    heavy = checkpointed(rows.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / heavy_rows).cast("int").alias("blocks"))
                         .where("blocks > 1"))

    def side(name: str, df: DataFrame) -> DataFrame:
        return df.select("token", *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in ("token", "a_block", "b_block")],
                         *[c for c in df.columns if c in ("a_block", "b_block")])

    def in_grid(part: DataFrame, own: str, other: str) -> DataFrame:
        found = part.join(F.broadcast(heavy), "token")
        return (found.withColumn(own, F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"))

    a, b = F.col("a_size"), F.col("b_size")
    smaller = (b < a) | ((b == a) & (F.col("b_set_id") < F.col("a_set_id")))
    needed = overlap_needed(a, b)
    both_whole = (a <= WHOLE_CODES) & (b <= WHOLE_CODES)
    in_reach = (a - F.col("a_pos") >= needed) & (b - F.col("b_pos") >= needed)
    shared_from_here = F.size(F.array_intersect("a_after", "b_after")) + 1
    differing = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in words), F.lit(0))
    possible = F.coalesce((a + b - differing) / 2 >= needed, F.lit(True))
    passes = smaller & (b >= F.lit(t) * a - 1e-9) & F.when(both_whole, in_reach & (shared_from_here >= needed)).otherwise(possible)

    def meet(part: DataFrame) -> DataFrame:
        light = part if no_heavy else part.join(F.broadcast(heavy.select("token")), "token", "left_anti")
        dealt = light.repartition("token")
        cells = side("a", dealt).join(side("b", dealt).hint("merge"), "token").where(passes)
        if not no_heavy:
            grid = side("a", in_grid(part, "a_block", "b_block")).join(side("b", in_grid(part, "b_block", "a_block")), ["token", "a_block", "b_block"])
            cells = cells.unionByName(grid.where(passes).select(*cells.columns))
        return (cells.groupBy("a_set_id", "b_set_id")
                .agg(F.max(F.when(both_whole, shared_from_here)).alias("n_shared"),
                     F.count(F.lit(1)).alias("n_met"), F.max(a).alias("a_size"), F.max(b).alias("b_size"),
                     F.max(F.greatest("a_rest", "b_rest")).alias("rest"),
                     F.max("a_pos").alias("a_last"), F.max("b_pos").alias("b_last")))

    no_heavy = heavy.isEmpty()
    n_rows = signed.agg(F.sum("keep")).first()[0] or 0
    turns = max(1, -(-n_rows // rows_per_pass))
    met = None
    for turn in range(turns):
        part = rows if turns == 1 else rows.where(F.pmod(F.xxhash64("token"), F.lit(turns)) == turn)
        one = checkpointed(meet(part))
        met = one if met is None else met.unionByName(one)
    if turns > 1:
        highest = ("n_shared", "a_size", "b_size", "rest", "a_last", "b_last")
        met = checkpointed(met.groupBy("a_set_id", "b_set_id").agg(F.sum("n_met").alias("n_met"), *[F.max(c).alias(c) for c in highest]))

    # shared codes outside a prefix come after all others, and from the first of
    # them on all lie outside that same prefix
    left = F.least(a - F.col("a_last") - 1, b - F.col("b_last") - 1, F.col("rest"))
    open_pairs = met.where(F.col("n_shared").isNull() & (F.col("n_met") + left >= needed)).drop("n_shared")
    counted = (open_pairs
               .join(sets.select(F.col("set_id").alias("a_set_id"), F.col("tokens").alias("a_tokens")), "a_set_id")
               .join(sets.select(F.col("set_id").alias("b_set_id"), F.col("tokens").alias("b_tokens")), "b_set_id")
               .withColumn("n_shared", F.size(F.array_intersect("a_tokens", "b_tokens"))))
    columns = ["a_set_id", "b_set_id", "a_size", "b_size", "n_shared"]
    similarity = F.col("n_shared") / (a + b - F.col("n_shared"))
    return (met.where(F.col("n_shared").isNotNull()).select(*columns).unionByName(counted.select(*columns))
            # the count decides; the ratio is only worked out for pairs that pass
            .where((F.col("n_shared") >= needed) & (similarity >= t))
            .select(F.least("a_set_id", "b_set_id").alias("patient_a"), F.greatest("a_set_id", "b_set_id").alias("patient_b"),
                    "n_shared", similarity.alias("similarity")))


def jaccard_sets(pairs: DataFrame, min_similarity: float, heavy_rows: int = HEAVY_ROWS) -> tuple[DataFrame, DataFrame]:
    """Members (set_id, patient_id) of each distinct code set, and the similar pairs of sets.

    The compact form of ``jaccard_pairs``: a set is named by its smallest
    patient, and equal patients are not spelled out.
    """
    sets = checkpointed(code_sets(checkpointed(pairs.select("patient_id", "code"))))
    distinct = checkpointed(distinct_sets(sets))
    members = checkpointed(sets.join(distinct.select("tokens", "set_id"), "tokens")
                           .select("set_id", "patient_id", F.size("tokens").alias("size")))
    return members, similar_sets(distinct, min_similarity, heavy_rows)


def jaccard_pairs(pairs: DataFrame, min_similarity: float, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """All patient pairs (a < b) with similarity >= ``min_similarity``; none is left out.

    A pair absent from the result is below the threshold. The result grows with
    the square of a group of equal patients; ``jaccard_sets`` does not.
    """
    members, similar = jaccard_sets(pairs, min_similarity, heavy_rows)
    one = members.select(F.col("set_id").alias("patient_a"), F.col("patient_id").alias("one"), "size")
    two = members.select(F.col("set_id").alias("patient_b"), F.col("patient_id").alias("two"))
    ends = (F.least("one", "two").alias("patient_a"), F.greatest("one", "two").alias("patient_b"))
    between = similar.join(one.drop("size"), "patient_a").join(two, "patient_b").select(*ends, "n_shared", "similarity")
    equal = (one.join(two.withColumnRenamed("patient_b", "patient_a"), "patient_a").where("one < two")
             .select(*ends, F.col("size").alias("n_shared"), F.lit(1.0).alias("similarity")))
    return between.unionByName(equal)


# --- random walk with restart ---------------------------------------------

def random_walk(edges: DataFrame, source: int, steps: int = 100, restart: float = 0.15,
                vertices: DataFrame | None = None,
                edges_per_split: int = EDGES_PER_SPLIT) -> DataFrame:
    """(id, rank) after ``steps`` rounds of a walk that restarts at ``source``.

    A vertex that receives nothing in a round keeps its rank. A vertex with very
    many edges is split into pieces of ``edges_per_split``; its rank is copied
    to each piece, so no single task holds all its edges.
    """
    ends = checkpointed(edges.select("src", "dst"))
    degree = ends.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).select(
        F.col("src").alias("id"), (1.0 / F.col("degree")).alias("weight"),
        F.ceil(F.col("degree") / edges_per_split).cast("int").alias("splits"))
    links = (ends.join(degree.withColumnRenamed("id", "src"), "src")
             .withColumn("piece", F.pmod(F.xxhash64("dst"), F.col("splits")).cast("int"))
             .select("src", "piece", "dst", "weight"))
    links = links.repartition("src", "piece").persist()

    known = ends.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    if vertices is not None:
        known = known.unionByName(vertices.select("id")).distinct()
    start = F.when(F.col("id") == source, F.lit(float(restart))).otherwise(F.lit(0.0))
    ranks = (known.join(degree.select("id", "splits"), "id", "left")
             .select("id", F.coalesce("splits", F.lit(0)).alias("splits"), start.alias("rank")))
    ranks = checkpointed(ranks)
    held: list[DataFrame] = []
    for step in range(1, steps + 1):
        sent = (ranks.where((F.col("splits") > 0) & (F.col("rank") > 0))
                .select(F.col("id").alias("src"), "rank",
                        F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("piece")))
        inbox = (links.join(sent, ["src", "piece"], "left").groupBy(F.col("dst").alias("id"))
                 .agg(F.sum(F.coalesce("rank", F.lit(0.0)) * F.col("weight")).alias("received")))
        jump = F.when(F.col("id") == source, F.lit(float(restart))).otherwise(F.lit(0.0))
        ranks = (ranks.join(inbox, "id", "left")
                 .select("id", "splits", F.coalesce(jump + (1.0 - restart) * F.col("received"),
                                                    F.col("rank")).alias("rank")))
        if step % ROUNDS_PER_CHECKPOINT == 0 or step == steps:
            ranks = checkpointed(ranks)
            for old in held:
                old.unpersist()
            held = []
        else:
            # read twice by the next round, so kept; the checkpoint bounds its lineage
            ranks = ranks.persist()
            held.append(ranks)
    links.unpersist()
    return ranks.select("id", "rank")


def push_walk(edges: DataFrame, source: int, steps: int = 100, restart: float = 0.15,
              tolerance: float = 1e-6, vertices: DataFrame | None = None,
              edges_per_split: int = HEAVY_EDGES) -> DataFrame:
    """(id, rank, residual) of the walk of ``random_walk``, by pushing residuals.

    All mass starts as residual of ``source``. In a round every vertex whose
    residual exceeds ``tolerance / 2`` per edge of the graph times its degree
    keeps the share ``restart`` as rank and sends the rest along its edges; the
    others wait, so a round costs the edges of its senders only. Waiting mass is
    at most ``tolerance / 2`` in all. Rounds end once all residuals together are
    within ``tolerance`` (looked at every ``ROUNDS_PER_CHECKPOINT`` rounds), or
    after ``steps + 1``. No rank exceeds that of ``steps`` full rounds, and all
    ranks together fall short of it by at most ``tolerance``.

    Links lie by their source, and a round shuffles what their tasks have summed
    per receiver. The links of a vertex with more than ``edges_per_split`` edges lie
    by their receivers instead, and its value is sent to all tasks; so neither a
    hub nor the many receivers of a hub move one row per edge.

    Repeated edges count as often as they occur; a null end drops the edge. A
    vertex without edges out keeps its share, the rest of its residual is gone;
    a source in no edge and not in ``vertices`` gives zeros.
    """
    ends = checkpointed(edges.select("src", "dst").dropna())
    degree = ends.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    n_edges = ends.count()
    pieces = max(ends.sparkSession.sparkContext.defaultParallelism, -(-n_edges // LINKS_PER_TASK))
    heavy = F.col("degree") > edges_per_split
    # at most one in ``edges_per_split`` of the edges
    hubs = checkpointed(degree.where(heavy).select("src"))
    links = ends.join(F.broadcast(hubs), "src", "left_anti").repartition(pieces, "src").sortWithinPartitions("src").persist()
    hub_links = ends.join(F.broadcast(hubs), "src").select("src", "dst").repartition(pieces, "dst").persist()
    per_edge = tolerance / 2 / max(n_edges, 1)

    known = ends.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    if vertices is not None:
        known = known.unionByName(vertices.select("id")).distinct()
    state = checkpointed(known.join(degree.withColumnRenamed("src", "id"), "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree"), F.lit(0.0).alias("rank"),
        F.when(F.col("id") == source, 1.0).otherwise(0.0).alias("residual")))
    held: list[DataFrame] = []
    sends = F.col("residual") > per_edge * F.col("degree")
    for step in range(1, steps + 2):
        sent = state.where(sends & (F.col("degree") > 0)).select(
            F.col("id").alias("src"), ((1.0 - restart) * F.col("residual") / F.col("degree")).alias("sent"), heavy.alias("heavy"))
        pushed = [links.join(sent.where(~F.col("heavy")).hint("merge"), "src"), hub_links.join(F.broadcast(sent.where("heavy")), "src")]
        kept = state.select("id", "degree", (F.col("rank") + F.when(sends, restart * F.col("residual")).otherwise(0.0)).alias("rank"),
                            F.when(sends, 0.0).otherwise(F.col("residual")).alias("residual"))
        light, hub = (p.groupBy(F.col("dst").alias("id")).agg(F.sum("sent").alias("residual")) for p in pushed)
        received = light.unionByName(hub).select("id", F.lit(None).cast("bigint").alias("degree"), F.lit(0.0).alias("rank"), "residual")
        # what is kept and what arrives meet in one aggregate; arriving mass is summed before the shuffle
        state = kept.unionByName(received).groupBy("id").agg(
            F.max("degree").alias("degree"), F.sum("rank").alias("rank"), F.sum("residual").alias("residual"))
        if step % ROUNDS_PER_CHECKPOINT == 0 or step == steps + 1:
            state = checkpointed(state)
            for old in held:
                old.unpersist()
            held = []
            if (state.agg(F.sum("residual")).first()[0] or 0.0) <= tolerance:
                break
        else:
            # read twice by the next round, so kept; the checkpoint bounds its lineage
            state = state.persist()
            held.append(state)
    links.unpersist()
    hub_links.unpersist()
    return state.select("id", "rank", "residual")


def ranked_patients(ranks: DataFrame, patients: DataFrame, source: int) -> DataFrame:
    """Patients other than ``source`` by rank descending, then id."""
    people = patients.select(F.col("patient_id").alias("id")).distinct()
    others = (people.join(ranks, "id").where(F.col("id") != source)
              .select(F.col("id").alias("patient_id"), F.col("rank").alias("score")))
    return rank_by(others, "score", "patient_id")
