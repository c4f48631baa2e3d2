import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import clustering, graph
from cohortlens.plans.workloads import patient_similarity


def pairs_frame(spark, sets):
    return spark.createDataFrame([(p, c) for p, codes in sets.items() for c in codes], "patient_id long, code string")


def expand(found, sets):
    """Similarity of every patient pair from pairs of representatives."""
    rep, rows = {p: p for p in sets}, [(r["patient_a"], r["patient_b"], r["similarity"]) for r in found]
    for a, b, s in rows:
        if sets[a] == sets[b]:
            rep[b] = a
    by_rep = {(a, b): s for a, b, s in rows}
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        key = tuple(sorted((rep[a], rep[b])))
        s = 1.0 if key[0] == key[1] else by_rep.get(key)
        if s is not None:
            out[(a, b)] = s
    return out


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.34, 0.5, 0.75, 1.0])
def test_pairs_match_brute_force(spark, threshold):
    rng = random.Random(int(threshold * 100))
    codes = [f"c{i}" for i in range(40)]
    sets = {}
    for p in range(120):
        base = {"hot"} if p % 3 == 0 else set()          # one code on a third of the patients
        sets[p] = frozenset(base | set(rng.sample(codes, rng.choice([1, 2, 3, 6, 12, 25]))))
    for p in range(120, 150):                            # a group of equal sets, and its neighbours
        sets[p] = frozenset({"hot", "c1"})
    # a code on a third of the patients is met in a grid of blocks
    found = graph.jaccard_pairs(pairs_frame(spark, sets), threshold, heavy_rows=1 + int(threshold * 60)).collect()
    assert len({(r[0], r[1]) for r in found}) == len(found)
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        s = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if s >= threshold:
            want[(a, b)] = s
    got = {(r[0], r[1]): r["similarity"] for r in found}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("threshold", [0.03, 0.3])
def test_pairs_of_small_and_large_sets_match_brute_force(spark, threshold, monkeypatch):
    monkeypatch.setattr(graph, "WHOLE_CODES", 8, raising=False)
    rng = random.Random(5)
    sets = {p: frozenset(rng.sample(range(60), rng.choice([1, 3, 7, 8, 9, 20, 40]))) for p in range(90)}
    pairs = spark.createDataFrame([(p, c) for p, codes in sets.items() for c in codes], "patient_id long, code long")
    want = {(a, b): (len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a, b in itertools.combinations(sets, 2)}
    want = {k: (n, n / u) for k, (n, u) in want.items() if n / u >= threshold}
    for heavy_rows in (4, 1000):
        found = {(r["patient_a"], r["patient_b"]): (r["n_shared"], r["similarity"])
                 for r in graph.jaccard_pairs(pairs, threshold, heavy_rows).collect()}
        assert found == want


def test_only_similar_pairs_of_sets_are_written(spark, monkeypatch):
    stored, store = [], graph.checkpointed
    monkeypatch.setattr(graph, "checkpointed", lambda df: stored.append(store(df)) or stored[-1])
    rng = random.Random(9)
    rows = [(p, c) for p in range(300) for c in rng.sample(range(400), 40)]
    distinct = graph.distinct_sets(graph.code_sets(spark.createDataFrame(rows, "patient_id long, code long")))
    similar = graph.similar_sets(distinct, 0.08).count()
    written = [df.count() for df in stored if "b_set_id" in df.columns]
    assert 0 < similar < 300 * 299 // 4 and written == [similar]


def test_pairs_of_equal_patients_are_complete(spark):
    sets = {1: {"a", "b"}, 2: {"a", "b"}, 3: {"a", "b"}, 4: {"b", "c"}}
    found = {(r[0], r[1]) for r in graph.jaccard_pairs(pairs_frame(spark, sets), 0.1).collect()}
    assert found == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}


def test_code_ids_follow_the_patients_of_both_inputs(spark):
    patients = spark.createDataFrame([(1,), (2,)], "patient_id long")
    kind, day = graph.CODE_KINDS[0], dt.date(2020, 1, 1)
    records = spark.createDataFrame([(1, kind, "a", day, 1.0), (3, kind, "a", day, 2.0)],
                                    "patient_id long, kind string, code string, date date, value double")
    vertices = {(r["id"], r["kind"], r["key"]) for r in graph.graph_vertices(records, patients).collect()}
    assert vertices == {(1, "patient", "1"), (2, "patient", "2"), (3, "patient", "3"), (4, kind, "a")}
    edges = {(r["src"], r["dst"]) for r in graph.graph_edges(records, patients).collect()}
    assert edges == {(1, 4), (4, 1), (3, 4), (4, 3)}


def test_power_iteration_on_sets_equals_the_spelled_out_graph(spark):
    rng, sets = random.Random(3), {}
    for p in range(90):
        base = [f"{p % 3}{i}" for i in range(6)]
        sets[p] = frozenset(rng.sample(base, 5 if p % 3 else 4) + (["shared"] if p % 7 == 0 else []))
    pairs = pairs_frame(spark, {**sets, 99: {"alone"}})
    found = clustering.power_iteration_sets(*graph.jaccard_sets(pairs, 0.3), k=3).collect()
    assert {r["id"] for r in found} == set(sets) and found[0]["converged"] and found[0]["rounds"] <= 100
    # the same rounds over all pairs of patients, in a plain loop
    import numpy as np
    a = np.asarray([[len(sets[p] & sets[q]) / len(sets[p] | sets[q]) if p != q else 0.0 for q in sets] for p in sets])
    a[a < 0.3] = 0
    v = a.sum(axis=1) / a.sum()
    for _ in range(found[0]["rounds"]):
        v = a @ v / a.sum(axis=1)
        v /= v.sum()
    group = {r["id"]: r["cluster"] for r in found}
    spans = sorted((min(v[p] for p in group if group[p] == c), max(v[p] for p in group if group[p] == c)) for c in set(group.values()))
    assert len(spans) == 3 and all(x[1] < y[0] + 1e-12 for x, y in zip(spans, spans[1:]))


def test_threshold_is_checked(spark):
    with pytest.raises(ValueError):
        graph.jaccard_pairs(pairs_frame(spark, {1: {"a"}}), 0)


def test_one_vs_all_ranks_everyone_else(spark):
    sets = {1: {"a", "b"}, 2: {"a", "b"}, 3: {"b", "c"}, 4: {"z"}}
    people = spark.createDataFrame([(i,) for i in range(1, 6)], "patient_id long")
    found = graph.jaccard_one_vs_all(pairs_frame(spark, sets), 1, people).orderBy("rank").collect()
    assert [(r["patient_id"], round(r["similarity"], 3)) for r in found] == [
        (2, 1.0), (3, 0.333), (4, 0.0), (5, 0.0)]


def test_patient_without_codes_has_no_similarity(spark):
    people = spark.createDataFrame([(1,), (2,)], "patient_id long")
    found = graph.jaccard_one_vs_all(pairs_frame(spark, {2: {"a"}}), 1, people).collect()
    assert [tuple(r) for r in found] == [(2, 0.0, 1)]


RECORDS = "patient_id long, kind string, code string, date date, value double"


def records(spark):
    d = dt.date
    return spark.createDataFrame([
        (1, "lab", "L1", d(2000, 1, 1), 1.0), (1, "lab", "L1", d(2000, 1, 2), 2.0), (1, "lab", "L1", d(2000, 1, 2), 3.0),
        (1, "diagnostic", "D1", d(2000, 1, 1), 0.0), (2, "diagnostic", "D1", d(2000, 1, 1), 0.0),
        (2, "medication", "M1", d(2000, 1, 1), 0.0), (3, "lab", "L1", d(2000, 1, 5), 9.0)], RECORDS)


def people(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "patient_id long")


def test_latest_record_breaks_ties(spark):
    found = graph.latest_records(records(spark), ["patient_id", "kind", "code"], "date", ["value"])
    assert found.where("patient_id = 1 and code = 'L1'").first()["value"] == 3.0


def test_vertices_and_edges(spark):
    vertices = {r["key"]: r["id"] for r in graph.graph_vertices(records(spark), people(spark)).collect()}
    assert vertices == {"1": 1, "2": 2, "3": 3, "D1": 4, "L1": 5, "M1": 6}
    edges = {(r["src"], r["dst"]) for r in graph.graph_edges(records(spark), people(spark)).collect()}
    assert len(edges) == 10 and all((b, a) in edges for a, b in edges)


def walk_by_hand(edges, source, steps, a=0.15):
    out = {}
    for s, _ in edges:
        out[s] = out.get(s, 0) + 1
    nodes = {n for e in edges for n in e}
    rank = {n: a if n == source else 0.0 for n in nodes}
    for _ in range(steps):
        got = {}
        for s, d in edges:
            got[d] = got.get(d, 0.0) + rank[s] / out[s]
        rank = {n: (a * (n == source) + (1 - a) * got[n]) if n in got else rank[n] for n in nodes}
    return rank


@pytest.mark.parametrize("split", [1, 1_000_000])
def test_walk_matches_by_hand(spark, split):
    edges = [(1, 10), (10, 1), (1, 11), (11, 1), (2, 11), (11, 2), (3, 11)]   # 3 receives nothing
    frame = spark.createDataFrame(edges, "src long, dst long")
    found = {r["id"]: r["rank"] for r in graph.random_walk(frame, 1, 7, edges_per_split=split).collect()}
    want = walk_by_hand(edges, 1, 7)
    assert found.keys() == want.keys() and all(abs(found[n] - want[n]) < 1e-12 for n in want)


@pytest.mark.parametrize("split, tolerance", [(1, 1e-1), (1_000_000, 1e-3)])
def test_push_walk_is_within_its_tolerance(spark, split, tolerance):
    # 1 - 2 is listed twice, 4 has no way out, 5 no way in, 20 is a hub
    edges = [(1, 2), (1, 2), (2, 1), (2, 3), (3, 2), (3, 4), (5, 1), *[(i, 20) for i in (1, 2, 3)], *[(20, i) for i in (1, 2, 3, 4)]]
    frame = spark.createDataFrame([*edges, (None, 1), (1, None)], "src long, dst long")
    rows = graph.push_walk(frame, 1, tolerance=tolerance, edges_per_split=split).collect()
    want = walk_by_hand(edges, 1, 100)
    short = {r["id"]: want[r["id"]] - r["rank"] for r in rows}
    assert short.keys() == want.keys() and min(short.values()) > -1e-12
    assert sum(short.values()) <= tolerance and sum(r["residual"] for r in rows) <= tolerance


def test_push_walk_of_few_steps_and_odd_sources(spark):
    edges = [(1, 10), (10, 1), (1, 11), (11, 1), (2, 11), (11, 2)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    found = {r["id"]: r["rank"] for r in graph.push_walk(frame, 1, steps=6, tolerance=1e-15).collect()}
    want = walk_by_hand(edges, 1, 6)
    assert found.keys() == want.keys() and all(abs(found[n] - want[n]) < 1e-12 for n in want)
    assert {r["rank"] for r in graph.push_walk(frame, 99, tolerance=1e-3).collect()} == {0.0}
    alone = graph.push_walk(frame, 99, tolerance=1e-3, vertices=spark.range(99, 100)).where("id = 99").collect()
    assert [r["rank"] for r in alone] == [0.15]
    assert graph.push_walk(frame.limit(0), 1).count() == 0


def test_walk_mass(spark):
    edges = graph.graph_edges(records(spark), people(spark))
    ranks = graph.random_walk(edges, 1, 6)
    assert abs(ranks.agg(F.sum("rank")).first()[0] - (1 - 0.85 ** 7)) < 1e-12
    assert [r["patient_id"] for r in graph.ranked_patients(ranks, people(spark), 1).orderBy("rank").collect()] in (
        [2, 3], [3, 2])


def test_power_iteration_separates_components(spark):
    rows = [(a, b, 1.0) for g in ((1, 2, 3), (11, 12, 13)) for a, b in itertools.combinations(g, 2)]
    rows.append((3, 11, 0.001))
    frame = spark.createDataFrame(rows, "patient_a long, patient_b long, similarity double")
    found = {r["id"]: r["cluster"] for r in clustering.power_iteration(frame, 2, 20).collect()}
    assert len(found) == 6


def test_similarity_workload(spark):
    found = patient_similarity(records(spark), people(spark), 1, 0.2, steps=2, k=2)
    assert {(r[0], r[1]) for r in found["pairs"].collect()} == {(1, 2), (1, 3)}
    assert found["jaccard"].count() == 2 and found["walk"].count() == 2


def test_checkpoints_leave_no_shuffle_files_behind(spark):
    from cohortlens.session import SHUFFLE_CLEANUP_CONF, checkpointed

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in manager.getAllFiles().mkString(",").split(",") if "/shuffle_" in name}

    before = shuffled()
    kept = checkpointed(spark.range(10_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count())
    assert not shuffled() - before
    assert kept.count() == 100 and spark.conf.get(SHUFFLE_CLEANUP_CONF, None) in (None, "false")


@pytest.mark.parametrize("heavy_rows", [20_000, 5])
def test_similar_sets_in_passes(spark, heavy_rows):
    rng = random.Random(4)
    rows = [(n, sorted(rng.sample(range(60), rng.randint(1, 12)))) for n in range(80)]
    rows += [(100 + n, sorted(rng.sample(range(400), 150))) for n in range(6)]
    sets = spark.createDataFrame([(n, codes, len(codes)) for n, codes in rows], "set_id long, tokens array<long>, size int")
    found = graph.similar_sets(sets, 0.2, heavy_rows, rows_per_pass=100).collect()
    expected = {}
    for (x, one), (y, two) in itertools.combinations(rows, 2):
        shared = len(set(one) & set(two))
        if shared / len(set(one) | set(two)) >= 0.2:
            expected[x, y] = shared
    assert {(r["patient_a"], r["patient_b"]): r["n_shared"] for r in found} == expected and len(found) == len(expected)


def test_push_walk_moves_no_row_per_edge_of_a_hub(spark):
    # every leaf is joined to one hub: without the hub's own way a round shuffles a row per leaf and direction
    pairs = [(0, leaf) for leaf in range(1, 40)] + [(leaf, 0) for leaf in range(1, 40)] + [(1, 2), (2, 1), (1, 2)]
    frame = spark.createDataFrame(pairs, "src long, dst long")
    plain, split = ({r["id"]: (r["rank"], r["residual"]) for r in graph.push_walk(frame, 1, steps=6, tolerance=1e-15, edges_per_split=n).collect()}
                    for n in (1000, 3))
    assert plain.keys() == split.keys() and len(plain) == 40
    assert all(plain[v] == pytest.approx(split[v]) for v in plain)
    assert graph.HEAVY_EDGES <= 10_000
