"""Conversation repair against all edits of short conversations, and odd tables."""
import hashlib
import itertools
import re

import numpy as np
import pytest

from cohortlens.llm import repair
from cohortlens.llm.repair import BLANK, CLEAN, CUT, DUPLICATE

PATTERN = re.compile(r"(s?(ua)+)?")


def cheapest(codes, most_inserts=3):
    """Every sequence of edits with a few inserts; roles are given and inserted as they come."""
    best = None
    for inserts in range(most_inserts + 1):
        for where in itertools.combinations_with_replacement(range(len(codes) + 1), inserts):
            for choice in itertools.product("KDR", repeat=len(codes)):
                if any(e != "D" and c % 4 in (BLANK, DUPLICATE) for e, c in zip(choice, codes)):
                    continue
                audit = "".join("I" * where.count(i) + (choice[i] if i < len(codes) else "") for i in range(len(codes) + 1))
                cost, out, at = 0, "", 0
                for e in audit:
                    code = codes[at] if e != "I" else None
                    at += e != "I"
                    if e != "D":
                        out += "suax"[code // 4] if e == "K" else "a" if out.endswith("u") else "u"
                    cost += {"K": 0, "R": 2, "D": 3, "I": 2}[e] + (e in "KR" and code % 4 == CUT)
                if PATTERN.fullmatch(out) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_of_all_edits(seed):
    rng = np.random.default_rng(seed)
    codes = [int(4 * rng.choice(4, p=[.2, .4, .3, .1]) + rng.choice([CLEAN, BLANK, DUPLICATE, CUT], p=[.6, .1, .1, .2]))
             for _ in range(int(rng.integers(1, 5)))]
    for cuts in ([codes], [codes[:1], codes[1:]], [[c] for c in codes]):
        stretches = [tuple(c) for c in cuts if c]
        value, parts = repair.conversation_repair(stretches)
        assert value == cheapest(codes)
        assert "".join(edits for _, edits in parts) == value[1]
        known = [tuple(repair.stretch_items(s, p) for p in range(4)) for s in stretches]
        assert repair.conversation_repair(stretches, known) == (value, parts)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "q", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, cost int")


def test_a_long_conversation_in_stretches(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(9, i, str(rng.choice(["system", "user", "assistant", "tool"], p=[.1, .5, .3, .1])),
             str(rng.choice(["Yes.", "No", f"Turn {i}!", " "]))) for i in range(300)]
    rows += [(c, i, "user", f"{i}.") for c in range(20) for i in range(c % 4) if c != 9]
    reports, turns = [], []
    for bits in (2, 10):
        monkeypatch.setattr(repair, "LONG_STRETCH", 4)
        found = repair.Repair(frame(spark, rows).repartition(6), stretch_bits=bits)
        reports.append(sorted(map(tuple, found.report(frame(spark, rows)).collect())))
        turns.append(sorted(tuple(r) for r in found.turns().collect()))
    assert reports[0] == reports[1] and turns[0] == turns[1]
    by_id = {r[0]: r for r in reports[0]}
    own = [t for t in turns[0] if t[0] == "9"]
    assert [t[1] for t in own] == list(range(len(own)))
    joined = "\n".join(f"{t[3]}:{t[4]}" for t in own)
    assert by_id[9][-1] == hashlib.sha256(joined.encode()).hexdigest()
    assert PATTERN.fullmatch("".join(t[3][0] for t in own)) and len(by_id[9][-2]) >= 300


def test_nulls_repeats_and_empty_conversations(spark):
    rows = [(None, None, None, None), (1, None, "user", "Hi."), (1, 3, "assistant", "Yes. \t"), (1, 5, "assistant", "Yes. \t"),
            (2, 0, "", "x."), (3, 1, "user", "a\x1c"), (3, 2, "assistant", "")]
    turns = frame(spark, rows)
    ids = turns.unionByName(frame(spark, [(4, 0, "user", "gone")]))
    got = {r.conv_id: r for r in repair.Repair(turns).report(ids).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert (got[None].blank, got[None].cost, got[None].audit, got[None].repaired_sha256) == (1, 3, "D", empty)
    assert (got[1].gaps, got[1].duplicate, got[1].truncated, got[1].illegal, got[1].cost, got[1].audit) == (1, 1, 0, 1, 3, "KKD")
    assert got[1].repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes. \t").hexdigest()
    assert (got[2].illegal, got[2].audit, got[2].cost) == (0, "D", 3)
    assert (got[3].blank, got[3].truncated, got[3].audit, got[3].cost) == (1, 1, "DD", 6)
    assert tuple(got[4])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert repair.Repair(turns.limit(0)).report(turns.limit(0)).count() == 0


def test_damage_takes_each_lot(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)]
    got = repair.damage(frame(spark, rows)).collect()
    texts = {r.text for r in got}
    assert texts == {"", "One Two", "One. Two!"} and {r.role for r in got} == {"user", "assistant"}
    assert 0 < len({(r.conv_id, r.turn) for r in got}) < len(rows) and len(got) > len({(r.conv_id, r.turn) for r in got})
