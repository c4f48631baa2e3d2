"""Repair of conversation structure by Knuth's lightest-derivation agenda.

A conversation shall read ``(s?(ua)+)?`` in the initials of its roles. Turns may
be kept, given another role, deleted, and empty turns inserted. Items of the
deduction system say what has been read and where in the pattern the output
stands; each carries (cost, audit), the audit being the edits' initials in
order. Both combine monotonically and never decrease, so items are final when
they leave the agenda, and the first goal to leave it is the cheapest repair
with the least audit.

Turns are reduced to one small code each. Stretches of bounded length are
deduced on their own, from every place in the pattern to every other; a second
deduction joins the stretches of a conversation, each step from two antecedents,
the prefix and the stretch. Only the edits meet the texts again, which stream
past in order, so no conversation's texts are ever held.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import stored

#: Turns of a stretch: 2 to this power.
STRETCH_BITS = 10
#: Stretches of so many turns are deduced before they meet the others of their conversation.
LONG_STRETCH = 128
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
CLEAN, BLANK, DUPLICATE, CUT = range(4)
#: Places in the pattern: nothing written, after the system turn, after a user turn, after a pair.
START, SYSTEM, USER, PAIR = range(4)
_PLACES = (START, SYSTEM, USER, PAIR)
_INITIALS = "sua"
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_SPACE = " \t\n\x0b\x0c\r"
Value = tuple[int, str]


def lightest(axioms: Iterable[tuple[Hashable, Value]],
             deduce: Callable[[Hashable, Value], Iterable[tuple[Hashable, Value]]],
             goals: set[Hashable], all_goals: bool = False) -> dict[Hashable, tuple[Value, Hashable | None]]:
    """Final items with their values and last antecedents, until the first goal is final (or all of them)."""
    agenda = [(value, n, item, None) for n, (item, value) in enumerate(axioms)]
    heapq.heapify(agenda)
    done: dict[Hashable, tuple[Value, Hashable | None]] = {}
    best: dict[Hashable, Value] = {}
    pushed, open_goals = len(agenda), set(goals)
    while agenda and open_goals:
        value, _, item, source = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = (value, source)
        if item in open_goals:
            open_goals = open_goals - {item} if all_goals else set()
        for other, new in deduce(item, value):
            if other not in done and (other not in best or new < best[other]):
                best[other] = new
                heapq.heappush(agenda, (new, pushed, other, item))
                pushed += 1
    return done


def _written(place: int) -> int:
    """Where a user or assistant turn, whichever is next, leads to."""
    return PAIR if place == USER else USER


def _kept(place: int, initial: int) -> int | None:
    """Where keeping a turn leads to, if the pattern allows it."""
    if initial == 0:
        return SYSTEM if place == START else None
    if initial == 1:
        return USER if place != USER else None
    return PAIR if initial == 2 and place == USER else None


@functools.lru_cache(maxsize=1 << 12)
def stretch_items(codes: tuple[int, ...], start: int) -> tuple[Value | None, ...]:
    """The cheapest (cost, audit) from ``start`` to each place over turns of these codes."""

    def deduce(item: tuple[int, int], value: Value) -> Iterator[tuple[tuple[int, int], Value]]:
        (at, place), (cost, audit) = item, value
        yield (at, _written(place)), (cost + INSERT, audit + "I")
        if at == len(codes):
            return
        initial, fault = divmod(codes[at], 4)
        yield (at + 1, place), (cost + DELETE, audit + "D")
        if fault in (BLANK, DUPLICATE):
            return
        more = TRUNCATED if fault == CUT else 0
        onward = _kept(place, initial)
        if onward is not None:
            yield (at + 1, onward), (cost + KEEP + more, audit + "K")
        yield (at + 1, _written(place)), (cost + REROLE + more, audit + "R")

    ends = [(len(codes), place) for place in _PLACES]
    done = lightest([((0, start), (0, ""))], deduce, set(ends), all_goals=True)
    return tuple(done[end][0] if end in done else None for end in ends)


Items = tuple[tuple[Value | None, ...], ...]


def conversation_repair(stretches: list[tuple[int, ...]], items: list[Items | None] | None = None
                        ) -> tuple[Value, list[tuple[int, str]]]:
    """The cheapest (cost, audit) of a whole conversation, and (start, edits) of each stretch.

    ``items`` holds the stretch items of every start where they are known already.
    """

    def across(at: int, place: int) -> tuple[Value | None, ...]:
        known = items[at] if items else None
        return known[place] if known else stretch_items(stretches[at], place)

    def deduce(item: tuple[int, int], value: Value) -> Iterator[tuple[tuple[int, int], Value]]:
        (at, place), (cost, audit) = item, value
        if at < len(stretches):
            for end, found in enumerate(across(at, place)):
                if found is not None:
                    yield (at + 1, end), (cost + found[0], audit + found[1])

    goals = {(len(stretches), START), (len(stretches), PAIR)}
    done = lightest([((0, START), (0, ""))], deduce, goals)
    goal = next(g for g in goals if g in done)
    value, item, parts = done[goal][0], goal, []
    while done[item][1] is not None:
        before = done[item][1]
        parts.append((before[1], across(*before)[item[1]][1]))
        item = before
    return value, parts[::-1]


def _illegal(initials: list[int], before: int | None) -> int:
    chain = ([] if before is None else [before]) + initials
    return sum(pair not in _LEGAL for pair in zip(chain, chain[1:]))


def _with_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds cost and audit from every start to every end where a stretch is long."""
    for batch in batches:
        costs: list[list[int | None] | None] = []
        audits: list[list[str | None] | None] = []
        for codes in batch.column(2).to_pylist():
            found = [v for place in _PLACES for v in stretch_items(tuple(codes), place)] if len(codes) >= LONG_STRETCH else None
            costs.append(found and [v and v[0] for v in found])
            audits.append(found and [v and v[1] for v in found])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                                         [*batch.schema.names, "costs", "audits"])


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the hash of id and turn; nulls read as one space.

    Of twenty lots 0 drops the turn, 1 empties its text, 2 removes its closing
    marks, 3 repeats it, 4 makes it the user's.
    """
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    lot = F.crc32(F.concat(name[0], F.lit(":"), name[1]).cast("binary")) % 20
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    copies = F.when(F.col("lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), lot.alias("lot")).where("lot <> 0")
            .select("conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def _key(column: str = "conv_id") -> Column:
    """The id as text; a space, which no id is, for the null id."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


class Repair:
    """A repair of all conversations of ``conversations`` (conv_id, turn, role, text).

    Turns stand in the order of ``turn``, nulls first, then of role and text.
    Null roles and texts read as one space; the null id is a conversation too.
    Equal rows are all there, all but the first are duplicates. Conversations
    of any number of turns, and turns of any length, are taken whole. An empty
    table has an empty repair; other columns are ignored.
    """

    def __init__(self, conversations: DataFrame, stretch_bits: int = STRETCH_BITS):
        text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
        order = ["key", "turn", "role", "text"]
        plain = conversations.select(_key().alias("key"), F.col("turn").cast("bigint").alias("turn"),
                                     role.alias("role"), text.alias("text"))
        # numbers of one global order, so that a large conversation lies in many partitions
        self.rows = stored(plain.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("at", F.monotonically_increasing_id()), "repair-rows")
        self.bits = stretch_bits
        self.edits = stored(self._repaired(self._codes()), "repair-edits")

    def _codes(self) -> DataFrame:
        """(key, stretch, codes): four times the role's number plus the fault, one number a turn, in order."""
        initial, code = F.substring("role", 1, 1), F.lit(len(_INITIALS))
        for n, letter in enumerate(_INITIALS):
            code = F.when(initial == letter, n).otherwise(code)
        twin = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
        slim = self.rows.select("key", "at", code.alias("initial"), twin.alias("twin"),
                                (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                                F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1).isin(".", "!", "?").alias("closed"))
        first = slim.groupBy("key", "twin").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
        fault = (F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE)
                 .when(~F.col("closed"), CUT).otherwise(CLEAN))
        coded = slim.join(first, "at", "left").select("key", "at", (F.col("initial") * 4 + fault).alias("code"))
        found = coded.groupBy("key", F.shiftright("at", self.bits).alias("stretch")).agg(
            F.sort_array(F.collect_list(F.struct("at", "code"))).alias("turns"))
        return found.select("key", "stretch", F.col("turns.code").cast("array<int>").alias("codes")).mapInArrow(
            _with_items, "key string, stretch bigint, codes array<int>, costs array<bigint>, audits array<string>")

    def _repaired(self, codes: DataFrame) -> DataFrame:
        """One row per stretch: its start and edits; the conversation's figures stand in the first one."""
        figures = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
        schema = f"key string, stretch bigint, start int, edits string, {figures}"
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()] + [pa.int64()] * 5 + [pa.string()]

        def solved(key: str, numbers: list[int], turns: list[tuple[int, ...]], items: list[Items | None]) -> list[list]:
            (cost, audit), parts = conversation_repair(turns, items)
            count, last = [0] * 4, None
            illegal = 0
            for part in turns:
                illegal += _illegal([c // 4 for c in part], last)
                last = part[-1] // 4
                for code in part:
                    count[code % 4] += 1
            totals = [count[BLANK], count[DUPLICATE], count[CUT], illegal, cost, audit]
            return [[key, number, start, edits, *(totals if n == 0 else [None] * 6)]
                    for n, (number, (start, edits)) in enumerate(zip(numbers, parts))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, numbers, turns, items = None, [], [], []
            for batch in batches:
                out: list[list] = []
                for k, number, part, costs, audits in zip(*(c.to_pylist() for c in batch.columns)):
                    if k != key and turns:
                        out += solved(key, numbers, turns, items)
                        numbers, turns, items = [], [], []
                    key = k
                    numbers.append(number)
                    turns.append(tuple(part))
                    found = [None if c is None else (c, a) for c, a in zip(costs or [], audits or [])]
                    items.append(tuple(tuple(found[4 * p:4 * p + 4]) for p in _PLACES) if found else None)
                yield as_batch(out)
            if turns:
                yield as_batch(solved(key, numbers, turns, items))

        def as_batch(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names)

        # an audit is one cell of the result, so the codes of a conversation, a few bytes a turn, fit where it does
        return codes.repartition("key").sortWithinPartitions("key", "stretch").mapInArrow(run, schema)

    def _streamed(self) -> DataFrame:
        """Turns in order, each stretch led by its edits."""
        turns = self.rows.select("key", F.shiftright("at", self.bits).alias("stretch"), "at", "role", "text",
                                 F.lit(None).cast("int").alias("start"))
        heads = self.edits.select("key", "stretch", F.lit(-1).cast("bigint").alias("at"), F.lit("").alias("role"),
                                  F.col("edits").alias("text"), "start")
        return turns.unionByName(heads).repartition("key").sortWithinPartitions("key", "stretch", "at")

    def turns(self) -> DataFrame:
        """(key, place, edit, role, text) of the repaired conversations, places gapless from 0."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk, place = _Walk(), -1
            for found in walk.over(batches):
                rows = []
                for k, edit, role, text in found:
                    place = place + 1 if edit else -1
                    if edit:
                        rows.append((k, place, edit, role, text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], kind) for j, kind in
                     enumerate((pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                    ["key", "place", "edit", "role", "text"])

        return self._streamed().mapInArrow(run, "key string, place bigint, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """(key, repaired_sha256) of ``role:text`` of the repaired turns, joined by newlines."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk, key, digest, first = _Walk(), None, hashlib.sha256(), True
            for found in walk.over(batches):
                keys, sums = [], []
                for k, edit, role, text in found:
                    if not edit:  # a conversation begins
                        if key is not None:
                            keys.append(key)
                            sums.append(digest.hexdigest())
                        key, digest, first = k, hashlib.sha256(), True
                        continue
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "replace"))
                    first = False
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(sums, pa.string())], ["key", "repaired_sha256"])
            if key is not None:
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])

        return self._streamed().mapInArrow(run, "key string, repaired_sha256 string")

    def report(self, ids: DataFrame) -> DataFrame:
        """Figures, audit and digest for each of ``ids`` (conv_id); those without turns have zeros and an empty repair."""
        spread = (self.rows.select("key", "turn").where(F.col("turn").isNotNull()).distinct().groupBy("key")
                  .agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
        counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
        figures = self.edits.where(F.col("audit").isNotNull()).select("key", *counts, "audit")
        found = (ids.select("conv_id").distinct().withColumn("key", _key()).join(figures, "key", "left")
                 .join(spread, "key", "left").join(self.digests(), "key", "left"))
        return found.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *counts)],
                            F.coalesce("audit", F.lit("")).alias("audit"),
                            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


class _Walk:
    """Applies edits to turns that stream past in order."""

    def __init__(self) -> None:
        self.key: str | None = None
        self.edits, self.at, self.place = "", 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self.key, "I", self._next_role(), ""

    def _next_role(self) -> str:
        self.place = _written(self.place)
        return "assistant" if self.place == PAIR else "user"

    def over(self, batches: Iterable[pa.RecordBatch]) -> Iterator[Iterator[tuple[str, str, str, str]]]:
        """For each batch (key, edit, role, text) of what is written; an empty edit opens a conversation."""
        for batch in batches:
            yield self._written_of(batch)
        yield self._inserted()

    def _written_of(self, batch: pa.RecordBatch) -> Iterator[tuple[str, str, str, str]]:
        names = batch.schema.names
        columns = [batch.column(names.index(c)) for c in ("key", "start", "role", "text")]
        for key, start, role, text in zip(*(c.to_pylist() for c in columns)):
            if start is not None:
                yield from self._inserted()
                if key != self.key:
                    yield key, "", "", ""
                self.key, self.edits, self.at, self.place = key, text, 0, start
                continue
            yield from self._inserted()
            edit = self.edits[self.at]
            self.at += 1
            if edit == "K":
                self.place = _kept(self.place, _INITIALS.index(role[0]))
                yield key, edit, role, text
            elif edit == "R":
                yield key, edit, self._next_role(), text
