"""Repair of the turns of conversations by the cheapest edits, found by iterative-deepening A*.

A conversation is a row of turns, each with the initial of its role and its first fault. Edits
keep, rerole or delete a turn or insert one, until the roles are an optional system turn followed
by pairs of user and assistant. The search goes depth first, in the order of the edits' initials,
and gives up a path whose cost so far plus the least cost from its state on is over the bound. A
table keeps for each state that failed what its failure taught about that least cost. A round
without a path raises the bound to the least cost then known for the start. So the first path
that is accepted is the cheapest, and of the cheapest ones the first in the order of initials.

A conversation of any length is searched in chunks of turns, so no task holds one as a whole. What
the turns after a chunk cost, for each of the four states it can end in, comes from a scan over
the chunks' cost matrices; each chunk is searched from each state it can start in, and a second
scan tells in which one it does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, parts, with_place

CHUNK = 256
"""Turns that are searched at once."""
FAN = 256
"""Neighbours that a scan combines in one step."""

# --- fixed values: faults, costs of edits, initials and names of roles -------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"s": "system", "u": "user", "a": "assistant"}
_NO_WORD = r"^[\x20\x09-\x0D]*\z"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"

# States: nothing yet, after system, after user, after assistant.
_STATES = range(4)
_NEXT = (2, 2, 3, 2)
"""The state after a turn of the one role out of user and assistant that fits."""
_NAME = ("user", "user", "assistant", "user")
_FAR = 1 << 40
_ACCEPT = (0, _FAR, _FAR, 0)


def _turn(initial: str, fault: str, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits that take a turn in: initial of the edit, state after it, cost."""
    yield "D", state, DELETE
    if fault in "bd":
        return
    extra = TRUNCATED if fault == "t" else 0
    if initial == "s" and state == 0:
        yield "K", 1, KEEP + extra
    elif initial == ("a" if state == 2 else "u"):
        yield "K", _NEXT[state], KEEP + extra
    yield "R", _NEXT[state], REROLE + extra


class Search:
    """The turns of a chunk, two letters each (initial and fault), and what is to pay for each
    state at its end. ``last`` chunks may end with inserted turns."""

    def __init__(self, turns: list[tuple[str, str]], end: tuple[int, ...] = _ACCEPT, last: bool = True):
        self._turns, self._end, self._last = turns, end, last
        least = [0] * (len(turns) + 1)
        for i in range(len(turns) - 1, -1, -1):
            least[i] = least[i + 1] + (DELETE if turns[i][1] in "bd" else min(DELETE, TRUNCATED) if turns[i][1] == "t" else 0)
        self._least = [value + min(end) for value in least]
        self._failed: dict[tuple[int, int], int] = {}

    def _from(self, place: int, state: int) -> int:
        """The least cost from a state on, as far as it is known."""
        if place == len(self._turns) and not self._last:
            return self._end[state]
        return self._failed.get((place, state), self._least[place])

    def _edits(self, place: int, state: int) -> list[tuple[str, int, int, int]]:
        """Edits in the order of their initials: initial, place and state after it, cost."""
        found = []
        if place < len(self._turns):
            found = [(edit, place + 1, after, cost) for edit, after, cost in _turn(*self._turns[place], state)]
        if place < len(self._turns) or self._last:
            found.insert(bool(found), ("I", place, _NEXT[state], INSERT))
        return found

    def run(self, start: int = 0) -> tuple[int, str, int]:
        """The least cost, the edits' initials and the state at the end."""
        while (bound := self._from(0, start)) < _FAR:
            path = self._within(start, bound)
            if path is not None:
                return bound, *path
        raise ValueError("no edits lead to an end")

    def _within(self, start: int, bound: int) -> tuple[str, int] | None:
        stack = [[0, start, 0, iter(self._edits(0, start)), _FAR]]
        taken: list[str] = []
        while stack:
            frame = stack[-1]
            place, state, spent, edits, _ = frame
            if place == len(self._turns) and spent + self._end[state] <= bound:
                return "".join(taken), state
            for edit, after, to, cost in edits:
                ahead = cost + self._from(after, to)
                if spent + ahead <= bound:
                    taken.append(edit)
                    stack.append([after, to, spent + cost, iter(self._edits(after, to)), _FAR])
                    break
                frame[4] = min(frame[4], ahead)
            else:  # the state fails: what is left to try costs this much at least
                stack.pop()
                learnt = max(min(frame[4], _FAR), self._from(place, state))
                if place == len(self._turns):
                    learnt = min(learnt, self._end[state]) if self._end[state] < _FAR else learnt
                self._failed[place, state] = learnt
                if stack:
                    taken.pop()
                    before = stack[-1]
                    before[4] = min(before[4], spent - before[2] + learnt)
        return None


def matrix(turns: list[tuple[str, str]]) -> list[int]:
    """The least cost from each state before some turns to each state after them."""
    out = []
    for start in _STATES:
        costs = [_FAR] * 4
        costs[start] = 0
        for initial, fault in turns:
            for _ in range(2):  # more than two inserted turns in a row lead nowhere new
                for state in _STATES:
                    costs[_NEXT[state]] = min(costs[_NEXT[state]], costs[state] + INSERT)
            after = [_FAR] * 4
            for state in _STATES:
                for _, to, cost in _turn(initial, fault, state):
                    after[to] = min(after[to], costs[state] + cost)
            costs = after
        out += costs
    return out


def _later_first(later: list[int], one: list[int]) -> list[int]:
    """The cost matrix of turns followed by later ones."""
    return [min(one[4 * i + k] + later[4 * k + j] for k in _STATES) for i in _STATES for j in _STATES]


def _then(states: list[int], following: list[int]) -> list[int]:
    return [following[state] for state in states]


# --- scans over the chunks of long conversations -----------------------------

Combine = Callable[[list[int], list[int]], list[int]]


def _fold(combine: Combine):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for group in batch.column(2).to_pylist():
                value = group[0]["value"]
                for other in group[1:]:
                    value = combine(value, other["value"])
                values.append(value)
            columns = [batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "at", "value"])

    return fold


def _unfold(combine: Combine):
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, group, before in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for child in group:
                    rows.append((key, child["at"], before))
                    before = child["value"] if before is None else combine(before, child["value"])
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "at", "before"])

    return unfold


def scan(values: DataFrame, combine: Combine) -> DataFrame:
    """``key, at, before``: of values ``key, at, value`` with ``at`` from 0 in each key, what those
    with a smaller ``at`` combine to; NULL at 0. No task sees more than `FAN` values of a key."""

    def grouped(level: DataFrame) -> DataFrame:
        group = F.sort_array(F.collect_list(F.struct("at", "value"))).alias("group")
        return level.groupBy("key", F.expr(f"at div {FAN}").alias("above")).agg(group)

    levels = [kept(values.select("key", "at", "value"), "scan")]
    while levels[-1].filter("at > 0").limit(1).count():
        combined = grouped(levels[-1]).mapInArrow(_fold(combine), "key string, at long, value array<long>")
        levels.append(kept(combined, "scan"))
    before = levels.pop().select("key", "at", F.lit(None).cast("array<long>").alias("before"))
    for level in reversed(levels):
        both = grouped(level).join(before.withColumnRenamed("at", "above"), ["key", "above"])
        both = both.select("key", "group", "before")
        before = kept(both.mapInArrow(_unfold(combine), "key string, at long, before array<long>"), "scan")
    return before


# --- conversations -----------------------------------------------------------


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with turns lost, emptied, cut short, repeated and misattributed by
    a hash of conversation and turn. NULL roles and texts, and NULLs in the hashed text, are one
    space."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.encode(F.concat(filled(conv_col), F.lit(":"), filled(turn_col)), "UTF-8")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(filled(text_col), "[.!?]", "")).otherwise(filled(text_col))
    role = F.when(kind == 4, "user").otherwise(filled(role_col))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), copies.alias("__copies")
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("__copies"))).alias("__copy")).drop("__copy")


def _key(name: str) -> Column:
    """A conversation's id as a text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))


def _turns_of(group: list[dict], first: int) -> tuple[str | None, list[tuple[str, str]]]:
    """The initial of the turn before the chunk, and the chunk's turns."""
    before = None
    if group[0]["place"] <= first:
        before, group = group[0]["code"][0], group[1:]
    return before, [(row["code"][0], row["code"][1]) for row in group]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = []
        for chunk, group in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            values.append(matrix(_turns_of(group, chunk * CHUNK)[1]))
        columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(values, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "chunk", "chunks", "value"])


_FOUND = "key string, chunk long, chunks long, illegal long, cost long, audits array<string>, value array<long>"


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, chunk, group, chunks, later``."""
    end = [min(INSERT * n for n in range(4) if _after(state, n) in (0, 3)) for state in _STATES]
    for batch in batches:
        illegal, costs, audits, exits = [], [], [], []
        for _, chunk, group, chunks, later in zip(*(column.to_pylist() for column in batch.columns)):
            before, turns = _turns_of(group, chunk * CHUNK)
            initials = ([] if before is None else [before]) + [initial for initial, _ in turns]
            illegal.append(sum(one + two not in ("su", "ua", "au") for one, two in zip(initials, initials[1:])))
            last = chunk == chunks - 1
            after = _ACCEPT if last else tuple(
                end[i] if later is None else min(later[4 * i + j] + end[j] for j in _STATES) for i in _STATES
            )
            search = Search(turns, after, last)
            found = [search.run(start) for start in (_STATES if chunk else (0,))]
            costs.append(found[0][0] if chunk == 0 else None)
            audits.append([audit for _, audit, _ in found])
            exits.append([state for *_, state in found] * (1 if chunk else 4))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in (0, 1, 3)),
                pa.array(illegal, pa.int64()),
                pa.array(costs, pa.int64()),
                pa.array(audits, pa.list_(pa.string())),
                pa.array(exits, pa.list_(pa.int64())),
            ],
            [field.split()[0] for field in _FOUND.split(", ")],
        )


def _after(state: int, inserted: int) -> int:
    for _ in range(inserted):
        state = _NEXT[state]
    return state


_EDITS = "key string, place long, part int, role string, own boolean"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, chunk, group, start, audit`` to a row for each turn that is left: the place of
    its own turn or of the one it is inserted at, its part there, and its role if that changed."""
    for batch in batches:
        rows = []
        for key, chunk, group, state, audit in zip(*(column.to_pylist() for column in batch.columns)):
            turns = _turns_of(group, chunk * CHUNK)[1]
            at, part = 0, 0
            for edit in audit:
                place = chunk * CHUNK + min(at + 1, len(turns))
                if edit == "I":
                    rows.append((key, place, part, _NAME[state], False))
                    state, part = _NEXT[state], part + 1
                    continue
                if edit == "R":
                    rows.append((key, place, part, _NAME[state], True))
                    state = _NEXT[state]
                elif edit == "K":
                    rows.append((key, place, part, None, True))
                    state = 1 if turns[at][0] == "s" else _NEXT[state]
                # What is inserted after the last turn follows it at its own place.
                part = part + 1 if at + 1 == len(turns) else 0
                at += 1
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
        columns = list(zip(*rows)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], [field.split()[0] for field in _EDITS.split(", ")]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, line`` in order: the SHA-256 of each key's lines, joined by newlines."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "repaired_sha256"])

    for batch in batches:
        for at, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != key:
                if digest is not None:
                    yield row()
                key, digest = at, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.encode())
    if digest is not None:
        yield row()


class Repair:
    """The repair of turns ``conv_id, turn, role, text``. ``conversations`` has a row for each
    conversation that is to be reported, with or without turns.

    Turns are taken by number (NULLs first), those of one number by role and text. Roles and texts
    must not be NULL. A turn's fault is the first of: blank, duplicate (role and text were seen
    before), truncated (its last visible character ends no sentence). All tables are written to the
    shared folder.
    """

    def __init__(self, turns: DataFrame, conversations: DataFrame):
        self._turns = turns.select(_key("conv_id").alias("key"), "turn", "role", "text")
        self._conversations = conversations.select("conv_id").distinct().withColumn("key", _key("conv_id"))
        rows = self._turns.withColumn("salt", F.monotonically_increasing_id())
        order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("salt")]
        self._placed = kept(with_place(rows, ["key"], order, "place").drop("salt"), "turns")
        self._chunks = self._chunked()
        self._searched = self._search()

    def _chunked(self) -> DataFrame:
        """``key, chunk, group, chunks``: turns in chunks, and the last one before each chunk."""
        same = F.sha2("text", 256).alias("same")
        rows = self._placed.select("key", "place", "role", "text", same)
        first = rows.groupBy("key", "role", "same").agg(F.min("place").alias("first"))
        fault = (
            F.when(F.col("text").rlike(_NO_WORD), "b")
            .when(F.col("place") > F.col("first"), "d")
            .when(~F.col("text").rlike(_ENDED), "t")
            .otherwise("-")
        )
        initial = F.substring("role", 1, 1)
        initial = F.when(initial.isin(*ROLES), initial).otherwise("?")
        coded = rows.join(first, ["key", "role", "same"]).select("key", "place", F.concat(initial, fault).alias("code"))
        self._coded = coded = kept(coded, "codes")
        own = F.expr(f"(place - 1) div {CHUNK}")
        both = F.when(F.col("place") % CHUNK == 0, F.array(own, own + 1)).otherwise(F.array(own))
        group = F.sort_array(F.collect_list(F.struct("place", "code"))).alias("group")
        chunks = coded.select("key", F.explode(both).alias("chunk"), "place", "code").groupBy("key", "chunk").agg(group)
        chunks = chunks.filter(F.element_at("group", -1)["place"] > F.col("chunk") * CHUNK)
        sizes = coded.groupBy("key").agg(F.expr(f"(max(place) + {CHUNK - 1}) div {CHUNK}").alias("chunks"))
        return kept(chunks.join(sizes, "key"), "chunks")

    def _search(self) -> DataFrame:
        """``key, chunk, audit, start, illegal, cost``."""
        long = self._chunks.filter("chunks > 1")
        costs = long.mapInArrow(_matrices, "key string, chunk long, chunks long, value array<long>")
        costs = costs.select("key", (F.col("chunks") - 1 - F.col("chunk")).alias("at"), "chunks", "value")
        costs = kept(costs, "costs")
        later = scan(costs, _later_first).join(costs.select("key", "at", "chunks"), ["key", "at"])
        later = later.select("key", (F.col("chunks") - 1 - F.col("at")).alias("chunk"), F.col("before").alias("later"))
        rows = self._chunks.join(later, ["key", "chunk"], "left").select("key", "chunk", "group", "chunks", "later")
        rows = rows.repartition(parts(rows), "key", "chunk")
        found = kept(rows.mapInArrow(_searched, _FOUND), "audits")
        long = found.filter("chunks > 1").select("key", F.col("chunk").alias("at"), "value")
        starts = scan(long, _then).select("key", F.col("at").alias("chunk"), "before")
        start = F.when(F.col("chunk") == 0, 0).otherwise(F.element_at("before", 1))
        found = found.join(starts, ["key", "chunk"], "left").withColumn("start", start.cast("int"))
        audit = F.element_at("audits", F.col("start") + 1)
        return kept(found.select("key", "chunk", audit.alias("audit"), "start", "illegal", "cost"), "audits")

    def repaired(self) -> DataFrame:
        """``conv_id, place, part, role, text``: the turns that result, in the order of ``place`` and
        ``part`` within each conversation. Inserted turns have an empty text."""
        return self._conversations.join(self._lines(), "key").select("conv_id", "place", "part", "role", "text")

    def _lines(self) -> DataFrame:
        rows = self._chunks.join(self._searched, ["key", "chunk"]).select("key", "chunk", "group", "start", "audit")
        edits = rows.mapInArrow(_edits, _EDITS).withColumnRenamed("role", "other")
        text = F.when(F.col("own"), F.col("text")).otherwise("").alias("text")
        both = edits.join(self._placed, ["key", "place"])
        return both.select("key", "place", "part", F.coalesce("other", "role").alias("role"), text)

    def report(self) -> DataFrame:
        """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost,
        audit, repaired_sha256``."""
        wide = F.col("turn").cast("decimal(38,0)")
        turns = self._turns.groupBy("key").agg(
            (F.max(wide) - F.min(wide) + 1 - F.count_distinct("turn")).alias("gaps")
        ).withColumn("gaps", F.expr("coalesce(try_cast(gaps AS bigint), if(gaps IS NULL, 0L, NULL))"))
        faults = self._coded.groupBy("key").agg(
            *(F.count_if(F.substring("code", 2, 1) == name[0]).alias(name) for name in ("blank", "duplicate", "truncated"))
        )
        pieces = F.sort_array(F.collect_list(F.struct("chunk", "audit")))
        edits = self._searched.groupBy("key").agg(
            F.sum("illegal").alias("illegal"),
            F.sum("cost").alias("cost"),
            F.array_join(F.transform(pieces, lambda piece: piece["audit"]), "").alias("audit"),
        )
        lines = self._lines().select("key", "place", "part", F.concat("role", F.lit(":"), "text").alias("line"))
        lines = lines.repartition(parts(lines), "key").sortWithinPartitions("key", "place", "part").select("key", "line")
        hashes = lines.mapInArrow(_hashed, "key string, repaired_sha256 string")
        out = self._conversations
        for more in (turns, faults, edits, hashes):
            out = out.join(more, "key", "left")
        zeros = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
        gaps = F.when(F.col("blank").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps")
        return out.select(
            "conv_id", gaps, *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The report of the repair of damaged conversations, one row for each original ``conv_id``, a
    NULL one too. Repeated rows are turns of their own. An empty table gives no rows; other columns
    are ignored. ``gaps`` is NULL where a long cannot hold it."""
    return Repair(damage(conversations), conversations).report()
