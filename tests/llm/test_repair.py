"""Conversation repair against dynamic programming and by its contract on small cases."""

import hashlib
import random
import re
import zlib

import pytest

from plazalens.llm import conversation_repair as repair

FAR = 1 << 40


def least(turns):
    """The cheapest edits of (initial, fault) turns, first in ASCII order, by a table over states."""
    nexts = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                best[nexts[state]] = min(best.get(nexts[state], (FAR, "")), (cost + 3, audit + "I"))
        return best

    best = {0: (0, "")}
    for initial, fault in turns:
        after = {}
        for state, (cost, audit) in inserted(best).items():
            steps = [("D", state, 4)]
            if fault not in "bd":
                extra = 3 * (fault == "t")
                if initial == "s" and state == 0:
                    steps.append(("K", 1, extra))
                if initial == ("a" if state == 2 else "u"):
                    steps.append(("K", nexts[state], extra))
                steps.append(("R", nexts[state], 3 + extra))
            for edit, to, more in steps:
                after[to] = min(after.get(to, (FAR, "")), (cost + more, audit + edit))
        best = after
    return min(value for state, value in inserted(best).items() if state in (0, 3))


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        named = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(named.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, "user" if kind == 4 else role, text


def brute(rows):
    by_conv = {row[0]: [] for row in rows}
    for conv, turn, role, text in damaged(rows):
        by_conv[conv].append((turn is not None, turn or 0, role, text))
    out = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        seen, coded = set(), []
        for _, _, role, text in turns:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "b" if not visible else "d" if (role, text) in seen else "-" if visible[-1] in ".!?" else "t"
            seen.add((role, text))
            coded.append((role[:1], fault))
        cost, audit = least(coded)
        lines, at, before = [], 0, 0
        fits = {0: "user", 1: "user", 2: "assistant", 3: "user"}
        for edit in audit:
            if edit == "I":
                lines.append(fits[before] + ":")
            else:
                role, text = turns[at][2:]
                if edit == "K":
                    lines.append(f"{role}:{text}")
                    if role[:1] == "s":
                        before, at = 1, at + 1
                        continue
                elif edit == "R":
                    lines.append(f"{fits[before]}:{text}")
                at += 1
            if edit != "D":
                before = 3 if before == 2 else 2
        numbers = [t[1] for t in turns if t[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        faults = [sum(fault == kind for _, fault in coded) for kind in "bdt"]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def conversations(spark):
    def make(rows):
        schema = "conv_id long, turn long, role string, text string, key string, place int, audit string, salt string"
        return spark.createDataFrame([(*row, *["x", 1, "x", "x"]) for row in rows], schema)

    return make


def test_first_path_is_the_cheapest_and_least():
    rng = random.Random(12)
    for _ in range(1500):
        turns = [(rng.choice("suaua?"), rng.choice("bdt----")) for _ in range(rng.randrange(12))]
        cost, audit, state = repair.Search(turns).run()
        assert (cost, audit) == least(turns) and state in (0, 3)


def test_chunks_join_up():
    rng = random.Random(5)
    for _ in range(150):
        turns = [(rng.choice("suaua?"), rng.choice("bdt-----")) for _ in range(rng.randrange(4, 40))]
        cut = rng.randrange(1, len(turns))
        later = repair.matrix(turns[cut:])
        ends = [0, 6, 3, 0]
        after = tuple(min(later[4 * i + j] + ends[j] for j in range(4)) for i in range(4))
        cost, first, state = repair.Search(turns[:cut], after, last=False).run()
        rest, second, _ = repair.Search(turns[cut:]).run(state)
        assert (cost, first + second) == least(turns)
        assert rest == after[state]


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", None]


def some_rows(seed, count):
    rng = random.Random(seed)
    texts = ["Fine.", "Cut", "Why?  \n", "", " \t", None, "Same!", "Same!", "é…", "a\nb.", "?" * 50 + "x"]
    rows = []
    for conv in [*range(count), None, 10**12]:
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice([*texts, f"{conv} {turn}.", f"{conv} {turn} long. " * 20])
            rows.append((conv, rng.choice([turn] * 9 + [None]), rng.choice(ROLES), text))
    return rows


def test_report(conversations):
    rows = some_rows(1, 120)
    rows += rows[:20]  # repeated rows
    got = repair.repair_damaged(conversations(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_long_conversations_are_searched_in_chunks(conversations):
    rng = random.Random(8)
    rows = [(7, turn, rng.choice(["user", "assistant"]) if turn % 9 == 0 else ("user", "assistant")[turn % 2], f"{turn}.") for turn in range(1200)]
    rows += [(None, None, "user", "the same")] * 600 + [(9, turn, ("user", "assistant")[turn % 2], "x.") for turn in range(2 * repair.CHUNK)]
    rows += some_rows(2, 5)
    rows = [row for row in rows if row[0] != 10**12]
    got = repair.repair_damaged(conversations(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_scan_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(repair, "FAN", 3)
    values = [("a", at, [at + 1]) for at in range(40)] + [("b", 0, [5])]
    got = repair.scan(spark.createDataFrame(values, "key string, at long, value array<long>"), lambda one, two: one + two)
    found = {(r.key, r.at): r.before for r in got.collect()}
    assert found == {("b", 0): None} | {("a", at): list(range(1, at + 1)) or None for at in range(40)}


def test_repaired_turns(conversations):
    turns = conversations([(1, 0, "assistant", "Hi."), (1, 1, "user", "Go."), (2, 0, "user", " ")]).select("conv_id", "turn", "role", "text")
    fixed = repair.Repair(turns, turns)
    rows = [tuple(r)[3:] for r in fixed.repaired().orderBy("conv_id", "place", "part").collect()]
    assert {r.conv_id: (r.cost, r.audit) for r in fixed.report().collect()} == {1: (6, "IKKI"), 2: (4, "D")}
    assert rows == [("user", ""), ("assistant", "Hi."), ("user", "Go."), ("assistant", "")]


def test_no_rows(conversations):
    assert repair.repair_damaged(conversations([])).collect() == []
