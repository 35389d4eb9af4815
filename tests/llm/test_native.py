"""Quality rules, mixing and tool calls: built-in functions only, against brute force."""

import json
import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from plazalens.llm import mixing, quality, tool_calls
from plazalens.llm.common import with_place
from tests.llm.test_dedup import LONG


def words_of(text):
    return [w for w in "".join(" " if c in quality.BLANKS else c for c in text or "").split(" ") if w]


def counts_of(text):
    words = words_of(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {p for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    symbols = sum(c in quality.SYMBOLS for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


TEXTS = [
    None, "", " \n ", "a # b", "x y\nx y\n\n \nx y", "a b c d e f g h " * 3, "a b c d e f g h i " * 2 + "z", "é | < \x0b b",
    " ".join(f"w{i % 11}" for i in range(60)), "one two three four five six seven eight", LONG,
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8",
]


@pytest.fixture(scope="module")
def labels(spark):
    columns = "doc_id long, quality int, toxic int, stratum string"
    return lambda rows: spark.createDataFrame([(doc, good, 0, "x") for doc, good in rows], columns)


def test_counts(documents, labels):
    rows = [(i, text, "en") for i, text in enumerate(TEXTS)] + [(None, "a b", None), (0, None, "en")]
    got = quality.assess(documents(rows), labels([(1, 1), (None, 1), (2, None)])).collect()
    assert len(got) == len(rows)
    for row in got:
        if row.doc_id is None:
            continue
        n, chars, symbols, lines, repeats = counts_of(TEXTS[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert row.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert row.kept == (not row.base_failed)
    assert quality.assess(documents([]), labels([])).collect() == []


def tail(k, n, p):
    p = Fraction(p)
    return float(sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_tails_are_exact(spark):
    cases = [(k, n) for n in (1, 5, 300, 3000) for k in (0, 1, 2, 7, 13, n) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for p in (0.005, 0.3):
        for row in df.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("p")).collect():
            expected = 1.0 if row.k >= row.n * p else tail(row.k, row.n, p)
            assert row.p == pytest.approx(expected, rel=1e-9)


def test_cutoffs_lose_few_good_documents(documents, labels):
    rng = random.Random(4)
    rows, marks = [], []
    plain = " ".join(["word"] * 3 + [f"w{i}" for i in range(27)])

    def marked(n):
        return plain + "".join(f" #{k}" for k in range(n))

    for i in range(3000):
        good, lang = rng.random() < 0.7, rng.choice(["aa", "aa", "bb"])
        share = rng.random() * (0.02 if good else 0.6)
        rows.append((i, marked(int(share * 130)), lang))
        marks.append((i, int(good)))
    rows += [(5000 + i, marked(70), "rare") for i in range(5)]
    marks += [(5000 + i, 0) for i in range(5)]
    got = {r.doc_id: r for r in quality.assess(documents(rows), labels(marks)).collect()}
    good = [got[i] for i, mark in marks if mark]
    bad = [got[i] for i, mark in marks if not mark and i < 3000]
    assert sum(not r.kept for r in good) <= 0.02 * len(good)
    assert sum(not r.kept for r in bad) > 0.6 * len(bad)
    assert all(r.kept and r.max_symbols is None for i, r in got.items() if i >= 5000)
    # The choice agrees with the rule worked out by hand.
    for lang in ("aa", "bb"):
        held = [got[i] for (i, _, at), (_, mark) in zip(rows, marks) if at == lang and mark]
        chosen = dict.fromkeys(quality.RULES)
        for step, (rule, cutoff) in enumerate(quality.STEPS, 1):
            lost = sum(any(above(r, *tried) for tried in quality.STEPS[:step]) for r in held)
            if lost >= len(held) * 0.02 or tail(lost, len(held), 0.02) > 0.05 / 2:
                break
            chosen[rule] = cutoff
        assert chosen["symbols"] is not None
        for rule, cutoff in chosen.items():
            assert {got[i][f"max_{rule}"] for i, _, at in rows if at == lang} == {cutoff}


def above(row, rule, cutoff):
    numerator, denominator, _ = quality.RULES[rule]
    return 1000 * row[numerator] > cutoff * row[denominator]


def test_217_good_documents_suffice_among_four_strata(documents, labels):
    plain = " ".join(f"word{i}" for i in range(30))
    sizes = {"a": 217, "b": 216, "c": 300, None: 217}
    rows, spam = [], {}
    for lang, n in sizes.items():
        rows += [(len(rows) + i, plain, lang) for i in range(n)]
        spam[lang] = len(rows)
        rows.append((len(rows), plain + " " + "#" * 400, lang))
    marks = [(i, int(i not in spam.values())) for i, _, _ in rows]
    got = {r.doc_id: r for r in quality.assess(documents(rows), labels(marks)).collect()}
    assert {lang: got[i].kept for lang, i in spam.items()} == {"a": False, "b": True, "c": False, None: False}
    assert all(got[i].kept for i, mark in marks if mark)


# --- mixing ------------------------------------------------------------------


def targets_of(sizes, cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = Fraction(sum(sizes.values())), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        more = {s for s in rest if level * weight[s] > cap * sizes[s]}
        if not more:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


def test_mix(documents):
    rng = random.Random(8)
    sources = [None, "", "a", "b", "B", "é", "tiny", "hot", "wordless"]
    rows = [(i, "w " * rng.randrange(40), None, "hot" if i % 3 == 0 else rng.choice(sources)) for i in range(900)]
    rows = [(i, "" if s == "wordless" else t, x, s) for i, t, x, s in rows if s != "tiny"]
    rows += [(2000, "only one", None, "tiny"), (2001, None, None, "a"), (2002, LONG, None, "b")]
    rows += [(7777, "same id " * 5, None, "a")] * 3 + [(None, "no id", None, "b")]
    got = mixing.mix(documents(rows)).collect()
    again = mixing.mix(documents(rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    expected = targets_of(sizes)
    taken = Counter()
    for row in got:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(float(expected[row.source]))
        assert 0 <= row.taken <= 3 * row.size
        taken[row.source] += row.taken
    assert len(got) == len(rows)
    for source, target in expected.items():
        assert taken[source] <= target + 1e-6
        assert taken[source] > target - 5  # rows that share an id round down each
    assert mixing.mix(documents([])).collect() == []


def test_thresholds_nest(documents, spark):
    rows = [(i, f"a b c {i}", None, "s" if i % 2 else "t") for i in range(400)]
    weights = lambda w: spark.createDataFrame([("s", w), ("t", 10.0 - w)], "source string, weight double")
    few = {r.doc_id for r in mixing.mix(documents(rows), weights=weights(2.0)).collect() if r.source == "s" and r.taken == r.size}
    many = {r.doc_id for r in mixing.mix(documents(rows), weights=weights(4.0)).collect() if r.source == "s" and r.taken == r.size}
    assert few < many


def test_apply_mix(documents):
    rows = [(i, f"a  b c\n{i}", None, "s" if i % 5 else "t") for i in range(100)] + [(500, None, None, None), (501, "", None, "t")]
    docs = documents(rows)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    texts = {row[0]: row[1] for row in rows}
    times = {r.doc_id: r.taken // r.size + (2 * (r.taken % r.size) >= r.size) for r in mixing.mix(docs).collect() if r.taken}
    got = Counter()
    for row in out.collect():
        got[row.doc_id] += 1
        assert row.text == texts[row.doc_id]
    assert got == {doc: n for doc, n in times.items() if n}
    assert mixing.apply_mix(documents([])).collect() == []


def test_places(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "b"]), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, n int, i int")
    got = with_place(df, ["g"], [F.col("n"), F.col("i")], "place").collect()
    for group in (None, "a", "b"):
        order = sorted((r for r in rows if r[0] == group), key=lambda r: r[1:])
        found = sorted((r.place, r.n, r.i) for r in got if r.g == group)
        assert found == [(at + 1, n, i) for at, (_, n, i) in enumerate(order)]


# --- tool calls --------------------------------------------------------------

SCHEMAS = {"f": {"n": ("BIGINT", True), "s": ("STRING", False)}, "g": {"x": ("DOUBLE", True), "b": ("BOOLEAN", False)}}
ARGUMENTS = {
    '{"n": 1}': ("f", "", '{"n":1}'),
    '{ "s" : "é\\n", "n":2 }': ("f", "", '{"n":2,"s":"é\\n"}'),
    '{"s": 3}': ("f", "missing n; type of s", '{"s":3}'),
    '{"n": "1", "z": {"b": 1, "a": [2, {"d": 1, "c": 2}]}}': ("f", "type of n; unknown z", '{"n":"1","z":{"a":[2,{"c":2,"d":1}],"b":1}}'),
    '{"x": 1, "b": true}': ("g", "", '{"b":true,"x":1}'),
    '{"x": 1.5}': ("g", "", '{"x":1.5}'),
    '{"x": null}': ("g", "type of x", '{"x":null}'),
    '{"n": 1': ("f", "not an object", "null"),
    "[1]": ("f", "not an object", "[1]"),
    "{}": ("h", "unknown tool", "{}"),
}


@pytest.fixture(scope="module")
def tables(spark):
    calls = "conv_id long, position long, call_id string, name string, arguments string, needs string, content string"
    results = "conv_id long, position long, call_id string, content string, name string"

    def make(made, given):
        return (
            spark.createDataFrame([(*row, "x") for row in made], calls),
            spark.createDataFrame([(*row, "x") for row in given], results),
        )

    return make


def test_arguments(tables):
    made = [(1, i, f"c{i}", name, text, None) for i, (text, (name, _, _)) in enumerate(ARGUMENTS.items())]
    got = tool_calls.link(*tables([*made, (1, 99, "null", "f", None, None)], []), SCHEMAS).collect()
    by_id = {row.call_id: row for row in got}
    for i, (name, errors, written) in enumerate(ARGUMENTS.values()):
        assert by_id[f"c{i}"].errors == errors
        assert by_id[f"c{i}"].message.startswith(f'{{"arguments":{written},"errors":')
    assert by_id["null"].errors == "not an object"


def test_links_and_order(tables):
    made = [
        (1, 5, "a", "f", "{}", "b"), (1, 6, "b", "f", "{}", "c"), (1, 7, "c", "f", "{}", None), (1, 1, "d", "f", "{}", "gone"),
        (1, 2, "x", "f", "{}", "y"), (1, 3, "y", "f", "{}", "x"), (2, 1, "e", "f", "{}", "a"), (2, 9, "d", "f", "{}", None),
        (1, 8, None, "f", "{}", None), (1, 1, "d", "f", "{}", "gone"), (None, None, "n", None, None, None),
    ]
    given = [(1, 9, "a", "done"), (1, 8, "a", "first"), (1, 9, "zz", "é\"\n"), (1, 9, None, "lost"), (2, 3, "e", None)]
    got = {row.call_id: row for row in tool_calls.link(*tables(made, given), SCHEMAS).collect()}
    assert {k: r.level for k, r in got.items()} == {"a": 2, "b": 1, "c": 0, "d": 0, "x": None, "y": None, "e": 3, "zz": None, "n": 0}
    order = sorted((r.place, k) for k, r in got.items() if r.conv_id == 1)
    assert [k for _, k in order] == ["d", "c", "b", "a", "x", "y", "zz"] and [p for p, _ in order] == list(range(1, 8))
    assert {k: r.status for k, r in got.items() if r.status != "pending"} == {"a": "linked", "e": "linked", "zz": "orphan"}
    for row in got.values():
        message = json.loads(row.message)
        assert json.dumps(message, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == row.message
    assert json.loads(got["a"].message)["result"] == "first" and json.loads(got["zz"].message)["result"] == "é\"\n"
    assert tool_calls.link(*tables([], []), SCHEMAS).collect() == []


def test_every_row_comes_out_and_conversations_have_their_own_ids(tables):
    made = [
        (1, 1, "call_1", "f", '{"n": 1}', None), (2, 1, "call_1", "f", "{}", None), (2, 2, "call_2", "f", "{}", "call_1"),
        (1, 1, "call_1", "f", '{"n": 1}', None), (1, 3, "call_1", "g", "{}", None), (None, 1, "call_1", "f", "{}", None),
        (1, 4, None, "f", "{}", None), (1, 4, None, "f", "{}", None),
    ]
    given = [(1, 2, "call_1", "a"), (1, 5, "call_1", "b"), (2, 3, "call_1", "c"), (2, 3, "call_1", "c"), (2, 9, None, "d"), (3, 1, "call_2", "e"), (None, 2, "call_1", "f")]
    got = tool_calls.link(*tables(made, given), SCHEMAS, every_row=True).collect()
    found = sorted(((r.conv_id, r.call_id, r.status, r.level, json.loads(r.message)["result"]) for r in got), key=repr)
    expected = [
        (1, "call_1", "linked", 0, "a"), (2, "call_1", "linked", 0, "c"), (2, "call_2", "pending", 1, None), (None, "call_1", "linked", 0, "f"),
        (1, "call_1", "duplicate", None, None), (1, "call_1", "duplicate", None, None), (1, "call_1", "duplicate", None, "b"), (2, "call_1", "duplicate", None, "c"),
        (1, None, "unidentified", None, None), (1, None, "unidentified", None, None), (2, None, "unidentified", None, "d"), (3, "call_2", "orphan", None, "e"),
    ]
    assert found == sorted(expected, key=repr)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    rounds, keep = [], tool_calls.kept
    monkeypatch.setattr(tool_calls, "kept", lambda df, name: rounds.append(name) or keep(df, name))
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(300)]
    hub = [(f"h{i}", "c0") for i in range(200)]
    calls = spark.createDataFrame(chain + hub, "call_id string, needs string")
    got = dict(map(tuple, tool_calls.levels(calls).collect()))
    assert got == {f"c{i}": i for i in range(300)} | {f"h{i}": 1 for i in range(200)}
    assert len(rounds) <= 11


def test_conversations_as_calls(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (1, 2, "user", None), (2, 1, None, "é" * 100_000), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    calls, results = tool_calls.from_conversations(turns)
    got = tool_calls.link(calls, results, tool_calls.TOOLS).collect()
    assert sorted(r.call_id for r in got) == ["call_1_-1", "call_1_1", "call_2_0"]
