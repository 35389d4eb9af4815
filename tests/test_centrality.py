"""Sketched and sampled closeness against searches from every vertex."""

import random
from collections import deque

import pytest

from plazalens.operators import centrality


def exact(pairs, ids, directed=True):
    """For each vertex: how many others reach it, the sum of their distances, the largest."""
    back = {}
    for src, dst in pairs:
        back.setdefault(dst, set()).add(src)
        if not directed:
            back.setdefault(src, set()).add(dst)
    out = {}
    for start in ids:
        hops, queue = {start: 0}, deque([start])
        while queue:
            at = queue.popleft()
            for other in back.get(at, ()):
                if other not in hops:
                    hops[other] = hops[at] + 1
                    queue.append(other)
        out[start] = (len(hops) - 1, sum(hops.values()), max(hops.values()))
    return out


def closeness(reach, total, _):
    return reach / total if total else 0.0


def some_links(seed, size, degree, hub=True):
    rng = random.Random(seed)
    pairs = [(rng.randrange(size), rng.randrange(size)) for _ in range(size * degree)]
    pairs += [(i, 0) for i in range(0, size, 3)] if hub else []
    pairs += [(5, 5), (None, 3), (4, None), pairs[0]]
    pairs += [(10_000 + i, 10_001 + i) for i in range(15)]  # a long chain of its own
    return pairs


def proper(pairs):
    return [(a, b) for a, b in pairs if a is not None and b is not None and a != b]


@pytest.mark.parametrize("directed", [True, False])
def test_small_sketches_are_exact(spark, directed):
    pairs = some_links(1, 60, 1)
    links = spark.createDataFrame(pairs, "src long, dst long")
    lonely = spark.createDataFrame([(77_777,), (3,), (None,)], "name long")
    got = {r.landmark: r for r in centrality.closeness_sketched(links, lonely, directed).collect()}
    ids = {end for pair in proper(pairs) for end in pair} | {77_777, 3}
    want = exact(proper(pairs), ids, directed)
    assert set(got) == set(want)
    for vertex, found in want.items():
        row = got[vertex]
        assert (row.reach, row.rounds) == (found[0] + 1, found[2])
        assert row.closeness == pytest.approx(closeness(*found))
        assert row.low <= row.closeness <= row.high


def test_large_sketches_keep_within_their_error(spark):
    pairs = some_links(2, 3000, 2)
    links = spark.createDataFrame(pairs, "src long, dst long").repartition(4)
    got = {r.landmark: r for r in centrality.closeness_sketched(links, lg_k=9).collect()}
    sample = random.Random(3).sample(sorted(got), 60)
    want = exact(proper(pairs), sample)
    error = centrality.sketch_error(9)
    assert all(abs(got[v].reach - want[v][0] - 1) <= error * (want[v][0] + 1) + 1 for v in sample)
    held = sum(got[v].low <= closeness(*want[v]) <= got[v].high for v in sample)
    assert held >= 59
    assert sum(abs(got[v].closeness - closeness(*want[v])) <= 0.1 * closeness(*want[v]) + 1e-9 for v in sample) >= 50


def test_texts_as_ids_and_no_links(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    got = {r.landmark: (r.closeness, r.rounds) for r in centrality.closeness_sketched(links).collect()}
    assert got == {"a": (0.0, 0), "b": (1.0, 1), "c": (pytest.approx(2 / 3), 2)}
    none = spark.createDataFrame([], "src long, dst long")
    assert centrality.closeness_sketched(none).collect() == []
    assert centrality.closeness_sampled(none).collect() == []
    alone = centrality.closeness_sketched(none, spark.createDataFrame([(1,)], "id long")).collect()
    assert [(r.landmark, r.closeness, r.low, r.high) for r in alone] == [(1, 0.0, 0.0, 0.0)]


def test_all_pivots_give_points(spark):
    pairs = some_links(4, 40, 1)
    links = spark.createDataFrame(pairs, "src long, dst long")
    want = exact(proper(pairs), {end for pair in proper(pairs) for end in pair})
    got = centrality.closeness_sampled(links, pivots=1000).collect()
    assert {r.landmark for r in got} == set(want)
    for r in got:
        assert r.low == pytest.approx(closeness(*want[r.landmark])) == pytest.approx(r.high)
        assert r.reaching == want[r.landmark][0]


def test_intervals_hold_and_runs_agree(spark):
    pairs = some_links(5, 400, 3)
    links = spark.createDataFrame(pairs, "src long, dst long")
    want = exact(proper(pairs), {end for pair in proper(pairs) for end in pair})
    longest = max(found[2] for found in want.values())
    first = centrality.closeness_sampled(links, pivots=150, longest=longest).collect()
    again = centrality.closeness_sampled(links.repartition(7), pivots=150, longest=longest).collect()
    assert sorted(first) == sorted(again)
    held = sum(r.low - 1e-9 <= closeness(*want[r.landmark]) <= r.high + 1e-9 for r in first)
    assert held >= 0.95 * len(first)
    assert sum(r.high - r.low < 0.9 for r in first) > len(first) // 2


def test_bad_arguments(spark):
    links = spark.createDataFrame([(1, 2)], "src long, dst long")
    for bad in ({"pivots": 1}, {"confidence": 1.0}):
        with pytest.raises(ValueError):
            centrality.closeness_sampled(links, **bad)
