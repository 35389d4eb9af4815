import os
import random
from collections import Counter, defaultdict, deque
from urllib.parse import urlsplit

import pytest

from plazalens.operators import graph
from plazalens.sources import deduplicate

# a chain to c, a hub with a repeated link, a loop, and a pair that reaches nothing else.
LINKS = [
    ("e", "d"), ("d", "c"), ("c", "b"), ("b", "a"), ("x", "hub"), ("y", "hub"), ("x", "hub"),
    ("hub", "a"), ("z", "z"), ("p", "q"), ("q", "p"), ("a", "e"),
]


@pytest.fixture
def links(spark):
    return spark.createDataFrame(LINKS, "src string, dst string")


def distances_by_hand(links, landmarks, directed=True):
    incoming = defaultdict(set)
    for src, dst in links:
        incoming[dst].add(src)
        if not directed:
            incoming[src].add(dst)
    found = {}
    for landmark in landmarks:
        reached, queue = {landmark: 0}, deque([landmark])
        while queue:
            at = queue.popleft()
            for before in incoming[at]:
                if before not in reached:
                    reached[before] = reached[at] + 1
                    queue.append(before)
        found.update({(landmark, id): hops for id, hops in reached.items()})
    return found


def as_dict(distances):
    rows = distances.collect()
    found = {(r.landmark, r.id): r.distance for r in rows}
    assert len(found) == len(rows)
    return found


def test_vertices_and_edges(posts):
    kept = deduplicate(posts)
    names = {"ann", "bob", "cat", "dan", "eve", "fay", "gus", "hub", "ian"}
    assert {r.id for r in graph.vertices(kept).collect()} == names
    with_null = graph.vertices(kept, keep_null=True)
    assert {r.id for r in with_null.collect()} == names | {None}
    assert with_null.count() == 10
    assert Counter(map(tuple, graph.edges(kept).collect())) == Counter(
        [("ann", "hub")] * 2
        + [("dan", "hub"), ("eve", "ann"), ("fay", "bob"), ("hub", "hub"), ("ian", "hub")]
    )


def test_network_size(posts):
    kept = deduplicate(posts)
    assert graph.network_size(kept).collect() == [(9, 10, 7)]
    assert graph.network_size(kept.limit(0)).collect() == [(0, 0, 0)]


def test_degrees(links):
    degrees = {r.id: r.degree for r in graph.degrees(links).collect()}
    expected = Counter(end for link in LINKS for end in link)
    assert degrees == expected
    assert degrees["hub"] == 4 and degrees["z"] == 2
    assert sum(degrees.values()) == 2 * len(LINKS)


def test_degree_share_and_ranking(links):
    top = graph.top_degrees(links, 3).collect()
    n = len(LINKS)
    assert [tuple(r) for r in top] == [
        ("hub", 4, round(400 / n, 2)), ("a", 3, 25.0), ("b", 2, round(200 / n, 2))]
    shares = graph.degree_share(links).collect()
    assert sum(r.fract_degree for r in shares) == pytest.approx(200, abs=0.1)


@pytest.mark.parametrize("directed", [True, False])
def test_hop_distances(links, directed):
    landmarks = ["a", "hub", "z", "q", "nowhere"]
    got = as_dict(graph.hop_distances(links, landmarks, directed))
    assert got == distances_by_hand(LINKS, landmarks, directed)
    if directed:
        assert got["a", "e"] == 4 and ("a", "p") not in got and got["nowhere", "nowhere"] == 0


def test_max_hops(links):
    assert as_dict(graph.hop_distances(links, ["a"], max_hops=0)) == {("a", "a"): 0}
    near = as_dict(graph.hop_distances(links, ["a"], max_hops=2))
    expected = distances_by_hand(LINKS, ["a"])
    assert near == {pair: hops for pair, hops in expected.items() if hops <= 2}


@pytest.mark.parametrize("directed", [True, False])
def test_split_hubs_change_nothing(spark, monkeypatch, directed):
    rng = random.Random(5)
    # A third of all links end in vertex 0; parts of at most four links for nine landmarks.
    rows = [(rng.randrange(40), rng.randrange(40)) for _ in range(70)]
    rows += [(n % 41, 0) for n in range(35)]
    landmarks = list(range(0, 41, 5))
    monkeypatch.setattr(graph, "_STEPS_PER_PART", 4 * len(landmarks))
    links = spark.createDataFrame(rows, "src int, dst int")
    _, splits = graph._laid_out(links, directed, graph._landmark_table(links, landmarks))
    assert max(r.parts for r in splits.collect()) > 5
    _, whole = graph._laid_out(links, directed, graph._landmark_table(links, [1]))
    assert max((r.parts for r in whole.collect()), default=1) < 5
    got = as_dict(graph.hop_distances(links, landmarks, directed))
    assert got == distances_by_hand(rows, landmarks, directed)


def test_a_long_chain_merges_its_rounds_and_keeps_nothing_cached(spark):
    rows = [(n + 1, n) for n in range(25)]
    links = spark.createDataFrame(rows, "src bigint, dst bigint")
    cached = len(spark.sparkContext._jsc.getPersistentRDDs())
    distances = graph.hop_distances(links, [0])
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == cached
    assert as_dict(distances) == {(0, n): n for n in range(26)}


def checkpoints(spark):
    folder = spark.sparkContext.getCheckpointDir()
    return set(os.listdir(urlsplit(folder).path)) if folder else set()


def test_a_long_chain_writes_each_pair_a_few_times(spark, monkeypatch):
    rows = [(n + 1, n) for n in range(33)]
    links = spark.createDataFrame(rows, "src bigint, dst bigint")
    graph.use_checkpoint_dir(spark)
    before, written = checkpoints(spark), []
    write = graph._written

    def counted(pairs):
        frame, size = write(pairs)
        written.append(size)
        return frame, size

    monkeypatch.setattr(graph, "_written", counted)
    spark.sparkContext.setJobGroup("chain", "chain")
    distances = graph.hop_distances(links, [0])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert distances.count() == 34
    assert len(jobs) < 414 // 2
    # 34 pairs, each written anew at most log2(34) times.
    assert sum(written) <= 34 * 6
    # What was merged is gone: the links, the splits and a logarithmic number of frames stay.
    assert len(checkpoints(spark) - before) <= 9


@pytest.mark.parametrize("directed", [True, False])
@pytest.mark.parametrize("batch", [64, 3])
def test_closeness_in_batches(spark, links, directed, batch):
    landmarks = ["a", "hub", "z", "q", "nowhere", "b", "c"]
    expected = graph.closeness(graph.hop_distances(links, landmarks, directed))
    got = graph.closeness_of(links, landmarks, directed, batch)
    assert got.dtypes == expected.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    with pytest.raises(ValueError):
        graph.closeness_of(links, landmarks, directed, 65)


def test_batches_hold_at_most_a_row_per_vertex(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.randrange(50), rng.randrange(50)) for _ in range(150)]
    links = spark.createDataFrame(rows, "src int, dst int")
    sizes, forget = [], graph.forget_checkpoint

    def counted(frame):
        sizes.append(frame.count())
        forget(frame)

    monkeypatch.setattr(graph, "forget_checkpoint", counted)
    got = {r.landmark: r.closeness for r in graph.closeness_of(links, range(50)).collect()}
    assert max(sizes) <= 50
    by_hand = distances_by_hand(rows, range(50))
    for landmark in range(50):
        hops = [d for (mark, _), d in by_hand.items() if mark == landmark]
        assert got[landmark] == ((len(hops) - 1) / sum(hops) if sum(hops) else 0.0)


@pytest.mark.parametrize("directed", [True, False])
def test_landmarks_share_rows_as_bits(spark, monkeypatch, directed):
    rng = random.Random(3)
    rows = [(rng.randrange(200), rng.randrange(200)) for _ in range(420)]
    links = spark.createDataFrame(rows, "src int, dst int")
    landmarks = list(range(200))  # four groups, the last of them not full
    written, write = [], graph._written

    def counted(frame):
        frame, size = write(frame)
        written.append(frame.collect())  # frames are deleted when they are merged
        return frame, size

    monkeypatch.setattr(graph, "_written", counted)
    got = as_dict(graph.hop_distances(links, landmarks, directed))
    assert got == distances_by_hand(rows, landmarks, directed)
    first = written[0]
    assert len(first) == 200 and len({r.group for r in first}) == 4
    assert len({(r.group, r.bits) for r in first}) == 200
    assert max(d for d in got.values()) > 4


def test_landmarks_are_numbered_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(graph, "_NUMBERED", 8)
    rows = [(n + 1, n) for n in range(12)] + [(n, 100) for n in range(50)]
    links = spark.createDataFrame(rows, "src bigint, dst bigint")
    landmarks = spark.range(0, 30, numPartitions=4)
    got = as_dict(graph.hop_distances(links, landmarks))
    assert got == distances_by_hand(rows, range(30))


def test_searches_of_two_threads_leave_the_setting_alone(spark):
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    with graph._in_one_job(spark):
        with graph._in_one_job(spark):
            assert spark.conf.get(key) == "false"
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before and not graph._users


def test_links_with_a_null_end_are_no_edges(spark):
    links = spark.createDataFrame([(1, None), (1, 2), (None, None)], "src int, dst int")
    assert sorted(map(tuple, graph.degree_share(links).collect())) == [(1, 1, 100.0), (2, 1, 100.0)]


def test_closeness(spark, links):
    landmarks = spark.createDataFrame([("a",), ("z",), ("q",), ("a",)], "v string")
    distances = graph.hop_distances(links, landmarks)
    by_hand = distances_by_hand(LINKS, ["a"])
    total = sum(by_hand.values())
    assert {r.landmark: r.closeness for r in graph.closeness(distances).collect()} == {
        "a": (len(by_hand) - 1) / total, "z": 0.0, "q": 1.0}


def test_closeness_of_all_vertices(posts):
    kept = deduplicate(posts)
    edges = graph.edges(kept)
    everyone = graph.closeness_of(edges, graph.vertices(kept))
    values = {r.landmark: r.closeness for r in everyone.collect()}
    assert values["hub"] == 4 / 5 and values["ann"] == 1.0 and values["cat"] == 0.0
    assert len(values) == 9
