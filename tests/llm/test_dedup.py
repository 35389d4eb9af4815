"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from plazalens.llm import exact_dedup, near_dedup
from plazalens.llm.components import components
from plazalens.llm.shingles import shingle_sets

BLANK = re.compile(r"[\x20\x09-\x0D]+")
LONG = "long text " * 20_000


def normalised(text):
    return BLANK.sub(" ", text or "")


def exact_rows(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(normalised(text), []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[normalised(text)]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, hashlib.sha256(normalised(text).encode()).hexdigest()))
    return out


ROWS = [
    (5, "a  b"), (2, "a\tb"), (7, "a b"), (7, "a b"), (1, None), (9, ""), (3, " "), (4, "\n\x0b "), (8, LONG),
    (6, LONG.replace(" ", "\n")), (None, "a b"), (None, "alone"), (None, "alone"), (10, "A b"), (11, "é a b"), (12, "é a b"),
]


def test_exact_groups(documents):
    got = exact_dedup.exact_groups(documents(ROWS)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(exact_rows(ROWS), key=repr)


def test_exact_groups_of_no_rows(documents):
    assert exact_dedup.exact_groups(documents([])).collect() == []
    assert exact_dedup.drop_copies(documents([])).collect() == []


def test_a_third_of_all_rows_is_one_text(documents):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 200}") for i in range(3000)]
    got = exact_dedup.exact_groups(documents(rows)).collect()
    assert sorted(map(tuple, got)) == sorted(exact_rows(rows))


def test_drop_copies_keeps_columns_and_repeated_rows(documents):
    docs = documents(ROWS)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    kept = [row[0] for row in exact_rows(ROWS) if row[3]]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted(kept, key=repr)


def test_drop_copies_goes_by_id_and_text(documents):
    rows = [(1, "A"), (1, "B"), (0, "B"), (2, "A"), (1, "A"), (None, "C"), (None, "B"), (3, "C")]
    got = exact_dedup.drop_copies(documents(rows)).collect()
    kept = exact_dedup.exact_groups(documents(rows)).filter("kept").collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(0, "B"), (1, "A"), (1, "A"), (3, "C")]
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in kept)


def test_directory_splits_and_doubles():
    directory = exact_dedup.Directory(4, capacity=3)
    rng = random.Random(4)
    keys = [(0xA << 60) | rng.randrange(1 << 60) for _ in range(60)]
    keys += keys[:5]
    for key in keys:
        directory.chain(key).append(key)
    buckets = list(directory.buckets())
    assert sorted(key for _, _, bucket in buckets for key in bucket) == sorted(set(keys))
    assert all(len(bucket) <= 3 for _, _, bucket in buckets)
    assert max(depth for _, depth, _ in buckets) == directory.depth
    for number, depth, bucket in buckets:
        assert all(((key << 4) & (1 << 64) - 1) >> (64 - depth) == number for key in bucket if depth)
    for key in keys:
        assert key in directory.chain(key)


def test_a_bucket_that_has_used_all_bits_grows():
    directory = exact_dedup.Directory(4, capacity=3)
    keys = [(0xA << 60) | i for i in range(20)]
    for key in keys:
        directory.chain(key).append(key)
    assert directory.depth == exact_dedup.DEPTH
    assert sorted(key for _, _, bucket in directory.buckets() for key in bucket) == keys


def test_colliding_keys_are_compared_by_bytes():
    import pyarrow as pa

    rows = [(0, 1, b"x", b"dx", 4, 1), (0, 1, b"y", b"dy", 3, 2), (0, 1, b"x", b"dx", 2, 5), (0, 2, b"x", b"dx", 9, 1)]
    names = ["owner", "key", "text", "digest", "keep_id", "copies"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    (out,) = exact_dedup._own(1, 512)(iter([batch]))
    entries = [(r["key"], r["chain"], r["digest"], r["keep_id"], r["copies"]) for r in out.to_pylist()]
    assert sorted(entries) == [(1, 0, b"dx", 2, 6), (1, 1, b"dy", 3, 2), (2, 0, b"dx", 9, 1)]


def test_copies_within_a_batch_are_combined_by_bytes():
    import pyarrow as pa

    rows = [(0, 1, f"t{i % 300}".encode(), b"same" if i % 300 < 2 else b"d%d" % (i % 300), i) for i in range(900)]
    rows[5] = (*rows[5][:4], None)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["owner", "key", "text", "digest", "doc_id"])
    out = [row for part in exact_dedup._combine(iter([batch])) for row in part.to_pylist()]
    assert [(r["text"], r["copies"]) for r in out] == [(f"t{i}".encode(), 3) for i in range(300)]
    assert [r["keep_id"] for r in out] == [305 if i == 5 else i for i in range(300)]


def _index_of(documents, capacity):
    docs = documents([(i, "hot" if i % 3 == 0 else f"text {i}") for i in range(900)])
    return docs, exact_dedup.build_index(docs, 2, capacity=capacity)


@pytest.mark.parametrize("capacity", [2, 16, 512])
def test_written_directories_lead_to_the_buckets(documents, capacity):
    docs, index = _index_of(documents, capacity)
    rows = exact_dedup.keyed(docs).select("doc_id", "key", "digest")
    got = {r.doc_id: (r.keep_id, r.copies) for r in exact_dedup.look_up(rows, index, 2).collect()}
    assert got == {i: (0, 300) if i % 3 == 0 else (i, 1) for i in range(900)}
    for row in exact_dedup.directories(index).collect():
        assert len(row.slots) == 1 << row.deepest and max(row.slots) == row.deepest
    placed = {(r.owner, r.bucket, r.depth) for r in index.filter("key IS NOT NULL").collect()}
    found = exact_dedup.located(rows, index, 2).collect()
    assert {(r.owner, r.bucket, r.depth) for r in found} == placed
    assert max(depth for _, _, depth in placed) > 0 or capacity == 512


def test_a_wrong_directory_loses_texts(documents):
    from pyspark.sql import functions as F

    docs, index = _index_of(documents, 16)
    rows = exact_dedup.keyed(docs).select("doc_id", "key", "digest")
    wrong_bucket = index.withColumn("bucket", F.col("bucket").bitwiseXOR(F.lit(1)))
    assert exact_dedup.look_up(rows, wrong_bucket, 2).count() < 900
    shallower = index.withColumn("depth", F.greatest(F.col("depth") - 1, F.lit(0)))
    assert exact_dedup.look_up(rows, shallower, 2).count() < 900


# --- near duplicates ---------------------------------------------------------


def shingles(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def near_rows(rows, size, percent=80):
    sets = [(doc, shingles(text, size)) for doc, text in rows if doc is not None]
    least = {doc: doc for doc, _ in sets}

    def root(doc):
        while least[doc] != doc:
            doc = least[doc]
        return doc

    for i, (a, one) in enumerate(sets):
        for b, other in sets[:i]:
            if one and other and 100 * len(one & other) >= percent * len(one | other):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return [(d, len(shingles(t, size)), None if d is None else root(d), d is None or root(d) == d) for d, t in rows]


def variants(seed, groups=12, copies=8):
    rng = random.Random(seed)
    rows, doc = [], 100
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 5, 20, 80, 400]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                words[rng.randrange(len(words))] = f"v{rng.randrange(10_000)}"
            text = " ".join(words)
            rows.append((doc, text.upper() if rng.random() < 0.2 else text))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups(documents, size):
    odd = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"), (7, LONG), (8, LONG + "end")]
    rows = variants(size) + odd + [(4, "one")] * 2
    got = near_dedup.near_groups(documents(rows), shingle=size).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(near_rows(rows, size), key=repr)


def test_a_large_group_of_near_copies(documents):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(600):
        words = list(base)
        words[rng.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"x{i}y{j}" for j in range(30))) for i in range(100)]
    got = near_dedup.near_groups(documents(rows), shingle=4).collect()
    assert {r.component_id for r in got if r.doc_id < 600} == {0}
    assert all(r.kept for r in got if r.doc_id >= 1000)


@pytest.mark.parametrize("last", [3, 9])
def test_blocks_and_deep_nodes_find_what_is_left(documents, monkeypatch, last):
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "PART", 4)
    monkeypatch.setattr(near_dedup, "LAST_DEPTH", last)
    rows = variants(11)
    got = near_dedup.near_groups(documents(rows), shingle=4).collect()
    assert sorted(map(tuple, got)) == sorted(near_rows(rows, 4))


@pytest.mark.parametrize("part", [near_dedup.PART, 300])
def test_pairs_among_thousands_that_share_a_passage(documents, monkeypatch, part):
    """Documents of one passage and words of their own are at 0.67 of each other; 400 of them
    have a partner at 0.8. In smaller parts their nodes have to branch on."""
    monkeypatch.setattr(near_dedup, "PART", part)
    rng = random.Random(12)
    passage, rows = [f"p{i}" for i in range(158)], []
    for i in range(2400):
        own = [f"o{i}x{j}" for j in range(39)]
        rows.append((i, " ".join(passage + own)))
        if i < 400:
            changed = own[:18] + [f"c{i}x{j}" for j in range(21)]
            rows.append((10_000 + i, " ".join(passage + changed)))
    rng.shuffle(rows)
    by_id = dict(rows)
    for a, b, linked in [(0, 10_000, True), (0, 1, False), (10_000, 10_001, False)]:
        one, other = shingles(by_id[a], 4), shingles(by_id[b], 4)
        assert (100 * len(one & other) >= 80 * len(one | other)) == linked
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(documents(rows), shingle=4).collect()}
    found = sum(got[10_000 + i] == i for i in range(400))
    assert found >= 398
    assert all(got[i] == i for i in range(2400))


def test_thousands_of_near_copies_take_linear_work(spark, documents, monkeypatch):
    """Variants of one template, which link among themselves but often not with the smallest."""
    rng, seen = random.Random(9), []
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(3000):
        words = list(base)
        for at in rng.sample(range(150), 2):
            words[at] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(9000 + i, " ".join([f"z{i}a{j}" for j in range(100)] + base[:60])) for i in range(600)]
    compared = near_dedup._exhaustive

    def counted(part, join):
        links = compared(part, join)
        seen.append((part.count(), links.count()))
        return links

    monkeypatch.setattr(near_dedup, "_exhaustive", counted)
    got = near_dedup.near_groups(documents(rows), shingle=4).collect()
    assert {r.component_id for r in got if r.doc_id < 3000} == {0}
    assert all(r.kept for r in got if r.doc_id >= 9000)
    assert sum(members for members, _ in seen) <= 40 * len(rows)
    assert sum(links for _, links in seen) <= 20 * len(rows)


def test_trees_keep_the_promised_share():
    assert near_dedup.lost(3, 0.8) == pytest.approx(0.3575, abs=1e-3)
    for depth in (3, 6, 9, 15):
        trees = near_dedup.trees_for(depth, 0.8)
        assert near_dedup.lost(depth, 0.8) ** trees <= near_dedup.MISSED < near_dedup.lost(depth, 0.8) ** (trees - 1)


def test_bits_and_sets_agree_on_links(monkeypatch):
    rng = random.Random(4)
    texts = [text.encode() for _, text in variants(6)] + [b"", b"one"]
    pairs = np.array([(rng.randrange(len(texts)), rng.randrange(len(texts))) for _ in range(800)])
    found = []
    for words in (near_dedup.BIT_WORDS, 0):
        monkeypatch.setattr(near_dedup, "BIT_WORDS", words)
        found.append(near_dedup._Sets(texts, 4, 0.8).linked(*pairs[pairs[:, 0] != pairs[:, 1]].T))
    assert (found[0] == found[1]).all() and found[0].any()


def test_near_groups_of_no_rows(documents):
    assert near_dedup.near_groups(documents([])).collect() == []


def test_drop_near_copies(documents):
    docs = documents(variants(2) + [(None, "x"), (1, None)])
    got = near_dedup.drop_near_copies(docs, shingle=5)
    assert got.columns == docs.columns
    expected = [r[0] for r in near_rows(variants(2) + [(None, "x"), (1, None)], 5) if r[3]]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted(expected, key=repr)


def test_shingle_sets_are_those_of_the_words():
    texts = ["A b c d e", "a  b\tc d e", None, "", "a b", "a b c d a b c d", "É x y z"]
    sizes = [len(s) for s in shingle_sets([t.encode() if t is not None else None for t in texts], 4)]
    assert sizes == [len(shingles(t, 4)) for t in texts]
    one, two, *_ = shingle_sets([t.encode() for t in texts[:2]], 4)
    assert np.array_equal(one, two)


def test_a_very_long_text_leaves_nothing_behind():
    from plazalens.llm import shingles as module

    text = b" ".join(b"w%d" % i for i in range(600_000)) + b" end"
    (whole,) = shingle_sets([text], 4)
    assert len(whole) == 600_001 - 3
    (same,) = shingle_sets([text.replace(b" ", b"\n", 5)], 4)
    assert np.array_equal(whole, same)
    assert len(module._powers) <= 2 * module._CHUNK


def test_recall_of_the_trees():
    """Pairs at a similarity of 0.8 meet at depth 3 of some tree."""
    rng = np.random.default_rng(5)
    met = 0
    for _ in range(300):
        common = rng.integers(0, 1 << 63, 160, np.uint64)
        one, other = (np.concatenate((common, rng.integers(0, 1 << 63, 20, np.uint64))) for _ in range(2))
        signatures = np.stack([near_dedup.signature(one), near_dedup.signature(other)])
        together = False
        for tree in range(near_dedup.TREES):
            rows, nodes = np.arange(2), near_dedup.mix(np.full(2, tree + 1, np.uint64))
            for _ in range(near_dedup.FIRST_DEPTH):
                at, nodes = near_dedup.branch(nodes, signatures[rows], 0.8)
                rows = rows[at]
            together = together or bool(set(nodes[rows == 0]) & set(nodes[rows == 1]))
        met += together
    assert met >= 297


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(50)] + [(7, 7), (None, 3)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    least = {}

    def root(x):
        least.setdefault(x, x)
        while least[x] != x:
            x = least[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            least[y] = x
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, root(x)) for x in least)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
