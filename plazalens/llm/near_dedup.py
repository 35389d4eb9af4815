"""Near duplicates: a set similarity join along chosen paths.

Every document is its set of word shingles; equal sets are one representative. A tree starts
with all representatives in its root. A node chooses one or two positions of the minwise
signature by a hash of its own path, so that every document finds its way alone, and a document
goes to the child that its minwise value at a chosen position names. With a threshold t a node
chooses 1/t positions on average: a pair of similarity t then stays together in one child on
average. At depth 3 nodes are compared, and several trees bring the recall up: of pairs at a
similarity of 0.8 the default eight, which share a signature of 64 positions, miss 0.0011, the floor of
agreement included.

Nothing is quadratic in a group of copies. Every member of a node is first compared with the
node's smallest one. Those confirmed links make labels, and only members with different labels are
compared within a node after that. A node with many members outside its main label is compared in
parts of bounded size. What the parts of all nodes find is exchanged as labels, which leaves a
group of near copies one label in all its nodes. The members of nodes that still hold many labels
branch on: in new trees, deeper by three levels, over fresh minwise positions, and in as many of
them as keep the share of missed pairs at `MISSED`. Links are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, parts
from .components import components
from .shingles import mix, shingle_sets

POSITIONS = 64
TREES = 8
FIRST_DEPTH, DEEPER, LAST_DEPTH = 3, 3, 15
"""Nodes are compared at the first depth; members of large ones go on that much deeper, and large
nodes of the last depth are compared block by block."""
MISSED = 0.001
"""Share of pairs at the threshold that the trees of a further depth may miss."""
SMALL = 256
"""Members of a node without its main label, at most, for it to be compared exhaustively."""
PART = 2048
"""Members in a part of a larger node."""
BIT_WORDS = 1 << 22
"""Words of 64 bits that the sets of a node may take as rows of bits."""
BROADCAST_IDS = 1_000_000
"""Ids sent to every task to pick texts, at most (8 bytes each); more are joined by a shuffle."""



@lru_cache(maxsize=8)
def _functions(seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_917 + seed)
    xor = rng.integers(0, 1 << 63, POSITIONS, np.uint64)
    return xor, rng.integers(0, 1 << 62, POSITIONS, np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, seed: int = 0) -> np.ndarray:
    """The upper 32 bits of the smallest value of each of 64 hash functions, which the seed names."""
    xor, odd = _functions(seed)
    with np.errstate(over="ignore"):
        values = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), 4096):
            part = shingles[at : at + 4096, None]
            np.minimum(values, ((part ^ xor) * odd).min(axis=0), out=values)
    return (values >> np.uint64(32)).astype("<u4")


def lost(depth: int, similarity: float) -> float:
    """The chance that a tree parts a pair of this similarity before a depth: a node chooses a
    second position with a chance of 1/t - 1, and each child keeps the pair with a chance of t."""
    twice, chance = min(1.0, 1 / similarity - 1), 0.0
    for _ in range(depth):
        child = 1 - similarity + similarity * chance
        chance = (1 - twice) * child + twice * child * child
    return chance


def trees_for(depth: int, similarity: float, missed: float = MISSED) -> int:
    """Trees of a depth that together miss no more than a share of the pairs."""
    chance = lost(depth, similarity)
    return 1 if chance <= missed else math.ceil(math.log(missed) / math.log(chance))


def branch(nodes: np.ndarray, signatures: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The children of each row's node that the row goes to: row numbers and child nodes."""
    with np.errstate(over="ignore"):
        n = np.uint64(POSITIONS)
        first = mix(nodes ^ np.uint64(0xA5A5)) % n
        second = (first + np.uint64(1) + mix(nodes ^ np.uint64(0x5A5A)) % (n - np.uint64(1))) % n
        share = (mix(nodes ^ np.uint64(0x3C3C)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        twice = np.flatnonzero(share < min(1.0, 1 / similarity - 1))
        rows = np.concatenate((np.arange(len(nodes)), twice))
        chosen = np.concatenate((first, second[twice]))
        value = signatures[rows, chosen.astype(np.int64)].astype(np.uint64)
        return rows, mix(mix(nodes[rows]) + (chosen << np.uint64(32)) + value)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, POSITIONS)


_SETS = "doc_id long, n_shingles long, digest binary, signature binary"


def _describe(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, signatures = [], [], []
            for shingles in shingle_sets(batch.column(1).to_pylist(), size):
                counts.append(len(shingles))
                data = shingles.tobytes()
                digests.append(hashlib.blake2b(data, digest_size=16).digest() if data else None)
                signatures.append(signature(shingles).tobytes() if data else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "digest", "signature"],
            )

    return describe


def _children(trees: int, depth: int, similarity: float, signatures: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each tree the nodes at a depth, and the row that reached each."""
    for tree in range(trees):
        rows = np.arange(len(signatures))
        nodes = mix(np.full(len(signatures), tree + 1, np.uint64))
        for _ in range(depth):
            at, nodes = branch(nodes, signatures[rows], similarity)
            rows = rows[at]
        yield nodes, rows


def _paths(trees: int, depth: int, similarity: float):
    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            reps = batch.column(0).to_numpy(zero_copy_only=False)
            for nodes, rows in _children(trees, depth, similarity, _matrix(batch.column(1))):
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(reps[rows])], ["node", "rep"])

    return paths


def _deeper(trees: int, depth: int, similarity: float, size: int):
    """Rows ``rep, label, text`` to their nodes in trees over positions that are named by the
    depth, ``node, rep, label``."""

    def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingle_sets(batch.column(2).to_pylist(), size)
            signatures = np.stack([signature(shingles, depth) for shingles in sets])
            for nodes, rows in _children(trees, depth, similarity, signatures):
                taken = batch.select([0, 1]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), *taken.columns], ["node", "rep", "label"])

    return deeper


def _agreeing(floor: float):
    """Of pairs with both signatures, those that agree in at least a share of the positions."""

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).mean(axis=1) >= floor
                yield batch.select([0, 1]).filter(pa.array(same))

    return agreeing


_ROUND = 4096
"""Pairs of a node between two looks at which of them still have different labels."""


class _Sets:
    """The shingle sets of some texts, and which pairs of them are linked. Shingles that are in
    several sets become bits, so many pairs are compared by popcounts at once, as long as the bits
    are few enough; other pairs are compared one by one."""

    def __init__(self, texts: list[bytes], size: int, similarity: float):
        self._sets, self._similarity = list(shingle_sets(texts, size)), similarity
        self._sizes = np.array([len(shingles) for shingles in self._sets])
        rows = np.repeat(np.arange(len(texts)), self._sizes)
        _, codes, counts = np.unique(np.concatenate(self._sets), return_inverse=True, return_counts=True)
        shared = counts > 1
        words = (int(shared.sum()) + 63) // 64
        self._bits = None
        if 0 < words * len(texts) <= BIT_WORDS:
            there = shared[codes]
            rows, codes = rows[there], (np.cumsum(shared) - 1)[codes[there]]
            self._bits = np.zeros((len(texts), words), np.uint64)
            np.bitwise_or.at(self._bits, (rows, codes >> 6), np.uint64(1) << (codes & 63).astype(np.uint64))

    def linked(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        if self._bits is None:
            return np.array([_linked(self._sets[i], self._sets[j], self._similarity) for i, j in zip(one.tolist(), other.tolist())], bool)
        step, common = max(1, (1 << 18) // self._bits.shape[1]), []
        for at in range(0, len(one), step):
            both = self._bits[one[at : at + step]] & self._bits[other[at : at + step]]
            common.append(np.bitwise_count(both).sum(axis=1, dtype=np.int64))
        shared = np.concatenate(common)
        return (shared > 0) & (100 * shared >= round(100 * self._similarity) * (self._sizes[one] + self._sizes[other] - shared))


def _agreeing_pairs(labels: np.ndarray, signatures: np.ndarray, floor: float) -> np.ndarray:
    """Pairs of members with different labels whose signatures agree, the most similar first."""
    found = []
    for i in range(len(labels) - 1):
        other = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
        agreed = (signatures[other] == signatures[i]).sum(axis=1)
        near = agreed >= floor * POSITIONS
        found.append(np.stack((np.full(near.sum(), i), other[near], -agreed[near]), 1).astype(np.int32))
    pairs = np.concatenate(found) if found else np.empty((0, 3), np.int32)
    return pairs[np.argsort(pairs[:, 2], kind="stable"), :2]


def _links_of_node(rows: list[pa.RecordBatch], size: int, similarity: float, floor: float) -> list[tuple[int, int]]:
    """Compare the members of a node that have different labels. Pairs whose signatures agree
    are compared on full sets, the most similar first, unless their labels are joined by then."""
    reps = np.concatenate([r.column(1).to_numpy(zero_copy_only=False) for r in rows])
    labels = np.concatenate([r.column(2).to_numpy(zero_copy_only=False) for r in rows])
    signatures = np.concatenate([_matrix(r.column(3)) for r in rows])
    pairs = _agreeing_pairs(labels, signatures, floor)
    if not len(pairs):
        return []
    used, at = np.unique(pairs, return_inverse=True)
    pairs, reps, labels = at.reshape(-1, 2), reps[used], np.unique(labels[used], return_inverse=True)[1]
    column = pa.chunked_array([r.column(4) for r in rows]).take(pa.array(used))
    sets, links = _Sets(column.to_pylist(), size, similarity), []
    while len(pairs):
        some, pairs = pairs[:_ROUND], pairs[_ROUND:]
        for i, j in some[sets.linked(some[:, 0], some[:, 1])].tolist():
            if labels[i] != labels[j]:
                labels[labels == labels[j]] = labels[i]
                links.append((int(reps[i]), int(reps[j])))
        pairs = pairs[labels[pairs[:, 0]] != labels[pairs[:, 1]]]
    return links


def _compare_nodes(size: int, similarity: float, floor: float):
    """Rows ``node, rep, label, signature, text`` sorted by node: links between labels."""

    def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = _links_of_node(rows, size, similarity, floor)
        sides = [pa.array([side(pair) for pair in found], pa.int64()) for side in (min, max)]
        return pa.RecordBatch.from_arrays(sides, ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []
        for batch in batches:
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(nodes[1:] != nodes[:-1]) + 1).tolist(), len(nodes)]
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if nodes[start] != node and held:
                    yield links(held)
                    held = []
                node = nodes[start]
                held.append(batch.slice(start, end - start))
        if held:
            yield links(held)

    return compare


def _linked(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """100 i >= 100 t u, for i shingles in both sets and u in either."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return common > 0 and 100 * common >= round(100 * similarity) * (len(one) + len(other) - common)


def _confirm(size: int, similarity: float):
    """Rows ``a, text_a, b, text_b`` whose sets overlap enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            a, text_a, b, text_b = (column.to_pylist() for column in batch.columns)
            hits = []
            for row, other in enumerate(shingle_sets(text_b, size)):
                if text_a[row] != last or last_set is None:
                    last, last_set = text_a[row], next(shingle_sets([text_a[row]], size))
                if _linked(last_set, other, similarity):
                    hits.append(row)
            yield batch.select([0, 2]).take(pa.array(hits, pa.int64()))

    return confirm


class _Join:
    def __init__(self, texts: DataFrame, size: int, similarity: float, few: bool):
        self.texts, self.size, self.similarity, self.few = texts, size, similarity, few
        self.floor = max(0.0, similarity - 0.2)  # four standard deviations of 64 positions

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among candidate pairs ``a, b``."""
        pairs = kept(pairs.distinct(), "candidates")
        texts = kept(self.texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id"))), "texts")
        sides = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        sides = sides.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        sides = sides.select("a", "text_a", "b", "text_b")
        return kept(sides.mapInArrow(_confirm(self.size, self.similarity), "a long, b long").distinct(), "links")

    def texts_of(self, ids: DataFrame) -> DataFrame:
        """``id``, ``text`` of some documents."""
        ids = ids.distinct()
        return self.texts.join(F.broadcast(ids) if self.few else ids, "id", "left_semi")

    def agreeing(self, pairs: DataFrame, reps: DataFrame) -> DataFrame:
        one, other = (
            reps.select(F.col("rep").alias(name), F.col("signature").alias(f"signature_{name}")) for name in "ab"
        )
        both = pairs.join(one, "a").join(other, "b").select("a", "b", "signature_a", "signature_b")
        return both.mapInArrow(_agreeing(self.floor), "a long, b long")


def _mixed(members: DataFrame) -> DataFrame:
    """Nodes whose members have different labels: ``n`` members, the most frequent label
    ``main`` and the number of ``others``."""
    by_label = members.groupBy("node", "label").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "label")).alias("most")
    nodes = by_label.groupBy("node").agg(F.sum("n").alias("n"), most, F.count("*").alias("labels"))
    nodes = nodes.filter("labels > 1").select("node", "n", F.col("most.label").alias("main"), (F.col("n") - F.col("most.n")).alias("others"))
    return kept(nodes, "nodes")


def _leaf_links(members: DataFrame, reps: DataFrame, stars: DataFrame, join: _Join) -> DataFrame:
    """Links within nodes ``node, rep, label``; ``stars`` has the links that made the labels.

    Members with the main label need comparing with the others only, so a node with few others is
    small, however large a group of near copies lies in it. Members of large nodes get the labels
    that all nodes' links make, which leaves few large nodes. The members of these branch on."""
    rows, depth = _mixed(members, reps), FIRST_DEPTH
    found = _exhaustive(_dealt(rows), join)
    while not (large := rows.filter(_is_large())).isEmpty():
        stars = kept(components(found.unionByName(stars)), "labels")
        rows = _mixed(_labelled(large.select("node", "rep"), stars), reps)
        stars = stars.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
        found = found.unionByName(_exhaustive(_dealt(rows.filter(~_is_large())), join))
        large = rows.filter(_is_large())
        if large.isEmpty():
            break
        if depth >= LAST_DEPTH:
            return found.unionByName(_blockwise(large, join))
        depth += DEEPER
        some = kept(large.select("rep", "label").distinct(), "large")
        texts = join.texts_of(some.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep")
        to_nodes = _deeper(trees_for(depth, join.similarity), depth, join.similarity, join.size)
        texts = some.join(texts, "rep").select("rep", "label", "text")
        rows = _mixed(kept(texts.mapInArrow(to_nodes, "node long, rep long, label long").distinct(), "deeper"), reps)
        found = found.unionByName(_exhaustive(_dealt(rows), join))
    return found


def _is_large() -> Column:
    return (F.col("others") > SMALL) & (F.col("n") > PART)


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members ``node, rep`` with their labels: their components, or themselves."""
    labels = labels.withColumnRenamed("id", "rep")
    return members.join(labels, "rep", "left").select("node", "rep", F.coalesce("component", "rep").alias("label"))


def _mixed(members: DataFrame, reps: DataFrame) -> DataFrame:
    """The members of nodes with different labels, with their signatures, and of their node the
    number of members ``n``, the most frequent label ``main`` and the number of ``others``."""
    members = kept(members, "members")
    by_label = members.groupBy("node", "label").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "label")).alias("most")
    nodes = by_label.groupBy("node").agg(F.sum("n").alias("n"), most, F.count("*").alias("labels"))
    nodes = nodes.filter("labels > 1").select("node", "n", F.col("most.label").alias("main"), (F.col("n") - F.col("most.n")).alias("others"))
    rows = members.join(nodes, "node").join(reps, "rep")
    return kept(rows.select("node", "rep", "label", "signature", "n", "main", "others"), "mixed")


def _dealt(rows: DataFrame) -> DataFrame:
    """Nodes in parts. The members with the main label are dealt out, and so are the others of large
    nodes; the few others of small ones are sent to each part."""
    parts_ = F.ceil(F.col("n") / F.lit(PART)).cast("long")
    one = F.array(F.pmod(F.xxhash64("rep", "node"), parts_))
    every = F.sequence(F.lit(0).cast("long"), parts_ - 1)
    part = F.explode(F.when((F.col("label") == F.col("main")) | _is_large(), one).otherwise(every)).alias("part")
    rows = rows.select("node", "rep", "label", "signature", part)
    return rows.select(F.xxhash64("node", "part").alias("node"), "rep", "label", "signature")


def _exhaustive(rows: DataFrame, join: _Join) -> DataFrame:
    """The links that tasks find in nodes, which they compare with full texts."""
    rows = rows.select("node", "rep", "label", "signature")
    texts = join.texts_of(rows.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep")
    rows = rows.join(texts, "rep").select("node", "rep", "label", "signature", "text")
    rows = rows.repartition(parts(rows), "node").sortWithinPartitions("node")
    compare = _compare_nodes(join.size, join.similarity, join.floor)
    return kept(rows.mapInArrow(compare, "a long, b long"), "links")


def _blockwise(rows: DataFrame, join: _Join) -> DataFrame:
    """Members of a node in blocks, each pair of blocks a small node of its own. Blocks of
    members with the main label are paired with blocks of others only."""
    is_main = F.col("label") == F.col("main")
    blocks = F.ceil(F.col("others") / F.lit(SMALL // 2)).cast("long")
    mains = F.ceil((F.col("n") - F.col("others")) / F.lit(SMALL // 2)).cast("long")
    mine = F.when(is_main, F.col("blocks") + F.pmod(F.xxhash64("rep"), mains)).otherwise(F.pmod(F.xxhash64("rep"), "blocks"))
    rows = rows.withColumn("blocks", blocks).withColumn("mine", mine)
    last = F.when(is_main, F.col("blocks")).otherwise(F.col("blocks") + mains) - 1
    other = F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("other")
    rows = rows.select("node", "rep", "label", "signature", "mine", other)
    pair = F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node")
    return _exhaustive(rows.select(pair, "rep", "label", "signature"), join)


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    trees: int = TREES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id that
    links reach), ``kept`` (it is that id).

    Words are runs of non-blanks with A-Z in lower case. Texts without words, NULL ones too,
    have no shingles and link with nothing. Equal sets are linked. Repeated rows, and other rows
    that share an id, count as one document with the links of all. A row without an id is
    linked with nothing: its component is NULL and it is kept. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    sets = kept(rows.mapInArrow(_describe(shingle), _SETS), "sets")
    usable = sets.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    groups = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    groups = kept(groups, "groups")
    reps = groups.select("rep", "signature")
    texts = rows.filter("doc_id IS NOT NULL").withColumnRenamed("doc_id", "id")
    join = _Join(texts, shingle, similarity, few=reps.count() <= BROADCAST_IDS)

    paths = kept(reps.mapInArrow(_paths(trees, FIRST_DEPTH, similarity), "node long, rep long"), "paths")
    nodes = paths.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("first"))
    members = kept(paths.join(nodes.filter("n > 1").select("node", "first"), "node"), "members")
    stars = members.filter("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    links = join.confirmed(join.agreeing(stars, reps))

    # A member's label is its smallest centre's, one step on; members of one label are connected.
    centre = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("a"))
    centre = kept(centre, "centres")
    above = centre.select(F.col("id").alias("a"), F.col("a").alias("above"))
    labels = centre.join(above, "a", "left").select("id", F.coalesce("above", "a").alias("component"))
    more = _leaf_links(_labelled(members.select("node", "rep"), labels), reps, links, join)

    # Ids that share a set, and so a representative, are members of its component as well.
    same = usable.select("doc_id", "digest").join(groups.select("digest", "rep"), "digest")
    same = same.filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = kept(components(more.unionByName(links).unionByName(same)), "components")
    out = sets.select("doc_id", "n_shingles").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """The documents that stay, one of each component, with all their columns."""
    groups = near_groups(docs, id_col, text_col, shingle)
    gone = groups.filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")
