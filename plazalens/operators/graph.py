"""The reshare graph: who reshares whom, degrees, hop distances and closeness."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import TOP_VERTICES
from ..sources.checkpoints import forget_checkpoint, use_checkpoint_dir
from ..sources.posts import POST_FIELDS, PostFields
from .ranking import top_k

# A vertex is split into parts whose links times all landmarks are at most this many steps,
# unless that is less than a ten-thousandth of all links. So at most _MAX_SPLIT vertices are.
_STEPS_PER_PART = 10_000_000
_MAX_SPLIT = 10_000
# Landmarks of a batch in `closeness_of`, or of a group in `hop_distances`: the bits of a long.
BATCH = 64
# A task numbers at least so many landmarks if there are so many, so that most groups are full.
_NUMBERED = 64 * BATCH


def vertices(
    posts: DataFrame, fields: PostFields = POST_FIELDS, keep_null: bool = False
) -> DataFrame:
    """``id``: distinct authors and reshared authors. ``keep_null`` keeps the NULL that
    posts without an original bring in."""
    both = F.array(F.col(fields.author), F.col(fields.source_author))
    ids = posts.select(F.explode(both).alias("id"))
    return (ids if keep_null else ids.dropna()).distinct()


def edges(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """``src``, ``dst``: author and reshared author, one row per reshare."""
    return posts.select(
        F.col(fields.author).alias("src"), F.col(fields.source_author).alias("dst")
    ).dropna()


def network_size(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """One row: ``users`` (distinct names), ``users_with_null`` (one more if some post has no
    author or no original), ``edges``."""
    author, source = F.col(fields.author), F.col(fields.source_author)
    is_edge = author.isNotNull() & source.isNotNull()
    ends = F.array(
        F.struct(author.alias("id"), is_edge.alias("is_edge")),
        F.struct(source.alias("id"), F.lit(False).alias("is_edge")),
    )
    per_user = (
        posts.select(F.explode(ends).alias("end"))
        .groupBy("end.id")
        .agg(F.count_if("end.is_edge").alias("edges"))
    )
    return per_user.agg(
        F.count("id").alias("users"),
        F.count("*").alias("users_with_null"),
        F.coalesce(F.sum("edges"), F.lit(0)).alias("edges"),
    )


def degrees(links: DataFrame) -> DataFrame:
    """``id``, ``degree``: incoming and outgoing edges of each vertex. Parallel edges count
    each, a loop counts twice, vertices without edges are absent. Links with a NULL end are
    no edges."""
    ends = links.select("src", "dst").dropna().select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def degree_share(links: DataFrame) -> DataFrame:
    """Degrees, and ``fract_degree``: the degree in percent of the number of edges.

    The number of edges is half the sum of the degrees, so the edges are read once.
    """
    per_vertex = degrees(links)
    n_edges = per_vertex.agg((F.sum("degree") / 2).alias("n")).scalar()
    return per_vertex.withColumn(
        "fract_degree", F.round(F.col("degree") / n_edges * 100, 2)
    )


def top_degrees(links: DataFrame, k: int = TOP_VERTICES) -> DataFrame:
    """The ``k`` vertices of highest degree, with their share of the edges."""
    return top_k(degree_share(links), [F.desc("degree"), F.asc("id")], k)


def hop_distances(
    links: DataFrame,
    landmarks: DataFrame | Iterable,
    directed: bool = True,
    max_hops: int | None = None,
) -> DataFrame:
    """``landmark``, ``id``, ``distance``: the fewest edges on a path from ``id`` to the
    landmark, along the edges' direction unless ``directed=False``. A landmark is at
    distance 0 from itself; vertices that do not reach it are absent.

    Breadth-first from all landmarks at once. Landmarks are numbered and searched in groups of
    up to 64, a bit each, so a vertex has one row per group and distance, with the bits of
    the landmarks that it reaches in that many hops. Each round joins the newest rows to the
    links that end in them and turns off the bits seen before. Links and seen rows are laid
    out once, so a round shuffles only the newest rows and the steps taken from them; ends
    of very many links are split, so no task holds a whole hub. Pairs are made of the bits
    when the result is read.

    A round writes its new rows once, as a checkpoint: that cuts the lineage, and a lost
    executor costs no earlier round. Checkpoints of like size are merged, so every row is
    written again a logarithmic number of times, few are joined in a round, and those merged
    are deleted at once. The result reads the last ones; Spark deletes them with it if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    use_checkpoint_dir(links.sparkSession)
    table = _landmark_table(links, landmarks)
    number = table.count()
    laid_out, splits = _laid_out(links, directed, table, number)
    newest, size = _written(_first_bits(table, splits, number))
    seen, hop = [_Seen(newest, size)], 0
    try:
        while size and (max_hops is None or hop < max_hops):
            hop += 1
            steps = _next_hop(laid_out, newest, [frame.known for frame in seen], hop)
            newest, size = _written(steps)
            if size:
                seen.append(_Seen(newest, size))
                _merge_alike(seen)
            else:
                forget_checkpoint(newest)
    finally:
        laid_out.unpersist()
        for frame in seen:
            frame.known.unpersist()
    return _pairs(_union([frame.rows for frame in seen]))


def _first_bits(landmarks: DataFrame, splits: DataFrame, number: int) -> DataFrame:
    """``group``, ``id``, ``parts``, ``bits``, ``distance``: each of the landmarks, of which
    there are ``number``, with its own bit."""
    row = F.monotonically_increasing_id()
    bit = row.bitwiseAND(BATCH - 1).cast("int")
    return _at_landmarks(landmarks.coalesce(max(1, number // _NUMBERED)), splits).select(
        F.shiftright(row, 6).alias("group"),
        "id",
        "parts",
        F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"),
        "distance",
    )


def _bits_on(bits: str) -> Column:
    """The places of the bits that are on."""
    places = F.sequence(F.lit(0), F.lit(BATCH - 1))
    return F.filter(places, lambda place: F.getbit(F.col(bits), place) == 1)


def _pairs(found: DataFrame) -> DataFrame:
    """``landmark``, ``id``, ``distance`` of rows with bits. Rows at distance 0 tell which
    landmark a bit stands for; a group has at most 64 of them."""
    names = (
        found.filter("distance = 0")
        .select("group", F.explode(_bits_on("bits")).alias("place"), F.col("id").alias("landmark"))
        .groupBy("group")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "landmark"))).alias("names"))
    )
    return (
        found.join(names, "group")
        .select("names", F.explode(_bits_on("bits")).alias("place"), "id", "distance")
        .select(F.col("names")[F.col("place")].alias("landmark"), "id", "distance")
    )


def _written(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows checkpointed, and their number from the same job."""
    counted = Observation()
    with _in_one_job(rows.sparkSession):
        written = rows.observe(counted, F.count("*").alias("rows")).checkpoint()
    return written, counted.get["rows"]


_one_job = threading.Lock()
_users: dict[SparkSession, list] = {}
"""Sessions with jobs in one: how many run, and the setting before the first."""


@contextmanager
def _in_one_job(spark: SparkSession):
    """Plan without adaptive execution, which would run a job for every cached frame and
    shuffle of a round. What it does is done here: hubs are split, and layouts are kept.
    Of several threads the first saves the session's setting and the last restores it."""
    key = "spark.sql.adaptive.enabled"
    with _one_job:
        users = _users.setdefault(spark, [0, spark.conf.get(key)])
        users[0] += 1
        spark.conf.set(key, "false")
    try:
        yield
    finally:
        with _one_job:
            users[0] -= 1
            if not users[0]:
                spark.conf.set(key, _users.pop(spark)[1])


class _Seen:
    """Checkpointed rows, and the bits of each group and vertex laid out for joins with steps.
    The layout is made by the first join that needs it and is neither shuffled nor sorted again;
    what is lost of it comes back from the checkpoint."""

    def __init__(self, rows: DataFrame, size: int):
        keys = ["group", "id"]
        self.rows, self.size = rows, size
        # A merged frame has a row for each distance.
        laid_out = rows.repartition(*keys).groupBy(*keys).agg(F.bit_or("bits").alias("known"))
        self.known = laid_out.sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def _merge_alike(seen: list[_Seen]) -> None:
    """Merge the last frames while the one before is at most twice as large. The newest rows
    are still needed by themselves, so they stay out until the next round."""
    while len(seen) > 2 and seen[-3].size <= 2 * seen[-2].size:
        last, two, one = seen.pop(), seen.pop(), seen.pop()
        merged, size = _written(_union([one.rows, two.rows]))
        for frame in (one, two):
            frame.known.unpersist()
            forget_checkpoint(frame.rows)
        seen += [_Seen(merged, size), last]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _at_landmarks(landmarks: DataFrame, splits: DataFrame) -> DataFrame:
    return landmarks.join(F.broadcast(splits), "id", "left").select(
        F.col("id").alias("landmark"),
        "id",
        F.coalesce("parts", F.lit(1)).alias("parts"),
        F.lit(0).alias("distance"),
    )


def _next_hop(links: DataFrame, newest: DataFrame, seen: list[DataFrame], hop: int) -> DataFrame:
    """The rows reached in ``hop`` edges, with the bits of those reached in no fewer. Tasks
    merge repeated rows before the shuffle."""
    reached = newest.select(
        "group",
        F.col("id").alias("dst"),
        F.explode(F.sequence(F.lit(1), "parts")).alias("part"),
        "bits",
    )
    steps = (
        links.join(reached, ["dst", "part"])
        .groupBy("group", F.col("src").alias("id"))
        .agg(F.max("src_parts").alias("parts"), F.bit_or("bits").alias("bits"))
    )
    new = F.when(F.col("known").isNull(), F.col("bits")).otherwise(
        F.col("bits").bitwiseAND(F.bitwise_not("known"))
    )
    for known in seen:
        steps = steps.join(known, ["group", "id"], "left")
        steps = steps.select("group", "id", "parts", new.alias("bits")).filter("bits <> 0")
    return steps.withColumn("distance", F.lit(hop))


def closeness(distances: DataFrame) -> DataFrame:
    """``landmark``, ``closeness`` from `hop_distances`: the number of other vertices that
    reach the landmark over the sum of their distances; 0 if none does. For the closeness of
    all vertices use `closeness_of`, which does not need all pairs."""
    reaching, total = F.count("*"), F.sum("distance")
    value = F.when((total > 0) & (reaching > 1), (reaching - 1) / total).otherwise(0.0)
    return distances.groupBy("landmark").agg(value.alias("closeness"))


def closeness_of(
    links: DataFrame, landmarks: DataFrame | Iterable, directed: bool = True, batch: int = BATCH
) -> DataFrame:
    """``landmark``, ``closeness`` of very many landmarks, such as all `vertices`.

    Landmarks are taken in batches of at most 64, a bit each. What is held is one row per
    vertex with the bits of the batch's landmarks that it reaches. Every round adds its number
    of new bits, and their distance, to the batch's sums, 64 numbers at most. A batch's result
    is written and its rows are dropped, so there are never more rows than vertices.
    """
    if not 0 < batch <= BATCH:
        raise ValueError(f"a batch has 1 to {BATCH} landmarks")
    spark = links.sparkSession
    use_checkpoint_dir(spark)
    table = _landmark_table(links, landmarks)
    laid_out, splits = _laid_out(links, directed, table)
    # The number of a row in its part, which is the number's upper bits.
    row = F.monotonically_increasing_id()
    numbered = _at_landmarks(table, splits).select("id", "parts", row.alias("row")).checkpoint()
    part, place = F.shiftright("row", 33).alias("part"), F.col("row").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part).agg(F.count("*").alias("n")).collect()  # a row per task
    folder = f"{spark.sparkContext.getCheckpointDir()}/closeness-{uuid.uuid4().hex}"
    kind = links.schema["dst"].dataType.simpleString()
    spark.createDataFrame([], f"landmark {kind}, closeness double").write.parquet(folder)
    try:
        for part, n in sizes:
            for first in range(0, n, batch):
                inside = (F.shiftright("row", 33) == part) & place.between(first, first + batch - 1)
                bit = (place - first).cast("int")
                members = numbered.filter(inside).select("id", "parts", bit.alias("bit"))
                _batch_closeness(laid_out, members).write.mode("append").parquet(folder)
    finally:
        laid_out.unpersist()
    forget_checkpoint(numbered)
    return spark.read.schema(f"landmark {kind}, closeness double").parquet(folder)


def _batch_closeness(links: DataFrame, members: DataFrame) -> DataFrame:
    reached, total, hop = [0] * BATCH, [0] * BATCH, 0
    newest = members.select("id", "parts", F.expr("shiftleft(1L, bit)").alias("bits")).checkpoint()
    state = newest
    while True:
        hop += 1
        sources = newest.select(
            F.col("id").alias("dst"), F.explode(F.sequence(F.lit(1), "parts")).alias("part"), "bits"
        )
        steps = links.join(sources, ["dst", "part"]).groupBy(F.col("src").alias("id"))
        steps = steps.agg(F.max("src_parts").alias("parts"), F.bit_or("bits").alias("bits"))
        known = state.select("id", F.col("bits").alias("known"))
        new = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("long"))))
        fresh = steps.join(known, "id", "left").select("id", "parts", new.alias("bits"))
        fresh = fresh.filter("bits <> 0").checkpoint()
        counts = [F.sum(F.getbit("bits", F.lit(i)).cast("long")).alias(str(i)) for i in range(BATCH)]
        found = fresh.agg(*counts).first()
        if found["0"] is None:
            break
        for i in range(BATCH):
            reached[i] += found[str(i)]
            total[i] += hop * found[str(i)]
        merged = state.unionByName(fresh).groupBy("id")
        merged = merged.agg(F.max("parts").alias("parts"), F.bit_or("bits").alias("bits")).checkpoint()
        for frame in {state, newest}:
            forget_checkpoint(frame)
        state, newest = merged, fresh
    for frame in {state, newest, fresh}:
        forget_checkpoint(frame)
    values = [float(n / d) if d else 0.0 for n, d in zip(reached, total)]
    value = F.element_at(F.array(*map(F.lit, values)), F.col("bit") + 1)
    return members.select(F.col("id").alias("landmark"), value.alias("closeness"))


def _landmark_table(links: DataFrame, landmarks: DataFrame | Iterable) -> DataFrame:
    if not isinstance(landmarks, DataFrame):
        kind = links.schema["dst"].dataType.simpleString()
        rows = [(landmark,) for landmark in landmarks]
        landmarks = links.sparkSession.createDataFrame(rows, f"id {kind}")
    return landmarks.select(F.col(landmarks.columns[0]).alias("id")).dropna().distinct()


def _laid_out(
    links: DataFrame, directed: bool, landmarks: DataFrame, number: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Distinct links partitioned by end vertex and part, and the split vertices.

    A part holds fewer links the more landmarks there are (``number``, counted if it is not
    given), as every landmark that reached a hub takes a step along each of its links.

    Links: ``src``, ``dst``, ``part`` of dst's links this one is in, and ``src_parts``, the
    number of parts src's own links are in. They are persisted, which keeps their
    partitioning for the joins; what is lost with an executor comes back from the
    checkpointed pairs.

    Splits: ``id``, ``parts``, at most ``_MAX_SPLIT`` rows since each of them ends more
    than 1 / ``_MAX_SPLIT`` of the links. That bound makes them safe to broadcast.
    """
    pairs = links.select("src", "dst")
    if not directed:
        there, back = F.struct("src", "dst"), F.struct(
            F.col("dst").alias("src"), F.col("src").alias("dst")
        )
        pairs = pairs.select(F.explode(F.array(there, back)).alias("way")).select("way.*")
    pairs = pairs.filter(F.col("src") != F.col("dst")).distinct()
    counted = Observation()
    pairs = pairs.observe(counted, F.count("*").alias("links")).checkpoint()

    number = landmarks.count() if number is None else number
    steps = max(1, _STEPS_PER_PART // max(1, number))
    per_part = max(steps, -(-counted.get["links"] // _MAX_SPLIT))
    splits = (
        pairs.groupBy(F.col("dst").alias("id"))
        .agg(F.count("*").alias("links"))
        .filter(F.col("links") > per_part)
        .select("id", F.ceil(F.col("links") / per_part).cast("int").alias("parts"))
        .checkpoint()
    )
    ends = splits.withColumnsRenamed({"id": "dst", "parts": "dst_parts"})
    starts = splits.withColumnsRenamed({"id": "src", "parts": "src_parts"})
    part = F.pmod(F.xxhash64("src"), F.coalesce("dst_parts", F.lit(1))) + 1
    laid_out = (
        pairs.join(F.broadcast(ends), "dst", "left")
        .join(F.broadcast(starts), "src", "left")
        .select(
            "src",
            "dst",
            part.cast("int").alias("part"),
            F.coalesce("src_parts", F.lit(1)).alias("src_parts"),
        )
        .repartition("dst", "part")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    laid_out.count()
    return laid_out, splits
