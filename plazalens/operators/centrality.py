"""Closeness of all vertices of graphs that are too large for a search from each of them: by
mergeable sketches of who reaches whom, and by searches from a sample of pivots."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.checkpoints import forget_checkpoint, use_checkpoint_dir
from .graph import hop_distances

LG_K = 12
"""Logarithm of the sketch's number of registers."""
DEVIATIONS = 3.0
PIVOTS = 256
CONFIDENCE = 0.95


def sketch_error(lg_k: int = LG_K, deviations: float = DEVIATIONS) -> float:
    """The relative error that a sketch's estimate keeps within so many standard deviations."""
    return deviations * 1.04 / math.sqrt(2**lg_k)


def _pairs(links: DataFrame, directed: bool) -> DataFrame:
    """Distinct links between different vertices, each way if they have no direction."""
    pairs = links.select("src", "dst")
    if not directed:
        pairs = pairs.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return pairs.filter(F.col("src") != F.col("dst")).distinct()


def _ids(pairs: DataFrame, vertices: DataFrame | None) -> DataFrame:
    ends = pairs.select(F.explode(F.array("src", "dst")).alias("id"))
    if vertices is not None:
        ends = ends.unionByName(vertices.select(F.col(vertices.columns[0]).alias("id")))
    return ends.dropna().distinct()


def closeness_sketched(
    links: DataFrame,
    vertices: DataFrame | None = None,
    directed: bool = True,
    lg_k: int = LG_K,
    deviations: float = DEVIATIONS,
    max_rounds: int | None = None,
) -> DataFrame:
    """``landmark``, ``closeness``, ``low``, ``high``, ``reach``, ``rounds`` of every vertex, the
    ends of links and the given ``vertices``, in one run of rounds for all of them.

    A vertex holds a sketch of the vertices that reach it, at first of itself. In round r it merges in
    the sketches of the vertices that link to it, so its estimate grows by the number of
    vertices at distance r. The rounds end when no estimate moves. ``reach`` is the last estimate, the
    vertex included, ``rounds`` the last round that moved it, which is its largest distance.
    ``closeness`` is the number of others over the sum of their distances; ``low`` and ``high``
    are what it can be if each estimate is within `sketch_error`.

    State is one sketch per vertex, 2^lg_k / 2 bytes or so, checkpointed in each round; small sets
    are held exactly. Only the sketches that moved go along their links again, and those that
    meet in a vertex are merged within tasks before the shuffle, so a hub gets one from each.
    Links with a NULL end are no links; no vertices, no rows.
    """
    use_checkpoint_dir(links.sparkSession)
    pairs = _pairs(links, directed).checkpoint()
    error = sketch_error(lg_k, deviations)
    state = _ids(pairs, vertices).groupBy("id").agg(F.hll_sketch_agg("id", lg_k).alias("sketch"))
    state = state.select(
        "id", "sketch", F.lit(1).cast("long").alias("now"), F.lit(0).cast("long").alias("past"),
        F.lit(0).alias("last"), F.lit(True).alias("moved"),
    ).checkpoint()
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        after = _next_round(pairs, state, rounds).checkpoint()
        forget_checkpoint(state)
        state = after
        if state.filter("moved").isEmpty():
            break
    forget_checkpoint(pairs)
    return state.select(F.col("id").alias("landmark"), *_from_estimates(error))


def _next_round(pairs: DataFrame, state: DataFrame, number: int) -> DataFrame:
    """The state after one more round. ``past`` sums the estimates of the rounds before ``last``."""
    moved = state.filter("moved").select(F.col("id").alias("src"), "sketch")
    merged = pairs.join(moved, "src").groupBy(F.col("dst").alias("id"))
    more = merged.agg(F.hll_union_agg("sketch").alias("more"))
    both = state.join(more, "id", "left")
    sketch = F.when(F.col("more").isNull(), F.col("sketch")).otherwise(F.hll_union("sketch", "more"))
    both = both.select("id", sketch.alias("sketch"), "now", "past", "last")
    both = both.withColumn("size", F.hll_sketch_estimate("sketch"))
    grew = F.col("size") > F.col("now")
    return both.select(
        "id",
        "sketch",
        F.when(grew, F.col("size")).otherwise(F.col("now")).alias("now"),
        F.when(grew, F.col("past") + F.col("now") * (F.lit(number) - F.col("last"))).otherwise(F.col("past")).alias("past"),
        F.when(grew, F.lit(number)).otherwise(F.col("last")).alias("last"),
        grew.alias("moved"),
    )


def _from_estimates(error: float) -> list[Column]:
    """With estimates e(r) of the vertices within r hops and the last round R that moved, the sum of
    distances is R e(R) minus the sum of e(r) for r < R."""
    now, past, last = F.col("now"), F.col("past"), F.col("last")
    distances = last * now - past
    fewest, most = now / (1 + error), now / (1 - error)
    shortest = F.greatest(last * fewest - past / (1 - error), fewest - 1, F.lit(0.0))
    longest = last * most - past / (1 + error)
    return [
        F.when(last > 0, (now - 1) / distances).otherwise(0.0).alias("closeness"),
        F.when(last > 0, F.greatest(fewest - 1, F.lit(0.0)) / longest).otherwise(0.0).alias("low"),
        F.when(last == 0, 0.0).when(shortest > 0, F.least(F.lit(1.0), (most - 1) / shortest)).otherwise(1.0).alias("high"),
        now.alias("reach"),
        last.alias("rounds"),
    ]


def closeness_sampled(
    links: DataFrame,
    vertices: DataFrame | None = None,
    pivots: int = PIVOTS,
    confidence: float = CONFIDENCE,
    longest: int | None = None,
    directed: bool = True,
) -> DataFrame:
    """``landmark``, ``closeness``, ``low``, ``high``, ``pivots``, ``reaching`` of every vertex, the
    ends of links and the given ``vertices``, from one hop search.

    The pivots are the vertices of the smallest hashes (``pivots`` of them, the bound of what the
    search holds per vertex), so runs agree. The search gives their distances to all vertices. Of a
    vertex's other pivots ``reaching`` reach it; their share and the mean of their distances,
    0 for those that do not, estimate those of all other vertices. Each lies within
    Hoeffding's bound for samples without replacement, so the closeness lies between ``low`` and
    ``high`` with the given confidence for each vertex. With as many pivots as vertices the
    interval is a point.

    ``longest`` is the largest distance that can occur, which the bound on the mean needs; the
    number of vertices less one if not given, which makes the interval wide. The largest
    ``rounds`` of `closeness_sketched` is a good one. Links with a NULL end are no links.
    """
    if pivots < 2 or not 0 < confidence < 1:
        raise ValueError("two pivots and a confidence between 0 and 1 are needed")
    use_checkpoint_dir(links.sparkSession)
    pairs = _pairs(links, directed).checkpoint()
    ids = _ids(pairs, vertices).checkpoint()
    others = ids.count() - 1
    chosen = ids.orderBy(F.md5(F.col("id").cast("string")), "id").limit(pivots).checkpoint()
    backward = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    found = hop_distances(backward, chosen).filter("distance > 0").groupBy("id")
    found = found.agg(F.count("*").alias("reaching"), F.sum("distance").alias("total"))
    own = chosen.select("id", F.lit(1).alias("own"))
    size = min(pivots, others + 1)
    rows = ids.join(found, "id", "left").join(F.broadcast(own), "id", "left").select(
        "id",
        F.coalesce("reaching", F.lit(0)).alias("reaching"),
        F.coalesce("total", F.lit(0)).alias("total"),
        (F.lit(size) - F.coalesce("own", F.lit(0))).cast("long").alias("pivots"),
    )
    return rows.select(F.col("id").alias("landmark"), *_interval(others, confidence, longest))


def _interval(others: int, confidence: float, longest: int | None) -> list[Column]:
    sample = F.col("pivots")
    longest = float(max(1, others) if longest is None else longest)
    spread = math.log(4 / (1 - confidence)) / 2  # two means, two sides each
    left = 1 - (sample - 1) / F.lit(float(max(1, others)))
    error = F.when(sample >= others, 0.0).otherwise(F.sqrt(F.lit(spread) / sample * left))
    share, mean = F.col("reaching") / sample, F.col("total") / sample
    least, most = F.greatest(share - error, F.lit(0.0)), share + error
    nearest, farthest = mean - error * longest, mean + error * longest
    return [
        F.when(F.col("total") > 0, share / mean).otherwise(0.0).alias("closeness"),
        F.when(least > 0, least / farthest).otherwise(0.0).alias("low"),
        F.when(nearest > 0, F.least(F.lit(1.0), most / nearest)).when(most > 0, 1.0).otherwise(0.0).alias("high"),
        sample,
        "reaching",
    ]
