"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept


def _are_stars(pairs: DataFrame) -> bool:
    """True if every id hangs on one other, on which nothing but ids hang."""
    hanging = pairs.select("u", F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    holding = pairs.select(F.col("v").alias("u"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    ends = hanging.unionByName(holding).groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return ends.filter("hangs > 1 OR (hangs > 0 AND holds > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``id``, ``component``: for each end of a link ``a``, ``b`` (longs) the smallest id that
    can be reached. Links of an id to itself and NULL ends are ignored; no links, no rows.

    Two steps take turns until nothing changes. The first hangs every larger neighbour of an id
    on the smallest neighbour, the second does so with the smaller ones. Both keep the
    components, never have more links than before, and end with each component a star around
    its smallest id, after some log(n) rounds. Each step's links are written to the shared
    folder. Smallest neighbours are combined within tasks first; the join that follows has a
    plain exchange on both sides, so that Spark can split an id with very many links.
    """
    ends = links.dropna().select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = kept(ends.filter("u > v").distinct(), "links")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(kept(least, "least"), "u").filter("v > u")
        pairs = kept(hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        if _are_stars(pairs):
            break
        least = kept(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = pairs.join(least, "u").filter("v <> m")
        hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = kept(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        if _are_stars(pairs):
            break
    members = pairs.select(F.col("u").alias("id"), F.col("v").alias("component"))
    centres = pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)
