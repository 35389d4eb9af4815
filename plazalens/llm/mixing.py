"""Mixing sources to target weights with nested hash thresholds.

A document's hash, from its id, says how early it is taken. A source's budget is spent on the
documents below a threshold. The threshold is found without sorting: words are summed by source
and hash bucket, the bucket in which the budget runs out is found, and only the documents of
that bucket are summed again, by the next bits. Thresholds nest: a larger budget takes the same
documents and more. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, with_place, words

HASH_BITS = 60
LEVEL_BITS = 10
CAP = 3
"""A source, and a document, is taken this many times at most."""


def id_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text; of the empty text for NULL."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _key(source: Column) -> Column:
    """The source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, key, size, hash``; the size is the number of words."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        _key(F.col(source_col)).alias("key"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        id_hash(F.col(id_col)).alias("hash"),
    )


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, ... ``cycle``, 1, ... for sources by code point, NULL last."""
    placed = with_place(sources, [], [F.col("source").asc_nulls_last()], "place")
    return placed.withColumn("weight", (F.col("place") - 1) % cycle + 1).drop("place")


def with_targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target``: the sum of all ``source_size`` shared by ``weight``, each share at most
    ``cap`` times the source's size, the excess shared again among the rest. Only sums and the
    level, words per unit of weight, come to the driver."""
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > F.col("source_size") * cap
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size") * cap).otherwise(0)).alias("fixed"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        risen = (sums["all"] - sums["fixed"]) / sums["weight"] if sums["weight"] else level
        if risen <= level:
            break
        level = risen
    share = (F.col("weight") * F.lit(level)).cast("double")
    return sources.withColumn("target", F.least(share, (F.col("source_size") * cap).cast("double")))


def thresholds(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: ``times`` every document is taken, and where one more time ends: documents
    whose hash, without its last ``shift`` bits, is below ``prefix`` are in; those at it share
    ``rest`` words of their ``held``.

    Buckets are refined until no source's last bucket holds more than one document, or the hash
    has no more bits: then ids repeat, and their rows share what is left in proportion.
    """
    budget = F.floor("target").cast("long")
    times = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    state = sources.select(
        "key", "source_size", "target", times.alias("times"),
        (budget - times * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"),
    )
    state = kept(state, "thresholds")
    by_bucket = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        bucket = F.shiftright("hash", shift)
        inside = docs.join(state.select("key", "prefix"), "key").filter(
            F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")
        )
        buckets = inside.groupBy("key", bucket.alias("bucket")).agg(
            F.sum("size").alias("held"), F.count("*").alias("n")
        )
        reached = buckets.withColumn("reached", F.sum("held").over(by_bucket))
        budgets = state.select("key", "source_size", "target", "times", "rest")
        last = reached.join(budgets, "key").filter(
            (F.col("reached") > F.col("rest")) & (F.col("reached") - F.col("held") <= F.col("rest"))
        )
        state = kept(
            last.select(
                "key", "source_size", "target", "times",
                (F.col("rest") - F.col("reached") + F.col("held")).alias("rest"),
                F.col("bucket").alias("prefix"), F.lit(shift).alias("shift"), "held", "n",
            ).unionByName(_empty_sources(sources, shift)),
            "thresholds",
        )
        if not state.filter("n > 1 AND rest > 0").limit(1).count():
            break
    return state


def _empty_sources(sources: DataFrame, shift: int) -> DataFrame:
    """Sources without words take nothing."""
    nothing = {name: F.lit(0).cast("long") for name in ("times", "rest", "prefix", "held", "n")}
    empty = sources.filter("source_size = 0").select("key", "source_size", "target")
    return empty.withColumns(nothing).withColumn("shift", F.lit(shift))


def _taken() -> Column:
    wide = "decimal(38,0)"
    share = F.expr(f"cast(rest as {wide}) * cast(size as {wide}) div greatest(held, 1)").cast("long")
    place = F.expr("shiftright(hash, shift)")
    more = F.when(place < F.col("prefix"), F.col("size")).when(place == F.col("prefix"), share).otherwise(0)
    return (F.col("times") * F.col("size") + more).cast("long")


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "key").agg(F.sum("size").alias("source_size"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: DataFrame | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` of
    its source and ``taken``, the words that the mix takes of it, repeats counted.

    ``weights`` has ``source, weight`` with positive weights; without it, sources weigh 1, 2, 3
    and so on again. NULL text has size 0, NULL is a source like any other, documents without
    words are taken 0 times. The taken words of a source add up to its target, rounded down;
    where the budget ends, one document gives its first words only. Rows with the same id share
    a hash and so what is left at the threshold, in proportion to their sizes, rounded down.
    An empty table gives an empty table.
    """
    rows = kept(sized(docs, id_col, text_col, source_col), "sized")
    state = plan(rows, weights)
    out = rows.join(state, "key")
    return out.select("doc_id", "source", "size", "source_size", "target", _taken().alias("taken"))


def plan(rows: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """The thresholds for the rows of `sized`."""
    sources = kept(source_sizes(rows), "sources")
    if weights is None:
        weighted = cyclic_weights(sources)
    else:
        named = weights.select(_key(F.col("source")).alias("key"), F.col("weight"))
        weighted = sources.join(named, "key")
    return thresholds(rows, kept(with_targets(kept(weighted, "weighted")), "targets"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents as often as the mix takes them, with all their columns. The document at a
    source's threshold, of which the mix takes a part, comes whole or not at all, whichever is
    nearer (whole at one half), so a source stays within a document of its target. The texts are
    not shuffled: the thresholds, one row per source, go to them."""
    rows = sized(docs, id_col, text_col, source_col)
    state = plan(kept(rows, "sized"))
    names = docs.columns
    mine = {"key": _key(docs[source_col]), "size": F.size(words(docs[text_col])).cast("long"), "hash": id_hash(docs[id_col])}
    whole = docs.select(F.struct(*names).alias("row"), *[value.alias(name) for name, value in mine.items()])
    taken = whole.join(state, "key").select("row", "size", _taken().alias("taken")).filter("taken > 0")
    times = F.expr("taken div size + if(2 * (taken % size) >= size, 1, 0)").cast("int")
    each = taken.select("row", F.explode(F.array_repeat(F.lit(0), times)))
    return each.select(*[F.col(f"row.`{name}`").alias(name) for name in names])
