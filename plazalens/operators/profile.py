"""Profiling posts: every report is one aggregation over one pass of the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags as tag_functions
from ..functions.fixed_values import HISTOGRAM_BINS, USA_ZONE_PATTERN
from ..functions.times import parse_created_at
from ..sources.posts import POST_FIELDS, PostFields

# What the geolocation check looks at.
LOCATION_PATHS = ("geo.coordinates", "place.country", "place.country_code", "user.time_zone")


def is_reshare(fields: PostFields = POST_FIELDS) -> Column:
    return F.col(fields.source_author).isNotNull()


def is_reply(fields: PostFields = POST_FIELDS) -> Column:
    return F.col(fields.reply_to).isNotNull()


def kind_aggregates(
    fields: PostFields = POST_FIELDS, among: Column | None = None
) -> list[Column]:
    """``total``, ``reshares``, ``replies``, ``neither``, and ``partitions``: true if the
    three kinds add up to the total, that is, if no post is both. ``among`` narrows the
    rows that count."""
    among = F.lit(True) if among is None else among
    total = F.count_if(among)
    kinds = {
        "reshares": F.count_if(among & is_reshare(fields)),
        "replies": F.count_if(among & is_reply(fields)),
        "neither": F.count_if(among & ~is_reshare(fields) & ~is_reply(fields)),
    }
    return [
        total.alias("total"),
        *[column.alias(name) for name, column in kinds.items()],
        (kinds["reshares"] + kinds["replies"] + kinds["neither"] == total).alias("partitions"),
    ]


def kind_breakdown(
    posts: DataFrame, fields: PostFields = POST_FIELDS, by: Sequence[str | Column] = ()
) -> DataFrame:
    """Posts by kind, over all rows or per group."""
    return posts.groupBy(*by).agg(*kind_aggregates(fields))


def null_profile(posts: DataFrame, paths: Sequence[str] = LOCATION_PATHS) -> DataFrame:
    """Rows, and non-NULL values of each path (dots become ``_`` in the column names)."""
    return posts.agg(
        F.count("*").alias("rows"),
        *[F.count(path).alias(path.replace(".", "_")) for path in paths],
    )


def mean_length_of(column: str) -> Column:
    """Mean number of characters per row, rounded half to even; rows without text count
    as rows. NULL if there are no rows."""
    return F.bround(F.try_divide(F.sum(F.length(column)), F.count("*")), 0)


def mean_text_length(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """``rows``, ``characters``, ``mean_length``."""
    return posts.agg(
        F.count("*").alias("rows"),
        F.sum(F.length(fields.text)).alias("characters"),
        mean_length_of(fields.text).alias("mean_length"),
    )


def text_completeness(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """``rows``, ``with_text``, and ``complete`` if they are the same."""
    with_text = F.count(fields.text)
    return posts.agg(
        F.count("*").alias("rows"),
        with_text.alias("with_text"),
        (F.count("*") == with_text).alias("complete"),
    )


def histogram(values: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``bin``, ``count`` for equal-width bins over [min, max], the last one closed.

    Bins and their edges are computed in double precision the way numpy does it, so a
    value that sits on an edge falls on the same side; a column with one value spans half
    a unit to each side. NULLs are left out, empty bins are kept.

    The input is read once: it is reduced to distinct values and their counts, and both
    the range and the bins come from that shuffle. (``rows`` is there to keep Spark from
    taking the range of the ungrouped values, which would read the input again.)
    """
    counts = (
        values.select(F.col(column).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    one_value = F.min("value") == F.max("value")
    low = F.min("value").cast("double") - F.when(one_value, 0.5).otherwise(0.0)
    high = F.max("value").cast("double") + F.when(one_value, 0.5).otherwise(0.0)
    rows = F.sum("n")
    span = counts.agg(
        F.struct(low.alias("low"), high.alias("high"), rows.alias("rows")).alias("span")
    )

    ranged = counts.withColumn("span", span.scalar())
    x, low, high = F.col("value").cast("double"), F.col("span.low"), F.col("span.high")
    width = (high - low) / bins
    guess = F.least(F.floor((x - low) * (F.lit(float(bins)) / (high - low))), F.lit(bins - 1))
    shift = F.when(x < guess * width + low, -1).when(
        (x >= (guess + 1) * width + low) & (guess != bins - 1), 1
    )
    binned = (
        ranged.withColumn("bin", guess + F.coalesce(shift, F.lit(0)))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    every_bin = values.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return every_bin.join(binned, "bin", "left").select(
        "bin", F.coalesce("n", F.lit(0)).alias("count")
    )


def text_length_histogram(
    posts: DataFrame, fields: PostFields = POST_FIELDS, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    return histogram(posts.select(F.length(fields.text).alias("length")), "length", bins)


def with_timestamp(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """Add ``timestamp``. Sort by it with ``orderBy("timestamp")``; NULLs come first."""
    return posts.withColumn("timestamp", parse_created_at(F.col(fields.created_at)))


def period(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """``min_timestamp``, ``max_timestamp``: the time the posts cover."""
    timestamp = parse_created_at(F.col(fields.created_at))
    return posts.agg(
        F.min(timestamp).alias("min_timestamp"), F.max(timestamp).alias("max_timestamp")
    )


def in_zone(
    posts: DataFrame, pattern: str = USA_ZONE_PATTERN, fields: PostFields = POST_FIELDS
) -> DataFrame:
    """Posts whose author's zone is LIKE ``pattern``."""
    return posts.filter(F.col(fields.zone).like(pattern))


def with_tags(posts: DataFrame, fields: PostFields = POST_FIELDS) -> DataFrame:
    """Posts with at least one tag."""
    return posts.filter(~tag_functions.is_empty(F.col(fields.tags)))


def zone_report(
    posts: DataFrame, pattern: str = USA_ZONE_PATTERN, fields: PostFields = POST_FIELDS
) -> DataFrame:
    """One row about the posts of a zone: kinds, mean text length, posts with tags, posts
    with text, and whether all have text."""
    return in_zone(posts, pattern, fields).agg(
        *kind_aggregates(fields),
        mean_length_of(fields.text).alias("mean_length"),
        F.count_if(~tag_functions.is_empty(F.col(fields.tags))).alias("with_tags"),
        F.count(fields.text).alias("with_text"),
        (F.count("*") == F.count(fields.text)).alias("complete"),
    )
