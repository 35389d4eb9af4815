"""Topics: posts, or reshared originals, whose tags mention one topic and no other. Needles are
searched within tags, or compared with whole tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import TOPIC_NEEDLES
from ..functions.tags import distinct_lower, on_one_topic, searchable, topic_of
from ..sources.posts import POST_FIELDS, PostFields
from .profile import kind_aggregates

Topics = Mapping[str, Iterable[str]]


def with_topic(
    posts: DataFrame, topics: Topics = TOPIC_NEEDLES, tags: str = POST_FIELDS.tags
) -> DataFrame:
    """Add ``topic``, NULL for posts that mention no topic or several. Give the original's
    tag column to label reshares by what they reshare."""
    return posts.withColumn("topic", topic_of(searchable(F.col(tags)), topics))


def on_topic(
    posts: DataFrame, topics: Topics = TOPIC_NEEDLES, tags: str = POST_FIELDS.tags
) -> DataFrame:
    """The posts of exactly one topic, with ``topic``."""
    return with_topic(posts.filter(on_one_topic(searchable(F.col(tags)), topics)), topics, tags)


def topic_posts(
    posts: DataFrame,
    topic: str,
    topics: Topics = TOPIC_NEEDLES,
    tags: str = POST_FIELDS.tags,
) -> DataFrame:
    """The posts of one topic and no other."""
    return posts.filter(on_one_topic(searchable(F.col(tags)), topics, among=[topic]))


def with_exact_topic(
    posts: DataFrame, topics: Topics | DataFrame = TOPIC_NEEDLES, tags: str = POST_FIELDS.tags
) -> DataFrame:
    """Add ``topic`` like `with_topic`, but a tag counts only if it equals a needle as a whole,
    in any letter case: ``nobama`` is not on the topic of ``obama``. NULL for posts whose tags
    are on no topic or on several; a needle of two topics is on both.

    Topics are a mapping or a table ``topic, needle`` of any size. Different sets of tags, not
    posts, are taken apart and meet the needles; a set is on one topic if the least and the
    greatest topic of its tags are the same, so no list of topics is ever held. The posts then
    find their set by its SHA-256. Posts without tags are left out of both joins' work.
    """
    needles = _needle_table(posts, topics)
    tag_set = distinct_lower(F.col(tags))
    digest = F.when(F.size(tag_set) > 0, F.unhex(F.sha2(F.to_json(tag_set), 256)))
    sets = posts.select(digest.alias("__set"), tag_set.alias("tags")).filter("__set IS NOT NULL")
    tagged = sets.dropDuplicates(["__set"]).select("__set", F.explode("tags").alias("needle"))
    least, greatest = F.min("topic"), F.max("topic")
    one = F.when(least == greatest, least).alias("topic")
    found = tagged.join(needles, "needle").groupBy("__set").agg(one).filter("topic IS NOT NULL")
    others = [F.col(f"`{name}`") for name in posts.columns if name != "topic"]
    return posts.select(*others, digest.alias("__set")).join(found, "__set", "left").drop("__set")


def on_exact_topic(
    posts: DataFrame, topics: Topics | DataFrame = TOPIC_NEEDLES, tags: str = POST_FIELDS.tags
) -> DataFrame:
    """The posts of exactly one topic by whole tags, with ``topic``."""
    return with_exact_topic(posts, topics, tags).filter("topic IS NOT NULL")


def _needle_table(posts: DataFrame, topics: Topics | DataFrame) -> DataFrame:
    if not isinstance(topics, DataFrame):
        rows = [(topic, needle) for topic, needles in topics.items() for needle in needles]
        topics = posts.sparkSession.createDataFrame(rows, "topic string, needle string")
    return topics.select("topic", F.lower("needle").alias("needle")).dropna().distinct()


def source_topic_sum(
    posts: DataFrame, topics: Topics = TOPIC_NEEDLES, fields: PostFields = POST_FIELDS
) -> DataFrame:
    """Per topic of the reshared original: ``posts`` and the sum of their counters,
    ``reshare_count``. An original that is reshared n times counts n times."""
    return on_topic(posts, topics, fields.source_tags).groupBy("topic").agg(
        F.count("*").alias("posts"), F.sum(fields.reshare_count).alias("reshare_count")
    )


def topic_report(
    posts: DataFrame, topics: Topics = TOPIC_NEEDLES, fields: PostFields = POST_FIELDS
) -> DataFrame:
    """Per topic: kinds of its posts, and ``source_posts``, ``source_reshare_count`` of the
    reshares whose original is of the topic.

    One pass: a row counts under its own topic and under its original's. Only the columns
    that are counted pass through the expansion.
    """
    flat = PostFields(
        source_author="source_author", reply_to="reply_to", reshare_count="reshare_count"
    )
    tagged = F.col(fields.tags), F.col(fields.source_tags)
    on_own, on_source = (on_one_topic(searchable(tags), topics) for tags in tagged)
    searched = posts.filter(on_own | on_source).select(
        searchable(F.col(fields.tags)).alias("own_tags"),
        searchable(F.col(fields.source_tags)).alias("source_tags"),
        F.col(fields.source_author).alias(flat.source_author),
        F.col(fields.reply_to).alias(flat.reply_to),
        F.col(fields.reshare_count).alias(flat.reshare_count),
    )
    own, source = (
        F.struct(topic_of(F.col(tags), topics).alias("topic"), F.lit(is_own).alias("own"))
        for tags, is_own in (("own_tags", True), ("source_tags", False))
    )
    roles = searched.withColumn("role", F.explode(F.array(own, source)))
    is_own = F.col("role.own")
    return (
        roles.filter(F.col("role.topic").isNotNull())
        .groupBy(F.col("role.topic").alias("topic"))
        .agg(
            *kind_aggregates(flat, among=is_own),
            F.count_if(~is_own).alias("source_posts"),
            F.sum(F.when(~is_own, F.col(flat.reshare_count))).alias("source_reshare_count"),
        )
    )
