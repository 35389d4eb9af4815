"""One query per operator over the driver's tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import centrality, graph, profile, sentiment, topics, words
from ..operators.ranking import with_global_place
from ..sources.inference import line_schema, path_profile as profile_paths
from ..sources.posts import (
    CORRUPT,
    POST_FIELDS,
    dedup_report,
    deduplicate,
    distinct_flat,
    parse_posts,
)
from . import reports, tables
from .tables import FIELDS, TOPICS, ZONE_PATTERN

Query = Callable[[SparkSession, str], DataFrame]
LEXICON = sentiment.lexicon_of(tables.POSITIVE_WORDS, tables.NEGATIVE_WORDS)

QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _epoch(column: str):
    return F.unix_timestamp(column)


# --- duplicates and profile --------------------------------------------------


@_query
def dedup_rows(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    return deduplicate(rows)


@_query
def dedup_keys(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return deduplicate(rows, ["user_id", "event_type"], order=["props"])


@_query
def dedup_summary(spark, sf_dir):
    return dedup_report(tables.table(spark, sf_dir, "documents").select("text", "lang"))


@_query
def dedup_flat_posts(spark, sf_dir):
    posts = tables.nested_posts(spark, sf_dir)
    flat = distinct_flat(posts.unionAll(posts), POST_FIELDS)
    return flat.select(
        "id", "text", "author", "zone", "reply_to", "source_author",
        F.concat_ws("|", "tags").alias("tags"), F.concat_ws("|", "source_tags").alias("source_tags"),
    )


@_query
def parse_lines(spark, sf_dir):
    posts = parse_posts(tables.lines(spark, sf_dir), "line", "id BIGINT, text STRING")
    return posts.select("id", "text", F.col(CORRUPT).isNotNull().alias("malformed"))


@_query
def parse_report(spark, sf_dir):
    lines = tables.lines(spark, sf_dir)
    return dedup_report(parse_posts(lines.unionAll(lines), "line", "id BIGINT, text STRING"))


@_query
def null_profile(spark, sf_dir):
    paths = ["author", "zone", "tags", "rt_author", "reply_to", "src_tags", "src_reply_to"]
    return profile.null_profile(tables.posts(spark, sf_dir), paths)


@_query
def inferred_schema(spark, sf_dir):
    return line_schema(tables.lines(spark, sf_dir), "line")


@_query
def path_profile(spark, sf_dir):
    return profile_paths(tables.post_lines(spark, sf_dir), "line")


@_query
def kind_breakdown(spark, sf_dir):
    return profile.kind_breakdown(tables.posts(spark, sf_dir), FIELDS)


@_query
def kind_breakdown_by_zone(spark, sf_dir):
    return profile.kind_breakdown(tables.posts(spark, sf_dir), FIELDS, by=["zone"])


@_query
def mean_text_length(spark, sf_dir):
    return profile.mean_text_length(tables.posts(spark, sf_dir), FIELDS)


@_query
def text_completeness(spark, sf_dir):
    return profile.text_completeness(tables.posts(spark, sf_dir), FIELDS)


@_query
def text_length_histogram(spark, sf_dir):
    return profile.text_length_histogram(tables.posts(spark, sf_dir), FIELDS)


@_query
def created_at_order(spark, sf_dir):
    stamped = profile.with_timestamp(tables.created(spark, sf_dir))
    placed = with_global_place(stamped, [F.asc("timestamp"), F.asc("event_id")])
    return placed.select("event_id", "created_at", _epoch("timestamp").alias("epoch"), "place")


@_query
def period(spark, sf_dir):
    covered = profile.period(tables.created(spark, sf_dir))
    return covered.select(
        _epoch("min_timestamp").alias("min_epoch"), _epoch("max_timestamp").alias("max_epoch")
    )


@_query
def zone_report(spark, sf_dir):
    return profile.zone_report(tables.posts(spark, sf_dir), ZONE_PATTERN, FIELDS)


@_query
def posts_with_tags(spark, sf_dir):
    return profile.with_tags(tables.posts(spark, sf_dir), FIELDS).select("id")


# --- topics ------------------------------------------------------------------


@_query
def topic_posts(spark, sf_dir):
    return topics.on_topic(tables.posts(spark, sf_dir), TOPICS, "tags").select("id", "topic")


@_query
def one_topic_posts(spark, sf_dir):
    posts = topics.topic_posts(tables.posts(spark, sf_dir), "a", TOPICS, "tags")
    return posts.select("id", "author", "rt_author")


@_query
def exact_topic_posts(spark, sf_dir):
    needles = tables.topic_needles(spark, sf_dir)
    return topics.with_exact_topic(tables.posts(spark, sf_dir), needles, "tags").select("id", "topic")


@_query
def source_topic_sum(spark, sf_dir):
    return topics.source_topic_sum(tables.posts(spark, sf_dir), TOPICS, FIELDS)


@_query
def topic_report(spark, sf_dir):
    return topics.topic_report(tables.posts(spark, sf_dir, tags_once=True), TOPICS, FIELDS)


@_query
def topic_report_nested(spark, sf_dir):
    return topics.topic_report(tables.nested_posts(spark, sf_dir), TOPICS)


# --- text and sentiment ------------------------------------------------------


@_query
def clean_text(spark, sf_dir):
    text = F.concat("text", F.lit(tables.LINKS_AND_ENTITIES)).alias("text")
    documents = tables.table(spark, sf_dir, "documents").select("doc_id", text)
    return words.clean_text(documents).select("doc_id", "text_cln")


@_query
def clean_pages(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    text = F.concat_ws(" ", "url", "html").alias("text")
    return words.clean_text(pages.select("page_id", text)).select("page_id", "text_cln")


@_query
def sentiment_counts(spark, sf_dir):
    posts = words.clean_text(tables.posts(spark, sf_dir))
    return sentiment.sentiment_counts(sentiment.with_sentiment(posts, LEXICON))


@_query
def sentiment_table_lexicon(spark, sf_dir):
    posts = words.clean_text(tables.posts(spark, sf_dir).select("id", "text"))
    lexicon = tables.role_lexicon(spark, sf_dir)
    return sentiment.with_sentiment(posts, lexicon).select("id", "sentiment")


@_query
def sentiment_joined_lexicon(spark, sf_dir):
    posts = words.clean_text(tables.posts(spark, sf_dir).select("id", "text"))
    lexicon = tables.role_lexicon(spark, sf_dir)
    labelled = sentiment.with_sentiment(posts, lexicon)
    return labelled.select("id", "sentiment")


@_query
def sentiment_by_topic(spark, sf_dir):
    labelled = reports.labelled_posts(tables.posts(spark, sf_dir), LEXICON, TOPICS, FIELDS)
    return labelled.groupBy("topic", "sentiment").agg(F.count("*").alias("count"))


@_query
def sentiment_kinds(spark, sf_dir):
    labelled = reports.labelled_posts(tables.posts(spark, sf_dir), LEXICON, TOPICS, FIELDS)
    return sentiment.sentiment_kinds(labelled, FIELDS)


@_query
def positive_posts(spark, sf_dir):
    labelled = reports.labelled_posts(tables.posts(spark, sf_dir), LEXICON, TOPICS, FIELDS)
    return labelled.filter(F.col("sentiment") == sentiment.POSITIVE).select("id", "topic")


# --- words -------------------------------------------------------------------


@_query
def word_counts(spark, sf_dir):
    return words.word_counts(tables.posts(spark, sf_dir))


@_query
def word_counts_clean(spark, sf_dir):
    return words.word_counts(words.clean_text(tables.posts(spark, sf_dir)), "text_cln")


@_query
def word_counts_stop_table(spark, sf_dir):
    stopwords = tables.benchmark_words(spark, sf_dir)
    return words.word_counts(tables.posts(spark, sf_dir), "text", stopwords)


@_query
def vocabulary_size(spark, sf_dir):
    return words.vocabulary_size(words.word_counts(tables.posts(spark, sf_dir)))


@_query
def top_words(spark, sf_dir):
    return words.top_words(words.word_counts(tables.posts(spark, sf_dir)))


@_query
def top_total(spark, sf_dir):
    return words.top_total(words.word_counts(tables.posts(spark, sf_dir)))


def _segment_counts(spark, sf_dir):
    return reports.segment_counts(
        tables.posts(spark, sf_dir), LEXICON, TOPICS, fields=FIELDS
    )


@_query
def segment_counts(spark, sf_dir):
    return _segment_counts(spark, sf_dir)


@_query
def keyword_report(spark, sf_dir):
    return reports.keyword_report(_segment_counts(spark, sf_dir))


@_query
def keyword_report_zone(spark, sf_dir):
    posts = profile.in_zone(tables.posts(spark, sf_dir), ZONE_PATTERN, FIELDS)
    counts = reports.segment_counts(posts, LEXICON, TOPICS, fields=FIELDS)
    return reports.keyword_report(counts)


@_query
def keyword_totals(spark, sf_dir):
    return reports.keyword_totals(_segment_counts(spark, sf_dir))


# --- graph -------------------------------------------------------------------


@_query
def vertices(spark, sf_dir):
    return graph.vertices(tables.posts(spark, sf_dir), FIELDS)


@_query
def vertices_with_null(spark, sf_dir):
    return graph.vertices(tables.posts(spark, sf_dir), FIELDS, keep_null=True)


@_query
def edges(spark, sf_dir):
    return graph.edges(tables.posts(spark, sf_dir), FIELDS)


@_query
def network_size(spark, sf_dir):
    return graph.network_size(tables.posts(spark, sf_dir), FIELDS)


@_query
def degrees(spark, sf_dir):
    return graph.degrees(tables.links(spark, sf_dir))


@_query
def degree_share(spark, sf_dir):
    return graph.degree_share(tables.links(spark, sf_dir))


@_query
def top_degrees(spark, sf_dir):
    return graph.top_degrees(tables.links(spark, sf_dir))


def _top_ids(links: DataFrame) -> DataFrame:
    return graph.top_degrees(links).select("id")


@_query
def hop_distances(spark, sf_dir):
    links = tables.links(spark, sf_dir)
    return graph.hop_distances(links, _top_ids(links))


@_query
def hop_distances_supply(spark, sf_dir):
    links = tables.supply_links(spark, sf_dir)
    return graph.hop_distances(links, _top_ids(links))


@_query
def hop_distances_undirected(spark, sf_dir):
    links = tables.supply_links(spark, sf_dir)
    return graph.hop_distances(links, _top_ids(links), directed=False)


@_query
def closeness(spark, sf_dir):
    links = tables.links(spark, sf_dir)
    return graph.closeness(graph.hop_distances(links, _top_ids(links)))


@_query
def closeness_all(spark, sf_dir):
    posts = tables.posts(spark, sf_dir)
    links = graph.edges(posts, FIELDS)
    return graph.closeness_of(links, graph.vertices(posts, FIELDS))


@_query
def closeness_sketch(spark, sf_dir):
    """The sketched closeness of all vertices held against the exact one."""
    posts = tables.posts(spark, sf_dir)
    links, everyone = graph.edges(posts, FIELDS), graph.vertices(posts, FIELDS)
    sketched = centrality.closeness_sketched(links, everyone)
    exact = graph.closeness_of(links, everyone).withColumnRenamed("closeness", "exact")
    within = F.col("exact").between(F.col("low") - 1e-12, F.col("high") + 1e-12)
    return exact.join(sketched, "landmark").select(
        "landmark", F.col("exact").alias("closeness"), "rounds", within.alias("within")
    )


@_query
def closeness_sample(spark, sf_dir):
    """Intervals of all vertices' closeness from twelve pivots, and whether they hold the exact one."""
    posts = tables.posts(spark, sf_dir)
    links, everyone = graph.edges(posts, FIELDS), graph.vertices(posts, FIELDS)
    longest = centrality.closeness_sketched(links, everyone).agg(F.max("rounds")).first()[0]
    sampled = centrality.closeness_sampled(links, everyone, pivots=12, longest=longest)
    exact = graph.closeness_of(links, everyone).withColumnRenamed("closeness", "exact")
    holds = F.col("exact").between(F.col("low") - 1e-12, F.col("high") + 1e-12)
    rounded = [F.round(name, 9).alias(name) for name in ("closeness", "low", "high")]
    return sampled.join(exact, "landmark").select("landmark", *rounded, "pivots", "reaching", holds.alias("holds"))
