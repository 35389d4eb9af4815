"""Reports that combine several operators in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import NEGATIVE, POSITIVE, STOPWORDS, TOPIC_NEEDLES, TOP_WORDS
from ..functions.text import clean, count_tokens, tokens
from ..operators.ranking import top_k_per_group
from ..operators.sentiment import LABELS, Labels, Lexicon, with_sentiment
from ..operators.topics import Topics, on_topic
from ..operators.words import StopWords, most_frequent_first, without_stopwords
from ..sources.posts import POST_FIELDS, PostFields


def labelled_posts(
    posts: DataFrame,
    lexicon: Lexicon,
    topics: Topics = TOPIC_NEEDLES,
    fields: PostFields = POST_FIELDS,
    labels: Labels = LABELS,
    everywhere: bool = False,
) -> DataFrame:
    """Posts of exactly one topic, with ``topic``, ``text_cln`` and ``sentiment``."""
    cleaned = on_topic(posts, topics, fields.tags).withColumn(
        "text_cln", clean(F.col(fields.text), everywhere)
    )
    return with_sentiment(cleaned, lexicon, "text_cln", labels=labels)


def segment_counts(
    posts: DataFrame,
    lexicon: Lexicon,
    topics: Topics = TOPIC_NEEDLES,
    stopwords: StopWords = STOPWORDS,
    fields: PostFields = POST_FIELDS,
    labels: Labels = LABELS,
    everywhere: bool = False,
) -> DataFrame:
    """``segment``, ``word``, ``count`` of each topic's raw, clean, positive and negative
    posts; segments are named ``<topic> raw`` and so on.

    The posts are read once. The words of a post's raw and clean text are laid end to end
    and told apart by position. Each word is counted once per topic, with a counter for each
    segment, so one shuffle with one row per topic and word serves all segments.
    """
    positive, negative, _ = labels
    labelled = labelled_posts(posts, lexicon, topics, fields, labels, everywhere)
    posted = labelled.select(
        "topic",
        F.equal_null("sentiment", F.lit(positive)).alias("in_positive"),
        F.equal_null("sentiment", F.lit(negative)).alias("in_negative"),
        F.coalesce(count_tokens(F.col(fields.text)), F.array()).alias("raw_words"),
        F.coalesce(tokens(F.col("text_cln")), F.array()).alias("clean_words"),
    )
    words = posted.select(
        "topic",
        "in_positive",
        "in_negative",
        F.size("raw_words").alias("n_raw"),
        F.posexplode(F.concat("raw_words", "clean_words")).alias("at", "word"),
    ).filter(F.col("word") != "")
    is_clean = F.col("at") >= F.col("n_raw")
    counters = {
        "raw": ~is_clean,
        "clean": is_clean,
        "positive": is_clean & F.col("in_positive"),
        "negative": is_clean & F.col("in_negative"),
    }
    counts = words.groupBy("topic", "word").agg(
        *[F.count_if(condition).alias(kind) for kind, condition in counters.items()]
    )
    by_kind = [
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("count")) for kind in counters
    ]
    return (
        without_stopwords(counts, stopwords)
        .select("topic", "word", F.explode(F.array(*by_kind)).alias("part"))
        .filter(F.col("part.count") > 0)
        .select(
            F.concat_ws(" ", "topic", "part.kind").alias("segment"),
            "word",
            F.col("part.count").alias("count"),
        )
    )


def keyword_report(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """The ``k`` most frequent words of each segment of `segment_counts`, with ``rank``."""
    return top_k_per_group(counts, ["segment"], most_frequent_first(), k, spread_by="word")


def keyword_totals(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """Per segment of `segment_counts`: ``words``, its vocabulary size, and ``total``, the
    sum of its ``k`` highest counts."""
    vocabulary = counts.groupBy("segment").agg(F.count("*").alias("words"))
    totals = keyword_report(counts, k).groupBy("segment").agg(F.sum("count").alias("total"))
    return vocabulary.join(totals, "segment")
