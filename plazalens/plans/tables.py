"""Posts and a graph derived from the driver's tables, which hold neither."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import once
from ..sources.posts import POST_SCHEMA, PostFields

FIELDS = PostFields(
    reshare_count="retweet_count",
    author="author",
    zone="zone",
    tags="tags",
    reply_to="reply_to",
    source_author="rt_author",
    source_reply_to="src_reply_to",
    source_tags="src_tags",
)

TOPICS = {"a": ("ment", "mente"), "b": ("tion",)}
ZONE_PATTERN = "%e%"
LINKS_AND_ENTITIES = (
    " See HTTPS://Example.org/a_b?c=d#!e, http:\\\\x.y @Jo_Hn #tag don't x#y (end). Bye"
)

POSITIVE_WORDS = (
    "thing", "thble", "erble", "ertion", "antion", "thanedble", "reble", "mente", "outre",
    "lement", "letre", "nicht", "enlich", "einlich", "well-made", "under", "onble",
)
NEGATIVE_WORDS = (
    "worthless", "disgusting", "trash", "thtion", "attion", "ering", "reing", "ining", "edble",
    "queque", "eauou", "ersch", "ensch", "enkeit", "der", "two-faced", "under", "onble",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str, tags_once: bool = False) -> DataFrame:
    """Flat posts from ``documents``: tags are the long words of the text. ``tags_once`` is for
    queries that use the tags several times, also in filters: they are worked out once then,
    but also where they are not needed."""
    doc, text = F.col("doc_id"), F.lower("text")
    reshares = (doc % 9).isin(0, 2, 4, 6)

    def words(at_least: int):
        return F.regexp_extract_all(text, F.lit("[a-z]{%d,}" % at_least), 0)

    def account(factor: int):
        return F.concat(F.lit("src"), (doc * factor % 20).cast("string"))

    none = F.array().cast("array<string>")
    tags = F.when(doc % 5 == 0, none).otherwise(words(9)).alias("tags")
    src_tags = F.when(reshares, words(11)).alias("src_tags")
    flat = table(spark, sf_dir, "documents").select(
        doc.alias("id"),
        "text",
        F.col("source").alias("author"),
        F.col("lang").alias("zone"),
        F.col("n_chars").alias("retweet_count"),
        *([] if tags_once else [tags, src_tags]),
        *([once(F.struct(tags, src_tags)).alias("both")] if tags_once else []),
        F.when(reshares, account(7)).alias("rt_author"),
        F.when(doc % 9 == 1, account(3)).alias("reply_to"),
        F.when(reshares & (doc % 4 == 0), account(3)).alias("src_reply_to"),
    )
    return flat.select("*", "both.*").drop("both") if tags_once else flat


def post_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts as JSON lines."""

    def entities(tags: str):
        tag = F.transform(tags, lambda text: F.struct(text.alias("text")))
        return F.struct(tag.alias("hashtags")).alias("entities")

    def named(column: str, *more):
        return F.struct(F.col(column).alias("name"), *more).alias("user")

    original = F.struct(
        named("rt_author"),
        F.col("src_reply_to").alias("in_reply_to_screen_name"),
        entities("src_tags"),
    )
    line = F.struct(
        "id",
        "text",
        "retweet_count",
        named("author", F.col("zone").alias("time_zone")),
        entities("tags"),
        F.col("reply_to").alias("in_reply_to_screen_name"),
        F.when(F.col("rt_author").isNotNull(), original).alias("retweeted_status"),
    )
    return posts(spark, sf_dir, tags_once=True).select(F.to_json(line).alias("line"))


def nested_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines, read with the declared schema."""
    lines = post_lines(spark, sf_dir)
    return lines.select(once(F.from_json("line", POST_SCHEMA)).alias("post")).select("post.*")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as JSON lines, every seventh of them cut in the middle."""
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), "text"))
    cut = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, cut).otherwise(line).alias("line")
    )


def created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id``, ``created_at`` from ``events``."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at")
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from ``events``: user to the key in the event's properties."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("src"),
        F.get_json_object("props", "$.k").cast("bigint").alias("dst"),
    )


def supply_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from ``lineitem``: part to supplier, in one range of numbers."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("bigint").alias("src"),
        F.col("l_suppkey").cast("bigint").alias("dst"),
    )


def role_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon table from ``conversations``: +1 for words of users, -1 for the others'.
    Words of both are in it twice."""
    word = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")
    polarity = F.when(F.col("role") == "user", 1).otherwise(-1).alias("polarity")
    return table(spark, sf_dir, "conversations").select(word, polarity).filter("word != ''")


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop word table: the words of ``benchmark``."""
    word = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")
    return table(spark, sf_dir, "benchmark").select(word).distinct()


def topic_needles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic table from ``conversations``: its long words, which are on the topics of all the
    roles that use them."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{9,}"), 0)).alias("needle")
    return table(spark, sf_dir, "conversations").select(F.col("role").alias("topic"), word)
