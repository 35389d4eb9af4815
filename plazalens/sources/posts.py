"""The posts table: its schema, the JSON-lines scan, and duplicate removal."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.once import once
from .inference import infer_schema

# --- fixed values: the fields of a post -------------------------------------

_POINT = "STRUCT<coordinates: ARRAY<DOUBLE>, type: STRING>"
_SIZE = "STRUCT<h: BIGINT, resize: STRING, w: BIGINT>"
_ENTITIES = f"""STRUCT<
    hashtags: ARRAY<STRUCT<indices: ARRAY<BIGINT>, text: STRING>>,
    media: ARRAY<STRUCT<display_url: STRING, expanded_url: STRING, id: BIGINT, id_str: STRING,
        indices: ARRAY<BIGINT>, media_url: STRING, media_url_https: STRING,
        sizes: STRUCT<large: {_SIZE}, medium: {_SIZE}, small: {_SIZE}, thumb: {_SIZE}>,
        source_status_id: BIGINT, source_status_id_str: STRING, type: STRING, url: STRING>>,
    urls: ARRAY<STRUCT<display_url: STRING, expanded_url: STRING, indices: ARRAY<BIGINT>,
        url: STRING>>,
    user_mentions: ARRAY<STRUCT<id: BIGINT, id_str: STRING, indices: ARRAY<BIGINT>,
        name: STRING, screen_name: STRING>>>"""
_PLACE = """STRUCT<
    attributes: STRUCT<street_address: STRING>,
    bounding_box: STRUCT<coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>, type: STRING>,
    country: STRING, country_code: STRING, full_name: STRING, id: STRING, name: STRING,
    place_type: STRING, url: STRING>"""
_USER = """STRUCT<
    contributors_enabled: BOOLEAN, created_at: STRING, default_profile: BOOLEAN,
    default_profile_image: BOOLEAN, description: STRING, favourites_count: BIGINT,
    follow_request_sent: STRING, followers_count: BIGINT, following: STRING,
    friends_count: BIGINT, geo_enabled: BOOLEAN, id: BIGINT, id_str: STRING,
    is_translator: BOOLEAN, lang: STRING, listed_count: BIGINT, location: STRING,
    name: STRING, notifications: STRING, profile_background_color: STRING,
    profile_background_image_url: STRING, profile_background_image_url_https: STRING,
    profile_background_tile: BOOLEAN, profile_banner_url: STRING, profile_image_url: STRING,
    profile_image_url_https: STRING, profile_link_color: STRING,
    profile_sidebar_border_color: STRING, profile_sidebar_fill_color: STRING,
    profile_text_color: STRING, profile_use_background_image: BOOLEAN, protected: BOOLEAN,
    screen_name: STRING, show_all_inline_media: BOOLEAN, statuses_count: BIGINT,
    time_zone: STRING, url: STRING, utc_offset: BIGINT, verified: BOOLEAN>"""
_HEAD = f"""contributors ARRAY<BIGINT>, coordinates {_POINT}, created_at STRING,
    entities {_ENTITIES}, favorited BOOLEAN, geo {_POINT}, id BIGINT, id_str STRING,
    in_reply_to_screen_name STRING, in_reply_to_status_id BIGINT,
    in_reply_to_status_id_str STRING, in_reply_to_user_id BIGINT,
    in_reply_to_user_id_str STRING, place {_PLACE}, possibly_sensitive BOOLEAN,
    possibly_sensitive_editable BOOLEAN, retweet_count BIGINT, retweeted BOOLEAN"""
_TAIL = f"source STRING, text STRING, truncated BOOLEAN, user {_USER}"
_ORIGINAL = f"STRUCT<{_HEAD}, scopes STRUCT<followers: BOOLEAN>, {_TAIL}>"

POST_SCHEMA = f"{_HEAD}, retweeted_status {_ORIGINAL}, {_TAIL}"
"""DDL of a post: 23 top-level columns. A reshare holds the original post, one level deep."""


@dataclass(frozen=True)
class PostFields:
    """Where the operators find what they need; dotted paths reach into structs."""

    id: str = "id"
    text: str = "text"
    created_at: str = "created_at"
    reshare_count: str = "retweet_count"
    author: str = "user.name"
    zone: str = "user.time_zone"
    tags: str = "entities.hashtags.text"
    reply_to: str = "in_reply_to_screen_name"
    source_author: str = "retweeted_status.user.name"
    source_reply_to: str = "retweeted_status.in_reply_to_screen_name"
    source_tags: str = "retweeted_status.entities.hashtags.text"


POST_FIELDS = PostFields()
FLAT_FIELDS = PostFields(**{field.name: field.name for field in dataclasses.fields(PostFields)})
"""The fields after `flatten`: each a column of its own name."""


CORRUPT = "_corrupt_record"
LINE_DIGEST = "_line_digest"


def read_posts(
    spark: SparkSession,
    path: str | list[str],
    schema: str | None = POST_SCHEMA,
    corrupt: Literal["keep", "fail"] = "keep",
) -> DataFrame:
    """JSON-lines posts. A declared schema saves the pass that infers one; ``schema=None``
    infers it with `infer_schema`. Pass a shorter schema to parse fewer fields. Empty lines are
    skipped.

    Two more columns keep lines apart that the fields do not: a line that cannot be parsed stays a
    row of its own with its text in ``_corrupt_record``, and ``_line_digest`` is that of the whole
    line, its keys sorted, so posts that differ only in a field outside the schema stay
    different. ``corrupt="fail"`` fails on a broken line.
    """
    lines = spark.read.text(path)
    return parse_posts(lines, "value", infer_schema(lines) if schema is None else schema, corrupt)


def parse_posts(
    lines: DataFrame,
    column: str = "value",
    schema: str | T.StructType = POST_SCHEMA,
    corrupt: Literal["keep", "fail"] = "keep",
) -> DataFrame:
    """Posts from a column of JSON lines, as `read_posts` gives them."""
    line = F.col(column)
    options = {"mode": "FAILFAST" if corrupt == "fail" else "PERMISSIVE"}
    if corrupt == "keep":
        options["columnNameOfCorruptRecord"] = CORRUPT
        broken = T.StructField(CORRUPT, T.StringType())
        schema = f"{schema}, {CORRUPT} STRING" if isinstance(schema, str) else T.StructType([*schema, broken])
    whole = F.coalesce(F.to_json(F.try_parse_json(line)), line)
    parsed = lines.filter(F.trim(line) != "").select(
        once(F.from_json(line, schema, options)).alias("post"),
        F.unhex(F.sha2(whole, 256)).alias(LINE_DIGEST),
    )
    broken = [] if corrupt == "keep" else [F.lit(None).cast("string").alias(CORRUPT)]
    return parsed.select("post.*", *broken, LINE_DIGEST)


def flatten(
    posts: DataFrame, fields: PostFields = POST_FIELDS, more: Mapping[str, str] | None = None
) -> DataFrame:
    """The fields as plain columns, to be used with ``FLAT_FIELDS``; ``more`` adds columns by
    name and path."""
    paths = {**dataclasses.asdict(fields), **(more or {})}
    return posts.select(*[F.col(path).alias(name) for name, path in paths.items()])


def deduplicate(
    posts: DataFrame,
    subset: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one of each set of rows equal in every column or, another result, in ``subset``.

    Of rows equal in ``subset`` the first by ``order`` stays, NULL before values; ties, and all
    of the order if none is given, are broken by the other columns in turn, so the result
    does not depend on where rows lie. Equal rows are merged inside each map task first, so
    many copies of one row cost the shuffle no more than one row per task.
    """
    if not subset:
        return posts.dropDuplicates()
    first = [name for name in order or () if name not in subset]
    rest = [name for name in posts.columns if name not in subset and name not in first]
    least = F.min(F.struct(*[F.col(f"`{name}`") for name in [*first, *rest]])).alias("__rest")
    if not first and not rest:
        return posts.distinct()
    kept = posts.groupBy(*[F.col(f"`{name}`") for name in subset])
    return kept.agg(least).select(
        *[F.col(f"`{n}`") if n in subset else F.col(f"__rest.`{n}`").alias(n) for n in posts.columns]
    )


def distinct_flat(
    posts: DataFrame, fields: PostFields = POST_FIELDS, more: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of `deduplicate` and then `flatten`, with a much smaller shuffle: whole
    rows are compared by their digest, so only that and the flat columns move."""
    digest = row_digest(posts).alias("__digest")
    flat = {**(more or {}), "__digest": "__digest"}
    return flatten(posts.select("*", digest), fields, flat).distinct().drop("__digest")


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of all columns, the same for rows that are equal as grouping keys; for posts as
    they were read, the digest of the whole line."""
    if LINE_DIGEST in df.columns:
        return F.col(LINE_DIGEST)
    columns = [_comparable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema]
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"timestampFormat": f"{micros}XXX", "timestampNTZFormat": micros}
    return F.unhex(F.sha2(F.to_json(F.struct(*columns), options), 256))


def _comparable(col: Column, kind: T.DataType) -> Column:
    """The column with -0.0 made 0.0, wherever it is: as grouping keys they are equal."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return col + F.lit(0.0).cast(kind)
    if not _has_fractions(kind):
        return col
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda item: _comparable(item, kind.elementType))
    inner = [_comparable(col[field.name], field.dataType).alias(field.name) for field in kind]
    return F.when(col.isNotNull(), F.struct(*inner))


def _has_fractions(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_fractions(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_fractions(field.dataType) for field in kind)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def dedup_report(posts: DataFrame, text: str = "text") -> DataFrame:
    """One row: ``raw`` and ``deduped`` row counts, ``deduped_with_text``, ``removed``, true if
    the last differs from the first (so rows without text count as removed), and for posts
    read with their broken lines ``malformed``, the number of those among the raw rows.

    One pass: digests are grouped with their number of copies instead of counted twice.
    """
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in posts.columns else F.lit(False)
    rows = posts.select(
        row_digest(posts).alias("digest"),
        F.col(text).isNotNull().alias("with_text"),
        broken.alias("broken"),
    )
    copies = rows.groupBy("digest", "with_text", "broken").agg(F.count("*").alias("n"))
    report = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.count("*").alias("deduped"),
        F.count_if("with_text").alias("deduped_with_text"),
        F.coalesce(F.sum(F.when(F.col("broken"), F.col("n"))), F.lit(0)).alias("malformed"),
    ).withColumn("removed", F.col("raw") != F.col("deduped_with_text"))
    return report if CORRUPT in posts.columns else report.drop("malformed")
