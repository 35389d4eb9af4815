"""The three analyses of a dump. Each takes prepared posts and returns its tables by name;
nothing runs until a table is used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS, TOP_VERTICES, TOP_WORDS, TOPIC_NEEDLES, USA_ZONE_PATTERN
from ..operators import graph, profile, sentiment, topics
from ..operators.sentiment import Lexicon
from ..operators.topics import Topics
from ..operators.words import StopWords
from ..sources.posts import FLAT_FIELDS, distinct_flat
from . import reports

# Where posts say where they were sent from, by the name of the flat column.
_LOCATIONS = {
    "geo_coordinates": "geo.coordinates",
    "place_country": "place.country",
    "place_country_code": "place.country_code",
}


def prepare(raw: DataFrame) -> DataFrame:
    """Distinct posts with flat columns. Every table reads them anew, so write them once (to
    Parquet, say, which also reads only the columns a table needs) or persist them."""
    return distinct_flat(raw, more=_LOCATIONS)


def exploration(
    posts: DataFrame,
    lexicon: Lexicon,
    topic_needles: Topics = TOPIC_NEEDLES,
    zone_pattern: str = USA_ZONE_PATTERN,
) -> dict[str, DataFrame]:
    """What the dump holds: kinds, text lengths, period, locations, tags, the posts of a zone,
    and the topics with their sentiment. `dedup_report` of the raw posts goes with it."""
    labelled = reports.labelled_posts(posts, lexicon, topic_needles, FLAT_FIELDS)
    return {
        "kinds": profile.kind_breakdown(posts, FLAT_FIELDS),
        "text_length": profile.mean_text_length(posts, FLAT_FIELDS),
        "text_length_histogram": profile.text_length_histogram(posts, FLAT_FIELDS),
        "period": profile.period(posts, FLAT_FIELDS),
        "locations": profile.null_profile(posts, [*_LOCATIONS, FLAT_FIELDS.zone]),
        "tags": profile.with_tags(posts, FLAT_FIELDS).agg(F.count("*").alias("with_tags")),
        "zone": profile.zone_report(posts, zone_pattern, FLAT_FIELDS),
        "topics": topics.topic_report(posts, topic_needles, FLAT_FIELDS),
        "sentiment": sentiment.sentiment_kinds(labelled, FLAT_FIELDS),
    }


def word_report(
    posts: DataFrame,
    lexicon: Lexicon,
    topic_needles: Topics = TOPIC_NEEDLES,
    zone_pattern: str = USA_ZONE_PATTERN,
    stopwords: StopWords = STOPWORDS,
    k: int = TOP_WORDS,
) -> dict[str, DataFrame]:
    """What posts of a zone say on each topic: all word counts by segment, the top words, and
    the sizes."""
    in_zone = profile.in_zone(posts, zone_pattern, FLAT_FIELDS)
    counts = reports.segment_counts(in_zone, lexicon, topic_needles, stopwords, FLAT_FIELDS)
    return {
        "counts": counts,
        "top": reports.keyword_report(counts, k),
        "totals": reports.keyword_totals(counts, k),
    }


def network(posts: DataFrame, k: int = TOP_VERTICES) -> dict[str, DataFrame]:
    """Who reshares whom: size of the graph, its edges, all degrees with their shares, and
    the top ones. For closeness, give ``edges`` to `graph.hop_distances`."""
    with_text = posts.filter(F.col(FLAT_FIELDS.text).isNotNull())
    edges = graph.edges(with_text, FLAT_FIELDS)
    return {
        "size": graph.network_size(with_text, FLAT_FIELDS),
        "edges": edges,
        "degrees": graph.degree_share(edges),
        "top": graph.top_degrees(edges, k),
    }
