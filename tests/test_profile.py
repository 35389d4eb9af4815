import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plazalens.operators import profile, topics
from plazalens.sources import deduplicate


@pytest.fixture(scope="module")
def kept(posts):
    return deduplicate(posts).cache()


def test_kind_breakdown(kept):
    # Post 6 is a reshare and a reply, so the kinds do not add up.
    assert profile.kind_breakdown(kept).collect() == [(13, 7, 2, 5, False)]
    assert profile.kind_breakdown(kept.filter("id <> 6")).collect() == [(12, 6, 1, 5, True)]
    assert profile.kind_breakdown(kept.limit(0)).collect() == [(0, 0, 0, 0, True)]


def test_kind_breakdown_by_group(kept):
    by_author = profile.kind_breakdown(kept, by=[F.col("user.name").alias("author")])
    rows = {row.author: tuple(row)[1:] for row in by_author.collect()}
    assert rows["ann"] == (2, 2, 0, 0, True)
    assert rows["fay"] == (1, 1, 1, 0, False)
    assert rows[None] == (1, 0, 0, 1, True)


def test_null_profile(kept):
    row = profile.null_profile(kept).first().asDict()
    assert row == {"rows": 13, "geo_coordinates": 1, "place_country": 1,
                   "place_country_code": 1, "user_time_zone": 11}


def test_mean_text_length_counts_rows_without_text(texts):
    report = profile.mean_text_length(texts("ab", "abc", None, ""))
    assert report.collect() == [(4, 5, 1.0)]


@pytest.mark.parametrize("lengths, mean", [([2, 3], 2.0), ([3, 4], 4.0), ([1, 1, 2], 1.0)])
def test_mean_text_length_rounds_half_to_even(texts, lengths, mean):
    assert profile.mean_text_length(texts(*["x" * n for n in lengths])).first().mean_length == mean


def test_mean_text_length_of_nothing_is_null(texts):
    assert profile.mean_text_length(texts("a").limit(0)).collect() == [(0, None, None)]


def test_text_completeness(kept):
    assert profile.text_completeness(kept).collect() == [(13, 12, False)]
    assert profile.text_completeness(kept.dropna(subset=["text"])).collect() == [(12, 12, True)]


def bins_of(spark, values, bins=50):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [row["count"] for row in profile.histogram(df, "x", bins).orderBy("bin").collect()]


@pytest.mark.parametrize("bins", [1, 7, 50])
@pytest.mark.parametrize(
    "values",
    [
        [0, 140],
        list(range(141)),
        [1, 1, 2, 139, 140, 140],
        [5, 5, 5],
        [-3, 0, 8],
        [0.1 * n for n in range(1, 300)],
        [random.Random(1).randint(0, 10_000) for _ in range(2_000)],
    ],
)
def test_histogram_agrees_with_numpy(spark, values, bins):
    assert bins_of(spark, [float(v) for v in values], bins) == list(
        np.histogram(np.array(values, dtype=float), bins=bins)[0]
    )


def test_histogram_skips_nulls_and_keeps_empty_bins(spark):
    assert sum(bins_of(spark, [None, 1.0, 2.0, None])) == 2
    assert bins_of(spark, [None]) == [0] * 50


def test_text_length_histogram_counts_each_text(kept):
    rows = profile.text_length_histogram(kept).collect()
    assert len(rows) == 50
    assert sum(row["count"] for row in rows) == kept.filter("text is not null").count()


def test_period_and_order(kept):
    assert profile.period(kept).select(
        F.col("min_timestamp").cast("string"), F.col("max_timestamp").cast("string")
    ).collect() == [("2012-09-13 03:30:22", "2012-09-14 05:25:11")]
    ordered = [row.id for row in profile.with_timestamp(kept).orderBy("timestamp").collect()]
    assert set(ordered[:3]) == {8, 9, 11} and ordered[-1] == 10


def test_zone_is_matched_as_written(kept):
    assert {row.id for row in profile.in_zone(kept).collect()} == {1, 2, 3, 5, 7, 8, 9, 12}


def test_zone_report(kept):
    row = profile.zone_report(kept).first().asDict()
    length = sum(map(len, ["Good good bad day"] * 2 + ["bad BAD http://t.co/A1, worse", "good",
                 "Mitt's bad day", "me again", "", "place"]))
    assert row == {
        "total": 9, "reshares": 5, "replies": 1, "neither": 3, "partitions": True,
        "mean_length": float(round(length / 9)), "with_tags": 6, "with_text": 8,
        "complete": False,
    }


def test_missing_tags_count_as_none(kept):
    assert {row.id for row in profile.with_tags(kept).collect()} == {1, 2, 3, 4, 5, 6, 12}


def test_topic_labels(kept):
    labelled = topics.with_topic(kept).select("id", "topic").distinct()
    assert dict(labelled.collect()) == {
        1: "obama", 2: "obama", 3: None, 4: "obama", 5: "romney", 6: None, 7: None, 8: None,
        9: None, 10: None, 11: None, 12: "romney"}
    assert {r.id for r in topics.topic_posts(kept, "romney").collect()} == {5, 12}


def test_source_topic_sum(kept):
    assert set(topics.source_topic_sum(kept).collect()) == {("obama", 2, 7), ("romney", 2, 9)}


def test_topic_report_joins_posts_and_sources(kept):
    rows = {row.topic: tuple(row)[1:] for row in topics.topic_report(kept).collect()}
    assert rows == {
        "obama": (4, 3, 1, 0, True, 2, 7),
        "romney": (2, 2, 0, 0, True, 2, 9),
    }


def test_topic_report_of_a_topic_only_in_sources(kept):
    only_source = kept.filter("id = 4")
    rows = {row.topic: tuple(row)[1:] for row in topics.topic_report(only_source).collect()}
    assert rows["romney"] == (0, 0, 0, 0, True, 1, 2)
    assert rows["obama"] == (1, 1, 0, 0, True, 0, None)
