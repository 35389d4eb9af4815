from plazalens.operators import graph, profile, sentiment, topics
from plazalens.plans import analyses, reports
from plazalens.sources import FLAT_FIELDS, deduplicate, flatten
from tests.test_words_and_sentiment import LEXICON


def test_exploration(posts):
    tables = analyses.exploration(analyses.prepare(posts), LEXICON)
    kept = deduplicate(posts)
    assert tables["kinds"].collect() == profile.kind_breakdown(kept).collect()
    assert tables["text_length"].collect() == profile.mean_text_length(kept).collect()
    assert sorted(tables["text_length_histogram"].collect()) == sorted(
        profile.text_length_histogram(kept).collect())
    assert tables["period"].collect() == profile.period(kept).collect()
    assert tables["locations"].collect() == [(13, 1, 1, 1, 11)]
    assert tables["tags"].collect() == [(profile.with_tags(kept).count(),)]
    assert tables["zone"].collect() == profile.zone_report(kept).collect()
    assert set(tables["topics"].collect()) == set(topics.topic_report(kept).collect())
    expected = sentiment.sentiment_kinds(reports.labelled_posts(kept, LEXICON))
    assert set(tables["sentiment"].collect()) == set(expected.collect())


def test_word_report(spark, posts, tmp_path):
    analyses.prepare(posts).write.parquet(str(tmp_path / "posts"))
    prepared = spark.read.parquet(str(tmp_path / "posts"))
    tables = analyses.word_report(prepared, LEXICON, k=2)
    usa = flatten(profile.in_zone(deduplicate(posts)))
    expected = reports.segment_counts(usa, LEXICON, fields=FLAT_FIELDS)
    assert set(tables["counts"].collect()) == set(expected.collect())
    assert {r.segment for r in tables["top"].collect()} == {
        "obama raw", "obama clean", "obama positive", "obama negative",
        "romney raw", "romney clean", "romney negative"}
    assert {r.segment: r.words for r in tables["totals"].collect()}["obama raw"] == 5


def test_network(posts):
    tables = analyses.network(analyses.prepare(posts), k=1)
    assert tables["size"].collect() == [(9, 10, 7)]
    assert tables["edges"].count() == 7
    assert tables["top"].collect() == [("hub", 6, 85.71)]
    assert set(tables["degrees"].collect()) == set(
        graph.degree_share(graph.edges(deduplicate(posts))).collect())
