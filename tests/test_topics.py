"""Exact topics: whole tags against a table of needles, by hand and by brute force."""

import random

from plazalens.operators import topics

TAGS = [["Obama"], ["nobama"], ["obama2012"], ["romney", "OBAMA"], [], None, [None], [None, "romney"], ["both"]]


def topics_of(posts, needles):
    rows = topics.with_exact_topic(posts, needles, "tags").collect()
    return sorted(((row.id, row.topic) for row in rows), key=repr)


def test_whole_tags_in_any_case(spark):
    posts = spark.createDataFrame(list(enumerate(TAGS)), "id int, tags array<string>")
    needles = {"a": ["obama", "both"], "b": ["Romney", "both"]}
    expected = ["a", None, None, None, None, None, None, "b", None]
    assert topics_of(posts, needles) == sorted(enumerate(expected), key=repr)
    on_topic = topics.on_exact_topic(posts, needles, "tags").collect()
    assert sorted((row.id, row.topic) for row in on_topic) == [(0, "a"), (7, "b")]
    assert topics_of(posts.limit(0), needles) == []
    assert {topic for _, topic in topics_of(posts, {"a": []})} == {None}


def test_a_table_of_needles_with_nulls_and_repeated_rows(spark):
    posts = spark.createDataFrame([(1, ["x"]), (2, ["y"]), (2, ["y"])], "id int, tags array<string>")
    rows = [("a", "x"), ("a", "X"), (None, "y"), ("b", None), ("c", "y")]
    needles = spark.createDataFrame(rows, "topic string, needle string")
    assert topics_of(posts, needles) == [(1, "a"), (2, "c"), (2, "c")]


def test_a_topic_column_of_the_posts_is_replaced(spark):
    posts = spark.createDataFrame([(1, ["x"], "old")], "id int, tags array<string>, topic string")
    assert topics.with_exact_topic(posts, {"a": ["x"]}, "tags").collect()[0].asDict() == {
        "id": 1, "tags": ["x"], "topic": "a"}


def test_ten_thousand_needles_against_brute_force(spark):
    rng = random.Random(8)
    needles = {f"t{n}": [f"tag{i}" for i in range(n, 10_000, 40)] for n in range(40)}
    of_tag = {tag: topic for topic, tags in needles.items() for tag in tags}
    hot = ["tag7", "other"]
    rows = [
        (i, hot if i % 3 == 0 else [f"tag{rng.randrange(20_000)}" for _ in range(rng.randrange(4))])
        for i in range(900)
    ]
    expected = []
    for i, tags in rows:
        found = {of_tag[tag] for tag in tags if tag in of_tag}
        expected.append((i, found.pop() if len(found) == 1 else None))
    posts = spark.createDataFrame(rows, "id int, tags array<string>")
    assert topics_of(posts, needles) == sorted(expected, key=repr)
