"""What the physical plans look like: what reaches the scan, what is shuffled, and how."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from plazalens.operators import graph, profile, sentiment, topics, words
from plazalens.operators.ranking import top_k_per_group
from plazalens.plans import reports
from plazalens.plans.queries import QUERIES
from plazalens.sources import FLAT_FIELDS, POST_FIELDS, deduplicate, distinct_flat

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


def plan(df, run=False):
    """The physical plan, after a run only the one that AQE ended up with."""
    if run:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue().split("== Initial Plan ==")[0] if run else text.getvalue()


LOOPS = ("hop_distances", "closeness")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(LOOPS)))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


@pytest.mark.parametrize(
    "name, columns",
    [
        ("word_counts", "text:string"),
        ("kind_breakdown", "doc_id:bigint"),
        ("text_length_histogram", "text:string"),
        ("vertices", "doc_id:bigint,source:string"),
        ("period", "ts:timestamp_ntz"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert f"ReadSchema: struct<{columns}>" in text


def test_counts_are_combined_before_the_shuffle(spark):
    text = plan(QUERIES["word_counts"](spark, SF_DIR))
    assert text.count("Exchange") == 1 and "partial_count" in text
    assert "INSET" in text


def test_segments_need_one_shuffle_and_ranks_are_cut_before_theirs(spark):
    assert plan(QUERIES["segment_counts"](spark, SF_DIR)).count("Exchange") == 1
    text = plan(QUERIES["keyword_report"](spark, SF_DIR))
    assert text.count("Exchange") == 3  # the counts, the slices' ranks, the groups' ranks
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_words_take_no_global_sort(spark):
    text = plan(QUERIES["top_words"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize("name", ["degree_share", "text_length_histogram"])
def test_input_is_read_once(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR), run=True)
    assert "ReusedExchange" in text


def test_inlined_lexicon_does_not_shuffle(spark):
    assert plan(QUERIES["positive_posts"](spark, SF_DIR)).count("Exchange") == 0


def test_a_hop_shuffles_neither_links_nor_seen_rows(spark):
    links = spark.createDataFrame([(n, n % 7) for n in range(200)], "src bigint, dst bigint")
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        graph.use_checkpoint_dir(spark)
        marks = graph._landmark_table(links, [0])
        laid_out, splits = graph._laid_out(links, True, marks)
        start, _ = graph._written(graph._first_bits(marks, splits, 1))
        far, n = graph._written(start.withColumn("id", start.id + 50))
        seen = [graph._Seen(start, 1).known, graph._Seen(far, n).known]
        assert [pairs.count() for pairs in seen] == [1, n] == [1, 1]
        text = plan(graph._next_hop(laid_out, start, seen, 1))
        for frame in [laid_out, *seen]:
            frame.unpersist()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    ours = [line for line in text.splitlines() if "ENSURE_REQUIREMENTS" in line]
    # The steps by group and vertex, and the newest rows by end vertex: nothing else moves.
    assert len(ours) == 2
    assert len(re.findall("SortMergeJoin.*LeftOuter", text)) == 2 and text.count("SortMergeJoin") == 3


@pytest.mark.parametrize("distinct", [deduplicate, distinct_flat])
def test_filters_run_before_duplicates_are_removed(posts, distinct):
    fields = POST_FIELDS if distinct is deduplicate else FLAT_FIELDS
    kept = profile.in_zone(distinct(posts), fields=fields)
    for report in (
        topics.on_topic(kept, tags=fields.tags),
        topics.topic_posts(kept, "obama", tags=fields.tags),
        topics.source_topic_sum(kept, fields=fields),
        topics.topic_report(kept, fields=fields),
        sentiment.sentiment_kinds(reports.labelled_posts(kept, {"good": 1}, fields=fields), fields),
    ):
        text = plan(report)
        scan = text[text.rindex("Exchange"):]
        assert "RLIKE" in scan and "Contains(" in scan
        if distinct is distinct_flat:
            assert scan.index("sha2(") < scan.index("RLIKE")


def test_large_stop_table_is_joined_after_counting(spark):
    df = spark.createDataFrame([("a b",)], "text string")
    stop = spark.range(10).selectExpr("string(id) AS word")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(words.word_counts(df, "text", stop))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.index("LeftAnti") < text.index("HashAggregate")


def test_large_rankings_are_made_in_slices(spark):
    df = spark.createDataFrame([("a", "w", 1)], "g string, word string, n int")
    text = plan(top_k_per_group(df, ["g"], [F.desc("n"), F.asc("word")], 900, spread_by="word"))
    assert text.count("Exchange") == 2 and "xxhash64" in text


def test_rows_stay_out_of_the_join_of_words_and_lexicon(spark):
    posts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "text")
    lexicon = spark.createDataFrame([("the", 1)], "word string, polarity int")
    text = plan(sentiment.with_sentiment(posts, lexicon, "text"))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    read = [line.split("ReadSchema: ")[1] for line in scans]
    assert "struct<text:string>" in read  # what the words come from
    assert sum("source:string" in columns for columns in read) == 1
    assert "getbit" in text and "partial_sum(polarity" in text


def test_exact_topics_shuffle_tag_sets_and_needles_but_no_text(spark):
    text = plan(QUERIES["exact_topic_posts"](spark, SF_DIR))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text" not in line
