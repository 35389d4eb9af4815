import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plazalens.operators import sentiment, words
from plazalens.operators.ranking import top_k_per_group
from plazalens.plans import reports
from plazalens.sources import PostFields, deduplicate

LEXICON = sentiment.lexicon_of(
    ["good", "great", "both", "well-made", "it's"], ["bad", "worse", "both", "two-faced"]
)


def label(score):
    return {1: "positivo", -1: "negativo", 0: "neutro"}[(score > 0) - (score < 0)]


def labels_of(df, lexicon=LEXICON, **options):
    rows = sentiment.with_sentiment(df, lexicon, "text", **options).collect()
    return [row.sentiment for row in rows]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("", "neutro"),
        ("nothing here", "neutro"),
        ("good", "positivo"),
        ("bad", "negativo"),
        ("good bad", "neutro"),
        ("good good bad", "positivo"),
        ("bad bad good", "negativo"),
        ("both", "neutro"),
        ("both good", "positivo"),
        ("Good", "neutro"),
        ("goodness", "neutro"),
        ("it's", "positivo"),
    ],
)
def test_label(texts, text, expected):
    assert labels_of(texts(text)) == [expected]


def test_words_split_at_blanks_of_every_script_on_request(texts):
    df = texts("good good\nbad")
    assert labels_of(df, cleaned=False) == ["positivo"]


def test_lexicon_entries(texts, spark):
    doubled = [("good", 1), ("good", 1), ("bad", -1), ("fine", 3), ("", 5), ("a\\'b", -2)]
    df = texts("good bad", "fine bad bad", "a\\'b good", "bad")
    expected = ["neutro", "positivo", "negativo", "negativo"]
    assert labels_of(df, doubled) == expected
    assert labels_of(df, {"good": 1, "bad": -1, "fine": 3, "a\\'b": -2}) == expected
    table = spark.createDataFrame([*doubled, (None, 1), ("x", None)], "word string, polarity int")
    labelled = sentiment.with_sentiment(df, table, df.columns[0]).collect()
    assert {row.text: row.sentiment for row in labelled} == dict(zip([r.text for r in df.collect()], expected))
    assert labels_of(df, []) == ["neutro"] * 4


def test_other_labels(texts):
    df = texts("good", "bad", "x")
    assert labels_of(df, labels=("up", "down", "level")) == ["up", "down", "level"]


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_joined_and_inlined_lexicon_agree_with_a_count(spark, broadcast):
    rng = random.Random(7)
    vocabulary = [f"w{n}" for n in range(60)]
    # A third of the rows share one text and a third of all words are one word.
    texts = ["w1 w1 w2"] * 100 + [
        " ".join(rng.choices(vocabulary + ["w1"] * 30, k=rng.randint(0, 12))) for _ in range(200)
    ]
    entries = [(w, 1) for w in vocabulary[:25]] + [(w, -1) for w in vocabulary[20:50]]
    df = spark.createDataFrame(list(enumerate(texts)) + [(300, None)], "id int, text string")
    lexicon = spark.createDataFrame(entries, "word string, polarity int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        rows = sentiment.with_sentiment(df, lexicon, "text").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    net = Counter()
    for word, polarity in entries:
        net[word] += polarity
    expected = {n: label(sum(net[w] for w in t.split(" "))) for n, t in enumerate(texts)}
    assert {row.id: row.sentiment for row in rows} == {**expected, 300: None}
    assert [name for name, _ in df.dtypes] + ["sentiment"] == list(rows[0].asDict())


POLARITIES = {
    "double": ("double", [0.5, -1.0, 0.4, 0.1, 0.2, -0.3]),
    "bigint": ("bigint", [2**40, -(2**40), 3, 1, -1, 2]),
    "int": ("int", [1, -1, 1, 2, -2, 1]),
    "decimal": ("decimal(5,2)", [Decimal("0.5"), Decimal("-1.0"), Decimal("0.40"), Decimal("0.1"), Decimal("0.2"), Decimal("-0.3")]),
}


@pytest.mark.parametrize("kind", sorted(POLARITIES))
def test_a_list_and_a_table_give_the_same_labels(spark, texts, kind):
    ddl, values = POLARITIES[kind]
    names = ["good", "bad", "meh", "a", "b", "c"]
    entries = [*zip(names, values), ("", values[0]), ("good", None), ("good", values[0])]
    table = spark.createDataFrame([*entries, (None, values[0])], f"word string, polarity {ddl}")
    lines = ["good good bad", "meh", "", "  ", "a b c", "bad", "good", None, "x"]
    df = texts(*lines)

    def expected(text):
        if text is None:
            return None
        net = {name: Decimal(str(value)) for name, value in zip(names, values)}
        return label(sum(net.get(word, 0) for word in text.split(" ")))

    by_hand = sorted(((t, expected(t)) for t in lines), key=repr)
    for lexicon in (entries, table):
        labelled = sentiment.with_sentiment(df, lexicon, df.columns[0])
        got = sorted((tuple(row) for row in labelled.collect()), key=repr)
        assert got == by_hand


def test_a_lexicon_table_that_no_word_is_in_and_texts_posted_often(spark):
    rows = [(i, "good day" if i % 3 else None) for i in range(300)] + [(300, ""), (300, "bad"), (300, "bad")]
    df = spark.createDataFrame(rows, "id int, text string")
    table = spark.createDataFrame([("good", 1), ("bad", -1), (None, 1), ("", 1)], "word string, polarity int")
    got = [tuple(row) for row in sentiment.with_sentiment(df, table, "text").collect()]
    labels = {None: None, "good day": "positivo", "": "neutro", "bad": "negativo"}
    assert sorted(got, key=repr) == sorted(((i, text, labels[text]) for i, text in rows), key=repr)
    none = sentiment.with_sentiment(df, table.limit(0), "text").select("sentiment").distinct().collect()
    assert {row.sentiment for row in none} == {None, "neutro"}


def test_a_lexicon_of_many_words_is_not_thinned_by_the_bit_table(spark):
    words_of = spark.range(200_000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit(1).alias("polarity"))
    df = words_of.select(F.col("word").alias("text")).union(spark.range(1000).select(F.concat(F.lit("x"), "id")))
    counts = sentiment.sentiment_counts(sentiment.with_sentiment(df, words_of, "text"))
    assert {row.sentiment: row["count"] for row in counts.collect()} == {"positivo": 200_000, "neutro": 1000}


def test_read_lexicon(spark, tmp_path):
    (tmp_path / "pos.txt").write_text("good\n a+ \n\nboth\n")
    (tmp_path / "neg.txt").write_text("bad\nboth")
    table = sentiment.read_lexicon(spark, str(tmp_path / "pos.txt"), str(tmp_path / "neg.txt"))
    assert sorted(map(tuple, table.collect())) == [
        ("a+", 1), ("bad", -1), ("both", -1), ("both", 1), ("good", 1)]


def counts_of(df):
    return {row.word: row["count"] for row in df.collect()}


def test_word_counts(texts):
    df = texts(" The cat\tTHE  dog don't ", "rt dog ... dog cat", None, "", "   ")
    assert counts_of(words.word_counts(df)) == {"cat": 1, "dog": 2, "dog cat": 1}
    assert counts_of(words.word_counts(df, stopwords=()))["the"] == 2


def test_stop_table_does_what_the_list_does(spark, texts):
    df = texts("a b a c", "c b d")
    table = spark.createDataFrame([("a",), ("c",), ("a",)], "w string")
    expected = {"b": 2, "d": 1}
    assert counts_of(words.word_counts(df, "text", ["a", "c"])) == expected
    assert counts_of(words.word_counts(df, "text", table)) == expected


def test_top_words_break_ties_by_word(texts):
    counts = words.word_counts(texts("z z y y x w w w"), stopwords=())
    assert [tuple(r) for r in words.top_words(counts, 3).collect()] == [("w", 3), ("y", 2), ("z", 2)]
    assert words.top_total(counts, 3).first().total == 7
    assert words.vocabulary_size(counts).first().words == 4


def test_top_k_per_group_past_the_group_limit_threshold(spark):
    rows = [(g, f"w{n}", n % 50) for g in ("a", "b") for n in range(700)]
    df = spark.createDataFrame(rows, "g string, word string, n int")
    order = [F.desc("n"), F.asc("word")]
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        got = top_k_per_group(df, ["g"], order, 300, spread_by="word").collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    expected = []
    for g in ("a", "b"):
        best = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:300]
        expected += [(*row, rank + 1) for rank, row in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(expected)


def test_sentiment_counts_and_kinds(posts):
    kept = deduplicate(posts)
    labelled = reports.labelled_posts(kept, LEXICON)
    kinds = {(r.topic, r.sentiment): tuple(r)[2:] for r in sentiment.sentiment_kinds(labelled).collect()}
    assert kinds == {
        ("obama", "positivo"): (3, 3, 1),
        ("obama", "negativo"): (1, 0, 0),
        ("romney", "negativo"): (1, 1, 0),
        ("romney", "neutro"): (1, 1, 0),
    }
    counts = {r.sentiment: r["count"] for r in sentiment.sentiment_counts(labelled).collect()}
    assert counts == {"positivo": 3, "negativo": 2, "neutro": 1}


def test_keyword_segments_of_the_posts(posts):
    counts = reports.segment_counts(deduplicate(posts), LEXICON)
    segments = {}
    for row in counts.collect():
        segments.setdefault(row.segment, {})[row.word] = row["count"]
    assert segments == {
        "obama raw": {"good": 5, "bad": 4, "day": 3, "http://t.co/a1,": 1, "worse": 1},
        "obama clean": {"good": 5, "bad": 4, "day": 3, "worse": 1},
        "obama positive": {"good": 5, "bad": 2, "day": 3},
        "obama negative": {"bad": 2, "worse": 1},
        "romney raw": {"mitt's": 1, "bad": 1, "day": 1, "place": 1},
        "romney clean": {"mitt": 1, "bad": 1, "day": 1, "place": 1},
        "romney negative": {"mitt": 1, "bad": 1, "day": 1},
    }
    top = reports.keyword_report(counts, 2).filter("segment = 'obama raw'").orderBy("rank")
    assert [tuple(r) for r in top.collect()] == [
        ("obama raw", "good", 5, 1), ("obama raw", "bad", 4, 2)]
    totals = {r.segment: (r.words, r.total) for r in reports.keyword_totals(counts, 2).collect()}
    assert totals["obama raw"] == (5, 9) and totals["obama negative"] == (2, 3)


def test_segments_agree_with_one_count_per_segment(spark):
    rng = random.Random(3)
    vocabulary = ["good", "bad", "the", "Both", "x", "#tag", "@who", "well-made", "y.", "z!"]
    rows = [
        (" ".join(rng.choices(vocabulary, k=rng.randint(0, 9))), rng.choice([["a"], ["b"], ["ab"], []]))
        for _ in range(150)
    ]
    df = spark.createDataFrame(rows, "text string, tags array<string>")
    topics, fields = {"a": ["a"], "b": ["b"]}, PostFields(tags="tags")
    counts = reports.segment_counts(df, LEXICON, topics, fields=fields)
    labelled = reports.labelled_posts(df, LEXICON, topics, fields)
    for topic in topics:
        of_topic = labelled.filter(F.col("topic") == topic)
        for kind, part, column in [
            ("raw", of_topic, "text"),
            ("clean", of_topic, "text_cln"),
            ("positive", of_topic.filter("sentiment = 'positivo'"), "text_cln"),
            ("negative", of_topic.filter("sentiment = 'negativo'"), "text_cln"),
        ]:
            segment = counts.filter(F.col("segment") == f"{topic} {kind}")
            assert counts_of(segment) == counts_of(words.word_counts(part, column)), (topic, kind)
