import random
import re
import string

import pytest
from pyspark.sql import functions as F

from plazalens.functions import tags, text, times
from plazalens.functions.fixed_values import ANY_BLANK, SEPARATORS, STOPWORDS
from plazalens.operators.words import clean_text

NBSP = "\u00a0"


def cleaned(df, everywhere=False):
    return [row.text_cln for row in clean_text(df, everywhere=everywhere).collect()]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, None),
        ("", ""),
        ("   ", ""),
        (" Leading and trailing ", "leading and trailing"),
        ("don't stop", "don t stop"),
        ("@jo_hn hi", "hn hi"),
        ("#tag stays? no #more", "stays no"),
        ("x#y and x@y", "x#y and x@y"),
        ("#a#b c", "c"),
        ("@ # @@ ## a", "a"),
        ("@only", ""),
        (f"a{NBSP}#b{NBSP}c\u3000d\x1ce", "a c d e"),
        ("Ünïcode ÀÉ ß", "ünïcode àé ß"),
        ("tab\tnew\nline\x0bvt\x0cff\rcr", "tab new line vt ff cr"),
        ("HTTP://T.co/AbC rest", "rest"),
        ("see https://a.b/c?d=e&f=g#!h, then", "see then"),
        ("ends http://a.b/c", "ends"),
        ("http:\\\\x.y z", "z"),
        ("http:/one slash", "http one slash"),
        ("ahttp://b c", "a c"),
        ("http://a.b!c d", "c d"),
        ("http://#!x y", "x y"),
        ("http://a#!x y", "y"),
        ("http://a#!#!x y", "x y"),
        ("http://é.com/ü y", "y"),
        ("100% & 50$ | pipes", "100 50 pipes"),
        ("a ||| b ### c *** d", "a b c d"),
    ],
)
def test_clean(texts, raw, expected):
    assert cleaned(texts(raw)) == [expected]


def test_every_separator_is_a_blank(texts):
    assert cleaned(texts("a" + SEPARATORS + "b", *[f"a{c}b" for c in SEPARATORS])) == ["a b"] * (
        1 + len(SEPARATORS)
    )


def test_blank_class_matches_the_blanks_of_every_script(spark):
    points = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "point int, char string")
    found = {row.point for row in df.filter(F.col("char").rlike(f"^[{ANY_BLANK}]$")).collect()}
    assert found == {c for c in points if chr(c).isspace()}


def test_links_replaced_everywhere_leave_the_tail_of_a_longer_link(texts):
    df = texts("http://a.b http://a.b/tail end", "http://a.b/tail http://a.b end")
    assert cleaned(df) == ["end", "end"]
    assert cleaned(df, everywhere=True) == ["tail end", "end"]


def test_long_links_and_entity_lists_do_not_overflow(texts):
    link = "http://a.b/" + "x#!" * 50_000
    entities = "#tag @user " * 50_000
    assert cleaned(texts(f"{link} {entities} end")) == ["end"]


LINK = re.compile(r"https?:(?://|\\)+(?:[\w:#@%/;$()~?+-=\\.&](?:#!)?)*")
GAP = re.compile("[" + re.escape("".join(set(string.punctuation) - set("@#"))) + r"\s\x1c-\x1f]+")


def words_of(text):
    return " ".join(word for word in GAP.split(text) if word and word[0] not in "@#")


@pytest.mark.parametrize("everywhere", [False, True])
def test_clean_agrees_with_python_on_random_texts(texts, everywhere):
    rng = random.Random(11)
    pieces = [*"abZ9_éÀß²½Ⅷ中٣ @#!/\\:.,'-~+=&%\t\n\r\x0b\x1c\x85\u00a0\u2009\u2028\u3000",
              "http://", "https:\\", "HTTP:", "#!", "a.b/", "http://a", " ", " ", "@x ", "#y "]
    raw = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(3_000)]
    expected = []
    for text in map(str.lower, raw):
        if everywhere:
            for link in [match.group() for match in LINK.finditer(text)]:
                text = text.replace(link, ", ")
        expected.append(words_of(text if everywhere else LINK.sub(", ", text)))
    assert cleaned(texts(*raw), everywhere) == expected


def test_count_tokens_split_at_ascii_blanks_only(texts):
    df = texts(f"A\tb{NBSP}c  d").select(text.count_tokens(F.col("text")).alias("t"))
    assert df.first().t == ["a", f"b{NBSP}c", "d"]


def test_tokens(texts):
    df = texts(f"a{NBSP}b\nc").select(
        text.tokens(F.col("text"), cleaned=False).alias("any"),
        text.tokens(F.lit("a b")).alias("cleaned"),
    )
    assert df.first() == (["a", "b", "c"], ["a", "b"])


def test_stopwords_are_a_set():
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 187


@pytest.fixture
def tag_df(spark):
    rows = [(["Obama"],), (["nobama", "x"],), (["Obama", "ROMNEY"],), ([],), (None,),
            ([None, "romney"],), (["oba", "ma"],), (["obama2012"],)]
    return spark.createDataFrame(rows, "tags array<string>")


def test_tag_functions(tag_df):
    topics = {"o": ("obama", "obama2012"), "r": ("romney",)}
    rows = tag_df.select(
        tags.joined(F.col("tags")).alias("joined"),
        tags.is_empty(F.col("tags")).alias("empty"),
        tags.mentions(tags.searchable(F.col("tags")), ["Obama"]).alias("mentions"),
        tags.topic_of(tags.searchable(F.col("tags")), topics).alias("topic"),
        tags.topic_of(tags.searchable(F.col("tags")), {}).alias("none"),
    ).collect()
    assert [r.joined for r in rows] == [
        "Obama", "nobama|x", "Obama|ROMNEY", "", "", "romney", "oba|ma", "obama2012"]
    assert [r.empty for r in rows] == [False, False, False, True, True, False, False, False]
    assert [r.mentions for r in rows] == [True, True, True, False, False, False, False, True]
    assert [r.topic for r in rows] == ["o", "o", None, None, None, "r", None, "o"]
    assert {r.none for r in rows} == {None}


@pytest.mark.parametrize(
    "topics",
    [
        {},
        {"o": ("obama", "obama2012"), "r": ("romney",)},
        {"o": ["Obama"], "r": ["romney"], "x": ["x"]},
        {"none": [], "o": ["OBAMA"]},
        {"bar": ["|"], "dot": ["a.a"], "o": ["oba"]},
    ],
)
def test_topic_filters_agree_with_the_label(spark, topics):
    rows = [(["Obama"],), (["nobama", "x"],), (["Obama", "ROMNEY"],), ([],), (None,), (["a.A"],),
            ([None, "romney"],), (["oba", "ma"],), (["obama2012", "line\nbreak"],), (["\nX"],)]
    df = spark.createDataFrame(rows, "tags array<string>")
    haystack = tags.searchable(F.col("tags"))
    for among in [None, *([name] for name in topics)]:
        rows = df.select(
            tags.topic_of(haystack, topics).alias("topic"),
            tags.on_one_topic(haystack, topics, among).alias("on"),
        ).collect()
        wanted = set(topics if among is None else among)
        assert [row.on for row in rows] == [row.topic in wanted for row in rows]


def test_topic_among_three(tag_df):
    topics = {"o": ["obama"], "r": ["romney"], "x": ["x"]}
    haystack = tags.searchable(F.col("tags"))
    rows = tag_df.select(tags.topic_of(haystack, topics).alias("topic")).collect()
    assert [r.topic for r in rows] == ["o", None, None, None, None, "r", None, "o"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Thu Sep 13 03:30:22 +0000 2012", "2012-09-13 03:30:22"),
        ("Fri Sep 14 07:25:11 +0200 2012", "2012-09-14 05:25:11"),
        ("thu sep 13 03:30:22 +0000 2012", "2012-09-13 03:30:22"),
        ("Xyz Sep 13 03:30:22 +0000 2012", None),
        ("Thu Foo 13 03:30:22 +0000 2012", None),
        ("2012-09-13", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_created_at(texts, raw, expected):
    parsed = texts(raw).select(times.parse_created_at(F.col("text")).cast("string").alias("t"))
    assert parsed.first().t == expected
