"""Lexicon sentiment: the sign of the summed polarity of a text's words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import NEGATIVE, NEUTRAL, POSITIVE
from ..functions.once import once
from ..functions.text import token_gap, tokens
from ..sources.checkpoints import written
from ..sources.posts import POST_FIELDS, PostFields
from .profile import is_reshare

Lexicon = Mapping[str, float] | Iterable[tuple[str, float]] | DataFrame
Labels = tuple[str, str, str]
LABELS: Labels = (POSITIVE, NEGATIVE, NEUTRAL)

_BIT_SLOTS = 1 << 14
_EXACT = "DECIMAL(28, 9)"


def lexicon_of(positive: Iterable[str], negative: Iterable[str]) -> list[tuple[str, int]]:
    """Entries of a lexicon from two word lists. A word in both is in it twice and cancels."""
    return [(word, 1) for word in positive] + [(word, -1) for word in negative]


def read_lexicon(spark, positive: str, negative: str) -> DataFrame:
    """A lexicon table ``word, polarity`` from two text files with one word per line."""

    def words(path: str, polarity: int) -> DataFrame:
        word = F.trim("value").alias("word")
        return spark.read.text(path).select(word, F.lit(polarity).alias("polarity"))

    return words(positive, 1).union(words(negative, -1)).filter("word != ''")


def label_of(score: str, labels: Labels = LABELS) -> Column:
    """Positive, negative or neutral label by the sign of a score column; NULL for NULL."""
    positive, negative, neutral = labels
    sign = F.sign(score)
    return F.when(sign > 0, positive).when(sign < 0, negative).when(sign == 0, neutral)


def _exact(polarity) -> Decimal:
    return Decimal(str(polarity)).quantize(Decimal("1e-9"), ROUND_HALF_UP)


def score_sql(words: str, entries: Iterable[tuple[str, float]]) -> str:
    """SQL of the summed polarity of an array of words, for entries that fit in the plan.

    An entry listed twice counts once; a word with several polarities counts with each; the
    empty word and entries without a polarity do not count. Sums are exact. Thousands of
    literals go to the parser as one string, not one by one through the Python gateway, and
    end up in one hash set per polarity.
    """
    net: dict[str, Decimal] = defaultdict(Decimal)
    for word, polarity in {(w, _exact(p)) for w, p in entries if w and p is not None}:
        net[word] += polarity
    by_polarity: dict[Decimal, list[str]] = defaultdict(list)
    for word in sorted(net):
        if net[word]:
            by_polarity[net[word]].append(_literal(word))
    whole = all(polarity == int(polarity) and abs(polarity) < 2**31 for polarity in by_polarity)
    kind = "BIGINT" if whole else "DECIMAL(38, 9)"
    cases = "".join(
        f" WHEN word IN ({', '.join(words_of)}) THEN CAST('{polarity:f}' AS {kind})"
        if not whole
        else f" WHEN word IN ({', '.join(words_of)}) THEN {int(polarity)}L"
        for polarity, words_of in sorted(by_polarity.items())
    )
    gain = f"CASE{cases} ELSE 0 END" if cases else "0"
    return f"aggregate({words}, CAST(0 AS {kind}), (score, word) -> CAST(score + {gain} AS {kind}))"


def _literal(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_sentiment(
    df: DataFrame,
    lexicon: Lexicon,
    column: str = "text_cln",
    out: str = "sentiment",
    labels: Labels = LABELS,
    cleaned: bool = True,
) -> DataFrame:
    """Add the sentiment label of a text column; NULL for NULL text. ``cleaned=False`` is
    for text that did not pass `clean_text`.

    Entries given in Python become part of the plan and are tested inside each row: no
    shuffle, for as many as the driver can hold. A table is joined, whatever its size, and
    Spark chooses how by the bytes it has. Both give the same labels: polarities are whole
    numbers or are rounded to nine digits, and sums are exact.
    """
    if isinstance(lexicon, DataFrame):
        return _with_joined_sentiment(df, lexicon, column, out, labels, cleaned)
    if isinstance(lexicon, Mapping):
        lexicon = lexicon.items()
    text = f"`{column}`" if column in df.columns else column
    score = score_sql(f"split({text}, {_literal(token_gap(cleaned))})", lexicon)
    scored = df.withColumn("__score", once(F.expr(score)))
    return scored.withColumn(out, label_of("__score", labels)).drop("__score")


def net_polarity(lexicon: DataFrame) -> DataFrame:
    """``word``, ``polarity``: different entries of a lexicon table summed up, without the
    empty word, entries that lack a part, and words that cancel."""
    whole = isinstance(lexicon.schema["polarity"].dataType, T.IntegralType)
    polarity = F.col("polarity").cast("BIGINT" if whole else _EXACT).alias("polarity")
    entries = lexicon.select("word", polarity).dropna().filter("word != ''").distinct()
    return entries.groupBy("word").agg(F.sum("polarity").alias("polarity")).filter("polarity != 0")


def _with_joined_sentiment(
    df: DataFrame, lexicon: DataFrame, column: str, out: str, labels: Labels, cleaned: bool
) -> DataFrame:
    """The label by two joins: words meet the lexicon, then scores meet the rows.

    The summed lexicon is written to the shared folder first, so that Spark knows its bytes when
    it chooses the join. Only a text's SHA-256 goes with its words. Words that the lexicon cannot
    hold are dropped by a bit table before any shuffle, and scores are combined in each task. A
    text posted n times scores n times as much, with the same sign. The rows read their text a
    second time and are shuffled once, by that digest; Spark splits a text that is posted very
    often, and rows without a text, which need no score, are spread.
    """
    digest = F.unhex(F.sha2(column, 256))
    polarity = written(net_polarity(lexicon), "lexicon")
    words = df.select(digest.alias("digest"), F.explode(tokens(F.col(column), cleaned)).alias("word"))
    found = words.filter(_may_be_in(polarity)).join(polarity, "word")
    scores = found.groupBy(F.col("digest").alias("__digest")).agg(F.sum("polarity").alias("__score"))
    spread = F.unhex(F.hex(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])))
    rows = df.select("*", F.coalesce(digest, spread).alias("__digest"), digest.isNotNull().alias("__has_text"))
    label = F.coalesce(label_of("__score", labels), F.lit(labels[2]))
    return rows.join(scores, "__digest", "left").select(
        *[F.col(f"`{name}`") for name in df.columns if name != out],
        F.when(F.col("__has_text"), label).alias(out),
    )


def _may_be_in(lexicon: DataFrame) -> Column:
    """True for each ``word`` of the lexicon and for few others: a table of bits by the word's
    hash, one row of `_BIT_SLOTS` numbers whatever the size of the lexicon. A lexicon of more
    than a million words fills it, and fewer words are dropped."""
    hashed = F.xxhash64("word")
    slot, bit = F.pmod(hashed, F.lit(_BIT_SLOTS)), F.shiftrightunsigned(hashed, 58).cast("int")
    ones = lexicon.select(slot.alias("id"), bit.alias("bit")).groupBy("id")
    ones = ones.agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    slots = lexicon.sparkSession.range(_BIT_SLOTS).join(ones, "id", "left")
    listed = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))
    table = slots.agg(listed.getField("bits").alias("bits")).scalar()
    return F.getbit(F.element_at(table, (slot + 1).cast("int")), bit) == 1


def sentiment_counts(df: DataFrame, sentiment: str = "sentiment") -> DataFrame:
    """``sentiment``, ``count``."""
    return df.groupBy(F.col(sentiment).alias("sentiment")).agg(F.count("*").alias("count"))


def sentiment_kinds(
    df: DataFrame, fields: PostFields = POST_FIELDS, by: tuple[str, ...] = ("topic", "sentiment")
) -> DataFrame:
    """Per topic and sentiment: posts, how many of them are reshares, and of how many of
    those the original is a reply."""
    of_a_reply = is_reshare(fields) & F.col(fields.source_reply_to).isNotNull()
    return df.groupBy(*by).agg(
        F.count("*").alias("posts"),
        F.count_if(is_reshare(fields)).alias("reshares"),
        F.count_if(of_a_reply).alias("reshares_of_replies"),
    )
