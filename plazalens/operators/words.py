"""Word counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import STOPWORDS, TOP_WORDS
from ..functions.text import clean, count_tokens
from .ranking import top_k

StopWords = Iterable[str] | DataFrame


def most_frequent_first() -> list:
    """Order by count, then word: ties always come out the same."""
    return [F.desc("count"), F.asc("word")]


def clean_text(
    df: DataFrame, column: str = "text", out: str = "text_cln", everywhere: bool = False
) -> DataFrame:
    """Add the cleaned text."""
    return df.withColumn(out, clean(F.col(column), everywhere))


def without_stopwords(df: DataFrame, stopwords: StopWords) -> DataFrame:
    """Drop rows whose ``word`` is a stop word.

    A Python collection becomes a hash-set test. A table (its first column) is
    anti-joined, and Spark broadcasts it only if it is small.
    """
    if isinstance(stopwords, DataFrame):
        unwanted = stopwords.select(F.col(stopwords.columns[0]).alias("word"))
        return df.join(unwanted, "word", "left_anti")
    unwanted = list(dict.fromkeys(stopwords))
    return df.filter(~F.col("word").isin(unwanted)) if unwanted else df


def word_counts(
    df: DataFrame, column: str = "text", stopwords: StopWords = STOPWORDS
) -> DataFrame:
    """``word``, ``count`` of the lower-case words of a column, stop words left out.

    Tasks count their own words before the shuffle, so frequent words do not pile up in
    one task. Stop words leave after the counting, when each word is one row; Spark moves
    a hash-set test down to the words itself.
    """
    words = df.select(F.explode(count_tokens(F.col(column))).alias("word"))
    counts = words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("count"))
    return without_stopwords(counts, stopwords)


def vocabulary_size(counts: DataFrame) -> DataFrame:
    """``words``: the number of different words in the result of `word_counts`."""
    return counts.agg(F.count("*").alias("words"))


def top_words(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """The ``k`` most frequent words of the result of `word_counts`."""
    return top_k(counts, most_frequent_first(), k)


def top_total(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """``total``: the sum of the ``k`` highest counts (not of all counts)."""
    return top_words(counts, k).agg(F.sum("count").alias("total"))
