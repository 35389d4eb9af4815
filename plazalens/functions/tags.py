"""Functions over a post's tag list (``array<string>``)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(tags: Column) -> Column:
    """The tags as one string, separated by ``|``; empty for no tags or NULL."""
    return F.coalesce(F.array_join(tags, "|"), F.lit(""))


def is_empty(tags: Column) -> Column:
    """True for an empty or missing list."""
    return F.coalesce(F.size(tags), F.lit(0)) <= 0


def searchable(tags: Column) -> Column:
    """The joined tags in lower case: what the tests below search."""
    return F.lower(joined(tags))


def distinct_lower(tags: Column) -> Column:
    """The different tags in lower case, sorted, without NULLs; NULL for NULL."""
    return F.array_sort(F.array_distinct(F.transform(F.array_compact(tags), F.lower)))


def _needles(needles: Iterable[str]) -> list[str]:
    """The needles in lower case, without those that contain another one: they can match
    nothing new. An empty needle, which every text contains, is refused."""
    wanted = sorted({needle.lower() for needle in needles})
    if "" in wanted:
        raise ValueError("a topic needs needles that are not empty")
    return [n for n in wanted if not any(o != n and o in n for o in wanted)]


def mentions(haystack: Column, needles: Iterable[str]) -> Column:
    """True if some tag holds one of the needles, in any letter case."""
    tests = [haystack.contains(needle) for needle in _needles(needles)]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def topic_of(haystack: Column, topics: Mapping[str, Iterable[str]]) -> Column:
    """Name of the only topic the tags mention; NULL if they mention none or several."""
    hits = {name: mentions(haystack, needles) for name, needles in topics.items()}
    names = [F.when(hit, F.lit(name)) for name, hit in hits.items()]
    matching = reduce(lambda a, b: a + b, [hit.cast("int") for hit in hits.values()], F.lit(0))
    return F.when(matching == 1, F.coalesce(*names, F.lit(None).cast("string")))


def on_one_topic(
    haystack: Column, topics: Mapping[str, Iterable[str]], among: Iterable[str] | None = None
) -> Column:
    """True where `topic_of` is one of the topics, or of those named in ``among``.

    This is one regex, so that a filter builds the haystack once per row: Spark moves the
    filter down to the scan, below the removal of duplicates, where most rows are dropped.
    """
    found = {name: "|".join(map(re.escape, _needles(n))) for name, n in topics.items()}
    found = {name: f".*(?:{pattern})" for name, pattern in found.items() if pattern}
    alone = [
        f"(?={found[name]})" + "".join(f"(?!{found[o]})" for o in found if o != name)
        for name in (topics if among is None else among)
        if name in found
    ]
    return haystack.rlike(f"(?s)^(?:{'|'.join(alone)})") if alone else F.lit(False)
