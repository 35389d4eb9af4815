"""Text functions: Column in, Column out, all of them built-in JVM expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import ANY_BLANK, ASCII_BLANK, LINK_PATTERN, SEPARATORS

# One pass over the text: a run of blanks and punctuation, with any entities in it, unless it
# is the one blank it would become (most are). Possessive quantifiers keep the matcher
# iterative: a plain repeated group recurses once per repetition in Java and overflows the
# stack on very long links or lists of entities.
_GAP = re.escape(SEPARATORS) + ANY_BLANK
_GAPS_AND_ENTITIES = rf"(?! [^{_GAP}@#])[{_GAP}]++(?:[@#][^{_GAP}]*+[{_GAP}]*+)*+"


def strip_links(col: Column, everywhere: bool = False) -> Column:
    """Replace each link in lower-case text by a comma and a blank.

    ``everywhere=True`` replaces the links found one after the other, each wherever its
    characters occur. A link that begins a later, longer one then leaves that one's tail
    behind. The default replaces every link as a whole.
    """
    if not everywhere:
        return F.regexp_replace(col, LINK_PATTERN, ", ")
    links = F.regexp_extract_all(col, F.lit(LINK_PATTERN), 0)
    return F.reduce(links, col, lambda text, link: F.replace(text, link, F.lit(", ")))


def strip_entities(col: Column) -> Column:
    """Turn punctuation into blanks, drop words starting with ``@`` or ``#``, and join
    what is left with single blanks."""
    gap_first = F.concat(F.lit(" "), col)
    return F.trim(F.regexp_replace(gap_first, _GAPS_AND_ENTITIES, " "))


def clean(col: Column, everywhere: bool = False) -> Column:
    """Lower case, without links, entities and punctuation. NULL stays NULL."""
    return strip_entities(strip_links(F.lower(col), everywhere))


def count_tokens(col: Column) -> Column:
    """Lower-case words between ASCII blanks, as the word counter splits them. A text with
    a leading or trailing blank, or none, has an empty first or last word."""
    return F.split(F.lower(col), f"{ASCII_BLANK}+")


def token_gap(cleaned: bool = True) -> str:
    """What separates the words of a cleaned text, or else of any text: blanks of any
    script. Cleaned text splits on one plain character, which needs no regex."""
    return " " if cleaned else f"[{ANY_BLANK}]+"


def tokens(col: Column, cleaned: bool = True) -> Column:
    """Words of a cleaned text, or of any text."""
    return F.split(col, token_gap(cleaned))
