"""Expressions that are worth working out only once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(col: Column) -> Column:
    """The same value, for a column of its own in ``select`` or ``withColumn``.

    Spark moves a filter on a projected column below the projection, by repeating the
    expression in the filter, and ahead of cheaper filters. It moves none below an explode.
    Exploding a one-element array keeps each row as it is.
    """
    return F.explode(F.array(col))
