"""Time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import CREATED_AT_FORMAT, WEEKDAYS


def parse_created_at(col: Column) -> Column:
    """``Thu Sep 13 03:30:22 +0000 2012`` as a timestamp; NULL if it does not read so.

    The default datetime parser takes no weekday names, so the name is checked apart
    and the rest parsed. This needs no session-wide legacy parser setting.
    """
    weekday = F.lower(F.substring(col, 1, 4)).isin(*WEEKDAYS)
    rest = F.try_to_timestamp(F.substr(col, F.lit(5)), F.lit(CREATED_AT_FORMAT))
    return F.when(weekday, rest)
