"""Top-k rows, over all rows or per group."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.checkpoints import use_checkpoint_dir

_SPREAD = 256


def with_global_place(df: DataFrame, order: Sequence[Column], name: str = "place") -> DataFrame:
    """Every row with its place, from 1, in an order over all rows; ties come in any order.

    The rows are sorted by ranges, so no task sees more than its range. A row's place is its
    place there after the rows of the ranges before; only the ranges' sizes, a number per task, pass
    through the driver. The sorted rows are checkpointed, so that both steps see the same ranges.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    row = F.monotonically_increasing_id()
    part, inside = F.shiftright(row, 33).alias("__part"), row.bitwiseAND((1 << 33) - 1)
    rows = df.orderBy(*order).select("*", part, inside.alias("__inside")).checkpoint()
    sizes = sorted(tuple(size) for size in rows.groupBy("__part").agg(F.count("*")).collect())
    before = list(accumulate((n for _, n in sizes), initial=0))
    starts = [(part, start) for (part, _), start in zip(sizes, before)]
    starts = spark.createDataFrame(starts, "__part long, __before long")
    place = (F.col("__before") + F.col("__inside") + 1).alias(name)
    return rows.join(starts, "__part").select(*df.columns, place)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``: each task keeps k rows, no global sort."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, spread_by: str
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, with their ``rank``.

    Each group is first ranked in slices, by hash of ``spread_by``: the best k of the slices'
    best k are the best k of the group. So no task ranks a whole group, nor k rows from every
    other task.
    """
    slices = [*by, F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD))]
    best = _first_ranks(df, slices, order, k).drop("rank")
    return _first_ranks(best, by, order, k)


def _first_ranks(df: DataFrame, by: Sequence, order: Sequence[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
