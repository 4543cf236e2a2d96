"""One row per key, chosen by a total order so that reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """Keep the first row of each key; by default in order of all other columns.

    Spark plans the rank filter as a group limit before and after the shuffle, so a
    map task sends at most one row per key however many copies of it there are.
    """
    if order is None:
        order = [F.asc_nulls_first(name) for name in df.columns if name not in keys]
    if not order:
        return df.distinct()
    rows = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(rows))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
