"""First row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key group; NULL keys form one group.

    The rank filter becomes a group limit before the shuffle, so a group that fills a third of the input
    sends one row per input partition. ``order`` has to be total to survive recomputation unchanged.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
