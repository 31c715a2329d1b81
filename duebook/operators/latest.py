"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def newest(name: str) -> Column:
    """Descending with nulls first, the order in which the sources see "newest"."""
    return F.col(name).desc_nulls_first()


def earliest(name: str) -> Column:
    """Ascending with nulls last."""
    return F.col(name).asc_nulls_last()


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    ``row_number() = 1`` lets Spark place a group limit before the shuffle: each map
    task sends at most one row per key, so a key holding a third of the table is no
    more work than any other.  ``order`` must be total for a reproducible result.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
