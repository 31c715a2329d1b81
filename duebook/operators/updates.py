"""Table mutations as pure transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "__hit"


def _one_per_key(source: DataFrame, keys: dict[str, str], values: list[str]) -> DataFrame:
    """Reduce ``source`` to one row per key: smallest values, nulls last.

    A min over a struct is an ordinary partial aggregate, so hot keys shrink before
    the shuffle.
    """
    wanted = source.select(
        *[F.col(s).alias(f"__k_{t}") for t, s in keys.items()], *[F.col(v).alias(f"__v_{v}") for v in values]
    )
    ranked = F.struct(*[part for v in values for part in (F.isnull(f"__v_{v}").alias(f"n_{v}"), F.col(f"__v_{v}"))])
    best = wanted.groupBy(*[f"__k_{t}" for t in keys]).agg(F.min(ranked).alias("__best"))
    return best.select(
        *[f"__k_{t}" for t in keys], *[F.col(f"__best.__v_{v}").alias(f"__v_{v}") for v in values], F.lit(True).alias(_HIT)
    )


def update_from(
    target: DataFrame, source: DataFrame, keys: dict[str, str], values: dict[str, str], only_if: Column | None = None
) -> DataFrame:
    """``UPDATE target SET values FROM source WHERE keys``.

    ``keys`` and ``values`` map target columns to source columns.  A match overwrites
    even with null; rows without a match stay as they are.  Several source rows for one
    key are reduced to the smallest values, nulls last.
    """
    picked = _one_per_key(source, keys, list(dict.fromkeys(values.values())))
    condition = [F.col(t) == F.col(f"__k_{t}") for t in keys]
    joined = target.join(picked, condition, "left")
    hit = F.coalesce(F.col(_HIT), F.lit(False))
    if only_if is not None:
        hit = hit & F.coalesce(only_if, F.lit(False))
    return joined.select(
        *[
            F.when(hit, F.col(f"__v_{values[c]}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            if c in values
            else F.col(c)
            for c in target.columns
        ]
    )


def fill_from(target: DataFrame, source: DataFrame, keys: dict[str, str], values: dict[str, str]) -> DataFrame:
    """Like ``update_from``, but only where the target column is null."""
    picked = _one_per_key(source, keys, list(dict.fromkeys(values.values())))
    joined = target.join(picked, [F.col(t) == F.col(f"__k_{t}") for t in keys], "left")
    return joined.select(
        *[
            F.coalesce(F.col(c), F.col(f"__v_{values[c]}")).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def set_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """``UPDATE df SET values WHERE condition``; a null condition changes nothing."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE FROM df WHERE condition``; a null condition deletes nothing."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def _keyed(df: DataFrame, keys: dict[str, str]) -> tuple[DataFrame, list[Column]]:
    right = df.select(*[F.col(s).alias(f"__k_{t}") for t, s in keys.items()])
    return right, [F.col(t) == F.col(f"__k_{t}") for t in keys]


def delete_using(df: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other`` (null keys stay)."""
    right, condition = _keyed(other, keys)
    return df.join(right, condition, "left_anti")


def keep_using(df: DataFrame, other: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    right, condition = _keyed(other, keys)
    return df.join(right, condition, "left_semi")


def replace_by_key(current: DataFrame, affected: DataFrame, fresh: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Drop the affected keys from ``current`` and append the recomputed rows."""
    return delete_using(current, affected, keys).unionByName(fresh.select(*current.columns))
