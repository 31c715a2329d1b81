"""Pivot of key/value rows, and unions to a common schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_attributes(
    df: DataFrame, key: str, name: str, value: str, wanted: list[str], condition: Column | None = None
) -> DataFrame:
    """One row per ``key`` with one column per wanted attribute name.

    The names are given, so no job is needed to discover them.  Keys without any wanted
    attribute keep a row of nulls.
    """
    allowed = F.lit(True) if condition is None else condition
    return df.groupBy(key).agg(
        *[F.max(F.when(allowed & (F.col(name) == attribute), F.col(value))).alias(attribute) for attribute in wanted]
    )


def layout(text: str) -> dict[str, str]:
    """Column names and types, in order, from ``a bigint, b string``."""
    return dict(column.split(" ", 1) for column in text.split(", "))


def conform(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select exactly ``columns``; missing ones become typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(data_type).alias(name)
            for name, data_type in columns.items()
        ]
    )


def conform_union(parts: list[DataFrame], columns: dict[str, str]) -> DataFrame:
    """Append all parts under one layout, duplicates kept."""
    result = conform(parts[0], columns)
    for part in parts[1:]:
        result = result.unionByName(conform(part, columns))
    return result


def union_distinct(*parts: DataFrame) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.distinct()
