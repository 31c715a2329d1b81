"""Text helpers that keep the null rules of the source systems."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def concat_skipping_nulls(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(_col(value).cast("string"), F.lit(""))


def attribute(document: Column | str, key: str) -> Column:
    """One text attribute of a JSON column; absent and null both give null."""
    return F.get_json_object(_col(document), f"$.{key}")


def like_any(value: Column | str, patterns: list[str]) -> Column:
    value = _col(value)
    return reduce(lambda a, b: a | b, [value.like(p) for p in patterns])


def safe_id(text: Column | str) -> Column:
    """A numeric id from text, null where the text is not one."""
    return _col(text).try_cast("bigint")


def comma_list(text: Column | str) -> Column:
    """Elements of ``a,b,c``; an empty text has none."""
    text = _col(text)
    return F.when(F.length(text) > 0, F.split(text, ",", -1))
