"""Joins with residual conditions, and lookups that survive skewed keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.session import discard, materialize

# a slice for so many stored bytes, at most so many slices
SLICE_BYTES = 8 << 20
MOST_SLICES = 4


def lookup(left: DataFrame, right: DataFrame, on: dict[str, str], spread_by: str) -> DataFrame:
    """Left outer join that does not send all null keys to one task.

    Null keys never match, but a shuffled outer join would still hash them together.
    Rows with a null key get the hash of ``spread_by`` as spread number, so they reach every
    partition; the right side carries the number 0 only.  ``on`` maps left to right columns; the right key
    columns are dropped.
    """
    empty_left = _any_null([F.col(c) for c in on])
    salted = left.withColumn(
        "__spread", F.when(empty_left, F.xxhash64(spread_by)).otherwise(F.lit(0).cast("long"))
    )
    keyed = right.withColumnsRenamed({r: f"__r_{r}" for r in on.values()})
    # depends on the key so that the optimiser keeps it as a join key; null keys never match anyway
    keyed = keyed.withColumn(
        "__spread_r", F.when(_any_null([F.col(f"__r_{r}") for r in on.values()]), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    )
    condition = [F.col(a) == F.col(f"__r_{b}") for a, b in on.items()]
    condition.append(F.col("__spread") == F.col("__spread_r"))
    return keyed_drop(salted.join(keyed, condition, "left"), list(on.values()))


def keyed_drop(df: DataFrame, right_keys: list[str]) -> DataFrame:
    return df.drop("__spread", "__spread_r", *[f"__r_{r}" for r in right_keys])


def _any_null(columns: list[Column]) -> Column:
    test = columns[0].isNull()
    for column in columns[1:]:
        test = test | column.isNull()
    return test


def member_join(
    left: DataFrame, right: DataFrame, row_id: list[str], on: dict[str, str], members: str, element: str
) -> DataFrame:
    """Inner join on equal keys and ``element`` of the right being in the left array.

    The array is exploded, so membership is part of the equi-join key and no pair of
    rows is formed that does not belong to the result.  Returns ``row_id`` of the left
    and all right columns but the keys.
    """
    exploded = left.select(
        *row_id, *[F.col(a).alias(f"__l_{a}") for a in on], F.explode(F.array_distinct(members)).alias("__member")
    )
    condition = [F.col(f"__l_{a}") == F.col(b) for a, b in on.items()]
    condition.append(F.col("__member") == F.col(element))
    return exploded.join(right, condition, "inner").drop("__member", *[f"__l_{a}" for a in on], *on.values())


def conditional_join(
    left: DataFrame, right: DataFrame, on: dict[str, str], applies: Column, condition: Column, how: str = "inner"
) -> DataFrame:
    """Equi-join with an extra condition that counts only where ``applies`` holds."""
    keys = [F.col(a) == F.col(b) for a, b in on.items()]
    keys.append(F.when(applies, condition).otherwise(F.lit(True)))
    return left.join(right, keys, how)


def full_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with one coalesced key column."""
    renamed = right.withColumnRenamed(key, "__key_r")
    joined = left.join(renamed, F.col(key) == F.col("__key_r"), "full")
    rest = [c for c in left.columns if c != key] + [c for c in right.columns if c != key]
    return joined.select(F.coalesce(F.col(key), F.col("__key_r")).alias(key), *rest)


def routed_join(
    left: DataFrame, right: DataFrame, routes: list[tuple[Column, Column]], columns: list[Column], stored: bool = False
) -> DataFrame:
    """Union of joins, each with its own key and its own part of the right side.

    ``routes`` are (filter on the right, join condition) pairs; equal rows found on
    several routes are merged.  With ``stored`` the routes are joined one after the other.
    """
    parts = [left.join(right.filter(part), condition, "inner").select(*columns) for part, condition in routes]
    if stored:
        return materialize(*parts, compression="zstd").distinct()
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.distinct()


def slices_for(df: DataFrame) -> int:
    """In how many slices of its key a table is joined, by the largest file source it reads; 1 if that is unknown."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = [size for size in sizes if size < 1 << 60]
    return max(1, min(MOST_SLICES, max(known, default=0) // SLICE_BYTES))


def in_slice(key: str, i: int, slices: int) -> Column:
    """Whether a row belongs to slice ``i`` of its key."""
    return F.pmod(F.xxhash64(key), F.lit(slices)) == i


def join_in_slices(left: DataFrame, *rights: tuple[DataFrame, str], on: str, how: str, slices: int, finish=lambda df: df) -> DataFrame:
    """Equi-joins of ``left`` with tables by the same key, in one go or slice after slice of the key.

    ``rights`` are (table, key column) with keys of the type of ``on``; their keys are dropped.  A join in
    one go leaves the shuffle files of all its rows until the query ends.  Slices are stored one by one, so no more
    than those of one slice exist at a time.  Rows are read once a slice; each belongs to
    one, also those without a key.  ``finish`` is applied to the joined rows.  Inputs that are stages of an
    earlier call are removed.
    """

    def part(df: DataFrame, key: str, i: int) -> DataFrame:
        return df if slices == 1 else df.filter(in_slice(key, i, slices))

    def joined(i: int) -> DataFrame:
        def one(rows: DataFrame, right: tuple[DataFrame, str]) -> DataFrame:
            df, key = right
            return rows.join(part(df, key, i), F.col(on) == F.col(key), how).drop(key)

        return finish(reduce(one, rights, part(left, on, i)))

    if slices == 1:
        return joined(0)
    stored = materialize(*[joined(i) for i in range(slices)], compression="zstd")
    discard(*[df for df in (left, *[right for right, _ in rights]) if getattr(df, "sliced", False)])
    stored.sliced = True
    return stored
