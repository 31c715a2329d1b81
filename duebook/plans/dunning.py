"""Dunning state per main account."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.dates import NO_END, day, utc_date
from duebook.operators.joins import full_merge
from duebook.operators.latest import earliest, latest_per_key, newest
from duebook.operators.updates import delete_where

# Case statuses that count as dunning.
DUNNING_STATUSES = ["DUNNING", "BLOCKING", "INKASSO"]


def latest_case(case_receivables: DataFrame) -> DataFrame:
    """Newest receivables case per account.

    Lock rows of the account could only order cases of the same instant, and all cases
    of an account see the same lock rows, so they are not joined.
    """
    picked = latest_per_key(case_receivables, ["mba"], [newest("created_at"), earliest("id")])
    return picked.select("id", "created_at", "mba", "status")


def active_locks(dunning_locks: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest lock per account, dropped afterwards if it is deleted or over."""
    locks = dunning_locks.select(
        "mba",
        F.coalesce(utc_date("expires_at"), day(NO_END)).alias("dunning_lock_until"),
        F.col("reason").alias("dunning_lock_reason"),
        "deleted",
        "created_at",
        "updated_at",
    )
    newest_lock = latest_per_key(
        locks,
        ["mba"],
        [newest("created_at"), newest("updated_at"), earliest("dunning_lock_until"), earliest("dunning_lock_reason")],
    )
    kept = delete_where(newest_lock, F.col("deleted"))
    return delete_where(kept, F.col("dunning_lock_until") < F.lit(as_of)).drop("created_at", "updated_at")


def case_lock_merge(cases: DataFrame, locks: DataFrame) -> DataFrame:
    """Accounts with a case, a lock, or both."""
    return full_merge(cases, locks.drop("deleted"), "mba").select(
        "mba", "id", "created_at", "status", "dunning_lock_until", "dunning_lock_reason"
    )


def dunning_state(merged: DataFrame, dunning_claims: DataFrame, claims: DataFrame) -> DataFrame:
    """One row per account with level, scenario and status.

    The newest row wins; among claims of one case the highest level does.
    """
    case_claims = dunning_claims.join(
        claims.select(F.col("id").alias("dunning_claim_id"), F.col("status").alias("claim_status")),
        "dunning_claim_id",
        "left",
    ).select(
        F.col("case_receivable_id").alias("case_id"),
        "dunning_level",
        F.col("scenario").alias("dunning_scenario"),
        "claim_status",
    )
    joined = merged.join(case_claims, F.col("id") == F.col("case_id"), "left")
    picked = latest_per_key(
        joined,
        ["mba"],
        [
            newest("created_at"),
            F.col("dunning_level").desc_nulls_last(),
            earliest("dunning_scenario"),
            earliest("claim_status"),
        ],
    )
    return picked.select(
        "mba",
        "dunning_level",
        "dunning_scenario",
        F.col("claim_status").alias("status"),
        F.when(F.col("status").isin(DUNNING_STATUSES), F.col("status")).alias("dunning_status"),
        "dunning_lock_until",
        "dunning_lock_reason",
        F.lit(1).cast("bigint").alias("rnk"),
    )


SOURCES = ["case_receivables", "dunning_claims", "dunning_locks", "claims"]


def dunning(vault, as_of: dt.date) -> DataFrame:
    """Dunning state; empty where a dunning source is missing or there is no case at all."""
    cases = latest_case(vault.optional("case_receivables"))
    locks = active_locks(vault.optional("dunning_locks"), as_of)
    merged = case_lock_merge(cases, locks)
    if not all(vault.has(table) for table in SOURCES) or vault["case_receivables"].isEmpty():
        merged = merged.filter(F.lit(False))
    return dunning_state(merged, vault.optional("dunning_claims"), vault.optional("claims"))
