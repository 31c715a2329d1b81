"""Incremental reload: find what changed, recompute only that, replace it.

The state of the last run is either its tables, which ``signed_changes`` compares with the
present ones (additions, changes and removals), or fingerprints and times, which find
additions and changes only.  ``plans.incremental_list`` carries the changes on to the list.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.amounts import UNITS, units
from duebook.functions.dates import FIRST_DAY_EXCLUDED, after_day, local_date
from duebook.functions.fingerprint import row_fingerprint
from duebook.operators.joins import lookup
from duebook.operators.updates import delete_using, keep_using, replace_by_key
from duebook.plans.bookings import json_bookings, json_headers, json_raw_segments, json_segments
from duebook.plans.charges import ENERGY_TAXES, VAT
from duebook.session import materialize
from duebook.sources.documents import parse_documents, without_malformed


def fingerprints(df: DataFrame, keys: list[str], *columns: str | Column) -> DataFrame:
    """Key columns and the fingerprint of the given columns."""
    return df.select(*keys, row_fingerprint(*columns).alias("hash"))


def changed_keys(current: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose fingerprint is new since the snapshot."""
    same = {c: c for c in [*keys, "hash"]}
    return delete_using(current, snapshot, same).select(*keys).distinct()


def removed_keys(current: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    return delete_using(snapshot, current, {k: k for k in keys}).select(*keys).distinct()


def signed_changes(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(keys, change) of every key whose rows differ: ``added``, ``changed`` or ``removed``.

    The rows of a key are compared as a multiset by the sums of two hashes of ``columns`` (all others
    by default).  Both tables go through one partial aggregate, so a hot key
    shrinks before the shuffle, and null keys are compared like any other.
    """
    compared = columns if columns is not None else [c for c in after.columns if c not in keys]
    # a hash skips nulls, hence the marks
    values = [part for c in compared for part in (F.isnull(c), F.col(c))]

    def side(df: DataFrame, sign: int) -> DataFrame:
        hashes = [F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)") * sign for seed in (1, 2)]
        return df.select(*keys, F.lit(sign).alias("__sign"), hashes[0].alias("__h1"), hashes[1].alias("__h2"))

    both = side(before, -1).unionByName(side(after, 1)).groupBy(*keys).agg(
        F.count_if(F.col("__sign") < 0).alias("__before"),
        F.count_if(F.col("__sign") > 0).alias("__after"),
        F.sum("__h1").alias("__d1"),
        F.sum("__h2").alias("__d2"),
    )
    differs = (F.col("__before") != F.col("__after")) | (F.col("__d1") != 0) | (F.col("__d2") != 0)
    kind = F.when(F.col("__before") == 0, "added").when(F.col("__after") == 0, "removed").otherwise("changed")
    return both.filter(differs).select(*keys, kind.alias("change"))


def changed_rows(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Rows of ``current`` beyond those of the snapshot, counted with multiplicity."""
    return current.exceptAll(snapshot.select(*current.columns))


def changed_since(current: DataFrame, snapshot: DataFrame, modified: str) -> DataFrame:
    """Rows modified after the newest row of the snapshot; all of them without one."""
    newest = snapshot.agg(F.max(modified)).scalar()
    return current.filter(newest.isNull() | (F.col(modified) > newest))


def advance_snapshot(snapshot: DataFrame, changed: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot with the changed keys brought up to date; a key without present rows leaves.

    Store it under a new path.
    """
    mapping = {k: k for k in keys}
    return replace_by_key(snapshot, changed, keep_using(current, changed, mapping), mapping)


# What the extract reads of each source: the key of a change, and the columns that matter.
EXTRACT_INPUTS = {
    "applied_billing_charge": (["ouid"], None),
    "billing_account": (["ouid"], ["name", "customerouid"]),
    "login": (["customerouid"], ["ouid", "externalid"]),
    "applied_billing_tax_rate": (["appliedbillingchargeouid"], ["taxcategory", "amount"]),
    "payment_request": (["transactionid"], ["daterequest"]),
    "settlement_note_advice": (["ouid"], ["id"]),
}


def extract_changes(before, after) -> dict[str, DataFrame]:
    """Signed changes of every source of the extract between two vaults."""
    return {name: signed_changes(before[name], after[name], keys, columns) for name, (keys, columns) in EXTRACT_INPUTS.items()}


def affected_charges(vault, changes: Mapping[str, DataFrame]) -> DataFrame:
    """Charges touched by changes of any source, as distinct (ouid), removed charges included.

    ``changes`` holds key columns as in ``EXTRACT_INPUTS``.  A source row reaches the charges that refer
    to it now; a charge that referred to it before and no longer does has changed itself.
    """
    charge = vault["applied_billing_charge"]
    found: list[DataFrame] = []

    def referring(changed: DataFrame, column: str, key: str) -> None:
        found.append(keep_using(charge, changed, {column: key}).select("ouid"))

    for name, changed in changes.items():
        if name == "applied_billing_charge":
            found.append(changed.select("ouid"))
        elif name == "applied_billing_tax_rate":
            found.append(changed.select(F.col("appliedbillingchargeouid").alias("ouid")))
        elif name == "billing_account":
            referring(changed, "billingaccountouid", "ouid")
        elif name == "login":
            accounts = keep_using(vault["billing_account"], changed, {"customerouid": "customerouid"})
            referring(accounts, "billingaccountouid", "ouid")
        elif name == "payment_request":
            referring(changed, "transactionid", "transactionid")
        elif name == "settlement_note_advice":
            referring(changed, "settlementnoteadviceouid", "ouid")
        else:
            raise ValueError(f"{name} is no source of the extract")
    if not found:
        return charge.select("ouid").filter(F.lit(False))
    return reduce(lambda a, b: a.unionByName(b), found).filter(F.col("ouid").isNotNull()).distinct()


def charge_extract(vault, affected: DataFrame | None = None) -> DataFrame:
    """Charges with unsigned amounts and taxes, of all or only of the affected charges."""
    charge = vault["applied_billing_charge"]
    tax = vault["applied_billing_tax_rate"].filter(F.col("taxcategory").isin(VAT, *ENERGY_TAXES))
    if affected is not None:
        charge = keep_using(charge, affected, {"ouid": "ouid"})
        tax = keep_using(tax, affected, {"appliedbillingchargeouid": "ouid"})
    size = F.abs(units("amount"))
    taxes = tax.groupBy(F.col("appliedbillingchargeouid").alias("tax_charge")).agg(
        F.sum(F.when(F.col("taxcategory") == VAT, size)).cast(UNITS).alias("taxamount"),
        F.sum(F.when(F.col("taxcategory").isin(ENERGY_TAXES), size)).cast(UNITS).alias("energytaxamount"),
    )
    accounts = vault["billing_account"].select(
        F.col("ouid").alias("billing_account_ouid"), F.col("name").alias("billing_account"), F.col("customerouid").alias("customer")
    )
    logins = vault["login"].select(
        F.col("ouid").alias("login_ouid"), F.col("customerouid").alias("login_customer"), F.col("externalid").alias("customer_id")
    )
    account_rows = (
        accounts.join(logins, F.col("customer") == F.col("login_customer"), "left")
        .drop("customer", "login_customer")
        .withColumn("account_key", F.col("billing_account_ouid"))
    )
    requests = vault["payment_request"].select(F.col("transactionid").alias("request_tx"), "daterequest")
    notes = vault["settlement_note_advice"].select(F.col("ouid").alias("note_ouid"), F.col("id").alias("bill_id"))
    kept = charge.filter(after_day("datetimecreate", FIRST_DAY_EXCLUDED))
    joined = kept.join(taxes, F.col("ouid") == F.col("tax_charge"), "left").join(
        requests, F.col("transactionid") == F.col("request_tx"), "left"
    )
    joined = lookup(joined, notes, {"settlementnoteadviceouid": "note_ouid"}, spread_by="ouid")
    joined = lookup(joined, account_rows, {"billingaccountouid": "account_key"}, spread_by="ouid")
    return joined.select(
        F.col("ouid").alias("applied_billing_charge_ouid"),
        "billing_account_ouid",
        "login_ouid",
        "datetimelastmodif",
        "billing_account",
        "customer_id",
        local_date("datetimecreate").alias("datetimecreate"),
        "transactionid",
        "glid",
        "analyticaxis",
        "aggregateid",
        "accountingid",
        F.abs(units("taxexcludedamount")).cast(UNITS).alias("taxexcludedamount"),
        F.abs(units("taxincludedamount")).cast(UNITS).alias("taxincludedamount"),
        local_date(F.coalesce("daterequest", "datetimecreate")).alias("due_date"),
        "bill_id",
        "taxamount",
        "energytaxamount",
    )


def reload_charges(previous: DataFrame, vault, affected: DataFrame) -> DataFrame:
    """The extract with the affected charges recomputed."""
    return replace_by_key(
        previous, affected, charge_extract(vault, affected), {"applied_billing_charge_ouid": "ouid"}
    )


# --- bookings of changed documents ----------------------------------------------


def document_fingerprints(booking_runs: DataFrame) -> DataFrame:
    """Fingerprint of document and deletion mark per run."""
    return fingerprints(booking_runs, ["id"], "summary", "deleted")


def run_bookings(booking_runs: DataFrame) -> DataFrame:
    """Bookings with the run they came from, also where a segment has no header."""
    # parsed once, read by segments, headers and raw segments
    documents = without_malformed(materialize(parse_documents(booking_runs)))
    return json_bookings(
        json_segments(documents), json_headers(documents), json_raw_segments(documents), source_run="source_run"
    )


def reload_bookings(previous: DataFrame, booking_runs: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Bookings with those of new, changed and removed runs replaced."""
    current = document_fingerprints(booking_runs)
    changed = changed_keys(current, snapshot, ["id"])
    affected = changed.unionByName(removed_keys(current, snapshot, ["id"]))
    fresh = run_bookings(keep_using(booking_runs, changed, {"id": "id"}))
    return replace_by_key(previous, affected, fresh, {"source_run": "id"})
