"""Accounts, balance dates and due dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.dates import local_date
from duebook.functions.text import attribute, like_any
from duebook.operators.latest import earliest, latest_per_key
from duebook.operators.propagate import propagate
from duebook.operators.updates import update_from

REJECTED_PARENT = "rejectedChargeTransactionId"
PARTIAL_PARENT = "partiallyPaidChargeTransactionId"
MAX_REJECTION_ROUNDS = 6
SETTLED = ["DUE_LETTERED", "DUE_CANCELLED"]
IGNORED = "ignored"


def account_map(billing_account: DataFrame, relationship: DataFrame) -> DataFrame:
    """Child account name to main account name, with the main account's migration flag."""
    main = billing_account.select(
        F.col("ouid").alias("main_ouid"),
        F.col("name").alias("mba"),
        attribute("characteristics", "migrationFlag").alias("migration_flag"),
    )
    child = billing_account.select(F.col("ouid").alias("child_ouid"), F.col("name").alias("cba"))
    return (
        relationship.join(main, F.col("targetbillingaccountouid") == F.col("main_ouid"))
        .join(child, F.col("billingaccountouid") == F.col("child_ouid"))
        .select("mba", "cba", "migration_flag")
    )


def balance_dates(balance: DataFrame) -> DataFrame:
    """Balance and due date per transaction over its DUE balances."""
    settled_on = F.when(F.col("status").isin(SETTLED), local_date("datetimelastmodif"))
    return (
        balance.filter(F.col("status").like("DUE%"))
        .groupBy("transactionid")
        .agg(
            F.coalesce(F.max(local_date("letteringdate")), F.max(settled_on)).alias("balance_date"),
            F.max(local_date("startdatetime")).alias("due_date"),
        )
    )


def original_due_dates(charge: DataFrame, dates: DataFrame) -> DataFrame:
    """Due date of every transaction with a charge that does not reject another one.

    Aggregated before the join: the balance dates are already one row per transaction.
    """
    created = (
        charge.filter(attribute("characteristics", REJECTED_PARENT).isNull())
        .groupBy("transactionid")
        .agg(F.max("datetimecreate").alias("created"))
    )
    due = dates.select("transactionid", "due_date")
    return created.join(due, "transactionid", "left").select(
        F.lit("original").alias("src"),
        "transactionid",
        F.coalesce("due_date", local_date("created")).alias("due_date"),
    )


def reject_edges(charge: DataFrame) -> DataFrame:
    """Distinct (transaction, rejected transaction) pairs."""
    return (
        charge.select("transactionid", attribute("characteristics", REJECTED_PARENT).alias("original_transactionid"))
        .filter(F.col("original_transactionid").isNotNull())
        .distinct()
    )


def propagate_due_dates(originals: DataFrame, edges: DataFrame, max_rounds: int | None = MAX_REJECTION_ROUNDS) -> DataFrame:
    """Rejections inherit the due date of what they reject, also along chains."""
    inherited = propagate(originals, edges, "transactionid", "original_transactionid", "due_date", max_rounds)
    return originals.unionByName(inherited.select(F.lit("rejection").alias("src"), "transactionid", "due_date"))


def override_request_due(due: DataFrame, charge: DataFrame, payment_request: DataFrame) -> DataFrame:
    """Manual consumption transactions take the earliest payment request date."""
    consumption = charge.filter(F.col("glid").like("%_MANUAL_CONSUMPTION")).select("transactionid")
    requested = (
        payment_request.join(consumption, "transactionid", "left_semi")
        .groupBy("transactionid")
        .agg(F.min(local_date("daterequest")).alias("request_due"))
    )
    return update_from(due, requested, {"transactionid": "transactionid"}, {"due_date": "request_due"})


def parent_links(charge: DataFrame) -> DataFrame:
    """Distinct (transactionid, parent, link): the transactions that charges name as rejected or partly paid."""
    named = [F.struct(F.lit(link).alias("link"), attribute("characteristics", link).alias("parent")) for link in (REJECTED_PARENT, PARTIAL_PARENT)]
    rows = charge.filter(F.col("characteristics").isNotNull()).select("transactionid", F.explode(F.array(*named)).alias("named"))
    return rows.select("transactionid", "named.parent", "named.link").filter(F.col("parent").isNotNull()).distinct()


def _parent_dates(due: DataFrame, parents: DataFrame, link: str) -> DataFrame:
    """(transactionid, parent_due) for the parents of one kind."""
    dates = due.select(F.col("transactionid").alias("parent"), F.col("due_date").alias("parent_due")).distinct()
    links = parents.filter(F.col("link") == link).select("transactionid", "parent")
    return links.join(dates, "parent").select("transactionid", "parent_due")


def override_from_parent(due: DataFrame, parents: DataFrame, link: str) -> DataFrame:
    """A charge takes over the due date of the transaction that it pays in part or rejects."""
    return update_from(due, _parent_dates(due, parents, link), {"transactionid": "transactionid"}, {"due_date": "parent_due"})


def override_partial_due(due: DataFrame, charge: DataFrame) -> DataFrame:
    """A charge paying another one in part takes over that one's due date."""
    return override_from_parent(due, parent_links(charge), PARTIAL_PARENT)


def override_rejected_due(due: DataFrame, charge: DataFrame) -> DataFrame:
    """One more step from the rejected parent, whose date may have changed since."""
    return override_from_parent(due, parent_links(charge), REJECTED_PARENT)


def apply_due_to_balance(dates: DataFrame, due: DataFrame) -> DataFrame:
    return update_from(dates, due, {"transactionid": "transactionid"}, {"due_date": "due_date"})


def split_status_transactions(balance: DataFrame) -> DataFrame:
    """Transactions with several DUE statuses; the status list is distinct before it is collected."""
    statuses = balance.filter(F.col("status").like("DUE%")).select("transactionid", "status").distinct()
    return (
        statuses.groupBy("transactionid")
        .agg(
            F.count("status").alias("n"),
            F.array_join(F.sort_array(F.collect_list("status")), ", ").alias("statuses"),
        )
        .filter(F.col("n") > 1)
    )


def charge_balance_dates(balance: DataFrame, split: DataFrame, charge: DataFrame) -> DataFrame:
    """Dates per charge where one transaction holds several statuses."""
    own = F.when(F.col("status").isin(SETTLED), local_date("datetimelastmodif"))
    rows = (
        balance.filter(F.col("status").like("DUE%"))
        .join(split.select("transactionid"), "transactionid", "left_semi")
        .select(
            "status",
            "transactionid",
            "amount",
            "billingaccountouid",
            F.coalesce(local_date("letteringdate"), own).alias("balance_date"),
            local_date("startdatetime").alias("due_date"),
        )
        .distinct()
    )
    keys = charge.select(
        F.col("ouid").alias("charge_ouid"),
        F.col("transactionid").alias("c_transaction"),
        F.col("taxincludedamount").alias("c_amount"),
        F.col("billingaccountouid").alias("c_account"),
    )
    return (
        rows.join(
            keys,
            (F.col("transactionid") == F.col("c_transaction"))
            & (F.col("amount") == F.col("c_amount"))
            & (F.col("billingaccountouid") == F.col("c_account")),
            "left",
        )
        .select("charge_ouid", "status", "transactionid", "balance_date", "due_date")
        .distinct()
    )


def partial_due_on_charge(charge_dates: DataFrame, charge: DataFrame, dates: DataFrame) -> DataFrame:
    """Partly paid parents also set the due date of the per-charge rows."""
    return update_from(
        charge_dates,
        _parent_dates(dates.select("transactionid", "due_date"), parent_links(charge), PARTIAL_PARENT),
        {"transactionid": "transactionid"},
        {"due_date": "parent_due"},
    )


def bonus_refund_dates(charge_dates: DataFrame, charge: DataFrame) -> DataFrame:
    """Append bonus charges, balanced on the days of their refunds.

    Refunds are reduced to distinct days first; every reader of these rows removes
    duplicates anyway.
    """
    kept = charge.filter(F.coalesce("accountingid", F.lit("")) != IGNORED)
    refund = (
        kept.filter(F.col("glid").like("%_MANUAL_BONUS_REFUND"))
        .select("billingaccountouid", "transactionid", "taxincludedamount", local_date("datetimecreate").alias("balance_date"))
        .distinct()
    )
    bonus = kept.filter(F.col("glid").like("%_MANUAL_BONUS"))
    matched = bonus.join(refund, ["billingaccountouid", "transactionid", "taxincludedamount"]).select(
        F.col("ouid").alias("charge_ouid"),
        F.lit("").alias("status"),
        "transactionid",
        "balance_date",
        local_date("datetimecreate").alias("due_date"),
    )
    return charge_dates.unionByName(matched)


def charge_due_dates(charge: DataFrame, note_advice: DataFrame) -> DataFrame:
    """Due dates fixed per charge: bills by their note, bonuses by their creation."""
    note = note_advice.select(
        F.col("ouid").alias("note_ouid"),
        F.coalesce(local_date("paymentduedate"), local_date("datetimecreate")).alias("note_due"),
    )
    bills = (
        charge.filter(like_any("glid", ["%_BILL", "%_BILL_MIGRATION"]))
        .join(note, F.col("settlementnoteadviceouid") == F.col("note_ouid"))
        .groupBy(F.col("ouid").alias("charge_ouid"), "transactionid")
        .agg(F.max("note_due").alias("due_date"))
    )
    bonuses = charge.filter(
        F.col("glid").like("%_MANUAL_BONUS") & ~F.col("analyticaxis").like("%special%")
    ).select(F.col("ouid").alias("charge_ouid"), "transactionid", local_date("datetimecreate").alias("due_date"))
    return bills.unionByName(bonuses)


def migrated_bill_due(payment_request: DataFrame) -> DataFrame:
    """First request of a migrated bill per transaction."""
    first = latest_per_key(
        payment_request.filter(F.col("bpmeventname") == "migrated"),
        ["transactionid"],
        [earliest("datetimelastmodif"), earliest("ouid")],
    )
    return first.select("transactionid", local_date("daterequest").alias("due_date"))
