"""Charges with account, dates, dunning, write-off and taxes.

Join order: everything keyed by the charge first, then note and account, then by the
transaction, so that filling bill ids by transaction afterwards finds the rows already in
place.  Accounts are few next to charges: login, hierarchy and dunning are joined to the
accounts beforehand, which saves three passes over the charges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.amounts import UNITS, charge_sign, sign_or_one, sign_or_zero, units
from duebook.functions.dates import FIRST_DAY_EXCLUDED, after_day, hour_of, local_date
from duebook.functions.text import attribute
from duebook.operators.joins import lookup
from duebook.operators.updates import fill_from, set_where

# Tax categories.
VAT = "VAT"
ENERGY_TAXES = ["gasTax", "electricityTax"]


def account_table(
    billing_account: DataFrame, login: DataFrame, accounts: DataFrame, dunning_rows: DataFrame | None = None
) -> DataFrame:
    """One lookup table per account: login, hierarchy and, if given, dunning state."""
    base = billing_account.select(
        F.col("ouid").alias("account_ouid"),
        F.col("name").alias("account_name"),
        F.col("customerouid").alias("account_customer"),
        attribute("characteristics", "migrationFlag").alias("own_flag"),
    )
    logins = login.select(
        F.col("ouid").alias("login_ouid"), F.col("customerouid").alias("login_customer"), F.col("externalid").alias("customer_id")
    )
    hierarchy = accounts.select(
        F.col("mba").alias("main_name"), "cba", F.col("migration_flag").alias("main_flag")
    )
    table = (
        base.join(logins, F.col("account_customer") == F.col("login_customer"), "left")
        .join(hierarchy, F.col("account_name") == F.col("cba"), "left")
        .select(
            "account_ouid",
            "login_ouid",
            "customer_id",
            F.coalesce("main_name", "account_name").alias("mba"),
            "cba",
            F.coalesce("own_flag", "main_flag").alias("migration_flag"),
        )
    )
    if dunning_rows is None:
        return table
    state = dunning_rows.select(
        F.col("mba").alias("dunned"),
        "dunning_lock_until",
        "dunning_lock_reason",
        "dunning_status",
        "dunning_scenario",
        "dunning_level",
    )
    return table.join(state, F.col("mba") == F.col("dunned"), "left").drop("dunned")


def _due_date() -> Column:
    general = F.coalesce("dd_due", "cb_due", "tx_due", local_date("datetimecreate"))
    by_transaction = F.coalesce("dd2_due", "cb_due", "tx_due", local_date("datetimecreate"))
    return (
        F.when(_fee_with_note(), by_transaction)
        .when(F.col("glid").like("%_CANCELLATION_BALANCE"), F.coalesce("dd_due", "dd2_due"))
        .otherwise(general)
    )


def _fee_with_note() -> Column:
    return F.col("glid").like("%_FEE") & F.col("settlementnoteadviceouid").isNotNull()


def base_charges(
    charge: DataFrame,
    account_rows: DataFrame,
    note_advice: DataFrame,
    charge_due: DataFrame,
    charge_dates: DataFrame,
    dates: DataFrame,
    write_off_rows: DataFrame,
) -> DataFrame:
    """Charge rows with everything known about them.

    ``account_rows`` is an ``account_table`` with dunning.  Due dates of a whole
    transaction are made distinct and attached only to the charges whose own rule asks
    for them, so a large transaction does not multiply.  The result may hold equal rows;
    ``charges`` removes them.
    """
    kept = charge.filter(after_day("datetimelastmodif", FIRST_DAY_EXCLUDED))
    by_charge = charge_due.select(F.col("charge_ouid").alias("dd_ouid"), F.col("due_date").alias("dd_due"))
    by_status = charge_dates.filter(F.col("charge_ouid").isNotNull()).select(
        F.col("charge_ouid").alias("cb_ouid"), F.col("balance_date").alias("cb_balance"), F.col("due_date").alias("cb_due")
    )
    off = write_off_rows.filter(F.col("charge_ouid").isNotNull()).withColumnRenamed("charge_ouid", "off_ouid")
    per_charge = (
        kept.join(by_charge, F.col("ouid") == F.col("dd_ouid"), "left")
        .join(by_status, F.col("ouid") == F.col("cb_ouid"), "left")
        .join(off, F.col("ouid") == F.col("off_ouid"), "left")
    )

    note = note_advice.select(F.col("ouid").alias("note_ouid"), F.col("id").alias("bill_id"))
    with_note = lookup(per_charge, note, {"settlementnoteadviceouid": "note_ouid"}, spread_by="ouid")
    with_account = lookup(
        with_note, account_rows.withColumn("account_key", F.col("account_ouid")), {"billingaccountouid": "account_key"}, "ouid"
    )

    by_transaction = charge_due.select(
        F.col("transactionid").alias("dd2_transaction"), F.col("due_date").alias("dd2_due")
    ).distinct()
    asks = _fee_with_note() | (F.col("glid").like("%_CANCELLATION_BALANCE") & F.col("dd_due").isNull())
    balance = dates.select(
        F.col("transactionid").alias("tx"), F.col("balance_date").alias("tx_balance"), F.col("due_date").alias("tx_due")
    )
    full = with_account.join(
        by_transaction, (F.col("transactionid") == F.col("dd2_transaction")) & asks, "left"
    ).join(balance, F.col("transactionid") == F.col("tx"), "left")
    sign = charge_sign("glid")
    return full.select(
        F.col("ouid").alias("applied_billing_charge_ouid"),
        F.col("account_ouid").alias("billing_account_ouid"),
        "login_ouid",
        "datetimelastmodif",
        "mba",
        "cba",
        "customer_id",
        local_date("datetimecreate").alias("datetimecreate"),
        "transactionid",
        "glid",
        "analyticaxis",
        "aggregateid",
        "accountingid",
        (units("taxexcludedamount") * sign).cast(UNITS).alias("taxexcludedamount"),
        (units("taxincludedamount") * sign).cast(UNITS).alias("taxincludedamount"),
        _due_date().alias("due_date"),
        "bill_id",
        F.when(F.col("cb_ouid").isNotNull(), F.col("cb_balance")).otherwise(F.col("tx_balance")).alias("balance_date"),
        "write_off_date",
        "write_off_reason",
        "write_off_note",
        "dunning_lock_until",
        "dunning_lock_reason",
        "dunning_status",
        "dunning_scenario",
        "dunning_level",
        "migration_flag",
        F.lit(True).alias("can_be_due"),
    )


def can_be_due(rows: DataFrame) -> DataFrame:
    """Special bonuses and cancellations are never due."""
    special = F.col("glid").like("%MANUAL_BONUS") & F.col("analyticaxis").like("%special%")
    rows = set_where(rows, special, {"can_be_due": F.lit(False)})
    return set_where(rows, F.col("analyticaxis").like("%cancellation%"), {"can_be_due": F.lit(False)})


def found_bills(charge: DataFrame, product: DataFrame) -> DataFrame:
    """(found_tx, found_bill) of manual consumption, found by the product ordered in the same hour."""
    billed = product.select(
        F.col("billingaccountouid").alias("p_account"),
        F.col("name").alias("p_name"),
        F.col("startdatetime").alias("p_start"),
        F.col("enddatetime").alias("p_end"),
        hour_of("orderdate").alias("p_hour"),
        attribute("characteristics", "billId").alias("found_bill"),
    ).filter(F.col("found_bill").isNotNull())
    consumption = charge.filter(F.col("glid").like("%_MANUAL_CONSUMPTION")).select(
        "transactionid", "billingaccountouid", "productname", "startdatetime", "enddatetime", hour_of("datetimecreate").alias("hour")
    )
    return (
        consumption.distinct()
        .join(
            billed.distinct(),
            (F.col("billingaccountouid") == F.col("p_account"))
            & (F.col("productname") == F.col("p_name"))
            & (F.col("startdatetime") == F.col("p_start"))
            & (F.col("enddatetime") == F.col("p_end"))
            & (F.col("hour") == F.col("p_hour")),
        )
        .select(F.col("transactionid").alias("found_tx"), "found_bill")
    )


def fill_bill_id(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Missing bill ids from ``found_bills``."""
    return fill_from(rows, found, {"transactionid": "found_tx"}, {"bill_id": "found_bill"})


def aggregate_signs(tax_rate: DataFrame, charge: DataFrame) -> DataFrame:
    """Signs of the VAT, gross and net totals per aggregate.

    A charge counts once per VAT row.  VAT rows are added up per charge first, so the
    join carries one row per charge.
    """
    vat = (
        tax_rate.filter(F.col("taxcategory") == VAT)
        .groupBy(F.col("appliedbillingchargeouid").alias("vat_ouid"))
        .agg(F.sum("amount").alias("vat"), F.count(F.lit(1)).alias("vat_rows"))
    )
    aggregated = charge.filter(F.coalesce("aggregateid", F.lit("")) != "").select(
        "ouid", "aggregateid", "taxincludedamount", "taxexcludedamount", charge_sign("glid").alias("sign")
    )
    factor = F.col("sign") * F.col("vat_rows")
    return (
        vat.join(aggregated, F.col("vat_ouid") == F.col("ouid"))
        .groupBy("aggregateid")
        .agg(
            sign_or_one(F.sum("vat")).alias("total_sign"),
            sign_or_one(F.sum(F.col("taxincludedamount") * factor)).alias("total_sign_taxincludedamount"),
            sign_or_one(F.sum(F.col("taxexcludedamount") * factor)).alias("total_sign_taxexcludedamount"),
        )
    )


def charge_taxes(tax_rate: DataFrame) -> DataFrame:
    """VAT and energy tax per charge."""
    amount = units("amount")
    return (
        tax_rate.filter(F.col("taxcategory").isin(VAT, *ENERGY_TAXES))
        .groupBy("appliedbillingchargeouid")
        .agg(
            F.sum(F.when(F.col("taxcategory") == VAT, amount)).cast(UNITS).alias("taxamount"),
            F.sum(F.when(F.col("taxcategory").isin(ENERGY_TAXES), amount)).cast(UNITS).alias("energytaxamount"),
        )
    )


def charges(rows: DataFrame, taxes: DataFrame, signs: DataFrame) -> DataFrame:
    """Charges that have taxes, with the signs of their aggregate.

    The join by charge comes last: rows are then already placed by charge and removing
    duplicates needs no further exchange.
    """
    sign_rows = signs.select(
        F.col("aggregateid").alias("sign_aggregate"),
        F.col("total_sign").alias("tax_total_aggregate_sign"),
        "total_sign_taxincludedamount",
        "total_sign_taxexcludedamount",
    )
    signed = lookup(rows, sign_rows, {"aggregateid": "sign_aggregate"}, spread_by="applied_billing_charge_ouid")
    return signed.join(
        taxes, F.col("applied_billing_charge_ouid") == F.col("appliedbillingchargeouid")
    ).distinct()


def tax_amounts_per_aggregate(
    charge_aggregate: DataFrame, tax_aggregate: DataFrame, charge: DataFrame, tax_rate: DataFrame
) -> DataFrame:
    """Tax rows of charges linked to the tax aggregate of the same rate and category."""
    aggregates = _aggregate_taxes(charge_aggregate, tax_aggregate).filter(
        F.col("ta_category").isin(VAT, *ENERGY_TAXES)
    )
    rows = _charge_tax_rows(charge, tax_rate).filter(F.col("amount").isNotNull())
    return (
        rows.join(aggregates, _same_tax())
        .select(
            units("amount").alias("amount"),
            "tax_ouid",
            "charge_ouid",
            "tax_aggregate_ouid",
            "taxrate",
            units("ta_amount").alias("tax_aggregate_amount"),
            sign_or_zero("ta_amount").alias("tax_total_sign_via_tax_aggregate"),
            "taxcategory",
        )
        .distinct()
    )


def charge_tax_link(
    charge: DataFrame, charge_aggregate: DataFrame, tax_aggregate: DataFrame, tax_rate: DataFrame
) -> DataFrame:
    """Distinct (tax aggregate, charge) pairs joined by a VAT row of equal rate."""
    aggregates = _aggregate_taxes(charge_aggregate, tax_aggregate).filter(F.col("ta_category") == VAT)
    rows = _charge_tax_rows(charge, tax_rate)
    return rows.join(aggregates, _same_tax()).select("tax_aggregate_ouid", "charge_ouid").distinct()


def _aggregate_taxes(charge_aggregate: DataFrame, tax_aggregate: DataFrame) -> DataFrame:
    heads = charge_aggregate.select(F.col("ouid").alias("head_ouid"), F.col("aggregateid").alias("head_aggregate"))
    return tax_aggregate.join(heads, F.col("chargeaggregateouid") == F.col("head_ouid")).select(
        "head_aggregate",
        F.col("ouid").alias("tax_aggregate_ouid"),
        F.col("taxcategory").alias("ta_category"),
        F.col("taxrate").alias("ta_rate"),
        F.col("amount").alias("ta_amount"),
    )


def _charge_tax_rows(charge: DataFrame, tax_rate: DataFrame) -> DataFrame:
    keys = charge.filter(F.col("aggregateid").isNotNull()).select(F.col("ouid").alias("charge_ouid"), "aggregateid")
    return tax_rate.join(keys, F.col("appliedbillingchargeouid") == F.col("charge_ouid")).select(
        "charge_ouid", "aggregateid", F.col("ouid").alias("tax_ouid"), "taxcategory", "taxrate", "amount"
    )


def _same_tax() -> Column:
    return (
        (F.col("aggregateid") == F.col("head_aggregate"))
        & (F.col("taxrate") == F.col("ta_rate"))
        & (F.col("taxcategory") == F.col("ta_category"))
    )
