"""Ledger bookings, from JSON booking runs or from journal tables.

Both adapters deliver the same three tables: bookings, tax bookings and document
headers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.amounts import german_decimal
from duebook.functions.dates import german_date, local_date
from duebook.functions.text import safe_id
from duebook.operators.joins import join_in_slices, member_join, slices_for
from duebook.operators.shape import conform, layout, pivot_attributes
from duebook.session import materialize
from duebook.sources.documents import SEGMENT_FIELDS, explode_documents, parse_documents, without_malformed
from duebook.sources.lookups import ClientLookups

BOOKING_COLUMNS = layout(
    "booking_execution_id bigint, booking_created date, booking_src string, key string, ba string, budat date,"
    " bukrs string, beldat date, aufnr string, gsber string, kostl string, mwskz string, newbk string, newbs string,"
    " newko string, mwskz2 string, prced string, sgtxt string, vbund string, wrbed_total string,"
    " wrbed_aggregate string, xblnr string, xstba string, zterm string, zuonr string, psegment string,"
    " aggregate_id string, amount_calculation string, tax_aggregate_ouid bigint"
)
TAX_BOOKING_COLUMNS = layout(
    "bbtax_booking_execution_id bigint, bbtax_booking_created date, key string, aufnr string, gsber string,"
    " kostl string, mwskz string, newbk string, newbs string, newko string, prced string, sgtxt string, vbund string,"
    " xblnr string, xstba string, zterm string, zuonr string, psegment string, wrbed string, fwbas string,"
    " aggregate_id string, amount_calculation string"
)
HEADER_COLUMNS = layout(
    "ba string, budat date, bukrs string, xbelnr string, beldat date, booking_execution_id bigint, booking_created date"
)

NOT_SET = "/"
DEBIT_KEY, CREDIT_KEY = "40", "50"
JOURNAL_RUN = -1
# Metadata types that carry ledger attributes.
METADATA_TYPES = ["rfbibl", "schleupen"]


@dataclass(frozen=True)
class Ledger:
    bookings: DataFrame
    tax_bookings: DataFrame
    headers: DataFrame


# --- booking run documents -------------------------------------------------------


def json_segments(documents: DataFrame) -> DataFrame:
    """Ledger segments with their list of aggregate ids; (run, position) identifies a row."""
    return explode_documents(documents, "bbseg", position=True).select(
        F.col("booking_execution_id").alias("bseg_booking_execution_id"),
        local_date("booking_created").alias("bseg_booking_created"),
        "position",
        *SEGMENT_FIELDS,
        F.col("relatedAggregateIds").alias("related_aggregate_ids"),
    )


def json_headers(documents: DataFrame) -> DataFrame:
    rows = explode_documents(documents, "bbkpf")
    return rows.select(
        "ba",
        german_date("budat").alias("budat"),
        "bukrs",
        F.col("xblnr").alias("xbelnr"),
        german_date("beldat").alias("beldat"),
        "booking_execution_id",
        local_date("booking_created").alias("booking_created"),
    )


def json_raw_segments(documents: DataFrame) -> DataFrame:
    rows = explode_documents(documents, "rawSegments")
    return rows.select(
        "wrbed",
        F.col("xblnr").alias("xbelnr"),
        "newbs",
        "newko",
        F.col("mwskz").alias("mwskz2"),
        F.col("amountCalculation").alias("amount_calculation"),
        F.col("relatedAggregateId").alias("aggregate_id"),
        "booking_execution_id",
    )


def json_tax_bookings(
    documents: DataFrame, vat_accounts: DataFrame, tax_aggregate: DataFrame, charge_aggregate: DataFrame
) -> DataFrame:
    """Tax rows with VAT account and the aggregate behind their tax aggregate id.

    ``vat_accounts`` is a client lookup, limited to a few rows when it is loaded.
    """
    rows = explode_documents(documents, "bbtax").withColumn(
        "ta_key", safe_id(F.coalesce("taxAggregateOuid", F.lit("-1")))
    )
    aggregates = tax_aggregate.join(
        charge_aggregate.withColumnsRenamed({"ouid": "ca_ouid"}), F.col("chargeaggregateouid") == F.col("ca_ouid"), "left"
    ).select(F.col("ouid").alias("ta_ouid"), F.col("aggregateid").alias("aggregate_id"))
    accounts = vat_accounts.withColumnRenamed("mwskz", "code")
    joined = rows.join(accounts, F.col("mwskz") == F.col("code"), "left").join(
        aggregates, F.col("ta_key") == F.col("ta_ouid"), "left"
    )
    return _tax_rows(
        joined,
        run=F.col("booking_execution_id"),
        created=local_date("booking_created"),
        mwskz=F.col("mwskz"),
        newbs=F.col("bs"),
        xblnr=F.col("xblnr"),
        wrbed=F.col("fwste"),
        fwbas=F.col("fwbas"),
        indicator=F.lit("vat.Amount"),
    )


def json_bookings(
    segments: DataFrame, headers: DataFrame, raw_segments: DataFrame, source_run: str | None = None
) -> DataFrame:
    """Segments with their header and the raw segments of the aggregates they list.

    Raw segments are found with the aggregate id as part of the join key, then attached
    to the segment they belong to.  Segments without any stay once.  ``source_run`` names
    an extra column with the run, which is also set where a segment has no header.
    """
    row_id = ["bseg_booking_execution_id", "position"]
    raw = raw_segments.select(
        F.col("booking_execution_id").alias("raw_run"),
        F.col("xbelnr").alias("raw_xblnr"),
        F.col("newko").alias("raw_newko"),
        F.col("newbs").alias("raw_newbs"),
        "mwskz2",
        F.col("wrbed").alias("wrbed_aggregate"),
        "aggregate_id",
        "amount_calculation",
    )
    hits = member_join(
        segments,
        raw,
        row_id,
        {"bseg_booking_execution_id": "raw_run", "xblnr": "raw_xblnr", "newko": "raw_newko", "newbs": "raw_newbs"},
        "related_aggregate_ids",
        "aggregate_id",
    ).withColumnsRenamed({"bseg_booking_execution_id": "hit_run", "position": "hit_position"})
    joined = segments.join(
        headers,
        (F.col("xblnr") == F.col("xbelnr")) & (F.col("bseg_booking_execution_id") == F.col("booking_execution_id")),
        "left",
    ).join(
        hits,
        (F.col("bseg_booking_execution_id") == F.col("hit_run"))
        & (F.col("position") == F.col("hit_position"))
        & F.col("xbelnr").isNotNull(),
        "left",
    )
    renamed = joined.withColumnRenamed("wrbed", "wrbed_total").withColumn("booking_src", F.lit("bbseg"))
    if source_run is None:
        return conform(renamed, BOOKING_COLUMNS)
    renamed = renamed.withColumn(source_run, F.col("bseg_booking_execution_id"))
    return conform(renamed, BOOKING_COLUMNS | {source_run: "bigint"})


def ledger_from_documents(vault, lookups: ClientLookups, documents: DataFrame | None = None) -> Ledger:
    """Ledger tables of the booking runs; pass staged ``documents`` to parse only once."""
    if documents is None:
        documents = without_malformed(materialize(parse_documents(vault["booking_runs"])))
    headers = json_headers(documents)
    return Ledger(
        json_bookings(json_segments(documents), headers, json_raw_segments(documents)),
        json_tax_bookings(
            documents, lookups.vat_accounts_df(vault.spark), vault["tax_aggregate"], vault["charge_aggregate"]
        ),
        headers,
    )


# --- journal tables --------------------------------------------------------------


def account_metadata(metadata: DataFrame) -> DataFrame:
    """Ledger attributes of a journal item from its key/value rows."""
    return pivot_attributes(
        metadata, "journal_entry_items_uuid", "key", "value", ["gsber", "aufnr", "mwskz"], F.col("type").isin(METADATA_TYPES)
    )


def _exported_entries(summaries: DataFrame, journal_entries: DataFrame) -> DataFrame:
    exported = summaries.filter(F.coalesce("export", F.lit(False))).select(
        F.col("uuid").alias("summary"),
        F.least(local_date("file_created_at"), local_date("create_time")).alias("booking_created"),
        local_date("create_time").alias("beldat"),
    )
    entries = journal_entries.select(
        F.col("uuid").alias("entry"), "summaries_uuid", F.col("id").alias("xblnr"), F.col("date").alias("budat")
    )
    return entries.join(exported, F.col("summaries_uuid") == F.col("summary"))


def _items(vault) -> DataFrame:
    items = vault["journal_entry_items"].select(
        F.col("uuid").alias("item"), "journal_entries_uuid", F.col("amount").alias("item_amount"), "account"
    )
    entries = _exported_entries(vault["summaries"], vault["journal_entries"])
    metadata = account_metadata(vault["journal_entry_item_account_metadata"])
    return items.join(entries, F.col("journal_entries_uuid") == F.col("entry")).join(
        metadata, F.col("item") == F.col("journal_entry_items_uuid"), "left"
    ).drop("journal_entry_items_uuid")


def _posting_key(amount: str) -> Column:
    return F.when(F.col(amount) < 0, F.lit(CREDIT_KEY)).otherwise(F.lit(DEBIT_KEY))


def journal_bookings(vault) -> DataFrame:
    """Bookings of exported journal entries.

    The chain below an item (sources, source items, references) is put together first
    and joined to the items once.  Large tables are joined in slices.
    """
    references = vault["transaction_items"].select(
        F.col("uuid").alias("ti"), F.col("external_reference").alias("aggregate_id")
    )
    tax_references = vault["transaction_item_taxes"].select(
        F.col("uuid").alias("tit"), F.col("external_reference").alias("tax_reference")
    )
    source_items = vault["journal_entry_item_source_items"].withColumnsRenamed(
        {"journal_entry_item_sources_uuid": "source", "amount": "source_amount"}
    )
    n = slices_for(source_items)
    source_items = join_in_slices(
        source_items, (references, "ti"), on="transaction_items_uuid", how="left", slices=n, finish=lambda df: df.drop("transaction_items_uuid")
    )
    source_items = join_in_slices(
        source_items,
        (tax_references, "tit"),
        on="transaction_item_taxes_uuid",
        how="left",
        slices=n,
        finish=lambda df: df.drop("transaction_item_taxes_uuid"),
    )
    sources = vault["journal_entry_item_sources"].select("uuid", F.col("journal_entry_items_uuid").alias("source_item"))
    sources = join_in_slices(sources, (source_items, "source"), on="uuid", how="left", slices=n, finish=lambda df: df.drop("uuid"))
    items = vault["journal_entry_items"].select(
        F.col("uuid").alias("item"), "journal_entries_uuid", F.col("amount").alias("item_amount"), "account"
    )
    entries = _exported_entries(vault["summaries"], vault["journal_entries"]).drop("summaries_uuid", "summary")
    items = join_in_slices(
        items, (entries, "entry"), on="journal_entries_uuid", how="inner", slices=n, finish=lambda df: df.drop("journal_entries_uuid")
    )
    metadata = account_metadata(vault["journal_entry_item_account_metadata"])
    return join_in_slices(
        items, (metadata, "journal_entry_items_uuid"), (sources, "source_item"), on="item", how="left", slices=n, finish=_journal_rows
    )


def _journal_rows(joined: DataFrame) -> DataFrame:
    slash = F.lit(NOT_SET)
    rows = joined.select(
        F.lit(JOURNAL_RUN).alias("booking_execution_id"),
        "booking_created",
        F.lit("bbseg").alias("booking_src"),
        F.lit("").alias("key"),
        F.lit("ED").alias("ba"),
        "budat",
        F.lit("100").alias("bukrs"),
        "beldat",
        F.coalesce("aufnr", slash).alias("aufnr"),
        F.coalesce("gsber", slash).alias("gsber"),
        F.coalesce("mwskz", slash).alias("mwskz"),
        _posting_key("item_amount").alias("newbs"),
        F.col("account").alias("newko"),
        german_decimal("source_amount").alias("wrbed_aggregate"),
        german_decimal("item_amount").alias("wrbed_total"),
        "xblnr",
        F.when(F.col("tax_index").isNotNull(), F.lit("X")).otherwise(slash).alias("xstba"),
        "aggregate_id",
        F.col("amount_formula").alias("amount_calculation"),
        safe_id("tax_reference").alias("tax_aggregate_ouid"),
        *[slash.alias(c) for c in ("kostl", "newbk", "prced", "sgtxt", "vbund", "zterm", "zuonr", "psegment")],
    )
    return conform(rows, BOOKING_COLUMNS)


def journal_tax_bookings(vault, vat_accounts: DataFrame) -> DataFrame:
    """Tax bookings of exported journal entries."""
    references = vault["transaction_items"].select(
        F.col("uuid").alias("ti"), F.col("external_reference").alias("aggregate_id")
    )
    details = (
        vault["journal_entry_item_tax_source_items"]
        .join(references, F.col("transaction_items_uuid") == F.col("ti"), "left")
        .select(
            "journal_entry_item_tax_sources_uuid",
            F.col("amount").alias("detail_amount"),
            "base_amount",
            "amount_formula",
            "aggregate_id",
        )
    )
    sources = vault["journal_entry_item_tax_sources"].select(
        F.col("uuid").alias("tax_source"), "journal_entry_item_taxes_uuid"
    )
    taxes = vault["journal_entry_item_taxes"].select(
        F.col("uuid").alias("tax"), F.col("journal_entry_items_uuid").alias("tax_item"), F.col("amount").alias("tax_amount")
    )
    chain = taxes.join(sources, F.col("tax") == F.col("journal_entry_item_taxes_uuid")).join(
        details, F.col("tax_source") == F.col("journal_entry_item_tax_sources_uuid"), "left"
    )
    accounts = vat_accounts.withColumnRenamed("mwskz", "code")
    joined = (
        _items(vault)
        .drop("account")
        .join(chain, F.col("item") == F.col("tax_item"))
        .join(accounts, F.col("mwskz") == F.col("code"), "left")
    )
    return _tax_rows(
        joined,
        run=F.lit(JOURNAL_RUN),
        created=F.col("booking_created"),
        mwskz=F.coalesce("mwskz", F.lit(NOT_SET)),
        newbs=_posting_key("tax_amount"),
        xblnr=F.col("xblnr"),
        wrbed=german_decimal("detail_amount"),
        fwbas=german_decimal("base_amount"),
        indicator=F.col("amount_formula"),
    )


def journal_headers(vault) -> DataFrame:
    rows = _exported_entries(vault["summaries"], vault["journal_entries"]).select(
        "budat", F.col("xblnr").alias("xbelnr")
    )
    return conform(rows, HEADER_COLUMNS)


def ledger_from_journal(vault, lookups: ClientLookups) -> Ledger:
    return Ledger(
        journal_bookings(vault),
        journal_tax_bookings(vault, lookups.vat_accounts_df(vault.spark)),
        journal_headers(vault),
    )


LEDGERS = {"documents": ledger_from_documents, "journal": ledger_from_journal}


def _tax_rows(
    joined: DataFrame,
    run: Column,
    created: Column,
    mwskz: Column,
    newbs: Column,
    xblnr: Column,
    wrbed: Column,
    fwbas: Column,
    indicator: Column,
) -> DataFrame:
    own = {
        "bbtax_booking_execution_id": run,
        "bbtax_booking_created": created,
        "mwskz": mwskz,
        "newbs": newbs,
        "newko": F.col("account"),
        "xblnr": xblnr,
        "wrbed": wrbed,
        "fwbas": fwbas,
        "aggregate_id": F.col("aggregate_id"),
        "amount_calculation": indicator,
    }
    return joined.select(
        *[own.get(name, F.lit(NOT_SET)).cast(kind).alias(name) for name, kind in TAX_BOOKING_COLUMNS.items()]
    )
