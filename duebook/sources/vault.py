"""Source ("vault") tables: schemas, readers, and missing sources.

Instants are handed on as ``timestamp_ntz`` in UTC, whatever the session zone is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

_CENTS = "decimal(20,2)"
_AT = "timestamp_ntz"

# Column lists per source table.
SCHEMAS: dict[str, str] = {
    "applied_billing_charge": (
        "ouid bigint, billingaccountouid bigint, customerouid bigint, settlementnoteadviceouid bigint,"
        " transactionid string, glid string, analyticaxis string, aggregateid string, accountingid string,"
        f" taxexcludedamount {_CENTS}, taxincludedamount {_CENTS}, datetimecreate {_AT}, datetimelastmodif {_AT},"
        f" startdatetime {_AT}, enddatetime {_AT}, productname string, characteristics string"
    ),
    "billing_account": f"ouid bigint, name string, customerouid bigint, datetimelastmodif {_AT}, characteristics string",
    "billing_account_relationship": "billingaccountouid bigint, targetbillingaccountouid bigint",
    "billing_account_balance": (
        f"ouid bigint, transactionid string, status string, amount {_CENTS}, billingaccountouid bigint,"
        f" aggregateid string, accountingid string, letteringdate {_AT}, startdatetime {_AT}, datetimecreate {_AT},"
        f" datetimelastmodif {_AT}"
    ),
    "payment_request": (
        f"ouid bigint, transactionid string, status string, bpmeventname string, daterequest {_AT},"
        f" datelastchangestatus {_AT}, datetimelastmodif {_AT}"
    ),
    "payment_item": f"paymentouid bigint, referredouid bigint, referredtype string, amount {_CENTS}",
    "settlement_note_advice": f"ouid bigint, id string, paymentduedate {_AT}, datetimecreate {_AT}",
    "login": "ouid bigint, customerouid bigint, externalid string",
    "applied_billing_tax_rate": (
        f"ouid bigint, appliedbillingchargeouid bigint, taxcategory string, taxrate {_CENTS}, amount {_CENTS},"
        f" datetimelastmodif {_AT}"
    ),
    "charge_aggregate": "ouid bigint, aggregateid string",
    "tax_aggregate": f"ouid bigint, chargeaggregateouid bigint, taxcategory string, taxrate {_CENTS}, amount {_CENTS}",
    "product": (
        f"ouid bigint, billingaccountouid bigint, name string, startdatetime {_AT}, enddatetime {_AT},"
        f" orderdate {_AT}, characteristics string"
    ),
    "order_item": "product_ouid bigint, productorderouid bigint",
    "note": "productorderouid bigint, text string",
    "product_order": "ouid bigint, state string",
    "case_receivables": f"id string, mba string, status string, created_at {_AT}",
    "dunning_claims": "case_receivable_id string, dunning_claim_id string, dunning_level int, scenario string",
    "dunning_locks": (
        f"mba string, reason string, expires_at {_AT}, deleted boolean, created_at {_AT}, updated_at {_AT}"
    ),
    "claims": "id string, status string",
    "booking_runs": f"id bigint, timestamp {_AT}, deleted int, summary string",
    "summaries": f"uuid string, file_created_at {_AT}, create_time {_AT}, export boolean",
    "journal_entries": "uuid string, summaries_uuid string, id string, date date",
    "journal_entry_items": f"uuid string, journal_entries_uuid string, amount {_CENTS}, account string",
    "journal_entry_item_account_metadata": "journal_entry_items_uuid string, type string, key string, value string",
    "journal_entry_item_sources": "uuid string, journal_entry_items_uuid string",
    "journal_entry_item_source_items": (
        f"journal_entry_item_sources_uuid string, amount {_CENTS}, tax_index int, amount_formula string,"
        " transaction_items_uuid string, transaction_item_taxes_uuid string"
    ),
    "transaction_items": "uuid string, external_reference string",
    "transaction_item_taxes": "uuid string, external_reference string",
    "journal_entry_item_taxes": f"uuid string, journal_entry_items_uuid string, amount {_CENTS}",
    "journal_entry_item_tax_sources": "uuid string, journal_entry_item_taxes_uuid string",
    "journal_entry_item_tax_source_items": (
        f"journal_entry_item_tax_sources_uuid string, amount {_CENTS}, base_amount {_CENTS}, amount_formula string,"
        " transaction_items_uuid string"
    ),
    "payment_bookings": "id string, payment_id string, payment_state_id string, sap_id string",
    "payments": f"id string, amount {_CENTS}",
    "payment_states": "id string, payment_status string",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[table])


def to_schema(df: DataFrame, table: str) -> DataFrame:
    """Pick and cast the columns of a source table; instants become UTC wall-clock times."""
    columns = []
    missing = [name for name in schema_of(table).names if name not in df.columns]
    if missing:
        raise ValueError(f"source {table} has no column {', '.join(missing)}")
    for field in schema_of(table).fields:
        column = F.col(f"`{field.name}`")
        if isinstance(df.schema[field.name].dataType, TimestampType):
            column = F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz"))
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


# what Spark says of a path or table that does not exist
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


class Vault(Mapping):
    """Source tables by name, opened on first use."""

    def __init__(self, spark: SparkSession, reader: Callable[[str], DataFrame]):
        self.spark = spark
        self._reader = reader
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in SCHEMAS:
            raise KeyError(table)
        if table not in self._open:
            self._open[table] = self._reader(table)
        return self._open[table]

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def has(self, table: str) -> bool:
        """False where the source does not exist; a source that exists but cannot be read raises."""
        try:
            self[table]
        except KeyError:
            return False
        except AnalysisException as error:
            if error.getCondition() in MISSING:
                return False
            raise
        return True

    def optional(self, table: str) -> DataFrame:
        """The table, or an empty one of the right type where the source is missing."""
        return self[table] if self.has(table) else self.spark.createDataFrame([], schema_of(table))

    def replacing(self, **tables: DataFrame) -> Vault:
        """The same vault with some tables exchanged."""
        return Vault(self.spark, lambda name: tables[name] if name in tables else self[name])


def from_frames(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Vault:
    return Vault(spark, lambda table: to_schema(frames[table], table))


def from_parquet(spark: SparkSession, root: str) -> Vault:
    """One parquet table per folder ``root/<table>``; filters and columns are pushed down."""
    return Vault(spark, lambda table: to_schema(spark.read.parquet(f"{root}/{table}"), table))


def from_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    names: Mapping[str, str] | None = None,
    split: Mapping[str, Mapping[str, str]] | None = None,
) -> Vault:
    """Tables of a database.

    ``names`` maps tables to their qualified names; tables it leaves out are missing
    sources.  Without it every table has its own name.  ``split`` holds the JDBC
    partitioning options (partitionColumn, lowerBound, upperBound, numPartitions) of
    large tables, which otherwise arrive in a single task.
    """

    def read(table: str) -> DataFrame:
        name = table if names is None else names[table]
        reader = spark.read.format("jdbc").options(**options).option("dbtable", name)
        return to_schema(reader.options(**(split or {}).get(table, {})).load(), table)

    return Vault(spark, read)
