"""Booking run documents: one JSON text per run, four arrays inside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text fields of a ledger segment.
SEGMENT_FIELDS = [
    "key",
    "aufnr",
    "gsber",
    "kostl",
    "mwskz",
    "newbk",
    "newbs",
    "newko",
    "prced",
    "sgtxt",
    "vbund",
    "wrbed",
    "xblnr",
    "xstba",
    "zterm",
    "zuonr",
    "psegment",
]
HEADER_FIELDS = ["ba", "budat", "bukrs", "xblnr", "beldat"]
RAW_FIELDS = ["wrbed", "xblnr", "newbs", "newko", "mwskz", "amountCalculation", "relatedAggregateId"]
TAX_FIELDS = ["mwskz", "bs", "xblnr", "fwste", "fwbas", "taxAggregateOuid"]


def _array(fields: list[str], extra: str = "") -> str:
    return "array<struct<" + ",".join(f"`{f}`:string" for f in fields) + extra + ">>"


DOCUMENT = (
    "struct<sap:struct<"
    f"bbseg:{_array(SEGMENT_FIELDS, ',relatedAggregateIds:array<string>')},"
    f"bbkpf:{_array(HEADER_FIELDS)},"
    f"rawSegments:{_array(RAW_FIELDS)},"
    f"bbtax:{_array(TAX_FIELDS)}"
    ">>"
)


# the text of a document that is no JSON
MALFORMED = "malformed"


def _parsed(booking_runs: DataFrame) -> DataFrame:
    kept = booking_runs.filter(F.col("summary").isNotNull() & (F.col("deleted") == 0))
    schema = DOCUMENT.removesuffix(">") + f",{MALFORMED}:string>"
    doc = F.from_json("summary", schema, {"columnNameOfCorruptRecord": MALFORMED})
    return kept.select(F.col("id").alias("booking_execution_id"), F.col("timestamp").alias("booking_created"), doc.alias("doc"))


def parse_documents(booking_runs: DataFrame) -> DataFrame:
    """Parse every kept run once: (booking_execution_id, booking_created, sap, malformed).

    ``malformed`` holds the text of a run that is no JSON document; such a run has no ``sap``.  Store the
    result and look at ``malformed_runs`` before it is used.
    """
    return _parsed(booking_runs).select("booking_execution_id", "booking_created", "doc.sap", f"doc.{MALFORMED}")


def malformed_runs(documents: DataFrame) -> DataFrame:
    """Runs of ``parse_documents`` that could not be read, with their text."""
    return documents.filter(F.col(MALFORMED).isNotNull()).select("booking_execution_id", "booking_created", MALFORMED)


class MalformedDocuments(ValueError):
    """Some runs are no JSON documents."""


def without_malformed(documents: DataFrame, quarantine: str | None = None) -> DataFrame:
    """Stored documents that could be read.

    A malformed run stops the load, as a failing cast does, unless ``quarantine`` names a folder to
    which such runs are appended.
    """
    bad = malformed_runs(documents)
    few = [r[0] for r in bad.select("booking_execution_id").limit(20).collect()]
    if few and quarantine is None:
        raise MalformedDocuments(f"booking runs that are no JSON documents: {', '.join(map(str, few))}")
    if few:
        bad.write.mode("append").parquet(quarantine)
    return documents.filter(F.col(MALFORMED).isNull())


def explode_documents(documents: DataFrame, array: str, position: bool = False) -> DataFrame:
    """One row per element of one array; absent, null and empty arrays give none."""
    if position:
        rows = documents.select(
            "booking_execution_id", "booking_created", F.posexplode(f"sap.{array}").alias("position", "item")
        )
        return rows.select("booking_execution_id", "booking_created", "position", "item.*")
    rows = documents.select("booking_execution_id", "booking_created", F.explode(f"sap.{array}").alias("item"))
    return rows.select("booking_execution_id", "booking_created", "item.*")
