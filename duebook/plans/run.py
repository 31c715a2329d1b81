"""One run for a client: build, publish, export for each system, archive."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from duebook.plans.build import build
from duebook.session import stages
from duebook.sinks.csv_chunks import DEFAULT_CHUNK_ROWS, delivery_path, export_table, write_chunks
from duebook.sinks.publish import publish_list, read_published
from duebook.sources.lookups import ClientLookups
from duebook.sources.vault import Vault

ARCHIVE = "archive"


@dataclass(frozen=True)
class RunResult:
    """Paths of the files that a run delivered, by system, and of its archive."""

    exported: dict[str, list[str]] = field(default_factory=dict)
    archived: list[str] = field(default_factory=list)


def run(
    vault: Vault,
    as_of: dt.date,
    client: str,
    environment: str,
    published: str,
    exports: str,
    systems: list[str],
    overlays: Mapping[str, ClientLookups] | None = None,
    ledger: str = "journal",
    view: str = "open_items_customer",
    rows_per_chunk: int = DEFAULT_CHUNK_ROWS,
) -> RunResult:
    """Build the list, publish it under ``published``, export its view to ``exports`` and archive the whole of it.

    Every stage written on the way is removed at the end, also after a failure.
    """
    spark = vault.spark
    with stages(spark):
        publish_list(build(vault, as_of, client, overlays, ledger), published, view)
    with stages(spark):
        exported = {system: export_table(spark, view, exports, client, environment, system, rows_per_chunk) for system in systems}
        folder = f"{delivery_path(exports, client, environment)}/{ARCHIVE}/{as_of.isoformat()}"
        archived = write_chunks(read_published(spark, published), folder, ARCHIVE, view, rows_per_chunk, staged=True)
    return RunResult(exported, archived)
