"""Benchmark of headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores.  Every query runs over the whole tables and its full result is computed by a
no-op write.  The derived source tables are stored before the clock starts, as they
would exist in a vault.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duebook import checks  # noqa: E402
from duebook.session import local_session  # noqa: E402
from duebook.sources.sample_vault import TABLES, sample_vault  # noqa: E402

HEADLINE = [
    "latest_event_per_user",
    "top_row_per_order",
    "pattern_join_parts",
    "running_numbers",
    "partition_total",
    "count_distinct_having",
    "balance_dates",
    "propagate_due_dates",
    "due_overrides",
    "charge_balance_dates",
    "dunning_state",
    "write_offs",
    "aggregate_signs",
    "charge_taxes",
    "base_charges",
    "charges",
    "tax_amounts",
    "overpayment_cross_match",
    "overpayment_dates",
    "due_cancelled_charges",
    "json_bookings",
    "journal_bookings",
    "open_items",
    "booked_charges",
    "booked_balances",
    "booked_taxes",
    "payment_bookings",
    "affected_charges",
    "incremental_equals_full",
    "chunk_rows",
    "open_item_list",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, app="duebook-bench")
    vault = sample_vault(spark, folder)
    stored = sum(vault[table].count() for table in [*TABLES, "booking_runs"])
    registered = checks.registered()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "source_rows": stored,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
