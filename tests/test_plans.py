import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.plans import balances as bal
from duebook.operators.joins import member_join
from duebook.plans import bookings as book
from duebook.plans import build as b
from duebook.plans import charges as chg
from duebook.plans import due_dates as due
from duebook.plans import dunning as dun
from duebook.plans import incremental as inc
from duebook.plans import open_items as items
from duebook.plans import overpayments as over
from duebook.plans.amount_rules import booked_amount
from duebook.session import materialize
from duebook.sources.documents import MalformedDocuments, malformed_runs, parse_documents, without_malformed
from duebook.sources.lookups import BASE, WITH_VAT_ACCOUNTS, ClientLookups, client_lookups

REJECT, PARTIAL = due.REJECTED_PARENT, due.PARTIAL_PARENT


def charge(ouid, tx, glid="BANK_FEE", **more):
    return {"ouid": ouid, "transactionid": tx, "glid": glid, "datetimecreate": "2024-01-01 10:00:00"} | more


def parent(key, tx):
    return f'{{"{key}":"{tx}"}}'


def test_due_date_chain(table, rows):
    charges = [charge(1, "t1")] + [
        charge(i, f"t{i}", characteristics=parent(REJECT, f"t{i - 1}")) for i in range(2, 9)
    ] + [charge(9, "t9", characteristics=parent(REJECT, "nowhere"))]
    frame = table("applied_billing_charge", *charges)
    balance = table(
        "billing_account_balance", {"ouid": 1, "transactionid": "t1", "status": "DUE", "startdatetime": "2024-01-10 00:00:00"}
    )
    originals = due.original_due_dates(frame, due.balance_dates(balance))
    result = due.propagate_due_dates(originals, due.reject_edges(frame))
    assert rows(result, "transactionid", "due_date") == [(f"t{i}", "2024-01-10") for i in range(1, 8)]


def test_override_order(table, rows):
    frame = table(
        "applied_billing_charge",
        charge(1, "p"),
        charge(2, "c", characteristics=parent(PARTIAL, "p")),
        charge(3, "r", characteristics=parent(REJECT, "c")),
    )
    balance = table(
        "billing_account_balance", {"ouid": 1, "transactionid": "p", "status": "DUE", "startdatetime": "2024-03-01 00:00:00"}
    )
    result = due.propagate_due_dates(due.original_due_dates(frame, due.balance_dates(balance)), due.reject_edges(frame))
    result = due.override_rejected_due(due.override_partial_due(result, frame), frame)
    assert rows(result, "transactionid", "due_date") == [(t, "2024-03-01") for t in ("c", "p", "r")]


def test_split_status(table, rows):
    balance = table(
        "billing_account_balance",
        *[{"ouid": i, "transactionid": t, "status": s} for i, (t, s) in enumerate(
            [("a", "DUE_LETTERED"), ("a", "DUE"), ("a", "DUE"), ("b", "DUE"), ("a", "PAID")]
        )],
    )
    assert rows(due.split_status_transactions(balance)) == [("a", "2", "DUE, DUE_LETTERED")]


def test_cancelled_balances_by_number_and_total(table, rows):
    def settled(amounts, cancelled):
        frame = table(
            "applied_billing_charge", *[charge(i, "t", taxincludedamount=a) for i, a in enumerate(amounts, 1)]
        )
        balance = table(
            "billing_account_balance",
            *[{"ouid": i, "transactionid": "t", "status": "DUE_CANCELLED", "amount": a} for i, a in enumerate(cancelled, 1)],
        )
        numbered = bal.numbered_due_charges(frame, BASE.due_types)
        return rows(bal.due_cancelled_charges(numbered, bal.numbered_cancelled_balances(balance), frame), "ouid")

    assert settled([100, 100, 50], [100]) == [("1",)]
    assert settled([30, 70], [100]) == [("1",), ("2",)]


def test_dunning_cases(vault, rows):
    v = vault(
        dunning_locks=[
            {"mba": "A", "created_at": "2024-01-01 00:00:00", "deleted": "false", "reason": "old"},
            {"mba": "A", "created_at": "2024-01-02 00:00:00", "deleted": "true", "reason": "new"},
            {"mba": "B", "created_at": "2024-01-01 00:00:00", "deleted": "false", "reason": "lock"},
        ],
        case_receivables=[
            {"id": "c1", "mba": "A", "status": "CLOSED", "created_at": "2024-01-05 00:00:00"},
            {"id": "c2", "mba": "C", "status": "DUNNING", "created_at": "2024-01-05 00:00:00"},
            {"id": "c3", "mba": "C", "status": "BLOCKING"},
        ],
    )
    state = dun.dunning(v, dt.date(2024, 1, 15))
    assert rows(state, "mba", "dunning_status", "dunning_lock_until", "dunning_lock_reason") == [
        ("A", None, None, None), ("B", None, "9999-12-31", "lock"), ("C", "BLOCKING", None, None),
    ]
    assert dun.dunning(v.replacing(case_receivables=v["case_receivables"].limit(0)), dt.date(2024, 1, 15)).isEmpty()


def test_missing_dunning_sources_give_an_empty_state(spark):
    from duebook.sources.vault import from_frames

    assert dun.dunning(from_frames(spark, {}), dt.date(2024, 1, 15)).isEmpty()


def test_write_offs(vault, rows):
    def product(i, day, ids):
        return {
            "ouid": i, "name": "X_ACTCHARGESCANCELLATION", "orderdate": f"{day} 00:00:00",
            "characteristics": f'{{"CANCELLATION_REASON":"r{i}","CHARGES_OUIDS":"{ids}"}}',
        }

    v = vault(
        product=[product(1, "2024-01-01", "1,2"), product(2, "2024-02-01", "1,x"), product(3, "2024-03-01", "2")],
        order_item=[{"product_ouid": i, "productorderouid": i} for i in (1, 2, 3)],
        product_order=[{"ouid": 1, "state": "COMPLETED"}, {"ouid": 2, "state": "COMPLETED"}, {"ouid": 3, "state": "OPEN"}],
    )
    assert rows(b.write_off_rows(v), "charge_ouid", "write_off_reason") == [("1", "r2"), ("2", "r1"), (None, "r2")]


def test_flags_taxes_and_signs(table, spark, rows):
    frame = spark.createDataFrame(
        [("A_MANUAL_BONUS", None), ("A_MANUAL_BONUS", "special"), ("X", "cancellation")], "glid string, analyticaxis string"
    ).withColumn("can_be_due", F.lit(True))
    assert rows(chg.can_be_due(frame), "can_be_due") == [("False",), ("False",), ("True",)]
    tax = table(
        "applied_billing_tax_rate",
        *[{"ouid": i, "appliedbillingchargeouid": 1, "taxcategory": c, "amount": a} for i, (c, a) in enumerate(
            [("VAT", 1900), ("gasTax", 100), ("electricityTax", 200)]
        )],
        {"ouid": 9, "appliedbillingchargeouid": 2, "taxcategory": "VAT", "amount": -5},
    )
    taxes = {r.appliedbillingchargeouid: r for r in chg.charge_taxes(tax).collect()}
    assert (taxes[1].taxamount, taxes[1].energytaxamount) == (Decimal("19.000000"), Decimal("3.000000"))
    charges = table("applied_billing_charge", charge(1, "t", aggregateid="a"), charge(2, "t", aggregateid="b"))
    assert rows(chg.aggregate_signs(tax, charges), "aggregateid", "total_sign") == [("a", "1"), ("b", "-1")]


def test_overpayment_used_up(table, rows):
    def days(*uses):
        frame = table(
            "applied_billing_charge",
            charge(1, "t", over.CREDIT, taxincludedamount=100),
            *[charge(i, "t", over.USED, taxincludedamount=a, datetimecreate=f"2024-{d} 12:00:00")
              for i, (a, d) in enumerate(uses, 2)],
        )
        return rows(over.used_dates(frame), "fully_used_at")

    assert days((60, "01-05")) == [(None,)]
    assert days((60, "01-05"), (40, "01-09")) == [("2024-01-09",)]


@pytest.mark.parametrize("seed", range(4))
def test_cross_match_against_all_pairs(table, rows, seed):
    rng = random.Random(seed)
    uses = [(i, f"T{rng.randrange(4)}", f"2024-01-{i % 27 + 1:02d}") for i in range(1, 14)]
    credits = [(100 + i, f"C{rng.randrange(3)}", rng.randrange(2), rng.choice([10, 20])) for i in range(14)]
    balances = [(200 + i, f"C{rng.randrange(3)}", rng.randrange(2), rng.choice([10, 20])) for i in range(10)]
    requests = [(300 + i, f"T{i % 4}") for i in range(6)]
    paid = [(rng.choice(requests)[0], *rng.choice(balances)) for _ in range(14)]
    paid += paid[:2]

    pairs = [
        (u, q, bl, c, n)
        for u in uses for q in requests if q[1] == u[1]
        for n, p in enumerate(paid) if p[0] == q[0]
        for bl in balances if bl[0] == p[1]
        for c in credits if c[1:] == bl[1:]
    ]
    use_no, credit_no = {}, {}
    for column, numbers, order in (
        (3, use_no, lambda x: (x[1][1], x[0][0], x[1][0], x[2][0], x[4])),
        (0, credit_no, lambda x: (x[3][1], x[3][2], x[3][3], x[3][0], x[1][0], x[2][0], x[4])),
    ):
        seen = Counter()
        for x in sorted(pairs, key=order):
            seen[x[column][0]] += 1
            numbers[x] = seen[x[column][0]]
    hits = [x for x in pairs if use_no[x] == credit_no[x]]
    expected = sorted({(x[0][2], x[0][1]) for x in hits}) + sorted({(x[0][2], x[3][1]) for x in hits})

    frame = table(
        "applied_billing_charge",
        *[charge(i, t, over.USED, datetimecreate=f"{d} 12:00:00") for i, t, d in uses],
        *[charge(i, t, over.CREDIT, billingaccountouid=a, taxincludedamount=m) for i, t, a, m in credits],
    )
    args = (
        frame,
        table("payment_request", *[{"ouid": i, "transactionid": t} for i, t in requests]),
        table("payment_item", *[
            {"paymentouid": p[0], "referredouid": p[1], "referredtype": "CANCELLED_BALANCE", "amount": p[4]} for p in paid
        ]),
        table("billing_account_balance", *[
            {"ouid": i, "transactionid": t, "billingaccountouid": a, "amount": m} for i, t, a, m in balances
        ]),
    )
    assert rows(over.cross_match(*args, hot_rows=None)) == sorted(expected)
    if seed == 0:
        assert rows(over.cross_match(*args, hot_rows=3)) == sorted(expected)


DOCUMENT = (
    '{"sap":{"bbseg":[{"xblnr":"BR_TRPC-1","newbs":"40","newko":"1000","mwskz":"11","wrbed":"12,30",'
    '"relatedAggregateIds":["a1","a2"]}],'
    '"bbkpf":[{"ba":"ED","bukrs":"100","xblnr":"BR_TRPC-1","budat":"31.12.2023","beldat":"30.12.2023"}],'
    '"rawSegments":[{"xblnr":"BR_TRPC-1","newbs":"40","newko":"1000","wrbed":"12,30",'
    '"amountCalculation":"TaxIncludedAmount","relatedAggregateId":"a1"},'
    '{"xblnr":"BR_TRPC-1","newbs":"40","newko":"1000","wrbed":"1,00","amountCalculation":"VAT","relatedAggregateId":"a3"}],'
    '"bbtax":[{"xblnr":"BR_TRPC-1","bs":"50","mwskz":"11","fwste":"1,96","fwbas":"10,34","taxAggregateOuid":"7"}]}}'
)


def run(i, summary=DOCUMENT, deleted=0):
    return {"id": i, "timestamp": "2024-01-01 00:00:00", "deleted": deleted, "summary": summary}


def test_document_bookings(vault, rows):
    v = vault(
        booking_runs=[run(1), run(2, deleted=1), run(3, summary=None), run(4, summary='{"sap":{"bbseg":null}}')],
        tax_aggregate=[{"ouid": 7, "chargeaggregateouid": 70}],
        charge_aggregate=[{"ouid": 70, "aggregateid": "a1"}],
    )
    ledger = book.ledger_from_documents(v, WITH_VAT_ACCOUNTS)
    assert rows(ledger.bookings, "booking_execution_id", "aggregate_id", "budat", "wrbed_aggregate") == [
        ("1", "a1", "2023-12-31", "12,30")
    ]
    assert rows(ledger.tax_bookings, "newko", "aggregate_id", "wrbed", "newbs") == [("76100030", "a1", "1,96", "50")]
    assert rows(ledger.headers, "xbelnr", "beldat") == [("BR_TRPC-1", "2023-12-30")]


def test_journal_bookings(vault, rows):
    v = vault(
        summaries=[
            {"uuid": "s", "export": "true", "create_time": "2024-01-02 00:00:00"},
            {"uuid": "n", "create_time": "2024-01-02 00:00:00"},
        ],
        journal_entries=[{"uuid": "e", "summaries_uuid": "s", "id": "D1"}, {"uuid": "f", "summaries_uuid": "n", "id": "D2"}],
        journal_entry_items=[
            {"uuid": "i1", "journal_entries_uuid": "e", "amount": -1230},
            {"uuid": "i2", "journal_entries_uuid": "e", "amount": 5},
            {"uuid": "i3", "journal_entries_uuid": "e"},
            {"uuid": "i4", "journal_entries_uuid": "f", "amount": 7},
        ],
        journal_entry_item_account_metadata=[
            {"journal_entry_items_uuid": "i1", "type": "rfbibl", "key": "mwskz", "value": "11"},
            {"journal_entry_items_uuid": "i1", "type": "else", "key": "aufnr", "value": "no"},
        ],
    )
    assert rows(book.journal_bookings(v), "newbs", "wrbed_total", "mwskz", "aufnr", "booking_created") == [
        ("40", "0,05", "/", "/", "2024-01-02"),
        ("40", None, "/", "/", "2024-01-02"),
        ("50", "12,30", "11", "/", "2024-01-02"),
    ]


@pytest.mark.parametrize(
    "given, expected",
    [
        ({"amount_calculation": "TaxIncludedAmount", "taxincludedamount": 119, "total_sign_taxincludedamount": 1}, "119.00"),
        ({"amount_calculation": "TaxIncludedAmount", "taxincludedamount": 119}, None),
        (
            {"glid": "ELEC_DISCOUNT_X", "amount_calculation": "TaxIncludedAmount", "booking_created": "2022-01-01",
             "taxexcludedamount": 100, "total_sign_taxexcludedamount": -1},
            "-100.00",
        ),
        ({"amount_calculation": "VAT", "datetimecreate": "2021-01-01", "taxamount": -19}, "19.00"),
        ({"amount_calculation": "VAT", "datetimecreate": "2022-01-01", "taxamount": -19, "tax_total_aggregate_sign": -1}, "19.00"),
        ({"amount_calculation": "whatever"}, "0.00"),
        ({"amount_calculation": None}, "0.00"),
        (
            {"glid": "EPILOT_A", "amount_calculation": "TaxIncludedAmount", "taxincludedamount": 5, "taxamount": 0,
             "tax_total_aggregate_sign": -1},
            "5.00",
        ),
        (
            {"amount_calculation": "GASTAX", "energytaxamount": -3, "linked_tax_aggregate": 1, "linked_tax_sign": 0}, "0.00"
        ),
        ({"amount_calculation": "GASTAX", "energytaxamount": -3}, "3.00"),
    ],
)
def test_amount_rules(spark, given, expected):
    columns = {
        "glid": "string", "analyticaxis": "string", "newko": "string", "amount_calculation": "string",
        "booking_created": "date", "datetimecreate": "date", "taxexcludedamount": "decimal(24,6)",
        "taxincludedamount": "decimal(24,6)", "taxamount": "decimal(24,6)", "energytaxamount": "decimal(24,6)",
        "total_sign_taxexcludedamount": "int", "total_sign_taxincludedamount": "int", "tax_total_aggregate_sign": "int",
        "linked_tax_aggregate": "bigint", "linked_tax_amount": "decimal(24,6)", "linked_tax_sign": "int",
    }
    base = {"glid": "ELEC_BILL", "booking_created": "2024-02-01", "datetimecreate": "2022-01-01"} | given
    row = spark.range(1).select(*[F.lit(base.get(c)).cast(t).alias(c) for c, t in columns.items()])
    value = row.select(booked_amount().alias("v")).first().v
    assert (None if value is None else str(value)) == expected


def test_payment_cut_over(table, spark, rows):
    names = list(book.BOOKING_COLUMNS)

    def booking(day, aggregate, document):
        values = {"beldat": day, "aggregate_id": aggregate, "xblnr": document, "newbs": "40"}
        return spark.range(1).select(*[F.lit(values.get(c)).cast(t).alias(c) for c, t in book.BOOKING_COLUMNS.items()])

    bookings = booking("2024-01-30", "p1", "x").unionByName(booking("2024-02-01", "y", "D1"))
    bookings = bookings.unionByName(booking("2024-01-31", "p1", "D1")).select(*names)
    result = items.payment_bookings(
        table("payment_bookings", {"id": "p1", "payment_id": "m", "payment_state_id": "z", "sap_id": "D1"}),
        table("payments", {"id": "m", "amount": 7}),
        table("payment_states", {"id": "z", "payment_status": "OK"}),
        bookings,
    )
    assert rows(result, "glid", "booking_created_at", "booking_debit_amount", "booking_credit_amount") == [
        ("PAS_OK", day, "7.00", None) for day in ("2024-01-30", "2024-01-31", "2024-02-01")
    ]


def test_imbalance(spark, rows):
    def line(aggregate, indicator, debit, credit):
        values = {"aggregate_id": aggregate, "booking_amount_indicator": indicator, "booking_debit_amount": debit,
                  "booking_credit_amount": credit}
        return spark.range(1).select(*[F.lit(values.get(c)).cast(t).alias(c) for c, t in items.LIST_COLUMNS.items()])

    net = "VATExcludedAmount - ELECTRICITYTAX"
    parts = [line("a", net, -5, None), line("a", "VAT", None, 5), line("b", net, -5, None), line("b", "VAT", None, -5),
             line(None, net, -5, None)]
    fixed = items.fix_imbalance(items.open_item_list(parts))
    assert rows(fixed.filter("booking_debit_amount is not null"), "aggregate_id", "booking_debit_amount") == [
        ("a", "5.00"), ("b", "-5.00"), (None, "-5.00"),
    ]


def test_lookups():
    own = ClientLookups(due_types=(("X", "%"),))
    assert client_lookups("c", {"c": own}) is own
    assert client_lookups("other", {"c": own}) is BASE
    assert len(BASE.due_types) == 18 and len(WITH_VAT_ACCOUNTS.vat_accounts) == 20
    with pytest.raises(ValueError):
        ClientLookups(due_types=(("X", "%"), ("X", "%")))


def test_incremental_bookings_equal_a_full_load(vault, rows):
    old = vault(booking_runs=[run(1), run(2), run(3)])["booking_runs"]
    changed = DOCUMENT.replace('"a1"]', '"a1","a3"]').replace('["a1","a2"]', '["a1","a3"]')
    new = vault(booking_runs=[run(1), run(2, changed), run(4), run(5, deleted=1)])["booking_runs"]
    previous = inc.run_bookings(old)
    result = inc.reload_bookings(previous, new, inc.document_fingerprints(old))
    assert rows(result) == rows(inc.run_bookings(new))
    same = inc.reload_bookings(result, new, inc.document_fingerprints(new))
    assert rows(same) == rows(result)


def test_documents_are_parsed_once(vault, capsys):
    """Whatever reads segments, headers, raw segments and tax rows reads the stored documents."""
    v = vault(booking_runs=[run(1)])
    book.ledger_from_documents(v, WITH_VAT_ACCOUNTS).tax_bookings.explain("extended")
    inc.run_bookings(v["booking_runs"]).explain("extended")
    assert "from_json" not in capsys.readouterr().out


@pytest.mark.parametrize("left, right", [("bseg_booking_execution_id", "booking_execution_id"), ("xblnr", "xbelnr"), ("newko", "newko"), ("newbs", "newbs")])
def test_the_sample_shows_a_dropped_join_key(spark, left, right):
    """Without any one key of the raw segments the sample gives other bookings, so a check on it means something."""
    from duebook.sources.sample_vault import sample_vault

    documents = materialize(parse_documents(sample_vault(spark, "/root/testdata/sf0.001")["booking_runs"]))
    segments = book.json_segments(documents).withColumn("position", F.monotonically_increasing_id())
    segments = materialize(segments.filter("newko is not null"))
    raw = book.json_raw_segments(documents).filter("newko is not null")
    def hits(segments, raw):
        on = {"bseg_booking_execution_id": "raw_run", "xblnr": "raw_xblnr", "newko": "raw_newko", "newbs": "raw_newbs"}
        renamed = {"booking_execution_id": "raw_run", "xbelnr": "raw_xblnr", "newko": "raw_newko", "newbs": "raw_newbs"}
        return member_join(segments, raw.withColumnsRenamed(renamed), ["position"], on, "related_aggregate_ids", "aggregate_id").count()

    whole = hits(segments, raw)
    same = F.lit(0).cast("long") if left.startswith("bseg") else F.lit("same")
    assert hits(segments.withColumn(left, same), raw.withColumn(right, same)) > whole > 0


def test_malformed_documents_stop_or_go_aside(vault, spark, rows, tmp_path):
    v = vault(booking_runs=[run(1), run(2, DOCUMENT[:-5]), run(3, "[]x"), run(4, DOCUMENT[:-5], deleted=1), run(5, summary=None), run(6, "{}")])
    documents = parse_documents(v["booking_runs"])
    assert rows(malformed_runs(documents), "booking_execution_id") == [("2",), ("3",)]
    with pytest.raises(MalformedDocuments, match="2, 3|3, 2"):
        inc.run_bookings(v["booking_runs"])
    aside = str(tmp_path / "quarantine")
    kept = without_malformed(documents, aside)
    assert rows(kept, "booking_execution_id") == [("1",), ("6",)]
    assert rows(spark.read.parquet(aside), "booking_execution_id") == [("2",), ("3",)]


def test_booking_stream(vault, spark, rows, tmp_path):
    from duebook.streaming.booking_stream import current_bookings, stream_bookings

    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([run(1), run(2)], [run(2, deleted=1), run(3)]):
        vault(booking_runs=part)["booking_runs"].write.mode("append").parquet(source)
        stream_bookings(spark, source, target, str(tmp_path / "cp")).awaitTermination()
    expected = inc.run_bookings(vault(booking_runs=[run(1), run(3)])["booking_runs"])
    assert rows(current_bookings(spark, target)) == rows(expected)

    # an older version that arrives late, and another checkpoint, change nothing and lose nothing
    late = run(3, DOCUMENT.replace("12,30", "99,99")) | {"timestamp": "2023-12-31 00:00:00"}
    vault(booking_runs=[late, run(2) | {"timestamp": "2023-12-01 00:00:00"}])["booking_runs"].write.mode("append").parquet(source)
    stream_bookings(spark, source, target, str(tmp_path / "cp")).awaitTermination()
    assert rows(current_bookings(spark, target)) == rows(expected)
    stream_bookings(spark, source, target, str(tmp_path / "cp2")).awaitTermination()
    assert rows(current_bookings(spark, target)) == rows(expected)
    vault(booking_runs=[run(4) | {"timestamp": "2024-02-01 00:00:00"}, run(1, deleted=1) | {"timestamp": "2024-02-01 00:00:00"}])["booking_runs"].write.mode("append").parquet(source)
    stream_bookings(spark, source, target, str(tmp_path / "cp2")).awaitTermination()
    newer = vault(booking_runs=[run(3), run(4) | {"timestamp": "2024-02-01 00:00:00"}])["booking_runs"]
    assert rows(current_bookings(spark, target)) == rows(inc.run_bookings(newer))


def test_day_bounds_reach_the_scan(spark, tmp_path, capsys):
    """The bound is compared with the bare column, so parquet skips files and row groups."""
    from duebook.functions.dates import FIRST_DAY_EXCLUDED, after_day, local_date
    from duebook.plans import balances as bal
    from duebook.sources.vault import from_parquet

    instants = ["2019-07-30 21:59:59", "2019-07-30 22:00:00", "2019-07-29 00:00:00", "2020-01-01 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in instants], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    kept = df.filter(after_day("t", FIRST_DAY_EXCLUDED))
    assert kept.exceptAll(df.filter(local_date("t") > F.lit(FIRST_DAY_EXCLUDED).cast("date"))).isEmpty() and kept.count() == 2

    table = spark.createDataFrame([(1, "2021-01-01 00:00:00", "A")], "ouid long, at string, aggregateid string").select(
        "ouid", "aggregateid", *[F.col("at").cast("timestamp_ntz").alias(c) for c in ("datetimecreate", "datetimelastmodif", "startdatetime", "letteringdate")],
        *[F.lit("x").alias(c) for c in ("transactionid", "status", "accountingid")], F.lit(1).cast("decimal(20,2)").alias("amount"), F.lit(1).cast("long").alias("billingaccountouid"),
    )
    table.write.parquet(str(tmp_path / "billing_account_balance"))
    vault = from_parquet(spark, str(tmp_path))
    accounts = spark.createDataFrame([], "account_ouid long, login_ouid long, customer_id string, mba string, cba string, migration_flag string")
    bal.balances(vault["billing_account_balance"], accounts).explain("formatted")
    assert "GreaterThanOrEqual(datetimecreate,2019-07-30T22:00)" in capsys.readouterr().out
