"""Check SQL, in plain relational form.

Every statement says what a result is, without regard to speed: complete joins,
window functions and recursion over the whole tables.  ``PARTS`` are named building
blocks; a statement carries those it needs as common table expressions.
"""

from __future__ import annotations

import re

from duebook.sources.sample_vault import LEDGER_ROWS, RAW_TABLES, TABLES

AS_OF = "date '2024-01-15'"
SEEN = "date '2019-07-30'"


def berlin(ts: str) -> str:
    return f"cast((({ts}) at time zone 'UTC') at time zone 'Europe/Berlin' as date)"


def unit(cents: str) -> str:
    return f"cast({cents} as decimal(20,2)) * 0.01"


def attr(column: str, key: str) -> str:
    return f"json_extract_string({column}, '$.{key}')"


def german(cents: str) -> str:
    return f"replace(cast(cast({unit(f'abs({cents})')} as decimal(20,2)) as varchar), '.', ',')"


# Types with inverted sign, due types and tax codes with their accounts.
INVERTED = "(OVERPAYMENT.CREDIT|.*.MANUAL.BONUS)"
DUE_TYPES = """('BANK_FEE'), ('DUNNING_FEE'), ('%_ABSCHLAG'), ('%_BILL'), ('%_BILL_MIGRATION'),
  ('%_CANCELLATION_BALANCE'), ('%_MANUAL_BILL'), ('%_MANUAL_BONUS'), ('EPILOT_%_LEASE_PAY'), ('EPILOT_%_SERVICE_PAY'),
  ('EPILOT_%_UNIT_PAY'), ('OVERPAYMENT_CREDIT'), ('OVERPAYMENT_REFUND'), ('OVERPAYMENT_USED'), ('METER_BLOCKING_%_FEE'),
  ('METER_BLOCKING_LETTER'), ('METER_UNBLOCKING_%_FEE'), ('%_CANCELLATION_BALANCE_WRITE_OFF')"""
VAT_CODES = """('11','76100030'), ('1A','76100030'), ('21','76100030'), ('2A','76100030'), ('12','76100101'),
  ('1B','76100101'), ('22','76100100'), ('2B','76100100'), ('59','76110005'), ('5W','76110005'), ('69','76110005'),
  ('6W','76110005'), ('51','76110030'), ('5A','76110030'), ('61','76110030'), ('6A','76110030'), ('62','76110030'),
  ('6B','76110030'), ('81','RC'), ('8A','RC')"""

# Result columns of the list that a part leaves empty or fills.
LIST = {
    "applied_billing_charge_ouid": "varchar",
    "billing_account_ouid": "varchar",
    "login_ouid": "varchar",
    "billing_account_balance_ouid": "varchar",
    "tax_item_ouid": "varchar",
    "datetimelastmodif": "timestamp",
    "cba": "varchar",
    "mba": "varchar",
    "customer_id": "varchar",
    "date_created": "date",
    "transaction_id": "varchar",
    "glid": "varchar",
    "analyticaxis": "varchar",
    "bill_id": "varchar",
    "due_date": "date",
    "balance_date": "date",
    "write_off_date": "date",
    "write_off_reason": "varchar",
    "write_off_note": "varchar",
    "dunning_lock_until": "date",
    "dunning_lock_reason": "varchar",
    "dunning_status": "varchar",
    "dunning_scenario": "varchar",
    "dunning_level": "integer",
    "amount_net": "decimal(24,6)",
    "amount_gross": "decimal(24,6)",
    "amount_vat": "decimal(24,6)",
    "amount_energy_tax": "decimal(24,6)",
    "aggregate_id": "varchar",
    "accounting_id": "varchar",
    "booking_execution_id": "bigint",
    "booking_created_at": "date",
    "booking_date": "date",
    "booking_order_number": "varchar",
    "booking_tax_code": "varchar",
    "booking_mainledger_account": "varchar",
    "booking_reference_document_number": "varchar",
    "booking_debit_amount": "decimal(20,2)",
    "booking_credit_amount": "decimal(20,2)",
    "booking_amount_indicator": "varchar",
    "migration_flag": "varchar",
}
HIDDEN = {
    "applied_billing_charge_ouid",
    "billing_account_ouid",
    "login_ouid",
    "billing_account_balance_ouid",
    "tax_item_ouid",
    "datetimelastmodif",
    "dunning_status",
    "booking_execution_id",
}
# Columns of a booking.
BOOKING = [
    "booking_execution_id",
    "booking_created",
    "booking_src",
    "key",
    "ba",
    "budat",
    "bukrs",
    "beldat",
    "aufnr",
    "gsber",
    "kostl",
    "mwskz",
    "newbk",
    "newbs",
    "newko",
    "mwskz2",
    "prced",
    "sgtxt",
    "vbund",
    "wrbed_total",
    "wrbed_aggregate",
    "xblnr",
    "xstba",
    "zterm",
    "zuonr",
    "psegment",
    "aggregate_id",
    "amount_calculation",
    "tax_aggregate_ouid",
]
BOOKING_KINDS = {
    "booking_execution_id": "bigint",
    "booking_created": "date",
    "budat": "date",
    "beldat": "date",
    "tax_aggregate_ouid": "bigint",
}
# Columns of a tax booking.
TAX_BOOKING = [
    "bbtax_booking_execution_id",
    "bbtax_booking_created",
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
    "xblnr",
    "xstba",
    "zterm",
    "zuonr",
    "psegment",
    "wrbed",
    "fwbas",
    "aggregate_id",
    "amount_calculation",
]


def list_row(values: dict[str, str], source: str, distinct: bool = False) -> str:
    columns = ",\n    ".join(f"cast({values.get(c, 'null')} as {kind}) as {c}" for c, kind in LIST.items())
    return f"select {'distinct ' if distinct else ''}{columns}\n  {source}"


def booking_row(values: dict[str, str], source: str) -> str:
    columns = ", ".join(
        f"cast({values.get(c, 'null')} as {BOOKING_KINDS.get(c, 'varchar')}) as \"{c}\"" for c in BOOKING
    )
    return f"select {columns} {source}"


def tax_row(values: dict[str, str], source: str) -> str:
    kinds = {"bbtax_booking_execution_id": "bigint", "bbtax_booking_created": "date"}
    columns = ", ".join(
        f"cast({values.get(c, chr(39) + '/' + chr(39))} as {kinds.get(c, 'varchar')}) as \"{c}\"" for c in TAX_BOOKING
    )
    return f"select {columns} {source}"


CHARGE_INFO = {
    "datetimelastmodif": "c.datetimelastmodif",
    "cba": "c.cba",
    "mba": "c.mba",
    "customer_id": "c.customer_id",
    "bill_id": "c.bill_id",
    "write_off_date": "c.write_off_date",
    "write_off_reason": "c.write_off_reason",
    "write_off_note": "c.write_off_note",
    "dunning_lock_until": "c.dunning_lock_until",
    "dunning_lock_reason": "c.dunning_lock_reason",
    "dunning_status": "c.dunning_status",
    "dunning_scenario": "c.dunning_scenario",
    "dunning_level": "c.dunning_level",
    "migration_flag": "c.migration_flag",
    "applied_billing_charge_ouid": "c.charge",
    "billing_account_ouid": "c.account",
    "login_ouid": "c.login_ouid",
    "billing_account_balance_ouid": "''",
    "tax_item_ouid": "''",
    "date_created": "c.created",
    "transaction_id": "c.tx",
    "glid": "c.glid",
    "analyticaxis": "coalesce(c.analyticaxis, '')",
    "amount_net": "c.net",
    "amount_gross": "c.gross",
    "amount_vat": "c.taxamount",
    "amount_energy_tax": "c.energytaxamount",
}
BOOKED_INFO = {
    "booking_date": "k.budat",
    "booking_order_number": "k.aufnr",
    "booking_tax_code": "k.mwskz",
    "booking_mainledger_account": "coalesce(k.newko, 'tax code: ' || coalesce(k.mwskz, ''))",
    "booking_reference_document_number": "k.xblnr",
    "booking_amount_indicator": "k.amount_calculation",
}


def both_sides(amount: str) -> dict[str, str]:
    return {
        "booking_debit_amount": f"case k.newbs when '40' then {amount} end",
        "booking_credit_amount": f"case k.newbs when '50' then {amount} end",
    }


PARTS: dict[str, str] = {name: text.format(**{t: t for t in RAW_TABLES}) for name, text in (TABLES | LEDGER_ROWS).items()}

PARTS |= {
    "due_patterns": f"select p from (values {DUE_TYPES}) t(p)",
    "vat_codes": f"select code, konto from (values {VAT_CODES}) t(code, konto)",
    "tx_dates": f"""
  select transactionid as tx,
    coalesce(max({berlin('letteringdate')}),
      max({berlin('datetimelastmodif')}) filter (where status in ('DUE_CANCELLED', 'DUE_LETTERED'))) as balanced,
    max({berlin('startdatetime')}) as due
  from billing_account_balance where starts_with(status, 'DUE') group by all""",
    "first_due": f"""
  select 'original' as src, c.transactionid as tx, coalesce(max(t.due), {berlin('max(c.datetimecreate)')}) as due
  from applied_billing_charge c left join tx_dates t on t.tx = c.transactionid
  where {attr('c.characteristics', 'rejectedChargeTransactionId')} is null group by c.transactionid""",
    "rejections": f"""
  select distinct transactionid as tx, {attr('characteristics', 'rejectedChargeTransactionId')} as parent
  from applied_billing_charge where {attr('characteristics', 'rejectedChargeTransactionId')} is not null""",
    "walk": """
  select tx, due, 0 as depth from first_due
  union all
  select r.tx, w.due, w.depth + 1 from walk w join rejections r on r.parent = w.tx where w.depth < 6""",
    "spread_due": """
  select src, tx, due from first_due
  union all
  select 'rejection' as src, tx, due
  from (select tx, due, depth, min(depth) over (partition by tx) as nearest from walk where depth > 0) x
  where depth = nearest""",
    "request_due": f"""
  select transactionid as tx, min({berlin('daterequest')}) as due from payment_request
  where transactionid in (select transactionid from applied_billing_charge where glid like '%\\_MANUAL\\_CONSUMPTION' escape '\\')
  group by all""",
    "due_1": """
  select s.src, s.tx, case when r.tx is not null then r.due else s.due end as due
  from spread_due s left join request_due r using (tx)""",
    "partial_parent": f"""
  select distinct transactionid as tx, {attr('characteristics', 'partiallyPaidChargeTransactionId')} as parent
  from applied_billing_charge where {attr('characteristics', 'partiallyPaidChargeTransactionId')} is not null""",
    "due_2": """
  select s.src, s.tx, case when o.tx is not null then o.due else s.due end as due
  from due_1 s left join (select p.tx, min(d.due) as due from partial_parent p join due_1 d on d.tx = p.parent group by p.tx) o
    on o.tx = s.tx""",
    "due_3": """
  select s.src, s.tx, case when o.tx is not null then o.due else s.due end as due
  from due_2 s left join (select p.tx, min(d.due) as due from rejections p join due_2 d on d.tx = p.parent group by p.tx) o
    on o.tx = s.tx""",
    "tx_due": """
  select t.tx, t.balanced, case when o.tx is not null then o.due else t.due end as due
  from tx_dates t left join (select tx, min(due) as due from due_3 group by tx) o on o.tx = t.tx""",
    "mixed": """
  select transactionid as tx, count(distinct status) as n, string_agg(distinct status, ', ' order by status) as statuses
  from billing_account_balance where starts_with(status, 'DUE') group by 1 having count(distinct status) > 1""",
    "mixed_dates": f"""
  select distinct c.ouid as charge, b.status, b.transactionid as tx,
    coalesce({berlin('b.letteringdate')},
      case when b.status <> 'DUE' then {berlin('b.datetimelastmodif')} end) as balanced,
    {berlin('b.startdatetime')} as due
  from billing_account_balance b
  left join applied_billing_charge c on c.transactionid = b.transactionid and c.taxincludedamount = b.amount
    and c.billingaccountouid = b.billingaccountouid
  where starts_with(b.status, 'DUE') and b.transactionid in (select tx from mixed)""",
    "charge_dates": f"""
  select m.charge, m.status, m.tx, m.balanced, case when o.tx is not null then o.due else m.due end as due
  from mixed_dates m left join (select p.tx, min(d.due) as due from partial_parent p join tx_due d on d.tx = p.parent group by p.tx) o
    on o.tx = m.tx
  union all
  select charge, '' as status, tx, balanced, due from (
    select distinct b.ouid as charge, b.transactionid as tx, {berlin('r.datetimecreate')} as balanced,
      {berlin('b.datetimecreate')} as due
    from applied_billing_charge b join applied_billing_charge r on r.billingaccountouid = b.billingaccountouid
      and r.transactionid = b.transactionid and r.taxincludedamount = b.taxincludedamount
    where b.glid like '%_MANUAL_BONUS' and r.glid like '%_MANUAL_BONUS_REFUND'
      and b.accountingid is distinct from 'ignored' and r.accountingid is distinct from 'ignored') x""",
    "charge_due": f"""
  select c.ouid as charge, c.transactionid as tx, max({berlin('coalesce(s.paymentduedate, s.datetimecreate)')}) as due
  from settlement_note_advice s join applied_billing_charge c on c.settlementnoteadviceouid = s.ouid
  where c.glid similar to '.*.(BILL|BILL.MIGRATION)' group by all
  union all
  select ouid, transactionid, {berlin('datetimecreate')} from applied_billing_charge
  where glid like '%_MANUAL_BONUS' and not contains(analyticaxis, 'special')""",
    "hierarchy": f"""
  select m.name as mba, c.name as cba, {attr('m.characteristics', 'migrationFlag')} as migration_flag
  from billing_account_relationship r, billing_account m, billing_account c
  where m.ouid = r.targetbillingaccountouid and c.ouid = r.billingaccountouid""",
    "case_now": """
  select id, created_at, mba, status from case_receivables
  qualify row_number() over (partition by mba order by created_at desc nulls first, id) = 1""",
    "lock_now": f"""
  select * from (
    select mba, coalesce(cast(expires_at as date), date '9999-12-31') as until, reason, deleted from dunning_locks
    qualify row_number() over (partition by mba order by created_at desc nulls first, updated_at desc nulls first,
      until, reason) = 1) x
  where until >= {AS_OF} and deleted is not true""",
    "case_or_lock": """
  select coalesce(c.mba, l.mba) as mba, c.id, c.created_at, c.status, l.until, l.reason
  from case_now c full join lock_now l on l.mba = c.mba""",
    "dunned": """
  select x.mba, d.dunning_level, d.scenario, k.status as claim, case when x.status in ('BLOCKING', 'DUNNING', 'INKASSO')
    then x.status end as dunning_status, x.until, x.reason
  from case_or_lock x left join dunning_claims d on d.case_receivable_id = x.id left join claims k on k.id = d.dunning_claim_id
  qualify row_number() over (partition by x.mba order by x.created_at desc nulls first, d.dunning_level desc nulls last,
    d.scenario nulls last, k.status nulls last) = 1""",
    "written_off": f"""
  select {berlin("ordered_at")} as day, reason, note, try_cast(id as bigint) as charge from (
    select p.orderdate as ordered_at, {attr('p.characteristics', 'CANCELLATION_REASON')} as reason, n.text as note,
      unnest(string_split({attr('p.characteristics', 'CHARGES_OUIDS')}, ',')) as id
    from product p join order_item i on i.product_ouid = p.ouid join product_order o on o.ouid = i.productorderouid
    left join note n on n.productorderouid = i.productorderouid
    where contains(p.name, 'ACTCHARGESCANCELLATION') and o.state = 'COMPLETED') x
  qualify row_number() over (partition by id order by ordered_at desc nulls first, reason nulls last, note nulls last) = 1""",
    "owner": """
  select a.ouid as account, l.ouid as login_ouid, l.externalid as customer_id, coalesce(h.mba, a.name) as mba, h.cba,
    coalesce(json_extract_string(a.characteristics, '$.migrationFlag'), h.migration_flag) as migration_flag
  from billing_account a left join login l on l.customerouid = a.customerouid left join hierarchy h on h.cba = a.name""",
    "found_bills": f"""
  select c.transactionid as tx, min({attr('p.characteristics', 'billId')}) as bill
  from applied_billing_charge c, product p
  where c.glid like '%_MANUAL_CONSUMPTION' and p.billingaccountouid = c.billingaccountouid and p.name = c.productname
    and p.startdatetime = c.startdatetime and p.enddatetime = c.enddatetime
    and date_trunc('hour', p.orderdate) = date_trunc('hour', c.datetimecreate) group by 1 having bill is not null""",
    "base": f"""
  select distinct c.ouid as charge, o.account, o.login_ouid, c.datetimelastmodif, o.mba, o.cba, o.customer_id,
    {berlin('c.datetimecreate')} as created, c.transactionid as tx, c.glid, c.analyticaxis, c.aggregateid, c.accountingid,
    cast({unit('c.taxexcludedamount')} * (case when regexp_full_match(c.glid, '{INVERTED}') then -1 else 1 end)
      as decimal(24,6)) as net,
    cast({unit('c.taxincludedamount')} * (case when regexp_full_match(c.glid, '{INVERTED}') then -1 else 1 end)
      as decimal(24,6)) as gross,
    case when c.glid like '%_FEE' and c.settlementnoteadviceouid is not null
        then coalesce(other.due, own.due, t.due, {berlin('c.datetimecreate')})
      when c.glid like '%_CANCELLATION_BALANCE' then coalesce(fixed.due, other.due)
      else coalesce(fixed.due, own.due, t.due, {berlin('c.datetimecreate')}) end as due_date,
    s.id as bill_id, case when own.charge is null then t.balanced else own.balanced end as balance_date,
    w.day as write_off_date, w.reason as write_off_reason, w.note as write_off_note, d.until as dunning_lock_until,
    d.reason as dunning_lock_reason, d.dunning_status, d.scenario as dunning_scenario, d.dunning_level, o.migration_flag
  from applied_billing_charge c
  left join owner o on o.account = c.billingaccountouid
  left join settlement_note_advice s on s.ouid = c.settlementnoteadviceouid
  left join charge_due fixed on fixed.charge = c.ouid
  left join charge_due other on other.tx = c.transactionid
  left join charge_dates own on own.charge = c.ouid
  left join tx_due t on t.tx = c.transactionid
  left join written_off w on w.charge = c.ouid
  left join dunned d on d.mba = o.mba
  where {berlin('c.datetimelastmodif')} > {SEEN}""",
    "signs": f"""
  select c.aggregateid, if(sum(t.amount) < 0, -1, 1) as total_sign,
    if(sum(c.taxincludedamount * if(regexp_full_match(c.glid, '{INVERTED}'), -1, 1)) < 0, -1, 1)
      as total_sign_taxincludedamount,
    if(sum(c.taxexcludedamount * if(regexp_full_match(c.glid, '{INVERTED}'), -1, 1)) < 0, -1, 1)
      as total_sign_taxexcludedamount
  from applied_billing_charge c join applied_billing_tax_rate t on t.appliedbillingchargeouid = c.ouid
  where t.taxcategory = 'VAT' and length(c.aggregateid) > 0 group by c.aggregateid""",
    "taxes": f"""
  select appliedbillingchargeouid,
    cast(sum({unit('amount')}) filter (where taxcategory = 'VAT') as decimal(24,6)) as taxamount,
    cast(sum({unit('amount')}) filter (where taxcategory <> 'VAT') as decimal(24,6)) as energytaxamount
  from applied_billing_tax_rate where taxcategory in ('VAT', 'gasTax', 'electricityTax') group by all""",
    "full_charges": """
  select distinct b.* exclude (bill_id), coalesce(b.bill_id, f.bill) as bill_id,
    not (coalesce(contains(b.analyticaxis, 'cancellation'), false)
      or coalesce(b.glid like '%MANUAL_BONUS' and contains(b.analyticaxis, 'special'), false)) as can_be_due,
    x.appliedbillingchargeouid, x.taxamount, x.energytaxamount, s.total_sign as tax_total_aggregate_sign,
    s.total_sign_taxincludedamount, s.total_sign_taxexcludedamount
  from base b join taxes x on x.appliedbillingchargeouid = b.charge
  left join signs s on s.aggregateid = b.aggregateid left join found_bills f on f.tx = b.tx""",
    "tax_rows": f"""
  select distinct cast({unit('r.amount')} as decimal(24,6)) as amount, r.ouid as tax_ouid, c.ouid as charge_ouid,
    a.ouid as tax_aggregate_ouid, r.taxrate, cast({unit('a.amount')} as decimal(24,6)) as tax_aggregate_amount,
    cast(sign(a.amount) as integer) as tax_total_sign_via_tax_aggregate, a.taxcategory
  from tax_aggregate a join charge_aggregate g on g.ouid = a.chargeaggregateouid
  join applied_billing_charge c on c.aggregateid = g.aggregateid
  join applied_billing_tax_rate r on r.appliedbillingchargeouid = c.ouid and r.taxrate = a.taxrate
    and r.taxcategory = a.taxcategory
  where r.amount is not null and a.taxcategory in ('VAT', 'gasTax', 'electricityTax')""",
    "vat_links": """
  select distinct a.ouid as tax_aggregate_ouid, c.ouid as charge_ouid
  from applied_billing_tax_rate r join applied_billing_charge c on c.ouid = r.appliedbillingchargeouid
  join charge_aggregate g on g.aggregateid = c.aggregateid
  join tax_aggregate a on a.chargeaggregateouid = g.ouid and a.taxrate = r.taxrate and a.taxcategory = r.taxcategory
  where r.taxcategory = 'VAT'""",
    "over_used": f"""
  select transactionid as tx, case when sum(taxincludedamount) filter (where glid = 'OVERPAYMENT_CREDIT')
      <= sum(taxincludedamount) filter (where glid = 'OVERPAYMENT_USED')
    then max({berlin('datetimecreate')}) filter (where glid = 'OVERPAYMENT_USED') end as day
  from applied_billing_charge where glid in ('OVERPAYMENT_CREDIT', 'OVERPAYMENT_USED') group by 1""",
    "over_rejected": f"""
  select distinct {attr('characteristics', 'rejectedChargeTransactionId')} as tx, {berlin('datetimecreate')} as day
  from applied_billing_charge where glid = 'OVERPAYMENT_CREDIT_REJECTED' and tx is not null""",
    "over_refund": f"""
  select distinct q.transactionid as tx, {berlin('c.datetimecreate')} as day
  from payment_request q, payment_item i, billing_account_balance b, applied_billing_charge c
  where i.paymentouid = q.ouid and b.ouid = i.referredouid and c.transactionid = b.transactionid
    and c.glid = 'OVERPAYMENT_REFUND_CANCEL' and q.transactionid is not null""",
    "over_request": f"""
  select distinct transactionid as tx, {berlin('datelastchangestatus')} as day from payment_request
  where status = 'REJECTED' and transactionid in (select transactionid from applied_billing_charge
    where glid in ('OVERPAYMENT_CREDIT', 'OVERPAYMENT_USED'))""",
    "over_payment": f"""
  select distinct transactionid as tx, {berlin('datelastchangestatus')} as day from payment_request
  where status = 'CANCELLED'
    and transactionid in (select transactionid from applied_billing_charge where glid = 'OVERPAYMENT_CREDIT')
    and transactionid in (select transactionid from billing_account_balance where status = 'PAID')""",
    "over_pairs": f"""
  select u.transactionid as use_tx, c.transactionid as credit_tx, {berlin('u.datetimecreate')} as day,
    row_number() over (partition by c.ouid order by q.transactionid, u.ouid, q.ouid, b.ouid) as use_no,
    row_number() over (partition by u.ouid order by c.transactionid, c.billingaccountouid, c.taxincludedamount, c.ouid,
      q.ouid, b.ouid) as credit_no
  from applied_billing_charge u join payment_request q on q.transactionid = u.transactionid
  join payment_item i on i.paymentouid = q.ouid and i.referredtype = 'CANCELLED_BALANCE'
  join billing_account_balance b on b.ouid = i.referredouid and b.amount = i.amount
  join applied_billing_charge c on c.transactionid = b.transactionid and c.billingaccountouid = b.billingaccountouid
    and c.taxincludedamount = b.amount and c.glid = 'OVERPAYMENT_CREDIT'
  where u.glid = 'OVERPAYMENT_USED'""",
    "over_cross": """
  select distinct day, use_tx as tx from over_pairs where use_no = credit_no
  union all
  select distinct day, credit_tx as tx from over_pairs where use_no = credit_no""",
    "over_days": """
  select tx, max(day) as day from (
    select tx, day from over_used union all select tx, day from over_rejected union all select tx, day from over_refund
    union all select tx, day from over_request union all select tx, day from over_payment
    union all select tx, day from over_cross) x group by tx""",
    "open_balances": f"""
  select b.ouid, b.datetimelastmodif, o.mba, o.cba, o.customer_id, {berlin('b.datetimecreate')} as datetimecreate,
    b.transactionid, 'PAYMENT_TRANSACTION' as glid, 'BALANCE' as analyticaxis, b.aggregateid, b.accountingid,
    cast(abs({unit('b.amount')}) as decimal(24,6)) as taxincludedamount, {berlin('b.startdatetime')} as balance_date,
    o.migration_flag
  from billing_account_balance b left join owner o on o.account = b.billingaccountouid
  where b.aggregateid is not null and {berlin('b.datetimecreate')} > {SEEN}""",
    "numbered": """
  select cast(sum(c.taxincludedamount) over (partition by c.transactionid) as decimal(30,2)) as sum_charges,
    c.taxincludedamount, c.transactionid, c.ouid,
    count(*) over (partition by c.transactionid, c.taxincludedamount order by c.ouid) as cnt
  from applied_billing_charge c join due_patterns p on c.glid like p.p where c.aggregateid is null""",
    "cancelled_balances": """
  select amount, transactionid, count(*) over (partition by transactionid, amount order by ouid) as cnt, datetimelastmodif
  from billing_account_balance where status = 'DUE_CANCELLED'""",
    "settled": """
  select n.ouid, x.datetimelastmodif from numbered n join cancelled_balances x on x.transactionid = n.transactionid
  where (x.amount = n.taxincludedamount and x.cnt = n.cnt) or x.amount = n.sum_charges
  union
  select c.ouid, k.datetimecreate from applied_billing_charge c join applied_billing_charge k
    on k.billingaccountouid = c.billingaccountouid and k.customerouid = c.customerouid
    and k.glid like '%_MANUAL_BONUS_CANCELLATION' and abs(k.taxincludedamount) = abs(c.taxincludedamount)
  where c.glid like '%_MANUAL_BONUS'""",
    "kept_runs": "select id, created from ledger_runs where deleted = 0 and no_document = 0",
    "doc_bookings": booking_row(
        {
            "booking_execution_id": "h.run_id",
            "booking_created": f"case when h.run_id is not null then {berlin('r.created')} end",
            "booking_src": "'bbseg'",
            "ba": "h.ba",
            "budat": "h.budat",
            "bukrs": "h.bukrs",
            "beldat": "h.beldat",
            "key": "s.key",
            "gsber": "s.gsber",
            "kostl": "s.kostl",
            "newbk": "s.newbk",
            "prced": "s.prced",
            "sgtxt": "s.sgtxt",
            "vbund": "s.vbund",
            "xstba": "s.xstba",
            "zterm": "s.zterm",
            "zuonr": "s.zuonr",
            "psegment": "s.psegment",
            "wrbed_total": "s.wrbed",
            "aufnr": "s.aufnr",
            "mwskz": "s.mwskz",
            "newbs": "s.newbs",
            "newko": "s.newko",
            "mwskz2": "w.mwskz",
            "xblnr": "s.xblnr",
            "wrbed_aggregate": "w.wrbed",
            "aggregate_id": "w.aggregate_id",
            "amount_calculation": "w.amount_calculation",
        },
        """from ledger_segments s join kept_runs r on r.id = s.run_id
  left join ledger_headers h on h.run_id = s.run_id and h.xblnr = s.xblnr
  left join ledger_raw w on w.run_id = s.run_id and w.xblnr = h.xblnr and w.newko = s.newko and w.newbs = s.newbs
    and w.aggregate_id in (s.agg_1, s.agg_2)""",
    ),
    "doc_tax": tax_row(
        {
            "bbtax_booking_execution_id": "t.run_id",
            "bbtax_booking_created": berlin("r.created"),
            "mwskz": "t.mwskz",
            "newbs": "t.bs",
            "newko": "v.konto",
            "xblnr": "t.xblnr",
            "wrbed": "t.fwste",
            "fwbas": "t.fwbas",
            "aggregate_id": "g.aggregateid",
            "amount_calculation": "'vat.Amount'",
        },
        """from ledger_tax t join kept_runs r on r.id = t.run_id left join vat_codes v on v.code = t.mwskz
  left join tax_aggregate a on cast(a.ouid as varchar) = t.tax_aggregate
  left join charge_aggregate g on g.ouid = a.chargeaggregateouid""",
    ),
    "item_attributes": """
  select journal_entry_items_uuid, max(value) filter (where key = 'gsber' and type <> 'other') as gsber,
    max(value) filter (where key = 'aufnr' and type <> 'other') as aufnr,
    max(value) filter (where key = 'mwskz' and type <> 'other') as mwskz
  from journal_entry_item_account_metadata group by all""",
    "posted": f"""
  select i.uuid as item, i.amount, i.account, e.id as xblnr, e.date as budat,
    least({berlin('s.file_created_at')}, {berlin('s.create_time')}) as booked, {berlin('s.create_time')} as beldat,
    m.gsber, m.aufnr, m.mwskz
  from journal_entry_items i join journal_entries e on e.uuid = i.journal_entries_uuid
  join summaries s on s.uuid = e.summaries_uuid and s.export is true
  left join item_attributes m on m.journal_entry_items_uuid = i.uuid""",
    "journal_rows": booking_row(
        {
            "booking_execution_id": "-1",
            "booking_created": "p.booked",
            "booking_src": "'bbseg'",
            "key": "''",
            "ba": "'ED'",
            "budat": "p.budat",
            "bukrs": "'100'",
            "beldat": "p.beldat",
            "aufnr": "coalesce(p.aufnr, '/')",
            "gsber": "coalesce(p.gsber, '/')",
            "mwskz": "coalesce(p.mwskz, '/')",
            "newbs": "if(p.amount < 0, '50', '40')",
            "newko": "p.account",
            "wrbed_aggregate": german("i.amount"),
            "wrbed_total": german("p.amount"),
            "xblnr": "p.xblnr",
            "xstba": "if(i.tax_index is null, '/', 'X')",
            "aggregate_id": "t.external_reference",
            "amount_calculation": "i.amount_formula",
            "tax_aggregate_ouid": "x.external_reference",
        }
        | dict.fromkeys(["kostl", "newbk", "prced", "sgtxt", "vbund", "zterm", "zuonr", "psegment"], "'/'"),
        """from posted p left join journal_entry_item_sources q on q.journal_entry_items_uuid = p.item
  left join journal_entry_item_source_items i on i.journal_entry_item_sources_uuid = q.uuid
  left join transaction_items t on t.uuid = i.transaction_items_uuid
  left join transaction_item_taxes x on x.uuid = i.transaction_item_taxes_uuid""",
    ),
    "journal_tax": tax_row(
        {
            "bbtax_booking_execution_id": "-1",
            "bbtax_booking_created": "p.booked",
            "mwskz": "coalesce(p.mwskz, '/')",
            "newbs": "if(w.amount < 0, '50', '40')",
            "newko": "v.konto",
            "xblnr": "p.xblnr",
            "wrbed": german("d.amount"),
            "fwbas": german("d.base_amount"),
            "aggregate_id": "t.external_reference",
            "amount_calculation": "d.amount_formula",
        },
        """from posted p join journal_entry_item_taxes w on w.journal_entry_items_uuid = p.item
  join journal_entry_item_tax_sources q on q.journal_entry_item_taxes_uuid = w.uuid
  left join journal_entry_item_tax_source_items d on d.journal_entry_item_tax_sources_uuid = q.uuid
  left join transaction_items t on t.uuid = d.transaction_items_uuid left join vat_codes v on v.code = p.mwskz""",
    ),
    "exported": """
  select e.date as budat, e.id as xbelnr from journal_entries e join summaries s on s.uuid = e.summaries_uuid
  where s.export is true""",
}


def part_open(ledger: str) -> str:
    values = CHARGE_INFO | {
        "due_date": "c.due_date",
        "balance_date": f"""case when c.glid in ('OVERPAYMENT_USED', 'OVERPAYMENT_CREDIT') then o.day
      when c.balance_date is not null then c.balance_date when z.ouid is not null then {berlin('z.datetimelastmodif')}
      when c.accountingid = 'ignored' then {berlin('c.datetimelastmodif')} else k.budat end""",
    }
    inner = list_row(
        values,
        f"""from full_charges c join due_patterns y on c.glid like y.p
  left join {ledger} k on k.aggregate_id = c.aggregateid left join settled z on z.ouid = c.charge
  left join over_days o on o.tx = c.tx where c.can_be_due""",
    )
    return f"""select * from ({inner}) x qualify row_number() over (partition by applied_billing_charge_ouid
    order by due_date nulls last, balance_date nulls last, login_ouid nulls last, customer_id nulls last, mba nulls last,
      bill_id nulls last, write_off_date nulls last, write_off_reason nulls last, datetimelastmodif, amount_gross) = 1"""


# What an indicator of a booking asks for.
INDICATORS = [
    ("TaxIncludedAmount", "gross"),
    ("ac.TaxIncludedAmount", "gross of the charge"),
    ("VATExcludedAmount", "net"),
    ("TaxIncludedAmount - VAT", "gross less VAT"),
    ("VAT", "VAT"),
    ("vat.Amount", "VAT"),
    ("energyTax.Amount", "energy tax"),
    ("GASTAX", "energy tax"),
    ("ELECTRICITYTAX", "energy tax"),
    ("TaxExcludedAmount - energyTax.Amount", "net less energy tax"),
    ("VATExcludedAmount - GASTAX", "net less energy tax"),
    ("VATExcludedAmount - ELECTRICITYTAX", "net less energy tax"),
    ("TaxIncludedAmount - VAT - ENERGYTAX", "net less energy tax"),
    ("TaxIncludedAmount - VAT - ELECTRICITYTAX", "net less energy tax"),
    ("TaxIncludedAmount - VAT - GASTAX", "net less energy tax"),
]

# Amounts with the sign of their aggregate.
NET, GROSS = "n * sn", "g * sg"
LESS_ENERGY = "n * sn - e * st"
ANY_GROSS = "what in ('gross', 'gross of the charge')"
REST = "what = 'net less energy tax'"
DISCOUNT = "c.glid like '%_DISCOUNT_%'"
DISCOUNT_TIME = "bk between date '2021-06-07' and date '2023-01-17'"
BONUS = "c.glid like '%_MANUAL_BONUS' and not can"
BONUS_TIME = "bk between date '2020-11-13' and date '2023-01-12'"
SUBSCRIPTION = "can and c.glid like '%_SUBSCRIPTION_%' and bk <= date '2021-06-07'"

# Rules of the booked amount in their order: (condition, amount).
AMOUNT_RULES = [
    (f"{DISCOUNT} and {DISCOUNT_TIME} and {ANY_GROSS}", NET),
    (f"{DISCOUNT} and {DISCOUNT_TIME} and {REST}", GROSS),
    (f"{DISCOUNT} and not can and bk <= date '2023-01-17' and {ANY_GROSS}", NET),
    (f"{DISCOUNT} and not can and bk <= date '2023-01-17' and {REST}", GROSS),
    (f"{BONUS} and k.newko[1] = '4' and {ANY_GROSS} and bk between date '2020-11-02' and date '2020-11-11'", NET),
    (f"{BONUS} and {BONUS_TIME} and {ANY_GROSS}", NET),
    (f"{BONUS} and {BONUS_TIME} and ({REST} or what = 'net')", GROSS),
    ("contains(c.analyticaxis, 'write-off') and k.newko[1] = '5' and bk <= date '2023-01-01'", NET),
    (f"{SUBSCRIPTION} and {ANY_GROSS}", LESS_ENERGY),
    (f"{SUBSCRIPTION} and {REST}", GROSS),
    (f"c.glid like 'EPILOT_%' and {ANY_GROSS}", "if(taxamount <> 0, g * st, g)"),
    (f"c.glid like 'EPILOT_%' and {REST}", "if(taxamount <> 0, n * st, n)"),
    ("what = 'gross'", GROSS),
    (REST, LESS_ENERGY),
    ("what in ('net', 'gross less VAT')", NET),
    ("what = 'gross of the charge'", GROSS),
    ("what = 'energy tax' and t.tax_aggregate_ouid is not null", "e * link_sign"),
    ("what = 'energy tax'", "abs(e)"),
    ("what = 'VAT' and c.created < date '2021-10-09'", "abs(v)"),
    ("what = 'VAT' and t.tax_aggregate_ouid is not null", "coalesce(link_amount, 0) * link_sign"),
    ("what = 'VAT' and bk < date '2024-01-04'", "abs(v)"),
    ("what = 'VAT'", "v * st"),
]


def part_ruled(ledger: str) -> str:
    """One row per charge, booking and tax row with the amount of the first rule that applies."""
    meanings = "\n      ".join(f"when '{indicator}' then '{meaning}'" for indicator, meaning in INDICATORS)
    rules = "\n      ".join(f"when {condition} then {amount}" for condition, amount in AMOUNT_RULES)
    return f"""
  select c.*, k.booking_execution_id, k.booking_created, k.budat, k.aufnr, k.mwskz, k.newbs, k.newko, k.xblnr,
    k.amount_calculation, k.aggregate_id, t.tax_ouid, t.amount as link_amount, t.tax_total_sign_via_tax_aggregate as link_sign,
    coalesce(net, 0) as n, coalesce(gross, 0) as g, coalesce(taxamount, 0) as v, coalesce(energytaxamount, 0) as e,
    total_sign_taxexcludedamount as sn, total_sign_taxincludedamount as sg, tax_total_aggregate_sign as st,
    case k.amount_calculation {meanings} else 'none' end as what,
    k.booking_created as bk, coalesce(contains(c.analyticaxis, 'cancellation'), false) as can,
    case {rules} else 0 end as ruled_amount
  from full_charges c left join vat_links l on l.charge_ouid = c.charge
  join {ledger} k on k.aggregate_id = c.aggregateid and c.aggregateid <> ''
    and (k.tax_aggregate_ouid is null or l.tax_aggregate_ouid is null or coalesce(k.amount_calculation not in ('VAT', 'vat.Amount'), true)
      or l.tax_aggregate_ouid = k.tax_aggregate_ouid)
  left join tax_rows t on t.tax_aggregate_ouid = k.tax_aggregate_ouid and t.charge_ouid = c.charge"""


def part_booked(ruled: str) -> str:
    renamed = {k: v.replace("k.", "c.") for k, v in (BOOKED_INFO | both_sides("c.ruled_amount")).items()}
    values = (
        CHARGE_INFO
        | renamed
        | {
            "tax_item_ouid": "c.tax_ouid",
            "aggregate_id": "c.aggregateid",
            "accounting_id": "c.accountingid",
            "booking_execution_id": "c.booking_execution_id",
            "booking_created_at": "c.booking_created",
        }
    )
    return list_row(values, f"from {ruled} c", distinct=True)


def part_balances(ledger: str) -> str:
    values = (
        dict.fromkeys(["applied_billing_charge_ouid", "billing_account_ouid", "login_ouid", "tax_item_ouid", "bill_id"], "''")
        | {
            "datetimelastmodif": "b.datetimelastmodif",
            "cba": "b.cba",
            "mba": "b.mba",
            "customer_id": "b.customer_id",
            "glid": "b.glid",
            "analyticaxis": "b.analyticaxis",
            "migration_flag": "b.migration_flag",
            "billing_account_balance_ouid": "b.ouid",
            "date_created": "b.datetimecreate",
            "transaction_id": "b.transactionid",
            "amount_net": "b.taxincludedamount",
            "amount_gross": "b.taxincludedamount",
            "amount_vat": "0",
            "amount_energy_tax": "0",
            "aggregate_id": "b.aggregateid",
            "accounting_id": "b.accountingid",
            "booking_execution_id": "k.booking_execution_id",
            "booking_created_at": "k.beldat",
        }
        | BOOKED_INFO
        | both_sides("if(k.amount_calculation = 'TaxIncludedAmount', abs(coalesce(b.taxincludedamount, 0)), -1)")
    )
    return list_row(values, f"from open_balances b join {ledger} k on k.aggregate_id = b.aggregateid and b.aggregateid <> ''")


def part_taxes(tax: str, headers: str) -> str:
    number = "cast(replace(k.{}, ',', '.') as decimal(20,2))"
    vat, net = number.format("wrbed"), number.format("fwbas")
    empty = ["applied_billing_charge_ouid", "billing_account_ouid", "login_ouid", "customer_id", "transaction_id", "glid", "bill_id"]
    blank = {c: f"coalesce(cast({CHARGE_INFO[c]} as varchar), '')" for c in empty}
    values = (
        CHARGE_INFO
        | blank
        | {
            "amount_net": f"coalesce(c.net, {net})",
            "amount_gross": f"coalesce(c.gross, {net} + {vat})",
            "amount_vat": f"coalesce(c.taxamount, {vat})",
            "amount_energy_tax": "0",
            "aggregate_id": "coalesce(k.aggregate_id, '')",
            "accounting_id": "coalesce(c.accountingid, '')",
            "booking_execution_id": "k.bbtax_booking_execution_id",
            "booking_created_at": "k.bbtax_booking_created",
        }
        | BOOKED_INFO
        | {"booking_date": "h.budat"}
        | both_sides(
            "if(k.amount_calculation in ('VAT', 'vat.Amount'),"
            f" coalesce(c.taxamount * c.tax_total_aggregate_sign, abs({vat})), -1)"
        )
    )
    return list_row(
        values,
        f"""from {tax} k left join full_charges c on c.aggregateid = k.aggregate_id and c.aggregateid <> ''
  join {headers} h on h.xbelnr = k.xblnr where regexp_matches(k.xblnr, '^BR.(TRPC|REBK|CANC|MAN)')""",
        distinct=True,
    )


def part_payments(ledger: str) -> str:
    values = {
        "glid": "'PAS_' || coalesce(s.payment_status, '')",
        "amount_net": "p.amount",
        "amount_gross": "p.amount",
        "amount_vat": "0",
        "aggregate_id": "x.id",
        "booking_created_at": "k.beldat",
        **BOOKED_INFO,
        "booking_mainledger_account": "k.newko",
        **both_sides("p.amount"),
    }
    return list_row(
        values,
        f"""from payment_bookings x join payments p on p.id = x.payment_id join payment_states s on s.id = x.payment_state_id
  join {ledger} k on (k.aggregate_id = x.id and k.beldat <= date '2024-01-31')
    or (k.xblnr = x.sap_id and k.beldat >= date '2024-01-31')""",
        distinct=True,
    )


def balanced_list(rows: str) -> str:
    columns = ", ".join(c if c != "booking_debit_amount" else "fixed as booking_debit_amount" for c in LIST)
    return f"""select {columns} from (
    select r.*, cast(case when r.booking_amount_indicator = 'VATExcludedAmount - ELECTRICITYTAX' and r.booking_debit_amount < 0
      and r.aggregate_id in (select aggregate_id from {rows} where aggregate_id is not null group by 1
        having sum(booking_debit_amount) <> sum(booking_credit_amount))
      then -r.booking_debit_amount else r.booking_debit_amount end as decimal(20,2)) as fixed from {rows} r) x"""


PARTS |= {
    "doc_heads": "select h.budat, h.xblnr as xbelnr from ledger_headers h join kept_runs r on r.id = h.run_id",
    "ruled_journal": part_ruled("journal_rows"),
    "ruled_docs": part_ruled("doc_bookings"),
    "balance_list": part_balances("journal_rows"),
    "balance_and_payment_list": f"select * from ({part_balances('journal_rows')}) x union all select * from ({part_payments('journal_rows')}) y",
}
for _suffix, _ledger, _tax, _heads, _ruled in (
    ("journal", "journal_rows", "journal_tax", "exported", "ruled_journal"),
    ("docs", "doc_bookings", "doc_tax", "doc_heads", "ruled_docs"),
):
    PARTS[f"list_{_suffix}"] = "\n  union all\n  ".join(
        f"select * from ({text}) part{i}"
        for i, text in enumerate(
            [
                part_open(_ledger),
                part_booked(_ruled),
                part_balances(_ledger),
                part_taxes(_tax, _heads),
                part_payments(_ledger),
            ]
        )
    )

_OLDER = "ouid % 5 = 0"
PARTS |= {
    "old_charge": f"""
  select * replace (case when {_OLDER} then datetimelastmodif - interval 1 day else datetimelastmodif end as datetimelastmodif,
    cast(case when {_OLDER} then taxincludedamount + 1 else taxincludedamount end as decimal(20,2)) as taxincludedamount)
  from applied_billing_charge where ouid % 7 <> 0
  union all
  select * replace (-ouid as ouid, case when {_OLDER} then datetimelastmodif - interval 1 day else datetimelastmodif end as datetimelastmodif,
    cast(case when {_OLDER} then taxincludedamount + 1 else taxincludedamount end as decimal(20,2)) as taxincludedamount)
  from applied_billing_charge where ouid % 7 <> 0 and ouid % 13 = 0""",
    "prints": """
  select ouid, md5(coalesce(cast(datetimelastmodif as varchar), chr(0)) || chr(31) || coalesce(aggregateid, chr(0))) as hash
  from applied_billing_charge""",
    "old_prints": """
  select ouid, md5(coalesce(cast(datetimelastmodif as varchar), chr(0)) || chr(31) || coalesce(aggregateid, chr(0))) as hash
  from old_charge""",
    "new_charges": "select distinct ouid from prints p where not exists (select 1 from old_prints o where o.ouid = p.ouid and o.hash = p.hash)",
    "new_logins": """
  select ouid, customerouid, md5(externalid) as hash from login where customerouid > 0 and ouid % 11 = 0
    and externalid <> 'old'""",
    "new_taxes": """
  select ouid, appliedbillingchargeouid from applied_billing_tax_rate where datetimelastmodif >=
    (select min(datetimelastmodif) from applied_billing_tax_rate where datetimelastmodif >= timestamp '2024-06-01')""",
    # all columns of the present and the earlier rows of a source, and the keys of rows that only one side has
    "old_logins": """
  select ouid, customerouid, case when ouid % 11 = 0 then 'old' else externalid end as externalid from login
  union all select -ouid, customerouid + 7, case when ouid % 11 = 0 then 'old' else externalid end from login where ouid % 17 = 0""",
    "old_taxes": """
  select ouid, appliedbillingchargeouid, taxcategory, amount from applied_billing_tax_rate where datetimelastmodif < timestamp '2024-06-01'
  union all select -ouid, appliedbillingchargeouid, taxcategory, amount from applied_billing_tax_rate
    where datetimelastmodif < timestamp '2024-06-01' and ouid % 19 = 0""",
    "old_requests": """
  select ouid, transactionid, case when ouid % 12 = 0 then daterequest - interval 1 day else daterequest end as daterequest from payment_request
  union all select -ouid, transactionid, case when ouid % 12 = 0 then daterequest - interval 1 day else daterequest end
    from payment_request where ouid % 21 = 0""",
    "moved_charges": """
  select ouid from ((select * from applied_billing_charge except all select * from old_charge)
    union all (select * from old_charge except all select * from applied_billing_charge)) x""",
    "moved_accounts": "select ouid from billing_account where ouid % 10 = 9",
    "moved_customers": """
  select customerouid from ((select ouid, customerouid, externalid from login except all select * from old_logins)
    union all (select * from old_logins except all select ouid, customerouid, externalid from login)) x""",
    "moved_taxes": """
  select appliedbillingchargeouid as ouid from (
    (select appliedbillingchargeouid, taxcategory, amount from applied_billing_tax_rate
      except all select appliedbillingchargeouid, taxcategory, amount from old_taxes)
    union all (select appliedbillingchargeouid, taxcategory, amount from old_taxes
      except all select appliedbillingchargeouid, taxcategory, amount from applied_billing_tax_rate)) x""",
    "moved_requests": """
  select transactionid from ((select transactionid, daterequest from payment_request except all select transactionid, daterequest from old_requests)
    union all (select transactionid, daterequest from old_requests except all select transactionid, daterequest from payment_request)) x""",
    "moved_notes": "select ouid from settlement_note_advice where ouid % 15 = 0",
    "touched": """
  select ouid from moved_charges
  union select c.ouid from applied_billing_charge c join moved_accounts a on a.ouid = c.billingaccountouid
  union select c.ouid from applied_billing_charge c join billing_account a on a.ouid = c.billingaccountouid
    join moved_customers m on m.customerouid = a.customerouid
  union select ouid from moved_taxes
  union select c.ouid from applied_billing_charge c join moved_requests r on r.transactionid = c.transactionid
  union select c.ouid from applied_billing_charge c join moved_notes n on n.ouid = c.settlementnoteadviceouid""",
    "extract": f"""
  select c.ouid as applied_billing_charge_ouid, a.ouid as billing_account_ouid, l.ouid as login_ouid, c.datetimelastmodif,
    a.name as billing_account, l.externalid as customer_id, {berlin('c.datetimecreate')} as datetimecreate, c.transactionid,
    c.glid, c.analyticaxis, c.aggregateid, c.accountingid,
    cast(abs({unit('c.taxexcludedamount')}) as decimal(24,6)) as taxexcludedamount,
    cast(abs({unit('c.taxincludedamount')}) as decimal(24,6)) as taxincludedamount,
    {berlin('coalesce(q.daterequest, c.datetimecreate)')} as due_date, s.id as bill_id, x.taxamount, x.energytaxamount
  from applied_billing_charge c left join billing_account a on a.ouid = c.billingaccountouid
  left join login l on l.customerouid = a.customerouid left join payment_request q on q.transactionid = c.transactionid
  left join settlement_note_advice s on s.ouid = c.settlementnoteadviceouid
  left join (select appliedbillingchargeouid,
      cast(sum(abs({unit('amount')})) filter (where taxcategory = 'VAT') as decimal(24,6)) as taxamount,
      cast(sum(abs({unit('amount')})) filter (where taxcategory <> 'VAT') as decimal(24,6)) as energytaxamount
    from applied_billing_tax_rate group by 1) x on x.appliedbillingchargeouid = c.ouid
  where {berlin('c.datetimecreate')} > {SEEN}""",
}

_FIRST = "row_number() over (partition by {} order by {}) = 1"
_DUE = "select src, tx as transactionid, due as due_date from {}"
_CENTS = "cast(round({} * 100) as bigint)"
_PATTERNS = "('%ring','%',1), ('small%','%',2), ('%bolt','Brand#1%',3), ('%o%','Brand#_',4), ('red widget','%',5)"
_CHARGE_NAMES = (
    "charge as applied_billing_charge_ouid, account as billing_account_ouid, login_ouid, datetimelastmodif, mba, cba,"
    " customer_id, created as datetimecreate, tx as transactionid, glid, analyticaxis, aggregateid, accountingid,"
    " net as taxexcludedamount, gross as taxincludedamount, due_date, bill_id, balance_date, write_off_date,"
    " write_off_reason, write_off_note, dunning_lock_until, dunning_lock_reason, dunning_status, dunning_scenario,"
    " dunning_level, migration_flag"
)


def _days(part: str) -> str:
    return f"select day as fully_used_at, tx as transactionid from {part}"


STATEMENTS: dict[str, str] = {
    "latest_event_per_user": f"""select user_id, event_id, event_type, ts from events
  qualify {_FIRST.format('user_id', 'ts desc nulls first, event_id desc nulls first')}""",
    "top_row_per_order": f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
  qualify {_FIRST.format('l_orderkey', 'l_extendedprice desc, l_linenumber desc, l_partkey desc, l_suppkey desc')}""",
    "pattern_join_parts": f"""select p_partkey, p_name, p_brand, a as pattern
  from part join (values {_PATTERNS}) t(a, b, i) on p_name like a and p_brand like b""",
    "pattern_match_once": f"""select p_partkey, p_name, p_brand, a as pattern
  from part join (values {_PATTERNS}) t(a, b, i) on p_name like a and p_brand like b
  qualify {_FIRST.format('p_partkey', 'i')}""",
    "update_from_orders": """select c_custkey, case when o.k is null then c_mktsegment else o.p end as c_mktsegment
  from customer left join (select o_custkey as k, min(case when o_custkey % 3 <> 0 then o_orderpriority end) as p
    from orders group by 1) o on o.k = c_custkey""",
    "fill_if_null": """select c_custkey, coalesce(case when c_acctbal > 0 then c_mktsegment end, p) as segment
  from customer left join (select o_custkey as k, min(o_orderpriority) as p from orders group by 1) o on o.k = c_custkey""",
    "conditional_update": """select o_orderkey, if(o_orderstatus <> 'P' and o_orderpriority = '1-URGENT', 'U', o_orderstatus)
    as o_orderstatus, o_orderpriority from orders""",
    "delete_where": "select event_id, event_type from events where event_type not in ('error', 'view')",
    "anti_join": """select o_orderkey, o_custkey from orders
  where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""",
    "semi_join": """select o_orderkey, o_custkey from orders
  where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""",
    "full_outer_merge": """select coalesce(a.p, b.p) as person, n_orders, n_events
  from (select o_custkey as p, count(*) as n_orders from orders group by 1) a
  full join (select user_id * 2 as p, count(*) as n_events from events group by 1) b
    on a.p = b.p""",
    "hour_join": """select a.event_id, b.event_id as later_id, a.user_id, date_trunc('hour', a.ts) as hour
  from events a join events b on a.user_id = b.user_id and date_trunc('hour', a.ts) = date_trunc('hour', b.ts)
  where a.event_id < b.event_id""",
    "abs_join": f"""select a.l_orderkey, a.l_partkey, a.l_suppkey, b.o as other_order, -{_CENTS.format('a.l_extendedprice')} as paid
  from lineitem a join (select distinct l_orderkey as o, {_CENTS.format('l_extendedprice')} as price from lineitem) b
    on abs(-{_CENTS.format('a.l_extendedprice')}) = abs(b.price)""",
    "running_numbers": """select event_id, user_id, event_type,
    row_number() over (partition by event_type order by user_id, event_id) as number from events""",
    "running_occurrences": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as integer) as quantity,
    count(*) over (partition by l_linenumber order by cast(l_quantity as integer)) as cnt from lineitem""",
    "partition_total": f"""select o_orderkey, o_custkey, {_CENTS.format('o_totalprice')} as cents,
    cast(sum({_CENTS.format('o_totalprice')}) over (partition by o_custkey) as bigint) as total from orders""",
    "having_imbalance": f"""select o_custkey,
    cast(sum({_CENTS.format('o_totalprice')}) filter (where o_orderstatus = 'F') as bigint) as debit,
    cast(sum({_CENTS.format('o_totalprice')}) filter (where o_orderstatus = 'O') as bigint) as credit
  from orders group by 1 having debit <> credit""",
    "count_distinct_having": """select l_orderkey, count(distinct l_returnflag) as n_flags, count(*) as n_lines
  from lineitem group by 1 having count(distinct l_returnflag) > 1""",
    "union_distinct": """select l_orderkey as orderkey from lineitem where l_tax = 0
  union select l_orderkey from lineitem where l_discount = 0 union select o_orderkey from orders where o_orderstatus = 'P'""",
    "except_all": """select l_orderkey, l_returnflag from lineitem
  except all select l_orderkey, l_returnflag from lineitem where l_linestatus = 'O'""",
    "german_decimals": """select l_orderkey, l_partkey, l_suppkey,
    replace(cast(cast(l_extendedprice as decimal(20,2)) as varchar), '.', ',') as text,
    cast(l_extendedprice as decimal(20,2)) as value from lineitem""",
    "berlin_dates": f"select event_id, {berlin('ts')} as day from events",
    "german_dates": "select o_orderkey, case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) end as day from orders",
    "safe_ids": "select event_id, case when event_type <> 'click' then event_id end as parsed from events",
    "inverted_signs": f"""select ouid, if(regexp_full_match(glid, '{INVERTED}'), -1, 1) as sign,
    regexp_full_match(glid, '{INVERTED}') as inverted, cast({unit('taxincludedamount')} as decimal(24,6)) as gross
  from applied_billing_charge""",
    "json_attributes": """select event_id, cast(json_extract(props, '$.k') as bigint) as k,
    cast(null as varchar) as missing from events""",
    "comma_lists": "select p_partkey, unnest(string_split(p_name, ' ')) as word from part",
    "md5_fingerprints": """select event_id, md5(cast(event_id as varchar) || chr(31) || if(event_type = 'view', chr(0), event_type)
    || chr(31) || props) as hash, 'x' || if(event_type = 'view', '', event_type) as joined from events""",
    "account_map": "select mba, cba, migration_flag from hierarchy",
    "balance_dates": "select tx as transactionid, balanced as balance_date, due as due_date from tx_dates",
    "original_due_dates": _DUE.format("first_due"),
    "reject_edges": "select tx as transactionid, parent as original_transactionid from rejections",
    "propagate_due_dates": _DUE.format("spread_due"),
    "override_request_due": _DUE.format("due_1"),
    "override_partial_due": _DUE.format("due_2"),
    "due_overrides": _DUE.format("due_3"),
    "balance_due_dates": "select tx as transactionid, balanced as balance_date, due as due_date from tx_due",
    "split_status": "select tx as transactionid, n, statuses from mixed",
    "split_charge_dates": """select charge as charge_ouid, status, tx as transactionid, balanced as balance_date, due as due_date
  from mixed_dates""",
    "charge_balance_dates": """select charge as charge_ouid, status, tx as transactionid, balanced as balance_date,
    due as due_date from charge_dates""",
    "charge_due_dates": "select charge as charge_ouid, tx as transactionid, due as due_date from charge_due",
    "migrated_bill_due": f"""select transactionid, {berlin('daterequest')} as due_date from payment_request
  where bpmeventname = 'migrated' qualify {_FIRST.format('transactionid', 'datetimelastmodif nulls last, ouid')}""",
    "latest_case": "select id, created_at, mba, status from case_now",
    "active_locks": "select mba, until as dunning_lock_until, reason as dunning_lock_reason, deleted from lock_now",
    "case_lock_merge": """select mba, id, created_at, status, until as dunning_lock_until, reason as dunning_lock_reason
  from case_or_lock""",
    "dunning_state": """select mba, dunning_level, scenario as dunning_scenario, claim as status, dunning_status,
    until as dunning_lock_until, reason as dunning_lock_reason, cast(1 as bigint) as rnk from dunned""",
    "write_offs": """select day as write_off_date, reason as write_off_reason, note as write_off_note, charge as charge_ouid
  from written_off""",
    "base_charges": f"select {_CHARGE_NAMES}, true as can_be_due from base",
    "can_be_due": """select ouid, glid, analyticaxis, case when analyticaxis = 'cancellation' then false
    when analyticaxis = 'special' and glid = 'ELEC_MANUAL_BONUS' then false else true end as can_be_due
  from applied_billing_charge""",
    "filled_bill_ids": """select c.ouid, c.transactionid, if(c.ouid % 2 = 0, 'known', f.bill) as bill_id
  from applied_billing_charge c left join found_bills f on f.tx = c.transactionid""",
    "aggregate_signs": """select aggregateid, total_sign, total_sign_taxincludedamount, total_sign_taxexcludedamount
  from signs""",
    "charge_taxes": "select appliedbillingchargeouid, taxamount, energytaxamount from taxes",
    "charges": f"""select {_CHARGE_NAMES}, can_be_due, appliedbillingchargeouid, taxamount, energytaxamount,
    tax_total_aggregate_sign, total_sign_taxincludedamount, total_sign_taxexcludedamount from full_charges""",
    "tax_amounts": "select * from tax_rows",
    "charge_tax_link": "select * from vat_links",
    "overpayment_used": _days("over_used"),
    "overpayment_rejected": _days("over_rejected"),
    "overpayment_refund_cancelled": _days("over_refund"),
    "overpayment_request_rejected": _days("over_request"),
    "overpayment_payment_cancelled": _days("over_payment"),
    "overpayment_cross_match": _days("over_cross"),
    "overpayment_dates": _days("over_days"),
    "balances": "select * from open_balances",
    "numbered_due_charges": "select * from numbered",
    "numbered_due_charges_once": """select
    cast(sum(taxincludedamount) over (partition by transactionid) as decimal(30,2)) as sum_charges, taxincludedamount,
    transactionid, ouid, row_number() over (partition by transactionid, taxincludedamount order by ouid) as cnt
  from applied_billing_charge c
  where aggregateid is null and exists (select 1 from due_patterns where c.glid like p)""",
    "numbered_cancelled_balances": "select * from cancelled_balances",
    "due_cancelled_charges": "select * from settled",
    "json_segments": f"""select run_id as bseg_booking_execution_id, {berlin('created')} as bseg_booking_created, key, aufnr, gsber, kostl, mwskz,
    newbk, newbs, newko, prced, sgtxt, vbund, wrbed, xblnr, xstba, zterm, zuonr, psegment, agg_1 || coalesce(',' || agg_2, '') as related from ledger_segments join kept_runs on id = run_id""",
    "json_headers": f"""select ba, budat, bukrs, xblnr as xbelnr, beldat, run_id as booking_execution_id,
    {berlin('created')} as booking_created from ledger_headers join kept_runs on id = run_id""",
    "json_raw_segments": """select wrbed, xblnr as xbelnr, newbs, newko, mwskz as mwskz2, amount_calculation, aggregate_id,
    run_id as booking_execution_id from ledger_raw join kept_runs on id = run_id""",
    "json_tax_bookings": "select * from doc_tax",
    "json_bookings": "select * from doc_bookings",
    "account_metadata": "select * from item_attributes",
    "journal_bookings": "select * from journal_rows",
    "journal_tax_bookings": "select * from journal_tax",
    "journal_headers": """select cast(null as varchar) as ba, budat, cast(null as varchar) as bukrs, xbelnr,
    cast(null as date) as beldat, cast(null as bigint) as booking_execution_id, cast(null as date) as booking_created
  from exported""",
    "open_items": part_open("journal_rows"),
    "booked_charges": part_booked("ruled_journal"),
    "booked_charges_from_documents": part_booked("ruled_docs"),
    "booked_balances": "select * from balance_list",
    "booked_taxes": part_taxes("journal_tax", "exported"),
    "payment_bookings": part_payments("journal_rows"),
    "fix_imbalance": balanced_list("balance_and_payment_list"),
    "open_item_list": balanced_list("list_journal"),
    "customer_view": f"""select {', '.join(c for c in LIST if c not in HIDDEN)} from ({balanced_list('list_docs')}) whole""",
    "row_fingerprints": "select * from prints",
    "changed_keys": "select * from new_charges",
    "changed_rows": "select * from new_logins",
    "changed_since": "select * from new_taxes",
    "affected_charges": "select * from touched",
    "signed_changes": """
  select ouid, case when not exists (select 1 from old_charge o where o.ouid = m.ouid) then 'added'
    when not exists (select 1 from applied_billing_charge c where c.ouid = m.ouid) then 'removed' else 'changed' end as change
  from (select distinct ouid from moved_charges) m""",
    "incremental_list": balanced_list("list_journal"),
    "recompute_affected": "select * from extract where applied_billing_charge_ouid in (select ouid from touched)",
    "incremental_equals_full": "select * from extract",
    "advance_snapshot": "select * from prints",
    "incremental_bookings": """select b.*, s.run_id as source_run from (select row_number() over () as r, * from doc_bookings) b
  join ledger_segments s on false""",
    "csv_round_trip": "select * from lineitem",
    "bucket_replace": "select * from orders",
    "published_list": f"""select {', '.join(c for c in LIST if c not in HIDDEN)} from ({part_payments("journal_rows")}) payments""",
    "missing_source": f"""select a.ouid as account_ouid, l.ouid as login_ouid, l.externalid as customer_id,
    coalesce(m.name, a.name) as mba, case when m.ouid is not null then a.name end as cba,
    coalesce({attr('a.characteristics', 'migrationFlag')}, {attr('m.characteristics', 'migrationFlag')}) as migration_flag,
    cast(null as date) as dunning_lock_until, cast(null as varchar) as dunning_lock_reason, cast(null as varchar) as dunning_status,
    cast(null as varchar) as dunning_scenario, cast(null as integer) as dunning_level
  from billing_account a left join login l on l.customerouid = a.customerouid
  left join billing_account_relationship r on r.billingaccountouid = a.ouid
  left join billing_account m on m.ouid = r.targetbillingaccountouid""",
    "malformed_runs": "select id as booking_execution_id, created as booking_created from kept_runs where id % 41 = 0",
    "chunk_rows": """select cast((n - 1) // 10000 as bigint) as chunk, count(*) as n_rows
  from (select row_number() over () as n from lineitem) x group by 1""",
}

_RUN_ROW = PARTS["doc_bookings"].replace(" from ledger_segments s", ', s.run_id as source_run from ledger_segments s', 1)
STATEMENTS["incremental_bookings"] = _RUN_ROW

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def _needed(text: str, seen: dict[str, None], own: str | None = None) -> None:
    for word in _WORD.findall(text):
        if word in PARTS and word not in seen and word != own:
            _needed(PARTS[word], seen, word)
            seen[word] = None


def statement(name: str) -> str:
    """The full SQL of a query with all the parts it uses."""
    seen: dict[str, None] = {}
    _needed(STATEMENTS[name], seen)
    if not seen:
        return STATEMENTS[name]
    parts = ",\n".join(f"{part} as materialized ({PARTS[part]})" for part in seen if part != "walk")
    if "walk" in seen:
        order = [part for part in seen]
        parts = ",\n".join(
            f"{part} as ({PARTS[part]})" if part == "walk" else f"{part} as materialized ({PARTS[part]})" for part in order
        )
    return f"with recursive {parts}\n{STATEMENTS[name]}"


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in STATEMENTS}
