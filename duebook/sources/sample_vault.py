"""Source tables derived from the generated star-schema tables.

The mapping is plain SQL so that the same text serves Spark and an independent
engine checking the results.  Keys and amounts use only exact arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.session import materialize
from duebook.sources.documents import SEGMENT_FIELDS
from duebook.sources.vault import Vault, schema_of

RAW_TABLES = ["customer", "orders", "lineitem", "events"]

_LINE = """
  select ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey as ouid,
    l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_extendedprice, l_tax, l_discount,
    o_custkey, (l_partkey * 7 + l_linenumber) % 16 as kind,
    case when l_partkey % 11 = 0 then -1 else 1 end as side,
    cast(case when l_suppkey % 2 = 0 then round(l_quantity) * 1000 else round(l_extendedprice * 100) end
      as decimal(20,2)) as gross,
    cast(case when l_suppkey % 2 = 0 then round(l_quantity) * 840 else round(l_extendedprice * 84) end
      as decimal(20,2)) as net,
    l_shipdate + interval 8400 days + interval 1 hour * (l_partkey % 24) as created,
    o_orderdate + interval 8400 days as ordered
  from {lineitem} join {orders} on o_orderkey = l_orderkey
"""

_PREFIX = (
    "case o_orderkey % 5 when 0 then 'BR_TRPC-' when 1 then 'BR_REBK-' when 2 then 'BR_CANC-'"
    " when 3 then 'BR_MAN-' else 'BR_OTHER-' end"
)
_LINE_PREFIX = _PREFIX.replace("o_orderkey", "l_orderkey")
# a run may hold a second document, whose number other runs use as well
_SHARED = "concat('BR_TRPC-S', cast({key} - {key} % 8 as string))"
_DOCUMENT = f"case when second = 1 then {_SHARED.format(key='o_orderkey')} else concat({_PREFIX}, cast(o_orderkey as string)) end"
_LINE_DOCUMENT = (
    f"case when l_orderkey % 3 <> 1 and l_partkey % 2 = 0 then {_SHARED.format(key='l_orderkey')}"
    f" else concat({_LINE_PREFIX}, cast(l_orderkey as string)) end"
)
_INDICATOR = """case l_linenumber + (l_suppkey % 8)
  when 1 then 'TaxIncludedAmount' when 2 then 'VAT' when 3 then 'TaxExcludedAmount - energyTax.Amount'
  when 4 then 'ELECTRICITYTAX' when 5 then 'ac.TaxIncludedAmount' when 6 then 'VATExcludedAmount - ELECTRICITYTAX'
  when 7 then 'vat.Amount' when 8 then 'energyTax.Amount' when 9 then 'VATExcludedAmount'
  when 10 then 'TaxIncludedAmount - VAT' when 11 then 'VATExcludedAmount - GASTAX' when 12 then 'TaxIncludedAmount'
  else 'UNKNOWN' end"""

# Flat ledger rows that the JSON documents of the booking runs are built from.
LEDGER_ROWS: dict[str, str] = {
    "ledger_runs": """
  select o_orderkey as id, o_orderdate + interval 8460 days as created,
    case when o_orderkey % 29 = 0 then 1 else 0 end as deleted,
    case when o_orderkey % 31 = 0 then 1 else 0 end as no_document
  from {orders}""",
    "ledger_segments": f"""
  select o_orderkey as run_id, bs as newbs, {_DOCUMENT} as xblnr,
    case when bs = '40' or o_orderkey % 3 = 1 then '4000' when o_orderkey % 3 = 0 then '5000' else null end as newko,
    case o_orderkey % 4 when 0 then '11' when 1 then '1A' when 2 then '5W' else 'ZZ' end as mwskz,
    concat('F', cast(o_orderkey % 7 as string)) as aufnr,
    concat('K', cast(o_orderkey % 9 as string)) as key,
    case when o_orderkey % 5 = 0 then '/' else concat('G', cast(o_orderkey % 5 as string)) end as gsber,
    case when o_orderkey % 6 = 0 then null else concat('C', cast(o_orderkey % 6 as string)) end as kostl,
    case when second = 1 then '200' else '100' end as newbk,
    concat('R', cast(o_orderkey % 8 as string)) as prced, concat('order, "', cast(o_orderkey as string), '"') as sgtxt,
    case when o_orderkey % 10 = 0 then concat('V', cast(o_orderkey as string)) end as vbund,
    replace(cast(cast(cast(round(o_totalprice * 50) as decimal(20,2)) * 0.01 as decimal(20,2)) as string), '.', ',') as wrbed,
    case when o_orderkey % 2 = 0 then 'X' else '/' end as xstba, concat('T', cast(o_orderkey % 12 as string)) as zterm,
    concat('A', cast(o_orderkey as string), bs) as zuonr, case when second = 1 then 'S' end as psegment,
    concat('A', cast(o_orderkey as string)) as agg_1,
    case when o_orderkey % 6 = 0 then null else concat('A', cast(o_orderkey + 1 as string)) end as agg_2
  from {{orders}} join (select '40' as bs union all select '50' as bs) sides on true
    join (select 0 as second union all select 1 as second) documents on second = 0 or o_orderkey % 3 <> 1""",
    "ledger_headers": f"""
  select o_orderkey as run_id, {_DOCUMENT} as xblnr, 'ED' as ba, '100' as bukrs,
    cast(o_orderdate + interval 8462 days + interval 1 day * second as date) as budat,
    cast(o_orderdate + interval 8461 days as date) as beldat
  from {{orders}} join (select 0 as second union all select 1 as second) documents on second = 0 or o_orderkey % 6 in (0, 2, 3)
  where o_orderkey % 17 <> 0""",
    "ledger_raw": f"""
  select l_orderkey as run_id, l_linenumber, l_partkey, l_suppkey,
    {_LINE_DOCUMENT} as xblnr,
    case when l_linenumber % 2 = 0 then '40' else '50' end as newbs,
    case when l_linenumber % 2 = 0 then case when l_suppkey % 5 = 0 then '4100' else '4000' end when l_orderkey % 3 = 0 then '5000' when l_orderkey % 3 = 1 then '4000' else null end as newko,
    case when l_suppkey % 3 = 0 then '/' else '11' end as mwskz,
    {_INDICATOR} as amount_calculation,
    case when l_linenumber % 5 = 0 then concat('A', cast(l_orderkey + 2 as string))
      else concat('A', cast(l_orderkey as string)) end as aggregate_id,
    replace(cast(cast(cast(round(l_extendedprice * 100) as decimal(20,2)) * 0.01 as decimal(20,2)) as string), '.', ',')
      as wrbed
  from {{lineitem}}""",
    "ledger_tax": f"""
  select l_orderkey as run_id, l_linenumber, l_partkey, l_suppkey,
    {_LINE_DOCUMENT} as xblnr,
    case when l_linenumber % 2 = 0 then '40' else '50' end as bs,
    case l_suppkey % 4 when 0 then '11' when 1 then '2B' when 2 then '8A' else 'ZZ' end as mwskz,
    replace(cast(cast(cast(round(l_extendedprice * l_tax * 100) as decimal(20,2)) * 0.01 as decimal(20,2)) as string),
      '.', ',') as fwste,
    replace(cast(cast(cast(round(l_extendedprice * 100) as decimal(20,2)) * 0.01 as decimal(20,2)) as string), '.', ',')
      as fwbas,
    case when l_suppkey % 5 = 0 then null else cast(l_orderkey * 10 + 1 + l_linenumber % 2 as string) end
      as tax_aggregate
  from {{lineitem}} where l_linenumber % 3 = 1""",
}

TABLES: dict[str, str] = {
    "applied_billing_charge": f"""
  select ouid, o_custkey as billingaccountouid, o_custkey as customerouid,
    case when (l_partkey + l_linenumber) % 3 = 0 then null else l_orderkey end as settlementnoteadviceouid,
    concat('T', cast(l_orderkey as string)) as transactionid,
    case kind when 0 then 'ELEC_ABSCHLAG' when 1 then 'GAS_BILL' when 2 then 'ELEC_MANUAL_BONUS'
      when 3 then 'OVERPAYMENT_CREDIT' when 4 then 'OVERPAYMENT_USED' when 5 then 'ELEC_MANUAL_BILL'
      when 6 then 'ELEC_MANUAL_CONSUMPTION' when 7 then 'ELEC_MANUAL_BONUS_REFUND' when 8 then 'ELEC_DISCOUNT_NEW'
      when 9 then 'EPILOT_SOLAR_LEASE_PAY' when 10 then 'GAS_SUBSCRIPTION_BASE' when 11 then 'DUNNING_FEE'
      when 12 then 'ELEC_CANCELLATION_BALANCE' when 13 then 'ELEC_MANUAL_BONUS_CANCELLATION'
      when 14 then 'GAS_BILL_MIGRATION'
      else case when l_suppkey % 2 = 0 then 'OVERPAYMENT_CREDIT_REJECTED' else 'OVERPAYMENT_REFUND_CANCEL' end
      end as glid,
    case when l_returnflag = 'R' then case when l_suppkey % 2 = 0 then 'cancellation' else 'write-off' end
      when l_returnflag = 'N' then case when l_suppkey % 2 = 0 then 'special' else 'regular' end end as analyticaxis,
    case when l_linenumber % 4 = 0 then null when l_orderkey % 50 = 0 then ''
      else concat('A', cast(l_orderkey as string)) end as aggregateid,
    case when l_suppkey % 9 = 0 then 'ignored' when l_suppkey % 9 = 1 then null
      else concat('K', cast(l_suppkey as string)) end as accountingid,
    net * side as taxexcludedamount, gross * side as taxincludedamount,
    created as datetimecreate, created + interval 1 day * (l_suppkey % 30) as datetimelastmodif,
    ordered as startdatetime, ordered + interval 30 days as enddatetime,
    concat('P', cast(l_partkey % 20 as string)) as productname,
    case when l_orderkey % 32 between 1 and 7
        then concat('{{{{"rejectedChargeTransactionId":"T', cast(l_orderkey - 1 as string), '"}}}}')
      when l_orderkey % 32 = 9
        then concat('{{{{"rejectedChargeTransactionId":"X', cast(l_orderkey as string), '"}}}}')
      when l_orderkey % 32 = 12 and l_linenumber % 2 = 1
        then concat('{{{{"rejectedChargeTransactionId":"T', cast(l_orderkey - 1 as string), '"}}}}')
      when l_orderkey % 32 in (20, 22)
        then concat('{{{{"partiallyPaidChargeTransactionId":"T', cast(l_orderkey - 4 as string), '"}}}}')
      when l_orderkey % 32 = 23
        then concat('{{{{"rejectedChargeTransactionId":"T', cast(l_orderkey - 1 as string), '"}}}}')
      when kind = 15
        then concat('{{{{"rejectedChargeTransactionId":"T', cast(l_orderkey - 2 as string), '"}}}}')
      when l_partkey % 3 = 0 then null else '{{{{"k":1}}}}' end as characteristics
  from ({_LINE}) line""",
    "billing_account": """
  select c_custkey as ouid, concat('B', cast(c_custkey as string)) as name, c_custkey as customerouid,
    cast('2023-01-01 00:00:00' as timestamp) + interval 1 hour * (c_custkey % 5000) as datetimelastmodif,
    case c_custkey % 3 when 0 then concat('{{"migrationFlag":"m', cast(c_custkey % 4 as string), '"}}')
      when 1 then '{{}}' end as characteristics
  from {customer}""",
    "billing_account_relationship": """
  select c_custkey as billingaccountouid, c_custkey - c_custkey % 10 as targetbillingaccountouid
  from {customer} where c_custkey % 10 <> 0""",
    "login": """
  select 100000000 + c_custkey as ouid, c_custkey as customerouid, c_name as externalid
  from {customer} where c_custkey % 7 <> 0
  union all
  select 200000000 + c_custkey as ouid, c_custkey as customerouid, concat(c_name, '-2') as externalid
  from {customer} where c_custkey % 50 = 1""",
    "billing_account_balance": f"""
  select ouid * 2 + 1 as ouid, concat('T', cast(l_orderkey as string)) as transactionid,
    case when l_linestatus = 'O' then 'DUE' when l_returnflag = 'R' then 'DUE_LETTERED'
      when l_returnflag = 'A' then 'DUE_CANCELLED' else 'PAID' end as status,
    gross * side + case when l_suppkey % 8 = 0 then 1 else 0 end as amount,
    o_custkey as billingaccountouid,
    case l_linenumber % 4 when 1 then concat('A', cast(l_orderkey as string)) when 2 then '' end as aggregateid,
    case when l_suppkey % 9 = 0 then 'ignored' else concat('K', cast(l_suppkey as string)) end as accountingid,
    case when l_suppkey % 3 = 0 then created + interval 10 days end as letteringdate,
    created + interval 14 days + interval 30 minutes as startdatetime,
    created + interval 1 hour as datetimecreate, created + interval 12 days as datetimelastmodif
  from ({_LINE}) line""",
    "payment_request": """
  select twin * 1000000000 + o_orderkey as ouid, concat('T', cast(o_orderkey as string)) as transactionid,
    case o_orderpriority when '1-URGENT' then 'REJECTED' when '2-HIGH' then 'CANCELLED' else 'DONE' end as status,
    case when o_orderkey % 6 = 0 then 'migrated' else 'direct' end as bpmeventname,
    case when o_orderkey % 13 = 0 then null
      else o_orderdate + interval 8400 days + interval 1 hour * (o_orderkey % 24) + interval 1 day * twin end
      as daterequest,
    o_orderdate + interval 8405 days + interval 1 hour * (o_orderkey % 24) as datelastchangestatus,
    o_orderdate + interval 8406 days - interval 1 day * twin as datetimelastmodif
  from {orders} join (select 0 as twin union all select 1 as twin) twins on twin = 0 or o_orderkey % 40 = 0""",
    "payment_item": f"""
  select l_orderkey - l_orderkey % 4 + extra as paymentouid, ouid * 2 + 1 as referredouid,
    case when l_suppkey % 5 <> 0 then 'CANCELLED_BALANCE' else 'BALANCE' end as referredtype,
    gross * side + case when l_suppkey % 12 = 0 then 1 else 0 end as amount
  from ({_LINE}) line join (select 0 as extra union all select 1 as extra) extras on true
  where kind in (2, 3, 15)""",
    "settlement_note_advice": """
  select o_orderkey as ouid, concat('N', cast(o_orderkey as string)) as id,
    case when o_orderkey % 4 = 0 then null else o_orderdate + interval 8420 days end as paymentduedate,
    o_orderdate + interval 8405 days as datetimecreate
  from {orders}""",
    "applied_billing_tax_rate": f"""
  select ouid * 4 + part as ouid, ouid as appliedbillingchargeouid,
    case when part < 2 then 'VAT' when l_linenumber % 2 = 0 then 'electricityTax' else 'gasTax' end as taxcategory,
    cast(case when part = 2 then 2.05 when (l_orderkey + part + case when l_linenumber % 5 = 0 then 1 else 0 end) % 2 = 0
      then 19 else 7 end as decimal(20,2)) as taxrate,
    cast(case when part = 2 then round(l_extendedprice * l_discount * 100)
      else round(l_extendedprice * l_tax * 100) end as decimal(20,2)) * side
      * case when part = 1 then -1 else 1 end as amount,
    created + interval 1 hour * (l_suppkey % 100) as datetimelastmodif
  from ({_LINE}) line join (select 0 as part union all select 1 as part union all select 2 as part) parts
    on part <> 1 or l_suppkey % 6 = 0
  where l_suppkey % 40 <> 39""",
    "charge_aggregate": """
  select o_orderkey as ouid, concat('A', cast(o_orderkey as string)) as aggregateid
  from {orders} where o_orderkey % 50 <> 0""",
    "tax_aggregate": """
  select o_orderkey * 10 + part as ouid, o_orderkey as chargeaggregateouid,
    case part when 1 then 'VAT' when 2 then 'VAT' when 3 then 'electricityTax' else 'gasTax' end as taxcategory,
    cast(case part when 1 then 19 when 2 then 7 else 2.05 end as decimal(20,2)) as taxrate,
    cast(((o_orderkey + part) % 3 - 1) * 100 as decimal(20,2)) as amount
  from {orders} join (select 1 as part union all select 2 as part union all select 3 as part union all select 4 as part)
    parts on true""",
    "product": f"""
  select ouid, o_custkey as billingaccountouid, concat('P', cast(l_partkey % 20 as string)) as name,
    ordered as startdatetime, ordered + interval 30 days as enddatetime, created + interval 20 minutes as orderdate,
    case when l_suppkey % 4 = 0 then '{{{{}}}}'
      else concat('{{{{"billId":"BI', cast(l_orderkey as string), '"}}}}') end as characteristics
  from ({_LINE}) line where kind = 6
  union all
  select (5 + o_orderkey % 2) * 1000000000000000 + l_orderkey as ouid, max(o_custkey) as billingaccountouid,
    'X_ACTCHARGESCANCELLATION_Y' as name, null as startdatetime, null as enddatetime,
    max(o_orderdate) + interval 8700 days as orderdate,
    concat('{{{{"CANCELLATION_REASON":"r', cast(l_orderkey % 3 as string), '","CHARGES_OUIDS":"',
      cast(min(((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) as string), ',',
      cast(max(((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) as string),
      case when l_orderkey % 7 = 0 then ',x' else '' end, '"}}}}') as characteristics
  from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey where l_orderkey % 5 = 0
  group by l_orderkey, o_orderkey
  union all
  select 8000000000000000 + l_orderkey as ouid, max(o_custkey) as billingaccountouid,
    'X_ACTCHARGESCANCELLATION_Y' as name, null as startdatetime, null as enddatetime,
    max(o_orderdate) + interval 8705 days as orderdate,
    concat('{{{{"CANCELLATION_REASON":"again","CHARGES_OUIDS":"',
      cast(min(((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) as string), '"}}}}')
      as characteristics
  from {{lineitem}} join {{orders}} on o_orderkey = l_orderkey where l_orderkey % 10 = 0
  group by l_orderkey""",
    "order_item": """
  select (5 + o_orderkey % 2) * 1000000000000000 + o_orderkey as product_ouid,
    (5 + o_orderkey % 2) * 1000000000000000 + o_orderkey as productorderouid
  from {orders} where o_orderkey % 5 = 0
  union all
  select 8000000000000000 + o_orderkey as product_ouid, 8000000000000000 + o_orderkey as productorderouid
  from {orders} where o_orderkey % 10 = 0""",
    "note": """
  select (5 + o_orderkey % 2) * 1000000000000000 + o_orderkey as productorderouid,
    concat('note ', cast(o_orderkey as string)) as text
  from {orders} where o_orderkey % 15 = 0""",
    "product_order": """
  select (5 + o_orderkey % 2) * 1000000000000000 + o_orderkey as ouid,
    case when o_orderkey % 35 = 5 then 'CANCELLED' else 'COMPLETED' end as state
  from {orders} where o_orderkey % 5 = 0
  union all
  select 8000000000000000 + o_orderkey as ouid, case when o_orderkey % 20 = 0 then 'COMPLETED' else 'OPEN' end as state
  from {orders} where o_orderkey % 10 = 0""",
    "case_receivables": """
  select concat('C', cast(event_id as string)) as id, concat('B', cast(user_id * 10 as string)) as mba,
    case event_type when 'purchase' then 'DUNNING' when 'error' then 'BLOCKING' when 'signup' then 'INKASSO'
      else 'CLOSED' end as status,
    case when event_id % 997 = 0 then null else ts end as created_at
  from {events}""",
    "dunning_locks": """
  select concat('B', cast(user_id * 5 as string)) as mba, event_type as reason,
    case when event_id % 5 = 0 then null else ts + interval 1 day * (event_id % 60) end as expires_at,
    event_id % 4 = 0 as deleted, ts as created_at, ts + interval 1 hour as updated_at
  from {events} where event_id % 3 = 0""",
    "dunning_claims": """
  select concat('C', cast(event_id as string)) as case_receivable_id,
    concat('D', cast(event_id + again as string)) as dunning_claim_id,
    cast((event_id + again) % 4 as int) as dunning_level,
    concat('S', cast(event_id % 3 as string)) as scenario
  from {events} join (select 0 as again union all select 1 as again) agains on again = 0 or event_id % 10 < 5
  where event_id % 4 <> 1""",
    "claims": """
  select concat('D', cast(event_id as string)) as id, case when event_id % 3 = 0 then 'closed' else 'active' end as status
  from {events} where event_id % 6 <> 0""",
    "summaries": """
  select concat('S', cast(o_orderkey as string)) as uuid,
    case when o_orderkey % 4 = 0 then null else o_orderdate + interval 8470 days end as file_created_at,
    o_orderdate + interval 8469 days + interval 1 hour * (o_orderkey % 48) as create_time,
    case when o_orderkey % 11 = 0 then null else o_orderkey % 9 <> 0 end as export
  from {orders}""",
    "journal_entries": f"""
  select concat('J', cast(o_orderkey as string)) as uuid, concat('S', cast(o_orderkey as string)) as summaries_uuid,
    concat({_PREFIX}, cast(o_orderkey as string)) as id, cast(o_orderdate + interval 8472 days as date) as date
  from {{orders}}""",
    "journal_entry_items": f"""
  select concat('I', cast(ouid as string)) as uuid, concat('J', cast(l_orderkey as string)) as journal_entries_uuid,
    case when l_suppkey % 25 = 0 then null else gross * case when l_linenumber % 2 = 0 then -1 else 1 end end as amount,
    case when l_suppkey % 10 = 0 then '5000' when l_suppkey % 10 < 4 then '4000' else '1000' end as account
  from ({_LINE}) line""",
    "journal_entry_item_account_metadata": f"""
  select concat('I', cast(ouid as string)) as journal_entry_items_uuid,
    case when l_suppkey % 13 = 0 then 'other' when l_suppkey % 2 = 0 then 'rfbibl' else 'schleupen' end as type,
    case part when 0 then 'gsber' when 1 then 'aufnr' else 'mwskz' end as key,
    case part when 0 then concat('G', cast(l_suppkey % 5 as string)) when 1 then concat('F', cast(l_orderkey % 7 as string))
      else case l_suppkey % 4 when 0 then '11' when 1 then '1A' when 2 then '5W' else 'ZZ' end end as value
  from ({_LINE}) line join (select 0 as part union all select 1 as part union all select 2 as part) parts
    on (l_partkey + part) % 6 <> 0""",
    "journal_entry_item_sources": f"""
  select concat('Q', cast(ouid as string)) as uuid, concat('I', cast(ouid as string)) as journal_entry_items_uuid
  from ({_LINE}) line where l_partkey % 14 <> 0""",
    "journal_entry_item_source_items": f"""
  select concat('Q', cast(ouid as string)) as journal_entry_item_sources_uuid, net as amount,
    case when l_linenumber % 3 = 0 then null else l_linenumber end as tax_index,
    {_INDICATOR} as amount_formula, concat('X', cast(l_orderkey as string)) as transaction_items_uuid,
    case when l_suppkey % 4 = 0 then null
      else concat('Y', cast(l_orderkey * 10 + 1 + l_linenumber % 2 as string)) end as transaction_item_taxes_uuid
  from ({_LINE}) line""",
    "transaction_items": """
  select concat('X', cast(o_orderkey as string)) as uuid, concat('A', cast(o_orderkey as string)) as external_reference
  from {orders}""",
    "transaction_item_taxes": """
  select concat('Y', cast(o_orderkey * 10 + part as string)) as uuid,
    cast(o_orderkey * 10 + part as string) as external_reference
  from {orders} join (select 1 as part union all select 2 as part) parts on true""",
    "journal_entry_item_taxes": f"""
  select concat('W', cast(ouid as string)) as uuid, concat('I', cast(ouid as string)) as journal_entry_items_uuid,
    gross * case when l_linenumber % 3 = 0 then -1 else 1 end as amount
  from ({_LINE}) line where l_linenumber % 2 = 0""",
    "journal_entry_item_tax_sources": f"""
  select concat('V', cast(ouid as string)) as uuid, concat('W', cast(ouid as string)) as journal_entry_item_taxes_uuid
  from ({_LINE}) line where l_linenumber % 2 = 0""",
    "journal_entry_item_tax_source_items": f"""
  select concat('V', cast(ouid as string)) as journal_entry_item_tax_sources_uuid, gross - net as amount,
    net as base_amount, case when l_suppkey % 5 = 0 then 'other' when l_suppkey % 2 = 0 then 'VAT' else 'vat.Amount' end
      as amount_formula,
    case when l_suppkey % 7 = 0 then concat('X', cast(l_orderkey + 100000000 as string))
      else concat('X', cast(l_orderkey as string)) end as transaction_items_uuid
  from ({_LINE}) line where l_linenumber % 2 = 0 and l_suppkey % 15 <> 0""",
    "payment_bookings": f"""
  select concat('A', cast(o_orderkey as string)) as id, concat('M', cast(o_orderkey as string)) as payment_id,
    concat('Z', cast(o_orderkey % 4 as string)) as payment_state_id,
    concat({_PREFIX}, cast(o_orderkey as string)) as sap_id
  from {{orders}} where o_orderkey % 3 = 0""",
    "payments": """
  select concat('M', cast(o_orderkey as string)) as id, cast(round(o_totalprice * 100) as decimal(20,2)) as amount
  from {orders}""",
    "payment_states": """
  select distinct concat('Z', cast(o_orderkey % 4 as string)) as id,
    concat('STATE_', cast(o_orderkey % 4 as string)) as payment_status
  from {orders} where o_orderkey % 4 <> 3""",
}


def sql_for(table: str) -> str:
    """The mapping text of a table with ``{customer}``-style places for the inputs."""
    return (TABLES | LEDGER_ROWS)[table]


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# the join that most texts begin with, and the columns they use of it
_JOINED = "{lineitem} join {orders} on o_orderkey = l_orderkey"
_LINE_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_returnflag",
    "l_linestatus",
    "l_quantity",
    "l_extendedprice",
    "l_tax",
    "l_discount",
    "l_shipdate",
]


def joined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with their order; ``o_orderkey`` repeats ``l_orderkey`` and is left out."""
    orders = raw_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = raw_table(spark, folder, "lineitem").select(*_LINE_COLUMNS)
    return lines.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).drop("o_orderkey")


def _derive(spark: SparkSession, folder: str, table: str, joined: Callable[[], DataFrame] | None = None) -> DataFrame:
    """A table from its text; ``joined`` gives stored ``joined_lines``."""
    text, used = sql_for(table), {}
    if joined is not None and _JOINED in text:
        text = text.replace(_JOINED, "{joined}")
        used["joined"] = joined().withColumn("o_orderkey", F.col("l_orderkey"))
    used |= {name: raw_table(spark, folder, name) for name in RAW_TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def booking_runs(spark: SparkSession, folder: str) -> DataFrame:
    """JSON documents, one per order; the arrays hold the lines of that order only."""

    def rows(name: str) -> DataFrame:
        return _derive(spark, folder, name)

    def gather(df: DataFrame, item, name: str) -> DataFrame:
        return df.groupBy("run_id").agg(F.collect_list(item).alias(name))

    segments = gather(
        rows("ledger_segments"),
        F.struct(*SEGMENT_FIELDS, F.array_compact(F.array("agg_1", "agg_2")).alias("relatedAggregateIds")),
        "bbseg",
    )
    headers = gather(
        rows("ledger_headers"),
        F.struct(
            "ba",
            "bukrs",
            "xblnr",
            F.date_format("budat", "dd.MM.yyyy").alias("budat"),
            F.date_format("beldat", "dd.MM.yyyy").alias("beldat"),
        ),
        "bbkpf",
    )
    raw = gather(
        rows("ledger_raw"),
        F.struct(
            "xblnr",
            "newbs",
            "newko",
            "mwskz",
            "wrbed",
            F.col("amount_calculation").alias("amountCalculation"),
            F.col("aggregate_id").alias("relatedAggregateId"),
        ),
        "rawSegments",
    )
    tax = gather(
        rows("ledger_tax"),
        F.struct("xblnr", "bs", "mwskz", "fwste", "fwbas", F.col("tax_aggregate").alias("taxAggregateOuid")),
        "bbtax",
    )
    document = F.to_json(F.struct(F.struct("bbseg", "bbkpf", "rawSegments", "bbtax").alias("sap")))
    runs = rows("ledger_runs").withColumnRenamed("id", "run_id")
    for part in (segments, headers, raw, tax):
        runs = runs.join(part, "run_id", "left")
    return runs.select(
        F.col("run_id").alias("id"),
        F.col("created").alias("timestamp"),
        "deleted",
        F.when(F.col("no_document") == 0, document).alias("summary"),
    )


_STORED: dict[tuple[str, str], Vault] = {}


def _grouped(table: str) -> bool:
    """Tables that are more than a selection from the joined lines or one raw table."""
    return table == "booking_runs" or "group by" in sql_for(table) or "select distinct" in sql_for(table)


def sample_vault(spark: SparkSession, folder: str) -> Vault:
    """The vault derived from the generated tables in ``folder``.

    Like the tables of a real vault, each row exists once: the join of lines and orders and the tables that
    take a shuffle to make are stored on first use and then read by every query of the application.  All
    others are selections from one of these or from one raw table; a copy of each would take many
    times the space of the input.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        stored: list[DataFrame] = []

        def joined() -> DataFrame:
            if not stored:
                stored.append(materialize(joined_lines(spark, folder)))
            return stored[0]

        def reader(table: str) -> DataFrame:
            df = derived_table(spark, folder, table, joined)
            return materialize(df) if _grouped(table) else df

        _STORED[key] = Vault(spark, reader)
    return _STORED[key]


def derived_table(spark: SparkSession, folder: str, table: str, joined: Callable[[], DataFrame] | None = None) -> DataFrame:
    df = booking_runs(spark, folder) if table == "booking_runs" else _derive(spark, folder, table, joined)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema_of(table).fields])
