"""Changes between two vaults, and the list kept up to date by them."""

from pyspark.sql import functions as F

from duebook.checks import AS_OF, CLIENT, EARLIER, OVERLAYS, earlier_list_vault
from duebook.plans import build as b
from duebook.plans import incremental as inc
from duebook.plans import incremental_list as inc_list
from duebook.sources.sample_vault import sample_vault

FOLDER = "/root/testdata/sf0.001"


def test_signed_changes_compare_multisets(spark, rows):
    def table(*values):
        return spark.createDataFrame(list(values), "k string, a int, b int")

    before = table(("same", 1, 2), ("same", 3, 4), ("twice", 1, 1), ("value", 1, 2), ("gone", 0, 0), (None, 1, 1), ("swap", None, 1), ("both", 1, 1), ("both", 2, 2))
    after = table(("same", 3, 4), ("same", 1, 2), ("twice", 1, 1), ("twice", 1, 1), ("value", 1, 3), ("new", 0, 0), (None, 1, 2), ("swap", 1, None), ("both", 1, 2), ("both", 2, 1))
    expected = [("both", "changed"), ("gone", "removed"), ("new", "added"), ("swap", "changed"), ("twice", "changed"), ("value", "changed"), (None, "changed")]
    assert rows(inc.signed_changes(before, after, ["k"]), "k", "change") == expected
    # only the named columns are compared
    assert ("value",) not in rows(inc.signed_changes(before, after, ["k"], ["a"]), "k")
    assert inc.signed_changes(after, after, ["k"]).isEmpty()


def test_removed_rows_leave_the_extract(vault, rows):
    charge = [{"ouid": i, "billingaccountouid": 5, "transactionid": f"t{i}", "taxincludedamount": 100, "datetimecreate": "2023-01-01 12:00:00"} for i in (1, 2, 3)]
    tax = [{"ouid": 10 * i, "appliedbillingchargeouid": i, "taxcategory": "VAT", "amount": 19} for i in (1, 2)]
    request = {"ouid": 7, "transactionid": "t3", "daterequest": "2023-05-05 12:00:00"}
    accounts = {"billing_account": [{"ouid": 5, "name": "a", "customerouid": 6}]}
    old = vault(applied_billing_charge=charge, applied_billing_tax_rate=tax, payment_request=[request], login=[{"ouid": 8, "customerouid": 6, "externalid": "x"}], **accounts)
    # a charge, a tax row, a payment request and the login are gone
    for new, touched in (
        (vault(applied_billing_charge=charge[1:], applied_billing_tax_rate=tax, payment_request=[request], login=[{"ouid": 8, "customerouid": 6, "externalid": "x"}], **accounts), ["1"]),
        (vault(applied_billing_charge=charge, applied_billing_tax_rate=tax[:1], payment_request=[request], login=[{"ouid": 8, "customerouid": 6, "externalid": "x"}], **accounts), ["2"]),
        (vault(applied_billing_charge=charge, applied_billing_tax_rate=tax, login=[{"ouid": 8, "customerouid": 6, "externalid": "x"}], **accounts), ["3"]),
        (vault(applied_billing_charge=charge, applied_billing_tax_rate=tax, payment_request=[request], **accounts), ["1", "2", "3"]),
    ):
        affected = inc.affected_charges(new, inc.extract_changes(old, new))
        assert rows(affected) == [(ouid,) for ouid in touched]
        reloaded = inc.reload_charges(inc.charge_extract(old), new, affected)
        assert rows(reloaded) == rows(inc.charge_extract(new))


def test_list_after_changes_equals_a_first_run(spark):
    vault = sample_vault(spark, FOLDER)
    state = inc_list.first(earlier_list_vault(vault), EARLIER, CLIENT, OVERLAYS)
    after = inc_list.advance(state, vault, AS_OF, CLIENT, OVERLAYS)
    full = b.build(vault, AS_OF, CLIENT, OVERLAYS)
    assert after.list().exceptAll(full).isEmpty() and full.exceptAll(after.list()).isEmpty()
    # the earlier list was another one
    assert not state.list().exceptAll(full).isEmpty() and not full.exceptAll(state.list()).isEmpty()

    # without a change nothing is touched, and one removed charge concerns only rows of its own transaction, aggregate and id
    charge = vault["applied_billing_charge"]
    one = charge.filter("aggregateid is not null and aggregateid <> ''").orderBy("ouid").first()
    smaller = vault.replacing(applied_billing_charge=charge.filter(F.col("ouid") != one["ouid"]))
    now = inc_list.sources(smaller, AS_OF, inc_list.client_lookups(CLIENT, OVERLAYS))
    assert inc_list.affected_by_inputs(now, now).isEmpty()
    touched = inc_list.affected_by_inputs(after.sources, now)
    related = charge.filter((F.col("transactionid") == one["transactionid"]) | (F.col("aggregateid") == one["aggregateid"])).count()
    assert 1 <= touched.count() < charge.count() / 20 and related < charge.count() / 20
