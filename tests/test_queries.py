"""Every registered query against its SQL, and every derived relation against its definition."""

import pytest

from tallychain.plans import registry
from tallychain.plans.oracle import with_relations
from tests.oracle_check import compare

NAMES = list(registry.plans())

# Columns of each relation, money as double on the SQL side.
RELATIONS = {
    "hub": "order_id, hub_txn_id, settle_key, gateway, amount::DOUBLE AS amount, status, order_status, "
    "created_date, source_month, customer_id, payment_flow",
    "hub_refund": "order_id, refund_txn_id, refund_unique_id, refund_amount::DOUBLE AS refund_amount, "
    "refund_status, refund_type, refund_date, gateway",
    "gateway_txn": "gateway, gw_key, amount::DOUBLE AS amount, status, is_success, txn_date, mode, "
    "bank_name, error_description, discount::DOUBLE AS discount, subvention::DOUBLE AS subvention",
    "settlement": "gateway, settlement_order_id, settled_date, sett_gross::DOUBLE AS sett_gross, "
    "sett_net::DOUBLE AS sett_net, sett_fee::DOUBLE AS sett_fee, sett_tax::DOUBLE AS sett_tax, "
    "signed_fee::DOUBLE AS signed_fee, sett_utr, sett_txn_type, payment_type, txn_status, method, "
    "network, card_type, is_forward, is_refund",
    "gateway_refund": "gateway, refund_key, original_key, amount::DOUBLE AS amount, "
    "settled_amount::DOUBLE AS settled_amount, settled_date, txn_date",
    "ledger": "order_id, ledger_table, ledger_amount::DOUBLE AS ledger_amount, ledger_date, "
    "ledger_status, mode, plan, account_id, mobile, alt_key, priority, in_scope, payment_status, "
    "refund_status",
    "bank": "gateway, bank_label, bank_date, deposit::DOUBLE AS deposit, remarks, month_text",
}


@pytest.mark.parametrize("name", RELATIONS)
def test_relation_matches_its_definition(name, derived, duck):
    sql = with_relations(f"SELECT {RELATIONS[name]} FROM {name}")
    assert compare(registry.comparable(getattr(derived, name)), duck, sql) is None


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(name, stored, duck):
    assert compare(registry.run(name, stored), duck, registry.sql()[name]) is None


def test_every_query_has_sql():
    assert set(registry.sql()) == set(NAMES)
