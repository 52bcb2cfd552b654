"""Row classifications."""

from __future__ import annotations

from tallychain.config import GATEWAYS, Period
from tallychain.functions.text import is_adjustment, is_partner_wallet


def is_refund_row(gateway: str, txn_type: str) -> str:
    return (
        f"coalesce(CASE {gateway} WHEN 'GW_A' THEN {txn_type} = 'REFUND' "
        f"WHEN 'GW_B' THEN contains({txn_type}, 'REVERSAL') OR contains({txn_type}, 'REFUND') "
        f"WHEN 'GW_C' THEN {txn_type} IN ('Refunded', 'Chargebacked') "
        f"ELSE {txn_type} = 'refund' END, false)"
    )


def is_forward_row(gateway: str, txn_type: str) -> str:
    """Rows that carry a customer payment. GW_C marks refunds on the payment row itself."""
    return (
        f"coalesce(CASE {gateway} WHEN 'GW_A' THEN {txn_type} = 'ACQUIRING' "
        f"WHEN 'GW_B' THEN NOT contains({txn_type}, 'REVERSAL') AND NOT contains({txn_type}, 'REFUND') "
        f"WHEN 'GW_C' THEN true ELSE {txn_type} = 'payment' END, false)"
    )


def non_refund_status(status: str) -> str:
    return f"({status} IS NULL OR {status} NOT IN ('Refunded', 'Chargebacked'))"


def gateway_success(gateway: str, status: str) -> str:
    """The status text that counts as success differs by gateway."""
    arms = " ".join(
        f"WHEN '{g.code}' THEN " + (f"{status} = '{g.success_status}'" if g.success_status else "true")
        for g in GATEWAYS
    )
    return f"coalesce(CASE {gateway} {arms} END, false)"


def settle_key(gateway: str, order_id: str, hub_txn_id: str) -> str:
    """The hub id that the gateway's files carry."""
    by_order = ", ".join(f"'{g.code}'" for g in GATEWAYS if g.hub_key == "order_id")
    return f"CASE WHEN {gateway} IN ({by_order}) THEN {order_id} ELSE {hub_txn_id} END"


def bank_label(gateway: str) -> str:
    arms = " ".join(f"WHEN '{g.code}' THEN '{g.bank_label}'" for g in GATEWAYS)
    return f"CASE {gateway} {arms} END"


def gateway_of_label(label: str) -> str:
    arms = " ".join(f"WHEN '{g.bank_label}' THEN '{g.code}'" for g in GATEWAYS)
    return f"CASE {label} {arms} END"


def is_topup(hub_id: str) -> str:
    return f"startswith({hub_id}, 'walletTop_')"


def l2_match(hub_id: str) -> str:
    return f"CASE WHEN {hub_id} IS NOT NULL THEN 'MATCHED' ELSE 'SETT_ONLY' END"


def l1_match(hub_id: str, ledger_id: str) -> str:
    """Ledger match is tested before partner wallet; ``trace_status`` does it the other way."""
    return (
        f"CASE WHEN {hub_id} IS NULL THEN 'NO_HUB' WHEN {ledger_id} IS NOT NULL THEN 'MATCHED' "
        f"WHEN {is_partner_wallet(hub_id)} THEN 'PARTNER_WALLET' ELSE 'HUB_ONLY' END"
    )


def trace_status_basic(hub_id: str, ledger_id: str) -> str:
    return (
        f"CASE WHEN {hub_id} IS NULL THEN 'MISSING_HUB' "
        f"WHEN {is_partner_wallet(hub_id)} THEN 'PARTNER_WALLET' "
        f"WHEN {ledger_id} IS NOT NULL THEN 'FULLY_TRACED' ELSE 'MISSING_LEDGER' END"
    )


def trace_status(
    gateway: str, settlement_id: str, hub_id: str, ledger_id: str, refunded: str, topup: str
) -> str:
    """Refunded and topup are fallbacks: they count only without a main-ledger match."""
    return (
        f"CASE WHEN {is_adjustment(gateway, settlement_id)} THEN 'PG_ADJUSTMENT' "
        f"WHEN {hub_id} IS NULL THEN 'MISSING_HUB' "
        f"WHEN {is_partner_wallet(hub_id)} THEN 'PARTNER_WALLET' "
        f"WHEN {ledger_id} IS NOT NULL THEN 'FULLY_TRACED' "
        f"WHEN {refunded} THEN 'REFUNDED' "
        f"WHEN {topup} AND {is_topup(hub_id)} THEN 'WALLET_TOPUP' "
        f"ELSE 'MISSING_LEDGER' END"
    )


def hub_category(hub_id: str, gw_id: str, status: str, source_month: str, month: str) -> str:
    return (
        f"CASE WHEN {hub_id} IS NULL AND {gw_id} IS NULL THEN '5 orphan' "
        f"WHEN {hub_id} IS NULL THEN '4 gateway only' "
        f"WHEN {status} = 'SUCCESS' AND {source_month} = '{month}' THEN '1 period success' "
        f"WHEN {status} = 'SUCCESS' THEN '2 other month success' ELSE '3 not success' END"
    )


def source_month_bucket(created: str, period: Period) -> str:
    prev = period.previous()
    return (
        f"CASE WHEN {created} IS NULL THEN 'NOT_IN_HUB' "
        f"WHEN {created} < DATE'{prev.start}' THEN 'EARLIER' "
        f"WHEN {created} < DATE'{period.start}' THEN 'PREVIOUS_MONTH' "
        f"WHEN {created} < DATE'{period.end}' THEN 'THIS_MONTH' ELSE 'LATER' END"
    )
