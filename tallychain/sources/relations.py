"""Source files to the canonical relations every operator works on.

hub          order_id, hub_txn_id, settle_key, gateway, amount, status, ...
gateway_txn  gateway, gw_key, amount, is_success, txn_date, ...
settlement   gateway, settlement_order_id, settled_date, sett_*, is_forward, is_refund, ...
ledger       order_id, ledger_table, ledger_amount, ledger_date, in_scope, ...
refunds      hub_refund and gateway_refund
bank         gateway, bank_date, deposit, ...

Ids are unquoted, dates are dates and money is decimal from here on, so joins
are plain equi-joins and filters are plain ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallychain.config import LEDGERS, MONEY, Ledger
from tallychain.functions.dates import (
    month_label,
    parse_dmy_date,
    parse_month_name_date,
    parse_quoted_date,
    parse_text_date,
)
from tallychain.functions.money import money, settlement_fee, settlement_net
from tallychain.functions.status import (
    gateway_of_label,
    gateway_success,
    is_forward_row,
    is_refund_row,
    settle_key,
)
from tallychain.functions.text import strip_quotes
from tallychain.operators.base import one_hub_row
from tallychain.operators.frames import union_all


def hub(raw: DataFrame) -> DataFrame:
    """Orders, one row each: an order delivered twice is the row ``one_hub_row`` picks.

    Every report on the hub thus counts it once. Orders that have no gateway key are
    told apart by their own ids.
    """
    rows = raw.selectExpr(
        "order_id",
        "hub_txn_id",
        f"{settle_key('payment_gateway', 'order_id', 'hub_txn_id')} AS settle_key",
        "payment_gateway AS gateway",
        f"{money('amount')} AS amount",
        "payment_status AS status",
        "order_status",
        f"{parse_text_date('order_date_created')} AS created_date",
        f"{month_label(parse_text_date('order_date_created'))} AS source_month",
        "customer_id",
        "payment_flow",
    )
    return one_hub_row(
        rows.selectExpr("*", "CASE WHEN settle_key IS NULL THEN struct(order_id, hub_txn_id) END AS _own"), "_own"
    ).drop("_own")


def hub_refund(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "order_id",
        f"{strip_quotes('refund_txn_id')} AS refund_txn_id",
        "refund_unique_id",
        f"{money('refund_amount')} AS refund_amount",
        "refund_status",
        "refund_type",
        f"{parse_text_date('refund_date')} AS refund_date",
        "payment_gateway AS gateway",
    )


def gateway_txn(feed: DataFrame) -> DataFrame:
    return feed.selectExpr(
        "gateway",
        f"{strip_quotes('raw_order_id')} AS gw_key",
        f"{money('raw_amount')} AS amount",
        "raw_status AS status",
        f"{gateway_success('gateway', 'raw_status')} AS is_success",
        f"""CASE WHEN gateway = 'GW_C' THEN {parse_dmy_date('raw_date')}
                 ELSE {parse_quoted_date('raw_date')} END AS txn_date""",
        "mode",
        "bank_name",
        "error_description",
        f"{money('discount')} AS discount",
        f"{money('subvention')} AS subvention",
    )


def settlement(feed: DataFrame) -> DataFrame:
    clean = feed.selectExpr(
        "gateway",
        f"{strip_quotes('raw_order_id')} AS settlement_order_id",
        f"{parse_quoted_date('raw_settled_on')} AS settled_date",
        f"{money('raw_gross')} AS sett_gross",
        f"{money('raw_net')} AS file_net",
        f"{money('raw_fee')} AS file_fee",
        f"{money('raw_tax')} AS file_tax",
        "utr AS sett_utr",
        "txn_type AS sett_txn_type",
        "payment_type",
        "txn_status",
        "method",
        "network",
        "card_type",
    )
    fee = settlement_fee("gateway", "file_fee", "file_tax")
    return clean.selectExpr(
        "gateway",
        "settlement_order_id",
        "settled_date",
        "sett_gross",
        f"{settlement_net('gateway', 'sett_gross', 'file_fee', 'file_tax', 'file_net')} AS sett_net",
        f"{fee} AS sett_fee",
        f"CAST(abs(coalesce(file_tax, 0)) AS {MONEY}) AS sett_tax",
        f"CAST(CASE WHEN gateway = 'GW_B' THEN file_fee ELSE -{fee} END AS {MONEY}) AS signed_fee",
        "sett_utr",
        "sett_txn_type",
        "payment_type",
        "txn_status",
        "method",
        "network",
        "card_type",
        f"{is_forward_row('gateway', 'sett_txn_type')} AS is_forward",
        f"{is_refund_row('gateway', 'sett_txn_type')} AS is_refund",
    )


def gateway_refund(feed: DataFrame) -> DataFrame:
    return feed.selectExpr(
        "gateway",
        f"{strip_quotes('raw_refund_id')} AS refund_key",
        f"{strip_quotes('raw_original_id')} AS original_key",
        f"{money('raw_amount')} AS amount",
        f"{money('raw_settled_amount')} AS settled_amount",
        f"{parse_quoted_date('raw_settled_on')} AS settled_date",
        f"{parse_quoted_date('raw_txn_date')} AS txn_date",
    )


def _ledger_date(spec: Ledger) -> str:
    return (parse_text_date if spec.date_style == "iso" else parse_month_name_date)(spec.date)


def ledger_one(spec: Ledger, raw: DataFrame) -> DataFrame:
    def text(name: str | None) -> str:
        return f"CAST({name or 'NULL'} AS STRING)"

    rank = "NULL" if spec.priority is None else str(spec.priority)
    return raw.selectExpr(
        f"{spec.key} AS order_id",
        f"'{spec.table}' AS ledger_table",
        f"{money(spec.amount)} AS ledger_amount",
        f"{_ledger_date(spec)} AS ledger_date",
        f"{text(spec.status)} AS ledger_status",
        f"{text(spec.mode)} AS mode",
        f"{text(spec.plan)} AS plan",
        f"{text(spec.account)} AS account_id",
        f"{text(spec.mobile)} AS mobile",
        f"{text(spec.alt_key or spec.key)} AS alt_key",
        f"{text(spec.payment_status)} AS payment_status",
        f"{text(spec.refund_status)} AS refund_status",
        f"CAST({rank} AS INT) AS priority",
        f"coalesce({spec.scope}, false) AS in_scope",
    )


def ledger(raw: dict[str, DataFrame]) -> DataFrame:
    """All ledger rows of all tables in one relation."""
    return union_all([ledger_one(spec, raw[spec.table]) for spec in LEDGERS])


def bank(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        f"{gateway_of_label('payment_gateway')} AS gateway",
        "payment_gateway AS bank_label",
        "CAST(transaction AS DATE) AS bank_date",
        f"{money('deposit_amt')} AS deposit",
        "transaction_remarks AS remarks",
        "month AS month_text",
    )
