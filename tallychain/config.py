"""Fixed vocabulary of the payment chain: gateways, ledgers, id families, periods.

Everything that differs between gateways or ledgers is data here, so that one
operator serves all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

MONEY = "decimal(18,2)"
#: Type of a summed amount: cluster-wide totals do not fit into MONEY.
MONEY_SUM = "decimal(38,2)"


@dataclass(frozen=True)
class Gateway:
    code: str
    bank_label: str
    #: hub column that the gateway's own order id equals
    hub_key: str
    #: status text of a successful gateway transaction; None accepts every status
    success_status: str | None
    #: the gateway subtracts refunds from the daily transfer
    nets_refunds: bool


# One row per gateway.
GATEWAYS = (
    Gateway("GW_A", "01 Wallet A", "hub_txn_id", None, True),
    Gateway("GW_B", "05 Wallet B", "hub_txn_id", "SUCCESS", False),
    Gateway("GW_C", "02 Wallet C", "hub_txn_id", "captured", False),
    Gateway("GW_D", "06 Wallet D", "order_id", "payment", False),
)
GATEWAY_CODES = [g.code for g in GATEWAYS]


@dataclass(frozen=True)
class Ledger:
    """How one internal ledger table maps onto the canonical ledger relation."""

    table: str
    key: str
    amount: str
    date: str
    #: iso | month_name | mixed
    date_style: str
    #: rank in the lookup pick; None keeps the table out of the pick
    priority: int | None
    mode: str | None = None
    status: str | None = None
    plan: str | None = None
    account: str | None = None
    mobile: str | None = None
    alt_key: str | None = None
    payment_status: str | None = None
    refund_status: str | None = None
    #: rows that count as money in: SQL predicate on the raw table
    scope: str = "true"


# The eight ledgers in lookup order, then topup and refunded.
LEDGERS = (
    Ledger("ledger_booking", "booking_txn_id", "booking_fee", "created_on", "month_name", 1,
           status="resultstatus", account="account_id", mobile="mobile",
           scope="resultstatus = 'TXN_SUCCESS'"),
    Ledger("ledger_revenue", "transaction_id", "totalpaid", "recharge_dt", "month_name", 2,
           mode="mode", plan="plan_type", account="account_id", mobile="mobile",
           scope="mode = 'online' AND totalpaid > 0"),
    Ledger("ledger_net_income", "txn_id", "amount", "txn_dt", "iso", 3,
           mode="mode", plan="rev_mode", mobile="mobile", scope="mode = 'online'"),
    Ledger("ledger_mobile", "transaction_id", "pay_amount", "createdate", "iso", 4),
    Ledger("ledger_deposit", "sd_txn_id", "sd_amount", "created_on", "month_name", 5,
           account="account_id", mobile="mobile", alt_key="transaction_id"),
    Ledger("ledger_ott", "transaction_id", "pay_amount", "createdate", "iso", 6),
    Ledger("ledger_topup", "transaction_id", "amount", "datetime", "mixed", None),
    Ledger("ledger_refunded", "transaction_id", "pay_amount", "dt", "iso", None,
           mode="payment_mode", status="txn_status", plan="payment_type", mobile="mobile",
           payment_status="payment_status", refund_status="refund_status",
           scope="refund_status = 1"),
)
LEDGER_TABLES = [x.table for x in LEDGERS]
LOOKUP_LEDGERS = [x for x in LEDGERS if x.priority is not None]

# Id families in match order, and the ledger each one is booked in.
PATTERNS = ("gen", "wgSub", "sub", "walletTop", "w", "mr", "sd", "ott")
ROUTES = {
    "gen_*": "ledger_revenue",
    "wgSub_*": "ledger_revenue",
    "sub_*": "ledger_revenue",
    "walletTop_*": "ledger_topup",
    "w_*": "ledger_net_income",
    "mr_*": "ledger_mobile",
    "sd_*": "ledger_deposit",
    "ott_*": "ledger_ott",
}
# Ids that are paid outside the hub.
PARTNER_PREFIXES = ("SRVC_", "BILL_")

# Tolerances of the reports.
AMOUNT_TOLERANCE = "0.50"
DAILY_OUTLIER = 50000
DAILY_ALERT = 1000
CLEAN_BELOW_PCT = 3
REVIEW_BELOW_PCT = 10
TOP_BATCHES = 20


@dataclass(frozen=True)
class Period:
    """Half-open date range [start, end)."""

    start: date
    end: date

    @staticmethod
    def month(text: str) -> Period:
        year, mon = (int(p) for p in text.split("-"))
        return Period(date(year, mon, 1), date(year + mon // 12, mon % 12 + 1, 1))

    def previous(self) -> Period:
        """The calendar month before ``start``."""
        first = self.start
        return Period(date(first.year - (first.month == 1), (first.month - 2) % 12 + 1, 1), first)
