"""Settlements against bank deposits. The only shared key is gateway and day.

Both sides are reduced to days or months before they meet, so every join here
is between frames the size of a calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.config import DAILY_ALERT, GATEWAYS, Period
from tallychain.functions.dates import in_period, month_start
from tallychain.functions.money import gap_status, outlier_flag, safe_pct, total
from tallychain.functions.status import non_refund_status
from tallychain.operators.base import bank_daily
from tallychain.operators.frames import group, union_all, with_totals

NETTING = [g.code for g in GATEWAYS if g.nets_refunds]


def _in_list(codes: list[str]) -> str:
    return "gateway IN (" + ", ".join(f"'{c}'" for c in codes) + ")"


def _scoped(df: DataFrame, col: str, period: Period | None) -> DataFrame:
    return df if period is None else df.where(in_period(col, period))


# Rows that a transfer is compared with: a gateway that nets refunds reports them in a
# file of their own, so all of its settlement rows count.
PAID_OUT = f"({_in_list(NETTING)} OR is_forward)"


def settlement_daily(
    settlement: DataFrame, period: Period | None = None, rows: str = "is_forward"
) -> DataFrame:
    return group(
        _scoped(settlement.where(rows), "settled_date", period),
        ["gateway", "settled_date"],
        "count(*) AS txns",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        f"{total('sett_fee')} AS fees",
    )


def refunds_daily(gateway_refund: DataFrame, period: Period | None = None) -> DataFrame:
    return group(
        _scoped(gateway_refund, "settled_date", period),
        ["gateway", "settled_date"],
        "count(*) AS refund_txns",
        f"{total('settled_amount')} AS refund_net",
    )


def bank_summary(bank: DataFrame) -> DataFrame:
    """Deposits, span and total per label, with a grand total."""
    rows = group(
        bank,
        "bank_label",
        "count(*) AS deposits",
        "min(bank_date) AS first_date",
        "max(bank_date) AS last_date",
        f"{total('deposit')} AS bank_total",
    )
    everything = group(
        rows,
        [],
        "'ALL' AS bank_label",
        "sum(deposits) AS deposits",
        "min(first_date) AS first_date",
        "max(last_date) AS last_date",
        f"{total('bank_total')} AS bank_total",
    )
    return rows.unionByName(everything)


def bank_by_month_label(bank: DataFrame) -> DataFrame:
    """By the month text of the statement, in calendar order."""
    return group(
        bank,
        "month_text",
        "min(bank_date) AS first_date",
        "count(*) AS deposits",
        f"{total('deposit')} AS bank_total",
    ).orderBy("first_date")


def bank_rows(bank: DataFrame, period: Period) -> DataFrame:
    """Single deposits of a period with the statement's narration."""
    return (
        bank.where(in_period("bank_date", period))
        .select("bank_date", "bank_label", "deposit", "remarks")
        .orderBy("bank_date", "bank_label", "remarks")
    )


def settlement_summary(settlement: DataFrame, bank: DataFrame) -> DataFrame:
    """Rows, span and amounts per gateway and overall, against all deposits.

    GW_C is taken without refunded rows. The overall row (ALL) also holds deposits
    whose label belongs to no gateway.
    """
    counted = f"CASE gateway WHEN 'GW_C' THEN {non_refund_status('sett_txn_type')} ELSE {PAID_OUT} END"
    rows = group(
        settlement.where(counted),
        "gateway",
        "count(*) AS n_rows",
        "min(settled_date) AS first_date",
        "max(settled_date) AS last_date",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        f"{total('sett_fee')} AS fees",
    )
    everything = group(
        rows,
        [],
        "'ALL' AS gateway",
        "sum(n_rows) AS n_rows",
        "min(first_date) AS first_date",
        "max(last_date) AS last_date",
        *[f"{total(m)} AS {m}" for m in ("gross", "net", "fees")],
    )
    # One row per gateway and label class from here on.
    deposits = group(bank, "gateway", f"{total('deposit')} AS bank_total")
    all_deposits = group(deposits, [], "'ALL' AS gateway", f"{total('bank_total')} AS bank_total")
    return (
        rows.unionByName(everything)
        .join(deposits.unionByName(all_deposits), "gateway", "left")
        .selectExpr(
            "*",
            "bank_total - net AS gap",
            safe_pct("bank_total - net", "bank_total") + " AS gap_pct",
            safe_pct("bank_total - net", "net") + " AS gap_pct_of_net",
        )
    )


def bank_monthly(
    settlement: DataFrame, bank: DataFrame, gap_base: str = "bank_deposit"
) -> DataFrame:
    """Months of either side: net, deposits, gap, and whether both sides have rows.

    ``gap_base`` is what the gap is a percentage of, ``bank_deposit`` or ``sett_net``.
    Each gateway also has a total row, with neither month nor ``reconcilable``.
    """
    sett_months = group(
        settlement.where(PAID_OUT).selectExpr(
            "gateway", f"{month_start('settled_date')} AS month", "sett_net"
        ),
        ["gateway", "month"],
        "count(*) AS txns",
        f"{total('sett_net')} AS sett_net",
    )
    bank_months = group(
        bank.selectExpr("gateway", f"{month_start('bank_date')} AS month", "deposit"),
        ["gateway", "month"],
        "count(*) AS deposits",
        f"{total('deposit')} AS bank_deposit",
    )
    measures = ["txns", "sett_net", "deposits", "bank_deposit"]
    months = sett_months.join(bank_months, ["gateway", "month"], "full").selectExpr(
        "gateway",
        "month",
        *[f"coalesce({m}, 0) AS {m}" for m in measures],
        "txns IS NOT NULL AND deposits IS NOT NULL AS reconcilable",
    )
    return _with_gateway_totals(months, measures, "CAST(NULL AS BOOLEAN) AS reconcilable").selectExpr(
        "gateway",
        "month",
        *measures,
        "bank_deposit - sett_net AS gap",
        safe_pct("bank_deposit - sett_net", gap_base) + " AS gap_pct",
        "reconcilable",
    )


def _with_gateway_totals(months: DataFrame, measures: list[str], *extra: str) -> DataFrame:
    """``months`` and a row for each gateway over all of them, its month null."""
    sums = group(months, "gateway", *[f"sum({m}) AS {m}" for m in measures])
    return months.unionByName(
        sums.selectExpr("gateway", "CAST(NULL AS DATE) AS month", *measures, *extra)
    )


def bank_daily_netting(
    settlement: DataFrame,
    gateway_refund: DataFrame,
    bank: DataFrame,
    period: Period | None = None,
    how: str = "full",
) -> DataFrame:
    """Expected transfer (net less that day's refunds) against the deposit.

    ``how='left'`` keeps settlement days only, ``'full'`` also bank-only and
    refund-only days.
    """
    only = _in_list(NETTING)
    day = ["gateway", "settled_date"]
    sett = settlement_daily(settlement.where(only), period, PAID_OUT)
    refunds = refunds_daily(gateway_refund.where(only), period)
    deposits = _scoped(
        bank_daily(bank.where(only)).selectExpr(
            "gateway", "bank_date AS settled_date", "bank_daily_deposit"
        ),
        "settled_date",
        period,
    )
    net, ref, dep = (f"coalesce({c}, 0)" for c in ("net", "refund_net", "bank_daily_deposit"))
    diff = f"{dep} - ({net} - {ref})"
    return (
        sett.join(refunds, day, how)
        .join(deposits, day, how)
        .selectExpr(
            "gateway",
            "settled_date AS day",
            "coalesce(txns, 0) AS txns",
            "coalesce(gross, 0) AS gross",
            f"{net} AS net",
            "coalesce(fees, 0) AS fees",
            "coalesce(refund_txns, 0) AS refund_txns",
            f"{ref} AS refund_net",
            f"{net} - {ref} AS expected",
            f"{dep} AS bank_deposit",
            f"{diff} AS daily_diff",
            f"{outlier_flag(diff)} AS is_outlier",
        )
    )


def bank_daily_full(
    settlement: DataFrame, bank: DataFrame, period: Period | None = None
) -> DataFrame:
    """Settlement days against deposit days for the gateways that do not net refunds."""
    only = f"NOT {_in_list(NETTING)}"
    sett = settlement_daily(settlement.where(only), period, PAID_OUT)
    deposits = _scoped(
        bank_daily(bank.where(only)).selectExpr(
            "gateway", "bank_date AS settled_date", "bank_daily_deposit"
        ),
        "settled_date",
        period,
    )
    diff = "coalesce(bank_daily_deposit, 0) - coalesce(net, 0)"
    return sett.join(deposits, ["gateway", "settled_date"], "full").selectExpr(
        "gateway",
        "settled_date AS day",
        "coalesce(txns, 0) AS txns",
        "coalesce(gross, 0) AS gross",
        "coalesce(net, 0) AS net",
        "coalesce(fees, 0) AS fees",
        "coalesce(bank_daily_deposit, 0) AS bank_deposit",
        f"{diff} AS daily_diff",
        f"{outlier_flag(diff)} AS is_outlier",
    )


def refund_impact_monthly(settlement: DataFrame, gateway_refund: DataFrame) -> DataFrame:
    """Refunds by settlement month: GW_A from its refund file, others from settlement rows.

    Each gateway also has a total row without month.
    """
    from_file = gateway_refund.where(_in_list(NETTING)).selectExpr(
        "gateway", "settled_date", "amount AS gross", "settled_amount AS net"
    )
    from_rows = settlement.where(f"is_refund AND NOT {_in_list(NETTING)}").selectExpr(
        "gateway", "settled_date", "sett_gross AS gross", "sett_net AS net"
    )
    months = group(
        union_all([from_file, from_rows]).selectExpr(
            "gateway", f"{month_start('settled_date')} AS month", "gross", "net"
        ),
        ["gateway", "month"],
        "count(*) AS n_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
    )
    return _with_gateway_totals(months, ["n_rows", "gross", "net"])


def bank_scorecard(
    settlement: DataFrame, bank: DataFrame, gap_base: str = "bank_deposit"
) -> DataFrame:
    """Gap over the months in which both sides have rows, per gateway and overall."""
    sums = group(
        bank_monthly(settlement, bank).where("reconcilable"),
        "gateway",
        "count(*) AS matched_months",
        f"{total('sett_net')} AS sett_net",
        f"{total('bank_deposit')} AS bank_deposit",
    )
    pct = safe_pct("bank_deposit - sett_net", gap_base)
    return (
        with_totals(sums, ["gateway"], "matched_months", "sett_net", "bank_deposit")
        .selectExpr("*", "bank_deposit - sett_net AS gap", f"{pct} AS gap_pct")
        .selectExpr("*", f"{gap_status('gap_pct')} AS status")
    )


def bank_uncovered(settlement: DataFrame, bank: DataFrame) -> DataFrame:
    """Deposits in months for which the gateway has no settlement rows."""
    return group(
        bank_monthly(settlement, bank).where("txns = 0 AND month IS NOT NULL"),
        "gateway",
        "count(*) AS months",
        "sum(deposits) AS deposits",
        f"{total('bank_deposit')} AS bank_total",
    )


def bank_period_check(settlement: DataFrame, bank: DataFrame, period: Period) -> DataFrame:
    """Net of all gateways against all deposits of a period, in one row."""
    sett = settlement_daily(settlement, period).selectExpr(
        "txns", "gross", "net", "CAST(0 AS BIGINT) AS deposits", "CAST(0 AS DECIMAL(18,2)) AS deposit"
    )
    dep = bank_daily(_scoped(bank, "bank_date", period)).selectExpr(
        "CAST(0 AS BIGINT) AS txns",
        "CAST(0 AS DECIMAL(18,2)) AS gross",
        "CAST(0 AS DECIMAL(18,2)) AS net",
        "deposits",
        "bank_daily_deposit AS deposit",
    )
    sums = group(
        sett.unionByName(dep),
        [],
        "sum(txns) AS sett_rows",
        f"{total('gross')} AS sett_gross",
        f"{total('net')} AS sett_net",
        "sum(deposits) AS deposits",
        f"{total('deposit')} AS bank_deposit",
    )
    return sums.selectExpr(
        "*",
        "bank_deposit - sett_net AS gap",
        safe_pct("bank_deposit - sett_net", "sett_net") + " AS gap_pct",
    )


def bank_gap_daily_alert(base: DataFrame, limit: int = DAILY_ALERT) -> DataFrame:
    """Days with a deposit whose gap to the traced net exceeds ``limit``."""
    days = group(
        base.where("bank_date IS NOT NULL"),
        ["settled_date", "gateway"],
        f"{total('sett_net')} AS sett_net",
        "max(bank_daily_deposit) AS bank_deposit",
    )
    return days.selectExpr("*", "bank_deposit - sett_net AS gap").where(F.abs("gap") > limit)
