"""Money expressions. Amounts are decimals; doubles only leave as percentages."""

from __future__ import annotations

from tallychain.config import (
    CLEAN_BELOW_PCT,
    DAILY_OUTLIER,
    MONEY,
    MONEY_SUM,
    REVIEW_BELOW_PCT,
)


def money(x: str) -> str:
    """Decimal of a number or text; null for junk."""
    return f"try_cast({x} AS {MONEY})"


coerce_numeric = money


def total(x: str, where: str | None = None) -> str:
    """Sum that is 0 over no rows."""
    return f"coalesce({total_or_null(x, where)}, 0)"


def total_or_null(x: str, where: str | None = None) -> str:
    picked = f"CASE WHEN {where} THEN {x} END" if where else x
    return f"CAST(sum({picked}) AS {MONEY_SUM})"


def safe_pct(part: str, whole: str) -> str:
    """part / whole in percent as a double, 0 when whole is 0 or null."""
    return f"coalesce(try_divide(CAST({part} AS DOUBLE) * 100, CAST({whole} AS DOUBLE)), 0D)"


def settlement_net(gateway: str, gross: str, fee: str, tax: str, file_net: str) -> str:
    """Net by gateway: the file's own net, except where none is delivered (GW_D)."""
    computed = f"{gross} - coalesce({fee}, 0) - coalesce({tax}, 0)"
    return f"CAST(CASE WHEN {gateway} = 'GW_D' THEN {computed} ELSE {file_net} END AS {MONEY})"


def settlement_fee(gateway: str, fee: str, tax: str) -> str:
    """Positive fee including tax. GW_B delivers one negative total that includes tax."""
    both = f"coalesce({fee}, 0) + coalesce({tax}, 0)"
    return (
        f"CAST(CASE WHEN {gateway} = 'GW_B' THEN abs(coalesce({fee}, 0)) "
        f"ELSE {both} END AS {MONEY})"
    )


def fee_sign_class(signed_fee: str) -> str:
    """Negative = charged to the merchant. A null fee falls through to credited."""
    return (
        f"CASE WHEN {signed_fee} < 0 THEN 'charged' WHEN {signed_fee} = 0 THEN 'none' "
        f"ELSE 'credited' END"
    )


def outlier_flag(diff: str) -> str:
    return f"abs({diff}) > {DAILY_OUTLIER}"


def gap_status(pct: str) -> str:
    return (
        f"CASE WHEN abs({pct}) < {CLEAN_BELOW_PCT} THEN 'CLEAN' "
        f"WHEN abs({pct}) < {REVIEW_BELOW_PCT} THEN 'REVIEW' ELSE 'MISMATCH' END"
    )
