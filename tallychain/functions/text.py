"""Id and label expressions.

All functions in this package take and return Spark SQL expression text, for
use in ``selectExpr``, ``where`` and ``expr``: one call per expression instead
of one per operator, which keeps plan building cheap.
"""

from __future__ import annotations

from tallychain.config import PARTNER_PREFIXES, PATTERNS, ROUTES


def strip_quotes(x: str) -> str:
    """Remove the literal single quotes some files wrap around values."""
    return f"btrim({x}, chr(39))"


def order_prefix(hub_id: str, settlement_id: str) -> str:
    """First '_' token of the hub id, or of the settlement id if there is none."""
    return f"split_part(coalesce({hub_id}, {settlement_id}), '_', 1)"


def order_pattern(order_id: str) -> str:
    """Id family as ``family_*``; ``startswith`` keeps '_' literal, LIKE would not."""
    arms = " ".join(f"WHEN startswith({order_id}, '{p}_') THEN '{p}_*'" for p in PATTERNS)
    return f"CASE {arms} ELSE 'other' END"


def order_pattern_regex(order_id: str) -> str:
    """Leading letters before the first '_' as ``letters_*``, else ``other``."""
    return (
        f"CASE WHEN {order_id} RLIKE '^[a-zA-Z]+_' "
        f"THEN concat(regexp_extract({order_id}, '^([a-zA-Z]+)_', 1), '_*') ELSE 'other' END"
    )


def expected_ledger(pattern: str) -> str:
    """Ledger table an id family is booked in; null when it has none."""
    arms = " ".join(f"WHEN '{p}' THEN '{t}'" for p, t in ROUTES.items())
    return f"CASE {pattern} {arms} END"


def is_partner_wallet(order_id: str) -> str:
    tests = " OR ".join(f"startswith({order_id}, '{p}')" for p in PARTNER_PREFIXES)
    return f"({tests})"


def is_adjustment(gateway: str, settlement_id: str) -> str:
    """Gateway bookkeeping rows that never had an order."""
    return (
        f"coalesce(({gateway} = 'GW_C' AND startswith({settlement_id}, 'ADJ_')) "
        f"OR ({gateway} = 'GW_A' AND startswith({settlement_id}, 'w-')), false)"
    )


def null_label(x: str, label: str) -> str:
    return f"coalesce({x}, '{label}')"
