"""Gateway fees (MDR)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallychain.config import Period
from tallychain.functions.money import fee_sign_class, safe_pct, total
from tallychain.functions.text import order_pattern
from tallychain.operators.base import one_hub_row
from tallychain.operators.frames import group, top_k, union_all, with_totals
from tallychain.operators.hub_gateway import KEY, hub_keys, hub_scope
from tallychain.operators.settlements import keyed
from tallychain.operators.trace import one_per_order, profile


def in_scope(settlement: DataFrame, hub: DataFrame, period: Period | None = None) -> DataFrame:
    """Forward settlement rows of successful hub orders."""
    return keyed(settlement.where("is_forward")).join(hub_keys(hub, period), KEY, "left_semi")


def mdr_by_gateway(settlement: DataFrame) -> DataFrame:
    """Fees in percent of gross, per gateway and blended."""
    sums = group(
        settlement.where("is_forward"),
        "gateway",
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_fee')} AS fees",
    )
    return with_totals(sums, ["gateway"], "n_rows", "gross", "fees").selectExpr(
        "*", safe_pct("fees", "gross") + " AS mdr_pct"
    )


def fee_summary(settlement: DataFrame, hub: DataFrame, period: Period | None = None) -> DataFrame:
    """Gross, fee, tax, net and the spread of the fee (without tax)."""
    fee = "(sett_fee - sett_tax)"
    by_key = group(
        keyed(settlement.where("is_forward")),
        KEY,
        "count(*) AS n",
        "sum(sett_gross) AS gross",
        f"sum({fee}) AS fee",
        "sum(sett_tax) AS tax",
        "sum(sett_net) AS net",
        f"count_if({fee} > 0) AS with_fee",
        f"count_if({fee} = 0) AS zero_fee",
        f"min({fee}) AS min_fee",
        f"max({fee}) AS max_fee",
    )
    sums = group(
        by_key.join(hub_keys(hub, period), KEY, "left_semi"),
        "gateway",
        "count(*) AS hub_txns",
        "sum(n) AS sett_rows",
        f"{total('gross')} AS gross",
        f"{total('fee')} AS fee",
        f"{total('tax')} AS tax",
        f"{total('fee + tax')} AS fee_incl_tax",
        f"{total('net')} AS net",
        "sum(with_fee) AS rows_with_fee",
        "sum(zero_fee) AS rows_zero_fee",
        "min(min_fee) AS min_fee",
        "max(max_fee) AS max_fee",
    )
    return sums.selectExpr(
        "*",
        "CAST(fee AS DOUBLE) / sett_rows AS avg_fee",
        safe_pct("fee", "gross") + " AS mdr_pct",
    )


def _fee_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    return group(
        rows,
        keys,
        "count(*) AS txns",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_fee - sett_tax')} AS fee",
        f"{total('sett_tax')} AS tax",
        f"{total('sett_fee')} AS fee_incl_tax",
        f"{total('sett_net')} AS net",
    )


def fee_by_method(settlement: DataFrame, hub: DataFrame, period: Period | None = None) -> DataFrame:
    rows = _fee_groups(
        in_scope(settlement, hub, period), ["gateway", "method", "network", "card_type"]
    )
    return rows.selectExpr("*", f"round({safe_pct('fee', 'gross')}, 4) AS mdr_pct")


def fee_by_batch(settlement: DataFrame, hub: DataFrame, period: Period | None = None) -> DataFrame:
    return _fee_groups(in_scope(settlement, hub, period), ["gateway", "sett_utr", "settled_date"])


def fee_sign_check(settlement: DataFrame) -> DataFrame:
    """Signed fees by row type and status beside net minus gross, which they must explain."""
    return group(
        settlement,
        ["gateway", "sett_txn_type", "payment_type", "txn_status"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        f"{total('signed_fee')} AS signed_fee",
        f"{total('sett_net - sett_gross')} AS net_minus_gross",
    )


def fee_vs_nofee(settlement: DataFrame, hub: DataFrame) -> DataFrame:
    rows = in_scope(settlement, hub).selectExpr("*", f"{fee_sign_class('signed_fee')} AS fee_class")
    return group(
        rows,
        ["gateway", "fee_class", "method"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        f"{total('signed_fee')} AS signed_fee",
    )


def fee_mode_matrix(settlement: DataFrame, hub: DataFrame) -> DataFrame:
    return group(
        in_scope(settlement, hub),
        ["gateway", "method"],
        "count_if(signed_fee < 0) AS has_fee",
        "count_if(signed_fee = 0) AS no_fee",
        "count(*) AS n_rows",
        f"{total('signed_fee')} AS signed_fee",
    )


def _charged_rows(settlement: DataFrame, orders: DataFrame, *extra: str) -> DataFrame:
    hubs = orders.selectExpr(
        "gateway", "settle_key AS gw_key", "order_id", "amount AS hub_amount", "created_date", *extra
    )
    return (
        keyed(settlement.where("is_forward AND signed_fee < 0"))
        .join(hubs, KEY)
        .select(
            "gateway", "order_id", "hub_amount", "created_date", "sett_gross", "sett_net",
            "sett_fee", "sett_tax", "method", "network", "card_type", "payment_type",
            "settled_date", "sett_utr", *extra,
        )
    )


def fee_rows(
    settlement: DataFrame, hub: DataFrame, period: Period | None = None, k: int | None = None
) -> DataFrame:
    """Rows that were charged a fee, with their order; the ``k`` highest fees if given."""
    rows = _charged_rows(settlement, one_hub_row(hub_scope(hub, period)))
    if k is None:
        return rows
    return top_k(rows, k, "sett_fee DESC", "sett_gross DESC", "order_id", "settled_date", "method")


def describe_fee(settlement: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles of the fee per gateway.

    Equal fees are counted first. Quartiles are exact and no task holds all values
    of a gateway: counts of fee ranges tell which range holds a quartile, and only
    that range is ordered.
    """
    values = group(
        settlement.where("is_forward"), ["gateway", "sett_fee"], "count(*) AS n"
    ).selectExpr("*", "CAST(sett_fee AS DOUBLE) AS fee", f"floor(sett_fee / {FEE_RANGE}) AS fee_range")
    sums = group(
        values,
        "gateway",
        "sum(n) AS n_rows",
        "CAST(sum(sett_fee * n) AS DOUBLE) AS s1",
        "CAST(sum(CAST(sett_fee AS DECIMAL(12,2)) * CAST(sett_fee AS DECIMAL(12,2)) * n) AS DOUBLE) AS s2",
        "min(fee) AS min_fee",
        "max(fee) AS max_fee",
    )
    return sums.join(_quartiles(values), "gateway", "left").selectExpr(
        "gateway",
        "n_rows",
        "round(s1 / n_rows, 4) AS mean_fee",
        "round(sqrt(try_divide(s2 - s1 * s1 / n_rows, n_rows - 1)), 4) AS std_fee",
        "min_fee",
        # Halfway between cents at most: four digits are exact.
        "round(p25, 4) AS p25",
        "round(p50, 4) AS p50",
        "round(p75, 4) AS p75",
        "max_fee",
    )


#: Width of the ranges that fees are counted in: at most this many times 100 cents.
FEE_RANGE = 10


def _quartiles(values: DataFrame) -> DataFrame:
    """p25, p50, p75 per gateway of ``values`` (gateway, fee, fee_range, n), interpolated."""
    ranges = group(values.where("fee IS NOT NULL"), ["gateway", "fee_range"], "sum(n) AS m").selectExpr(
        "gateway",
        "fee_range",
        "m",
        "sum(m) OVER (PARTITION BY gateway ORDER BY fee_range) - m AS before",
        "sum(m) OVER (PARTITION BY gateway) AS total",
    )
    # The two places around each quartile, counted from 0, and the range each lies in.
    places = ranges.selectExpr(
        "*", "explode(array(0.25D, 0.5D, 0.75D)) AS q"
    ).selectExpr("*", "q * (total - 1) AS place").selectExpr(
        "*", "explode(array_distinct(array(floor(place), ceil(place)))) AS at"
    ).where("at >= before AND at < before + m")
    inside = values.join(places.select("gateway", "fee_range").distinct(), ["gateway", "fee_range"], "left_semi")
    ordered = inside.selectExpr(
        "gateway",
        "fee_range",
        "fee",
        "n",
        "sum(n) OVER (PARTITION BY gateway, fee_range ORDER BY fee) - n AS below",
    )
    found = places.join(ordered, ["gateway", "fee_range"]).where(
        "at - before >= below AND at - before < below + n"
    )
    share = "fee * (1 - abs(place - at))"
    return group(
        found,
        "gateway",
        *[f"sum(CASE WHEN q = {q}D THEN {share} END) AS p{q[2:].ljust(2, '0')}" for q in ("0.25", "0.5", "0.75")],
    )


def fee_trace_to_ledger(
    settlement: DataFrame, hub: DataFrame, ledger: DataFrame, period: Period | None = None
) -> DataFrame:
    """Charged rows with every ledger (revenue, net income, booking) that knows the order."""
    tables = ("ledger_revenue", "ledger_net_income", "ledger_booking")
    known = union_all(
        [
            one_per_order(ledger, t).selectExpr(
                "order_id", f"'{t}' AS ledger_table", "ledger_date", "ledger_amount",
                "mode AS ledger_mode", "mobile AS ledger_mobile", "plan AS ledger_plan",
            )
            for t in tables
        ]
    )
    # The ledgers go onto the hub first: the settlement rows are shuffled once.
    orders = one_hub_row(hub_scope(hub, period)).join(known, "order_id", "left")
    extra = [c for c in known.columns if c != "order_id"]
    return _charged_rows(settlement, orders, *extra).selectExpr(
        "*", f"{order_pattern('order_id')} AS order_pattern"
    )


def fee_by_dimension(trace: DataFrame) -> DataFrame:
    """Fees by family, ledger, method, ledger mode and plan; unknown shown as NONE."""
    return profile(
        trace,
        {
            "pattern": "order_pattern",
            "ledger_table": "coalesce(ledger_table, 'NONE')",
            "method": "method",
            "ledger_mode": "coalesce(ledger_mode, 'NONE')",
            "plan": "coalesce(ledger_plan, 'NONE')",
        },
        "sett_gross AS gross",
        "sett_fee AS fees",
    )
