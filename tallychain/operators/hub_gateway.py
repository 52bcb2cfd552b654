"""Layer 2: the hub against the gateways' own transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallychain.config import Period
from tallychain.functions.dates import in_period
from tallychain.functions.money import safe_pct, total
from tallychain.functions.text import order_pattern_regex
from tallychain.operators.frames import group, key_set, keys_of, union_all, with_totals
from tallychain.operators.trace import amount_mismatch, profile

KEY = ["gateway", "gw_key"]


def hub_scope(hub: DataFrame, period: Period | None = None) -> DataFrame:
    """Successful hub rows, created in ``period`` if given."""
    rows = hub.where("status = 'SUCCESS'")
    return rows if period is None else rows.where(in_period("created_date", period))


def hub_keys(hub: DataFrame, period: Period | None = None) -> DataFrame:
    """Gateway keys of the hub rows in scope."""
    return keys_of(hub_scope(hub, period).withColumnRenamed("settle_key", "gw_key"), *KEY)


def gateway_scope(gateway_txn: DataFrame, period: Period | None = None) -> DataFrame:
    return gateway_txn if period is None else gateway_txn.where(in_period("txn_date", period))


def scope_by_gateway(hub: DataFrame, period: Period | None = None) -> DataFrame:
    """Distinct ids and amount in scope: the denominator of every rate."""
    return group(
        hub_scope(hub, period),
        "gateway",
        "count(DISTINCT order_id) AS hub_ids",
        f"{total('amount')} AS hub_amount",
    )


def paired(
    hub: DataFrame,
    gateway_txn: DataFrame,
    hub_period: Period | None = None,
    gateway_period: Period | None = None,
) -> DataFrame:
    """One row per gateway key with what either side holds under it.

    Both sides are stacked and grouped instead of joined: one shuffle gives the
    matched rows and both kinds of unmatched ones, and repeated keys on either
    side neither fan out nor pile up in one task. The amount of a hub order that was
    delivered twice counts once.
    """
    zero = "CAST(0 AS DECIMAL(18,2))"
    hubs = hub_scope(hub, hub_period).selectExpr(
        "gateway", "settle_key AS gw_key", "1 AS h", "amount AS h_amount",
        "0 AS g", f"{zero} AS g_amount", "0 AS ok", f"{zero} AS ok_amount",
    )
    in_period_ok = "is_success"
    if gateway_period is not None:
        in_period_ok += f" AND {in_period('txn_date', gateway_period)}"
    gws = gateway_txn.selectExpr(
        *KEY, "0 AS h", "CAST(NULL AS DECIMAL(18,2)) AS h_amount", "1 AS g", "amount AS g_amount",
        f"int({in_period_ok}) AS ok", f"CASE WHEN {in_period_ok} THEN amount ELSE {zero} END AS ok_amount",
    )
    sums = [f"sum({c}) AS {c}" for c in ("h", "g", "g_amount", "ok", "ok_amount")]
    return group(union_all([hubs, gws]), KEY, "min(h_amount) AS h_amount", *sums)


def l2_matched(hub: DataFrame, gateway_txn: DataFrame, period: Period | None = None) -> DataFrame:
    """Matched ids, both amounts, their difference, and the match rate."""
    pairs = paired(hub, gateway_txn, period)
    return group(
        pairs.where("h > 0"),
        "gateway",
        "count_if(g > 0) AS matched_ids",
        total("h_amount", "g > 0") + " AS hub_amount",
        total("g_amount", "g > 0") + " AS gateway_amount",
        "count(*) AS hub_ids",
    ).selectExpr(
        "*", "hub_amount - gateway_amount AS diff", safe_pct("matched_ids", "hub_ids") + " AS match_pct"
    )


def l2_hub_only(hub: DataFrame, gateway_txn: DataFrame, period: Period | None = None) -> DataFrame:
    rows = hub_scope(hub, period).withColumnRenamed("settle_key", "gw_key")
    return group(
        rows.join(key_set(gateway_txn, *KEY), KEY, "left_anti"),
        "gateway",
        "count(DISTINCT order_id) AS hub_only_ids",
        f"{total('amount')} AS hub_only_amount",
    )


def l2_gateway_total(gateway_txn: DataFrame, period: Period | None = None) -> DataFrame:
    """Successful rows by the gateway's own status and date."""
    return group(
        gateway_scope(gateway_txn.where("is_success"), period),
        "gateway",
        "count(DISTINCT gw_key) AS gateway_ids",
        f"{total('amount')} AS gateway_amount",
    )


def gateway_only(
    hub: DataFrame, gateway_txn: DataFrame, period: Period | None = None
) -> DataFrame:
    """Successful gateway keys without a successful hub row."""
    rows = group(
        gateway_scope(gateway_txn.where("is_success"), period),
        KEY,
        "count(*) AS n",
        "sum(amount) AS amount",
    )
    return rows.join(hub_keys(hub), KEY, "left_anti")


def l2_gateway_only(
    hub: DataFrame, gateway_txn: DataFrame, period: Period | None = None
) -> DataFrame:
    return group(
        gateway_only(hub, gateway_txn, period),
        "gateway",
        "count(*) AS gateway_only_ids",
        f"{total('amount')} AS gateway_only_amount",
    )


def l2_summary(hub: DataFrame, gateway_txn: DataFrame, period: Period | None = None) -> DataFrame:
    """All four counts per gateway and overall, from one grouping."""
    counts = [
        "count_if(h > 0) AS hub_ids",
        "count_if(h > 0 AND g > 0) AS matched_ids",
        "count_if(h > 0 AND g = 0) AS hub_only_ids",
        "count_if(ok > 0) AS gateway_ids",
        "count_if(ok > 0 AND h = 0) AS gateway_only_ids",
        total("h_amount", "h > 0 AND g > 0") + " AS hub_amount",
        total("g_amount", "h > 0 AND g > 0") + " AS gateway_amount",
    ]
    names = [c.rsplit(" ", 1)[1] for c in counts]
    rows = group(paired(hub, gateway_txn, period, period), "gateway", *counts)
    return with_totals(rows, ["gateway"], *names).selectExpr(
        "*", safe_pct("matched_ids", "hub_ids") + " AS match_pct"
    )


def l2_mismatch_profile(hub: DataFrame, gateway_txn: DataFrame) -> DataFrame:
    """Amount mismatches by every attribute that might explain them."""
    return profile(
        amount_mismatch(hub, gateway_txn),
        {
            "split": "CASE WHEN gw_amount = 0 THEN 'zero' ELSE 'partial' END",
            "gw_status": "gw_status",
            "mode": "gw_mode",
            "error": "error_description",
            "flow": "payment_flow",
            "pattern": order_pattern_regex("order_id"),
            "has_subvention": "subvention > 0",
            "has_discount": "coalesce(discount, 0) <> 0",
        },
        "hub_amount",
        "gw_amount",
        "subvention",
        "discount",
    )


def l2_gateway_only_presence(hub: DataFrame, gateway_txn: DataFrame) -> DataFrame:
    """Whether gateway-only keys occur in the hub under another status."""
    presence = group(
        hub.withColumnRenamed("settle_key", "gw_key"),
        KEY,
        "max(status) AS hub_status",
        "max(source_month) AS hub_month",
        "bool_or(status = 'SUCCESS') AS has_success",
    )
    rows = gateway_only(hub, gateway_txn).join(presence, KEY, "left")
    return group(
        rows.selectExpr("*", "coalesce(hub_status, 'NOT_IN_HUB') AS found"),
        ["gateway", "found"],
        "count(*) AS ids",
        f"{total('amount')} AS amount",
        "min(hub_month) AS first_month",
        "max(hub_month) AS last_month",
    )


def l2_refund_match(
    hub: DataFrame, hub_refund: DataFrame, gateway_refund: DataFrame, period: Period | None = None
) -> DataFrame:
    """Successful hub refunds of in-scope orders against the gateways' refunds."""
    orders = hub if period is None else hub.where(in_period("created_date", period))
    scoped = hub_refund.where("refund_status = 'SUCCESS'").join(
        keys_of(orders, "order_id"), "order_id", "left_semi"
    )
    key = "CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS gw_key"
    hubs = group(
        scoped.selectExpr("*", key),
        KEY,
        "count(DISTINCT refund_unique_id) AS n",
        "sum(refund_amount) AS amount",
    )
    gws = group(
        gateway_refund.withColumnRenamed("refund_key", "gw_key"),
        KEY,
        "count(*) AS gw_n",
        "sum(amount) AS gw_amount",
    )
    return group(
        hubs.join(gws, KEY, "full"),
        "gateway",
        "coalesce(sum(n), 0) AS hub_refunds",
        f"{total('amount')} AS hub_refund_amount",
        "coalesce(sum(gw_n), 0) AS gateway_refunds",
        f"{total('gw_amount')} AS gateway_refund_amount",
        "coalesce(sum(CASE WHEN gw_n > 0 THEN n END), 0) AS matched_refunds",
        total("amount", "gw_n > 0") + " AS matched_amount",
    )


def refund_by_gateway(hub: DataFrame, hub_refund: DataFrame) -> DataFrame:
    """Refunds of known hub orders with the successful part, by the order's gateway."""
    refunds = group(
        hub_refund,
        "order_id",
        "count(*) AS n",
        "sum(refund_amount) AS amount",
        "count_if(refund_status = 'SUCCESS') AS ok",
        "sum(CASE WHEN refund_status = 'SUCCESS' THEN refund_amount ELSE 0 END) AS ok_amount",
        "min(refund_date) AS first_date",
        "max(refund_date) AS last_date",
    )
    return group(
        refunds.join(key_set(hub, "order_id", "gateway"), "order_id"),
        "gateway",
        "sum(n) AS refunds",
        f"{total('amount')} AS refund_amount",
        "sum(ok) AS success_refunds",
        f"{total('ok_amount')} AS success_amount",
        "min(first_date) AS first_date",
        "max(last_date) AS last_date",
    )
