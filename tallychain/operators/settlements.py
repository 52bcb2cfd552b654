"""Layer 3: gateway transactions against settlement rows, and settlement reports.

A key has many settlement rows, so settlements are summed per key before they
meet the hub. Amounts of the hub and the gateway are thus counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallychain.config import TOP_BATCHES, Period
from tallychain.functions.dates import in_period, month_label
from tallychain.functions.money import safe_pct, total
from tallychain.functions.status import hub_category
from tallychain.operators.base import one_hub_row
from tallychain.operators.frames import group, key_set, keys_of, top_k, with_totals
from tallychain.operators.hub_gateway import KEY, hub_keys, hub_scope


def gateway_by_key(gateway_txn: DataFrame) -> DataFrame:
    return group(gateway_txn, KEY, "sum(amount) AS gw_amount", "count(*) AS gw_rows")


def keyed(settlement: DataFrame) -> DataFrame:
    return settlement.withColumnRenamed("settlement_order_id", "gw_key")


def settled_by_key(settlement: DataFrame) -> DataFrame:
    """Settlement rows reduced to one per key."""
    return group(
        keyed(settlement),
        KEY,
        "count(*) AS sett_rows",
        "sum(sett_gross) AS gross",
        "sum(sett_net) AS net",
        "sum(sett_fee) AS fees",
        "sum(sett_tax) AS tax",
        "min(settled_date) AS first_date",
        "max(settled_date) AS last_date",
    )


def chain(
    hub: DataFrame,
    gateway_txn: DataFrame,
    settlement: DataFrame,
    period: Period | None = None,
    how: str = "left",
) -> DataFrame:
    """Hub row, its gateway amount and its settlement sums: one row per gateway key."""
    hubs = one_hub_row(hub_scope(hub, period)).withColumnRenamed("settle_key", "gw_key")
    return (
        hubs.join(gateway_by_key(gateway_txn), KEY)
        .join(settled_by_key(settlement.where("is_forward")), KEY, how)
    )


def l3_settled(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame, period: Period | None = None
) -> DataFrame:
    """Hub, gateway and settlement counts and amounts, fees, span and distinct batches.

    Settlements are read once: summed per (id, batch) and joined with the orders in scope,
    whose amounts count on the first batch of an id. Rows stay where the join put them until
    they are summed up by gateway and batch, and none is expanded.
    """
    parts = group(
        keyed(settlement.where("is_forward")),
        [*KEY, "sett_utr"],
        "count(*) AS n",
        "sum(sett_gross) AS gross",
        "sum(sett_net) AS net",
        "sum(sett_fee) AS fees",
        "sum(sett_tax) AS tax",
        "min(settled_date) AS first_date",
        "max(settled_date) AS last_date",
    )
    orders = (
        one_hub_row(hub_scope(hub, period))
        .withColumnRenamed("settle_key", "gw_key")
        .join(gateway_by_key(gateway_txn), KEY)
        .select(*KEY, "amount", "gw_amount")
    )
    # An id has at most a row a batch here, whatever the number of its settlement rows.
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy("sett_utr")) == 1
    joined = orders.join(parts, KEY, "left").withColumn("first", first)
    return group(
        joined,
        "gateway",
        "count_if(first) AS hub_txns",
        f"{total('amount', 'first')} AS hub_amount",
        f"{total('gw_amount', 'first')} AS gateway_amount",
        "count_if(first AND n IS NOT NULL) AS settled_txns",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees - tax')} AS commission",
        f"{total('tax')} AS tax",
        "min(first_date) AS first_date",
        "max(last_date) AS last_date",
        "count(DISTINCT sett_utr) AS batches",
    )


def l3_unsettled(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame, period: Period | None = None
) -> DataFrame:
    rows = chain(hub, gateway_txn, settlement, period).where("sett_rows IS NULL")
    return group(rows, "gateway", "count(*) AS unsettled", f"{total('amount')} AS amount")


def l3_summary(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame, period: Period | None = None
) -> DataFrame:
    """Settlement rate per gateway and overall."""
    sums = group(
        chain(hub, gateway_txn, settlement, period),
        "gateway",
        "count(*) AS hub_txns",
        "count(sett_rows) AS settled_txns",
        f"{total('amount')} AS hub_amount",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )
    return with_totals(
        sums, ["gateway"], "hub_txns", "settled_txns", "hub_amount", "gross", "net", "fees"
    ).selectExpr("*", safe_pct("settled_txns", "hub_txns") + " AS settled_pct")


def l3_unsettled_reason(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame, period: Period
) -> DataFrame:
    """Why rows have no forward settlement in ``period``."""
    inside = f"is_forward AND {in_period('settled_date', period)}"
    by_key = group(
        keyed(settlement),
        KEY,
        f"count_if({inside}) AS inside",
        f"count_if(is_forward AND NOT {in_period('settled_date', period)}) AS other_period",
    )
    rows = one_hub_row(hub_scope(hub)).withColumnRenamed("settle_key", "gw_key").join(
        key_set(gateway_txn, *KEY), KEY, "left_semi"
    )
    reason = (
        "CASE WHEN inside IS NULL THEN 'never settled' WHEN other_period > 0 THEN 'settled in another period' "
        "ELSE 'refund rows only' END"
    )
    return group(
        rows.join(by_key, KEY, "left")
        .where("coalesce(inside, 0) = 0")
        .selectExpr("gateway", "amount", f"{reason} AS reason"),
        ["gateway", "reason"],
        "count(*) AS n_rows",
        f"{total('amount')} AS amount",
    )


def l3_batches(
    hub: DataFrame,
    settlement: DataFrame,
    gateway: str | None = None,
    k: int | None = None,
    period: Period | None = None,
) -> DataFrame:
    """Settlement batches of in-scope orders; the ``k`` largest by gross if given."""
    rows = keyed(settlement.where("is_forward"))
    if gateway is not None:
        rows = rows.where(f"gateway = '{gateway}'")
    parts = group(
        rows,
        [*KEY, "sett_utr", "settled_date"],
        "count(*) AS n",
        "sum(sett_gross) AS gross",
        "sum(sett_net) AS net",
        "sum(sett_fee) AS fees",
    )
    batches = group(
        parts.join(hub_keys(hub, period), KEY, "left_semi"),
        ["gateway", "sett_utr", "settled_date"],
        "count(*) AS txns",
        "sum(n) AS sett_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )
    return batches if k is None else top_k(batches, k, "gross DESC", "sett_utr", "settled_date")


def top_batches(hub: DataFrame, settlement: DataFrame, gateway: str) -> DataFrame:
    return l3_batches(hub, settlement, gateway, TOP_BATCHES)


def settlement_link_count(settlement: DataFrame, gateway_txn: DataFrame) -> DataFrame:
    """Settlement rows and keys that find a gateway transaction."""
    found = settled_by_key(settlement).join(key_set(gateway_txn, *KEY), KEY, "left_semi")
    return group(
        found, "gateway", "sum(sett_rows) AS linked_rows", "count(*) AS linked_keys"
    )


def embedded_settled_breakdown(
    gateway_txn: DataFrame, settlement: DataFrame, gateway: str = "GW_D"
) -> DataFrame:
    """Transactions of the gateway without a settlement file, by settled flag."""
    only = f"gateway = '{gateway}'"
    keys = key_set(keyed(settlement.where(only)), *KEY).selectExpr("*", "1 AS has")
    rows = group(gateway_txn.where(only), [*KEY, "status"], "count(*) AS n", "sum(amount) AS amount")
    return group(
        rows.join(keys, KEY, "left").selectExpr("*", "coalesce(has, 0) AS settled"),
        ["status", "settled"],
        "sum(n) AS n_rows",
        f"{total('amount')} AS amount",
    )


# --- settlements traced back to the hub ------------------------------------------------


def traced_back(settlement: DataFrame, gateway_txn: DataFrame, hub: DataFrame) -> DataFrame:
    """Settlement sums per key with the hub row found through the gateway transaction.

    GW_D settles inside its transactions, so its own row is the gateway row. A hub order
    delivered twice is one row here as everywhere.
    """
    gws = key_set(gateway_txn, *KEY).selectExpr("*", "gw_key AS found_key")
    hubs = one_hub_row(hub).selectExpr(
        "gateway", "settle_key AS gw_key", "order_id", "status", "source_month", "created_date"
    )
    rows = (
        settled_by_key(settlement)
        .join(gws, KEY, "left")
        .join(hubs, KEY, "left")
        .selectExpr(
            "*", "CASE WHEN gateway = 'GW_D' THEN gw_key ELSE found_key END AS gateway_txn_id"
        )
    )
    through = "CASE WHEN gateway_txn_id IS NOT NULL THEN {0} END AS {0}"
    return rows.selectExpr(
        *KEY, "gateway_txn_id", "sett_rows", "gross", "net", "fees", "tax",
        *[through.format(c) for c in ("order_id", "status", "source_month", "created_date")],
    )


def settlement_universe(
    settlement: DataFrame, gateway_txn: DataFrame, hub: DataFrame, month: str
) -> DataFrame:
    """Every settlement row by what it is in the hub; share of the gateway's rows."""
    category = hub_category("order_id", "gateway_txn_id", "status", "source_month", month)
    rows = group(
        traced_back(settlement, gateway_txn, hub).selectExpr("*", f"{category} AS category"),
        ["gateway", "category"],
        "sum(sett_rows) AS sett_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )
    # At most five rows per gateway reach this window.
    share = "CAST(sett_rows AS DOUBLE) * 100 / sum(sett_rows) OVER (PARTITION BY gateway)"
    return rows.selectExpr("*", f"{share} AS share_pct")


def settlement_type_mix(settlement: DataFrame) -> DataFrame:
    return group(
        settlement.selectExpr("*", "coalesce(sett_txn_type, 'NULL') AS txn_type"),
        ["gateway", "txn_type", "payment_type"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        f"{total('sett_fee')} AS fees",
    )


def amount_bridge(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame, period: Period | None = None
) -> DataFrame:
    """Hub, gateway, gross, net and fees of settled rows, the steps between, and the fee rate."""
    sums = group(
        chain(hub, gateway_txn, settlement, period, "inner"),
        "gateway",
        "count(*) AS hub_txns",
        f"{total('amount')} AS hub_amount",
        f"{total('gw_amount')} AS gateway_amount",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )
    return _bridge_steps(sums)


def _bridge_steps(sums: DataFrame) -> DataFrame:
    return sums.selectExpr(
        "*",
        "hub_amount - gateway_amount AS hub_minus_gateway",
        "gateway_amount - gross AS gateway_minus_gross",
        "gross - net AS gross_minus_net",
        safe_pct("fees", "gross") + " AS mdr_pct",
    )


def refund_deduction(
    settlement: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Refund rows settled for orders created in ``period``."""
    orders = hub if period is None else hub.where(in_period("created_date", period))
    scope = keys_of(orders.withColumnRenamed("settle_key", "gw_key"), *KEY)
    return group(
        settled_by_key(settlement.where("is_refund")).join(scope, KEY, "left_semi"),
        "gateway",
        "sum(sett_rows) AS refund_rows",
        f"{total('gross')} AS refund_gross",
        f"{total('net')} AS refund_net",
    )


def hub_refunds_done(
    hub_refund: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Successful refunds of orders created in ``period``, by the order's gateway."""
    orders = hub if period is None else hub.where(in_period("created_date", period))
    done = group(
        hub_refund.where("refund_status = 'SUCCESS'"),
        "order_id",
        "count(*) AS n",
        "sum(refund_amount) AS amount",
    )
    return group(
        one_hub_row(orders).select("order_id", "gateway").join(done, "order_id"),
        "gateway",
        "sum(n) AS refund_txns",
        f"{total('amount')} AS refund_amount",
    )


def bridge_summary(
    hub: DataFrame,
    gateway_txn: DataFrame,
    settlement: DataFrame,
    hub_refund: DataFrame,
    period: Period | None = None,
) -> DataFrame:
    """The bridge with totals, the net after successful hub refunds, and what it all cost.

    Refunds are those of all orders created in ``period``, whatever became of the
    payment; ``total_cost`` is fees and refunds.
    """
    measures = ["hub_txns", "hub_amount", "gateway_amount", "gross", "net", "fees"]
    rows = amount_bridge(hub, gateway_txn, settlement, period).select("gateway", *measures)
    refunds = hub_refunds_done(hub_refund, hub, period)
    joined = rows.join(refunds, "gateway", "full").selectExpr(
        "gateway", *[f"coalesce({m}, 0) AS {m}" for m in [*measures, "refund_txns", "refund_amount"]]
    )
    return with_totals(joined, ["gateway"], *measures, "refund_txns", "refund_amount").selectExpr(
        "*",
        "net - refund_amount AS adjusted_net",
        "fees + refund_amount AS total_cost",
        safe_pct("fees", "gross") + " AS mdr_pct",
        safe_pct("gross", "hub_amount") + " AS settled_pct",
    )


# --- settlement period views -------------------------------------------------------------


def _settled_in(settlement: DataFrame, period: Period | None) -> DataFrame:
    return settlement if period is None else settlement.where(in_period("settled_date", period))


def period_universe(
    settlement: DataFrame, gateway_txn: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Rows settled in ``period`` by the month and status of their hub row."""
    return group(
        traced_back(_settled_in(settlement, period), gateway_txn, hub).selectExpr(
            "*", "coalesce(source_month, 'NOT IN HUB') AS hub_month",
            "coalesce(status, 'N/A') AS hub_status",
        ),
        ["gateway", "hub_month", "hub_status"],
        "count(*) AS settled_ids",
        "sum(sett_rows) AS sett_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )


def source_month_waterfall(
    settlement: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Creation months inside each settlement month."""
    rows = _settled_in(settlement.where("is_forward"), period).selectExpr(
        "gateway", "settlement_order_id AS gw_key", f"{month_label('settled_date')} AS settled_month",
        "sett_gross", "sett_net",
    )
    parts = group(
        rows, [*KEY, "settled_month"], "count(*) AS n", "sum(sett_gross) AS gross", "sum(sett_net) AS net"
    )
    hubs = one_hub_row(hub).selectExpr("gateway", "settle_key AS gw_key", "source_month")
    return group(
        parts.join(hubs, KEY, "left").selectExpr(
            "*", "coalesce(source_month, 'NOT IN HUB') AS created_month"
        ),
        ["gateway", "settled_month", "created_month"],
        "sum(n) AS sett_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
    )


def period_summary(
    settlement: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Rows settled in ``period``, how many are in the hub, amounts and fee rate."""
    keys = key_set(hub.withColumnRenamed("settle_key", "gw_key"), *KEY).selectExpr("*", "true AS known")
    sums = group(
        settled_by_key(_settled_in(settlement.where("is_forward"), period)).join(keys, KEY, "left"),
        "gateway",
        "sum(sett_rows) AS sett_rows",
        "sum(CASE WHEN known THEN sett_rows ELSE 0 END) AS matched_rows",
        f"{total('gross')} AS gross",
        f"{total('net')} AS net",
        f"{total('fees')} AS fees",
    )
    return with_totals(
        sums, ["gateway"], "sett_rows", "matched_rows", "gross", "net", "fees"
    ).selectExpr(
        "*", safe_pct("matched_rows", "sett_rows") + " AS matched_pct",
        safe_pct("fees", "gross") + " AS mdr_pct",
    )


# --- refunds in settlements --------------------------------------------------------------


def refund_rows_by_origin(
    settlement: DataFrame, hub: DataFrame, period: Period | None = None
) -> DataFrame:
    """Refund rows settled in ``period`` by the month their order was created."""
    hubs = one_hub_row(hub).selectExpr("gateway", "settle_key AS gw_key", "source_month")
    rows = settled_by_key(_settled_in(settlement.where("is_refund"), period)).join(hubs, KEY, "left")
    return group(
        rows.selectExpr("*", "coalesce(source_month, 'NOT IN HUB') AS origin_month"),
        ["gateway", "origin_month"],
        "sum(sett_rows) AS refund_rows",
        f"{total('gross')} AS refund_amount",
    )


def refunds_settled(gateway_refund: DataFrame, period: Period | None = None) -> DataFrame:
    """Refunds by the day they were deducted. Dates are unquoted before the comparison."""
    return group(
        _settled_in(gateway_refund, period),
        "gateway",
        "count(DISTINCT refund_key) AS refund_ids",
        "count(*) AS refund_rows",
        f"{total('amount')} AS amount",
        f"{total('settled_amount')} AS settled_amount",
        "min(settled_date) AS first_date",
        "max(settled_date) AS last_date",
    )


def hub_refunds_by_refund_month(hub: DataFrame, hub_refund: DataFrame) -> DataFrame:
    refunds = group(
        hub_refund.selectExpr("*", f"{month_label('refund_date')} AS refund_month"),
        ["order_id", "refund_month"],
        "count(*) AS n",
        "sum(refund_amount) AS amount",
        "count_if(refund_status = 'SUCCESS') AS ok",
        "sum(CASE WHEN refund_status = 'SUCCESS' THEN refund_amount ELSE 0 END) AS ok_amount",
    )
    return group(
        refunds.join(key_set(hub, "order_id", "gateway"), "order_id"),
        ["gateway", "refund_month"],
        "sum(n) AS refunds",
        f"{total('amount')} AS refund_amount",
        "sum(ok) AS success_refunds",
        f"{total('ok_amount')} AS success_amount",
    )


def refund_rows_total(settlement: DataFrame) -> DataFrame:
    return group(
        settlement.where("is_refund"),
        "gateway",
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS refund_amount",
        f"{total('sett_net')} AS refund_net",
    )


def refund_settlement_detail(settlement: DataFrame) -> DataFrame:
    return group(
        settlement.where("payment_type = 'REFUND'").selectExpr(
            "*", "coalesce(txn_status, 'NULL') AS status"
        ),
        ["gateway", "payment_type", "status"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS txn_amount",
        f"{total('sett_net')} AS net_amount",
    )


def refund_trace_3way(
    settlement: DataFrame, gateway_refund: DataFrame, hub_refund: DataFrame
) -> DataFrame:
    """Refunded keys in settlements, and which of them the other two refund records know."""
    sett = settled_by_key(settlement.where("is_refund")).select(*KEY, "sett_rows", "gross")
    gws = group(
        gateway_refund.withColumnRenamed("refund_key", "gw_key"), KEY, "sum(amount) AS gw_amount"
    )
    hubs = group(
        hub_refund.selectExpr(
            "gateway",
            "CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS gw_key",
            "refund_amount",
        ),
        KEY,
        "sum(refund_amount) AS hub_amount",
    )
    return group(
        sett.join(gws, KEY, "left").join(hubs, KEY, "left"),
        "gateway",
        "count(*) AS sett_refund_ids",
        "count(gw_amount) AS in_gateway_refunds",
        "count(hub_amount) AS in_hub_refunds",
        f"{total('gross')} AS sett_refund_amount",
        f"{total('gw_amount')} AS gateway_refund_amount",
        f"{total('hub_amount')} AS hub_refund_amount",
    )


def refund_gap_by_status(
    hub: DataFrame, gateway_txn: DataFrame, settlement: DataFrame
) -> DataFrame:
    """Amount gap of mismatched rows by gateway status, and what was settled of them."""
    gws = group(
        gateway_txn.withColumnsRenamed({"amount": "gw_amount", "status": "gw_status"}),
        [*KEY, "gw_status", "gw_amount"],
        "count(*) AS n",
    )
    hubs = hub_scope(hub).selectExpr("gateway", "settle_key AS gw_key", "amount AS hub_amount")
    rows = (
        gws.join(hubs, KEY)
        .where("hub_amount <> gw_amount")
        .join(settled_by_key(settlement).select(*KEY, "gross"), KEY, "left")
    )
    return group(
        rows,
        ["gateway", "gw_status"],
        "sum(n) AS txns",
        f"{total('hub_amount * n')} AS hub_amount",
        f"{total('gw_amount * n')} AS gateway_amount",
        f"{total('(hub_amount - gw_amount) * n')} AS gap",
        "sum(CASE WHEN gross IS NOT NULL THEN n ELSE 0 END) AS in_settlements",
        f"{total('gross * n')} AS sett_gross",
    )


def embedded_refund_trace(
    settlement: DataFrame, hub: DataFrame, hub_refund: DataFrame, gateway: str = "GW_D"
) -> DataFrame:
    """Refund rows embedded in a gateway's transactions, found in hub and hub refunds."""
    only = f"gateway = '{gateway}'"
    rows = group(
        settlement.where(f"is_refund AND {only}"),
        ["settlement_order_id", "sett_txn_type"],
        "count(*) AS n",
        "sum(sett_gross) AS gross",
        "sum(sett_fee - sett_tax) AS fee",
        "sum(sett_tax) AS tax",
    ).withColumnRenamed("settlement_order_id", "order_id")
    orders = key_set(hub.where(only), "order_id").selectExpr("*", "true AS in_hub")
    refunds = key_set(hub_refund.where(only), "order_id").selectExpr("*", "true AS in_refunds")
    return group(
        rows.join(orders, "order_id", "left").join(refunds, "order_id", "left"),
        "sett_txn_type",
        "sum(n) AS n_rows",
        f"{total('gross')} AS gross",
        f"{total('fee')} AS fee",
        f"{total('tax')} AS tax",
        "sum(CASE WHEN in_hub THEN n ELSE 0 END) AS matched_hub",
        "sum(CASE WHEN in_refunds THEN n ELSE 0 END) AS matched_hub_refund",
    )


def fanout_ratio(settlement: DataFrame) -> DataFrame:
    """Settlement rows per key: how far a plain join would multiply hub amounts."""
    return group(
        settled_by_key(settlement),
        "gateway",
        "sum(sett_rows) AS sett_rows",
        "count(*) AS keys",
        "max(sett_rows) AS largest",
    ).selectExpr("*", "CAST(sett_rows AS DOUBLE) / keys AS ratio")
