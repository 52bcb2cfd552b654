"""Following single ids, id sets and refunds through all layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.functions.text import order_pattern
from tallychain.functions.money import total
from tallychain.operators.base import ledger_lookup, one_hub_row, with_deposits
from tallychain.operators.frames import group, key_set, pick_first, union_all


def trace_one(base: DataFrame, any_id: str) -> DataFrame:
    """All base rows of one id, given as settlement, hub order or hub transaction id.

    A branch for each id: every scan gets one equality, which min/max values, the
    dictionary and the bloom filter of a row group can answer.
    """
    wanted = F.lit(any_id)
    ids = [F.col(c) for c in ("settlement_order_id", "hub_order_id", "hub_txn_id")]
    branches = []
    for i, own in enumerate(ids):
        rows = base.where(own == wanted)
        for before in ids[:i]:
            rows = rows.where(~before.eqNullSafe(wanted))
        branches.append(rows)
    return union_all(branches)


def trace_end_to_end(
    ids: DataFrame,
    ledger: DataFrame,
    hub: DataFrame,
    gateway_txn: DataFrame,
    settlement: DataFrame,
    bank: DataFrame,
) -> DataFrame:
    """Ledger, hub, gateway, settlement and bank facts for every order id in ``ids``.

    Each layer is cut down to the wanted ids before it is grouped, and reduced to one
    row per key before it is joined: an id settled in many parts gives one row per
    settlement day, and a hub order delivered twice is one row.
    """
    key = ["gateway", "gw_key"]
    wanted = key_set(ids, "order_id")
    hubs = one_hub_row(hub.join(wanted, "order_id", "left_semi"), "order_id").selectExpr(
        "order_id", "gateway", "settle_key AS gw_key", "hub_txn_id", "amount AS hub_amount",
        "status AS hub_status",
    )
    keys = key_set(hub.join(wanted, "order_id", "left_semi").withColumnRenamed("settle_key", "gw_key"), *key)
    of_wanted = ledger.join(wanted, "order_id", "left_semi")
    facts = (
        wanted.join(
            ledger_lookup(of_wanted).select("order_id", "ledger_table", "ledger_amount"),
            "order_id",
            "left",
        ).join(hubs, "order_id", "left")
    )
    gw = group(
        gateway_txn.join(keys, key, "left_semi"), key, "sum(amount) AS gw_amount", "count(*) AS gw_rows"
    )
    sett = group(
        settlement.where("is_forward")
        .withColumnRenamed("settlement_order_id", "gw_key")
        .join(keys, key, "left_semi"),
        [*key, "settled_date"],
        "count(*) AS sett_rows",
        "sum(sett_gross) AS sett_gross",
        "sum(sett_net) AS sett_net",
        "sum(sett_fee) AS sett_fee",
    )
    return with_deposits(facts.join(gw, key, "left").join(sett, key, "left"), bank).select(
        "order_id", "ledger_table", "ledger_amount", "gateway", "hub_txn_id", "hub_amount",
        "hub_status", "gw_amount", "settled_date", "sett_rows", "sett_gross", "sett_net",
        "sett_fee", "bank_daily_deposit",
    )


def latest_refund(hub_refund: DataFrame, status: str = "SUCCESS") -> DataFrame:
    """The last successful refund per order, ties to the largest refund id.

    A sort aggregate over a struct: a hot order collapses before the shuffle.
    """
    newest = """max(struct(refund_date, refund_unique_id, refund_amount, refund_type,
                           refund_status)) AS r"""
    return group(hub_refund.where(f"refund_status = '{status}'"), "order_id", newest).selectExpr(
        "order_id",
        "r.refund_status",
        "r.refund_amount",
        "r.refund_date",
        "r.refund_type",
        "r.refund_unique_id",
    )


def one_per_order(ledger: DataFrame, table: str) -> DataFrame:
    """The last row that a ledger has of each order, as it stands there; ties to the smaller amount."""
    columns = (
        "ledger_date", "ledger_amount", "mode", "mobile", "plan", "ledger_status", "payment_status",
        "refund_status",
    )
    rows = ledger.where(f"ledger_table = '{table}' AND order_id IS NOT NULL").select("order_id", *columns)
    return pick_first(rows, ["order_id"], "ledger_date DESC", *columns[1:])


def amount_mismatch(hub: DataFrame, gateway_txn: DataFrame, *extra: str) -> DataFrame:
    """Successful hub rows whose gateway amount differs, with ``extra`` hub columns."""
    gw = gateway_txn.withColumnsRenamed(
        {"gw_key": "settle_key", "amount": "gw_amount", "status": "gw_status"}
    )
    return (
        hub.where("status = 'SUCCESS'")
        .join(gw, ["gateway", "settle_key"])
        .where("amount <> gw_amount")
        .selectExpr(
            "order_id", "hub_txn_id", "gateway", "settle_key AS gw_key",
            f"{order_pattern('order_id')} AS order_pattern", "amount AS hub_amount",
            "created_date", "customer_id", "payment_flow", "gw_amount",
            "CAST(amount - gw_amount AS DECIMAL(18,2)) AS amount_diff", "gw_status", "txn_date",
            "mode AS gw_mode", "bank_name", "error_description", "discount", "subvention", *extra,
        )
    )


def refund_trace(
    hub: DataFrame, gateway_txn: DataFrame, hub_refund: DataFrame, ledger: DataFrame
) -> DataFrame:
    """Mismatched rows with their refund: refunded ledger first, else revenue ledger.

    Everything known per order is attached to the hub, where ids are unique,
    before the gateway rows come in. A gateway id with very many rows then takes
    part in one join only, between two bare exchanges that AQE can split.
    """
    refunded = one_per_order(ledger, "ledger_refunded").selectExpr(
        "order_id", "true AS has_rf", "ledger_date AS rf_date", "ledger_amount AS rf_amount",
        "mode AS rf_mode", "mobile AS rf_mobile", "plan AS rf_plan",
        "payment_status AS ledger_payment_status", "refund_status AS ledger_refund_status",
        "ledger_status AS ledger_txn_status",
    )
    revenue = one_per_order(ledger, "ledger_revenue").selectExpr(
        "order_id", "true AS has_pr", "ledger_date AS pr_date", "ledger_amount AS pr_amount",
        "mode AS pr_mode", "mobile AS pr_mobile", "plan AS pr_plan",
    )
    facts = [refunded, revenue, latest_refund(hub_refund)]
    orders = one_hub_row(hub.where("status = 'SUCCESS'"), "order_id")
    for frame in facts:
        orders = orders.join(frame, "order_id", "left")
    extra = [c for frame in facts for c in frame.columns if c != "order_id"]
    return amount_mismatch(orders, gateway_txn, *extra).selectExpr(
        "order_id", "order_pattern", "gateway", "hub_txn_id", "hub_amount", "created_date",
        "customer_id", "payment_flow", "gw_amount", "amount_diff", "gw_status", "txn_date",
        "gw_mode", "bank_name",
        """CASE WHEN has_rf THEN 'ledger_refunded' WHEN has_pr THEN 'ledger_revenue'
           END AS ledger_table""",
        "coalesce(rf_date, pr_date) AS ledger_date",
        "coalesce(rf_amount, pr_amount) AS ledger_amount",
        "coalesce(rf_mode, pr_mode) AS ledger_mode",
        "coalesce(rf_mobile, pr_mobile) AS ledger_mobile",
        "ledger_payment_status", "ledger_refund_status", "ledger_txn_status",
        "coalesce(rf_plan, pr_plan) AS ledger_payment_type",
        """CASE WHEN has_rf AND has_pr THEN 'BOTH' WHEN has_rf THEN 'REFUNDED_LEDGER'
                WHEN has_pr THEN 'REVENUE_ONLY' ELSE 'NOT_FOUND' END AS ledger_presence""",
        "refund_status", "refund_amount", "refund_date", "refund_type", "refund_unique_id",
    )


def refund_trace_profile(trace: DataFrame) -> DataFrame:
    """Counts and totals per dimension value, null statuses shown as NONE."""
    dimensions = {
        "gw_status": "gw_status",
        "ledger_presence": "ledger_presence",
        "refund_status": "coalesce(refund_status, 'NONE')",
        "order_pattern": "order_pattern",
        "ledger_refund_status": "coalesce(ledger_refund_status, 'NONE')",
        "ledger_payment_status": "coalesce(ledger_payment_status, 'NONE')",
        "ledger_txn_status": "coalesce(ledger_txn_status, 'NONE')",
    }
    return profile(trace, dimensions, "hub_amount", "gw_amount", "refund_amount")


def profile(df: DataFrame, dimensions: dict[str, str], *measures: str) -> DataFrame:
    """Row counts and totals (``"x"`` or ``"x AS name"``) by each of several dimensions.

    Rows are first summed up by all dimensions together, so that only their few
    combinations are expanded into one row per dimension; the input, often a chain of
    joins, is computed once and never repeated.
    """
    named = [m.rsplit(" AS ", 1) if " AS " in m else (m, m) for m in measures]
    keys = {f"_by_{i}": e for i, e in enumerate(dimensions.values())}
    combined = group(
        df.selectExpr(
            *[f"CAST({e} AS STRING) AS {k}" for k, e in keys.items()], *[f"{x} AS {n}" for x, n in named]
        ),
        list(keys),
        "count(*) AS n_rows",
        *[f"sum({n}) AS {n}" for _, n in named],
    )
    pairs = ", ".join(f"'{n}', {k}" for n, k in zip(dimensions, keys))
    long = combined.selectExpr("*", f"stack({len(dimensions)}, {pairs}) AS (dimension, value)")
    return group(
        long,
        ["dimension", "value"],
        "sum(n_rows) AS n_rows",
        *[f"{total(n)} AS {n}" for _, n in named],
    )
