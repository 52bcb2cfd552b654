"""The reverse trace: every settled payment back to its hub order and ledger row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.config import (
    AMOUNT_TOLERANCE,
    GATEWAY_CODES,
    LOOKUP_LEDGERS,
    MONEY,
    Period,
)
from tallychain.functions import status as st
from tallychain.functions.dates import in_period, month_label
from tallychain.functions.money import safe_pct, total
from tallychain.functions.text import order_prefix
from tallychain.operators.frames import group, pick_first, top_k, with_totals

#: How the stored base table is filed.
FILED_BY = ["recon_month", "gateway"]
#: What the base table is made of when rows are dealt out; those with few values last, as in ``traced_orders``.
_TO_FILE = [
    "sett_gross", "sett_net", "sett_fee", "hub_amount", "ledger_amount", "settled_date", "hub_created_date",
    "settlement_order_id", "hub_order_id", "hub_txn_id", "sett_utr", "source_month", *FILED_BY, "hub_gateway",
    "sett_txn_type", "hub_status", "ledger_table", "in_ledger", "in_main", "in_refunded", "in_topup",
]


# A refunded row counts once the refund is done, which is that ledger's scope; top-ups
# are looked up for their own id family only.
_REFUNDED = "ledger_table = 'ledger_refunded' AND in_scope"
_TOPUP = f"ledger_table = 'ledger_topup' AND {st.is_topup('order_id')}"


def ledger_lookup(ledger: DataFrame) -> DataFrame:
    """One row per order id: its ledger id, table and amount, and whether a main ledger has it.

    The six main ledgers come first, by rank, then a done refund, then top-ups. A plain
    hash aggregate on fixed-width buffers: a hot id collapses before the shuffle and
    nothing is sorted. A tie inside one ledger goes to the smallest amount.
    ``ledger_txn_id`` is null for orders that only an open refund knows.
    """
    ranks = [x.priority for x in LOOKUP_LEDGERS]
    best = group(
        ledger.where("order_id IS NOT NULL"),
        "order_id",
        "min(priority) AS best",
        f"max({_REFUNDED}) AS in_refunded",
        f"max({_TOPUP}) AS in_topup",
        f"min(CASE WHEN {_REFUNDED} THEN ledger_amount END) AS refunded_amount",
        f"min(CASE WHEN {_TOPUP} THEN ledger_amount END) AS topup_amount",
        *[f"min(CASE WHEN priority = {r} THEN ledger_amount END) AS amount_{r}" for r in ranks],
    )
    tables = " ".join(f"WHEN best = {x.priority} THEN '{x.table}'" for x in LOOKUP_LEDGERS)
    amounts = " ".join(f"WHEN best = {r} THEN amount_{r}" for r in ranks)
    return best.selectExpr(
        "order_id",
        "best IS NOT NULL AS in_main",
        "CASE WHEN best IS NOT NULL OR in_refunded OR in_topup THEN order_id END AS ledger_txn_id",
        f"CASE {tables} WHEN in_refunded THEN 'ledger_refunded' WHEN in_topup THEN 'ledger_topup' END "
        "AS ledger_table",
        f"CASE {amounts} WHEN in_refunded THEN refunded_amount WHEN in_topup THEN topup_amount END "
        "AS ledger_amount",
        "in_refunded",
        "in_topup",
    )


def one_hub_row(hub: DataFrame, *keys: str) -> DataFrame:
    """One row per gateway key: a successful one if there is one, then the earliest.

    Nothing stops the hub from delivering an order twice; left in, the second row
    would repeat every settlement row of the order. ``keys`` are more columns that
    rows must share to be one, for reports that look orders up by another id.
    """
    return pick_first(
        hub, ["gateway", "settle_key", *keys], "status <> 'SUCCESS'", "created_date", "order_id",
        "hub_txn_id", "amount",
    )


def hub_traced(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    """Hub rows, one per gateway key, with their ledger match."""
    return one_hub_row(hub).join(ledger_lookup(ledger), "order_id", "left")


def traced_orders(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    """What the base table shows of an order, one row per gateway key.

    A ledger knows an order by its own id: whether one does is told by flags, which
    are narrower than the id again. Columns with few values stand last: side by side, they
    all but vanish when rows are compressed for a shuffle.
    """
    return hub_traced(hub, ledger).selectExpr(
        "amount AS hub_amount",
        "ledger_amount",
        "created_date AS hub_created_date",
        "settle_key",
        "order_id AS hub_order_id",
        "hub_txn_id",
        "source_month",
        "gateway AS hub_gateway",
        "status AS hub_status",
        "ledger_table",
        "ledger_txn_id IS NOT NULL AS in_ledger",
        "in_main",
        "in_refunded",
        "in_topup",
    )


def bank_daily(bank: DataFrame) -> DataFrame:
    """One row per gateway and day."""
    return group(
        bank,
        ["gateway", "bank_date"],
        f"CAST(sum(deposit) AS {MONEY}) AS bank_daily_deposit",
        "count(*) AS deposits",
    )


def with_deposits(rows: DataFrame, bank: DataFrame, period: Period | None = None) -> DataFrame:
    """Add ``bank_date`` and ``bank_daily_deposit`` of the row's gateway and settled date.

    The deposits are reduced to a row per gateway and day, so few that they are
    broadcast whatever the tables' size: left to itself, Spark may shuffle the rows,
    by far the widest, before it knows how small the other side is.
    """
    days = bank_daily(bank.where("gateway IS NOT NULL"))
    if period is not None:
        days = days.where(in_period("bank_date", period))
    days = days.selectExpr("gateway AS bank_gateway", "bank_date", "bank_daily_deposit")
    return rows.join(
        F.broadcast(days),
        F.expr("gateway = bank_gateway AND settled_date = bank_date"),
        "left",
    ).drop("bank_gateway")


def recon_base(
    settlement: DataFrame,
    hub: DataFrame,
    ledger: DataFrame,
    bank: DataFrame,
    period: Period | None = None,
    filed: bool = False,
) -> DataFrame:
    """One classified row per forward settlement row.

    The hub is traced to the ledgers first, so the settlement rows, by far the
    most, are shuffled once. Both inputs of that join are bare exchanges, which
    lets AQE split a settlement id that holds a large share of the rows.

    Ledger columns come from the six main ledgers, else from a done refund, else
    from the top-ups; ``l1_match`` tells matches in a main ledger only. Hub and
    ledger amounts stand on every settlement row of their order: reports on this
    table count them once per settlement id.

    ``filed`` deals the rows out as the stored table is filed, for ``recon_base_write``:
    before the deposits and the columns that follow from others widen them.
    """
    rows = settlement.where("is_forward")
    if period is not None:
        rows = rows.where(in_period("settled_date", period))
    joined = rows.join(
        traced_orders(hub, ledger),
        F.expr("gateway = hub_gateway AND settlement_order_id = settle_key"),
        "left",
    )
    if filed:
        joined = dealt(joined.withColumn("recon_month", F.expr(month_label("settled_date"))).select(_TO_FILE))
    return classified(with_deposits(joined, bank, period))


def dealt(rows: DataFrame) -> DataFrame:
    """Rows dealt out by month and gateway.

    ``rebalance`` sizes the files: a gateway with most of a month's rows is split over
    several writers, small ones are merged.
    """
    return rows.hint("rebalance", *[F.col(c) for c in FILED_BY])


def classified(joined: DataFrame) -> DataFrame:
    """The base table's columns, of settlement rows with their traced order and deposit."""
    hub_id, sett_id = "hub_order_id", "settlement_order_id"
    ledger_id = f"CASE WHEN in_main AND in_ledger THEN {hub_id} END"
    status = st.trace_status(
        "gateway",
        sett_id,
        hub_id,
        ledger_id,
        "coalesce(in_refunded, false)",
        "coalesce(in_topup, false)",
    )
    return joined.selectExpr(
        "gateway",
        "settlement_order_id",
        "bank_date",
        "bank_daily_deposit",
        "settled_date",
        f"{month_label('settled_date')} AS recon_month",
        "sett_gross",
        "sett_net",
        "sett_fee",
        "sett_utr",
        "sett_txn_type",
        "hub_order_id",
        "hub_txn_id",
        "hub_amount",
        "hub_status",
        "hub_gateway",
        "hub_created_date",
        f"{st.l2_match(hub_id)} AS l2_match",
        f"CASE WHEN in_ledger THEN {hub_id} END AS ledger_txn_id",
        "ledger_table",
        "ledger_amount",
        f"{st.l1_match(hub_id, ledger_id)} AS l1_match",
        f"{order_prefix(hub_id, sett_id)} AS order_id_prefix",
        f"{status} AS trace_status",
        f"{st.trace_status_basic(hub_id, ledger_id)} AS trace_status_basic",
        f"CAST(hub_amount - sett_gross AS {MONEY}) AS diff_hub_vs_sett",
        f"CAST(ledger_amount - hub_amount AS {MONEY}) AS diff_ledger_vs_hub",
        "source_month",
    )


@dataclass(frozen=True)
class Run:
    """One monthly run: reports that compare with deposits take both from here."""

    base: DataFrame
    bank: DataFrame
    period: Period


def run(
    settlement: DataFrame, hub: DataFrame, ledger: DataFrame, bank: DataFrame, period: Period
) -> Run:
    """The base table of a period and the deposits of the same period."""
    return Run(
        recon_base(settlement, hub, ledger, bank, period),
        bank.where(in_period("bank_date", period)),
        period,
    )


def per_id(base: DataFrame, *keys: str) -> DataFrame:
    """Base rows reduced to one per settlement id: hub and ledger amounts then count once.

    ``keys`` are columns that are the same on all rows of an id. An id with very
    many rows collapses before the shuffle.
    """
    return group(
        base,
        list(dict.fromkeys([*keys, "gateway", "settlement_order_id"])),
        "count(*) AS n_rows",
        "sum(sett_gross) AS sett_gross",
        "sum(sett_net) AS sett_net",
        "sum(sett_fee) AS sett_fee",
        "min(hub_amount) AS hub_amount",
        "min(ledger_amount) AS ledger_amount",
    )


# --- reports on the base table ---------------------------------------------------


def recon_row_counts(base: DataFrame) -> DataFrame:
    return with_totals(group(base, "gateway", "count(*) AS n_rows"), ["gateway"], "n_rows")


def recon_summary(base: DataFrame) -> DataFrame:
    """Rows and amounts by gateway and trace status, with subtotals and a grand total."""
    rows = group(
        per_id(base, "trace_status"),
        ["gateway", "trace_status"],
        "sum(n_rows) AS n_rows",
        f"{total('sett_gross')} AS sett_gross",
        f"{total('sett_net')} AS sett_net",
        f"{total('hub_amount')} AS hub_amount",
        f"{total('ledger_amount')} AS ledger_amount",
    )
    return with_totals(
        rows,
        ["gateway", "trace_status"],
        "n_rows",
        "sett_gross",
        "sett_net",
        "hub_amount",
        "ledger_amount",
    )


def waterfall_by_gateway(base: DataFrame, bank: DataFrame) -> DataFrame:
    """Bank, gross, net, hub and ledger totals and the steps between them, one row per gateway.

    ``base`` and ``bank`` must be of one period; a ``Run`` holds such a pair.
    """
    sums = group(
        per_id(base, "l1_match", "l2_match"),
        "gateway",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
        total("hub_amount", "l2_match = 'MATCHED'") + " AS hub",
        total("ledger_amount", "l1_match = 'MATCHED'") + " AS ledger",
    )
    layers = ("bank", "gross", "net", "hub", "ledger")
    # Deposits count whether or not the gateway has settlements, and without a gateway too.
    deposits = group(
        bank, "gateway", f"{total('deposit')} AS bank"
    ).withColumnRenamed("gateway", "bank_gateway")
    return (
        sums.join(deposits, F.expr("gateway <=> bank_gateway"), "full")
        .selectExpr(
            "coalesce(gateway, bank_gateway) AS gateway", *[f"coalesce({x}, 0) AS {x}" for x in layers]
        )
        .selectExpr(
            "*",
            "bank - gross AS bank_minus_gross",
            "gross - hub AS gross_minus_hub",
            "hub - ledger AS hub_minus_ledger",
        )
    )


def recon_waterfall(base: DataFrame, bank: DataFrame) -> DataFrame:
    """The waterfall with one row per layer and one column per gateway.

    ``unassigned`` holds what no known gateway has: deposits without a label, say. It is
    part of ``all_gateways``, which covers every deposit.
    """
    by_gateway = waterfall_by_gateway(base, bank)
    layers = by_gateway.columns[1:]
    long = by_gateway.unpivot("gateway", layers, "layer", "amount")
    other = f"gateway IS NULL OR gateway NOT IN ({', '.join(repr(g) for g in GATEWAY_CODES)})"
    return group(
        long,
        "layer",
        *[f"{total('amount', f'gateway = {g!r}')} AS {g.lower()}" for g in GATEWAY_CODES],
        f"{total('amount', other)} AS unassigned",
        f"{total('amount')} AS all_gateways",
    )


def gap_a_bank(base: DataFrame, bank: DataFrame) -> DataFrame:
    """Deposits against net over the days that have settlements; gap in percent of net."""
    days = group(
        base,
        ["gateway", "settled_date"],
        "count(*) AS n",
        "sum(sett_gross) AS gross",
        "sum(sett_net) AS net",
    )
    deposits = bank_daily(bank).withColumnRenamed("bank_date", "settled_date")
    sums = group(
        days.join(deposits, ["gateway", "settled_date"], "left"),
        "gateway",
        "count(*) AS sett_days",
        "sum(n) AS sett_rows",
        f"{total('gross')} AS sett_gross",
        f"{total('net')} AS sett_net",
        f"{total('bank_daily_deposit')} AS bank_deposit",
    )
    totals = with_totals(
        sums, ["gateway"], "sett_days", "sett_rows", "sett_gross", "sett_net", "bank_deposit"
    )
    return totals.selectExpr(
        "*",
        "bank_deposit - sett_net AS gap",
        safe_pct("bank_deposit - sett_net", "sett_net") + " AS gap_pct",
    )


def gap_b_settlement_only(base: DataFrame, k: int | None = None) -> DataFrame:
    """Settlement rows without a hub row by id family; the ``k`` largest if given."""
    rows = group(
        base.where("l2_match = 'SETT_ONLY'"),
        ["gateway", "order_id_prefix"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS gross",
        f"{total('sett_net')} AS net",
    )
    return rows if k is None else top_k(rows, k, "gross DESC", "gateway", "order_id_prefix")


def gap_c_hub_only(base: DataFrame, k: int | None = None) -> DataFrame:
    """Hub rows without a main ledger row by id family; the ``k`` largest if given."""
    rows = group(
        per_id(base.where("l1_match = 'HUB_ONLY'"), "order_id_prefix"),
        ["gateway", "order_id_prefix"],
        "sum(n_rows) AS n_rows",
        f"{total('hub_amount')} AS hub_amount",
        f"{total('sett_gross')} AS sett_gross",
    )
    return rows if k is None else top_k(rows, k, "hub_amount DESC", "gateway", "order_id_prefix")


def gap_c_resolved(base: DataFrame) -> DataFrame:
    """Hub-only rows split into refunded, topup and truly missing."""
    return group(
        per_id(base.where("l1_match = 'HUB_ONLY'"), "trace_status"),
        ["gateway", "trace_status"],
        "sum(n_rows) AS n_rows",
        f"{total('hub_amount')} AS hub_amount",
    )


def gap_d_amount(base: DataFrame, tolerance: str = AMOUNT_TOLERANCE) -> DataFrame:
    """Hub against ledger amount on matched rows; below ``tolerance`` counts as equal.

    Rows are settlement rows; amounts count once per settlement id.
    """
    diff = "abs(hub_amount - ledger_amount)"
    sums = group(
        per_id(
            base.where("l1_match = 'MATCHED' AND hub_amount IS NOT NULL AND ledger_amount IS NOT NULL")
        ),
        "gateway",
        "sum(n_rows) AS matched_rows",
        f"sum(CASE WHEN {diff} < {tolerance} THEN n_rows ELSE 0 END) AS exact_rows",
        f"sum(CASE WHEN {diff} >= {tolerance} THEN n_rows ELSE 0 END) AS diff_rows",
        f"{total('hub_amount')} AS hub_total",
        f"{total('ledger_amount')} AS ledger_total",
        f"{total('hub_amount - ledger_amount')} AS diff_total",
    )
    return with_totals(
        sums, ["gateway"], "matched_rows", "exact_rows", "diff_rows",
        "hub_total", "ledger_total", "diff_total",
    )


def recon_source_month(base: DataFrame, period: Period) -> DataFrame:
    """When the settled orders were created, relative to ``period``."""
    rows = group(
        per_id(
            base.selectExpr(
                "*", f"{st.source_month_bucket('hub_created_date', period)} AS created_in"
            ),
            "created_in",
        ),
        ["gateway", "created_in"],
        "sum(n_rows) AS n_rows",
        f"{total('sett_gross')} AS sett_gross",
        f"{total('hub_amount')} AS hub_amount",
    )
    return with_totals(rows, ["gateway", "created_in"], "n_rows", "sett_gross", "hub_amount")


def recon_scorecard(base: DataFrame) -> DataFrame:
    """All headline counters in one row."""

    def n(where: str, name: str) -> str:
        return f"count_if({where}) AS {name}"

    def gross(where: str, name: str) -> str:
        return f"{total('sett_gross', where)} AS {name}"

    statuses = {
        "traced": "FULLY_TRACED",
        "no_hub": "MISSING_HUB",
        "no_ledger": "MISSING_LEDGER",
        "partner": "PARTNER_WALLET",
    }
    return group(
        base,
        [],
        "count(*) AS total_rows",
        f"{total('sett_gross')} AS total_gross",
        f"{total('sett_net')} AS total_net",
        n("l2_match = 'MATCHED'", "l2_matched"),
        n("l2_match = 'SETT_ONLY'", "l2_sett_only"),
        gross("l2_match = 'MATCHED'", "l2_matched_gross"),
        gross("l2_match = 'SETT_ONLY'", "l2_sett_only_gross"),
        n("l1_match = 'MATCHED'", "l1_matched"),
        n("l1_match = 'HUB_ONLY'", "l1_hub_only"),
        n("l1_match = 'PARTNER_WALLET'", "l1_partner_wallet"),
        n("l1_match = 'NO_HUB'", "l1_no_hub"),
        *[n(f"trace_status_basic = '{s}'", f"rows_{k}") for k, s in statuses.items()],
        *[gross(f"trace_status_basic = '{s}'", f"gross_{k}") for k, s in statuses.items()],
    )


def recon_month_compare(base: DataFrame, first: Period, second: Period) -> DataFrame:
    """Two settlement months side by side, by trace status."""

    def cols(period: Period, name: str) -> list[str]:
        cond = in_period("settled_date", period)
        return [
            f"count_if({cond}) AS rows_{name}",
            f"{total('sett_gross', cond)} AS gross_{name}",
        ]

    either = f"{in_period('settled_date', first)} OR {in_period('settled_date', second)}"
    return group(base.where(either), "trace_status", *cols(first, "first"), *cols(second, "second"))


def gap_drilldown(base: DataFrame, status: str = "MISSING_LEDGER") -> DataFrame:
    return group(
        base.where(f"trace_status = '{status}'"),
        ["order_id_prefix", "gateway"],
        "count(*) AS n_rows",
        f"{total('sett_gross')} AS amount",
    )


def traced_waterfall(base: DataFrame) -> DataFrame:
    return group(
        per_id(base.where("trace_status = 'FULLY_TRACED'")),
        "gateway",
        f"{total('sett_gross')} AS sett_gross",
        f"{total('sett_net')} AS sett_net",
        f"{total('sett_fee')} AS fees",
        f"{total('hub_amount')} AS hub_total",
        f"{total('ledger_amount')} AS ledger_total",
    )


def gap_export_settlement(base: DataFrame) -> DataFrame:
    """Settlement rows without a hub row, in export layout."""
    return base.where("l2_match = 'SETT_ONLY'").select(
        "gateway", "settlement_order_id", "settled_date", "sett_gross", "sett_net", "sett_fee",
        "sett_utr", "sett_txn_type", "order_id_prefix", "trace_status",
    )


def gap_export_hub(base: DataFrame) -> DataFrame:
    """Hub rows without a ledger row, in export layout."""
    return base.where("l1_match = 'HUB_ONLY'").select(
        "gateway", "settlement_order_id", "settled_date", "sett_gross", "sett_net",
        "hub_order_id", "hub_txn_id", "hub_amount", "hub_status", "hub_created_date",
        "l2_match", "l1_match", "order_id_prefix", "trace_status",
    )
