"""Late rows: which part of the base table they touch, and what it becomes.

A late hub row touches its settlement id; a late ledger row the ids of its order; a late
settlement row its own id; a late deposit its gateway and day. Only rows of touched ids are
traced again, and only months that hold such rows or days are written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.functions.dates import month_label
from tallychain.operators.base import FILED_BY, dealt, recon_base, with_deposits
from tallychain.operators.frames import key_set, union_all
from tallychain.operators.key_filter import probed, semi_join

ID = ["gateway", "settlement_order_id"]


@dataclass(frozen=True)
class Late:
    """Rows that arrived since the base was built; they are in the relations by now.

    Deliveries only add rows. A correction is a delivery of the corrected row, which the
    relations reduce to one row per order as they do with any repeat.
    """

    settlement: DataFrame | None = None
    hub: DataFrame | None = None
    ledger: DataFrame | None = None
    bank: DataFrame | None = None


def touched_ids(late: Late, hub: DataFrame) -> DataFrame | None:
    """Distinct (gateway, settlement_order_id) whose trace may have changed; None if none can."""
    as_id = {"settle_key": "settlement_order_id"}
    found = []
    if late.settlement is not None:
        found.append(late.settlement.select(ID))
    if late.hub is not None:
        found.append(late.hub.withColumnsRenamed(as_id).select(ID))
    if late.ledger is not None:
        orders = key_set(late.ledger, "order_id")
        found.append(hub.join(orders, "order_id", "left_semi").withColumnsRenamed(as_id).select(ID))
    return key_set(union_all(found), *ID) if found else None


def touched_months(
    late: Late, base: DataFrame, ids: DataFrame | None, id_filter: DataFrame | None
) -> list[tuple[str | None, str | None]]:
    """The (recon_month, gateway) to be written again: at most months times gateways, so a list.

    Of the base only ids are read. Settlement days that had no row yet are in the late
    rows themselves. ``id_filter`` is the filter (``key_filter``) of ``ids``.
    """
    found = []
    if ids is not None:
        found.append(semi_join(base.select(*ID, "recon_month"), ids, ID, id_filter).select(FILED_BY))
    for rows, day in ((late.settlement, "settled_date"), (late.bank, "bank_date")):
        if rows is not None:
            found.append(rows.selectExpr(f"{month_label(day)} AS recon_month", "gateway"))
    if not found:
        return []
    months = [(r.recon_month, r.gateway) for r in union_all(found).distinct().collect()]
    return sorted(months, key=lambda p: [x or "" for x in p])


def filed_in(months: list[tuple[str | None, str | None]], month: str = "recon_month") -> Column:
    """Rows filed under any of ``months``, as literals, so that the scan opens no other."""
    held = F.lit(False)
    for gateway in dict.fromkeys(g for _, g in months):
        own = [m for m, g in months if g == gateway]
        inside = F.col(month).isin([m for m in own if m is not None])
        if None in own:
            inside = F.col(month).isNull() | inside
        held = held | (F.col("gateway").eqNullSafe(F.lit(gateway)) & inside)
    return held


def refreshed(
    base: DataFrame,
    settlement: DataFrame,
    hub: DataFrame,
    ledger: DataFrame,
    bank: DataFrame,
    ids: DataFrame | None,
    id_filter: DataFrame | None,
    months: list[tuple[str | None, str | None]],
    crowded: list[tuple[str | None, str | None]] | None = None,
) -> DataFrame:
    """All base rows of ``months`` as a rebuild would give them, filed by month and gateway.

    Rows of untouched ids are taken over and only get their deposits anew. They stay where
    they lie: a task reads a few files and writes a few. What ``id_filter`` can't tell from
    touched ids, what is traced again and the rows of ``crowded`` months are dealt out by
    month and gateway. ``settlement`` needs to hold the rows of ``months`` only. The joins
    on touched ids are small sides where late rows are few; nothing else is joined.
    """
    old = base.where(filed_in(months)).drop("bank_date", "bank_daily_deposit")

    def complete(rows: DataFrame) -> DataFrame:
        return with_deposits(rows, bank).select(base.columns)

    moved = []
    if ids is None:
        kept = old
    else:
        # Rows without an id meet nothing; they are taken from the settlements, late ones too.
        loose = "settlement_order_id IS NULL OR gateway IS NULL"
        asked = probed(old.where(f"NOT ({loose})"), ID, id_filter)
        kept = asked.where("NOT _maybe").drop("_maybe")
        moved.append(complete(asked.where("_maybe").drop("_maybe").join(ids, ID, "left_anti")))
        wanted = ids.withColumnRenamed("settlement_order_id", "settle_key")
        hubs = semi_join(hub, wanted, ["gateway", "settle_key"], id_filter)
        ledgers = ledger.join(key_set(hubs, "order_id"), "order_id", "left_semi")
        rows = (
            settlement.withColumn("_filed", F.expr(month_label("settled_date")))
            .where(filed_in(months, "_filed"))
            .drop("_filed")
        )
        own = semi_join(rows, ids, ID, id_filter).unionByName(rows.where(loose))
        moved.append(recon_base(own, hubs, ledgers, bank).select(base.columns))
    if crowded:
        moved.append(complete(kept.where(filed_in(crowded))))
        kept = kept.where(~filed_in(crowded))
    return union_all([complete(kept), dealt(union_all(moved))]) if moved else complete(kept)
