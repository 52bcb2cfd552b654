"""Layer 1: the internal ledgers against the hub.

A ledger id may repeat any number of times, a hub order id does not. Counting
operators therefore reduce the ledger to one row per id (and the values they
compare) before they join, and carry the row count along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallychain.config import LEDGER_TABLES, Period
from tallychain.functions.dates import in_period, month_label
from tallychain.functions.money import safe_pct, total
from tallychain.functions.text import expected_ledger, is_partner_wallet, order_pattern
from tallychain.operators.frames import (
    group,
    key_set,
    keys_of,
    share_of_total,
    top_k,
    union_all,
    with_totals,
)
from tallychain.operators.trace import profile


def in_hub_period(hub: DataFrame, period: Period | None) -> DataFrame:
    return hub if period is None else hub.where(in_period("created_date", period))


# --- the two universes ---------------------------------------------------------------


def hub_universe(hub: DataFrame, period: Period | None = None) -> DataFrame:
    return group(
        in_hub_period(hub, period),
        "source_month",
        "count(*) AS n_rows",
        f"{total('amount')} AS amount",
        "count_if(status = 'SUCCESS') AS success_rows",
        total("amount", "status = 'SUCCESS'") + " AS success_amount",
    )


def hub_by_gateway(hub: DataFrame) -> DataFrame:
    rows = group(
        hub,
        "gateway",
        "count(*) AS n_rows",
        "count_if(status = 'SUCCESS') AS success_rows",
        total("amount", "status = 'SUCCESS'") + " AS success_amount",
    ).selectExpr(
        "*",
        "coalesce(try_divide(CAST(success_amount AS DOUBLE), success_rows), 0D) AS avg_amount",
    )
    return share_of_total(rows, "success_rows")


def hub_by_pattern(hub: DataFrame) -> DataFrame:
    """Successful rows by id family, with the ledger each family should be in."""
    rows = group(
        hub.where("status = 'SUCCESS'").selectExpr(
            f"{order_pattern('order_id')} AS order_pattern", "amount"
        ),
        "order_pattern",
        "count(*) AS n_rows",
        f"{total('amount')} AS amount",
    )
    return share_of_total(
        rows.selectExpr("*", f"{expected_ledger('order_pattern')} AS expected_ledger"), "n_rows"
    )


def hub_status_distribution(hub: DataFrame) -> DataFrame:
    return group(
        hub, ["status", "order_status"], "count(*) AS n_rows", f"{total('amount')} AS amount"
    )


def ledger_universe(ledger: DataFrame) -> DataFrame:
    """Rows and amount per ledger table, all and in scope."""
    return group(
        ledger,
        "ledger_table",
        "count(*) AS n_rows",
        f"{total('ledger_amount')} AS amount",
        "count_if(in_scope) AS scope_rows",
        total("ledger_amount", "in_scope") + " AS scope_amount",
    )


# --- matching ------------------------------------------------------------------------


def linked(ledger: DataFrame, hub: DataFrame, dims: list[str], how: str = "left") -> DataFrame:
    """Ledger ids with their hub row; ``n`` is the number of equal ledger rows."""
    keys = ["ledger_table", "order_id", *dims]
    left = group(ledger.where("order_id IS NOT NULL"), keys, "count(*) AS n")
    right = hub.selectExpr(
        "order_id",
        "true AS in_hub",
        "amount AS hub_amount",
        "status AS hub_status",
        "order_status",
        "gateway",
        "created_date",
        "source_month",
    )
    return left.join(right, "order_id", how)


def _with_month(ledger: DataFrame) -> DataFrame:
    return ledger.selectExpr("*", f"{month_label('ledger_date')} AS ledger_month")


def l1_match_counts(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """Matched, unmatched, and matched to a hub row created in another month."""
    pairs = linked(_with_month(ledger), hub, ["ledger_month"])
    return group(
        pairs,
        "ledger_table",
        "sum(n) AS ledger_rows",
        "sum(CASE WHEN in_hub THEN n ELSE 0 END) AS matched",
        "sum(CASE WHEN in_hub IS NULL THEN n ELSE 0 END) AS unmatched",
        "sum(CASE WHEN source_month <> ledger_month THEN n ELSE 0 END) AS matched_other_month",
    )


def l1_scorecard(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """Match rate per ledger and overall."""
    counts = l1_match_counts(ledger, hub).select("ledger_table", "ledger_rows", "matched", "unmatched")
    rate = safe_pct("matched", "ledger_rows")
    return with_totals(counts, ["ledger_table"], "ledger_rows", "matched", "unmatched").selectExpr(
        "*", f"{rate} AS match_pct"
    )


def l1_matched_by_gateway(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    pairs = linked(ledger, hub.where("status = 'SUCCESS'"), [], "inner")
    return group(
        pairs,
        ["ledger_table", "gateway"],
        "count(*) AS matched_ids",
        "sum(n) AS ledger_rows",
        f"{total('hub_amount')} AS hub_amount",
    )


def l1_unmatched_rows(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """In-scope ledger rows without any hub row."""
    return (
        ledger.where("in_scope")
        .join(keys_of(hub, "order_id"), "order_id", "left_anti")
        .select("ledger_table", "order_id", "ledger_amount", "ledger_date", "ledger_status")
    )


def l1_unmatched_breakdown(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    rows = group(
        ledger, ["ledger_table", "order_id", "ledger_status"], "count(*) AS n",
        "sum(ledger_amount) AS amount",
    )
    return group(
        rows.join(keys_of(hub, "order_id"), "order_id", "left_anti").selectExpr(
            "*", f"{order_pattern('order_id')} AS order_pattern"
        ),
        ["ledger_table", "ledger_status", "order_pattern"],
        "sum(n) AS n_rows",
        f"{total('amount')} AS amount",
    )


def l1_zero_amount_dist(ledger: DataFrame, hub: DataFrame, table: str) -> DataFrame:
    """Unmatched rows of one ledger by the amount paid."""
    rows = group(
        ledger.where(f"ledger_table = '{table}'"), ["order_id", "ledger_amount"], "count(*) AS n"
    )
    return group(
        rows.join(keys_of(hub, "order_id"), "order_id", "left_anti"),
        "ledger_amount",
        "sum(n) AS n_rows",
    )


def l1_status_crosstab(ledger: DataFrame, hub: DataFrame, table: str) -> DataFrame:
    pairs = linked(ledger.where(f"ledger_table = '{table}'"), hub, ["ledger_status"], "inner")
    return group(
        pairs, ["ledger_status", "hub_status", "order_status"], "sum(n) AS n_rows",
        f"{total('hub_amount * n')} AS hub_amount",
    )


def l1_status_mismatch(
    ledger: DataFrame, hub: DataFrame, table: str, success: str = "TXN_SUCCESS"
) -> DataFrame:
    """One side successful and the other not, and null-status rows charged at the hub."""
    pairs = linked(ledger.where(f"ledger_table = '{table}'"), hub, ["ledger_status"], "inner")
    kind = (
        f"CASE WHEN ledger_status = '{success}' AND hub_status <> 'SUCCESS' THEN 'LEDGER_ONLY_SUCCESS' "
        f"WHEN ledger_status IS NULL AND hub_status = 'SUCCESS' THEN 'NULL_STATUS_CHARGED' "
        f"WHEN ledger_status <> '{success}' AND hub_status = 'SUCCESS' THEN 'HUB_ONLY_SUCCESS' END"
    )
    return group(
        pairs.selectExpr("*", f"{kind} AS mismatch").where("mismatch IS NOT NULL"),
        ["mismatch", "gateway"],
        "sum(n) AS n_rows",
        f"{total('hub_amount * n')} AS hub_amount",
    )


def _in_scope_pairs(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    return linked(
        ledger.where("in_scope"), hub.where("status = 'SUCCESS'"), ["ledger_amount"], "inner"
    )


def l1_amount_compare(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """Equal and unequal amounts on rows that are good on both sides."""
    return group(
        _in_scope_pairs(ledger, hub),
        "ledger_table",
        "sum(n) AS matched",
        "sum(CASE WHEN ledger_amount = hub_amount THEN n ELSE 0 END) AS amount_equal",
        "sum(CASE WHEN ledger_amount <> hub_amount THEN n ELSE 0 END) AS amount_differs",
        f"{total('ledger_amount * n')} AS ledger_total",
        f"{total('hub_amount * n')} AS hub_total",
        f"{total('(hub_amount - ledger_amount) * n')} AS diff",
    )


def l1_amount_mismatch_rows(ledger: DataFrame, hub: DataFrame, k: int | None = None) -> DataFrame:
    """Rows whose amounts differ; the ``k`` largest differences if given."""
    rows = (
        _in_scope_pairs(ledger, hub)
        .where("ledger_amount <> hub_amount")
        .selectExpr(
            "ledger_table",
            "order_id",
            "ledger_amount",
            "hub_amount",
            "CAST(hub_amount - ledger_amount AS DECIMAL(18,2)) AS diff",
            "n AS n_rows",
        )
    )
    return rows if k is None else top_k(rows, k, "abs(diff) DESC", "order_id", "ledger_table")


def matched_amounts(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """Totals of both sides on matched rows, per ledger and overall."""
    sums = l1_amount_compare(ledger, hub).select(
        "ledger_table", "matched", "hub_total", "ledger_total", "amount_differs"
    )
    return with_totals(
        sums, ["ledger_table"], "matched", "hub_total", "ledger_total", "amount_differs"
    ).selectExpr("*", "hub_total - ledger_total AS diff")


# --- orphans -------------------------------------------------------------------------


def orphans(hub: DataFrame, ledger: DataFrame, status: str | None = "SUCCESS") -> DataFrame:
    """Hub rows that no ledger knows."""
    rows = hub if status is None else hub.where(f"status = '{status}'")
    return rows.join(key_set(ledger, "order_id"), "order_id", "left_anti")


def _flagged(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    keys = key_set(ledger, "order_id").selectExpr("order_id", "true AS in_ledger")
    return hub.join(keys, "order_id", "left")


def l1_orphans(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    """Successful hub rows, how many have no ledger row, and their share."""
    sums = group(
        _flagged(hub.where("status = 'SUCCESS'"), ledger),
        [],
        "count(*) AS hub_rows",
        f"{total('amount')} AS hub_amount",
        "count_if(in_ledger IS NULL) AS orphan_rows",
        total("amount", "in_ledger IS NULL") + " AS orphan_amount",
    )
    return sums.selectExpr(
        "*",
        safe_pct("orphan_rows", "hub_rows") + " AS orphan_pct",
        safe_pct("orphan_amount", "hub_amount") + " AS orphan_amount_pct",
    )


def l1_orphans_by(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    """Orphans of any status by family and status, gateway, and month."""
    return profile(
        orphans(hub, ledger, None),
        {
            "pattern_status": f"concat({order_pattern('order_id')}, ' ', status)",
            "gateway": "gateway",
            "source_month": "source_month",
        },
        "amount",
    )


def l1_orphan_samples(hub: DataFrame, ledger: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` largest orphans."""
    rows = orphans(hub, ledger).select(
        "order_id", "gateway", "amount", "status", "created_date", "customer_id"
    )
    return top_k(rows, k, "amount DESC", "order_id")


def l1_per_table_coverage(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct successful hub ids found in each ledger, and their share of all."""
    ids = hub.where("status = 'SUCCESS'").select("order_id").distinct()
    found = group(
        key_set(ledger, "ledger_table", "order_id").join(ids, "order_id"),
        "ledger_table",
        "count(*) AS hub_ids",
    )
    everything = group(ids, [], "CAST(count(*) AS DOUBLE) AS n").scalar()
    return found.withColumn("hub_pct", found["hub_ids"] * 100 / everything)


def l1_unique_summary(hub: DataFrame, ledger: DataFrame, hub_refund: DataFrame) -> DataFrame:
    """Distinct ids on both sides and on one side only, amounts, and refund totals.

    All sides are stacked and grouped by id once instead of being joined.
    """
    money = "CAST(0 AS DECIMAL(18,2))"

    def side(df: DataFrame, key: str, **values: str) -> DataFrame:
        cols = {
            "in_scope": "0", "in_any": "0", "in_hub": "0", "rf": "0", "hr": "0",
            "scope_amount": money, "hub_amount": money, "rf_amount": money, "hr_amount": money,
        } | values
        return df.selectExpr(f"{key} AS id", *[f"{v} AS {k}" for k, v in cols.items()])

    refunded = "ledger_table = 'ledger_refunded'"
    stacked = union_all(
        [
            side(
                ledger.where("order_id IS NOT NULL"),
                "order_id",
                in_scope=f"int(in_scope AND NOT ({refunded}) AND ledger_table <> 'ledger_topup')",
                in_any="1",
                rf=f"int({refunded})",
                scope_amount="CASE WHEN in_scope AND ledger_table NOT IN "
                f"('ledger_refunded', 'ledger_topup') THEN ledger_amount ELSE {money} END",
                rf_amount=f"CASE WHEN {refunded} THEN ledger_amount ELSE {money} END",
            ),
            side(hub.where("status = 'SUCCESS'"), "order_id", in_hub="1", hub_amount="amount"),
            side(
                hub_refund.where("refund_status = 'SUCCESS'"),
                "order_id",
                hr="1",
                hr_amount="refund_amount",
            ),
        ]
    )
    ids = group(
        stacked,
        "id",
        "max(in_scope) AS in_scope",
        "max(in_any) AS in_any",
        "max(in_hub) AS in_hub",
        "sum(rf) AS rf",
        "sum(hr) AS hr",
        *[f"sum({c}) AS {c}" for c in ("scope_amount", "hub_amount", "rf_amount", "hr_amount")],
    )
    return group(
        ids,
        [],
        "count_if(in_scope = 1) AS ledger_ids",
        "count_if(in_hub = 1) AS hub_ids",
        "count_if(in_scope = 1 AND in_hub = 1) AS both_ids",
        "count_if(in_scope = 1 AND in_hub = 0) AS ledger_only_ids",
        "count_if(in_hub = 1 AND in_any = 0) AS hub_only_ids",
        "sum(rf) AS ledger_refunds",
        "sum(hr) AS hub_refunds",
        f"{total('scope_amount')} AS ledger_amount",
        f"{total('hub_amount')} AS hub_amount",
        f"{total('rf_amount')} AS ledger_refund_amount",
        f"{total('hr_amount')} AS hub_refund_amount",
    )


# --- ledgers among themselves --------------------------------------------------------


def _by_id(ledger: DataFrame, where: str, name: str) -> DataFrame:
    return group(
        ledger.where(f"({where}) AND order_id IS NOT NULL"),
        "order_id",
        f"count(*) AS n_{name}",
        f"sum(ledger_amount) AS amount_{name}",
    )


def ledger_overlap(ledger: DataFrame, first: str, second: str) -> DataFrame:
    """In-scope ids of two ledgers: in both, only in one, by family."""
    a = _by_id(ledger, f"ledger_table = '{first}' AND in_scope", "a")
    b = _by_id(ledger, f"ledger_table = '{second}' AND in_scope", "b")
    side = "CASE WHEN n_a IS NULL THEN 'second only' WHEN n_b IS NULL THEN 'first only' ELSE 'both' END"
    return group(
        a.join(b, "order_id", "full").selectExpr(
            f"{side} AS side", f"{order_pattern('order_id')} AS order_pattern", "amount_a", "amount_b"
        ),
        ["side", "order_pattern"],
        "count(*) AS ids",
        f"{total('amount_a')} AS first_amount",
        f"{total('amount_b')} AS second_amount",
    )


def deduplicated(ledger: DataFrame, first: str, second: str) -> DataFrame:
    """In-scope rows of ``first`` plus those of ``second`` whose id ``first`` lacks."""
    a = ledger.where(f"ledger_table = '{first}' AND in_scope")
    known = key_set(ledger.where(f"ledger_table = '{first}'"), "order_id")
    b = group(
        ledger.where(f"ledger_table = '{second}' AND in_scope"),
        ["ledger_table", "order_id"],
        "count(*) AS n",
        "sum(ledger_amount) AS amount",
    )
    rows = group(a, ["ledger_table", "order_id"], "count(*) AS n", "sum(ledger_amount) AS amount")
    return rows.unionByName(b.join(known, "order_id", "left_anti").select(*rows.columns))


def ledger_dedup_total(ledger: DataFrame, first: str, second: str) -> DataFrame:
    sums = group(
        deduplicated(ledger, first, second),
        "ledger_table",
        "sum(n) AS n_rows",
        f"{total('amount')} AS amount",
    )
    return with_totals(sums, ["ledger_table"], "n_rows", "amount")


def inflow_total(ledger: DataFrame, hub: DataFrame, first: str, second: str) -> DataFrame:
    """Online money in by the ledgers, by the hub, and the cash outside the hub."""
    others = ledger.where(
        "in_scope AND ledger_table IN ('ledger_deposit', 'ledger_mobile', 'ledger_ott')"
    ).selectExpr("'ledger' AS source", "ledger_amount AS amount")
    parts = union_all(
        [
            deduplicated(ledger, first, second).selectExpr("'ledger' AS source", "amount"),
            others,
            hub.where("status = 'SUCCESS'").selectExpr("'hub' AS source", "amount"),
            ledger.where(f"ledger_table = '{first}' AND mode = 'cash'").selectExpr(
                "'cash' AS source", "ledger_amount AS amount"
            ),
        ]
    )
    return group(
        parts,
        [],
        total("amount", "source = 'ledger'") + " AS ledger_total",
        total("amount", "source = 'hub'") + " AS hub_total",
        total("amount", "source = 'cash'") + " AS cash_total",
    ).selectExpr(
        "*", "hub_total - ledger_total AS diff", "ledger_total + cash_total AS with_cash"
    )


# --- key coverage --------------------------------------------------------------------


@dataclass(frozen=True)
class Keys:
    """Rows that carry an id of one domain.

    ``member`` is SQL text: a literal, or a column when one frame holds several
    members, as the ledger relation does.
    """

    domain: str
    member: str
    rows: DataFrame
    key: str


#: link name -> (domain, left member, right member)
Links = dict[str, tuple[str, str, str]]


def _member_counts(sides: list[Keys], links: Links) -> tuple[DataFrame, dict[tuple[str, str], str]]:
    """One row per id with the number of rows each member has under it.

    Every frame is read once, however many ids of it and links take part. There is
    no join, and an id that fills a member is counted map-side. That count keeps one
    number an id and member; the many columns are laid side by side in a window, which
    holds one id at a time, and not in a hash table of all ids.
    """
    members = sorted({(d, m) for d, left, right in links.values() for m in (left, right)})
    domains = {d: i for i, d in enumerate(dict.fromkeys(d for d, _ in members))}
    column = {dm: f"c{i}" for i, dm in enumerate(members)}
    by_frame: dict[int, list[Keys]] = {}
    for x in sides:
        if x.domain in domains:
            by_frame.setdefault(id(x.rows), []).append(x)
    stacked = union_all([_stacked(own, domains, members) for own in by_frame.values()])
    counted = group(
        stacked.where("id IS NOT NULL AND member IS NOT NULL"), ["domain", "id", "member"], "count(*) AS n"
    )
    own = Window.partitionBy("domain", "id")
    side_by_side = {
        col: F.coalesce(F.max(F.expr(f"CASE WHEN member = {i} THEN n END")).over(own), F.lit(0))
        for i, col in enumerate(column.values())
    }
    rows = counted.withColumns({"_first": F.min("member").over(own), **side_by_side})
    return rows.where("member = _first").select("domain", "id", *side_by_side), column


def _stacked(own: list[Keys], domains: dict[str, int], members: list[tuple[str, str]]) -> DataFrame:
    """All (domain, id, member) of one frame's rows, domains and members as their numbers; null if no link asks."""

    def number(x: Keys) -> str:
        known = " ".join(f"WHEN '{m}' THEN {i}Y" for i, (d, m) in enumerate(members) if d == x.domain)
        return f"CASE {x.member} {known} END" if known else "CAST(NULL AS TINYINT)"

    ids = ", ".join(f"{domains[x.domain]}Y, CAST({x.key} AS STRING), {number(x)}" for x in own)
    return own[0].rows.selectExpr(f"stack({len(own)}, {ids}) AS (domain, id, member)")


def _per_link(ids: DataFrame, measures: dict[str, dict[str, str]]) -> DataFrame:
    """``measures[link][name]`` as one row per link: all links in one aggregate."""
    names = list(next(iter(measures.values())))
    aggs = [
        f"{sql} AS x{i}_{n}" for i, by_name in enumerate(measures.values()) for n, sql in by_name.items()
    ]
    rows = ", ".join(
        f"'{link}', " + ", ".join(f"x{i}_{n}" for n in names) for i, link in enumerate(measures)
    )
    return group(ids, [], *aggs).selectExpr(
        f"stack({len(measures)}, {rows}) AS (link, {', '.join(names)})"
    )


def key_link_coverage(sides: list[Keys], links: Links) -> DataFrame:
    """Rows and distinct keys per link, and how many of them find a partner."""
    ids, column = _member_counts(sides, links)
    measures = {}
    for name, (domain, left, right) in links.items():
        n, m = column[domain, left], column[domain, right]
        measures[name] = {
            "left_rows": f"coalesce(sum({n}), 0)",
            "matched_rows": f"coalesce(sum(CASE WHEN {m} > 0 THEN {n} END), 0)",
            "left_keys": f"count_if({n} > 0)",
            "matched_keys": f"count_if({n} > 0 AND {m} > 0)",
        }
    return _per_link(ids, measures).selectExpr(
        "*", safe_pct("matched_keys", "left_keys") + " AS matched_pct"
    )


def entity_link(sides: list[Keys], links: Links) -> DataFrame:
    """Many-to-many links: partners on both sides and the number of pairs.

    Pairs are counted as the product of the two group sizes; none is built.
    """
    ids, column = _member_counts(sides, links)
    measures = {}
    for name, (domain, left, right) in links.items():
        n, m = column[domain, left], column[domain, right]
        both = f"{n} > 0 AND {m} > 0"
        measures[name] = {
            "shared_entities": f"count_if({both})",
            "left_rows": f"coalesce(sum(CASE WHEN {both} THEN {n} END), 0)",
            "right_rows": f"coalesce(sum(CASE WHEN {both} THEN {m} END), 0)",
            "pairs": f"CAST(coalesce(sum(CAST({n} AS DECIMAL(19,0)) * {m}), 0) AS DOUBLE)",
        }
    return _per_link(ids, measures)


def deposit_link(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    """The deposit ledger linked by its own key and by its alternate key."""
    deposits = ledger.where("ledger_table = 'ledger_deposit'")
    return key_link_coverage(
        [
            Keys("order", "'own'", deposits, "order_id"),
            Keys("order", "'alternate'", deposits, "alt_key"),
            Keys("order", "'hub'", hub, "order_id"),
            Keys("transaction", "'alternate'", deposits, "alt_key"),
            Keys("transaction", "'hub'", hub, "hub_txn_id"),
        ],
        {
            "deposit by own key": ("order", "own", "hub"),
            "deposit by alternate key": ("order", "alternate", "hub"),
            "deposit by hub transaction": ("transaction", "alternate", "hub"),
        },
    )


def revenue_link(ledger: DataFrame, hub: DataFrame) -> DataFrame:
    both = ledger.where("ledger_table IN ('ledger_revenue', 'ledger_booking')")
    return key_link_coverage(
        [Keys("order", "ledger_table", both, "order_id"), Keys("order", "'hub'", hub, "order_id")],
        {
            "revenue to hub": ("order", "ledger_revenue", "hub"),
            "revenue to booking": ("order", "ledger_revenue", "ledger_booking"),
        },
    )


def chain_coverage(
    hub: DataFrame,
    hub_refund: DataFrame,
    gateway_txn: DataFrame,
    settlement: DataFrame,
    gateway_refund: DataFrame,
    ledger: DataFrame,
) -> DataFrame:
    """Coverage of every id link of the chain, layer by layer."""
    refund_key = "CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END"

    def at_gateway(key: str) -> str:
        return f"concat(gateway, '|', {key})"

    sides = [
        Keys("order", "ledger_table", ledger, "order_id"),
        Keys("order", "'hub'", hub, "order_id"),
        Keys("order", "'hub_refund'", hub_refund, "order_id"),
        Keys("transaction", "'hub'", hub, "hub_txn_id"),
        Keys("transaction", "'hub_refund'", hub_refund, "refund_txn_id"),
        Keys("gateway", "'hub'", hub, at_gateway("settle_key")),
        Keys("gateway", "'gateway'", gateway_txn, at_gateway("gw_key")),
        Keys("gateway", "'settlement'", settlement, at_gateway("settlement_order_id")),
        Keys("gateway", "'hub_refund'", hub_refund, at_gateway(refund_key)),
        Keys("gateway", "'gateway_refund'", gateway_refund, at_gateway("refund_key")),
        Keys("gateway", "'refunded'", gateway_refund, at_gateway("original_key")),
    ]
    links = {f"{t} to hub": ("order", t, "hub") for t in LEDGER_TABLES} | {
        "ledger_revenue to ledger_topup": ("order", "ledger_revenue", "ledger_topup"),
        "ledger_refunded to hub_refund": ("order", "ledger_refunded", "hub_refund"),
        "hub_refund to hub by order": ("order", "hub_refund", "hub"),
        "hub_refund to hub by transaction": ("transaction", "hub_refund", "hub"),
        "hub to gateway": ("gateway", "hub", "gateway"),
        "gateway to settlement": ("gateway", "gateway", "settlement"),
        "hub_refund to gateway_refund": ("gateway", "hub_refund", "gateway_refund"),
        "gateway_refund to gateway": ("gateway", "refunded", "gateway"),
    }
    return key_link_coverage(sides, links)


def refund_to_original(gateway_refund: DataFrame, gateway_txn: DataFrame) -> DataFrame:
    """Gateway refund rows and the transactions they refund, per gateway."""
    refunds = group(
        gateway_refund.selectExpr("gateway", "original_key AS gw_key", "amount"),
        ["gateway", "gw_key"],
        "count(*) AS n",
        "sum(amount) AS refunded",
    )
    originals = group(gateway_txn, ["gateway", "gw_key"], "sum(amount) AS original")
    return group(
        refunds.join(originals, ["gateway", "gw_key"], "left"),
        "gateway",
        "sum(n) AS refund_rows",
        "sum(CASE WHEN original IS NOT NULL THEN n ELSE 0 END) AS matched_rows",
        f"{total('refunded')} AS refund_amount",
        f"{total('original')} AS original_amount",
    )


# --- mismatch reports ----------------------------------------------------------------


# Fixed value: how ids of returned booking fees begin.
BOOKING_REVERSAL = "BOOKING_PAYMENT"


def mismatch_ledger_to_hub(booking: DataFrame, revenue: DataFrame, hub: DataFrame) -> DataFrame:
    """Status and amount mismatches of two ledgers and revenue rows unknown to the hub.

    Takes the two source tables, since the report shows their own columns.
    """
    hubs = hub.selectExpr(
        "order_id AS hub_order_id", "status AS hub_status", "amount AS hub_amount",
        "gateway AS hub_gateway", "created_date AS hub_date",
    )
    b = booking.selectExpr(
        "'ledger_booking' AS ledger_table", "booking_txn_id AS ledger_txn_id",
        "created_on AS ledger_date", "CAST(booking_fee AS DECIMAL(18,2)) AS ledger_amount",
        "resultstatus AS ledger_status", "payment_flag AS ledger_flag",
        "payment_gateway_name AS ledger_gateway",
    )
    r = revenue.where("mode = 'online'").selectExpr(
        "'ledger_revenue' AS ledger_table", "transaction_id AS ledger_txn_id",
        "recharge_dt AS ledger_date", "CAST(totalpaid AS DECIMAL(18,2)) AS ledger_amount",
        "CAST(NULL AS STRING) AS ledger_status", "mode AS ledger_flag",
        "CAST(NULL AS STRING) AS ledger_gateway",
    )
    amounts = "concat('ledger ', CAST(ledger_amount AS STRING), ' vs hub ', CAST(hub_amount AS STRING))"
    only = (
        f"CASE WHEN {is_partner_wallet('ledger_txn_id')} THEN 'partner wallet, outside the hub' "
        "WHEN startswith(ledger_txn_id, 'gen_') AND ledger_amount = 0 THEN 'nothing paid, failed or cancelled' "
        f"WHEN startswith(ledger_txn_id, '{BOOKING_REVERSAL}') THEN 'booking fee reversal' "
        "ELSE 'not found in the hub' END"
    )
    both_ok = "ledger_status = 'TXN_SUCCESS' AND hub_status = 'SUCCESS'"
    differs = "ledger_amount <> hub_amount"
    # Both ledgers are joined once; the branches are arms of one CASE.
    rows = b.unionByName(r).join(hubs, F.expr("hub_order_id = ledger_txn_id"), "left")
    kind = (
        "CASE WHEN ledger_table = 'ledger_booking' THEN "
        "  CASE WHEN ledger_status IS NULL AND hub_order_id IS NOT NULL THEN 'STATUS_MISMATCH' "
        f"      WHEN {both_ok} AND {differs} THEN 'AMOUNT_MISMATCH' END "
        "WHEN hub_order_id IS NULL THEN 'LEDGER_ONLY' "
        f"WHEN hub_status = 'SUCCESS' AND {differs} THEN 'AMOUNT_MISMATCH' END"
    )
    return (
        rows.selectExpr("*", f"{kind} AS mismatch_type")
        .where("mismatch_type IS NOT NULL")
        .selectExpr(
            "*",
            f"""CASE mismatch_type WHEN 'STATUS_MISMATCH' THEN 'ledger status missing, hub row exists'
                     WHEN 'AMOUNT_MISMATCH' THEN {amounts} ELSE {only} END AS mismatch_reason""",
            """CAST(CASE WHEN mismatch_type <> 'LEDGER_ONLY'
                    THEN coalesce(hub_amount, 0) - coalesce(ledger_amount, 0) END AS DECIMAL(18,2))
               AS amount_diff""",
        )
    )


def mismatch_hub_to_ledger(hub: DataFrame, ledger: DataFrame) -> DataFrame:
    return orphans(hub, ledger).selectExpr(
        "order_id AS hub_order_id", "status AS hub_status", "amount AS hub_amount",
        "gateway AS hub_gateway", "created_date AS hub_date", "order_status", "customer_id",
        "payment_flow", f"{order_pattern('order_id')} AS order_pattern",
        "'HUB_ONLY' AS mismatch_type", "'successful hub row in no ledger' AS mismatch_reason",
    )


def mismatch_summary(ledger_to_hub: DataFrame, hub_to_ledger: DataFrame) -> DataFrame:
    """Both reports counted by type, family and gateway."""
    both = union_all(
        [
            ledger_to_hub.selectExpr(
                "mismatch_type", f"{order_pattern('ledger_txn_id')} AS order_pattern",
                "hub_gateway AS gateway", "ledger_amount AS amount",
            ),
            hub_to_ledger.selectExpr(
                "mismatch_type", "order_pattern", "hub_gateway AS gateway", "hub_amount AS amount"
            ),
        ]
    )
    return group(
        both, ["mismatch_type", "order_pattern", "gateway"], "count(*) AS n_rows",
        f"{total('amount')} AS amount",
    )
