"""Queries on the reverse trace."""

from __future__ import annotations

import re
from collections.abc import Callable

from tallychain.config import Period
from tallychain.operators import base as ops
from tallychain.operators import partials, refresh, trace
from tallychain.operators.frames import group
from tallychain.plans.registry import Chain, body, kept, query
from tallychain.session import shared_dir
from tallychain.sources import base_store, copartitioned, sinks

MONTH = Period.month("1996-01")
NEXT_MONTH = Period.month("1996-02")


@query("recon_base", """
SELECT gateway, settlement_order_id, bank_date, bank_daily_deposit::DOUBLE AS bank_daily_deposit,
       settled_date, recon_month, sett_gross::DOUBLE AS sett_gross, sett_net::DOUBLE AS sett_net,
       sett_fee::DOUBLE AS sett_fee, sett_utr, sett_txn_type, hub_order_id, hub_txn_id,
       hub_amount::DOUBLE AS hub_amount, hub_status, hub_gateway, hub_created_date, l2_match,
       ledger_txn_id, ledger_table, ledger_amount::DOUBLE AS ledger_amount, l1_match,
       order_id_prefix, trace_status, trace_status_basic,
       diff_hub_vs_sett::DOUBLE AS diff_hub_vs_sett,
       diff_ledger_vs_hub::DOUBLE AS diff_ledger_vs_hub, source_month
FROM base""")
def recon_base(c: Chain):
    return c.base


@query("ledger_lookup", """
SELECT order_id, ledger_table, ledger_amount::DOUBLE AS ledger_amount FROM lookup_all""")
def ledger_lookup(c: Chain):
    return ops.ledger_lookup(c.ledger).where("ledger_txn_id IS NOT NULL").select(
        "order_id", "ledger_table", "ledger_amount"
    )


@query("l2_match", "SELECT gateway, l2_match, COUNT(*) AS n_rows FROM base GROUP BY 1, 2")
def l2_match(c: Chain):
    return group(c.base, ["gateway", "l2_match"], "count(*) AS n_rows")


@query("l1_match", "SELECT gateway, l1_match, COUNT(*) AS n_rows FROM base GROUP BY 1, 2")
def l1_match(c: Chain):
    return group(c.base, ["gateway", "l1_match"], "count(*) AS n_rows")


@query("trace_status_basic", """
SELECT gateway, trace_status_basic, COUNT(*) AS n_rows FROM base GROUP BY 1, 2""")
def trace_status_basic(c: Chain):
    return group(c.base, ["gateway", "trace_status_basic"], "count(*) AS n_rows")


@query("trace_status", """
SELECT trace_status, l1_match, l2_match, COUNT(*) AS n_rows FROM base GROUP BY 1, 2, 3""")
def trace_status(c: Chain):
    return group(c.base, ["trace_status", "l1_match", "l2_match"], "count(*) AS n_rows")


@query("diff_columns", """
SELECT gateway, COUNT(diff_hub_vs_sett) AS hub_rows, SUM(diff_hub_vs_sett)::DOUBLE AS hub_vs_sett,
       COUNT(diff_ledger_vs_hub) AS ledger_rows, SUM(diff_ledger_vs_hub)::DOUBLE AS ledger_vs_hub,
       COUNT(DISTINCT source_month) AS source_months
FROM base GROUP BY 1""")
def diff_columns(c: Chain):
    return group(
        c.base,
        "gateway",
        "count(diff_hub_vs_sett) AS hub_rows",
        "sum(diff_hub_vs_sett) AS hub_vs_sett",
        "count(diff_ledger_vs_hub) AS ledger_rows",
        "sum(diff_ledger_vs_hub) AS ledger_vs_hub",
        "count(DISTINCT source_month) AS source_months",
    )


@query("recon_row_counts", """
SELECT coalesce(gateway, 'ALL') AS gateway, COUNT(*) AS n_rows FROM base b GROUP BY ROLLUP (b.gateway)""")
def recon_row_counts(c: Chain):
    return ops.recon_row_counts(c.base)


@query("recon_summary", """
SELECT coalesce(b.gateway, 'ALL') AS gateway, coalesce(b.trace_status, 'ALL') AS trace_status,
       COUNT(*) AS n_rows, coalesce(SUM(sett_gross), 0)::DOUBLE AS sett_gross,
       coalesce(SUM(sett_net), 0)::DOUBLE AS sett_net,
       coalesce(SUM(hub_amount), 0)::DOUBLE AS hub_amount,
       coalesce(SUM(ledger_amount), 0)::DOUBLE AS ledger_amount
FROM base_once b GROUP BY ROLLUP (b.gateway, b.trace_status)""")
def recon_summary(c: Chain):
    return ops.recon_summary(c.base)


@query("recon_waterfall", """
WITH w AS (
  SELECT b.gateway, SUM(sett_gross) AS gross, SUM(sett_net) AS net,
         coalesce(SUM(hub_amount) FILTER (l2_match = 'MATCHED'), 0) AS hub_amt,
         coalesce(SUM(ledger_amount) FILTER (l1_match = 'MATCHED'), 0) AS led
  FROM base_once b GROUP BY 1),
sides AS (
  SELECT gateway, 0 AS dep, gross, net, hub_amt, led FROM w UNION ALL
  SELECT gateway, deposit, 0, 0, 0, 0 FROM bank),
steps AS (
  SELECT gateway, unnest(['bank', 'gross', 'net', 'hub', 'ledger', 'bank_minus_gross',
                          'gross_minus_hub', 'hub_minus_ledger']) AS layer,
         unnest([dep, gross, net, hub_amt, led, dep - gross, gross - hub_amt, hub_amt - led]) AS amount
  FROM sides)
SELECT layer, coalesce(SUM(amount) FILTER (gateway = 'GW_A'), 0)::DOUBLE AS gw_a,
       coalesce(SUM(amount) FILTER (gateway = 'GW_B'), 0)::DOUBLE AS gw_b,
       coalesce(SUM(amount) FILTER (gateway = 'GW_C'), 0)::DOUBLE AS gw_c,
       coalesce(SUM(amount) FILTER (gateway = 'GW_D'), 0)::DOUBLE AS gw_d,
       coalesce(SUM(amount) FILTER (coalesce(gateway, '') NOT IN ('GW_A', 'GW_B', 'GW_C', 'GW_D')), 0)::DOUBLE
         AS unassigned,
       SUM(amount)::DOUBLE AS all_gateways
FROM steps GROUP BY 1""")
def recon_waterfall(c: Chain):
    return ops.recon_waterfall(c.base, c.bank)


@query("gap_a_bank", """
WITH s AS (SELECT gateway, settled_date, COUNT(*) AS n, SUM(sett_gross) AS g, SUM(sett_net) AS net
           FROM base GROUP BY 1, 2),
t AS (SELECT coalesce(s.gateway, 'ALL') AS gw, COUNT(*) AS sett_days,
       SUM(n)::BIGINT AS sett_rows, SUM(g) AS g, SUM(net) AS net,
       coalesce(SUM(b.bank_daily_deposit), 0) AS dep
FROM s LEFT JOIN bank_daily b ON b.gateway = s.gateway AND b.bank_date = s.settled_date
GROUP BY ROLLUP (s.gateway))
SELECT gw AS gateway, sett_days, sett_rows, g::DOUBLE AS sett_gross, net::DOUBLE AS sett_net,
       dep::DOUBLE AS bank_deposit, (dep - net)::DOUBLE AS gap,
       CASE WHEN net = 0 THEN 0 ELSE (dep - net)::DOUBLE * 100 / net::DOUBLE END AS gap_pct
FROM t""")
def gap_a_bank(c: Chain):
    return ops.gap_a_bank(c.base, c.bank)


@query("gap_b_settlement_only", """
SELECT gateway, order_id_prefix, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross,
       SUM(sett_net)::DOUBLE AS net
FROM base WHERE l2_match = 'SETT_ONLY' GROUP BY 1, 2""")
def gap_b_settlement_only(c: Chain):
    return ops.gap_b_settlement_only(c.base)


@query("gap_c_hub_only", """
SELECT gateway, order_id_prefix, COUNT(*) AS n_rows, SUM(hub_amount)::DOUBLE AS hub_amount,
       SUM(sett_gross)::DOUBLE AS sett_gross
FROM base_once WHERE l1_match = 'HUB_ONLY' GROUP BY 1, 2""")
def gap_c_hub_only(c: Chain):
    return ops.gap_c_hub_only(c.base)


@query("gap_b_settlement_only_top", """
SELECT gateway, order_id_prefix, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross,
       SUM(sett_net)::DOUBLE AS net
FROM base WHERE l2_match = 'SETT_ONLY' GROUP BY 1, 2
ORDER BY SUM(sett_gross) DESC, 1, 2 LIMIT 10""")
def gap_b_settlement_only_top(c: Chain):
    return ops.gap_b_settlement_only(c.base, 10)


@query("gap_c_hub_only_top", """
SELECT gateway, order_id_prefix, COUNT(*) AS n_rows, SUM(hub_amount)::DOUBLE AS hub_amount,
       SUM(sett_gross)::DOUBLE AS sett_gross
FROM base_once b WHERE l1_match = 'HUB_ONLY' GROUP BY 1, 2
ORDER BY SUM(b.hub_amount) DESC, 1, 2 LIMIT 5""")
def gap_c_hub_only_top(c: Chain):
    return ops.gap_c_hub_only(c.base, 5)


@query("gap_c_resolved", """
SELECT gateway, trace_status, COUNT(*) AS n_rows, SUM(hub_amount)::DOUBLE AS hub_amount
FROM base_once WHERE l1_match = 'HUB_ONLY' GROUP BY 1, 2""")
def gap_c_resolved(c: Chain):
    return ops.gap_c_resolved(c.base)


@query("gap_d_amount", """
SELECT coalesce(b.gateway, 'ALL') AS gateway, COUNT(*) AS matched_rows,
       COUNT(*) FILTER (abs(diff_ledger_vs_hub) < 0.5) AS exact_rows,
       COUNT(*) FILTER (abs(diff_ledger_vs_hub) >= 0.5) AS diff_rows,
       SUM(hub_amount)::DOUBLE AS hub_total, SUM(ledger_amount)::DOUBLE AS ledger_total,
       SUM(hub_amount - ledger_amount)::DOUBLE AS diff_total
FROM base_once b WHERE l1_match = 'MATCHED' GROUP BY ROLLUP (b.gateway)""")
def gap_d_amount(c: Chain):
    return ops.gap_d_amount(c.base)


@query("recon_source_month", """
WITH b AS (SELECT gateway AS gw, sett_gross AS g, hub_amount AS h,
       CASE WHEN hub_created_date IS NULL THEN 'NOT_IN_HUB'
            WHEN hub_created_date < DATE '1995-12-01' THEN 'EARLIER'
            WHEN hub_created_date < DATE '1996-01-01' THEN 'PREVIOUS_MONTH'
            WHEN hub_created_date < DATE '1996-02-01' THEN 'THIS_MONTH' ELSE 'LATER' END AS ci
  FROM base_once)
SELECT coalesce(gw, 'ALL') AS gateway, coalesce(ci, 'ALL') AS created_in, COUNT(*) AS n_rows,
       SUM(g)::DOUBLE AS sett_gross, coalesce(SUM(h), 0)::DOUBLE AS hub_amount
FROM b GROUP BY ROLLUP (gw, ci)""")
def recon_source_month(c: Chain):
    return ops.recon_source_month(c.base, MONTH)


def _n(cond: str, name: str) -> str:
    return f"COUNT(*) FILTER ({cond}) AS {name}"


def _g(cond: str, name: str) -> str:
    return f"coalesce(SUM(sett_gross) FILTER ({cond}), 0)::DOUBLE AS {name}"


@query("recon_scorecard", f"""
SELECT COUNT(*) AS total_rows, SUM(sett_gross)::DOUBLE AS total_gross, SUM(sett_net)::DOUBLE AS total_net,
       {_n("hub_order_id IS NOT NULL", "l2_matched")}, {_n("hub_order_id IS NULL", "l2_sett_only")},
       {_g("hub_order_id IS NOT NULL", "l2_matched_gross")},
       {_g("hub_order_id IS NULL", "l2_sett_only_gross")},
       {_n("l1_match = 'MATCHED'", "l1_matched")}, {_n("l1_match = 'HUB_ONLY'", "l1_hub_only")},
       {_n("l1_match = 'PARTNER_WALLET'", "l1_partner_wallet")}, {_n("l1_match = 'NO_HUB'", "l1_no_hub")},
       {_n("trace_status_basic = 'FULLY_TRACED'", "rows_traced")},
       {_n("trace_status_basic = 'MISSING_HUB'", "rows_no_hub")},
       {_n("trace_status_basic = 'MISSING_LEDGER'", "rows_no_ledger")},
       {_n("trace_status_basic = 'PARTNER_WALLET'", "rows_partner")},
       {_g("trace_status_basic = 'FULLY_TRACED'", "gross_traced")},
       {_g("trace_status_basic = 'MISSING_HUB'", "gross_no_hub")},
       {_g("trace_status_basic = 'MISSING_LEDGER'", "gross_no_ledger")},
       {_g("trace_status_basic = 'PARTNER_WALLET'", "gross_partner")}
FROM base""")
def recon_scorecard(c: Chain):
    return ops.recon_scorecard(c.base)


@query("recon_month_compare", """
SELECT trace_status, COUNT(*) FILTER (recon_month = '1996-01') AS rows_first,
       coalesce(SUM(sett_gross) FILTER (recon_month = '1996-01'), 0)::DOUBLE AS gross_first,
       COUNT(*) FILTER (recon_month = '1996-02') AS rows_second,
       coalesce(SUM(sett_gross) FILTER (recon_month = '1996-02'), 0)::DOUBLE AS gross_second
FROM base WHERE recon_month IN ('1996-01', '1996-02') GROUP BY 1""")
def recon_month_compare(c: Chain):
    return ops.recon_month_compare(c.base, MONTH, NEXT_MONTH)


@query("gap_drilldown", """
SELECT order_id_prefix, gateway, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS amount
FROM base WHERE trace_status = 'MISSING_LEDGER' GROUP BY 1, 2""")
def gap_drilldown(c: Chain):
    return ops.gap_drilldown(c.base)


@query("traced_waterfall", """
SELECT gateway, SUM(sett_gross)::DOUBLE AS sett_gross, SUM(sett_net)::DOUBLE AS sett_net,
       SUM(sett_fee)::DOUBLE AS fees, SUM(hub_amount)::DOUBLE AS hub_total,
       SUM(ledger_amount)::DOUBLE AS ledger_total
FROM base_once WHERE trace_status = 'FULLY_TRACED' GROUP BY 1""")
def traced_waterfall(c: Chain):
    return ops.traced_waterfall(c.base)


@query("trace_one", """
SELECT gateway, settlement_order_id, settled_date, sett_gross::DOUBLE AS sett_gross, hub_order_id,
       ledger_table, trace_status
FROM base WHERE settlement_order_id = 'sub_22' OR hub_order_id = 'sub_22' OR hub_txn_id = 'sub_22'""")
def trace_one(c: Chain):
    return trace.trace_one(c.base, "sub_22").select(
        "gateway", "settlement_order_id", "settled_date", "sett_gross", "hub_order_id",
        "ledger_table", "trace_status",
    )


@query("trace_end_to_end", """
WITH ids AS (SELECT DISTINCT order_id FROM hub_refund),
st AS (SELECT gateway, settlement_order_id AS gw_key, settled_date, COUNT(*) AS n,
              SUM(sett_gross) AS g, SUM(sett_net) AS net, SUM(sett_fee) AS fee
       FROM settlement WHERE is_forward GROUP BY 1, 2, 3)
SELECT i.order_id, w.ledger_table, w.ledger_amount::DOUBLE AS ledger_amount, h.gateway,
       h.hub_txn_id, h.amount::DOUBLE AS hub_amount, h.status AS hub_status,
       g.gw_amount::DOUBLE AS gw_amount, st.settled_date, st.n AS sett_rows,
       st.g::DOUBLE AS sett_gross, st.net::DOUBLE AS sett_net, st.fee::DOUBLE AS sett_fee,
       b.bank_daily_deposit::DOUBLE AS bank_daily_deposit
FROM ids i LEFT JOIN lookup_all w ON w.order_id = i.order_id
LEFT JOIN hub h ON h.order_id = i.order_id
LEFT JOIN gw_by_key g ON g.gateway = h.gateway AND g.gw_key = h.settle_key
LEFT JOIN st ON st.gateway = h.gateway AND st.gw_key = h.settle_key
LEFT JOIN bank_daily b ON b.gateway = h.gateway AND b.bank_date = st.settled_date""")
def trace_end_to_end(c: Chain):
    return trace.trace_end_to_end(
        c.hub_refund, c.ledger, c.hub, c.gateway_txn, c.settlement, c.bank
    )


# From the rule, one fact at a time: which payments differ, the last row that either ledger
# has of the order, and the last refund. ``facts`` puts both ledgers' rows side by side.
_REFUND_TRACE = """
WITH paid AS (
  SELECT order_id, gateway, hub_txn_id, settle_key, amount, created_date, customer_id, payment_flow
  FROM hub WHERE status = 'SUCCESS'),
ledger_row AS (
  SELECT order_id, ledger_table = 'ledger_refunded' AS back, ledger_date AS on_date, ledger_amount AS amt,
         mode AS how, mobile AS phone, plan AS kind, payment_status AS pay_st, refund_status AS ref_st,
         ledger_status AS txn_st
  FROM ledger WHERE ledger_table IN ('ledger_refunded', 'ledger_revenue')
  QUALIFY row_number() OVER (PARTITION BY order_id, ledger_table ORDER BY ledger_date DESC NULLS LAST,
    ledger_amount NULLS LAST, mode, mobile, plan, ledger_status, payment_status, refund_status) = 1),
facts AS (
  SELECT order_id, bool_or(back) AS in_back, bool_or(NOT back) AS in_revenue,
         max_by(on_date, back) AS on_date, max_by(amt, back) AS amt, max_by(how, back) AS how,
         max_by(phone, back) AS phone, max_by(kind, back) AS kind,
         max(pay_st) AS pay_st, max(ref_st) AS ref_st, max(txn_st) FILTER (back) AS txn_st
  FROM ledger_row GROUP BY 1),
refund_order AS (
  SELECT order_id, unnest(list(struct_pack(d := refund_date, id := refund_unique_id, amt := refund_amount,
             kind := refund_type, st := refund_status)
         ORDER BY refund_date DESC NULLS LAST, refund_unique_id DESC)[1:1]) AS last
  FROM hub_refund WHERE refund_status = 'SUCCESS' GROUP BY 1),
rt AS (
SELECT p.order_id,
  CASE WHEN starts_with(p.order_id, 'SRVC_') THEN 'other' ELSE split_part(p.order_id, '_', 1) || '_*' END
    AS order_pattern,
  p.gateway, p.hub_txn_id, p.amount::DOUBLE AS hub_amount, p.created_date, p.customer_id, p.payment_flow,
  g.amount::DOUBLE AS gw_amount, (p.amount - g.amount)::DOUBLE AS amount_diff, g.status AS gw_status,
  g.txn_date, g.mode AS gw_mode, g.bank_name,
  CASE WHEN in_back THEN 'ledger_refunded' WHEN in_revenue THEN 'ledger_revenue' END AS ledger_table,
  f.on_date AS ledger_date, f.amt::DOUBLE AS ledger_amount, f.how AS ledger_mode, f.phone AS ledger_mobile,
  f.pay_st AS ledger_payment_status, f.ref_st AS ledger_refund_status, f.txn_st AS ledger_txn_status,
  f.kind AS ledger_payment_type,
  CASE (coalesce(in_back, false)::INT * 2 + coalesce(in_revenue, false)::INT)
    WHEN 3 THEN 'BOTH' WHEN 2 THEN 'REFUNDED_LEDGER' WHEN 1 THEN 'REVENUE_ONLY' ELSE 'NOT_FOUND' END
    AS ledger_presence,
  r.last.st AS refund_status, r.last.amt::DOUBLE AS refund_amount, r.last.d AS refund_date,
  r.last.kind AS refund_type, r.last.id AS refund_unique_id
FROM paid p JOIN gateway_txn g ON g.gateway = p.gateway AND g.gw_key = p.settle_key AND g.amount <> p.amount
LEFT JOIN facts f USING (order_id) LEFT JOIN refund_order r USING (order_id))"""


@query("refund_trace", _REFUND_TRACE + "\nSELECT * FROM rt")
def refund_trace(c: Chain):
    return trace.refund_trace(c.hub, c.gateway_txn, c.hub_refund, c.ledger)


@query("refund_trace_profile", _REFUND_TRACE + """,
long AS (
  SELECT 'gw_status' AS dimension, gw_status AS value, * FROM rt UNION ALL
  SELECT 'ledger_presence', ledger_presence, * FROM rt UNION ALL
  SELECT 'refund_status', coalesce(refund_status, 'NONE'), * FROM rt UNION ALL
  SELECT 'order_pattern', order_pattern, * FROM rt UNION ALL
  SELECT 'ledger_refund_status', coalesce(ledger_refund_status, 'NONE'), * FROM rt UNION ALL
  SELECT 'ledger_payment_status', coalesce(ledger_payment_status, 'NONE'), * FROM rt UNION ALL
  SELECT 'ledger_txn_status', coalesce(ledger_txn_status, 'NONE'), * FROM rt)
SELECT dimension, value, COUNT(*) AS n_rows,
       SUM(hub_amount::DECIMAL(18,2))::DOUBLE AS hub_amount,
       SUM(gw_amount::DECIMAL(18,2))::DOUBLE AS gw_amount,
       coalesce(SUM(refund_amount::DECIMAL(18,2)), 0)::DOUBLE AS refund_amount
FROM long GROUP BY 1, 2""")
def refund_trace_profile(c: Chain):
    return trace.refund_trace_profile(refund_trace(c))


@query("frame_export", _REFUND_TRACE + "\nSELECT * FROM rt")
def frame_export(c: Chain):
    return _exported(c, refund_trace(c), "hub_amount DESC", "order_id")


@query("recon_base_write", """
SELECT recon_month, gateway, COUNT(*) AS n_rows, SUM(sett_net)::DOUBLE AS sett_net
FROM base GROUP BY 1, 2""")
def recon_base_write(c: Chain):
    path = shared_dir(c.spark, "recon_base")
    sinks.recon_base_write(c.base, path)
    return group(
        sinks.read_base(c.spark, path),
        ["recon_month", "gateway"],
        "count(*) AS n_rows",
        "sum(sett_net) AS sett_net",
    )


#: Rows that arrive after the first build, by relation.
_LATE = {
    "settlement": "settled_date >= '1998-06-01' AND settled_date < '1998-08-01'",
    "hub": "abs(hash(order_id)) % 400 = 0",
    "ledger": "abs(hash(order_id, ledger_table)) % 500 = 0",
    "bank": "bank_date >= '1998-06-20' AND bank_date < '1998-08-01'",
}
#: Columns of the relations that the base table and the deposits are made of, those with few values last.
_OF_BASE = {
    "hub": ["amount", "created_date", "order_id", "hub_txn_id", "settle_key", "source_month", "gateway", "status"],
    "settlement": ["sett_gross", "sett_net", "sett_fee", "settled_date", "settlement_order_id", "sett_utr",
                   "sett_txn_type", "gateway", "is_forward", "is_refund"],
}
_FOLDERS = 16
_ALIKE_BUCKETS = 4


@query("recon_base_refresh", body("recon_base"))
def recon_base_refresh(c: Chain):
    """The base written without the late rows of every layer, then brought up to date with them."""
    path = shared_dir(c.spark, "recon_base_refresh")
    c = kept(c, shared_dir(c.spark, "refresh-relations"), "hub", "settlement", "bank", columns=_OF_BASE)
    first = {n: getattr(c, n).where(f"NOT coalesce({late}, false)") for n, late in _LATE.items()}
    sinks.recon_base_write(ops.recon_base(*first.values(), filed=True), path, filed=True)
    late = refresh.Late(**{n: getattr(c, n).where(cond) for n, cond in _LATE.items()})
    base_store.refresh(c.spark, path, c.settlement, c.hub, c.ledger, c.bank, late)
    return sinks.read_base(c.spark, path)


@query("recon_base_alike", body("recon_base"))
def recon_base_alike(c: Chain):
    """The base from settlements and traced orders that are stored alike, keys of four rows split."""
    root = shared_dir(c.spark, "recon_base_alike")
    layout = copartitioned.store_alike(
        c.settlement, c.hub, c.ledger, root, _ALIKE_BUCKETS, rows_per_part=3,
        rows_per_bucket=copartitioned.ROWS_PER_BUCKET,
    )
    return copartitioned.recon_base_alike(c.spark, layout, c.bank)


@query("recon_month_compare_sums", body("recon_month_compare"))
def recon_month_compare_sums(c: Chain):
    """Two months compared from stored monthly sums."""
    path = shared_dir(c.spark, "sums")
    partials.partials_store(c.base, path)
    sums = partials.partials_load(c.spark, path)
    return partials.month_compare(sums, ("1996-01", "1996-01"), ("1996-02", "1996-02"))


@query("recon_cumulative", """
SELECT gateway, recon_month, SUM(SUM(n)) OVER w::BIGINT AS n_rows, (SUM(SUM(g)) OVER w)::DOUBLE AS sett_gross,
       (SUM(SUM(t)) OVER w)::DOUBLE AS sett_net, (SUM(SUM(f)) OVER w)::DOUBLE AS sett_fee
FROM (SELECT gateway, recon_month, 1 AS n, sett_gross AS g, sett_net AS t, sett_fee AS f FROM base
      WHERE recon_month >= '1996-01' AND recon_month <= '1997-12')
GROUP BY 1, 2 WINDOW w AS (PARTITION BY gateway ORDER BY recon_month)""")
def recon_cumulative(c: Chain):
    """Running totals of two years from stored monthly sums."""
    path = shared_dir(c.spark, "sums")
    partials.partials_store(c.base, path)
    return partials.cumulative(partials.partials_load(c.spark, path), "1996-01", "1997-12")


@query("trace_one_stored", body("trace_one"))
def trace_one_stored(c: Chain):
    """One id looked up in the stored base, through its index."""
    path, index = shared_dir(c.spark, "base"), shared_dir(c.spark, "base-index")
    c = kept(c, shared_dir(c.spark, "base-relations"), "settlement", "bank", columns=_OF_BASE)
    base = ops.recon_base(c.settlement, c.hub, c.ledger, c.bank, filed=True)
    sinks.recon_base_write(base, path, filed=True)
    base_store.add_to_index(sinks.read_base(c.spark, path), index, _FOLDERS)
    return base_store.look_up(c.spark, path, index, "sub_22", _FOLDERS).select(
        "gateway", "settlement_order_id", "settled_date", "sett_gross", "hub_order_id",
        "ledger_table", "trace_status",
    )


@query("gap_export_settlement", """
SELECT gateway, settlement_order_id, settled_date, sett_gross::DOUBLE AS sett_gross,
       sett_net::DOUBLE AS sett_net, sett_fee::DOUBLE AS sett_fee, sett_utr, sett_txn_type,
       order_id_prefix, trace_status
FROM base WHERE l2_match = 'SETT_ONLY'""")
def gap_export_settlement(c: Chain):
    return _exported(c, ops.gap_export_settlement(c.base), "gateway", "sett_gross DESC")


@query("gap_export_hub", """
SELECT gateway, settlement_order_id, settled_date, sett_gross::DOUBLE AS sett_gross,
       sett_net::DOUBLE AS sett_net, hub_order_id, hub_txn_id, hub_amount::DOUBLE AS hub_amount,
       hub_status, hub_created_date, l2_match, l1_match, order_id_prefix, trace_status
FROM base WHERE l1_match = 'HUB_ONLY'""")
def gap_export_hub(c: Chain):
    return _exported(c, ops.gap_export_hub(c.base), "gateway", "hub_amount DESC")


def _exported(c: Chain, df, *order: str):
    """Write the report as CSV and read it back with the schema it was written in."""
    path = shared_dir(c.spark, "gap_export")
    sinks.csv_export(df, path, *order)
    return c.spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(path)


# --- the monthly run -----------------------------------------------------------------
#
# The SQL scopes base rows and deposits each by its own date; Spark takes both from one Run.

_MONTH_OF = {
    "base_once": "once_month", "base": "base_month", "bank_daily": "bank_month_daily", "bank": "bank_month",
}


def _in_month(sql: str) -> str:
    """A report's SQL over the relations of the month."""
    return re.sub(
        r"\b(FROM|JOIN) (base_once|base|bank_daily|bank)\b", lambda m: f"{m[1]} {_MONTH_OF[m[2]]}", sql
    )


def _monthly(name: str, report: Callable) -> None:
    def plan(c: Chain):
        return report(c.month(MONTH))

    query(f"{name}_month", _in_month(body(name)))(plan)


_monthly("recon_row_counts", lambda r: ops.recon_row_counts(r.base))
_monthly("recon_summary", lambda r: ops.recon_summary(r.base))
_monthly("recon_scorecard", lambda r: ops.recon_scorecard(r.base))
_monthly("recon_waterfall", lambda r: ops.recon_waterfall(r.base, r.bank))
_monthly("gap_a_bank", lambda r: ops.gap_a_bank(r.base, r.bank))
_monthly("gap_b_settlement_only", lambda r: ops.gap_b_settlement_only(r.base))
_monthly("gap_c_hub_only", lambda r: ops.gap_c_hub_only(r.base))
_monthly("gap_d_amount", lambda r: ops.gap_d_amount(r.base))
