"""Queries on gateway transactions against settlements."""

from __future__ import annotations

from datetime import date

from tallychain.config import Period
from tallychain.operators import partials
from tallychain.operators import settlements as ops
from tallychain.plans.registry import Chain, body, query
from tallychain.session import shared_dir

YEAR = Period(date(1996, 1, 1), date(1997, 1, 1))
IN_YEAR = "year({0}) = 1996"

_CHAIN = """
WITH ch AS (
  SELECT h.gateway, h.settle_key AS gw_key, h.order_id, h.amount, g.gw_amount, s.sett_rows, s.gross,
         s.net, s.fee, s.tax, s.first_date, s.last_date
  FROM hub h JOIN gw_by_key g ON g.gateway = h.gateway AND g.gw_key = h.settle_key
  LEFT JOIN sett_by_key s ON s.gateway = h.gateway AND s.gw_key = h.settle_key
  WHERE h.status = 'SUCCESS')"""


@query("l3_settled", _CHAIN + """,
b AS (SELECT s.gateway, COUNT(DISTINCT s.sett_utr) AS batches
      FROM settlement s JOIN ch ON ch.gateway = s.gateway AND ch.gw_key = s.settlement_order_id
      WHERE s.is_forward GROUP BY 1)
SELECT ch.gateway, COUNT(*) AS hub_txns, SUM(amount)::DOUBLE AS hub_amount,
       SUM(gw_amount)::DOUBLE AS gateway_amount, COUNT(sett_rows) AS settled_txns,
       SUM(gross)::DOUBLE AS gross, SUM(net)::DOUBLE AS net, SUM(fee - tax)::DOUBLE AS commission,
       SUM(tax)::DOUBLE AS tax, MIN(first_date) AS first_date, MAX(last_date) AS last_date,
       MAX(b.batches) AS batches
FROM ch LEFT JOIN b ON b.gateway = ch.gateway GROUP BY 1""")
def l3_settled(c: Chain):
    return ops.l3_settled(c.hub, c.gateway_txn, c.settlement)


@query("l3_unsettled", """
SELECT gateway, COUNT(*) AS unsettled, SUM(amount)::DOUBLE AS amount FROM hub h
WHERE status = 'SUCCESS'
  AND EXISTS (SELECT 1 FROM gateway_txn g WHERE g.gateway = h.gateway AND g.gw_key = h.settle_key)
  AND NOT EXISTS (SELECT 1 FROM settlement s WHERE s.gateway = h.gateway
                  AND s.settlement_order_id = h.settle_key AND s.is_forward) GROUP BY 1""")
def l3_unsettled(c: Chain):
    return ops.l3_unsettled(c.hub, c.gateway_txn, c.settlement)


@query("l3_summary", _CHAIN + """
SELECT coalesce(ch.gateway, 'ALL') AS gateway, COUNT(*) AS hub_txns, COUNT(sett_rows) AS settled_txns,
       SUM(amount)::DOUBLE AS hub_amount, SUM(gross)::DOUBLE AS gross, SUM(net)::DOUBLE AS net,
       SUM(fee)::DOUBLE AS fees, COUNT(sett_rows)::DOUBLE * 100 / COUNT(*) AS settled_pct
FROM ch GROUP BY ROLLUP (ch.gateway)""")
def l3_summary(c: Chain):
    return ops.l3_summary(c.hub, c.gateway_txn, c.settlement)


_REASON = f"""
WITH sc AS (SELECT h.gateway, h.settle_key, h.amount FROM hub h WHERE h.status = 'SUCCESS' AND EXISTS
            (SELECT 1 FROM gateway_txn g WHERE g.gateway = h.gateway AND g.gw_key = h.settle_key)),
un AS (SELECT sc.* FROM sc WHERE NOT EXISTS (SELECT 1 FROM settlement s WHERE s.gateway = sc.gateway
       AND s.settlement_order_id = sc.settle_key AND s.is_forward AND {IN_YEAR.format('s.settled_date')})),
r AS (SELECT un.gateway, un.amount,
   CASE WHEN NOT EXISTS (SELECT 1 FROM settlement s WHERE s.gateway = un.gateway
                         AND s.settlement_order_id = un.settle_key) THEN 'never settled'
        WHEN EXISTS (SELECT 1 FROM settlement s WHERE s.gateway = un.gateway
                     AND s.settlement_order_id = un.settle_key AND s.is_forward) THEN 'settled in another period'
        ELSE 'refund rows only' END AS reason FROM un)
SELECT gateway, reason, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount FROM r GROUP BY 1, 2"""


@query("l3_unsettled_reason", _REASON)
def l3_unsettled_reason(c: Chain):
    return ops.l3_unsettled_reason(c.hub, c.gateway_txn, c.settlement, YEAR)


@query("join_scoped_vs_unscoped", _REASON)
def join_scoped_vs_unscoped(c: Chain):
    return ops.l3_unsettled_reason(c.hub, c.gateway_txn, c.settlement, YEAR)


_BATCH = """
WITH bt AS (SELECT s.gateway, s.sett_utr, s.settled_date, COUNT(DISTINCT s.settlement_order_id) AS txns,
                   COUNT(*) AS n, SUM(s.sett_gross) AS g, SUM(s.sett_net) AS net, SUM(s.sett_fee) AS f
            FROM settlement s WHERE s.is_forward AND EXISTS (SELECT 1 FROM hub h WHERE h.status = 'SUCCESS'
              AND h.gateway = s.gateway AND h.settle_key = s.settlement_order_id) GROUP BY 1, 2, 3)
SELECT gateway, sett_utr, settled_date, txns, n AS sett_rows, g::DOUBLE AS gross, net::DOUBLE AS net,
       f::DOUBLE AS fees FROM bt"""


@query("l3_batches", _BATCH)
def l3_batches(c: Chain):
    return ops.l3_batches(c.hub, c.settlement)


@query("top_k", _BATCH + " WHERE gateway = 'GW_A' ORDER BY g DESC, sett_utr, settled_date LIMIT 20")
def top_k(c: Chain):
    return ops.top_batches(c.hub, c.settlement, "GW_A")


@query("settlement_link_count", """
SELECT gateway, COUNT(*) AS linked_rows, COUNT(DISTINCT settlement_order_id) AS linked_keys
FROM settlement s WHERE EXISTS (SELECT 1 FROM gateway_txn g WHERE g.gateway = s.gateway
  AND g.gw_key = s.settlement_order_id) GROUP BY 1""")
def settlement_link_count(c: Chain):
    return ops.settlement_link_count(c.settlement, c.gateway_txn)


@query("embedded_settled_breakdown", """
SELECT status, CASE WHEN gw_key IN (SELECT settlement_order_id FROM settlement WHERE gateway = 'GW_D')
               THEN 1 ELSE 0 END AS settled, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount
FROM gateway_txn WHERE gateway = 'GW_D' GROUP BY 1, 2""")
def embedded_settled_breakdown(c: Chain):
    return ops.embedded_settled_breakdown(c.gateway_txn, c.settlement)


# A settlement row, through its gateway transaction, back to the hub.
_BACK = """
WITH back AS (
  SELECT s.*, CASE WHEN s.gateway = 'GW_D' THEN s.settlement_order_id ELSE g.gw_key END AS gid
  FROM settlement s LEFT JOIN (SELECT DISTINCT gateway, gw_key FROM gateway_txn) g
    ON g.gateway = s.gateway AND g.gw_key = s.settlement_order_id),
bh AS (SELECT b.*, h.order_id, h.status AS hstatus, h.source_month FROM back b
       LEFT JOIN hub h ON h.gateway = b.gateway AND h.settle_key = b.gid)"""


@query("settlement_universe", _BACK + """,
cat AS (SELECT gateway, CASE WHEN order_id IS NULL AND gid IS NULL THEN '5 orphan'
     WHEN order_id IS NULL THEN '4 gateway only'
     WHEN hstatus = 'SUCCESS' AND source_month = '1996-01' THEN '1 period success'
     WHEN hstatus = 'SUCCESS' THEN '2 other month success' ELSE '3 not success' END AS category,
   sett_gross, sett_net, sett_fee FROM bh)
SELECT gateway, category, COUNT(*) AS sett_rows, SUM(sett_gross)::DOUBLE AS gross,
       SUM(sett_net)::DOUBLE AS net, SUM(sett_fee)::DOUBLE AS fees,
       COUNT(*)::DOUBLE * 100 / SUM(COUNT(*)) OVER (PARTITION BY gateway) AS share_pct
FROM cat GROUP BY 1, 2""")
def settlement_universe(c: Chain):
    return ops.settlement_universe(c.settlement, c.gateway_txn, c.hub, "1996-01")


@query("settlement_type_mix", """
SELECT gateway, coalesce(sett_txn_type, 'NULL') AS txn_type, payment_type, COUNT(*) AS n_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net, SUM(sett_fee)::DOUBLE AS fees
FROM settlement GROUP BY 1, 2, 3""")
def settlement_type_mix(c: Chain):
    return ops.settlement_type_mix(c.settlement)


@query("amount_bridge", _CHAIN + """
SELECT gateway, COUNT(*) AS hub_txns, SUM(amount)::DOUBLE AS hub_amount,
       SUM(gw_amount)::DOUBLE AS gateway_amount, SUM(gross)::DOUBLE AS gross, SUM(net)::DOUBLE AS net,
       SUM(fee)::DOUBLE AS fees, (SUM(amount) - SUM(gw_amount))::DOUBLE AS hub_minus_gateway,
       (SUM(gw_amount) - SUM(gross))::DOUBLE AS gateway_minus_gross,
       (SUM(gross) - SUM(net))::DOUBLE AS gross_minus_net,
       SUM(fee)::DOUBLE * 100 / SUM(gross)::DOUBLE AS mdr_pct
FROM ch WHERE sett_rows IS NOT NULL GROUP BY 1""")
def amount_bridge(c: Chain):
    return ops.amount_bridge(c.hub, c.gateway_txn, c.settlement)


@query("bridge_summary", _CHAIN + """,
rd AS (SELECT h.gateway, COUNT(*) AS rn, SUM(r.refund_amount) AS ramt
       FROM hub_refund r JOIN hub h ON h.order_id = r.order_id
       WHERE r.refund_status = 'SUCCESS' GROUP BY 1),
t AS (SELECT ch.gateway AS gw, COUNT(*) AS n, SUM(amount) AS ha, SUM(gw_amount) AS ga, SUM(gross) AS g,
             SUM(net) AS net, SUM(fee) AS f FROM ch WHERE sett_rows IS NOT NULL GROUP BY 1),
u AS (SELECT coalesce(t.gw, 'ALL') AS gateway, SUM(n)::BIGINT AS n, SUM(ha) AS ha, SUM(ga) AS ga,
             SUM(g) AS g, SUM(net) AS net, SUM(f) AS f, SUM(coalesce(rn, 0))::BIGINT AS rn,
             SUM(coalesce(ramt, 0)) AS ramt
      FROM t LEFT JOIN rd ON rd.gateway = t.gw GROUP BY ROLLUP (t.gw))
SELECT gateway, n AS hub_txns, ha::DOUBLE AS hub_amount, ga::DOUBLE AS gateway_amount, g::DOUBLE AS gross,
       net::DOUBLE AS net, f::DOUBLE AS fees, rn AS refund_txns, ramt::DOUBLE AS refund_amount,
       (net - ramt)::DOUBLE AS adjusted_net, (f + ramt)::DOUBLE AS total_cost,
       f::DOUBLE * 100 / g::DOUBLE AS mdr_pct, g::DOUBLE * 100 / ha::DOUBLE AS settled_pct FROM u""")
def bridge_summary(c: Chain):
    return ops.bridge_summary(c.hub, c.gateway_txn, c.settlement, c.hub_refund)


@query("period_universe", _BACK + """
SELECT gateway, coalesce(source_month, 'NOT IN HUB') AS hub_month, coalesce(hstatus, 'N/A') AS hub_status,
       COUNT(DISTINCT settlement_order_id) AS settled_ids, COUNT(*) AS sett_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net, SUM(sett_fee)::DOUBLE AS fees
FROM bh WHERE year(settled_date) = 1996 GROUP BY 1, 2, 3""")
def period_universe(c: Chain):
    return ops.period_universe(c.settlement, c.gateway_txn, c.hub, YEAR)


@query("source_month_waterfall", """
SELECT s.gateway, strftime(s.settled_date, '%Y-%m') AS settled_month,
       coalesce(h.source_month, 'NOT IN HUB') AS created_month, COUNT(*) AS sett_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net
FROM settlement s LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
WHERE s.is_forward GROUP BY 1, 2, 3""")
def source_month_waterfall(c: Chain):
    return ops.source_month_waterfall(c.settlement, c.hub)


@query("source_month_waterfall_sums", body("source_month_waterfall"))
def source_month_waterfall_sums(c: Chain):
    """The waterfall from stored monthly sums of the base."""
    path = shared_dir(c.spark, "sums")
    partials.partials_store(c.base, path)
    return partials.source_month_waterfall(partials.partials_load(c.spark, path))


@query("period_summary", """
SELECT coalesce(s.gateway, 'ALL') AS gateway, COUNT(*) AS sett_rows, COUNT(h.order_id) AS matched_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net, SUM(sett_fee)::DOUBLE AS fees,
       COUNT(h.order_id)::DOUBLE * 100 / COUNT(*) AS matched_pct,
       SUM(sett_fee)::DOUBLE * 100 / SUM(sett_gross)::DOUBLE AS mdr_pct
FROM settlement s LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
WHERE s.is_forward AND year(settled_date) = 1996 GROUP BY ROLLUP (s.gateway)""")
def period_summary(c: Chain):
    return ops.period_summary(c.settlement, c.hub, YEAR)


@query("refund_rows_by_origin", """
SELECT s.gateway, coalesce(h.source_month, 'NOT IN HUB') AS origin_month, COUNT(*) AS refund_rows,
       SUM(sett_gross)::DOUBLE AS refund_amount
FROM settlement s LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
WHERE s.is_refund GROUP BY 1, 2""")
def refund_rows_by_origin(c: Chain):
    return ops.refund_rows_by_origin(c.settlement, c.hub)


@query("refunds_settled", """
SELECT gateway, COUNT(DISTINCT refund_key) AS refund_ids, COUNT(*) AS refund_rows,
       SUM(amount)::DOUBLE AS amount, SUM(settled_amount)::DOUBLE AS settled_amount,
       MIN(settled_date) AS first_date, MAX(settled_date) AS last_date
FROM gateway_refund WHERE year(settled_date) = 1996 GROUP BY 1""")
def refunds_settled(c: Chain):
    return ops.refunds_settled(c.gateway_refund, YEAR)


@query("hub_refunds_by_refund_month", """
SELECT h.gateway, strftime(r.refund_date, '%Y-%m') AS refund_month, COUNT(*) AS refunds,
       SUM(refund_amount)::DOUBLE AS refund_amount,
       COUNT(*) FILTER (refund_status = 'SUCCESS') AS success_refunds,
       coalesce(SUM(refund_amount) FILTER (refund_status = 'SUCCESS'), 0)::DOUBLE AS success_amount
FROM hub_refund r JOIN hub h ON h.order_id = r.order_id GROUP BY 1, 2""")
def hub_refunds_by_refund_month(c: Chain):
    return ops.hub_refunds_by_refund_month(c.hub, c.hub_refund)


@query("refund_rows_total", """
SELECT gateway, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS refund_amount,
       SUM(sett_net)::DOUBLE AS refund_net FROM settlement WHERE is_refund GROUP BY 1""")
def refund_rows_total(c: Chain):
    return ops.refund_rows_total(c.settlement)


@query("refund_settlement_detail", """
SELECT gateway, payment_type, coalesce(txn_status, 'NULL') AS status, COUNT(*) AS n_rows,
       SUM(sett_gross)::DOUBLE AS txn_amount, SUM(sett_net)::DOUBLE AS net_amount
FROM settlement WHERE payment_type = 'REFUND' GROUP BY 1, 2, 3""")
def refund_settlement_detail(c: Chain):
    return ops.refund_settlement_detail(c.settlement)


_TRACE3 = """
WITH s AS (SELECT gateway, settlement_order_id AS k, SUM(sett_gross) AS amt FROM settlement
           WHERE is_refund GROUP BY 1, 2),
g AS (SELECT gateway, refund_key AS k, SUM(amount) AS amt FROM gateway_refund GROUP BY 1, 2),
h AS (SELECT gateway, CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS k,
             SUM(refund_amount) AS amt FROM hub_refund GROUP BY 1, 2)
SELECT s.gateway, COUNT(*) AS sett_refund_ids, COUNT(g.k) AS in_gateway_refunds,
       COUNT(h.k) AS in_hub_refunds, SUM(s.amt)::DOUBLE AS sett_refund_amount,
       coalesce(SUM(g.amt), 0)::DOUBLE AS gateway_refund_amount,
       coalesce(SUM(h.amt), 0)::DOUBLE AS hub_refund_amount
FROM s LEFT JOIN g ON g.gateway = s.gateway AND g.k = s.k
LEFT JOIN h ON h.gateway = s.gateway AND h.k = s.k GROUP BY 1"""


@query("refund_trace_3way", _TRACE3)
def refund_trace_3way(c: Chain):
    return ops.refund_trace_3way(c.settlement, c.gateway_refund, c.hub_refund)


@query("join_refund_3way", _TRACE3)
def join_refund_3way(c: Chain):
    return ops.refund_trace_3way(c.settlement, c.gateway_refund, c.hub_refund)


@query("refund_gap_by_status", """
WITH sk AS (SELECT gateway, settlement_order_id AS k, SUM(sett_gross) AS g FROM settlement GROUP BY 1, 2)
SELECT h.gateway, t.status AS gw_status, COUNT(*) AS txns, SUM(h.amount)::DOUBLE AS hub_amount,
       SUM(t.amount)::DOUBLE AS gateway_amount, SUM(h.amount - t.amount)::DOUBLE AS gap,
       COUNT(sk.k) AS in_settlements, coalesce(SUM(sk.g), 0)::DOUBLE AS sett_gross
FROM hub h JOIN gateway_txn t ON t.gateway = h.gateway AND t.gw_key = h.settle_key
LEFT JOIN sk ON sk.gateway = h.gateway AND sk.k = h.settle_key
WHERE h.status = 'SUCCESS' AND h.amount <> t.amount GROUP BY 1, 2""")
def refund_gap_by_status(c: Chain):
    return ops.refund_gap_by_status(c.hub, c.gateway_txn, c.settlement)


@query("embedded_refund_trace", """
SELECT sett_txn_type, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross,
       SUM(sett_fee - sett_tax)::DOUBLE AS fee, SUM(sett_tax)::DOUBLE AS tax,
       COUNT(*) FILTER (settlement_order_id IN (SELECT order_id FROM hub WHERE gateway = 'GW_D')) AS matched_hub,
       COUNT(*) FILTER (settlement_order_id IN (SELECT order_id FROM hub_refund WHERE gateway = 'GW_D'))
         AS matched_hub_refund
FROM settlement WHERE is_refund AND gateway = 'GW_D' GROUP BY 1""")
def embedded_refund_trace(c: Chain):
    return ops.embedded_refund_trace(c.settlement, c.hub, c.hub_refund)


@query("refund_deduction", """
SELECT s.gateway, COUNT(*) AS refund_rows, SUM(s.sett_gross)::DOUBLE AS refund_gross,
       SUM(s.sett_net)::DOUBLE AS refund_net
FROM settlement s JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
WHERE s.is_refund AND year(h.created_date) = 1996 GROUP BY 1""")
def refund_deduction(c: Chain):
    return ops.refund_deduction(c.settlement, c.hub, YEAR)


@query("fanout_ratio", """
SELECT gateway, SUM(n)::BIGINT AS sett_rows, COUNT(*) AS keys, MAX(n) AS largest,
       SUM(n)::DOUBLE / COUNT(*) AS ratio
FROM (SELECT gateway, settlement_order_id, COUNT(*) AS n FROM settlement GROUP BY 1, 2) GROUP BY 1""")
def fanout_ratio(c: Chain):
    return ops.fanout_ratio(c.settlement)
