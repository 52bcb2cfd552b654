"""Queries on the hub against the gateways' transactions."""

from __future__ import annotations

from tallychain.operators import hub_gateway as ops
from tallychain.operators.trace import amount_mismatch
from tallychain.plans.registry import Chain, query

# Successful hub rows beside their gateway key, and one row per gateway key.
HS = "SELECT *, settle_key AS gw_key FROM hub WHERE status = 'SUCCESS'"


@query("scope_by_gateway", """
SELECT gateway, COUNT(DISTINCT order_id) AS hub_ids, SUM(amount)::DOUBLE AS hub_amount
FROM hub WHERE status = 'SUCCESS' GROUP BY 1""")
def scope_by_gateway(c: Chain):
    return ops.scope_by_gateway(c.hub)


@query("l2_matched", f"""
WITH hs AS ({HS}), x AS (SELECT hs.gateway, hs.order_id, hs.amount, g.gw_amount, g.gw_key AS found
  FROM hs LEFT JOIN gw_by_key g ON g.gateway = hs.gateway AND g.gw_key = hs.gw_key)
SELECT gateway, COUNT(found) AS matched_ids, SUM(amount) FILTER (found IS NOT NULL)::DOUBLE AS hub_amount,
       SUM(gw_amount)::DOUBLE AS gateway_amount, COUNT(*) AS hub_ids,
       (SUM(amount) FILTER (found IS NOT NULL) - SUM(gw_amount))::DOUBLE AS diff,
       COUNT(found)::DOUBLE * 100 / COUNT(*) AS match_pct
FROM x GROUP BY 1""")
def l2_matched(c: Chain):
    return ops.l2_matched(c.hub, c.gateway_txn)


@query("l2_hub_only", f"""
WITH hs AS ({HS})
SELECT gateway, COUNT(DISTINCT order_id) AS hub_only_ids, SUM(amount)::DOUBLE AS hub_only_amount
FROM hs WHERE NOT EXISTS (SELECT 1 FROM gateway_txn g WHERE g.gateway = hs.gateway AND g.gw_key = hs.gw_key)
GROUP BY 1""")
def l2_hub_only(c: Chain):
    return ops.l2_hub_only(c.hub, c.gateway_txn)


@query("l2_gateway_total", """
SELECT gateway, COUNT(DISTINCT gw_key) AS gateway_ids, SUM(amount)::DOUBLE AS gateway_amount
FROM gateway_txn WHERE is_success GROUP BY 1""")
def l2_gateway_total(c: Chain):
    return ops.l2_gateway_total(c.gateway_txn)


_GONLY = f"""
WITH hs AS ({HS}),
go AS (SELECT g.* FROM gateway_txn g WHERE g.is_success AND NOT EXISTS
       (SELECT 1 FROM hs WHERE hs.gateway = g.gateway AND hs.gw_key = g.gw_key))"""


@query("l2_gateway_only", _GONLY + """
SELECT gateway, COUNT(DISTINCT gw_key) AS gateway_only_ids, SUM(amount)::DOUBLE AS gateway_only_amount
FROM go GROUP BY 1""")
def l2_gateway_only(c: Chain):
    return ops.l2_gateway_only(c.hub, c.gateway_txn)


@query("l2_summary", f"""
WITH hs AS ({HS}),
gk AS (SELECT gateway, gw_key, SUM(amount) AS amt, bool_or(is_success) AS ok FROM gateway_txn GROUP BY 1, 2),
x AS (SELECT coalesce(hs.gateway, gk.gateway) AS gw, hs.order_id AS h, hs.amount AS ha, gk.gw_key AS g,
             gk.amt AS ga, coalesce(gk.ok, false) AS ok
      FROM hs FULL JOIN gk ON hs.gateway = gk.gateway AND hs.gw_key = gk.gw_key)
SELECT coalesce(gw, 'ALL') AS gateway, COUNT(h) AS hub_ids,
       COUNT(*) FILTER (h IS NOT NULL AND g IS NOT NULL) AS matched_ids,
       COUNT(*) FILTER (h IS NOT NULL AND g IS NULL) AS hub_only_ids,
       COUNT(*) FILTER (ok) AS gateway_ids, COUNT(*) FILTER (ok AND h IS NULL) AS gateway_only_ids,
       SUM(ha) FILTER (g IS NOT NULL)::DOUBLE AS hub_amount,
       SUM(ga) FILTER (h IS NOT NULL)::DOUBLE AS gateway_amount,
       COUNT(*) FILTER (h IS NOT NULL AND g IS NOT NULL)::DOUBLE * 100 / COUNT(h) AS match_pct
FROM x GROUP BY ROLLUP (gw)""")
def l2_summary(c: Chain):
    return ops.l2_summary(c.hub, c.gateway_txn)


_MM = """
WITH mm AS (
  SELECT h.*, g.amount AS gw_amount, g.status AS gw_status, g.txn_date, g.mode AS gw_mode, g.bank_name,
         g.error_description, g.discount, g.subvention
  FROM hub h JOIN gateway_txn g ON g.gateway = h.gateway AND g.gw_key = h.settle_key
  WHERE h.status = 'SUCCESS' AND h.amount <> g.amount)"""


@query("l2_amount_mismatch", _MM + """
SELECT order_id, hub_txn_id, gateway, settle_key AS gw_key,
       CASE WHEN starts_with(order_id, 'SRVC_') THEN 'other' ELSE split_part(order_id, '_', 1) || '_*' END
         AS order_pattern, amount::DOUBLE AS hub_amount, created_date, customer_id, payment_flow,
       gw_amount::DOUBLE AS gw_amount, (amount - gw_amount)::DOUBLE AS amount_diff, gw_status, txn_date,
       gw_mode, bank_name, error_description, discount::DOUBLE AS discount, subvention::DOUBLE AS subvention
FROM mm""")
def l2_amount_mismatch(c: Chain):
    return amount_mismatch(c.hub, c.gateway_txn)


_DIMS = {
    "split": "CASE WHEN gw_amount = 0 THEN 'zero' ELSE 'partial' END",
    "gw_status": "gw_status",
    "mode": "gw_mode",
    "error": "error_description",
    "flow": "payment_flow",
    "pattern": "split_part(order_id, '_', 1) || '_*'",
    "has_subvention": "CASE WHEN subvention > 0 THEN 'true' ELSE 'false' END",
    "has_discount": "CASE WHEN coalesce(discount, 0) <> 0 THEN 'true' ELSE 'false' END",
}


@query("l2_mismatch_profile", _MM + " UNION ALL ".join(f"""
SELECT '{d}' AS dimension, {e} AS value, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS hub_amount,
       SUM(gw_amount)::DOUBLE AS gw_amount, coalesce(SUM(subvention), 0)::DOUBLE AS subvention,
       coalesce(SUM(discount), 0)::DOUBLE AS discount
FROM mm GROUP BY 2""" for d, e in _DIMS.items()))
def l2_mismatch_profile(c: Chain):
    return ops.l2_mismatch_profile(c.hub, c.gateway_txn)


@query("l2_gateway_only_presence", _GONLY + """,
k AS (SELECT gateway, gw_key, SUM(amount) AS amount FROM go GROUP BY 1, 2),
p AS (SELECT gateway, settle_key, MAX(status) AS st, MAX(source_month) AS m FROM hub GROUP BY 1, 2)
SELECT k.gateway, coalesce(p.st, 'NOT_IN_HUB') AS found, COUNT(*) AS ids, SUM(k.amount)::DOUBLE AS amount,
       MIN(p.m) AS first_month, MAX(p.m) AS last_month
FROM k LEFT JOIN p ON p.gateway = k.gateway AND p.settle_key = k.gw_key GROUP BY 1, 2""")
def l2_gateway_only_presence(c: Chain):
    return ops.l2_gateway_only_presence(c.hub, c.gateway_txn)


@query("l2_refund_match", """
WITH hr AS (SELECT gateway, CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS k,
                   refund_unique_id, refund_amount
            FROM hub_refund WHERE refund_status = 'SUCCESS' AND order_id IN (SELECT order_id FROM hub)),
a AS (SELECT gateway, COUNT(*) AS n, SUM(refund_amount) AS amt FROM hr GROUP BY 1),
b AS (SELECT gateway, COUNT(*) AS n, SUM(amount) AS amt FROM gateway_refund GROUP BY 1),
m AS (SELECT gateway, COUNT(DISTINCT refund_unique_id) AS n, SUM(refund_amount) AS amt FROM hr
      WHERE EXISTS (SELECT 1 FROM gateway_refund g WHERE g.gateway = hr.gateway AND g.refund_key = hr.k)
      GROUP BY 1)
SELECT a.gateway, a.n AS hub_refunds, a.amt::DOUBLE AS hub_refund_amount, b.n AS gateway_refunds,
       b.amt::DOUBLE AS gateway_refund_amount, m.n AS matched_refunds, m.amt::DOUBLE AS matched_amount
FROM a JOIN b ON a.gateway = b.gateway JOIN m ON m.gateway = a.gateway""")
def l2_refund_match(c: Chain):
    return ops.l2_refund_match(c.hub, c.hub_refund, c.gateway_refund)


@query("refund_by_gateway", """
SELECT h.gateway, COUNT(*) AS refunds, SUM(refund_amount)::DOUBLE AS refund_amount,
       COUNT(*) FILTER (refund_status = 'SUCCESS') AS success_refunds,
       SUM(refund_amount) FILTER (refund_status = 'SUCCESS')::DOUBLE AS success_amount,
       MIN(refund_date) AS first_date, MAX(refund_date) AS last_date
FROM hub_refund r JOIN hub h ON h.order_id = r.order_id GROUP BY 1""")
def refund_by_gateway(c: Chain):
    return ops.refund_by_gateway(c.hub, c.hub_refund)
