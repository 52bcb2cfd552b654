"""Queries on gateway fees."""

from __future__ import annotations

from tallychain.operators import fees as ops
from tallychain.plans.registry import Chain, query

_IN = """
WITH sc AS (SELECT s.* FROM settlement s WHERE s.is_forward AND EXISTS
            (SELECT 1 FROM hub h WHERE h.status = 'SUCCESS' AND h.gateway = s.gateway
             AND h.settle_key = s.settlement_order_id))"""
_FEE_COLS = """COUNT(*) AS txns, SUM(sett_gross)::DOUBLE AS gross, SUM(sett_fee - sett_tax)::DOUBLE AS fee,
       SUM(sett_tax)::DOUBLE AS tax, SUM(sett_fee)::DOUBLE AS fee_incl_tax, SUM(sett_net)::DOUBLE AS net"""


@query("mdr_by_gateway", """
SELECT coalesce(s.gateway, 'ALL') AS gateway, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross,
       SUM(sett_fee)::DOUBLE AS fees, SUM(sett_fee)::DOUBLE * 100 / SUM(sett_gross)::DOUBLE AS mdr_pct
FROM settlement s WHERE is_forward GROUP BY ROLLUP (s.gateway)""")
def mdr_by_gateway(c: Chain):
    return ops.mdr_by_gateway(c.settlement)


@query("fee_summary", _IN + """
SELECT gateway, COUNT(DISTINCT settlement_order_id) AS hub_txns, COUNT(*) AS sett_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_fee - sett_tax)::DOUBLE AS fee,
       SUM(sett_tax)::DOUBLE AS tax, SUM(sett_fee)::DOUBLE AS fee_incl_tax, SUM(sett_net)::DOUBLE AS net,
       COUNT(*) FILTER (sett_fee - sett_tax > 0) AS rows_with_fee,
       COUNT(*) FILTER (sett_fee - sett_tax = 0) AS rows_zero_fee,
       MIN(sett_fee - sett_tax)::DOUBLE AS min_fee, MAX(sett_fee - sett_tax)::DOUBLE AS max_fee,
       SUM(sett_fee - sett_tax)::DOUBLE / COUNT(*) AS avg_fee,
       SUM(sett_fee - sett_tax)::DOUBLE * 100 / SUM(sett_gross)::DOUBLE AS mdr_pct
FROM sc GROUP BY 1""")
def fee_summary(c: Chain):
    return ops.fee_summary(c.settlement, c.hub)


@query("fee_by_method", _IN + f"""
SELECT gateway, method, network, card_type, {_FEE_COLS},
       round(SUM(sett_fee - sett_tax)::DOUBLE * 100 / SUM(sett_gross)::DOUBLE, 4) AS mdr_pct
FROM sc GROUP BY 1, 2, 3, 4""")
def fee_by_method(c: Chain):
    return ops.fee_by_method(c.settlement, c.hub)


@query("fee_by_batch", _IN + f"""
SELECT gateway, sett_utr, settled_date, {_FEE_COLS} FROM sc GROUP BY 1, 2, 3""")
def fee_by_batch(c: Chain):
    return ops.fee_by_batch(c.settlement, c.hub)


@query("fee_sign_check", """
SELECT gateway, sett_txn_type, payment_type, txn_status, COUNT(*) AS n_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net,
       SUM(signed_fee)::DOUBLE AS signed_fee, (SUM(sett_net) - SUM(sett_gross))::DOUBLE AS net_minus_gross
FROM settlement GROUP BY 1, 2, 3, 4""")
def fee_sign_check(c: Chain):
    return ops.fee_sign_check(c.settlement)


@query("fee_vs_nofee", _IN + """
SELECT gateway, CASE WHEN signed_fee < 0 THEN 'charged' WHEN signed_fee = 0 THEN 'none'
                ELSE 'credited' END AS fee_class, method, COUNT(*) AS n_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net, SUM(signed_fee)::DOUBLE AS signed_fee
FROM sc GROUP BY 1, 2, 3""")
def fee_vs_nofee(c: Chain):
    return ops.fee_vs_nofee(c.settlement, c.hub)


@query("fee_mode_matrix", _IN + """
SELECT gateway, method, COUNT(*) FILTER (signed_fee < 0) AS has_fee,
       COUNT(*) FILTER (signed_fee = 0) AS no_fee, COUNT(*) AS n_rows,
       SUM(sc.signed_fee)::DOUBLE AS signed_fee
FROM sc GROUP BY 1, 2""")
def fee_mode_matrix(c: Chain):
    return ops.fee_mode_matrix(c.settlement, c.hub)


_ROWS = """
SELECT s.gateway, h.order_id, h.amount::DOUBLE AS hub_amount, h.created_date, sett_gross::DOUBLE AS sett_gross,
       sett_net::DOUBLE AS sett_net, sett_fee::DOUBLE AS sett_fee, sett_tax::DOUBLE AS sett_tax, method,
       network, card_type, payment_type, settled_date, sett_utr
FROM settlement s JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
WHERE h.status = 'SUCCESS' AND s.is_forward AND s.signed_fee < 0"""


@query("fee_rows", _ROWS)
def fee_rows(c: Chain):
    return ops.fee_rows(c.settlement, c.hub)


@query("head_n", _ROWS + """
ORDER BY s.sett_fee DESC, s.sett_gross DESC, h.order_id, settled_date, method LIMIT 50""")
def head_n(c: Chain):
    return ops.fee_rows(c.settlement, c.hub, k=50)


@query("describe_fee", """
SELECT gateway, COUNT(*) AS n_rows, round(SUM(sett_fee)::DOUBLE / COUNT(*), 4) AS mean_fee,
       round(stddev_samp(sett_fee::DOUBLE), 4) AS std_fee, MIN(sett_fee)::DOUBLE AS min_fee,
       round(quantile_cont(sett_fee::DOUBLE, 0.25), 4) AS p25,
       round(quantile_cont(sett_fee::DOUBLE, 0.5), 4) AS p50,
       round(quantile_cont(sett_fee::DOUBLE, 0.75), 4) AS p75, MAX(sett_fee)::DOUBLE AS max_fee
FROM settlement WHERE is_forward GROUP BY 1""")
def describe_fee(c: Chain):
    return ops.describe_fee(c.settlement)


_TRACE = f"""
WITH fr AS ({_ROWS}),
kl AS (SELECT order_id, ledger_table, ledger_date, ledger_amount::DOUBLE AS ledger_amount,
              mode AS ledger_mode, mobile AS ledger_mobile, plan AS ledger_plan
       FROM ledger WHERE ledger_table IN ('ledger_revenue', 'ledger_net_income', 'ledger_booking')),
ft AS (SELECT fr.*, kl.* EXCLUDE (order_id),
         CASE WHEN starts_with(fr.order_id, 'SRVC_') THEN 'other'
              ELSE split_part(fr.order_id, '_', 1) || '_*' END AS order_pattern
       FROM fr LEFT JOIN kl ON kl.order_id = fr.order_id)"""


@query("fee_trace_to_ledger", _TRACE + "\nSELECT * FROM ft")
def fee_trace_to_ledger(c: Chain):
    return ops.fee_trace_to_ledger(c.settlement, c.hub, c.ledger)


_DIMS = {
    "pattern": "order_pattern",
    "ledger_table": "coalesce(ledger_table, 'NONE')",
    "method": "method",
    "ledger_mode": "coalesce(ledger_mode, 'NONE')",
    "plan": "coalesce(ledger_plan, 'NONE')",
}


@query("fee_by_dimension", _TRACE + " UNION ALL ".join(f"""
SELECT '{d}' AS dimension, {e} AS value, COUNT(*) AS n_rows,
       SUM(sett_gross::DECIMAL(18,2))::DOUBLE AS gross, SUM(sett_fee::DECIMAL(18,2))::DOUBLE AS fees
FROM ft GROUP BY 2""" for d, e in _DIMS.items()))
def fee_by_dimension(c: Chain):
    return ops.fee_by_dimension(fee_trace_to_ledger(c))
