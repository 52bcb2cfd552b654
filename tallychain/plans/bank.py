"""Queries on settlements against bank deposits."""

from __future__ import annotations

from tallychain.config import Period
from tallychain.operators import bank as ops
from tallychain.operators.base import bank_daily as daily
from tallychain.plans.registry import Chain, query

MONTH = Period.month("1996-01")


@query("bank_daily", """
SELECT gateway, bank_date, bank_daily_deposit::DOUBLE AS bank_daily_deposit, deposits FROM bank_daily""")
def bank_daily(c: Chain):
    return daily(c.bank)


@query("bank_summary", """
SELECT coalesce(b.bank_label, 'ALL') AS bank_label, COUNT(*) AS deposits, MIN(bank_date) AS first_date,
       MAX(bank_date) AS last_date, SUM(deposit)::DOUBLE AS bank_total
FROM bank b GROUP BY ROLLUP (b.bank_label)""")
def bank_summary(c: Chain):
    return ops.bank_summary(c.bank)


@query("bank_by_month_label", """
SELECT month_text, MIN(bank_date) AS first_date, COUNT(*) AS deposits, SUM(deposit)::DOUBLE AS bank_total
FROM bank GROUP BY 1""")
def bank_by_month_label(c: Chain):
    return ops.bank_by_month_label(c.bank)


@query("bank_rows", """
SELECT bank_date, bank_label, deposit::DOUBLE AS deposit, remarks FROM bank
WHERE year(bank_date) = 1996 AND month(bank_date) = 1""")
def bank_rows(c: Chain):
    return ops.bank_rows(c.bank, MONTH)


@query("settlement_summary", """
WITH s AS (SELECT gateway, COUNT(*) AS n_rows, MIN(settled_date) AS first_date,
                  MAX(settled_date) AS last_date, SUM(sett_gross) AS gross, SUM(sett_net) AS net,
                  SUM(sett_fee) AS fees
           FROM settlement
           WHERE gateway = 'GW_A' OR (gateway = 'GW_C' AND NOT is_refund)
              OR (gateway IN ('GW_B', 'GW_D') AND is_forward) GROUP BY 1),
d AS (SELECT gateway, SUM(deposit) AS dep FROM bank GROUP BY 1
      UNION ALL SELECT 'ALL', SUM(deposit) FROM bank),
sa AS (SELECT * FROM s UNION ALL
       SELECT 'ALL', SUM(n_rows)::BIGINT, MIN(first_date), MAX(last_date), SUM(gross), SUM(net), SUM(fees) FROM s)
SELECT sa.gateway, n_rows, first_date, last_date, gross::DOUBLE AS gross, net::DOUBLE AS net,
       fees::DOUBLE AS fees, dep::DOUBLE AS bank_total, (dep - net)::DOUBLE AS gap,
       (dep - net)::DOUBLE * 100 / dep::DOUBLE AS gap_pct,
       (dep - net)::DOUBLE * 100 / net::DOUBLE AS gap_pct_of_net
FROM sa JOIN d ON d.gateway = sa.gateway""")
def settlement_summary(c: Chain):
    return ops.settlement_summary(c.settlement, c.bank)


_MONTHLY = """
WITH sm AS (SELECT gateway AS g, date_trunc('month', settled_date)::DATE AS m, COUNT(*) AS txns,
                   SUM(sett_net) AS net FROM settlement WHERE gateway = 'GW_A' OR is_forward GROUP BY 1, 2),
bm AS (SELECT gateway AS g, date_trunc('month', bank_date)::DATE AS m, COUNT(*) AS deps,
              SUM(deposit) AS dep FROM bank GROUP BY 1, 2),
mm AS (SELECT coalesce(sm.g, bm.g) AS gateway, coalesce(sm.m, bm.m) AS month,
              coalesce(txns, 0) AS txns, coalesce(net, 0) AS net, coalesce(deps, 0) AS deps,
              coalesce(dep, 0) AS dep, txns IS NOT NULL AND deps IS NOT NULL AS reconcilable
       FROM sm FULL JOIN bm ON sm.g = bm.g AND sm.m = bm.m)"""


@query("bank_monthly", _MONTHLY + """,
mt AS (SELECT gateway, month, txns, net, deps, dep, reconcilable FROM mm
       UNION ALL SELECT gateway, NULL, SUM(txns)::BIGINT, SUM(net), SUM(deps)::BIGINT, SUM(dep), NULL
       FROM mm GROUP BY 1)
SELECT gateway, month, txns, net::DOUBLE AS sett_net, deps AS deposits, dep::DOUBLE AS bank_deposit,
       (dep - net)::DOUBLE AS gap,
       CASE WHEN dep = 0 THEN 0 ELSE (dep - net)::DOUBLE * 100 / dep::DOUBLE END AS gap_pct,
       reconcilable FROM mt""")
def bank_monthly(c: Chain):
    return ops.bank_monthly(c.settlement, c.bank)


_DAILY = """
WITH sd AS (SELECT gateway AS g, settled_date AS d, COUNT(*) AS txns, SUM(sett_gross) AS gross,
                   SUM(sett_net) AS net, SUM(sett_fee) AS fees
            FROM settlement WHERE gateway = 'GW_A' OR is_forward GROUP BY 1, 2),
rd AS (SELECT gateway AS g, settled_date AS d, COUNT(*) AS rtx, SUM(settled_amount) AS rnet
       FROM gateway_refund GROUP BY 1, 2),
bd AS (SELECT gateway AS g, bank_date AS d, bank_daily_deposit AS dep FROM bank_daily),
days AS (SELECT g, d FROM sd UNION SELECT g, d FROM rd WHERE g = 'GW_A' UNION SELECT g, d FROM bd),
x AS (SELECT days.g, days.d, coalesce(txns, 0) AS txns, coalesce(gross, 0) AS gross,
             coalesce(net, 0) AS net, coalesce(fees, 0) AS fees, coalesce(rtx, 0) AS rtx,
             coalesce(rnet, 0) AS rnet, coalesce(dep, 0) AS dep, txns IS NOT NULL AS has_sett
      FROM days LEFT JOIN sd ON sd.g = days.g AND sd.d = days.d
      LEFT JOIN rd ON rd.g = days.g AND rd.d = days.d
      LEFT JOIN bd ON bd.g = days.g AND bd.d = days.d)"""
_NETTED = """
SELECT g AS gateway, d AS day, txns, gross::DOUBLE AS gross, net::DOUBLE AS net, fees::DOUBLE AS fees,
       rtx AS refund_txns, rnet::DOUBLE AS refund_net, (net - rnet)::DOUBLE AS expected,
       dep::DOUBLE AS bank_deposit, (dep - net + rnet)::DOUBLE AS daily_diff,
       abs(dep - net + rnet) > 50000 AS is_outlier
FROM x WHERE g = 'GW_A'"""


@query("bank_daily_netting", _DAILY + _NETTED)
def bank_daily_netting(c: Chain):
    return ops.bank_daily_netting(c.settlement, c.gateway_refund, c.bank)


@query("join_left_date_3way", _DAILY + _NETTED + " AND has_sett")
def join_left_date_3way(c: Chain):
    return ops.bank_daily_netting(c.settlement, c.gateway_refund, c.bank, how="left")


@query("bank_daily_full", _DAILY + """
SELECT g AS gateway, d AS day, txns, gross::DOUBLE AS gross, net::DOUBLE AS net, fees::DOUBLE AS fees,
       dep::DOUBLE AS bank_deposit, (dep - net)::DOUBLE AS daily_diff, abs(dep - net) > 50000 AS is_outlier
FROM x WHERE g <> 'GW_A'""")
def bank_daily_full(c: Chain):
    return ops.bank_daily_full(c.settlement, c.bank)


@query("refund_impact_monthly", """
SELECT gateway, date_trunc('month', d)::DATE AS month, COUNT(*) AS n_rows, SUM(g)::DOUBLE AS gross,
       SUM(n)::DOUBLE AS net
FROM (SELECT gateway, settled_date AS d, amount AS g, settled_amount AS n
      FROM gateway_refund WHERE gateway = 'GW_A' UNION ALL
      SELECT gateway, settled_date, sett_gross, sett_net FROM settlement
      WHERE is_refund AND gateway <> 'GW_A') x
GROUP BY GROUPING SETS ((gateway, date_trunc('month', d)::DATE), (gateway))""")
def refund_impact_monthly(c: Chain):
    return ops.refund_impact_monthly(c.settlement, c.gateway_refund)


@query("bank_scorecard", _MONTHLY + """,
t AS (SELECT coalesce(mm.gateway, 'ALL') AS gateway, COUNT(*) AS matched_months, SUM(net) AS net,
             SUM(dep) AS dep FROM mm WHERE reconcilable GROUP BY ROLLUP (mm.gateway))
SELECT gateway, matched_months, net::DOUBLE AS sett_net, dep::DOUBLE AS bank_deposit,
       (dep - net)::DOUBLE AS gap, (dep - net)::DOUBLE * 100 / dep::DOUBLE AS gap_pct,
       CASE WHEN abs((dep - net)::DOUBLE * 100 / dep::DOUBLE) < 3 THEN 'CLEAN'
            WHEN abs((dep - net)::DOUBLE * 100 / dep::DOUBLE) < 10 THEN 'REVIEW'
            ELSE 'MISMATCH' END AS status
FROM t""")
def bank_scorecard(c: Chain):
    return ops.bank_scorecard(c.settlement, c.bank)


@query("bank_uncovered", """
SELECT gateway, COUNT(DISTINCT date_trunc('month', bank_date)) AS months, COUNT(*) AS deposits,
       SUM(deposit)::DOUBLE AS bank_total
FROM bank b WHERE NOT EXISTS (SELECT 1 FROM settlement s WHERE (s.is_forward OR s.gateway = 'GW_A') AND s.gateway = b.gateway
  AND date_trunc('month', s.settled_date) = date_trunc('month', b.bank_date)) GROUP BY 1""")
def bank_uncovered(c: Chain):
    return ops.bank_uncovered(c.settlement, c.bank)


@query("bank_period_check", """
WITH s AS (SELECT COUNT(*) AS n, SUM(sett_gross) AS g, SUM(sett_net) AS net FROM settlement
           WHERE is_forward AND strftime(settled_date, '%Y-%m') = '1996-01'),
d AS (SELECT COUNT(*) AS deps, SUM(deposit) AS dep FROM bank
      WHERE strftime(bank_date, '%Y-%m') = '1996-01')
SELECT n AS sett_rows, g::DOUBLE AS sett_gross, net::DOUBLE AS sett_net, deps AS deposits,
       dep::DOUBLE AS bank_deposit, (dep - net)::DOUBLE AS gap,
       (dep - net)::DOUBLE * 100 / net::DOUBLE AS gap_pct FROM s, d""")
def bank_period_check(c: Chain):
    return ops.bank_period_check(c.settlement, c.bank, MONTH)


@query("bank_gap_daily_alert", """
SELECT settled_date, gateway, SUM(sett_net)::DOUBLE AS sett_net,
       MAX(bank_daily_deposit)::DOUBLE AS bank_deposit,
       (MAX(bank_daily_deposit) - SUM(sett_net))::DOUBLE AS gap
FROM base b WHERE b.bank_date IS NOT NULL GROUP BY 1, 2
HAVING abs(MAX(b.bank_daily_deposit) - SUM(b.sett_net)) > 1000""")
def bank_gap_daily_alert(c: Chain):
    return ops.bank_gap_daily_alert(c.base)
