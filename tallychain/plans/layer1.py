"""Queries on the ledgers against the hub."""

from __future__ import annotations

from tallychain.operators import ledger_hub as ops
from tallychain.operators.ledger_hub import Keys
from tallychain.plans.registry import Chain, query

# Family of an id, written independently of the library.
PATTERN = (
    "CASE WHEN starts_with({0}, 'SRVC_') THEN 'other' ELSE split_part({0}, '_', 1) || '_*' END"
)


@query("hub_universe", """
SELECT source_month, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount,
       COUNT(*) FILTER (status = 'SUCCESS') AS success_rows,
       coalesce(SUM(amount) FILTER (status = 'SUCCESS'), 0)::DOUBLE AS success_amount
FROM hub h GROUP BY 1""")
def hub_universe(c: Chain):
    return ops.hub_universe(c.hub)


@query("hub_by_gateway", """
SELECT gateway, COUNT(*) AS n_rows, COUNT(*) FILTER (status = 'SUCCESS') AS success_rows,
       SUM(amount) FILTER (status = 'SUCCESS')::DOUBLE AS success_amount,
       SUM(amount) FILTER (status = 'SUCCESS')::DOUBLE / COUNT(*) FILTER (status = 'SUCCESS') AS avg_amount,
       COUNT(*) FILTER (status = 'SUCCESS')::DOUBLE * 100
         / (SELECT COUNT(*) FROM hub WHERE status = 'SUCCESS') AS share_pct
FROM hub GROUP BY 1""")
def hub_by_gateway(c: Chain):
    return ops.hub_by_gateway(c.hub)


@query("hub_by_pattern", f"""
WITH p AS (SELECT {PATTERN.format('order_id')} AS order_pattern, COUNT(*) AS n, SUM(amount) AS a
           FROM hub WHERE status = 'SUCCESS' GROUP BY 1)
SELECT order_pattern, n AS n_rows, a::DOUBLE AS amount,
       CASE WHEN order_pattern IN ('gen_*', 'sub_*', 'wgSub_*') THEN 'ledger_revenue'
            WHEN order_pattern = 'walletTop_*' THEN 'ledger_topup'
            WHEN order_pattern = 'w_*' THEN 'ledger_net_income'
            WHEN order_pattern = 'mr_*' THEN 'ledger_mobile'
            WHEN order_pattern = 'sd_*' THEN 'ledger_deposit'
            WHEN order_pattern = 'ott_*' THEN 'ledger_ott' END AS expected_ledger,
       n::DOUBLE * 100 / SUM(n) OVER () AS share_pct FROM p""")
def hub_by_pattern(c: Chain):
    return ops.hub_by_pattern(c.hub)


@query("hub_status_distribution", """
SELECT status, order_status, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount FROM hub GROUP BY 1, 2""")
def hub_status_distribution(c: Chain):
    return ops.hub_status_distribution(c.hub)


@query("ledger_universe", """
SELECT ledger_table, COUNT(*) AS n_rows, SUM(ledger_amount)::DOUBLE AS amount,
       COUNT(*) FILTER (in_scope) AS scope_rows,
       coalesce(SUM(ledger_amount) FILTER (in_scope), 0)::DOUBLE AS scope_amount
FROM ledger GROUP BY 1""")
def ledger_universe(c: Chain):
    return ops.ledger_universe(c.ledger)


_COUNTS = """
SELECT l.ledger_table, COUNT(*) AS ledger_rows, COUNT(h.order_id) AS matched,
       COUNT(*) FILTER (h.order_id IS NULL) AS unmatched,
       COUNT(*) FILTER (h.source_month <> strftime(l.ledger_date, '%Y-%m')) AS matched_other_month
FROM ledger l LEFT JOIN hub h ON h.order_id = l.order_id GROUP BY 1"""


@query("l1_match_counts", _COUNTS)
def l1_match_counts(c: Chain):
    return ops.l1_match_counts(c.ledger, c.hub)


@query("l1_scorecard", """
SELECT coalesce(l.ledger_table, 'ALL') AS ledger_table, COUNT(*) AS ledger_rows,
       COUNT(h.order_id) AS matched, COUNT(*) FILTER (h.order_id IS NULL) AS unmatched,
       COUNT(h.order_id)::DOUBLE * 100 / COUNT(*) AS match_pct
FROM ledger l LEFT JOIN hub h ON h.order_id = l.order_id GROUP BY ROLLUP (l.ledger_table)""")
def l1_scorecard(c: Chain):
    return ops.l1_scorecard(c.ledger, c.hub)


@query("l1_matched_by_gateway", """
SELECT l.ledger_table, h.gateway, COUNT(DISTINCT l.order_id) AS matched_ids, COUNT(*) AS ledger_rows,
       SUM(h.amount)::DOUBLE AS hub_amount
FROM ledger l JOIN hub h ON h.order_id = l.order_id WHERE h.status = 'SUCCESS' GROUP BY 1, 2""")
def l1_matched_by_gateway(c: Chain):
    return ops.l1_matched_by_gateway(c.ledger, c.hub)


@query("l1_unmatched_rows", """
SELECT ledger_table, order_id, ledger_amount::DOUBLE AS ledger_amount, ledger_date, ledger_status
FROM ledger l WHERE in_scope AND NOT EXISTS (SELECT 1 FROM hub h WHERE h.order_id = l.order_id)""")
def l1_unmatched_rows(c: Chain):
    return ops.l1_unmatched_rows(c.ledger, c.hub)


@query("l1_unmatched_breakdown", f"""
SELECT ledger_table, ledger_status, {PATTERN.format('l.order_id')} AS order_pattern,
       COUNT(*) AS n_rows, SUM(ledger_amount)::DOUBLE AS amount
FROM ledger l LEFT JOIN hub h ON h.order_id = l.order_id WHERE h.order_id IS NULL GROUP BY 1, 2, 3""")
def l1_unmatched_breakdown(c: Chain):
    return ops.l1_unmatched_breakdown(c.ledger, c.hub)


@query("l1_zero_amount_dist", """
SELECT ledger_amount::DOUBLE AS ledger_amount, COUNT(*) AS n_rows FROM ledger
WHERE ledger_table = 'ledger_revenue' AND order_id NOT IN (SELECT order_id FROM hub) GROUP BY 1""")
def l1_zero_amount_dist(c: Chain):
    return ops.l1_zero_amount_dist(c.ledger, c.hub, "ledger_revenue")


@query("l1_status_crosstab", """
SELECT l.ledger_status, h.status AS hub_status, h.order_status, COUNT(*) AS n_rows,
       SUM(h.amount)::DOUBLE AS hub_amount
FROM ledger l JOIN hub h ON h.order_id = l.order_id
WHERE l.ledger_table = 'ledger_booking' GROUP BY 1, 2, 3""")
def l1_status_crosstab(c: Chain):
    return ops.l1_status_crosstab(c.ledger, c.hub, "ledger_booking")


@query("l1_status_mismatch", """
SELECT mismatch, gateway, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS hub_amount FROM (
  SELECT 'LEDGER_ONLY_SUCCESS' AS mismatch, h.* FROM ledger l JOIN hub h ON h.order_id = l.order_id
  WHERE l.ledger_table = 'ledger_booking' AND l.ledger_status = 'TXN_SUCCESS' AND h.status <> 'SUCCESS'
  UNION ALL
  SELECT 'NULL_STATUS_CHARGED', h.* FROM ledger l JOIN hub h ON h.order_id = l.order_id
  WHERE l.ledger_table = 'ledger_booking' AND l.ledger_status IS NULL AND h.status = 'SUCCESS'
  UNION ALL
  SELECT 'HUB_ONLY_SUCCESS', h.* FROM ledger l JOIN hub h ON h.order_id = l.order_id
  WHERE l.ledger_table = 'ledger_booking' AND l.ledger_status <> 'TXN_SUCCESS' AND h.status = 'SUCCESS')
GROUP BY 1, 2""")
def l1_status_mismatch(c: Chain):
    return ops.l1_status_mismatch(c.ledger, c.hub, "ledger_booking")


_GOOD = """FROM ledger l JOIN hub h ON h.order_id = l.order_id
WHERE l.in_scope AND h.status = 'SUCCESS'"""


@query("l1_amount_compare", f"""
SELECT l.ledger_table, COUNT(*) AS matched,
       COUNT(*) FILTER (l.ledger_amount = h.amount) AS amount_equal,
       COUNT(*) FILTER (l.ledger_amount <> h.amount) AS amount_differs,
       SUM(l.ledger_amount)::DOUBLE AS ledger_total, SUM(h.amount)::DOUBLE AS hub_total,
       SUM(h.amount - l.ledger_amount)::DOUBLE AS diff {_GOOD} GROUP BY 1""")
def l1_amount_compare(c: Chain):
    return ops.l1_amount_compare(c.ledger, c.hub)


@query("l1_amount_mismatch_rows", f"""
SELECT l.ledger_table, l.order_id, l.ledger_amount::DOUBLE AS ledger_amount,
       h.amount::DOUBLE AS hub_amount, (h.amount - l.ledger_amount)::DOUBLE AS diff, COUNT(*) AS n_rows
{_GOOD} AND l.ledger_amount <> h.amount GROUP BY 1, 2, 3, 4, 5""")
def l1_amount_mismatch_rows(c: Chain):
    return ops.l1_amount_mismatch_rows(c.ledger, c.hub)


@query("sort_expr", f"""
SELECT l.ledger_table, l.order_id, l.ledger_amount::DOUBLE AS ledger_amount,
       h.amount::DOUBLE AS hub_amount, (h.amount - l.ledger_amount)::DOUBLE AS diff, 1::BIGINT AS n_rows
{_GOOD} AND l.ledger_amount <> h.amount
ORDER BY abs(h.amount - l.ledger_amount) DESC, l.order_id, l.ledger_table LIMIT 25""")
def sort_expr(c: Chain):
    return ops.l1_amount_mismatch_rows(c.ledger, c.hub, k=25)


@query("matched_amounts", f"""
SELECT coalesce(l.ledger_table, 'ALL') AS ledger_table, COUNT(*) AS matched,
       SUM(h.amount)::DOUBLE AS hub_total, SUM(l.ledger_amount)::DOUBLE AS ledger_total,
       COUNT(*) FILTER (l.ledger_amount <> h.amount) AS amount_differs,
       SUM(h.amount - l.ledger_amount)::DOUBLE AS diff {_GOOD} GROUP BY ROLLUP (l.ledger_table)""")
def matched_amounts(c: Chain):
    return ops.matched_amounts(c.ledger, c.hub)


_ORPHAN = "NOT EXISTS (SELECT 1 FROM ledger l WHERE l.order_id = h.order_id)"


@query("l1_orphans", f"""
WITH f AS (SELECT h.amount, {_ORPHAN} AS orphan FROM hub h WHERE h.status = 'SUCCESS')
SELECT COUNT(*) AS hub_rows, SUM(amount)::DOUBLE AS hub_amount, COUNT(*) FILTER (orphan) AS orphan_rows,
       SUM(amount) FILTER (orphan)::DOUBLE AS orphan_amount,
       COUNT(*) FILTER (orphan)::DOUBLE * 100 / COUNT(*) AS orphan_pct,
       SUM(amount) FILTER (orphan)::DOUBLE * 100 / SUM(amount)::DOUBLE AS orphan_amount_pct
FROM f""")
def l1_orphans(c: Chain):
    return ops.l1_orphans(c.hub, c.ledger)


@query("l1_orphans_by", f"""
WITH o AS (SELECT h.* FROM hub h WHERE {_ORPHAN}),
x AS (SELECT 'pattern_status' AS dimension, {PATTERN.format('order_id')} || ' ' || status AS value, amount FROM o
      UNION ALL SELECT 'gateway', gateway, amount FROM o
      UNION ALL SELECT 'source_month', source_month, amount FROM o)
SELECT dimension, value, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount FROM x GROUP BY 1, 2""")
def l1_orphans_by(c: Chain):
    return ops.l1_orphans_by(c.hub, c.ledger)


@query("l1_orphan_samples", f"""
SELECT order_id, gateway, amount::DOUBLE AS amount, status, created_date, customer_id
FROM hub h WHERE status = 'SUCCESS' AND {_ORPHAN} ORDER BY h.amount DESC, order_id LIMIT 20""")
def l1_orphan_samples(c: Chain):
    return ops.l1_orphan_samples(c.hub, c.ledger)


@query("l1_per_table_coverage", """
SELECT l.ledger_table, COUNT(DISTINCT h.order_id) AS hub_ids,
       COUNT(DISTINCT h.order_id)::DOUBLE * 100
         / (SELECT COUNT(*) FROM hub WHERE status = 'SUCCESS') AS hub_pct
FROM hub h JOIN ledger l ON l.order_id = h.order_id WHERE h.status = 'SUCCESS' GROUP BY 1""")
def l1_per_table_coverage(c: Chain):
    return ops.l1_per_table_coverage(c.hub, c.ledger)


@query("l1_unique_summary", """
WITH li AS (SELECT DISTINCT order_id FROM ledger
            WHERE in_scope AND ledger_table NOT IN ('ledger_topup', 'ledger_refunded')),
la AS (SELECT DISTINCT order_id FROM ledger),
hi AS (SELECT DISTINCT order_id FROM hub WHERE status = 'SUCCESS')
SELECT (SELECT COUNT(*) FROM li) AS ledger_ids, (SELECT COUNT(*) FROM hi) AS hub_ids,
  (SELECT COUNT(*) FROM li JOIN hi ON li.order_id = hi.order_id) AS both_ids,
  (SELECT COUNT(*) FROM li WHERE order_id NOT IN (SELECT order_id FROM hi)) AS ledger_only_ids,
  (SELECT COUNT(*) FROM hi WHERE order_id NOT IN (SELECT order_id FROM la)) AS hub_only_ids,
  (SELECT COUNT(*) FROM ledger WHERE ledger_table = 'ledger_refunded') AS ledger_refunds,
  (SELECT COUNT(*) FROM hub_refund WHERE refund_status = 'SUCCESS') AS hub_refunds,
  (SELECT SUM(ledger_amount)::DOUBLE FROM ledger
   WHERE in_scope AND ledger_table NOT IN ('ledger_topup', 'ledger_refunded')) AS ledger_amount,
  (SELECT SUM(amount)::DOUBLE FROM hub WHERE status = 'SUCCESS') AS hub_amount,
  (SELECT SUM(ledger_amount)::DOUBLE FROM ledger WHERE ledger_table = 'ledger_refunded') AS ledger_refund_amount,
  (SELECT SUM(refund_amount)::DOUBLE FROM hub_refund WHERE refund_status = 'SUCCESS') AS hub_refund_amount""")
def l1_unique_summary(c: Chain):
    return ops.l1_unique_summary(c.hub, c.ledger, c.hub_refund)


@query("ledger_overlap", f"""
WITH a AS (SELECT order_id, ledger_amount AS amt FROM ledger WHERE ledger_table = 'ledger_revenue' AND in_scope),
b AS (SELECT order_id, ledger_amount AS amt FROM ledger WHERE ledger_table = 'ledger_net_income' AND in_scope),
x AS (SELECT 'both' AS side, a.order_id, a.amt AS fa, b.amt AS sa FROM a JOIN b ON a.order_id = b.order_id
      UNION ALL SELECT 'first only', order_id, amt, NULL FROM a WHERE order_id NOT IN (SELECT order_id FROM b)
      UNION ALL SELECT 'second only', order_id, NULL, amt FROM b WHERE order_id NOT IN (SELECT order_id FROM a))
SELECT side, {PATTERN.format('order_id')} AS order_pattern, COUNT(*) AS ids,
       coalesce(SUM(fa), 0)::DOUBLE AS first_amount, coalesce(SUM(sa), 0)::DOUBLE AS second_amount
FROM x GROUP BY 1, 2""")
def ledger_overlap(c: Chain):
    return ops.ledger_overlap(c.ledger, "ledger_revenue", "ledger_net_income")


_DEDUP = """
WITH dd AS (SELECT ledger_table, ledger_amount FROM ledger WHERE ledger_table = 'ledger_revenue' AND in_scope
  UNION ALL
  SELECT ledger_table, ledger_amount FROM ledger l WHERE ledger_table = 'ledger_net_income' AND in_scope
  AND NOT EXISTS (SELECT 1 FROM ledger r WHERE r.ledger_table = 'ledger_revenue' AND r.order_id = l.order_id))"""


@query("ledger_dedup_total", _DEDUP + """
SELECT coalesce(dd.ledger_table, 'ALL') AS ledger_table, COUNT(*) AS n_rows,
       SUM(ledger_amount)::DOUBLE AS amount FROM dd GROUP BY ROLLUP (dd.ledger_table)""")
def ledger_dedup_total(c: Chain):
    return ops.ledger_dedup_total(c.ledger, "ledger_revenue", "ledger_net_income")


@query("inflow_total", _DEDUP + """,
t AS (SELECT (SELECT SUM(ledger_amount) FROM dd)
      + (SELECT SUM(ledger_amount) FROM ledger
         WHERE in_scope AND ledger_table IN ('ledger_deposit', 'ledger_mobile', 'ledger_ott')) AS lt,
      (SELECT SUM(amount) FROM hub WHERE status = 'SUCCESS') AS ht,
      (SELECT SUM(ledger_amount) FROM ledger WHERE ledger_table = 'ledger_revenue' AND mode = 'cash') AS ct)
SELECT lt::DOUBLE AS ledger_total, ht::DOUBLE AS hub_total, ct::DOUBLE AS cash_total,
       (ht - lt)::DOUBLE AS diff, (lt + ct)::DOUBLE AS with_cash FROM t""")
def inflow_total(c: Chain):
    return ops.inflow_total(c.ledger, c.hub, "ledger_revenue", "ledger_net_income")


def _link_sql(name: str, left: str, lkey: str, right: str, rkey: str) -> str:
    found = f"{lkey} IN (SELECT {rkey} FROM {right})"
    return f"""
SELECT '{name}' AS link, COUNT(*) AS left_rows, COUNT(*) FILTER ({found}) AS matched_rows,
       COUNT(DISTINCT {lkey}) AS left_keys, COUNT(DISTINCT CASE WHEN {found} THEN {lkey} END) AS matched_keys,
       COUNT(DISTINCT CASE WHEN {found} THEN {lkey} END)::DOUBLE * 100 / COUNT(DISTINCT {lkey}) AS matched_pct
FROM {left}"""


def _led(table: str) -> str:
    return f"ledger WHERE ledger_table = '{table}'"


@query("deposit_link", " UNION ALL ".join([
    _link_sql("deposit by own key", _led("ledger_deposit"), "order_id", "hub", "order_id"),
    _link_sql("deposit by alternate key", _led("ledger_deposit"), "alt_key", "hub", "order_id"),
    _link_sql("deposit by hub transaction", _led("ledger_deposit"), "alt_key", "hub", "hub_txn_id"),
]))
def deposit_link(c: Chain):
    return ops.deposit_link(c.ledger, c.hub)


@query("join_alternate_keys", """
SELECT 'own' AS key_used, COUNT(*) AS matched FROM ledger l JOIN hub h ON l.order_id = h.order_id
WHERE l.ledger_table = 'ledger_deposit'
UNION ALL
SELECT 'alternate', COUNT(*) FROM ledger l JOIN hub h ON l.alt_key = h.hub_txn_id
WHERE l.ledger_table = 'ledger_deposit'""")
def join_alternate_keys(c: Chain):
    own = ops.deposit_link(c.ledger, c.hub)
    return own.where("link <> 'deposit by alternate key'").selectExpr(
        "CASE link WHEN 'deposit by own key' THEN 'own' ELSE 'alternate' END AS key_used",
        "matched_rows AS matched",
    )


@query("revenue_link", " UNION ALL ".join([
    _link_sql("revenue to hub", _led("ledger_revenue"), "order_id", "hub", "order_id"),
    _link_sql("revenue to booking", _led("ledger_revenue"), "order_id", _led("ledger_booking"), "order_id"),
]))
def revenue_link(c: Chain):
    return ops.revenue_link(c.ledger, c.hub)


_GK = "gateway || '|' || gw_key"
_LINKS = [
    *[(f"{t} to hub", _led(t), "order_id", "hub", "order_id") for t in (
        "ledger_booking", "ledger_revenue", "ledger_net_income", "ledger_mobile", "ledger_deposit",
        "ledger_ott", "ledger_topup", "ledger_refunded")],
    ("ledger_revenue to ledger_topup", _led("ledger_revenue"), "order_id", _led("ledger_topup"), "order_id"),
    ("ledger_refunded to hub_refund", _led("ledger_refunded"), "order_id", "hub_refund", "order_id"),
    ("hub_refund to hub by order", "hub_refund", "order_id", "hub", "order_id"),
    ("hub_refund to hub by transaction", "hub_refund", "refund_txn_id", "hub", "hub_txn_id"),
    ("hub to gateway", "hub", "gateway || '|' || settle_key", "gateway_txn", _GK),
    ("gateway to settlement", "gateway_txn", _GK, "settlement", "gateway || '|' || settlement_order_id"),
    ("hub_refund to gateway_refund", "hub_refund",
     "gateway || '|' || CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END",
     "gateway_refund", "gateway || '|' || refund_key"),
    ("gateway_refund to gateway", "gateway_refund", "gateway || '|' || original_key", "gateway_txn", _GK),
]


@query("key_link_coverage", " UNION ALL ".join(_link_sql(*x) for x in _LINKS))
def key_link_coverage(c: Chain):
    return ops.chain_coverage(
        c.hub, c.hub_refund, c.gateway_txn, c.settlement, c.gateway_refund, c.ledger
    )


def _entity_sql(name: str, a: str, b: str, key: str) -> str:
    return f"""
SELECT '{name}' AS link, COUNT(*) AS shared_entities, SUM(x.n)::BIGINT AS left_rows,
       SUM(y.n)::BIGINT AS right_rows, SUM(x.n * y.n)::DOUBLE AS pairs
FROM (SELECT {key} AS e, COUNT(*) AS n FROM {_led(a)} GROUP BY 1) x
JOIN (SELECT {key} AS e, COUNT(*) AS n FROM {_led(b)} GROUP BY 1) y ON x.e = y.e"""


_ENTITIES = [
    ("booking account = revenue account", "ledger_booking", "ledger_revenue", "account_id"),
    ("booking mobile = revenue mobile", "ledger_booking", "ledger_revenue", "mobile"),
    ("revenue mobile = net income mobile", "ledger_revenue", "ledger_net_income", "mobile"),
    ("booking mobile = deposit mobile", "ledger_booking", "ledger_deposit", "mobile"),
    ("booking account = deposit account", "ledger_booking", "ledger_deposit", "account_id"),
    ("deposit mobile = revenue mobile", "ledger_deposit", "ledger_revenue", "mobile"),
]


@query("entity_link", " UNION ALL ".join(_entity_sql(*x) for x in _ENTITIES))
def entity_link(c: Chain):
    sides = [Keys(k, "ledger_table", c.ledger, k) for k in ("account_id", "mobile")]
    return ops.entity_link(sides, {n: (k, a, b) for n, a, b, k in _ENTITIES})


@query("refund_to_original", """
SELECT r.gateway, COUNT(*) AS refund_rows, COUNT(g.gw_key) AS matched_rows,
       SUM(r.amount)::DOUBLE AS refund_amount,
       (SELECT SUM(t.amount)::DOUBLE FROM gateway_txn t WHERE t.gateway = r.gateway
        AND t.gw_key IN (SELECT original_key FROM gateway_refund q WHERE q.gateway = r.gateway)) AS original_amount
FROM gateway_refund r LEFT JOIN gateway_txn g ON g.gateway = r.gateway AND g.gw_key = r.original_key
GROUP BY r.gateway""")
def refund_to_original(c: Chain):
    return ops.refund_to_original(c.gateway_refund, c.gateway_txn)


_L2H = """
WITH bk AS (SELECT 'ledger_booking' AS ledger_table, order_id AS ledger_txn_id,
    strftime(created_date, '%b %-d, %Y') AS ledger_date, paid AS ledger_amount,
    CASE WHEN k % 9 <> 0 THEN CASE WHEN status = 'SUCCESS' THEN 'TXN_SUCCESS' ELSE 'PENDING' END END AS ledger_status,
    flow AS ledger_flag, gateway AS ledger_gateway FROM booked WHERE k % 10 < 2 AND k % 3 = 0),
rv AS (SELECT 'ledger_revenue' AS ledger_table, order_id AS ledger_txn_id,
    strftime(created_date, '%b %-d, %Y') AS ledger_date,
    CAST(CASE WHEN k % 77 = 0 THEN 0 ELSE paid END AS DECIMAL(18,2)) AS ledger_amount,
    NULL::VARCHAR AS ledger_status, 'online' AS ledger_flag, NULL::VARCHAR AS ledger_gateway
    FROM booked WHERE k % 10 < 4 AND k % 13 <> 0),
hh AS (SELECT order_id AS hub_order_id, status AS hub_status, amount AS hub_amount,
              gateway AS hub_gateway, created_date AS hub_date FROM hub),
rep AS (
  SELECT *, 'STATUS_MISMATCH' AS mismatch_type, 'ledger status missing, hub row exists' AS mismatch_reason,
         hub_amount - ledger_amount AS amount_diff
  FROM bk JOIN hh ON ledger_txn_id = hub_order_id WHERE ledger_status IS NULL
  UNION ALL
  SELECT *, 'AMOUNT_MISMATCH', 'ledger ' || ledger_amount::VARCHAR || ' vs hub ' || hub_amount::VARCHAR,
         hub_amount - ledger_amount
  FROM bk JOIN hh ON ledger_txn_id = hub_order_id
  WHERE ledger_status = 'TXN_SUCCESS' AND hub_status = 'SUCCESS' AND ledger_amount <> hub_amount
  UNION ALL
  SELECT *, 'AMOUNT_MISMATCH', 'ledger ' || ledger_amount::VARCHAR || ' vs hub ' || hub_amount::VARCHAR,
         hub_amount - ledger_amount
  FROM rv JOIN hh ON ledger_txn_id = hub_order_id WHERE hub_status = 'SUCCESS' AND ledger_amount <> hub_amount
  UNION ALL
  SELECT *, 'LEDGER_ONLY', CASE WHEN starts_with(ledger_txn_id, 'SRVC_') THEN 'partner wallet, outside the hub'
           WHEN starts_with(ledger_txn_id, 'gen_') AND ledger_amount = 0
             THEN 'nothing paid, failed or cancelled'
           WHEN starts_with(ledger_txn_id, 'BOOKING_PAYMENT') THEN 'booking fee reversal'
           ELSE 'not found in the hub' END, NULL
  FROM rv LEFT JOIN hh ON ledger_txn_id = hub_order_id WHERE hub_order_id IS NULL)"""


@query("mismatch_ledger_to_hub", _L2H + """
SELECT * REPLACE (ledger_amount::DOUBLE AS ledger_amount, hub_amount::DOUBLE AS hub_amount,
                  amount_diff::DOUBLE AS amount_diff) FROM rep""")
def mismatch_ledger_to_hub(c: Chain):
    src = c.ledger_sources
    return ops.mismatch_ledger_to_hub(src["ledger_booking"], src["ledger_revenue"], c.hub)


_H2L = f"""
SELECT order_id AS hub_order_id, status AS hub_status, amount AS hub_amount, gateway AS hub_gateway,
       created_date AS hub_date, order_status, customer_id, payment_flow,
       {PATTERN.format('order_id')} AS order_pattern, 'HUB_ONLY' AS mismatch_type,
       'successful hub row in no ledger' AS mismatch_reason
FROM hub h WHERE status = 'SUCCESS' AND order_id NOT IN (SELECT order_id FROM ledger)"""


@query("mismatch_hub_to_ledger", f"""
WITH hl AS ({_H2L}) SELECT * REPLACE (hub_amount::DOUBLE AS hub_amount) FROM hl""")
def mismatch_hub_to_ledger(c: Chain):
    return ops.mismatch_hub_to_ledger(c.hub, c.ledger)


@query("mismatch_summary", _L2H + f""",
hl AS ({_H2L}),
x AS (SELECT mismatch_type, {PATTERN.format('ledger_txn_id')} AS order_pattern, hub_gateway AS gateway,
             ledger_amount AS amount FROM rep
      UNION ALL SELECT mismatch_type, order_pattern, hub_gateway, hub_amount FROM hl)
SELECT mismatch_type, order_pattern, gateway, COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount
FROM x GROUP BY 1, 2, 3""")
def mismatch_summary(c: Chain):
    return ops.mismatch_summary(mismatch_ledger_to_hub(c), mismatch_hub_to_ledger(c))
