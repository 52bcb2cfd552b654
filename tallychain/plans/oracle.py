"""The canonical relations once more, as SQL over the given tables.

Written straight from the definitions, without the detour over source files, so
that a wrong normaliser shows up as a mismatch. Each query's SQL names only the
relations it needs; ``with_relations`` puts them in front.
"""

from __future__ import annotations

import re

# name -> (SQL body, relations it reads). Order matters: later ones use earlier ones.
RELATIONS: dict[str, str] = {
    "spine": """
        SELECT o_orderkey AS k, o_custkey AS cust,
               fam || '_' || o_orderkey AS order_id,
               'h-' || fam || '_' || o_orderkey || '-1' AS hub_txn_id,
               CASE o_custkey % 4 WHEN 0 THEN 'GW_A' WHEN 1 THEN 'GW_B'
                                  WHEN 2 THEN 'GW_C' ELSE 'GW_D' END AS gateway,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
               o_orderstatus AS order_status,
               CAST(o_orderdate AS DATE) AS created_date,
               o_orderpriority AS flow
        FROM (SELECT *, CASE o_orderkey % 10
                          WHEN 0 THEN 'gen' WHEN 1 THEN 'gen' WHEN 2 THEN 'sub'
                          WHEN 3 THEN 'wgSub' WHEN 4 THEN 'w' WHEN 5 THEN 'walletTop'
                          WHEN 6 THEN 'mr' WHEN 7 THEN 'sd' WHEN 8 THEN 'ott'
                          ELSE 'SRVC' END AS fam FROM orders)""",
    "hub": """
        SELECT k, order_id, hub_txn_id,
               CASE WHEN gateway = 'GW_D' THEN order_id ELSE hub_txn_id END AS settle_key,
               gateway, amount, status, order_status, created_date,
               strftime(created_date, '%Y-%m') AS source_month,
               'c-' || cust AS customer_id, flow AS payment_flow
        FROM spine WHERE k % 97 <> 0""",
    "hub_refund": """
        SELECT h.order_id, h.hub_txn_id AS refund_txn_id,
               'r-' || h.k || '-' || n AS refund_unique_id,
               CAST(h.amount - n AS DECIMAL(18,2)) AS refund_amount,
               CASE WHEN h.k % 145 = 0 THEN 'PENDING' ELSE 'SUCCESS' END AS refund_status,
               CASE WHEN h.k % 58 = 0 THEN 'PARTIAL' ELSE 'FULL' END AS refund_type,
               CAST(h.created_date + CAST(n * 6 - 3 AS INTEGER) AS DATE) AS refund_date,
               h.gateway
        FROM hub h JOIN (VALUES (1), (2)) v(n) ON n = 1 OR h.k % 58 = 0
        WHERE h.k % 29 = 0""",
    "gateway_txn": """
        SELECT gateway,
               CASE WHEN gateway = 'GW_D' THEN order_id ELSE hub_txn_id END AS gw_key,
               CAST(CASE WHEN gateway = 'GW_C' AND k % 62 = 0 THEN 0
                         WHEN gateway = 'GW_C' AND k % 31 = 0 THEN amount - 5
                         ELSE amount END AS DECIMAL(18,2)) AS amount,
               CASE gateway
                 WHEN 'GW_A' THEN CASE WHEN status = 'SUCCESS' THEN 'TXN_SUCCESS' ELSE 'PENDING' END
                 WHEN 'GW_B' THEN CASE WHEN status = 'SUCCESS' THEN 'SUCCESS' ELSE 'FAILED' END
                 WHEN 'GW_C' THEN CASE WHEN status = 'SUCCESS' THEN 'captured' ELSE 'failed' END
                 ELSE CASE WHEN status = 'SUCCESS' THEN 'payment' ELSE 'adjustment' END END AS status,
               gateway = 'GW_A' OR status = 'SUCCESS' AS is_success,
               created_date AS txn_date,
               CASE k % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD'
                          WHEN 2 THEN 'NETBANKING' ELSE 'WALLET' END AS mode,
               'bank' || (k % 5) AS bank_name,
               CASE WHEN k % 3 = 0 THEN 'E0' || (k % 7) END AS error_description,
               CAST(CASE WHEN k % 8 = 0 THEN 2.5 WHEN k % 8 = 1 THEN 0 END AS DECIMAL(18,2)) AS discount,
               CAST(CASE WHEN k % 6 = 0 THEN 1.5 ELSE 0 END AS DECIMAL(18,2)) AS subvention
        FROM spine WHERE k % 97 = 0 OR k % 53 <> 0""",
    "settlement": """
        SELECT gateway, settlement_order_id, settled_date, gross AS sett_gross,
               CASE WHEN gateway = 'GW_B' AND l_returnflag = 'R' THEN gross + fee
                    ELSE gross - fee END::DECIMAL(18,2) AS sett_net,
               fee AS sett_fee,
               CAST(fee * CAST(0.18 AS DECIMAL(2,2)) AS DECIMAL(18,2)) AS sett_tax,
               CAST(CASE WHEN gateway = 'GW_B' AND l_returnflag = 'R' THEN fee ELSE -fee END
                    AS DECIMAL(18,2)) AS signed_fee,
               gateway || '-' || CAST(settled_date AS VARCHAR) AS sett_utr,
               kind AS sett_txn_type,
               CASE WHEN l_returnflag = 'R' THEN 'REFUND' ELSE 'PAYMENT' END AS payment_type,
               CASE WHEN l_linenumber % 2 = 1 THEN 'COMPLETED' END AS txn_status,
               method,
               CASE WHEN method = 'CARD' THEN CASE l_partkey % 3 WHEN 0 THEN 'VISA'
                    WHEN 1 THEN 'MASTER' ELSE 'RUPAY' END END AS network,
               CASE WHEN method = 'CARD' THEN CASE WHEN l_partkey % 2 = 0 THEN 'credit'
                    ELSE 'debit' END END AS card_type,
               CASE gateway WHEN 'GW_C' THEN true
                            ELSE kind IS NOT NULL AND kind IN ('ACQUIRING', 'PAYMENT', 'payment')
               END AS is_forward,
               l_returnflag = 'R' AS is_refund
        FROM (SELECT l.*, s.gateway, CAST(l_shipdate AS DATE) AS settled_date,
                     CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
                     CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
                          * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,2)) AS fee,
                     CASE l_partkey % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD'
                                        WHEN 2 THEN 'NETBANKING' ELSE 'WALLET' END AS method,
                     CASE WHEN s.gateway = 'GW_C' AND l_partkey % 500 = 0 THEN 'ADJ_' || l_partkey
                          WHEN s.gateway = 'GW_A' AND l_partkey % 499 = 0 THEN 'w-' || s.order_id
                          WHEN s.gateway = 'GW_D' THEN s.order_id
                          ELSE s.hub_txn_id END AS settlement_order_id,
                     CASE WHEN l_returnflag = 'R' THEN
                            CASE s.gateway WHEN 'GW_A' THEN 'REFUND'
                              WHEN 'GW_B' THEN CASE WHEN l_linenumber % 2 = 1 THEN 'REFUND' ELSE 'REVERSAL' END
                              WHEN 'GW_C' THEN CASE WHEN l_linenumber % 2 = 1 THEN 'Refunded' ELSE 'Chargebacked' END
                              ELSE 'refund' END
                          WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber = 7 THEN
                            CASE WHEN s.gateway = 'GW_D' THEN 'adjustment' END
                          ELSE CASE s.gateway WHEN 'GW_A' THEN 'ACQUIRING' WHEN 'GW_B' THEN 'PAYMENT'
                                 WHEN 'GW_C' THEN 'captured' ELSE 'payment' END END AS kind
              FROM lineitem l JOIN spine s ON l.l_orderkey = s.k)""",
    "gateway_refund": """
        SELECT gateway,
               CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS refund_key,
               CASE WHEN gateway = 'GW_D' THEN order_id ELSE refund_txn_id END AS original_key,
               refund_amount AS amount,
               CAST(refund_amount - 1 AS DECIMAL(18,2)) AS settled_amount,
               CAST(refund_date + 1 AS DATE) AS settled_date, refund_date AS txn_date
        FROM hub_refund WHERE CAST(split_part(order_id, '_', 2) AS BIGINT) % 203 <> 0""",
    "booked": """
        SELECT *, CAST(amount + CASE WHEN k % 211 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS paid
        FROM spine WHERE k % 50 <> 0 AND k % 40 <> 4""",
    "ledger": """
        SELECT order_id, 'ledger_booking' AS ledger_table, paid AS ledger_amount,
               created_date AS ledger_date,
               CASE WHEN k % 9 <> 0 THEN CASE WHEN status = 'SUCCESS' THEN 'TXN_SUCCESS' ELSE 'PENDING' END
               END AS ledger_status, NULL::VARCHAR AS mode, NULL::VARCHAR AS plan,
               CAST(cust AS VARCHAR) AS account_id, 'm-' || cust AS mobile, order_id AS alt_key,
               1 AS priority, k % 9 <> 0 AND status = 'SUCCESS' AS in_scope,
               NULL::VARCHAR AS payment_status, NULL::VARCHAR AS refund_status
        FROM booked WHERE k % 10 < 2 AND k % 3 = 0
        UNION ALL
        SELECT order_id, 'ledger_revenue', CASE WHEN k % 77 = 0 THEN 0 ELSE paid END, created_date,
               NULL, CASE WHEN k % 13 = 0 THEN 'cash' ELSE 'online' END, flow,
               CAST(cust AS VARCHAR), 'm-' || cust, order_id, 2,
               k % 13 <> 0 AND k % 77 <> 0 AND paid > 0, NULL, NULL
        FROM booked WHERE k % 10 < 4
        UNION ALL
        SELECT order_id, 'ledger_net_income', paid, created_date, NULL,
               CASE WHEN k % 17 = 0 THEN 'cash' ELSE 'online' END, 'wallet', NULL, 'm-' || cust,
               order_id, 3, k % 17 <> 0, NULL, NULL
        FROM booked WHERE k % 10 = 4 OR (k % 10 = 2 AND k % 3 = 0)
        UNION ALL
        SELECT order_id, 'ledger_mobile', paid, created_date, NULL, NULL, NULL, NULL, NULL,
               order_id, 4, true, NULL, NULL FROM booked WHERE k % 10 = 6
        UNION ALL
        SELECT order_id, 'ledger_deposit', paid, created_date, NULL, NULL, NULL,
               CAST(cust AS VARCHAR), 'm-' || cust,
               CASE WHEN k % 3 = 0 THEN hub_txn_id ELSE order_id END, 5, true, NULL, NULL
        FROM booked WHERE k % 10 = 7
        UNION ALL
        SELECT order_id, 'ledger_ott', paid, created_date, NULL, NULL, NULL, NULL, NULL,
               order_id, 6, true, NULL, NULL FROM booked WHERE k % 10 = 8
        UNION ALL
        SELECT order_id, 'ledger_topup', paid, created_date, NULL, NULL, NULL, NULL, NULL,
               order_id, NULL, true, NULL, NULL FROM booked WHERE k % 10 = 5
        UNION ALL
        SELECT order_id, 'ledger_refunded',
               CAST(amount + CASE WHEN k % 211 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,2)),
               CAST(created_date + 5 AS DATE), 'REFUNDED', 'online', 'type' || (k % 3), NULL, 'm-' || cust,
               order_id, NULL, k % 300 <> 0, CASE WHEN k % 4 = 0 THEN 'PAID' ELSE 'REVERSED' END,
               CASE WHEN k % 300 <> 0 THEN '1' ELSE '0' END
        FROM spine WHERE k % 100 = 0 OR k % 110 = 2""",
    "bank": """
        SELECT gateway,
               CASE gateway WHEN 'GW_A' THEN '01 Wallet A' WHEN 'GW_B' THEN '05 Wallet B'
                            WHEN 'GW_C' THEN '02 Wallet C' ELSE '06 Wallet D' END AS bank_label,
               d AS bank_date, deposit, 'RTGS ' || gateway || ' ' || CAST(d AS VARCHAR) AS remarks,
               strftime(d, '%b-%y') AS month_text
        FROM (SELECT s.gateway, s.settled_date AS d,
                     CAST(CAST(CASE WHEN s.nf = 0 THEN s.stray
                                    ELSE s.fwd - coalesce(r.netted, 0) END AS DECIMAL(18,2))
                          * CAST(0.995 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS deposit
              FROM (SELECT gateway, settled_date, COUNT(*) FILTER (is_forward) AS nf,
                           coalesce(SUM(sett_net) FILTER (is_forward), 0) AS fwd,
                           coalesce(SUM(sett_net) FILTER (is_refund), 0) AS stray
                    FROM settlement GROUP BY 1, 2) s
              LEFT JOIN (SELECT gateway, settled_date, SUM(settled_amount) AS netted
                         FROM gateway_refund WHERE gateway = 'GW_A' GROUP BY 1, 2) r
                ON r.gateway = s.gateway AND r.settled_date = s.settled_date
              WHERE day(s.settled_date) NOT IN (7, 21)
              UNION ALL
              SELECT gateway, CAST(created_date - 365 AS DATE),
                     CAST(CAST(SUM(amount) AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,2))
              FROM spine WHERE created_date < DATE '1995-02-01' GROUP BY 1, 2)""",
    "lookup": """
        SELECT order_id, ledger_table, ledger_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id
                                           ORDER BY priority, ledger_amount NULLS LAST) AS rn
              FROM ledger WHERE priority IS NOT NULL AND order_id IS NOT NULL)
        WHERE rn = 1""",
    # Orders whose money went back, and wallet top-ups: where a main ledger has nothing.
    "paid_back": """
        SELECT order_id, MIN(ledger_amount) AS amount FROM ledger
        WHERE ledger_table = 'ledger_refunded' AND refund_status = '1' GROUP BY 1""",
    "topped_up": """
        SELECT order_id, MIN(ledger_amount) AS amount FROM ledger
        WHERE ledger_table = 'ledger_topup' AND starts_with(order_id, 'walletTop_') GROUP BY 1""",
    # All eight ledgers: the main ones, else a refund, else a top-up.
    "lookup_all": """
        SELECT order_id, arg_min(ledger_table, step) AS ledger_table, arg_min(ledger_amount, step) AS ledger_amount
        FROM (SELECT 1 AS step, order_id, ledger_table, ledger_amount FROM lookup
              UNION ALL SELECT 2, order_id, 'ledger_refunded', amount FROM paid_back
              UNION ALL SELECT 3, order_id, 'ledger_topup', amount FROM topped_up) GROUP BY 1""",
    "bank_daily": """
        SELECT gateway, bank_date, SUM(deposit) AS bank_daily_deposit, COUNT(*) AS deposits
        FROM bank GROUP BY 1, 2""",
    "base": """
        SELECT s.gateway, s.settlement_order_id, b.bank_date, b.bank_daily_deposit, s.settled_date,
               strftime(s.settled_date, '%Y-%m') AS recon_month,
               s.sett_gross, s.sett_net, s.sett_fee, s.sett_utr, s.sett_txn_type,
               h.order_id AS hub_order_id, h.hub_txn_id, h.amount AS hub_amount,
               h.status AS hub_status, h.gateway AS hub_gateway, h.created_date AS hub_created_date,
               CASE WHEN h.order_id IS NOT NULL THEN 'MATCHED' ELSE 'SETT_ONLY' END AS l2_match,
               coalesce(w.order_id, p.order_id, t.order_id) AS ledger_txn_id,
               CASE WHEN w.order_id IS NOT NULL THEN w.ledger_table
                    WHEN p.order_id IS NOT NULL THEN 'ledger_refunded'
                    WHEN t.order_id IS NOT NULL THEN 'ledger_topup' END AS ledger_table,
               CASE WHEN w.order_id IS NOT NULL THEN w.ledger_amount
                    WHEN p.order_id IS NOT NULL THEN p.amount ELSE t.amount END AS ledger_amount,
               CASE WHEN h.order_id IS NULL THEN 'NO_HUB'
                    WHEN w.order_id IS NOT NULL THEN 'MATCHED'
                    WHEN starts_with(h.order_id, 'SRVC_') THEN 'PARTNER_WALLET'
                    ELSE 'HUB_ONLY' END AS l1_match,
               split_part(coalesce(h.order_id, s.settlement_order_id), '_', 1) AS order_id_prefix,
               CASE WHEN starts_with(s.settlement_order_id, 'ADJ_')
                      OR starts_with(s.settlement_order_id, 'w-') THEN 'PG_ADJUSTMENT'
                    WHEN h.order_id IS NULL THEN 'MISSING_HUB'
                    WHEN starts_with(h.order_id, 'SRVC_') THEN 'PARTNER_WALLET'
                    WHEN w.order_id IS NOT NULL THEN 'FULLY_TRACED'
                    WHEN p.order_id IS NOT NULL THEN 'REFUNDED'
                    WHEN t.order_id IS NOT NULL THEN 'WALLET_TOPUP'
                    ELSE 'MISSING_LEDGER' END AS trace_status,
               CASE WHEN h.order_id IS NULL THEN 'MISSING_HUB'
                    WHEN starts_with(h.order_id, 'SRVC_') THEN 'PARTNER_WALLET'
                    WHEN w.order_id IS NOT NULL THEN 'FULLY_TRACED'
                    ELSE 'MISSING_LEDGER' END AS trace_status_basic,
               h.amount - s.sett_gross AS diff_hub_vs_sett,
               CASE WHEN w.order_id IS NOT NULL THEN w.ledger_amount
                    WHEN p.order_id IS NOT NULL THEN p.amount ELSE t.amount END - h.amount AS diff_ledger_vs_hub,
               h.source_month
        FROM settlement s
        LEFT JOIN bank_daily b ON b.gateway = s.gateway AND b.bank_date = s.settled_date
        LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
        LEFT JOIN lookup w ON w.order_id = h.order_id
        LEFT JOIN paid_back p ON p.order_id = h.order_id
        LEFT JOIN topped_up t ON t.order_id = h.order_id
        WHERE s.is_forward""",
    # Hub and ledger amounts stand on one row of each settlement id only.
    "base_once": """
        SELECT * REPLACE (CASE WHEN first_row THEN hub_amount END AS hub_amount,
                          CASE WHEN first_row THEN ledger_amount END AS ledger_amount)
        FROM (SELECT *, row_number() OVER (PARTITION BY gateway, settlement_order_id) = 1 AS first_row
              FROM base)""",
    "base_month": "SELECT * FROM base WHERE recon_month = '1996-01'",
    "once_month": """
        SELECT * REPLACE (CASE WHEN first_row THEN hub_amount END AS hub_amount,
                          CASE WHEN first_row THEN ledger_amount END AS ledger_amount)
        FROM (SELECT *, row_number() OVER (PARTITION BY gateway, settlement_order_id) = 1 AS first_row
              FROM base_month)""",
    "bank_month": "SELECT * FROM bank WHERE year(bank_date) = 1996 AND month(bank_date) = 1",
    "bank_month_daily": """
        SELECT gateway, bank_date, SUM(deposit) AS bank_daily_deposit FROM bank_month GROUP BY 1, 2""",
    # One row per gateway key: joins between the layers do not fan out.
    "gw_by_key": """
        SELECT gateway, gw_key, SUM(amount) AS gw_amount, COUNT(*) AS gw_rows
        FROM gateway_txn GROUP BY 1, 2""",
    "sett_by_key": """
        SELECT gateway, settlement_order_id AS gw_key, COUNT(*) AS sett_rows,
               SUM(sett_gross) AS gross, SUM(sett_net) AS net, SUM(sett_fee) AS fee,
               SUM(sett_tax) AS tax, MIN(settled_date) AS first_date, MAX(settled_date) AS last_date
        FROM settlement WHERE is_forward GROUP BY 1, 2""",
}


def with_relations(body: str) -> str:
    """Prefix ``body`` with the relations it mentions, directly or through others."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in RELATIONS.items():
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(text)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({t})" for n, t in RELATIONS.items() if n in needed)
    head = body.lstrip()
    if head.upper().startswith("WITH "):
        return f"WITH {ctes},\n{head[5:]}"
    return f"WITH {ctes}\n{head}"
