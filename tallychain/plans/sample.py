"""Source files of a payment chain, derived from an orders / lineitem pair.

Every order and every line is used. The shapes (quoted ids, text dates,
negative fees, missing rows) are those of the real files, so the normalisers in
``relations`` run on them unchanged. Gaps are planted by rules on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallychain.config import MONEY
from tallychain.functions.status import bank_label
from tallychain.operators.frames import group

# Id family by last digit of the order key.
FAMILY = """CASE o_orderkey % 10 WHEN 0 THEN 'gen' WHEN 1 THEN 'gen' WHEN 2 THEN 'sub'
    WHEN 3 THEN 'wgSub' WHEN 4 THEN 'w' WHEN 5 THEN 'walletTop' WHEN 6 THEN 'mr'
    WHEN 7 THEN 'sd' WHEN 8 THEN 'ott' ELSE 'SRVC' END"""
GATEWAY = "CASE o_custkey % 4 WHEN 0 THEN 'GW_A' WHEN 1 THEN 'GW_B' WHEN 2 THEN 'GW_C' ELSE 'GW_D' END"


def _method(x: str) -> str:
    return f"CASE {x} % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'NETBANKING' ELSE 'WALLET' END"


def _quoted(x: str) -> str:
    return f"concat(chr(39), {x}, chr(39))"


#: an order's id as the gateway's own files carry it
RAW_ID = (
    f"CASE gateway WHEN 'GW_A' THEN {_quoted('hub_txn_id')} "
    "WHEN 'GW_D' THEN order_id ELSE hub_txn_id END"
)
IN_HUB = "k % 97 <> 0"


def order_spine(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS k",
        "o_custkey AS cust",
        f"concat({FAMILY}, '_', o_orderkey) AS order_id",
        f"{GATEWAY} AS gateway",
        f"CAST(o_totalprice AS {MONEY}) AS amount",
        "CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'SUCCESS' END AS status",
        "o_orderstatus AS order_status",
        "CAST(o_orderdate AS DATE) AS created_date",
        "o_orderpriority AS flow",
    ).selectExpr("*", "concat('h-', order_id, '-1') AS hub_txn_id")


def hub_txn(spine: DataFrame) -> DataFrame:
    return spine.where(IN_HUB).selectExpr(
        "order_id",
        "hub_txn_id",
        "CAST(amount AS DOUBLE) AS amount",
        "order_status",
        "status AS payment_status",
        "gateway AS payment_gateway",
        "CAST(created_date AS STRING) AS order_date_created",
        "concat('c-', cust) AS customer_id",
        "flow AS payment_flow",
    )


def _refunded(spine: DataFrame, where: str) -> DataFrame:
    """One refund per 29th hub order, two for every second of those."""
    return spine.where(f"{IN_HUB} AND k % 29 = 0 AND {where}").selectExpr(
        "*", "explode(sequence(1, CASE WHEN k % 58 = 0 THEN 2 ELSE 1 END)) AS n"
    )


def hub_refund(spine: DataFrame) -> DataFrame:
    return _refunded(spine, "true").selectExpr(
        "order_id",
        "hub_txn_id AS refund_txn_id",
        "concat_ws('-', 'r', k, n) AS refund_unique_id",
        "CAST(amount - n AS DOUBLE) AS refund_amount",
        "CASE WHEN k % 145 = 0 THEN 'PENDING' ELSE 'SUCCESS' END AS refund_status",
        "CASE WHEN k % 58 = 0 THEN 'PARTIAL' ELSE 'FULL' END AS refund_type",
        "CAST(date_add(created_date, n * 6 - 3) AS STRING) AS refund_date",
        "gateway AS payment_gateway",
    )


def gateway_refund_feed(spine: DataFrame) -> DataFrame:
    """Refunds as the gateways report them; every seventh refunded order is missing."""
    settled = "CAST(date_add(created_date, n * 6 - 2) AS STRING)"
    asked = "CAST(date_add(created_date, n * 6 - 3) AS STRING)"

    def stamped(day: str, time: str) -> str:
        quoted = _quoted(f"concat({day}, ' {time}')")
        return f"CASE WHEN gateway = 'GW_A' THEN {quoted} ELSE {day} END"

    return _refunded(spine, "k % 203 <> 0").selectExpr(
        "gateway",
        f"{RAW_ID} AS raw_refund_id",
        f"{RAW_ID} AS raw_original_id",
        "CAST(amount - n AS DOUBLE) AS raw_amount",
        "CAST(amount - n - 1 AS DOUBLE) AS raw_settled_amount",
        f"{stamped(settled, '16:24:17')} AS raw_settled_on",
        f"{stamped(asked, '09:00:00')} AS raw_txn_date",
    )


def gateway_txn_feed(spine: DataFrame) -> DataFrame:
    """Gateway transaction rows; some hub rows are missing, some rows are not in the hub."""
    stamped = _quoted("concat(CAST(created_date AS STRING), ' 10:00:00')")
    return spine.where(f"NOT ({IN_HUB}) OR k % 53 <> 0").selectExpr(
        "gateway",
        f"{RAW_ID} AS raw_order_id",
        """CAST(CASE WHEN gateway = 'GW_C' AND k % 62 = 0 THEN 0
                     WHEN gateway = 'GW_C' AND k % 31 = 0 THEN amount - 5
                     ELSE amount END AS DOUBLE) AS raw_amount""",
        """CASE gateway WHEN 'GW_A' THEN if(status = 'SUCCESS', 'TXN_SUCCESS', 'PENDING')
                        WHEN 'GW_B' THEN if(status = 'SUCCESS', 'SUCCESS', 'FAILED')
                        WHEN 'GW_C' THEN if(status = 'SUCCESS', 'captured', 'failed')
                        ELSE if(status = 'SUCCESS', 'payment', 'adjustment') END AS raw_status""",
        f"""CASE gateway WHEN 'GW_A' THEN {stamped}
                         WHEN 'GW_C' THEN concat(date_format(created_date, 'dd-MM-yyyy'), ' 10:00')
                         ELSE CAST(created_date AS STRING) END AS raw_date""",
        f"{_method('k')} AS mode",
        "concat('bank', k % 5) AS bank_name",
        "CASE WHEN k % 3 = 0 THEN concat('E0', k % 7) END AS error_description",
        "CASE k % 8 WHEN 0 THEN 2.5D WHEN 1 THEN 0D END AS discount",
        "CASE WHEN k % 6 = 0 THEN 1.5D ELSE 0D END AS subvention",
    )


def settlement_feed(spine: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One settlement row per line, in each gateway's own conventions."""
    owner = spine.select("k", "order_id", "hub_txn_id", "gateway")
    # Fees and date texts are made after the join: they would only widen its rows.
    lines = lineitem.selectExpr(
        "l_orderkey",
        "l_partkey AS part",
        "l_linenumber % 2 = 1 AS odd",
        "l_returnflag = 'R' AS refund",
        "l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber = 7 AS untyped",
        f"CAST(l_extendedprice AS {MONEY}) AS gross",
        "CAST(l_tax AS DECIMAL(4,2)) AS rate",
        "CAST(l_shipdate AS DATE) AS shipped",
    )
    joined = lines.join(owner, lines["l_orderkey"] == owner["k"]).selectExpr(
        "*",
        # Decimal arithmetic: a double product can fall on either side of half a cent.
        f"CAST(gross * rate * 0.01BD AS {MONEY}) AS fee",
        "CAST(shipped AS STRING) AS day",
    )
    rows = joined.selectExpr(
        "*",
        f"CAST(fee * 0.18BD AS {MONEY}) AS tax",
        f"{_method('part')} AS method",
        "gateway = 'GW_B' AND refund AS credit",
        "gateway = 'GW_D' AND fee = 0 AS no_fee",
    )
    return rows.selectExpr(
        "gateway",
        f"""CASE WHEN gateway = 'GW_C' AND part % 500 = 0 THEN concat('ADJ_', part)
                 WHEN gateway = 'GW_A' AND part % 499 = 0 THEN {_quoted("concat('w-', order_id)")}
                 ELSE {RAW_ID} END AS raw_order_id""",
        "CAST(gross AS DOUBLE) AS raw_gross",
        """CAST(CASE WHEN credit THEN gross + fee
                     WHEN gateway <> 'GW_D' THEN gross - fee END AS DOUBLE) AS raw_net""",
        """CAST(CASE WHEN credit THEN fee WHEN gateway = 'GW_B' THEN -fee
                     WHEN NOT no_fee THEN fee - tax WHEN gateway <> 'GW_D' THEN 0 END
                AS DOUBLE) AS raw_fee""",
        """CAST(CASE WHEN credit THEN tax WHEN gateway = 'GW_B' THEN -tax
                     WHEN NOT no_fee THEN tax WHEN gateway <> 'GW_D' THEN 0 END
                AS DOUBLE) AS raw_tax""",
        f"""CASE WHEN gateway = 'GW_A' AND refund THEN {_quoted("concat(day, ' 16:24:17')")}
                 WHEN gateway = 'GW_C' THEN concat(day, ' 14:30:00') ELSE day END AS raw_settled_on""",
        "concat_ws('-', gateway, day) AS utr",
        """CASE gateway
             WHEN 'GW_A' THEN CASE WHEN refund THEN 'REFUND' WHEN NOT untyped THEN 'ACQUIRING' END
             WHEN 'GW_B' THEN CASE WHEN refund AND odd THEN 'REFUND' WHEN refund THEN 'REVERSAL'
                                   WHEN NOT untyped THEN 'PAYMENT' END
             WHEN 'GW_C' THEN CASE WHEN refund AND odd THEN 'Refunded' WHEN refund THEN 'Chargebacked'
                                   WHEN NOT untyped THEN 'captured' END
             ELSE CASE WHEN refund THEN 'refund' WHEN untyped THEN 'adjustment' ELSE 'payment' END
           END AS txn_type""",
        "if(refund, 'REFUND', 'PAYMENT') AS payment_type",
        "CASE WHEN odd THEN 'COMPLETED' END AS txn_status",
        "method",
        """CASE WHEN method = 'CARD' THEN
             CASE part % 3 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTER' ELSE 'RUPAY' END END AS network""",
        "CASE WHEN method = 'CARD' THEN if(part % 2 = 0, 'credit', 'debit') END AS card_type",
    )


def ledger_sources(spine: DataFrame) -> dict[str, DataFrame]:
    """The eight ledger tables by name."""
    s = spine.selectExpr(
        "*",
        "CAST(amount + CASE WHEN k % 211 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS paid",
        "date_format(created_date, 'MMM d, yyyy') AS day_name",
        "CAST(created_date AS STRING) AS day",
        "concat('m-', cust) AS mobile",
    )
    booked = s.where("k % 50 <> 0 AND k % 40 <> 4")
    return {
        "ledger_booking": booked.where("k % 10 < 2 AND k % 3 = 0").selectExpr(
            "order_id AS booking_txn_id",
            "paid AS booking_fee",
            "day_name AS created_on",
            "CASE WHEN k % 9 <> 0 THEN if(status = 'SUCCESS', 'TXN_SUCCESS', 'PENDING') END AS resultstatus",
            "flow AS payment_flag",
            "gateway AS payment_gateway_name",
            "cust AS account_id",
            "mobile",
        ),
        "ledger_revenue": booked.where("k % 10 < 4").selectExpr(
            "order_id AS transaction_id",
            "CASE WHEN k % 77 = 0 THEN 0D ELSE paid END AS totalpaid",
            "if(k % 13 = 0, 'cash', 'online') AS mode",
            "day_name AS recharge_dt",
            "flow AS plan_type",
            "cust AS account_id",
            "mobile",
        ),
        "ledger_net_income": booked.where(
            "k % 10 = 4 OR (k % 10 = 2 AND k % 3 = 0)"
        ).selectExpr(
            "order_id AS txn_id",
            "paid AS amount",
            "day AS txn_dt",
            "if(k % 17 = 0, 'cash', 'online') AS mode",
            "'wallet' AS rev_mode",
            "concat('p-', cust % 100) AS partner",
            "mobile",
        ),
        "ledger_mobile": booked.where("k % 10 = 6").selectExpr(
            "order_id AS transaction_id", "paid AS pay_amount", "day AS createdate"
        ),
        "ledger_deposit": booked.where("k % 10 = 7").selectExpr(
            "order_id AS sd_txn_id",
            "CASE WHEN k % 3 = 0 THEN hub_txn_id ELSE order_id END AS transaction_id",
            "paid AS sd_amount",
            "day_name AS created_on",
            "cust AS account_id",
            "mobile",
        ),
        "ledger_ott": booked.where("k % 10 = 8").selectExpr(
            "order_id AS transaction_id", "paid AS pay_amount", "day AS createdate"
        ),
        "ledger_topup": booked.where("k % 10 = 5").selectExpr(
            "order_id AS transaction_id",
            "paid AS amount",
            "CASE WHEN k % 4 = 1 THEN day_name ELSE concat(day, ' 10:00:00') END AS datetime",
        ),
        # Some of these orders are in a main ledger too, and some are not refunded yet.
        "ledger_refunded": s.where("k % 100 = 0 OR k % 110 = 2").selectExpr(
            "order_id AS transaction_id",
            "paid AS pay_amount",
            "CAST(k % 300 <> 0 AS BIGINT) AS refund_status",
            "CAST(date_add(created_date, 5) AS STRING) AS dt",
            "'online' AS payment_mode",
            "if(k % 4 = 0, 'PAID', 'REVERSED') AS payment_status",
            "concat('type', k % 3) AS payment_type",
            "'REFUNDED' AS txn_status",
            "mobile",
        ),
    }


def bank_feed(settlement: DataFrame, gateway_refund: DataFrame, spine: DataFrame) -> DataFrame:
    """Daily deposits: 99.5 % of the expected transfer, with days missing on either side."""
    day = ["gateway", "settled_date"]
    netted = group(
        gateway_refund.where("gateway = 'GW_A'"), day, "sum(settled_amount) AS netted"
    )
    matched = (
        group(
            settlement.where("day(settled_date) NOT IN (7, 21)"),
            day,
            "count_if(is_forward) AS n_forward",
            "coalesce(sum(CASE WHEN is_forward THEN sett_net END), 0) AS forward",
            "coalesce(sum(CASE WHEN is_refund THEN sett_net END), 0) AS stray",
        )
        .join(netted, day, "left")
        .selectExpr(
            "gateway",
            "settled_date AS day",
            f"""CAST(CAST(CASE WHEN n_forward = 0 THEN stray ELSE forward - coalesce(netted, 0) END
                 AS {MONEY}) * 0.995BD AS {MONEY}) AS amount""",
        )
    )
    # Deposits from before the first settlement file.
    early = group(
        spine.where("created_date < DATE'1995-02-01'").selectExpr(
            "gateway", "date_sub(created_date, 365) AS day", "amount"
        ),
        ["gateway", "day"],
        f"CAST(CAST(sum(amount) AS {MONEY}) * 0.01BD AS {MONEY}) AS amount",
    )
    return matched.unionByName(early).selectExpr(
        "CAST(concat(day, ' 11:00:00') AS TIMESTAMP_NTZ) AS transaction",
        f"{bank_label('gateway')} AS payment_gateway",
        "CAST(amount AS DOUBLE) AS deposit_amt",
        "concat_ws(' ', 'RTGS', gateway, day) AS transaction_remarks",
        "date_format(day, 'MMM-yy') AS month",
    )

