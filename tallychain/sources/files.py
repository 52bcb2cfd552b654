"""Schemas of the source files and their mapping onto the common feeds.

Every file is read with its declared schema, bound by header name; delivered
files hold many more columns. The four gateways deliver the same
facts under different columns; each mapping here only renames, and all cleaning
happens once, in ``relations``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallychain.operators.frames import union_all

# Column names and types as delivered.
SCHEMAS = {
    "hub_txn": """order_id STRING, hub_txn_id STRING, amount DOUBLE, order_status STRING,
        payment_status STRING, payment_gateway STRING, order_date_created STRING,
        customer_id STRING, payment_flow STRING""",
    "hub_refund": """order_id STRING, refund_txn_id STRING, refund_unique_id STRING,
        refund_amount DECIMAL(18,2), refund_status STRING, refund_type STRING, refund_date STRING,
        payment_gateway STRING""",
    "gw_a_txn": """Order_ID STRING, Transaction_ID STRING, Amount DOUBLE, Status STRING,
        Transaction_Date STRING""",
    "gw_b_txn": """`Merchant Order Id` STRING, `Transaction Amount` DECIMAL(18,2),
        `Transaction Status` STRING, `Transaction Date` TIMESTAMP_NTZ""",
    "gw_c_txn": """txnid STRING, amount DOUBLE, status STRING, mode STRING, addedon STRING,
        bank_name STRING, discount DOUBLE, additional_charges DOUBLE, `amount(inr)` DOUBLE,
        merchant_subvention_amount DOUBLE, errorDescription STRING""",
    "gw_d_txn": """order_receipt STRING, payment_id STRING, amount DOUBLE, fee DOUBLE, tax DOUBLE,
        credit DOUBLE, debit DOUBLE, type STRING, settled INT, settled_at DATE,
        settlement_id STRING, settlement_utr STRING, method STRING, card_network STRING,
        card_type STRING, created_at TIMESTAMP_NTZ""",
    "gw_a_settlement": """order_id STRING, amount DOUBLE, settled_amount DOUBLE, commission DOUBLE,
        gst DOUBLE, settled_date DATE, utr_no STRING, transaction_type STRING, payout_date DATE""",
    "gw_b_settlement": """`Merchant Order Id` STRING, `Transaction Amount` DOUBLE,
        `Net Amount` DOUBLE, `Total Fees` DOUBLE, Fee DOUBLE, IGST DOUBLE,
        `Settlement Date` TIMESTAMP_NTZ, `Settlement UTR` STRING, `Transaction Type` STRING,
        `Payment Type` STRING, `Transaction Status` STRING, Mode STRING, Instrument STRING""",
    "gw_c_settlement": """`Merchant Txn ID` STRING, Amount DOUBLE, `Net Amount` DOUBLE,
        `Total Processing fees` DOUBLE, `Service Tax` DOUBLE, AddedOn STRING,
        `Merchant UTR` STRING, Status STRING""",
    "gw_a_refund": """Order_ID STRING, Ref_Txn_ID STRING, Amount DOUBLE, Settled_Amount DOUBLE,
        Settled_Date STRING, Transaction_Date STRING, Status STRING""",
    "gw_b_refund": """`Merchant Order Id` STRING, `Forward Merchant Txn Id` STRING,
        `Total Refund Amount` DOUBLE, `Transaction Date` TIMESTAMP_NTZ""",
    "bank_deposit": """Transaction TIMESTAMP_NTZ, `Payment Gateway` STRING,
        `Deposit Amt(INR)` DOUBLE, `Transaction Remarks` STRING, Month STRING""",
    "ledger_booking": """booking_txn_id STRING, booking_fee DECIMAL(18,2), created_on STRING,
        resultstatus STRING, payment_flag STRING, payment_gateway_name STRING, account_id BIGINT,
        mobile STRING""",
    "ledger_revenue": """transaction_id STRING, totalpaid DECIMAL(18,2), mode STRING, recharge_dt STRING,
        plan_type STRING, account_id BIGINT, mobile STRING""",
    "ledger_net_income": """txn_id STRING, amount DECIMAL(18,2), txn_dt STRING, mode STRING,
        rev_mode STRING, partner STRING, mobile STRING""",
    "ledger_topup": "transaction_id STRING, amount DOUBLE, datetime STRING",
    "ledger_mobile": "transaction_id STRING, pay_amount DOUBLE, createdate TIMESTAMP_NTZ",
    "ledger_refunded": """transaction_id STRING, pay_amount DECIMAL(18,2), refund_status BIGINT, dt DATE,
        payment_mode STRING, payment_status STRING, payment_type STRING, txn_status STRING,
        mobile STRING""",
    "ledger_deposit": """sd_txn_id STRING, transaction_id STRING, payment_gateway_txn_id STRING,
        sd_amount DOUBLE, created_on STRING, account_id BIGINT, mobile STRING""",
    "ledger_ott": "transaction_id STRING, pay_amount DOUBLE, createdate TIMESTAMP_NTZ",
}

# Spellings of delivered headers that differ from the declared names.
ALIASES = {"pay_ammount": "pay_amount"}

_TEXT = "CAST(NULL AS STRING)"


def settlement_feed(a: DataFrame, b: DataFrame, c: DataFrame, d: DataFrame) -> DataFrame:
    """Three settlement files and the transactions that GW_D settles in place."""
    return union_all(
        [
            a.selectExpr(
                "'GW_A' AS gateway", "order_id AS raw_order_id", "amount AS raw_gross",
                "settled_amount AS raw_net", "commission AS raw_fee", "gst AS raw_tax",
                "CAST(settled_date AS STRING) AS raw_settled_on", "utr_no AS utr",
                "transaction_type AS txn_type",
                "if(transaction_type = 'REFUND', 'REFUND', 'PAYMENT') AS payment_type",
                f"{_TEXT} AS txn_status", f"{_TEXT} AS method", f"{_TEXT} AS network",
                f"{_TEXT} AS card_type",
            ),
            b.selectExpr(
                "'GW_B' AS gateway", "`Merchant Order Id` AS raw_order_id",
                "`Transaction Amount` AS raw_gross", "`Net Amount` AS raw_net",
                "`Total Fees` AS raw_fee", "IGST AS raw_tax",
                "CAST(`Settlement Date` AS STRING) AS raw_settled_on", "`Settlement UTR` AS utr",
                "`Transaction Type` AS txn_type", "`Payment Type` AS payment_type",
                "`Transaction Status` AS txn_status", "Mode AS method", f"{_TEXT} AS network",
                f"{_TEXT} AS card_type",
            ),
            c.selectExpr(
                "'GW_C' AS gateway", "`Merchant Txn ID` AS raw_order_id", "Amount AS raw_gross",
                "`Net Amount` AS raw_net", "`Total Processing fees` AS raw_fee",
                "`Service Tax` AS raw_tax", "AddedOn AS raw_settled_on", "`Merchant UTR` AS utr",
                "Status AS txn_type",
                "if(Status IN ('Refunded', 'Chargebacked'), 'REFUND', 'PAYMENT') AS payment_type",
                f"{_TEXT} AS txn_status", f"{_TEXT} AS method", f"{_TEXT} AS network",
                f"{_TEXT} AS card_type",
            ),
            d.where("settled_at IS NOT NULL").selectExpr(
                "'GW_D' AS gateway", "order_receipt AS raw_order_id", "amount AS raw_gross",
                "CAST(NULL AS DOUBLE) AS raw_net", "fee AS raw_fee", "tax AS raw_tax",
                "CAST(settled_at AS STRING) AS raw_settled_on", "settlement_utr AS utr",
                "type AS txn_type", "if(type = 'refund', 'REFUND', 'PAYMENT') AS payment_type",
                f"{_TEXT} AS txn_status", "method", "card_network AS network", "card_type",
            ),
        ]
    )


def gateway_txn_feed(a: DataFrame, b: DataFrame, c: DataFrame, d: DataFrame) -> DataFrame:
    money = "CAST(NULL AS DOUBLE)"
    none = [
        f"{_TEXT} AS mode", f"{_TEXT} AS bank_name", f"{_TEXT} AS error_description",
        f"{money} AS discount", f"{money} AS subvention",
    ]
    return union_all(
        [
            a.selectExpr(
                "'GW_A' AS gateway", "Order_ID AS raw_order_id", "Amount AS raw_amount",
                "Status AS raw_status", "Transaction_Date AS raw_date", *none,
            ),
            b.selectExpr(
                "'GW_B' AS gateway", "`Merchant Order Id` AS raw_order_id",
                "CAST(`Transaction Amount` AS DOUBLE) AS raw_amount",
                "`Transaction Status` AS raw_status", "CAST(`Transaction Date` AS STRING) AS raw_date",
                *none,
            ),
            c.selectExpr(
                "'GW_C' AS gateway", "txnid AS raw_order_id", "amount AS raw_amount",
                "status AS raw_status", "addedon AS raw_date", "mode", "bank_name",
                "errorDescription AS error_description", "discount",
                "merchant_subvention_amount AS subvention",
            ),
            d.where("type <> 'refund'").selectExpr(
                "'GW_D' AS gateway", "order_receipt AS raw_order_id", "amount AS raw_amount",
                "type AS raw_status", "CAST(created_at AS STRING) AS raw_date", "method AS mode",
                *none[1:],
            ),
        ]
    )


def gateway_refund_feed(a: DataFrame, b: DataFrame, d: DataFrame) -> DataFrame:
    """Two refund files and the refund rows among GW_D's transactions."""
    return union_all(
        [
            a.selectExpr(
                "'GW_A' AS gateway", "Order_ID AS raw_refund_id", "Ref_Txn_ID AS raw_original_id",
                "Amount AS raw_amount", "Settled_Amount AS raw_settled_amount",
                "Settled_Date AS raw_settled_on", "Transaction_Date AS raw_txn_date",
            ),
            b.selectExpr(
                "'GW_B' AS gateway", "`Merchant Order Id` AS raw_refund_id",
                "`Forward Merchant Txn Id` AS raw_original_id",
                "`Total Refund Amount` AS raw_amount", "`Total Refund Amount` AS raw_settled_amount",
                "CAST(`Transaction Date` AS STRING) AS raw_settled_on",
                "CAST(`Transaction Date` AS STRING) AS raw_txn_date",
            ),
            d.where("type = 'refund'").selectExpr(
                "'GW_D' AS gateway", "order_receipt AS raw_refund_id",
                "order_receipt AS raw_original_id", "amount AS raw_amount",
                "debit AS raw_settled_amount", "CAST(settled_at AS STRING) AS raw_settled_on",
                "CAST(created_at AS STRING) AS raw_txn_date",
            ),
        ]
    )


def bank_feed(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "Transaction AS transaction", "`Payment Gateway` AS payment_gateway",
        "`Deposit Amt(INR)` AS deposit_amt", "`Transaction Remarks` AS transaction_remarks",
        "Month AS month",
    )
