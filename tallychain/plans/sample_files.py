"""The derived feeds split into the files each gateway, the hub, the ledgers and the bank deliver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tallychain.plans import sample
from tallychain.sources.files import ALIASES, SCHEMAS


def settlement_files(feed: DataFrame) -> dict[str, DataFrame]:
    def of(gateway: str) -> DataFrame:
        return feed.where(f"gateway = '{gateway}'")

    return {
        "gw_a_settlement": of("GW_A").selectExpr(
            "raw_order_id AS order_id", "raw_gross AS amount", "raw_net AS settled_amount",
            "raw_fee AS commission", "raw_tax AS gst",
            "CAST(left(btrim(raw_settled_on, chr(39)), 10) AS DATE) AS settled_date",
            "utr AS utr_no", "txn_type AS transaction_type",
        ),
        "gw_b_settlement": of("GW_B").selectExpr(
            "raw_order_id AS `Merchant Order Id`", "raw_gross AS `Transaction Amount`",
            "raw_net AS `Net Amount`", "raw_fee AS `Total Fees`", "raw_tax AS IGST",
            "CAST(raw_settled_on AS TIMESTAMP_NTZ) AS `Settlement Date`", "utr AS `Settlement UTR`",
            "txn_type AS `Transaction Type`", "payment_type AS `Payment Type`",
            "txn_status AS `Transaction Status`", "method AS Mode",
        ),
        "gw_c_settlement": of("GW_C").selectExpr(
            "raw_order_id AS `Merchant Txn ID`", "raw_gross AS Amount", "raw_net AS `Net Amount`",
            "raw_fee AS `Total Processing fees`", "raw_tax AS `Service Tax`",
            "raw_settled_on AS AddedOn", "utr AS `Merchant UTR`", "txn_type AS Status",
        ),
        "gw_d_txn": of("GW_D").selectExpr(
            "raw_order_id AS order_receipt", "raw_gross AS amount", "raw_fee AS fee",
            "raw_tax AS tax", "txn_type AS type", "CAST(raw_settled_on AS DATE) AS settled_at",
            "utr AS settlement_utr", "method", "network AS card_network", "card_type",
        ),
    }


_D_COLUMNS = [
    "order_receipt", "payment_id", "amount", "fee", "tax", "credit", "debit", "type", "settled",
    "settled_at", "settlement_id", "settlement_utr", "method", "card_network", "card_type", "created_at",
]


def _gw_d(df: DataFrame) -> DataFrame:
    """All columns of GW_D's file; those that ``df`` does not have are empty."""
    return df.selectExpr(*[c if c in df.columns else f"CAST(NULL AS STRING) AS {c}" for c in _D_COLUMNS])


def txn_files(feed: DataFrame) -> dict[str, DataFrame]:
    def of(gateway: str) -> DataFrame:
        return feed.where(f"gateway = '{gateway}'")

    return {
        "gw_a_txn": of("GW_A").selectExpr(
            "raw_order_id AS Order_ID", "concat('t', raw_order_id) AS Transaction_ID",
            "raw_amount AS Amount", "raw_status AS Status", "raw_date AS Transaction_Date",
        ),
        "gw_b_txn": of("GW_B").selectExpr(
            "raw_order_id AS `Merchant Order Id`", "raw_amount AS `Transaction Amount`",
            "raw_status AS `Transaction Status`",
            "CAST(raw_date AS TIMESTAMP_NTZ) AS `Transaction Date`",
        ),
        "gw_c_txn": of("GW_C").selectExpr(
            "raw_order_id AS txnid", "raw_amount AS amount", "raw_status AS status", "mode",
            "raw_date AS addedon", "bank_name", "discount", "0D AS additional_charges",
            "raw_amount AS `amount(inr)`", "subvention AS merchant_subvention_amount",
            "error_description AS errorDescription",
        ),
        "gw_d_txn": _gw_d(
            of("GW_D").selectExpr(
                "raw_order_id AS order_receipt", "raw_amount AS amount", "raw_status AS type",
                "mode AS method", "CAST(raw_date AS TIMESTAMP_NTZ) AS created_at",
            )
        ),
    }


def refund_files(feed: DataFrame) -> dict[str, DataFrame]:
    def of(gateway: str) -> DataFrame:
        return feed.where(f"gateway = '{gateway}'")

    return {
        "gw_a_refund": of("GW_A").selectExpr(
            "raw_refund_id AS Order_ID", "raw_original_id AS Ref_Txn_ID", "raw_amount AS Amount",
            "raw_settled_amount AS Settled_Amount", "raw_settled_on AS Settled_Date",
            "raw_txn_date AS Transaction_Date", "'SUCCESS' AS Status",
        ),
        "gw_b_refund": of("GW_B").selectExpr(
            "raw_refund_id AS `Merchant Order Id`", "raw_original_id AS `Forward Merchant Txn Id`",
            "raw_amount AS `Total Refund Amount`",
            "CAST(raw_txn_date AS TIMESTAMP_NTZ) AS `Transaction Date`",
        ),
        "gw_d_txn": _gw_d(
            of("GW_D").selectExpr(
                "raw_refund_id AS order_receipt", "raw_amount AS amount",
                "raw_settled_amount AS debit", "'refund' AS type",
                "CAST(raw_settled_on AS DATE) AS settled_at",
                "CAST(raw_txn_date AS TIMESTAMP_NTZ) AS created_at",
            )
        ),
    }


def bank_file(feed: DataFrame) -> DataFrame:
    return feed.selectExpr(
        "transaction AS Transaction", "payment_gateway AS `Payment Gateway`",
        "deposit_amt AS `Deposit Amt(INR)`", "transaction_remarks AS `Transaction Remarks`",
        "month AS Month",
    )


def source_files(c) -> dict[str, DataFrame]:
    """Every source file of a chain. GW_D's holds payments and, settled, the same again by line."""
    settled, paid = settlement_files(c.settlement_feed), txn_files(c.gateway_txn_feed)
    refunds = refund_files(c.gateway_refund_feed)
    ledgers = dict(c.ledger_sources)
    # As delivered: the amount column of two ledgers is misspelt.
    for name in ("ledger_mobile", "ledger_refunded"):
        ledgers[name] = ledgers[name].withColumnRenamed("pay_amount", "PAY_AMMOUNT")
    out = {
        **ledgers,
        "hub_txn": sample.hub_txn(c.spine),
        "hub_refund": sample.hub_refund(c.spine),
        "gw_a_txn": paid["gw_a_txn"],
        "gw_b_txn": paid["gw_b_txn"],
        "gw_c_txn": paid["gw_c_txn"],
        "gw_d_txn": paid["gw_d_txn"].unionByName(_gw_d(settled["gw_d_txn"])),
        "gw_a_settlement": settled["gw_a_settlement"],
        "gw_b_settlement": settled["gw_b_settlement"],
        "gw_c_settlement": settled["gw_c_settlement"],
        "gw_a_refund": refunds["gw_a_refund"],
        "gw_b_refund": refunds["gw_b_refund"],
        "bank_deposit": bank_file(c.bank_feed),
    }
    return {name: _with_all_columns(name, df) for name, df in out.items()}


def _with_all_columns(name: str, df: DataFrame) -> DataFrame:
    """Declared columns that nothing is derived for are delivered empty."""
    have = {ALIASES.get(c.lower(), c.lower()) for c in df.columns}
    empty = [f.name for f in StructType.fromDDL(SCHEMAS[name]).fields if f.name.lower() not in have]
    return df.selectExpr("*", *[f"CAST(NULL AS STRING) AS `{c}`" for c in empty])
