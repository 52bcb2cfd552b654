"""From delivered CSV files to the canonical relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallychain.config import LEDGERS
from tallychain.sources import files, relations
from tallychain.sources.tables import Landed, csv_load_all


def land(spark: SparkSession, patterns: dict[str, str], out_root: str) -> dict[str, Landed]:
    """Load source files by table name with their declared schemas; see ``tables.load_report``."""
    unknown = sorted(set(patterns) - set(files.SCHEMAS))
    if unknown:
        raise ValueError(f"no schema for {unknown}")
    return csv_load_all(spark, patterns, out_root, files.SCHEMAS, files.ALIASES)


def relations_of(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every relation whose source tables are given, by name."""
    gateways = ["gw_a", "gw_b", "gw_c"]
    makers = {
        "hub": (["hub_txn"], relations.hub),
        "hub_refund": (["hub_refund"], relations.hub_refund),
        "gateway_txn": (
            [*(f"{g}_txn" for g in gateways), "gw_d_txn"],
            lambda *t: relations.gateway_txn(files.gateway_txn_feed(*t)),
        ),
        "settlement": (
            [*(f"{g}_settlement" for g in gateways), "gw_d_txn"],
            lambda *t: relations.settlement(files.settlement_feed(*t)),
        ),
        "gateway_refund": (
            ["gw_a_refund", "gw_b_refund", "gw_d_txn"],
            lambda *t: relations.gateway_refund(files.gateway_refund_feed(*t)),
        ),
        "ledger": (
            [x.table for x in LEDGERS],
            lambda *t: relations.ledger({x.table: df for x, df in zip(LEDGERS, t)}),
        ),
        "bank": (["bank_deposit"], lambda t: relations.bank(files.bank_feed(t))),
    }
    return {
        name: make(*[tables[n] for n in needs])
        for name, (needs, make) in makers.items()
        if all(n in tables for n in needs)
    }
