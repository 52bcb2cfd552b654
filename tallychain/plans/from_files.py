"""Relations built from the gateways' own file layouts and from landed CSV files."""

from __future__ import annotations

from tallychain.operators.frames import group
from tallychain.plans.registry import Chain, FileChain, body, kept, query
from tallychain.plans.sample_files import bank_file, refund_files, settlement_files, source_files, txn_files
from tallychain.session import shared_dir
from tallychain.sources import files, landed, relations, sinks


@query("settlement_from_files", """
SELECT gateway, settlement_order_id, settled_date, sett_txn_type, payment_type, COUNT(*) AS n_rows,
       SUM(sett_gross)::DOUBLE AS gross, SUM(sett_net)::DOUBLE AS net, SUM(sett_fee)::DOUBLE AS fee
FROM settlement GROUP BY 1, 2, 3, 4, 5""")
def settlement_from_files(c: Chain):
    """The canonical settlements built from the four gateways' separate file layouts."""
    src = settlement_files(c.settlement_feed)
    feed = files.settlement_feed(
        src["gw_a_settlement"], src["gw_b_settlement"], src["gw_c_settlement"], src["gw_d_txn"]
    )
    return group(
        relations.settlement(feed),
        ["gateway", "settlement_order_id", "settled_date", "sett_txn_type", "payment_type"],
        "count(*) AS n_rows",
        "sum(sett_gross) AS gross",
        "sum(sett_net) AS net",
        "sum(sett_fee) AS fee",
    )


@query("txn_from_files", """
SELECT gateway, gw_key, amount::DOUBLE AS amount, status, is_success, txn_date,
       CASE WHEN gateway IN ('GW_C', 'GW_D') THEN mode END AS mode,
       CASE WHEN gateway = 'GW_C' THEN bank_name END AS bank_name,
       CASE WHEN gateway = 'GW_C' THEN error_description END AS error_description,
       CASE WHEN gateway = 'GW_C' THEN discount END::DOUBLE AS discount,
       CASE WHEN gateway = 'GW_C' THEN subvention END::DOUBLE AS subvention
FROM gateway_txn""")
def txn_from_files(c: Chain):
    """Gateway transactions from the four file layouts, which do not all have every fact."""
    src = txn_files(c.gateway_txn_feed)
    feed = files.gateway_txn_feed(*[src[f"gw_{g}_txn"] for g in "abcd"])
    return relations.gateway_txn(feed)


@query("refunds_from_files", """
SELECT gateway, refund_key, original_key, amount::DOUBLE AS amount,
       CASE WHEN gateway = 'GW_B' THEN amount ELSE settled_amount END::DOUBLE AS settled_amount,
       CASE WHEN gateway = 'GW_B' THEN txn_date ELSE settled_date END AS settled_date, txn_date
FROM gateway_refund WHERE gateway <> 'GW_C'""")
def refunds_from_files(c: Chain):
    """Gateway refunds from two files and the refund rows of GW_D; GW_C has no refund file."""
    src = refund_files(c.gateway_refund_feed)
    return relations.gateway_refund(
        files.gateway_refund_feed(src["gw_a_refund"], src["gw_b_refund"], src["gw_d_txn"])
    )


@query("bank_from_files", """
SELECT gateway, bank_label, bank_date, deposit::DOUBLE AS deposit, remarks, month_text FROM bank""")
def bank_from_files(c: Chain):
    return relations.bank(files.bank_feed(bank_file(c.bank_feed)))


@query("recon_base_from_files", body("recon_base"))
def recon_base_from_files(c: Chain):
    """All source files written as CSV, landed by header and traced like any other month."""
    root = shared_dir(c.spark, "landed")
    # Four gateways' files and the bank's come from one feed.
    sources = source_files(kept(c, f"{root}/feed", "settlement_feed"))
    for name, df in sources.items():
        sinks.csv_export(df, f"{root}/files/{name}", compression="gzip")
    loaded = landed.land(c.spark, {n: f"{root}/files/{n}/*.csv.gz" for n in sources}, f"{root}/tables")
    return FileChain(c.spark, c.root, {n: part.rows for n, part in loaded.items()}).base
