"""Control totals that must hold on any data."""

from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.operators import base, hub_gateway, ledger_hub, settlements
from tallychain.session import shared_dir
from tallychain.sources import warehouse


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_statuses_partition_the_base_table(stored):
    summary = base.recon_summary(stored.base)
    rows = {(r.gateway, r.trace_status): r.n_rows for r in summary.collect()}
    detail = sum(n for (g, s), n in rows.items() if g != "ALL" and s != "ALL")
    assert detail == rows["ALL", "ALL"] == stored.settlement.where("is_forward").count()


def test_base_has_one_row_per_forward_settlement_row(stored):
    assert stored.base.count() == stored.settlement.where("is_forward").count()
    dup = stored.hub.groupBy("gateway", "settle_key").count().where("count > 1").count()
    assert dup == 0


def test_gross_less_fee_is_net(stored):
    wrong = stored.settlement.where("NOT (gateway = 'GW_B' AND is_refund) AND sett_gross - sett_fee <> sett_net")
    assert wrong.count() == 0


def test_matched_and_unmatched_add_up(stored):
    counts = ledger_hub.l1_match_counts(stored.ledger, stored.hub)
    assert counts.where("matched + unmatched <> ledger_rows").count() == 0
    assert total(counts, "ledger_rows") == stored.ledger.count()


def test_layer2_parts_add_up(stored):
    r = hub_gateway.l2_summary(stored.hub, stored.gateway_txn).where("gateway = 'ALL'").first()
    assert r.matched_ids + r.hub_only_ids == r.hub_ids == stored.hub.where("status = 'SUCCESS'").count()


def test_universe_covers_every_settlement_row(stored):
    universe = settlements.settlement_universe(
        stored.settlement, stored.gateway_txn, stored.hub, "1996-01"
    )
    assert total(universe, "sett_rows") == stored.settlement.count()


def test_forward_and_reverse_paths_agree(stored):
    forward = total(settlements.amount_bridge(stored.hub, stored.gateway_txn, stored.settlement), "gross")
    keys = stored.gateway_txn.select("gateway", F.col("gw_key").alias("settlement_order_id")).distinct()
    ok = stored.base.where("hub_status = 'SUCCESS'").join(keys, ["gateway", "settlement_order_id"], "left_semi")
    assert total(ok, "sett_gross") == forward


def test_settlement_export_layout(stored):
    rows = base.gap_export_settlement(stored.base)
    assert len(rows.columns) == 10
    assert {r.trace_status for r in rows.select("trace_status").distinct().collect()} == {
        "MISSING_HUB", "PG_ADJUSTMENT",
    }
    assert len(base.gap_export_hub(stored.base).columns) == 14


def test_a_period_equals_its_share_of_the_whole(stored):
    month = Period.month("1996-01")
    part = base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank, month)
    whole = stored.base.where("recon_month = '1996-01'")
    assert part.count() == whole.count() > 0
    assert part.exceptAll(whole).count() == 0


def test_created_period_scopes_every_layer(stored):
    month = Period.month("1996-01")
    scope = stored.hub.where("status = 'SUCCESS' AND source_month = '1996-01'")
    n = scope.count()
    hub, gws, sett = stored.hub, stored.gateway_txn, stored.settlement
    assert total(hub_gateway.scope_by_gateway(hub, month), "hub_ids") == n > 0
    assert total(hub_gateway.l2_matched(hub, gws, month), "hub_ids") == n
    matched = total(hub_gateway.l2_matched(hub, gws, month), "matched_ids")
    only = total(hub_gateway.l2_hub_only(hub, gws, month), "hub_only_ids") or 0
    assert matched + only == n
    settled = settlements.l3_summary(hub, gws, sett, month).where("gateway = 'ALL'").first()
    assert settled.hub_txns == matched
    unsettled = total(settlements.l3_unsettled(hub, gws, sett, month), "unsettled") or 0
    assert settled.settled_txns + unsettled == matched


def test_monthly_storage_returns_the_same_rows(spark, stored):
    path = f"{shared_dir(spark, 'monthly')}/settlement"
    warehouse.store(stored.settlement, path, "settled_date")
    back = spark.read.parquet(path).drop("file_month").select(*stored.settlement.columns)
    assert back.count() == stored.settlement.count()
    assert back.exceptAll(stored.settlement).count() == 0
