"""Physical plans: what must hold when the data is a thousand times larger."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.functions import dates
from tallychain.operators import base, hub_gateway, settlements
from tallychain.operators.frames import pick_first
from tallychain.plans import registry
from tallychain.session import local_session, shared_dir
from tallychain.sources import sinks, warehouse


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", list(registry.plans()))
def test_no_query_uses_a_nested_loop_or_python(name, stored):
    plan = plan_of(registry.run(name, stored))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan


def test_period_reaches_the_scan(derived):
    plan = plan_of(derived.orders.where(dates.in_period("o_orderdate", Period.month("1996-01"))))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan)


def test_month_filter_prunes_stored_partitions(spark, derived):
    root = shared_dir(spark, "plans")
    warehouse.store(derived.hub, f"{root}/hub", "created_date")
    months = spark.read.parquet(f"{root}/hub").where("file_month = '1996-01'")
    assert re.search(r"PartitionFilters: \[.*1996-01", plan_of(months))
    want = derived.hub.where(dates.in_period("created_date", Period.month("1996-01"))).count()
    assert months.count() == want > 0


def test_a_monthly_run_opens_only_its_month(spark, derived):
    root = shared_dir(spark, "run")
    registry.store_chain(derived, root)
    chain = registry.StoredChain(spark, derived.root, root)
    month = Period.month("1996-01")
    monthly = chain.month(month)
    scans = plan_of(monthly.base).split("FileScan")[1:]
    scan = next(s for s in scans if "sett_gross" in s.split("PartitionFilters")[0])
    assert re.search(r"PartitionFilters: \[.*file_month", scan)
    assert monthly.base.count() == derived.base.where("recon_month = '1996-01'").count() > 0
    assert monthly.bank.count() == derived.bank.where(dates.in_period("bank_date", month)).count()


def test_only_used_columns_are_read(stored, capsys):
    plan = formatted(settlements.settlement_type_mix(stored.settlement), capsys)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "sett_utr" not in schema and "card_type" not in schema


def test_settlement_rows_are_shuffled_once_for_the_base_table(stored):
    plan = plan_of(base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank))
    # Exchanges whose keys are the settlement id; the deposits arrive by broadcast.
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*settlement_order_id", plan)) <= 1
    assert not re.search(r"Exchange hashpartitioning\([^)]*settled_date", plan)


def test_pick_first_limits_groups_before_the_shuffle(stored):
    plan = plan_of(pick_first(stored.ledger, ["order_id"], "priority", "ledger_amount"))
    limit = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert limit > plan.index("Exchange"), "a limit must sit below the exchange"


def test_ledger_lookup_is_a_hash_aggregate(stored):
    plan = plan_of(base.ledger_lookup(stored.ledger))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_both_layers_are_paired_without_a_join(stored):
    assert "Join" not in plan_of(hub_gateway.paired(stored.hub, stored.gateway_txn))


@pytest.fixture
def small_limits(spark):
    """Skew limits small enough for a test, and no broadcast that would hide the shuffle."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_settlements(spark, n=60000):
    """A third of all rows share one id."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END"
    return spark.range(0, n, 1, 8).selectExpr(
        "'GW_A' AS gateway", f"{key} AS settlement_order_id", "DATE'2026-01-02' AS settled_date",
        "CAST(10 AS DECIMAL(18,2)) AS sett_gross", "CAST(9 AS DECIMAL(18,2)) AS sett_net",
        "CAST(1 AS DECIMAL(18,2)) AS sett_fee", "uuid() AS sett_utr", "'ACQUIRING' AS sett_txn_type",
        "true AS is_forward",
    )


def test_a_hot_settlement_id_is_split(small_limits):
    spark = small_limits
    sett = hot_settlements(spark)
    hub = sett.select("settlement_order_id").distinct().selectExpr(
        "settlement_order_id AS order_id", "settlement_order_id AS hub_txn_id",
        "settlement_order_id AS settle_key", "'GW_A' AS gateway", "CAST(10 AS DECIMAL(18,2)) AS amount",
        "'SUCCESS' AS status", "DATE'2026-01-01' AS created_date", "'2026-01' AS source_month",
    )
    root = shared_dir(spark, "hot")
    sett.write.parquet(f"{root}/s")
    hub.write.parquet(f"{root}/h")
    ledger = spark.createDataFrame(
        [("hot", "ledger_revenue", Decimal(10), 2, True)],
        "order_id string, ledger_table string, ledger_amount decimal(18,2), priority int, in_scope boolean",
    )
    bank = spark.createDataFrame(
        [("GW_A", date(2026, 1, 2), Decimal(5))], "gateway string, bank_date date, deposit decimal(18,2)"
    )
    out = base.recon_base(spark.read.parquet(f"{root}/s"), spark.read.parquet(f"{root}/h"), ledger, bank)
    report = out.groupBy("trace_status").agg(F.count("*").alias("count"), F.max("sett_utr"))
    got = {r.trace_status: r["count"] for r in report.collect()}
    assert got == {"FULLY_TRACED": 20000, "MISSING_LEDGER": 40000}
    assert "skew=true" in plan_of(report)


def test_a_lost_month_is_rewritten_and_others_stay(spark):
    root = shared_dir(spark, "months")
    df = spark.createDataFrame(
        [("a", date(2026, 1, 5)), ("b", date(2026, 2, 5))], "order_id string, created_date date"
    )
    warehouse.store(df, root, "created_date")
    warehouse.store(df.where("order_id = 'b'").selectExpr("'c' AS order_id", "created_date"), root, "created_date")
    rows = spark.read.parquet(root).select("order_id").collect()
    assert sorted(r.order_id for r in rows) == ["a", "c"]


def test_local_session_is_reused(spark):
    assert local_session(4).sparkContext.applicationId == spark.sparkContext.applicationId


def test_key_coverage_hashes_one_count_an_id_and_member(derived):
    """The columns of all members side by side are made in a window, not in a hash table of all ids."""
    plan = plan_of(registry.run("key_link_coverage", derived))
    hashed = [x for x in plan.splitlines() if "Aggregate(" in x and "id#" in x.split("functions")[0]]
    assert hashed and all("functions=[count(1)]" in x or "functions=[partial_count(1)]" in x for x in hashed), hashed


def test_deposits_are_broadcast_from_the_start(small_limits, stored):
    """Unasked, Spark starts to shuffle the wide rows before it knows how few days there are."""
    plan = plan_of(base.with_deposits(stored.settlement, stored.bank))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_relations_are_kept_as_they_are(derived, tmp_path):
    known = registry.kept(derived, str(tmp_path), "settlement", "bank")
    assert "Join" not in plan_of(known.settlement) and "Join" not in plan_of(known.bank)
    for name in ("settlement", "bank"):
        was, now = getattr(derived, name), getattr(known, name)
        assert now.columns == was.columns and now.exceptAll(was).count() == was.exceptAll(now).count() == 0


def test_the_settlement_feed_is_joined_once_for_all_files(derived, monkeypatch):
    plans, export = [], sinks.csv_export

    def watched(df, path, **options):
        plans.append(plan_of(df))
        export(df, path, **options)

    monkeypatch.setattr(sinks, "csv_export", watched)
    registry.run("recon_base_from_files", derived)
    assert plans and not [p for p in plans if "l_orderkey#" in p]
