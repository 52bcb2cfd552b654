"""Settlements and orders stored alike: the same base, no exchange, hot keys over several files."""

import pytest
from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.operators import base
from tallychain.session import shared_dir
from tallychain.sources import copartitioned as alike
from tests.oracle_check import rows_of
from tests.test_plans import hot_settlements, plan_of

LEDGER = "order_id string, ledger_table string, ledger_amount decimal(18,2), priority int, in_scope boolean"


def rows(df):
    return rows_of(df.columns, df.collect())


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def layout(spark, stored):
    """Keys with four rows or more are split."""
    root = shared_dir(spark, "alike")
    return alike.store_alike(stored.settlement, stored.hub, stored.ledger, root, 4, rows_per_part=3)


def test_the_base_is_the_same(spark, stored, layout):
    expected = base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank)
    assert spark.read.parquet(f"{layout.root}/split").count() > 50
    assert rows(alike.recon_base_alike(spark, layout, stored.bank)) == rows(expected)


def test_neither_side_is_shuffled(no_broadcast, layout):
    plan = plan_of(alike.settled_orders(no_broadcast, layout))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_a_period_reads_its_months(no_broadcast, stored, layout):
    month = Period.month("1996-01")
    got = alike.recon_base_alike(no_broadcast, layout, stored.bank, month)
    expected = base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank, month)
    assert rows(got) == rows(expected)
    joined = alike.settled_orders(no_broadcast, layout, month)
    assert "Exchange" not in plan_of(joined)
    assert "PartitionFilters: [isnotnull(file_month" in joined._jdf.queryExecution().toString()


def test_a_later_session_opens_it(spark, stored, layout):
    again = alike.opened(spark, layout.root, 4)
    assert again != layout
    assert alike.settled_orders(spark, again).count() == stored.settlement.where("is_forward").count()


def test_months_are_replaced_and_others_stay(spark, stored):
    late = "settled_date >= '1996-03-01' AND settled_date < '1996-05-01' AND abs(hash(sett_utr)) % 3 = 0"
    first = stored.settlement.where(f"NOT coalesce({late}, false)")
    root = shared_dir(spark, "alike")
    layout = alike.store_alike(first, stored.hub, stored.ledger, root, 4, rows_per_part=3)
    expected = base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank)
    assert rows(alike.recon_base_alike(spark, layout, stored.bank)) != rows(expected)
    touched = stored.settlement.where("settled_date >= '1996-03-01' AND settled_date < '1996-05-01'")
    alike.replace_months(spark, layout, touched)
    assert rows(alike.recon_base_alike(spark, layout, stored.bank)) == rows(expected)
    again = alike.opened(spark, root, 4)
    assert rows(alike.recon_base_alike(spark, again, stored.bank)) == rows(expected)


def test_a_hot_key_and_rows_without_key_lie_in_several_files(no_broadcast):
    spark = no_broadcast
    root = shared_dir(spark, "alike-hot")
    sett = hot_settlements(spark).withColumn(
        "settlement_order_id", F.expr("if(settlement_order_id LIKE 'k%7', NULL, settlement_order_id)")
    )
    sett.write.parquet(f"{root}/s")
    sett = spark.read.parquet(f"{root}/s")
    hub = sett.select("settlement_order_id").distinct().selectExpr(
        "settlement_order_id AS order_id", "settlement_order_id AS hub_txn_id",
        "settlement_order_id AS settle_key", "'GW_A' AS gateway", "CAST(10 AS DECIMAL(18,2)) AS amount",
        "'SUCCESS' AS status", "DATE'2026-01-01' AS created_date", "'2026-01' AS source_month",
    )
    ledger = spark.createDataFrame([("hot", "ledger_revenue", None, 2, True)], LEDGER)
    layout = alike.store_alike(sett, hub, ledger, f"{root}/alike", 16, rows_per_part=500)
    assert [(r.gw_key, r.parts) for r in spark.read.parquet(f"{root}/alike/split").collect()] == [("hot", 40)]
    joined = alike.settled_orders(spark, layout)
    assert "Exchange" not in plan_of(joined)
    kinds = joined.groupBy(F.coalesce(F.substring("gw_key", 1, 1), F.lit("null")).alias("kind"))
    got = {r.kind: (r.n, r.found) for r in kinds.agg(F.count("*").alias("n"), F.count("hub_order_id").alias("found")).collect()}
    n = {r.kind: r["count"] for r in sett.groupBy(F.expr("coalesce(left(settlement_order_id, 1), 'null')").alias("kind")).count().collect()}
    assert got == {"h": (20000, 20000), "k": (n["k"], n["k"]), "null": (n["null"], 0)}
    # No task of the join has more than a few times its share of any kind of row.
    sizes = joined.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 4 * 60000 / 16


def test_empty_tables(spark, stored):
    root = shared_dir(spark, "alike-empty")
    layout = alike.store_alike(stored.settlement.limit(0), stored.hub, stored.ledger, root, 2)
    assert alike.recon_base_alike(spark, layout, stored.bank).count() == 0
    root = shared_dir(spark, "alike-empty")
    layout = alike.store_alike(stored.settlement, stored.hub.limit(0), stored.ledger, root, 2)
    joined = alike.recon_base_alike(spark, layout, stored.bank)
    assert joined.count() == stored.settlement.where("is_forward").count()
    assert joined.where("hub_order_id IS NOT NULL").count() == 0


def test_rows_without_a_date_stay(spark, stored):
    undated = stored.settlement.withColumn(
        "settled_date", F.expr("if(abs(hash(settlement_order_id)) % 50 = 0, NULL, settled_date)")
    )
    layout = alike.store_alike(undated, stored.hub, stored.ledger, shared_dir(spark, "alike-null"), 2)
    expected = base.recon_base(undated, stored.hub, stored.ledger, stored.bank)
    got = alike.recon_base_alike(spark, layout, stored.bank)
    assert got.where("settled_date IS NULL").count() > 0
    assert rows(got) == rows(expected)
    alike.replace_months(spark, layout, undated.where("settled_date IS NULL"))
    assert rows(alike.recon_base_alike(spark, layout, stored.bank)) == rows(expected)
    alike.forget(spark, layout)
    assert not spark.catalog.tableExists(layout.settlement)
    assert rows(alike.recon_base_alike(spark, alike.opened(spark, layout.root, 2), stored.bank)) == rows(expected)


def test_buckets_follow_the_rows(spark, stored):
    """A task sorts a bucket: a fixed number of them would grow with the tables."""
    n = stored.settlement.where("is_forward").count()
    root = shared_dir(spark, "alike-grown")
    grown = alike.store_alike(
        stored.settlement, stored.hub, stored.ledger, root, 4, rows_per_part=3, rows_per_bucket=n // 9
    )
    assert grown.buckets == -(-n // (n // 9)) > 4
    expected = base.recon_base(stored.settlement, stored.hub, stored.ledger, stored.bank)
    assert rows(alike.recon_base_alike(spark, grown, stored.bank)) == rows(expected)
    none = stored.settlement.limit(0)
    root = shared_dir(spark, "alike-few")
    assert alike.store_alike(none, stored.hub, stored.ledger, root, 2, rows_per_bucket=10).buckets == 2
