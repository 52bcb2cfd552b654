"""The stored base table: refreshed with late rows, looked up by id."""

import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallychain.operators import base, key_filter, refresh
from tallychain.operators.trace import trace_one
from tallychain.plans import registry
from tallychain.session import settings, shared_dir
from tallychain.sources import base_store, sinks
from tests.oracle_check import rows_of
from tests.test_traps import small_chain

registry.plans()
LAYERS = ("settlement", "hub", "ledger", "bank")


def rows(df):
    return rows_of(df.columns, df.collect())


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.fixture(scope="module")
def half(stored):
    """The relations with half a year of settlements."""
    frames = {n: getattr(stored, n) for n in LAYERS}
    frames["settlement"] = stored.settlement.where("settled_date >= '1996-01-01' AND settled_date < '1996-07-01'")
    return frames


@pytest.fixture(scope="module")
def written(spark, half):
    """The base of these, and its index."""
    path, index = shared_dir(spark, "base"), shared_dir(spark, "index")
    sinks.recon_base_write(base.recon_base(*half.values()), path)
    base_store.add_to_index(sinks.read_base(spark, path), index, 4)
    return path, index


#: What arrives late, by layer.
CASES = {
    "hub": {"hub": "abs(hash(order_id)) % 9 = 0"},
    "ledger": {"ledger": "abs(hash(order_id)) % 9 = 0"},
    "bank": {"bank": "day(bank_date) = 9"},
    "settlement": {"settlement": "abs(hash(settlement_order_id, settled_date)) % 9 = 0"},
    "a month": {"settlement": "settled_date >= '1996-05-01' AND settled_date < '1996-06-01'"},
    "all": {
        "hub": "abs(hash(order_id)) % 11 = 0",
        "ledger": "abs(hash(order_id, ledger_table)) % 7 = 0",
        "bank": "month(bank_date) = 3",
        "settlement": "abs(hash(sett_utr)) % 5 = 0",
    },
    "nothing": {"hub": "false", "ledger": "false"},
}


@pytest.mark.parametrize("case", CASES)
def test_a_refresh_equals_a_rebuild(spark, half, case):
    full = half
    conds = CASES[case]
    first = {n: df.where(f"NOT coalesce({conds[n]}, false)") if n in conds else df for n, df in full.items()}
    late = refresh.Late(**{n: full[n].where(cond) for n, cond in conds.items()})
    path, index = shared_dir(spark, "base"), shared_dir(spark, "index")
    sinks.recon_base_write(base.recon_base(*first.values()), path)
    base_store.add_to_index(sinks.read_base(spark, path), index, 4)
    before = rows(sinks.read_base(spark, path))
    months = base_store.refresh(spark, path, *full.values(), late, index, 4)
    expected = rows(base.recon_base(*full.values()).select(sinks.read_base(spark, path).columns))
    after = rows(sinks.read_base(spark, path))
    assert after == expected
    assert (before == after) == (not months) == (case == "nothing")
    # Ids that came late are found too.
    some = sinks.read_base(spark, path).where("hub_order_id IS NOT NULL").orderBy(F.col("hub_order_id").desc()).first()
    found = base_store.look_up(spark, path, index, some.hub_order_id, 4)
    assert rows(found) == rows(trace_one(sinks.read_base(spark, path), some.hub_order_id))


def test_only_touched_months_are_written_again(spark, half):
    full = half
    path = shared_dir(spark, "base")
    day = full["bank"].where("gateway = 'GW_B' AND bank_date > '1996-02-01'").agg(F.min("bank_date")).first()[0]
    is_late = f"gateway = 'GW_B' AND bank_date = DATE'{day}'"
    first = dict(full, bank=full["bank"].where(f"NOT coalesce({is_late}, false)"))
    sinks.recon_base_write(base.recon_base(*first.values()), path)
    before = files(path)
    months = base_store.refresh(spark, path, *full.values(), refresh.Late(bank=full["bank"].where(is_late)))
    assert months == [(f"{day:%Y-%m}", "GW_B")]
    changed = {f for f, t in files(path).items() if before.get(f) != t}
    assert changed and all(f.startswith(f"recon_month={day:%Y-%m}/gateway=GW_B/") for f in changed)


def test_rows_without_an_id_are_refreshed(spark):
    hub, sett, ledger, bank = small_chain(
        spark, [("o1", "t1", 100, "SUCCESS")],
        [("GW_A", "t1", "2026-01-02", 60, 1, "ACQUIRING"), ("GW_A", None, "2026-01-02", 5, 0, "ACQUIRING"),
         ("GW_A", None, "2026-01-02", 7, 0, "ACQUIRING"), ("GW_A", "t9", None, 8, 0, "ACQUIRING")],
        [("o1", "ledger_revenue", "99")],
    )
    path = shared_dir(spark, "base")
    is_late = "sett_gross IN (7, 8)"
    sinks.recon_base_write(base.recon_base(sett.where(f"NOT {is_late}"), hub, ledger, bank), path)
    months = base_store.refresh(spark, path, sett, hub, ledger, bank, refresh.Late(settlement=sett.where(is_late)))
    assert set(months) == {("2026-01", "GW_A"), (None, "GW_A")}
    found = sinks.read_base(spark, path)
    assert rows(found) == rows(base.recon_base(sett, hub, ledger, bank).select(found.columns))


def test_a_refresh_opens_only_touched_months(spark, written):
    rows_of_month = sinks.read_base(spark, written[0]).where(refresh.filed_in([("1996-02", "GW_A"), (None, "GW_B")]))
    held = {(r.recon_month, r.gateway) for r in rows_of_month.select("recon_month", "gateway").distinct().collect()}
    assert held == {("1996-02", "GW_A")}
    assert _scanned(rows_of_month, "numPartitions") == 1


# --- what a write and a refresh leave on disk ----------------------------------------------


def _nodes(df):
    """All nodes of the plan after it ran, those of its stages too."""
    df = df.select("*")
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    stack = [executed]
    while stack:
        node = stack.pop()
        yield node
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())


def _shuffled(df, least_columns=0):
    """Rows that went through a shuffle, of those with so many columns."""
    return sum(
        n.metrics().apply("shuffleRecordsWritten").value() for n in _nodes(df)
        if n.nodeName() == "Exchange" and n.output().size() >= least_columns
    )


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large to be broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_refresh_shuffles_only_what_may_be_touched(no_broadcast, half, written):
    spark, table = no_broadcast, sinks.read_base(no_broadcast, written[0])
    late = refresh.Late(hub=half["hub"].where("abs(hash(order_id)) % 50 = 0"))
    ids = refresh.touched_ids(late, half["hub"])
    id_filter = key_filter.bit_sets(ids, refresh.ID)
    months = refresh.touched_months(late, table, ids, id_filter)
    found = refresh.refreshed(table, *half.values(), ids, id_filter, months)
    expected = base.recon_base(*half.values()).where(refresh.filed_in(months)).select(table.columns)
    assert rows(found) == rows(expected)
    all_rows = table.where(refresh.filed_in(months)).count()
    assert 0 < _shuffled(found, len(table.columns) - 2) < all_rows / 4


def test_a_refresh_keeps_no_second_copy(spark, half):
    conds = CASES["all"]
    first = {n: df.where(f"NOT coalesce({conds[n]}, false)") for n, df in half.items()}
    path = shared_dir(spark, "base")
    sinks.recon_base_write(base.recon_base(*first.values(), filed=True), path, filed=True)
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir())
    late = refresh.Late(**{n: half[n].where(cond) for n, cond in conds.items()})
    base_store.refresh(spark, path, *half.values(), late)
    found = sinks.read_base(spark, path)
    assert rows(found) == rows(base.recon_base(*half.values()).select(found.columns))
    more = {p.name.rpartition("-")[0].split("-")[1] for p in set(root.iterdir()) - before if p.name.startswith("refresh-")}
    assert more == {"ids", "filter"}


def test_a_crowded_month_is_filed_anew(spark):
    hub, sett, ledger, bank = small_chain(
        spark, [(f"o{i}", f"t{i}", 100, "SUCCESS") for i in range(13)],
        [("GW_A", f"t{i}", "2026-01-02", 60, 1, "ACQUIRING") for i in range(13)], [("o1", "ledger_revenue", "99")],
    )
    path = shared_dir(spark, "base")
    whole = base.recon_base(sett, hub, ledger, bank)
    order = whole.select("settlement_order_id").orderBy("settlement_order_id").collect()
    pieces = [whole.where(F.col("settlement_order_id") == r[0]) for r in order]
    for piece in pieces[:-1]:
        piece.write.mode("append").partitionBy(*sinks.FILED_BY).parquet(path)
    assert len(files(path)) == 12 and sinks.crowded(sinks.read_base(spark, path)) == [("2026-01", "GW_A")]
    late = refresh.Late(settlement=sett.where(F.col("settlement_order_id") == order[-1][0]))
    base_store.refresh(spark, path, sett, hub, ledger, bank, late)
    found = sinks.read_base(spark, path)
    assert rows(found) == rows(whole.select(found.columns)) and len(files(path)) == 1


def test_rows_are_dealt_out_before_they_are_widened(spark, half):
    found = base.recon_base(*half.values(), filed=True)
    dealt = [n for n in _nodes(found) if n.nodeName() == "Exchange" and "recon_month" in n.outputPartitioning().toString()]
    assert len(dealt) == 1 and "REBALANCE" in dealt[0].toString().upper()
    columns = dealt[0].output().mkString(",")
    for made in ("trace_status", "l1_match", "bank_daily_deposit", "ledger_txn_id", "diff_hub_vs_sett"):
        assert made in found.columns and made not in columns
    assert rows(found) == rows(base.recon_base(*half.values()))


def test_bloom_filters_are_as_large_as_the_ids_need(written):
    stored = [pq.ParquetFile(p).metadata for p in Path(written[0]).rglob("*.parquet")]
    assert max(m.num_rows for m in stored) < 2000
    assert max(p.stat().st_size for p in Path(written[0]).rglob("*.parquet")) < 150_000


def test_shuffle_files_go_with_the_write(spark, half):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        found = blocks.getAllBlocks().mkString(",").split(",")
        return {b for b in found if b.startswith("shuffle_")}

    before = shuffles()
    sinks.recon_base_write(base.recon_base(*half.values(), filed=True), shared_dir(spark, "base"), filed=True)
    until = time.time() + 30
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before


def test_a_filter_misses_no_key(spark):
    keys = spark.range(0, 900, 3).selectExpr("CASE WHEN id > 0 THEN concat('k', id) END AS k", "id % 2 AS n")
    asked = spark.range(900).selectExpr("CASE WHEN id > 0 THEN concat('k', id) END AS k", "id % 2 AS n", "id")
    for bits in (1 << 12, key_filter.FILTER_BITS):
        found = key_filter.bit_sets(keys, ["k", "n"], bits=bits)
        told = {r.id: r._maybe for r in key_filter.probed(asked, ["k", "n"], found, bits).collect()}
        assert len(told) == 900 and all(told[i] for i in range(0, 900, 3))
        assert sum(told.values()) < 400
    # Null is no key of a join.
    assert key_filter.semi_join(asked, keys, ["k", "n"], key_filter.bit_sets(keys, ["k", "n"])).count() == 299


# --- look-up -----------------------------------------------------------------------------


def test_a_look_up_pushes_one_equality_to_each_scan(spark, written):
    plan = trace_one(sinks.read_base(spark, written[0]), "sub_22")._jdf.queryExecution().executedPlan().toString()
    for column in sinks.BASE_IDS:
        assert f"EqualTo({column},sub_22)" in plan
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and not any("Or(EqualTo(settlement_order_id" in line for line in pushed)


def test_row_groups_without_the_id_are_skipped(spark, monkeypatch):
    """Ids at random, so that only the bloom filters can rule row groups out."""
    monkeypatch.setattr(sinks, "ROW_GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(sinks, "ROW_GROUP_IDS", 20_000)
    names = spark.range(0, 60_000, 1, 1).selectExpr(
        "'2026-01' AS recon_month", "'GW_A' AS gateway", "id", "concat('s', md5(string(id))) AS settlement_order_id",
        "concat('o', md5(string(id + 7))) AS hub_order_id", "concat('t', md5(string(id + 9))) AS hub_txn_id",
    )
    path = shared_dir(spark, "base")
    sinks.recon_base_write(names, path)
    files_of = [pq.ParquetFile(p) for p in Path(path).rglob("*.parquet")]
    groups = sum(f.metadata.num_row_groups for f in files_of)
    assert groups >= 20
    first = files_of[0].read_row_group(0).column("settlement_order_id").to_pylist()
    assert first == sorted(first)
    for column in sinks.BASE_IDS:
        for known in (True, False):
            wanted = names.where("id = 31234").first()[column] if known else f"{column[0]}0nowhere"
            seen = spark.read.parquet(path).where(F.col(column) == wanted)
            scanned = _scanned(seen, "numOutputRows")
            assert seen.count() == int(known)
            # One row group of about 1/20 of all rows, or a false alarm more.
            assert scanned <= 60_000 // groups * 4, column


def _scanned(df, metric):
    """A metric of all scans of the plan after it ran."""
    df = df.select("*")  # a plan of its own: an action sets the metrics of a plan back
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    total, stack = 0, [executed]
    while stack:
        node = stack.pop()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if "Scan" in node.nodeName():
            total += node.metrics().apply(metric).value()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
    return total


def test_the_index_opens_one_folder_and_the_months_of_the_id(spark, written):
    path, index = written
    table = sinks.read_base(spark, path)
    for any_id in (table.where("hub_txn_id <> settlement_order_id").first().hub_txn_id, table.first().hub_order_id, "unknown"):
        found = base_store.look_up(spark, path, index, any_id, 4)
        assert rows(found) == rows(trace_one(table, any_id))
        months = {(r.recon_month, r.gateway) for r in found.collect()}
        # The three branches open the partitions of the id alone.
        assert (_scanned(found, "numPartitions") if months else 0) == 3 * len(months)
    # A hot id is one row of the index for each partition.
    hot = table.limit(1).crossJoin(spark.range(500)).drop("id")
    other = shared_dir(spark, "index")
    base_store.add_to_index(hot, other, 4)
    assert spark.read.parquet(other).count() <= 3


def test_index_rows_are_shuffled_once(spark, written):
    """Equal ones meet where they are filed."""
    table = sinks.read_base(spark, written[0])
    found = base_store.index_rows(table.unionByName(table), 4)
    assert [n.nodeName() for n in _nodes(found)].count("Exchange") == 1
    each = F.explode(F.array(*sinks.BASE_IDS)).alias("any_id")
    expected = table.select(each, *sinks.FILED_BY).where("any_id IS NOT NULL").distinct()
    assert rows(found.drop("folder")) == rows(expected)


def test_settings_hold_for_a_block(spark):
    before = {k: spark.conf.get(k, None) for k in base_store._READ_AT_ONCE}
    with pytest.raises(ValueError), settings(spark, base_store._READ_AT_ONCE):
        assert all(spark.conf.get(k) == v for k, v in base_store._READ_AT_ONCE.items())
        raise ValueError
    assert before == {k: spark.conf.get(k, None) for k in base_store._READ_AT_ONCE}
