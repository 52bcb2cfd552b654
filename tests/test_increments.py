"""Deliveries that repeat rows, mergeable profiles and monthly sums."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.operators import base, distincts, partials, refresh, settlements, sketches
from tallychain.plans import registry
from tallychain.session import shared_dir
from tallychain.sources import base_store, deliveries, sinks
from tests.oracle_check import rows_of

registry.plans()


def rows(df):
    return rows_of(df.columns, df.collect())


# --- deliveries --------------------------------------------------------------------------


def delivery(spark, items):
    return spark.createDataFrame(items, "id string, part int, amount int, month string")


@pytest.mark.parametrize("bits", [deliveries.FILTER_BITS, 1 << 15, 8])
def test_a_key_is_loaded_once(spark, bits):
    """A file delivered twice, a row in two months, null keys, a delivery that repeats itself."""
    index, target = shared_dir(spark, "index"), shared_dir(spark, "loaded")
    january = [(f"x{i}", i % 3, i, "2026-01") for i in range(200)] + [(None, 1, 7, "2026-01"), ("n", None, 8, "2026-01")]
    february = [("x5", 2, 999, "2026-02"), ("new", 0, 1, "2026-02"), ("new", 0, 2, "2026-02"), (None, 1, 9, "2026-02")]

    def load(name, items):
        deliveries.deliver(delivery(spark, items), ["id", "part"], index, target, name, "amount", bits=bits)
        found = spark.read.parquet(target)
        return sorted((r.id or "", -1 if r.part is None else r.part, r.amount) for r in found.collect())

    first = sorted((i or "", -1 if p is None else p, a) for i, p, a, _ in january)
    assert load("2026-01", january) == first
    assert load("2026-01 once more", january) == first
    assert load("2026-02", february) == sorted([*first, ("new", 0, 1)])
    # A run that broke off is run again under its name, whether or not its keys got in.
    assert load("2026-02", february) == sorted([*first, ("new", 0, 1)])
    assert load("2026-01", january) == sorted([*first, ("new", 0, 1)])


def test_a_delivery_that_broke_off_before_its_keys_got_in(spark):
    index, target = shared_dir(spark, "index"), shared_dir(spark, "loaded")
    items = [("a", 1, 1, "m"), ("b", 1, 1, "m")]
    new = deliveries.new_rows(delivery(spark, items), ["id"], index, "1")
    new.withColumn("delivery", F.lit("1")).write.partitionBy("delivery").parquet(target)
    deliveries.deliver(delivery(spark, items), ["id"], index, target, "1")
    deliveries.deliver(delivery(spark, items), ["id"], index, target, "2")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_only_doubtful_rows_are_compared_exactly(spark):
    """Rows the filter clears go past the join, whatever the size of the index."""
    index = shared_dir(spark, "index")
    old = delivery(spark, [(f"x{i}", 0, i, "m") for i in range(1000)])
    deliveries.record(old, ["id"], index, "1")
    held = deliveries.known_filter(spark, index, "2")
    assert held.agg(F.sum(F.bitmap_count("bits"))).first()[0] == pytest.approx(1000, abs=3)
    # Merged by OR: entering half of the keys again under another name adds no bit.
    deliveries.record(old.where("amount < 500"), ["id"], index, "1b")
    assert deliveries.known_filter(spark, index, "2").agg(F.sum(F.bitmap_count("bits"))).first() == held.agg(
        F.sum(F.bitmap_count("bits"))
    ).first()
    new = deliveries.new_rows(delivery(spark, [(f"y{i}", 0, i, "m") for i in range(50)]), ["id"], index, "2")
    assert new.count() == 50


# --- profiles ----------------------------------------------------------------------------


def test_a_year_is_profiled_from_monthly_states(spark):
    draw = random.Random(4)
    items = [
        (
            f"id{draw.randrange(4000)}", draw.choice([None, *range(50)]), Decimal(draw.randrange(10_000_000)) / 100,
            date(2026, draw.randrange(1, 13), draw.randrange(1, 28)), None,
        )
        for _ in range(20_000)
    ]
    df = spark.createDataFrame(items, "id string, n int, amount decimal(18,2), day date, empty double")
    path = shared_dir(spark, "states")
    sketches.profile_store(df, "date_format(day, 'yyyy-MM')", path)
    states = sketches.profile_load(spark, path, "2026-02", "2026-11")
    inside = [x for x in items if 2 <= x[3].month <= 11]
    lines = {r.column_name: r for r in sketches.profile_of(states, "t").collect()}
    assert set(lines) == {"id", "n", "amount", "day", "empty"}
    for i, name in enumerate(("id", "n", "amount", "day")):
        values = [x[i] for x in inside if x[i] is not None]
        line = lines[name]
        assert line.n_rows == len(inside)
        assert line.null_pct == pytest.approx(100 * (1 - len(values) / len(inside)))
        assert line.distinct_values == pytest.approx(len(set(values)), rel=sketches.DISTINCT_ERROR)
        shown = [f"{v:.2f}" if name == "amount" else str(v) for v in (min(values), max(values))]
        assert [line.smallest, line.largest] == shown
        if name != "id":
            numbers = sorted((v - date(1970, 1, 1)).days if name == "day" else float(v) for v in values)
            for q, got in ((0.25, line.q25), (0.5, line.q50), (0.75, line.q75)):
                below, upto = sum(x < got for x in numbers), sum(x <= got for x in numbers)
                assert below / len(numbers) - sketches.RANK_ERROR <= q <= upto / len(numbers) + sketches.RANK_ERROR
    assert (lines["empty"].null_pct, lines["empty"].distinct_values, lines["empty"].q50) == (100, 0, None)
    assert lines["id"].q50 is None


def test_merged_states_can_be_merged_again(spark):
    df = spark.range(5000).selectExpr("id % 700 AS a", "string(id) AS b", "concat('2026-0', id % 6 + 1) AS month")
    states = sketches.profile_states(df, "month")
    parts = sketches.merged(states.where("month <= '2026-03'")).unionByName(sketches.merged(states.where("month > '2026-03'")))
    whole = {r.column_name: r for r in sketches.profile_of(states, "t").collect()}
    halves = {r.column_name: r for r in sketches.profile_of(parts, "t").collect()}
    for c in ("a", "b"):
        for field in ("n_rows", "null_pct", "smallest", "largest"):
            assert whole[c][field] == halves[c][field]
        for lines in (whole, halves):
            assert lines[c].distinct_values == pytest.approx(700 if c == "a" else 5000, rel=sketches.DISTINCT_ERROR)


def test_a_profile_reads_states_only(spark, stored):
    path = shared_dir(spark, "states")
    sketches.profile_store(stored.hub, "source_month", path)
    profile = sketches.profile_of(sketches.profile_load(spark, path, "1996-01", "1996-12"), "hub")
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "states" in plan and "distinct_state" in plan


# --- monthly sums ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sums(spark, stored):
    path = shared_dir(spark, "sums")
    partials.partials_store(stored.base, path)
    return partials.partials_load(spark, path)


def test_any_span_of_months_equals_a_scan(stored, sums):
    for first, last in ((date(1996, 1, 1), date(1996, 2, 1)), (date(1995, 3, 1), date(1997, 6, 1))):
        period = Period(first, last)
        months = f"{first:%Y-%m}", f"{date(last.year, last.month - 1, 1):%Y-%m}"
        scan = settlements.source_month_waterfall(stored.settlement, stored.hub, period)
        assert rows(partials.source_month_waterfall(sums, *months).select(scan.columns)) == rows(scan)
        second = Period(date(1998, 1, 1), date(1998, 4, 1))
        scan = base.recon_month_compare(stored.base, period, second)
        compared = partials.month_compare(sums, months, ("1998-01", "1998-03"))
        assert rows(compared.select(scan.columns)) == rows(scan)


def test_sums_follow_a_refresh(spark, stored):
    layers = [stored.settlement.where("year(settled_date) = 1996"), stored.hub, stored.ledger, stored.bank]
    is_late = "settled_date >= '1996-05-01' AND settled_date < '1996-06-01'"
    path, kept = shared_dir(spark, "base"), shared_dir(spark, "sums")
    sinks.recon_base_write(base.recon_base(layers[0].where(f"NOT ({is_late})"), *layers[1:]), path)
    partials.partials_store(sinks.read_base(spark, path), kept)
    late = refresh.Late(settlement=layers[0].where(is_late))
    months = base_store.refresh(spark, path, *layers, late)
    assert "1996-05" in {m for m, _ in months}
    partials.partials_store(sinks.read_base(spark, path), kept, months)
    expected = partials.partials(base.recon_base(*layers))
    assert rows(partials.partials_load(spark, kept).select(expected.columns)) == rows(expected)


# --- distinct counts ---------------------------------------------------------------------


def test_numbers_are_dense_and_extended(spark, monkeypatch):
    monkeypatch.setattr(distincts, "LOTS", 7)
    first = spark.createDataFrame([(f"k{i % 500}",) for i in range(2000)] + [(None,)], "k string")
    numbers = distincts.number_keys(first, "k").collect()
    assert sorted(r.number for r in numbers) == list(range(1, 501))
    assert {tuple(r) for r in distincts.number_keys(first.repartition(5), "k").collect()} == {tuple(r) for r in numbers}
    known = spark.createDataFrame(numbers)
    later = spark.createDataFrame([(f"k{i}",) for i in range(400, 650)], "k string")
    added = distincts.number_keys(later, "k", known).collect()
    assert sorted(r.number for r in added) == list(range(501, 651))
    assert {r.key for r in added} == {f"k{i}" for i in range(500, 650)}
    none = first.limit(0)
    assert distincts.number_keys(none, "k").count() == 0
    fresh = distincts.number_keys(later, "k", spark.createDataFrame([], known.schema)).collect()
    assert sorted(r.number for r in fresh) == list(range(1, 251))


def test_bitmaps_count_what_distinct_counts(spark):
    """Keys over several buckets, one group with most of the rows, nulls, months without new keys."""
    rng = random.Random(3)
    data = [
        ("hot" if rng.random() < 0.7 else rng.choice("ab"), f"2026-0{rng.randint(1, 5)}", rng.randint(1, 90_000), rng.randint(-40, 40))
        for _ in range(60_000)
    ]
    data += [("a", "2026-06", None, None), (None, "2026-01", 5, None), (None, "2026-07", 5, 1)]
    df = spark.createDataFrame(data, "g string, month string, n long, day int").repartition(6)
    states = distincts.distinct_states(df, ["g", "month"], {"keys": "n", "days": "day"})
    assert "Expand" not in states._jdf.queryExecution().executedPlan().toString()
    want = df.groupBy("g").agg(F.countDistinct("n").alias("keys"), F.countDistinct("day").alias("days"))
    got = distincts.distinct_counts(states, ["g"], ["keys", "days"])
    assert rows(got) == rows(want)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    again = distincts.distinct_counts(distincts.merged(states, ["g"]), ["g"], ["keys", "days"])
    assert rows(again) == rows(want)
    first, months = {}, set()
    for g, month, n, _ in data:
        if n is not None:
            first[g, n] = min(month, first.get((g, n), month))
            months.add((g, month))
    want = {
        (g, m): (sum(f == m for (h, _), f in first.items() if h == g), sum(f <= m for (h, _), f in first.items() if h == g))
        for g, m in months
    }
    got = distincts.counts_to_month(states, ["g"], "month", "keys").collect()
    assert {(r.g, r.month): (r.new_keys, r.keys_so_far) for r in got} == want


def test_a_bucket_is_made_in_one_task(spark):
    """Bitmaps are not sent by every task that holds some number of a bucket."""
    df = spark.range(1000).selectExpr("'2026-01' AS month", "id % 300 AS n")
    plan = distincts.distinct_states(df, ["month"], {"keys": "n"})._jdf.queryExecution().executedPlan().toString()
    made, dealt = plan.index("partial_bitmap_construct_agg"), plan.index("Exchange")
    assert made < dealt and "Exchange hashpartitioning(counted" in plan, plan


def test_stored_states_replace_their_months(spark):
    df = spark.createDataFrame([("2026-01", 1), ("2026-01", 2), ("2026-02", 2), ("2026-02", 3)], "month string, n long")
    path = shared_dir(spark, "test-states")
    distincts.distinct_store(distincts.distinct_states(df, ["month"], {"keys": "n"}), path, "month")
    late = spark.createDataFrame([("2026-02", 3), ("2026-02", 4), ("2026-02", 5)], "month string, n long")
    distincts.distinct_store(distincts.distinct_states(late, ["month"], {"keys": "n"}), path, "month")
    got = distincts.distinct_counts(distincts.distinct_load(spark, path, "month"), ["month"], ["keys"]).collect()
    assert {tuple(r) for r in got} == {("2026-01", 2), ("2026-02", 3)}
