"""Small hand-made frames for every trap in the source data."""

import uuid
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallychain.config import LEDGERS, Period
from tallychain.functions import dates, money, status, text
from tallychain.operators import (
    bank,
    base,
    fees,
    frames,
    hub_gateway,
    inventory,
    ledger_hub,
    matching,
    settlements,
)
from tallychain.operators.frames import pick_first
from tallychain.operators.trace import latest_refund, one_per_order
from tallychain.plans import registry, sample
from tallychain.session import shared_dir
from tallychain.sources import relations, tables
from tallychain.sources.relations import union_all
from tests.oracle_check import rows_of

registry.plans()


def one_column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.selectExpr("i", f"{expr} AS y").orderBy("i").select("y").collect()]


def test_quotes_are_stripped_at_both_ends_only(spark):
    values = ["'a'", "a", "'a'b'", None, "", "''"]
    assert one_column(spark, values, text.strip_quotes("x")) == ["a", "a", "a'b", None, "", ""]


def test_text_dates(spark):
    day = date(2026, 1, 5)
    assert one_column(
        spark, ["'2026-01-05 16:24:17'", "2026-01-05", "junk", None, ""], dates.parse_quoted_date("x")
    ) == [day, day, None, None, None]
    assert one_column(spark, ["05-01-2026 10:00", "2026-01-05", "junk", None], dates.parse_dmy_date("x")) == [
        day, None, None, None,
    ]
    assert one_column(
        spark, ["Jan 5, 2026", "Jan 05, 2026", "2026-01-05 10:00:00", "Foo 5, 2026", None],
        dates.parse_month_name_date("x"),
    ) == [day, day, day, None, None]


def test_underscore_is_literal_in_id_families(spark):
    ids = ["w_1", "walletTop_1", "W_1", "wX1", "gen_9", "SRVC_3", None]
    assert one_column(spark, ids, text.order_pattern("x")) == [
        "w_*", "walletTop_*", "other", "other", "gen_*", "other", "other",
    ]
    got = one_column(spark, ["ADJ_1", "ADJX1", "w-1", None], text.is_adjustment("'GW_C'", "x"))
    assert got == [True, False, False, False]
    assert one_column(spark, ["a1_x", "ab_1", "noscore"], text.order_pattern_regex("x")) == [
        "other", "ab_*", "other",
    ]


def test_prefix_of_id_without_separator(spark):
    assert one_column(spark, ["ADJ", "gen_1_2", ""], text.order_prefix("NULL", "x")) == ["ADJ", "gen", ""]


@pytest.mark.parametrize(
    "gateway, expected",
    [
        # type:   ACQUIRING PAYMENT REVERSAL REFUND null  ''     payment
        ("GW_A", [True, False, False, False, False, False, False]),
        ("GW_B", [True, True, False, False, False, True, True]),
        ("GW_C", [True, True, True, True, True, True, True]),
        ("GW_D", [False, False, False, False, False, False, True]),
    ],
)
def test_forward_rows(spark, gateway, expected):
    kinds = ["ACQUIRING", "PAYMENT", "REVERSAL", "REFUND", None, "", "payment"]
    assert one_column(spark, kinds, status.is_forward_row(f"'{gateway}'", "x")) == expected


def test_non_refund_status_keeps_nulls(spark):
    values = ["Refunded", "Chargebacked", "captured", None]
    assert one_column(spark, values, status.non_refund_status("x")) == [False, False, True, True]


def test_fees_of_any_sign(spark):
    values = [Decimal("-4.00"), Decimal("0.00"), Decimal("2.50"), None]
    kind = "decimal(18,2)"
    assert one_column(spark, values, money.fee_sign_class("x"), kind) == [
        "charged", "none", "credited", "credited",
    ]
    fee = one_column(spark, values, money.settlement_fee("'GW_B'", "x", "NULL"), kind)
    assert fee == [Decimal("4.00"), Decimal("0.00"), Decimal("2.50"), Decimal("0.00")]
    net = one_column(
        spark, values, money.settlement_net("'GW_D'", "CAST(10 AS DECIMAL(18,2))", "x", "NULL", "NULL"), kind
    )
    assert net == [Decimal("14.00"), Decimal("10.00"), Decimal("7.50"), Decimal("10.00")]


def test_gap_bands_and_zero_denominator(spark):
    values = [2.99, -3.0, 9.99, 10.0]
    assert one_column(spark, values, money.gap_status("x"), "double") == [
        "CLEAN", "REVIEW", "REVIEW", "MISMATCH",
    ]
    assert one_column(spark, [0.0, 4.0, None], money.safe_pct("1", "x"), "double") == [0.0, 25.0, 0.0]


def test_coerce_numeric(spark):
    assert one_column(spark, ["1.5", "abc", None, ""], money.coerce_numeric("x")) == [
        Decimal("1.50"), None, None, None,
    ]


def test_period_of_december_and_january():
    assert Period.month("2025-12") == Period(date(2025, 12, 1), date(2026, 1, 1))
    assert Period.month("2026-01").previous() == Period.month("2025-12")
    assert Period.month("2026-03").previous() == Period.month("2026-02")


def test_anti_join_with_nulls_and_duplicates(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    rows = [r.id for r in matching.unmatched(left, right, "id").collect()]
    # NOT IN would return nothing here because of the null on the right.
    assert sorted(rows, key=str) == [None, "b", "b"]
    assert [r.id for r in matching.matched(left, right, "id").collect()] == ["a"]


def test_salting_does_not_change_the_result(spark):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) AS id", "id AS n")
    right = spark.createDataFrame([("hot",), ("hot",), ("k1",), (None,)], "id string")
    for f in (matching.matched, matching.unmatched):
        assert sorted(f(left, right, "id", salts=8).collect()) == sorted(f(left, right, "id").collect())
    assert matching.matched(left, right, "id", salts=8).count() == 1001


def test_duplicate_keys_and_approximate_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert inventory.duplicate_keys(df, "k").collect() == [("a", 2)]
    got = {r.column_name: r for r in inventory.column_profile_approx(df, "t").collect()}
    assert (got["v"].distinct_values, got["v"].samples) == (3, "1, 3")
    assert round(got["k"].null_pct, 2) == 33.33
    exact = {r.column_name: r for r in inventory.column_profile(df, "t").collect()}
    assert (exact["v"].samples, exact["k"].distinct_values) == ("1, 2, 3", 1)


def ledger_rows(spark, rows):
    by_table = {x.table: x.priority for x in LEDGERS}
    full = [(i, t, Decimal(a), by_table[t], True) for i, t, a in rows]
    return spark.createDataFrame(
        full,
        "order_id string, ledger_table string, ledger_amount decimal(18,2), priority int, in_scope boolean",
    )


def test_priority_pick_and_tie(spark):
    led = ledger_rows(
        spark,
        [
            ("x", "ledger_ott", "1"), ("x", "ledger_revenue", "2"), ("x", "ledger_net_income", "3"),
            ("y", "ledger_revenue", "9"), ("y", "ledger_revenue", "5"),
            ("z", "ledger_topup", "4"), ("walletTop_1", "ledger_topup", "4"), ("r", "ledger_refunded", "4"),
        ],
    )
    got = {r.order_id: r for r in base.ledger_lookup(led).collect()}
    assert (got["x"].ledger_table, got["x"].ledger_amount) == ("ledger_revenue", Decimal("2.00"))
    assert got["y"].ledger_amount == Decimal("5.00")
    assert got["z"].ledger_txn_id is None, "a top-up of another id family"
    assert (got["walletTop_1"].ledger_table, got["walletTop_1"].in_main) == ("ledger_topup", False)
    assert (got["r"].ledger_table, got["r"].in_main, got["r"].in_refunded) == ("ledger_refunded", False, True)
    assert got["x"].in_main
    by_window = pick_first(led.where("priority IS NOT NULL"), ["order_id"], "priority", "ledger_amount")
    assert {r.order_id: r.ledger_amount for r in by_window.collect()} == {
        "x": Decimal("2.00"), "y": Decimal("5.00"),
    }


def test_latest_refund_with_equal_and_null_dates(spark):
    rows = [
        ("a", "r1", date(2026, 1, 1)), ("a", "r2", date(2026, 1, 9)),
        ("b", "r3", date(2026, 1, 1)), ("b", "r4", date(2026, 1, 1)),
        ("c", "r5", None), ("c", "r6", date(2025, 1, 1)),
    ]
    df = spark.createDataFrame(
        [(o, r, d, Decimal(1), "FULL", "SUCCESS") for o, r, d in rows],
        "order_id string, refund_unique_id string, refund_date date, refund_amount decimal(18,2), "
        "refund_type string, refund_status string",
    )
    want = {"a": "r2", "b": "r4", "c": "r6"}
    assert {r.order_id: r.refund_unique_id for r in latest_refund(df).collect()} == want
    by_window = pick_first(df, ["order_id"], "refund_date DESC", "refund_unique_id DESC")
    assert {r.order_id: r.refund_unique_id for r in by_window.collect()} == want


def test_partner_wallet_order_differs_between_the_two_statuses(spark):
    values = ["SRVC_1"]
    assert one_column(spark, values, status.l1_match("x", "x")) == ["MATCHED"]
    assert one_column(spark, values, status.trace_status_basic("x", "x")) == ["PARTNER_WALLET"]


@pytest.mark.parametrize(
    "sett, hub, led, refunded, topup, expected",
    [
        ("'ADJ_1'", "NULL", "NULL", "false", "false", "PG_ADJUSTMENT"),
        ("'x'", "NULL", "NULL", "false", "false", "MISSING_HUB"),
        ("'x'", "'SRVC_1'", "NULL", "true", "false", "PARTNER_WALLET"),
        ("'x'", "'gen_1'", "'gen_1'", "true", "false", "FULLY_TRACED"),
        ("'x'", "'gen_1'", "NULL", "true", "false", "REFUNDED"),
        ("'x'", "'walletTop_1'", "NULL", "true", "true", "REFUNDED"),
        ("'x'", "'walletTop_1'", "NULL", "false", "true", "WALLET_TOPUP"),
        ("'x'", "'gen_1'", "NULL", "false", "true", "MISSING_LEDGER"),
    ],
)
def test_trace_status_precedence(spark, sett, hub, led, refunded, topup, expected):
    expr = status.trace_status("'GW_C'", sett, hub, led, refunded, topup)
    assert spark.range(1).selectExpr(f"{expr} AS s").first().s == expected


def settlement_frame(spark, rows):
    """rows: (gateway, id, day, gross, fee, type)"""
    feed = spark.createDataFrame(
        [(g, i, float(a), None if g == "GW_D" else float(a - f), float(f), 0.0, d, "u", t) for g, i, d, a, f, t in rows],
        "gateway string, raw_order_id string, raw_gross double, raw_net double, raw_fee double, "
        "raw_tax double, raw_settled_on string, utr string, txn_type string",
    ).selectExpr(
        "*", "'PAYMENT' AS payment_type", "CAST(NULL AS STRING) AS txn_status", "'UPI' AS method",
        "CAST(NULL AS STRING) AS network", "CAST(NULL AS STRING) AS card_type",
    )
    return relations.settlement(feed)


def test_amounts_are_not_multiplied_by_settlement_rows(spark):
    hub = spark.createDataFrame(
        [("o1", "t1", "t1", "GW_A", Decimal(100), "SUCCESS", date(2026, 1, 1), "2026-01")],
        "order_id string, hub_txn_id string, settle_key string, gateway string, amount decimal(18,2), "
        "status string, created_date date, source_month string",
    )
    gw = spark.createDataFrame(
        [("GW_A", "t1", Decimal(100), True)], "gateway string, gw_key string, amount decimal(18,2), is_success boolean"
    )
    sett = settlement_frame(
        spark, [("GW_A", "'t1'", "2026-01-02", 60, 1, "ACQUIRING"), ("GW_A", "t1", "'2026-01-03 10:00:00'", 40, 1, "ACQUIRING")]
    )
    row = settlements.amount_bridge(hub, gw, sett).first()
    assert (row.hub_amount, row.gateway_amount, row.gross, row.net) == (100, 100, 100, 98)
    assert settlements.fanout_ratio(sett).first().ratio == 2.0
    assert fees.fee_summary(sett, hub).first().hub_txns == 1
    assert hub_gateway.l2_summary(hub, gw).where("gateway = 'ALL'").first().match_pct == 100.0


def test_daily_match_keeps_days_of_either_side(spark):
    sett = settlement_frame(
        spark, [("GW_B", "a", "2026-01-01", 10, 0, "PAYMENT"), ("GW_B", "b", "2026-01-02", 20, 0, "PAYMENT")]
    )
    deposits = spark.createDataFrame(
        [("GW_B", date(2026, 1, 2), Decimal(19)), ("GW_B", date(2026, 1, 3), Decimal(5))],
        "gateway string, bank_date date, deposit decimal(18,2)",
    )
    got = {r.day.day: (r.net, r.bank_deposit) for r in bank.bank_daily_full(sett, deposits).collect()}
    assert got == {1: (10, 0), 2: (20, 19), 3: (0, 5)}


def test_gap_base_is_an_argument(spark):
    sett = settlement_frame(spark, [("GW_B", "a", "2026-01-01", 100, 0, "PAYMENT")])
    deposits = spark.createDataFrame(
        [("GW_B", date(2026, 1, 2), Decimal(80))], "gateway string, bank_date date, deposit decimal(18,2)"
    )
    assert bank.bank_monthly(sett, deposits).where("month IS NOT NULL").first().gap_pct == -25.0
    assert bank.bank_monthly(sett, deposits, gap_base="sett_net").first().gap_pct == -20.0


def test_netting_subtracts_refunds_and_keeps_refund_only_days(spark):
    sett = settlement_frame(spark, [("GW_A", "a", "2026-01-01", 100, 0, "ACQUIRING")])
    refunds = spark.createDataFrame(
        [("GW_A", date(2026, 1, 1), Decimal(30)), ("GW_A", date(2026, 1, 2), Decimal(7))],
        "gateway string, settled_date date, settled_amount decimal(18,2)",
    )
    deposits = spark.createDataFrame(
        [("GW_A", date(2026, 1, 1), Decimal(69))], "gateway string, bank_date date, deposit decimal(18,2)"
    )
    full = {r.day.day: r for r in bank.bank_daily_netting(sett, refunds, deposits).collect()}
    assert (full[1].expected, full[1].daily_diff) == (70, -1)
    assert full[2].expected == -7
    assert bank.bank_daily_netting(sett, refunds, deposits, how="left").count() == 1


def test_subtotals_keep_detail_and_sum_up(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], "g string, s string, n bigint")
    got = {(r.g, r.s): r.n for r in frames.with_totals(df, ["g", "s"], "n").collect()}
    assert got == {("a", "x"): 1, ("a", "y"): 2, ("b", "x"): 4, ("a", "ALL"): 3, ("b", "ALL"): 4, ("ALL", "ALL"): 7}


def test_dedupe_has_a_stable_winner(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert sorted(tables.dedupe_on_load(df, ["k"], "v").collect()) == [("a", 1), ("b", 5)]
    assert tables.dedupe_on_load(df, ["k"]).count() == 2


def test_table_name_clean():
    assert tables.table_name_clean("/data/My file-2026 (1).csv") == "My_file_2026__1_"


def test_union_all_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(union_all([a, b]).collect()) == [(1, "x"), (2, "y")]


def write_csv(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)


def test_csv_columns_are_bound_by_header(spark, tmp_path):
    write_csv(tmp_path, "a.csv", "utr_no,order_id,amount,junk\nU1,x1,10.5,j\nU2,x2,oops,j\n,x3,,\n")
    write_csv(tmp_path, "b.csv", "AMOUNT,Order_ID,UTR_NO\n7,x4,U4\n8,x5\n9,x6,U6,extra\n")
    landed = tables.read_csv(spark, f"{tmp_path}/*.csv", "order_id STRING, amount DECIMAL(18,2), utr_no STRING")
    assert landed.rows.columns == ["order_id", "amount", "utr_no"]
    assert sorted(landed.rows.collect()) == [
        ("x1", Decimal("10.50"), "U1"), ("x3", None, None), ("x4", Decimal("7.00"), "U4"),
    ]
    bad = {r.order_id: (r.source_file, r.bad_columns, r.amount) for r in landed.rejects.collect()}
    assert bad == {
        "x2": ("a.csv", ["amount"], "oops"), "x5": ("b.csv", ["*"], "8"), "x6": ("b.csv", ["*"], "9"),
    }
    report = tables.load_report({"t": landed}).collect()
    assert report == [("t", 3, 3)]


def test_a_missing_csv_column_is_an_error(spark, tmp_path):
    write_csv(tmp_path, "a.csv", "order_id,amount\nx,1\n")
    with pytest.raises(ValueError, match="utr_no"):
        tables.read_csv(spark, f"{tmp_path}/*.csv", "order_id STRING, utr_no STRING")
    by_alias = tables.read_csv(spark, f"{tmp_path}/*.csv", "utr_no STRING", {"order_id": "utr_no"})
    assert by_alias.rows.collect() == [("x",)]


def jobs_of(spark, action):
    """How many Spark jobs ``action`` runs, and what it returns."""
    name = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(name, "")
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), out


def test_jobs_of_a_load_do_not_grow_with_its_files(spark, tmp_path):
    """500 files of three layouts, some with a blank first line, one of them empty."""
    heads = ["order_id,amount,junk", "\nAmount , ORDER_ID", "\n\n\ufeffextra,order_id,amount"]
    lines = ["x{i},{i}.5,j", "{i}.5,x{i}", "e,x{i},{i}.5"]
    for n, folder in ((50, "few"), (500, "many")):
        for i in range(n):
            body = lines[i % 3].format(i=i)
            write_csv(tmp_path / folder, f"part {i}.csv", f"{heads[i % 3]}\n{body}\n{'bad' if i == 4 else body}\n")
        write_csv(tmp_path / folder, "none.csv", "")
    counts = {}
    for n, folder in ((50, "few"), (500, "many")):
        counts[n], landed = jobs_of(
            spark,
            lambda: tables.csv_load(
                spark, f"{tmp_path}/{folder}/*.csv", str(tmp_path / "out"), folder, "order_id STRING, amount DECIMAL(9,1)"
            ),
        )
        assert sorted(landed.rows.collect()) == sorted(
            (f"x{i}", Decimal(f"{i}.5")) for i in range(n) for _ in range(1 if i == 4 else 2)
        )
        assert [(r.source_file, r.bad_columns) for r in landed.rejects.collect()] == [("part 4.csv", ["*", "amount"])]
    # Headers, the listing of the pattern and of each layout's files, and the one parse.
    assert counts[500] <= counts[50] + 3 <= 8


def test_files_are_parsed_once_and_rejects_are_a_partition(spark, tmp_path):
    write_csv(tmp_path / "in", "a.csv", "order_id,amount\nx,1\ny,oops\nz,2\n")
    loaded = tables.csv_load(spark, str(tmp_path / "in"), str(tmp_path), "t", "order_id STRING, amount INT")
    for landed in (loaded, tables.open_landed(spark, str(tmp_path / "t"))):
        assert sorted(landed.rows.collect()) == [("x", 1), ("z", 2)]
        assert landed.rejects.collect() == [("y", "oops", "a.csv", ["amount"])]
        plan = landed.rows._jdf.queryExecution().executedPlan().toString()
        assert "csv" not in plan.lower().split("parquet")[0] and f"PartitionFilters: [isnotnull({tables.LANDED_AS}" in plan
    tables.csv_load(spark, str(tmp_path / "in"), str(tmp_path), "t", "order_id STRING, amount STRING")
    again = tables.open_landed(spark, str(tmp_path / "t"))
    assert again.rows.count() == 3 and again.rejects.count() == 0


def test_quoted_line_breaks(spark, tmp_path):
    write_csv(tmp_path / "in", "a.csv", 'order_id,remark\nx,"two\nlines ""q"""\ny,one\n')
    args = spark, str(tmp_path / "in"), "order_id STRING, remark STRING"
    assert sorted(tables.read_csv(*args, multi_line=True).rows.collect()) == [("x", 'two\nlines "q"'), ("y", "one")]
    assert tables.read_csv(*args).rejects.count() > 0


def test_header_columns():
    assert tables.header_columns('a,"b, c",,A') == ("a0", "b, c", "_c2", "A3")


def test_a_load_without_files_that_have_rows(spark, tmp_path):
    write_csv(tmp_path / "in", "a.csv", "order_id,amount\n")
    write_csv(tmp_path / "none", "b.csv", "")
    for folder in ("in", "none"):
        landed = tables.csv_load(spark, str(tmp_path / folder), str(tmp_path), "t", "order_id STRING, amount INT")
        assert landed.rows.columns == ["order_id", "amount"]
        assert landed.rows.count() == landed.rejects.count() == 0


def small_chain(spark, hub_rows, sett_rows, ledger):
    hub = spark.createDataFrame(
        [(o, t, t, "GW_A", Decimal(a), s, date(2026, 1, 1), "2026-01") for o, t, a, s in hub_rows],
        "order_id string, hub_txn_id string, settle_key string, gateway string, amount decimal(18,2), "
        "status string, created_date date, source_month string",
    )
    deposits = spark.createDataFrame(
        [("GW_A", date(2026, 1, 2), Decimal(50)), ("GW_A", date(2026, 2, 2), Decimal(70))],
        "gateway string, bank_date date, deposit decimal(18,2)",
    )
    return hub, settlement_frame(spark, sett_rows), ledger_rows(spark, ledger), deposits


def test_hub_and_ledger_amounts_count_once_and_repeated_hub_rows_do_not_multiply(spark):
    hub, sett, led, deposits = small_chain(
        spark,
        [("gen_1", "t1", 100, "SUCCESS"), ("gen_1", "t1", 100, "PENDING"), ("gen_2", "t2", 30, "SUCCESS")],
        [("GW_A", "t1", "2026-01-02", 60, 1, "ACQUIRING"), ("GW_A", "t1", "2026-01-02", 40, 1, "ACQUIRING"),
         ("GW_A", "t2", "2026-02-02", 30, 0, "ACQUIRING")],
        [("gen_1", "ledger_revenue", "99"), ("gen_2", "ledger_refunded", "30")],
    )
    whole = base.recon_base(sett, hub, led, deposits)
    assert whole.count() == 3
    steps = {r.gateway: r for r in base.waterfall_by_gateway(whole, deposits).collect()}["GW_A"]
    assert (steps.bank, steps.gross, steps.hub, steps.ledger) == (120, 130, 130, 99)
    rows = {r.trace_status: r for r in base.recon_summary(whole).where("gateway = 'GW_A'").collect()}
    assert (rows["FULLY_TRACED"].n_rows, rows["FULLY_TRACED"].hub_amount) == (2, 100)
    assert (rows["REFUNDED"].ledger_amount, rows["REFUNDED"].hub_amount) == (30, 30)
    back = whole.where("trace_status = 'REFUNDED'").first()
    assert (back.ledger_table, back.diff_ledger_vs_hub, back.l1_match) == ("ledger_refunded", 0, "HUB_ONLY")
    gw = spark.createDataFrame(
        [("GW_A", "t1", Decimal(100), True)], "gateway string, gw_key string, amount decimal(18,2), is_success boolean"
    )
    assert settlements.amount_bridge(hub, gw, sett).first().hub_amount == 100


def test_a_monthly_run_takes_the_deposits_of_its_month(spark):
    hub, sett, led, deposits = small_chain(
        spark, [("gen_1", "t1", 100, "SUCCESS")],
        [("GW_A", "t1", "2026-01-02", 60, 0, "ACQUIRING"), ("GW_A", "t1", "2026-02-02", 40, 0, "ACQUIRING")],
        [("gen_1", "ledger_revenue", "100")],
    )
    run = base.run(sett, hub, led, deposits, Period.month("2026-01"))
    steps = base.waterfall_by_gateway(run.base, run.bank).first()
    assert (steps.bank, steps.gross, steps.hub) == (50, 60, 100)
    assert base.gap_a_bank(run.base, run.bank).first().gap == -10


def test_a_refund_that_is_not_done_leaves_the_order_missing(spark):
    hub, sett, led, deposits = small_chain(
        spark, [("gen_1", "t1", 10, "SUCCESS")], [("GW_A", "t1", "2026-01-02", 10, 0, "ACQUIRING")],
        [("gen_1", "ledger_refunded", "10")],
    )
    open_refund = led.selectExpr("* EXCEPT (in_scope)", "false AS in_scope")
    row = base.recon_base(sett, hub, open_refund, deposits).first()
    assert (row.trace_status, row.ledger_table) == ("MISSING_LEDGER", None)


def test_reasons_of_revenue_rows_unknown_to_the_hub(spark):
    booking = spark.createDataFrame(
        [], "booking_txn_id string, created_on string, booking_fee double, resultstatus string, "
        "payment_flag string, payment_gateway_name string"
    )
    ids = [("gen_1", 0.0), ("sub_1", 0.0), ("BOOKING_PAYMENT_1", 5.0), ("SRVC_1", 1.0)]
    revenue = spark.createDataFrame(
        [(i, a, "online", "Jan 5, 2026") for i, a in ids],
        "transaction_id string, totalpaid double, mode string, recharge_dt string",
    )
    hub, *_ = small_chain(spark, [("x", "x", 1, "SUCCESS")], [("GW_A", "x", "2026-01-02", 1, 0, "ACQUIRING")], [])
    got = {r.ledger_txn_id: r.mismatch_reason for r in ledger_hub.mismatch_ledger_to_hub(booking, revenue, hub).collect()}
    assert got == {
        "gen_1": "nothing paid, failed or cancelled", "sub_1": "not found in the hub",
        "BOOKING_PAYMENT_1": "booking fee reversal", "SRVC_1": "partner wallet, outside the hub",
    }


def test_bank_totals_and_the_overall_gap(spark):
    sett = settlement_frame(
        spark, [("GW_A", "a", "2026-01-01", 100, 0, "ACQUIRING"), ("GW_A", "a", "2026-02-01", -10, 0, "REFUND"),
                ("GW_B", "b", "2026-01-01", 50, 0, "PAYMENT"), ("GW_B", "b", "2026-01-01", 9, 0, "REVERSAL")],
    )
    deposits = spark.createDataFrame(
        [("GW_A", date(2026, 1, 2), Decimal(80)), ("GW_B", date(2026, 1, 2), Decimal(40)), (None, date(2026, 1, 2), Decimal(3))],
        "gateway string, bank_date date, deposit decimal(18,2)",
    )
    rows = {r.gateway: r for r in bank.settlement_summary(sett, deposits).collect()}
    assert (rows["GW_A"].net, rows["GW_B"].net, rows["ALL"].net) == (90, 50, 140)
    assert (rows["ALL"].bank_total, rows["ALL"].gap) == (123, -17)
    totals = {r.gateway: r for r in bank.bank_monthly(sett, deposits).where("month IS NULL").collect()}
    assert (totals["GW_A"].sett_net, totals["GW_A"].gap, totals["GW_A"].reconcilable) == (90, -10, None)


def test_refunds_of_all_orders_are_deducted_from_the_bridge(spark):
    hub, sett, _, _ = small_chain(
        spark, [("o1", "t1", 100, "SUCCESS"), ("o2", "t2", 20, "PENDING")],
        [("GW_A", "t1", "2026-01-02", 100, 2, "ACQUIRING")], [],
    )
    gw = spark.createDataFrame(
        [("GW_A", "t1", Decimal(100), True)], "gateway string, gw_key string, amount decimal(18,2), is_success boolean"
    )
    refunds = spark.createDataFrame(
        [("o1", Decimal(5), "SUCCESS"), ("o1", Decimal(6), "PENDING"), ("o2", Decimal(20), "SUCCESS")],
        "order_id string, refund_amount decimal(18,2), refund_status string",
    )
    row = settlements.bridge_summary(hub, gw, sett, refunds).where("gateway = 'ALL'").first()
    assert (row.net, row.refund_amount, row.adjusted_net, row.total_cost) == (98, 25, 73, 27)


# --- a hub order delivered twice -------------------------------------------------------

#: Reports in which hub rows meet settlements, gateway rows or refunds.
MEETS_HUB = [
    "recon_base", "settlement_universe", "period_universe", "join_chain_reverse", "trace_end_to_end",
    "refund_trace", "refund_trace_profile", "source_month_waterfall", "refund_rows_by_origin", "fee_rows",
    "fee_trace_to_ledger", "fee_by_dimension", "l2_summary", "l2_matched", "l3_settled", "l3_summary",
    "l3_unsettled_reason", "amount_bridge", "refund_by_gateway", "hub_refunds_by_refund_month", "join_chain_3",
    "period_summary", "recon_waterfall", "recon_scorecard", "l3_batches", "bank_scorecard", "refund_trace_3way",
]


@pytest.fixture(scope="module")
def repeated(spark, stored):
    """The stored relations with a seventh of all hub rows delivered once more."""
    path = shared_dir(spark, "hub-repeats")
    again = stored.hub.where("abs(hash(order_id)) % 7 = 0")
    assert again.count() >= 200
    stored.hub.unionByName(again).write.parquet(path)
    chain = registry.StoredChain(spark, stored.root, stored.stored)
    chain.__dict__["hub"] = spark.read.parquet(path)
    return chain


@pytest.mark.parametrize("name", MEETS_HUB)
def test_repeated_hub_rows_change_no_report(name, stored, repeated):
    """The operators themselves hold against a hub that was not reduced."""
    results = [registry.run(name, chain) for chain in (stored, repeated)]
    before, after = (rows_of(df.columns, df.collect()) for df in results)
    assert before == after


def test_the_hub_relation_has_each_order_once(spark, derived):
    """What all registered queries read: the same rows whether or not a delivery is repeated."""
    raw = sample.hub_txn(derived.spine)
    twice = raw.unionByName(raw.where("abs(hash(order_id)) % 7 = 0"))
    late = raw.where("abs(hash(order_id)) % 7 = 0").withColumns(
        {"payment_status": F.lit("FAILED"), "amount": F.lit("1")}
    )
    expected = rows_of(derived.hub.columns, derived.hub.where("status = 'SUCCESS'").collect())
    for delivered in (twice, twice.unionByName(late)):
        hub = relations.hub(delivered).where("status = 'SUCCESS'")
        assert rows_of(hub.columns, hub.collect()) == expected


def test_orders_without_a_gateway_key_stay_apart(spark, derived):
    raw = sample.hub_txn(derived.spine).limit(3)
    loose = raw.withColumn("hub_txn_id", F.lit(None).cast("string")).withColumn("payment_gateway", F.lit("GW_A"))
    assert relations.hub(loose.unionByName(loose)).count() == 3


# --- whole ledger rows, whole waterfalls ------------------------------------------------


def test_the_last_ledger_row_is_kept_whole(spark):
    rows = [
        ("a", "ledger_refunded", Decimal(5), date(2026, 1, 2), "upi", "m1", "p9", "X", "PAID", "1"),
        ("a", "ledger_refunded", Decimal(9), date(2026, 1, 3), "card", "m0", "p1", "A", "BACK", "0"),
        ("a", "ledger_refunded", Decimal(7), date(2026, 1, 3), "net", "m2", None, "B", "OPEN", None),
        ("a", "ledger_refunded", Decimal(1), None, "zzz", "m9", "p9", "Z", "ZZ", "9"),
        ("a", "ledger_revenue", Decimal(3), date(2026, 1, 9), "cash", "m3", "p2", "C", None, None),
    ]
    ledger = spark.createDataFrame(
        rows, "order_id string, ledger_table string, ledger_amount decimal(18,2), ledger_date date, mode string, "
        "mobile string, plan string, ledger_status string, payment_status string, refund_status string",
    )
    row = one_per_order(ledger, "ledger_refunded").collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "order_id": "a", "ledger_date": date(2026, 1, 3), "ledger_amount": Decimal("7.00"), "mode": "net",
        "mobile": "m2", "plan": None, "ledger_status": "B", "payment_status": "OPEN", "refund_status": None,
    }


def test_deposits_of_any_gateway_reach_the_waterfall(spark):
    hub, sett, ledger, _ = small_chain(
        spark, [("o1", "t1", 100, "SUCCESS")], [("GW_A", "t1", "2026-01-02", 100, 2, "ACQUIRING")], []
    )
    deposits = spark.createDataFrame(
        [("GW_A", date(2026, 1, 2), Decimal(98)), ("GW_B", date(2026, 1, 2), Decimal(61)), (None, date(2026, 1, 3), Decimal(7))],
        "gateway string, bank_date date, deposit decimal(18,2)",
    )
    table = base.recon_base(sett, hub, ledger, deposits)
    bank_row = base.recon_waterfall(table, deposits).where("layer = 'bank'").first()
    assert (bank_row.gw_a, bank_row.gw_b, bank_row.gw_c, bank_row.unassigned, bank_row.all_gateways) == (98, 61, 0, 7, 166)
    step = base.recon_waterfall(table, deposits).where("layer = 'bank_minus_gross'").first()
    assert (step.gw_a, step.gw_b, step.unassigned, step.all_gateways) == (-2, 61, 7, 66)


def test_a_profile_expands_combinations_not_rows(stored):
    plan = registry.run("refund_trace_profile", stored)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate stack" in line or "Expand" in line)
    assert any("Aggregate" in line for line in lines[generate:][:4])
