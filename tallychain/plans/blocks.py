"""Queries on the building blocks: sources, expressions, joins, aggregates, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.functions import dates, money, status, text
from tallychain.functions.dates import month_label
from tallychain.operators import distincts, inventory, matching, settlements, sketches
from tallychain.operators.bank import bank_daily_full, bank_monthly
from tallychain.operators.base import ledger_lookup
from tallychain.operators.frames import (
    group,
    pick_first,
    share_of_total,
    with_totals,
)
from tallychain.operators.hub_gateway import KEY, hub_scope
from tallychain.operators.trace import latest_refund
from tallychain.plans.layer1 import PATTERN
from tallychain.plans.registry import Chain, query
from tallychain.session import shared_dir
from tallychain.sources import deliveries, sinks, tables, warehouse

MONTH = Period.month("1996-01")
NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# --- sources and metadata ------------------------------------------------------------


@query("table_inventory", " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS n_rows, COUNT(*) AS n_columns,
       string_agg(column_name, ', ' ORDER BY ordinal_position) AS columns
FROM information_schema.columns WHERE table_name = '{t}'""" for t in NAMES))
def table_inventory(c: Chain):
    return inventory.table_inventory({t: c.table(t) for t in NAMES})


_HITS = [
    ("region", "r_regionkey"), ("nation", "n_nationkey"), ("nation", "n_regionkey"),
    ("customer", "c_custkey"), ("customer", "c_nationkey"), ("supplier", "s_suppkey"),
    ("supplier", "s_nationkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
    ("orders", "o_custkey"), ("orders", "o_orderdate"), ("lineitem", "l_orderkey"),
    ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_shipdate"),
]


@query("schema_search", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{col}' AS column_name, COUNT({col}) AS non_null FROM {t}"
    for t, col in _HITS))
def schema_search(c: Chain):
    return inventory.schema_search({t: c.table(t) for t in NAMES[:7]}, ["key", "date"])


@query("sample_rows", """
SELECT order_id, gateway, amount::DOUBLE AS amount, created_date FROM hub
ORDER BY created_date, order_id LIMIT 10""")
def sample_rows(c: Chain):
    return inventory.sample_rows(
        c.hub, ["order_id", "gateway", "amount", "created_date"], 10, "created_date", "order_id"
    )


@query("min_max_range", """
SELECT gateway, MIN(settled_date) AS first_value, MAX(settled_date) AS last_value,
       COUNT(settled_date) AS n_values FROM settlement GROUP BY 1""")
def min_max_range(c: Chain):
    return inventory.min_max_range(c.settlement, "settled_date", "gateway")


_HUB_TYPES = {
    "order_id": "string", "hub_txn_id": "string", "settle_key": "string", "gateway": "string",
    "amount": "decimal(18,2)", "status": "string", "order_status": "string", "created_date": "date",
    "source_month": "string", "customer_id": "string", "payment_flow": "string",
}


@query("column_profile", " UNION ALL ".join(f"""
SELECT 'hub' AS table_name, '{col}' AS column_name, '{t}' AS data_type,
       COUNT(*) FILTER ({col} IS NULL)::DOUBLE * 100 / COUNT(*) AS null_pct,
       COUNT(DISTINCT {col}) AS distinct_values,
       (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT {col}::VARCHAR AS v FROM hub
        WHERE {col} IS NOT NULL ORDER BY 1 LIMIT 3)) AS samples FROM hub""" for col, t in _HUB_TYPES.items()))
def column_profile(c: Chain):
    return inventory.column_profile(c.hub, "hub")


@query("column_profile_approx", " UNION ALL ".join(f"""
SELECT 'hub' AS table_name, '{col}' AS column_name, '{t}' AS data_type,
       COUNT(*) FILTER ({col} IS NULL)::DOUBLE * 100 / COUNT(*) AS null_pct,
       MIN({col})::VARCHAR || ', ' || MAX({col})::VARCHAR AS samples FROM hub""" for col, t in _HUB_TYPES.items()))
def column_profile_approx(c: Chain):
    """The one-pass profile without its estimate of distinct values, which SQL can't repeat."""
    return inventory.column_profile_approx(c.hub, "hub").drop("distinct_values")


@query("warehouse_scan", """
SELECT gateway, COUNT(*) AS n_rows, SUM(sett_net)::DOUBLE AS sett_net, COUNT(DISTINCT settled_date) AS days
FROM settlement WHERE year(settled_date) = 1996 AND month(settled_date) = 1 GROUP BY 1""")
def warehouse_scan(c: Chain):
    """One month read from settlements stored by month: other months are not opened."""
    root = shared_dir(c.spark, "warehouse_scan")
    warehouse.store(c.settlement, f"{root}/settlement", warehouse.MONTH_OF["settlement"])
    return group(
        warehouse.load(c.spark, root, "settlement", MONTH),
        "gateway",
        "count(*) AS n_rows",
        "sum(sett_net) AS sett_net",
        "count(DISTINCT settled_date) AS days",
    )


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def duplicate_keys(c: Chain):
    return inventory.duplicate_keys(c.lineitem, "l_orderkey", "l_linenumber")


@query("add_source_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS source_month, 'orders.parquet' AS source_file, COUNT(*) AS n_rows
FROM orders GROUP BY 1""")
def add_source_month(c: Chain):
    dated = c.orders.selectExpr("*", "CAST(o_orderdate AS DATE) AS order_day", "_metadata.file_name")
    return group(
        tables.add_source_month(dated, "order_day", file_name=False).withColumnRenamed(
            "file_name", "source_file"
        ),
        ["source_month", "source_file"],
        "count(*) AS n_rows",
    )


@query("dedupe_on_load", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_on_load(c: Chain):
    return tables.dedupe_on_load(
        c.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey", "l_extendedprice"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("dedupe_across_deliveries", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedupe_across_deliveries(c: Chain):
    """Lines that come in three deliveries, many of them again and at another price: the first counts."""
    index, target = shared_dir(c.spark, "deliveries-index"), shared_dir(c.spark, "deliveries")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = c.lineitem.select(columns)
    dearer = lines.withColumn("l_extendedprice", F.col("l_extendedprice") + 1)
    first, early = lines.where("l_orderkey % 3 <> 0"), "l_orderkey % 3 <> 0"
    second = lines.where(f"NOT ({early}) AND l_orderkey % 2 = 0").unionByName(
        dearer.where(f"({early}) AND l_orderkey % 5 = 0")
    )
    third = dearer.where(f"({early}) OR l_orderkey % 2 = 0").unionByName(lines.where(f"NOT ({early}) AND l_orderkey % 2 <> 0"))
    for name, rows in (("1", first), ("2", second), ("3", third), ("again", first)):
        deliveries.deliver(rows, columns[:2], index, target, name, *columns[2:])
    return c.spark.read.parquet(target).select(columns)


_STATE_COLUMNS = ["gateway", "amount", "status", "created_date", "customer_id"]


@query("column_profile_states", " UNION ALL ".join(f"""
SELECT 'hub' AS table_name, '{col}' AS column_name, '{_HUB_TYPES[col]}' AS data_type, COUNT(*) AS n_rows,
       COUNT(*) FILTER ({col} IS NULL)::DOUBLE * 100 / COUNT(*) AS null_pct,
       MIN({col})::VARCHAR AS smallest, MAX({col})::VARCHAR AS largest, true AS within_error
FROM hub WHERE year(created_date) = 1996""" for col in _STATE_COLUMNS))
def column_profile_states(c: Chain):
    """The profile of a year merged from monthly states, with the estimate held against a count."""
    path = shared_dir(c.spark, "profile")
    sketches.profile_store(c.hub.select(_STATE_COLUMNS), month_label("created_date"), path)
    states = sketches.profile_load(c.spark, path, "1996-01", "1996-12")
    exact = inventory.column_profile(c.hub.where("year(created_date) = 1996").select(_STATE_COLUMNS), "hub")
    counted = exact.selectExpr("column_name", "distinct_values AS counted")
    close = f"abs(distinct_values - counted) <= greatest(1, counted * {sketches.DISTINCT_ERROR}) AS within_error"
    return sketches.profile_of(states, "hub").join(counted, "column_name").selectExpr(
        "table_name", "column_name", "data_type", "n_rows", "null_pct", "smallest", "largest", close
    )


_CSV_HUB = "order_id STRING, gateway STRING, amount DECIMAL(18,2), created_date DATE"


def _csv_hub(c: Chain, root: str) -> None:
    """The hub as two CSV files: columns shuffled in one, more of them in the other, two bad rows."""
    rows = c.hub.selectExpr("order_id", "gateway", "CAST(amount AS STRING) AS amount", "created_date", "settle_key")
    bad = c.hub.where("order_id IN ('gen_1', 'gen_10', 'gen_20', 'gen_30')").limit(1).selectExpr(
        "order_id", "gateway", "'n/a' AS amount", "created_date", "settle_key"
    )
    early = "created_date < DATE'1995-01-01'"
    one = rows.where(early).unionByName(bad).select("amount", "created_date", "order_id", "gateway")
    two = rows.where(f"NOT ({early})").select("settle_key", "gateway", "order_id", "created_date", "amount")
    sinks.csv_export(one, f"{root}/hub export/early")
    sinks.csv_export(two.withColumnRenamed("amount", " AMOUNT"), f"{root}/hub export/late")


@query("csv_load", """
SELECT order_id, gateway, amount::DOUBLE AS amount, created_date FROM hub""")
def csv_load(c: Chain):
    """The hub loaded by column name from files of different layouts; a bad row stays out."""
    root = shared_dir(c.spark, "csv_load")
    _csv_hub(c, root)
    name = tables.table_name_clean(f"{root}/hub export")
    return tables.csv_load(c.spark, f"{root}/hub export/*", f"{root}/tables", name, _CSV_HUB).rows


@query("csv_load_rejects", """
SELECT 'hub' AS table_name, COUNT(*) AS loaded,
       LEAST(COUNT(*) FILTER (order_id IN ('gen_1', 'gen_10', 'gen_20', 'gen_30')), 1) AS rejected FROM hub""")
def csv_load_rejects(c: Chain):
    root = shared_dir(c.spark, "csv_load_rejects")
    _csv_hub(c, root)
    landed = tables.csv_load(c.spark, f"{root}/hub export/*", f"{root}/tables", "hub", _CSV_HUB)
    return tables.load_report({"hub": landed})


@query("csv_load_all", """
SELECT 'bank' AS table_name, COUNT(*) AS n_rows FROM bank UNION ALL
SELECT 'hub_refund', COUNT(*) FROM hub_refund UNION ALL
SELECT 'nation', COUNT(*) FROM nation""")
def csv_load_all(c: Chain):
    """Three exports loaded by pattern, untyped columns staying text."""
    root = shared_dir(c.spark, "csv_load_all")
    frames = {"bank": c.bank, "hub_refund": c.hub_refund, "nation": c.table("nation")}
    for name, df in frames.items():
        sinks.csv_export(df, f"{root}/{name}")
    landed = tables.csv_load_all(
        c.spark, {n: f"{root}/{n}/*.csv" for n in frames}, f"{root}/tables"
    )
    rows = {name: part.rows for name, part in landed.items()}
    return inventory.table_inventory(rows).select("table_name", "n_rows")


# --- expressions on the raw files --------------------------------------------------------


@query("strip_quotes", """
SELECT gateway, settlement_order_id AS clean_id, COUNT(*) AS n_rows FROM settlement GROUP BY 1, 2""")
def strip_quotes(c: Chain):
    return group(
        c.settlement_feed.selectExpr("gateway", f"{text.strip_quotes('raw_order_id')} AS clean_id"),
        ["gateway", "clean_id"],
        "count(*) AS n_rows",
    )


def _by_day(df, expr: str):
    return group(df.selectExpr(f"{expr} AS day"), "day", "count(*) AS n_rows")


@query("parse_quoted_date", """
SELECT settled_date AS day, COUNT(*) AS n_rows FROM settlement
WHERE gateway = 'GW_A' AND is_refund GROUP BY 1""")
def parse_quoted_date(c: Chain):
    rows = c.settlement_feed.where("gateway = 'GW_A' AND txn_type = 'REFUND'")
    return _by_day(rows, dates.parse_quoted_date("raw_settled_on"))


@query("parse_text_date", """
SELECT settled_date AS day, COUNT(*) AS n_rows FROM settlement WHERE gateway = 'GW_C' GROUP BY 1""")
def parse_text_date(c: Chain):
    return _by_day(c.settlement_feed.where("gateway = 'GW_C'"), dates.parse_text_date("raw_settled_on"))


@query("parse_dmy_date", """
SELECT txn_date AS day, COUNT(*) AS n_rows FROM gateway_txn WHERE gateway = 'GW_C' GROUP BY 1""")
def parse_dmy_date(c: Chain):
    return group(
        c.gateway_txn.where("gateway = 'GW_C'").selectExpr("txn_date AS day"), "day", "count(*) AS n_rows"
    )


@query("parse_month_name_date", """
SELECT ledger_date AS day, COUNT(*) AS n_rows FROM ledger WHERE ledger_table = 'ledger_topup' GROUP BY 1""")
def parse_month_name_date(c: Chain):
    return _by_day(c.ledger_sources["ledger_topup"], dates.parse_month_name_date("datetime"))


@query("ts_to_date", "SELECT bank_date AS day, COUNT(*) AS n_rows FROM bank GROUP BY 1")
def ts_to_date(c: Chain):
    return _by_day(c.bank_feed, "CAST(transaction AS DATE)")


_ORDERS_MONTH = """
SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 1 GROUP BY 1"""


@query("month_range_filter", _ORDERS_MONTH)
def month_range_filter(c: Chain):
    return group(
        c.orders.where(dates.in_period("o_orderdate", MONTH)), "o_orderstatus", "count(*) AS n_rows"
    )


@query("year_month_filter", _ORDERS_MONTH)
def year_month_filter(c: Chain):
    return group(
        c.orders.where(dates.year_month("o_orderdate", 1996, 1)), "o_orderstatus", "count(*) AS n_rows"
    )


@query("month_prefix_filter", """
SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders
WHERE CAST(o_orderdate AS VARCHAR) LIKE '1996-01%' GROUP BY 1""")
def month_prefix_filter(c: Chain):
    return group(
        c.orders.where(dates.month_prefix("o_orderdate", "1996-01")), "o_orderstatus", "count(*) AS n_rows"
    )


@query("month_bucket", """
SELECT date_trunc('month', settled_date)::DATE AS month, strftime(settled_date, '%Y-%m') AS label,
       COUNT(*) AS n_rows FROM settlement GROUP BY 1, 2""")
def month_bucket(c: Chain):
    return group(
        c.settlement.selectExpr(
            f"{dates.month_start('settled_date')} AS month", f"{dates.month_label('settled_date')} AS label"
        ),
        ["month", "label"],
        "count(*) AS n_rows",
    )


@query("forward_rows", """
SELECT gateway, sett_txn_type, is_forward, is_refund, COUNT(*) AS n_rows FROM settlement GROUP BY 1, 2, 3, 4""")
def forward_rows(c: Chain):
    return group(
        c.settlement, ["gateway", "sett_txn_type", "is_forward", "is_refund"], "count(*) AS n_rows"
    )


@query("non_refund_status", """
SELECT sett_txn_type, COUNT(*) AS n_rows FROM settlement
WHERE gateway = 'GW_C' AND (sett_txn_type NOT IN ('Refunded', 'Chargebacked') OR sett_txn_type IS NULL)
GROUP BY 1""")
def non_refund_status(c: Chain):
    rows = c.settlement.where("gateway = 'GW_C'").where(status.non_refund_status("sett_txn_type"))
    return group(rows, "sett_txn_type", "count(*) AS n_rows")


@query("adjustment_rows", """
SELECT gateway, settlement_order_id, COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross FROM settlement
WHERE (gateway = 'GW_C' AND settlement_order_id LIKE 'ADJ!_%' ESCAPE '!')
   OR (gateway = 'GW_A' AND settlement_order_id LIKE 'w-%') GROUP BY 1, 2""")
def adjustment_rows(c: Chain):
    return group(
        c.settlement.where(text.is_adjustment("gateway", "settlement_order_id")),
        ["gateway", "settlement_order_id"],
        "count(*) AS n_rows",
        "sum(sett_gross) AS gross",
    )


@query("scoped_ledger_filter", """
SELECT ledger_table, COUNT(DISTINCT order_id) AS ids, SUM(ledger_amount)::DOUBLE AS amount
FROM ledger WHERE in_scope AND year(ledger_date) = 1996 AND month(ledger_date) = 1 GROUP BY 1""")
def scoped_ledger_filter(c: Chain):
    return group(
        c.ledger.where("in_scope").where(dates.in_period("ledger_date", MONTH)),
        "ledger_table",
        "count(DISTINCT order_id) AS ids",
        "sum(ledger_amount) AS amount",
    )


@query("settlement_net", """
SELECT gateway, payment_type, SUM(sett_gross)::DOUBLE AS gross, SUM(sett_fee)::DOUBLE AS fee,
       SUM(sett_net)::DOUBLE AS net, COUNT(*) FILTER (sett_net IS NULL) AS missing
FROM settlement GROUP BY 1, 2""")
def settlement_net(c: Chain):
    return group(
        c.settlement,
        ["gateway", "payment_type"],
        "sum(sett_gross) AS gross",
        "sum(sett_fee) AS fee",
        "sum(sett_net) AS net",
        "count_if(sett_net IS NULL) AS missing",
    )


@query("fee_sign_normalize", """
SELECT gateway, COUNT(*) FILTER (signed_fee < 0) AS negative, MIN(sett_fee)::DOUBLE AS min_fee,
       SUM(sett_fee)::DOUBLE AS fee, SUM(signed_fee)::DOUBLE AS signed_fee FROM settlement GROUP BY 1""")
def fee_sign_normalize(c: Chain):
    return group(
        c.settlement.withColumnRenamed("signed_fee", "raw_fee"),
        "gateway",
        "count_if(raw_fee < 0) AS negative",
        "min(sett_fee) AS min_fee",
        "sum(sett_fee) AS fee",
        "sum(raw_fee) AS signed_fee",
    )


@query("fee_sign_class", """
SELECT gateway, CASE WHEN signed_fee < 0 THEN 'charged' WHEN signed_fee = 0 THEN 'none' ELSE 'credited' END
  AS fee_class, COUNT(*) AS n_rows FROM settlement GROUP BY 1, 2""")
def fee_sign_class(c: Chain):
    return group(
        c.settlement.selectExpr("gateway", f"{money.fee_sign_class('signed_fee')} AS fee_class"),
        ["gateway", "fee_class"],
        "count(*) AS n_rows",
    )


@query("order_prefix", """
SELECT split_part(coalesce(h.order_id, s.settlement_order_id), '_', 1) AS prefix, COUNT(*) AS n_rows
FROM settlement s LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
GROUP BY 1""")
def order_prefix(c: Chain):
    hubs = c.hub.selectExpr("gateway", "settle_key AS settlement_order_id", "order_id")
    rows = c.settlement.join(hubs, ["gateway", "settlement_order_id"], "left")
    return group(
        rows.selectExpr(f"{text.order_prefix('order_id', 'settlement_order_id')} AS prefix"),
        "prefix",
        "count(*) AS n_rows",
    )


@query("order_pattern", """
SELECT CASE WHEN order_id LIKE 'gen!_%' ESCAPE '!' THEN 'gen_*'
            WHEN order_id LIKE 'wgSub!_%' ESCAPE '!' THEN 'wgSub_*'
            WHEN order_id LIKE 'sub!_%' ESCAPE '!' THEN 'sub_*'
            WHEN order_id LIKE 'w!_%' ESCAPE '!' THEN 'w_*'
            WHEN order_id LIKE 'walletTop!_%' ESCAPE '!' THEN 'walletTop_*'
            WHEN order_id LIKE 'mr!_%' ESCAPE '!' THEN 'mr_*'
            WHEN order_id LIKE 'sd!_%' ESCAPE '!' THEN 'sd_*'
            WHEN order_id LIKE 'ott!_%' ESCAPE '!' THEN 'ott_*' ELSE 'other' END AS order_pattern,
       COUNT(*) AS n_rows FROM hub GROUP BY 1""")
def order_pattern(c: Chain):
    return group(
        c.hub.selectExpr(f"{text.order_pattern('order_id')} AS order_pattern"),
        "order_pattern",
        "count(*) AS n_rows",
    )


@query("order_pattern_regex", """
SELECT CASE WHEN regexp_matches(settlement_order_id, '^[a-zA-Z]+_')
            THEN regexp_extract(settlement_order_id, '^([a-zA-Z]+)_', 1) || '_*' ELSE 'other' END AS order_pattern,
       COUNT(*) AS n_rows FROM settlement GROUP BY 1""")
def order_pattern_regex(c: Chain):
    return group(
        c.settlement.selectExpr(f"{text.order_pattern_regex('settlement_order_id')} AS order_pattern"),
        "order_pattern",
        "count(*) AS n_rows",
    )


@query("pattern_to_ledger", f"""
WITH r(p, t) AS (VALUES ('gen_*', 'ledger_revenue'), ('wgSub_*', 'ledger_revenue'),
  ('sub_*', 'ledger_revenue'), ('walletTop_*', 'ledger_topup'), ('w_*', 'ledger_net_income'),
  ('mr_*', 'ledger_mobile'), ('sd_*', 'ledger_deposit'), ('ott_*', 'ledger_ott'))
SELECT r.t AS expected_ledger, COUNT(*) AS n_rows
FROM hub LEFT JOIN r ON r.p = {PATTERN.format('order_id')} GROUP BY 1""")
def pattern_to_ledger(c: Chain):
    expected = text.expected_ledger(text.order_pattern("order_id"))
    return group(c.hub.selectExpr(f"{expected} AS expected_ledger"), "expected_ledger", "count(*) AS n_rows")


@query("gateway_to_bank_label", """
SELECT b.bank_label, s.gateway, COUNT(*) AS n_rows
FROM settlement s JOIN (SELECT DISTINCT gateway, bank_label FROM bank) b ON b.gateway = s.gateway GROUP BY 1, 2""")
def gateway_to_bank_label(c: Chain):
    return group(
        c.settlement.selectExpr("gateway", f"{status.bank_label('gateway')} AS bank_label"),
        ["bank_label", "gateway"],
        "count(*) AS n_rows",
    )


@query("source_month_bucket", """
SELECT CASE WHEN created_date < DATE '1995-12-01' THEN 'EARLIER'
            WHEN created_date < DATE '1996-01-01' THEN 'PREVIOUS_MONTH'
            WHEN created_date < DATE '1996-02-01' THEN 'THIS_MONTH' ELSE 'LATER' END AS bucket,
       COUNT(*) AS n_rows FROM hub GROUP BY 1""")
def source_month_bucket(c: Chain):
    return group(
        c.hub.selectExpr(f"{status.source_month_bucket('created_date', MONTH)} AS bucket"),
        "bucket",
        "count(*) AS n_rows",
    )


@query("hub_category", """
SELECT gateway, CASE WHEN status = 'SUCCESS' AND source_month = '1996-01' THEN '1 period success'
            WHEN status = 'SUCCESS' THEN '2 other month success' ELSE '3 not success' END AS category,
       COUNT(*) AS n_rows FROM hub GROUP BY 1, 2
UNION ALL SELECT gateway, '4 gateway only', COUNT(*) FROM gateway_txn g WHERE NOT EXISTS
  (SELECT 1 FROM hub h WHERE h.gateway = g.gateway AND h.settle_key = g.gw_key) GROUP BY 1""")
def hub_category(c: Chain):
    gws = group(c.gateway_txn, KEY, "max(gw_key) AS gateway_txn_id", "count(*) AS n")
    hubs = c.hub.selectExpr("gateway", "settle_key AS gw_key", "order_id", "status", "source_month")
    category = status.hub_category("order_id", "gateway_txn_id", "status", "source_month", "1996-01")
    return group(
        hubs.join(gws, KEY, "full").selectExpr("gateway", f"{category} AS category", "order_id", "n"),
        ["gateway", "category"],
        "sum(CASE WHEN order_id IS NULL THEN n ELSE 1 END) AS n_rows",
    )


@query("mismatch_reason", """
SELECT h.order_id, 'hub ' || h.amount::VARCHAR || ' vs gateway ' || g.amount::VARCHAR AS reason
FROM hub h JOIN gateway_txn g ON g.gateway = h.gateway AND g.gw_key = h.settle_key
WHERE h.amount <> g.amount""")
def mismatch_reason(c: Chain):
    gws = c.gateway_txn.selectExpr("gateway", "gw_key AS settle_key", "amount AS gw_amount")
    return (
        c.hub.join(gws, ["gateway", "settle_key"])
        .where("amount <> gw_amount")
        .selectExpr("order_id", "concat('hub ', amount, ' vs gateway ', gw_amount) AS reason")
    )


@query("safe_pct", """
WITH m AS (SELECT gateway, sett_utr, SUM(sett_fee)::DOUBLE AS f,
                  coalesce(SUM(sett_gross) FILTER (is_refund), 0)::DOUBLE AS r FROM settlement GROUP BY 1, 2)
SELECT gateway, sett_utr, CASE WHEN r = 0 THEN 0 ELSE f * 100 / r END AS fee_pct FROM m""")
def safe_pct(c: Chain):
    rows = group(
        c.settlement,
        ["gateway", "sett_utr"],
        "sum(sett_fee) AS f",
        f"{money.total('sett_gross', 'is_refund')} AS r",
    )
    return rows.selectExpr("gateway", "sett_utr", money.safe_pct("f", "r") + " AS fee_pct")


@query("coerce_numeric", """
SELECT o_orderpriority, COUNT(TRY_CAST(split_part(o_orderpriority, '-', 1) AS DECIMAL(18,2))) AS numeric_first,
       COUNT(TRY_CAST(o_orderpriority AS DECIMAL(18,2))) AS numeric_whole,
       SUM(TRY_CAST(split_part(o_orderpriority, '-', 1) AS DECIMAL(18,2)))::DOUBLE AS total
FROM orders GROUP BY 1""")
def coerce_numeric(c: Chain):
    first = money.coerce_numeric("split_part(o_orderpriority, '-', 1)")
    return group(
        c.orders,
        "o_orderpriority",
        f"count({first}) AS numeric_first",
        f"count({money.coerce_numeric('o_orderpriority')}) AS numeric_whole",
        f"sum({first}) AS total",
    )


@query("null_label", """
SELECT coalesce(error_description, 'N/A') AS error, COUNT(*) AS n_rows FROM gateway_txn GROUP BY 1""")
def null_label(c: Chain):
    return group(
        c.gateway_txn.selectExpr(f"{text.null_label('error_description', 'N/A')} AS error"),
        "error",
        "count(*) AS n_rows",
    )


_DAY_DIFF = """
WITH s AS (SELECT gateway, settled_date AS d, SUM(sett_net) AS net FROM settlement
           WHERE is_forward AND gateway <> 'GW_A' GROUP BY 1, 2),
x AS (SELECT coalesce(s.gateway, b.gateway) AS gateway, coalesce(b.bank_daily_deposit, 0) - coalesce(net, 0) AS diff
      FROM s FULL JOIN (SELECT * FROM bank_daily WHERE gateway <> 'GW_A') b
        ON b.gateway = s.gateway AND b.bank_date = s.d)"""


@query("outlier_flag", _DAY_DIFF + """
SELECT gateway, abs(diff) > 50000 AS is_outlier, COUNT(*) AS days FROM x GROUP BY 1, 2""")
def outlier_flag(c: Chain):
    days = bank_daily_full(c.settlement, c.bank)
    return group(days, ["gateway", "is_outlier"], "count(*) AS days")


@query("join_full_outer_date", _DAY_DIFF + """
SELECT gateway, COUNT(*) AS days, SUM(diff)::DOUBLE AS diff FROM x GROUP BY 1""")
def join_full_outer_date(c: Chain):
    days = bank_daily_full(c.settlement, c.bank)
    return group(days, "gateway", "count(*) AS days", "sum(daily_diff) AS diff")


@query("gap_status", """
WITH s AS (SELECT gateway AS g, date_trunc('month', settled_date) AS m, SUM(sett_net) AS net
           FROM settlement WHERE gateway = 'GW_A' OR is_forward GROUP BY 1, 2),
b AS (SELECT gateway AS g, date_trunc('month', bank_date) AS m, SUM(deposit) AS dep FROM bank GROUP BY 1, 2),
p AS (SELECT s.g, CASE WHEN dep = 0 THEN 0 ELSE (dep - net)::DOUBLE * 100 / dep::DOUBLE END AS pct
      FROM s JOIN b ON b.g = s.g AND b.m = s.m)
SELECT g AS gateway, CASE WHEN abs(pct) < 3 THEN 'CLEAN' WHEN abs(pct) < 10 THEN 'REVIEW' ELSE 'MISMATCH' END
  AS status, COUNT(*) AS months FROM p GROUP BY 1, 2""")
def gap_status(c: Chain):
    months = bank_monthly(c.settlement, c.bank).where("reconcilable")
    return group(
        months.selectExpr("gateway", f"{money.gap_status('gap_pct')} AS status"),
        ["gateway", "status"],
        "count(*) AS months",
    )


# --- joins ---------------------------------------------------------------------------


@query("join_inner", """
SELECT l.ledger_table, COUNT(*) AS n_rows, SUM(h.amount)::DOUBLE AS hub_amount
FROM ledger l JOIN hub h ON h.order_id = l.order_id GROUP BY 1""")
def join_inner(c: Chain):
    rows = c.ledger.join(c.hub, "order_id")
    return group(rows, "ledger_table", "count(*) AS n_rows", "sum(amount) AS hub_amount")


@query("join_inner_expr", """
SELECT h.gateway, COUNT(*) AS n_rows, SUM(g.amount)::DOUBLE AS gateway_amount
FROM hub h JOIN gateway_txn g ON h.hub_txn_id = g.gw_key GROUP BY 1""")
def join_inner_expr(c: Chain):
    gws = c.gateway_txn.selectExpr("gw_key AS hub_txn_id", "amount AS gateway_amount")
    rows = c.hub.join(gws, "hub_txn_id")
    return group(rows, "gateway", "count(*) AS n_rows", "sum(gateway_amount) AS gateway_amount")


@query("join_key_by_gateway", """
SELECT h.gateway, COUNT(*) AS n_rows FROM hub h JOIN gateway_txn g ON g.gateway = h.gateway
 AND g.gw_key = CASE WHEN h.gateway = 'GW_D' THEN h.order_id ELSE h.hub_txn_id END GROUP BY 1""")
def join_key_by_gateway(c: Chain):
    rows = c.hub.join(c.gateway_txn.selectExpr("gateway", "gw_key AS settle_key"), ["gateway", "settle_key"])
    return group(rows, "gateway", "count(*) AS n_rows")


@query("join_left", """
SELECT s.gateway, COUNT(*) AS n_rows, COUNT(h.order_id) AS matched
FROM settlement s LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id GROUP BY 1""")
def join_left(c: Chain):
    hubs = c.hub.selectExpr("gateway", "settle_key AS settlement_order_id", "order_id")
    rows = c.settlement.join(hubs, ["gateway", "settlement_order_id"], "left")
    return group(rows, "gateway", "count(*) AS n_rows", "count(order_id) AS matched")


@query("join_left_lookup", """
SELECT s.gateway, COUNT(*) AS n_rows, COUNT(b.bank_date) AS with_bank, COUNT(h.order_id) AS with_hub,
       COUNT(w.order_id) AS with_ledger
FROM settlement s LEFT JOIN bank_daily b ON b.gateway = s.gateway AND b.bank_date = s.settled_date
LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key = s.settlement_order_id
LEFT JOIN lookup_all w ON w.order_id = h.order_id GROUP BY 1""")
def join_left_lookup(c: Chain):
    rows = matching.lookup_join(c.settlement, c.hub, ledger_lookup(c.ledger), c.bank)
    return group(
        rows,
        "gateway",
        "count(*) AS n_rows",
        "count(bank_daily_deposit) AS with_bank",
        "count(order_id) AS with_hub",
        "count(ledger_txn_id) AS with_ledger",
    )


@query("anti_unmatched", """
SELECT l.ledger_table, COUNT(*) AS n_rows FROM ledger l LEFT JOIN hub h ON h.order_id = l.order_id
WHERE h.order_id IS NULL GROUP BY 1""")
def anti_unmatched(c: Chain):
    return group(matching.unmatched(c.ledger, c.hub, "order_id", repeats=False), "ledger_table", "count(*) AS n_rows")


_SIX = ["ledger_booking", "ledger_revenue", "ledger_net_income", "ledger_mobile", "ledger_deposit", "ledger_ott"]


@query("anti_multi_not_in", "SELECT gateway, COUNT(*) AS n_rows FROM hub WHERE " + " AND ".join(
    f"order_id NOT IN (SELECT order_id FROM ledger WHERE ledger_table = '{t}')" for t in _SIX) + " GROUP BY 1")
def anti_multi_not_in(c: Chain):
    six = [c.ledger.where(f"ledger_table = '{t}'") for t in _SIX]
    return group(matching.unmatched_in_all(c.hub, six, "order_id"), "gateway", "count(*) AS n_rows")


@query("anti_union_cte", """
WITH ids AS (SELECT order_id FROM ledger UNION SELECT order_id FROM hub_refund)
SELECT gateway, COUNT(*) AS n_rows FROM hub WHERE order_id NOT IN (SELECT order_id FROM ids) GROUP BY 1""")
def anti_union_cte(c: Chain):
    return group(
        matching.unmatched_in_all(c.hub, [c.ledger, c.hub_refund], "order_id"), "gateway", "count(*) AS n_rows"
    )


@query("anti_exists", """
SELECT gateway, COUNT(*) AS n_rows FROM gateway_txn g WHERE NOT EXISTS
 (SELECT 1 FROM hub h WHERE h.gateway = g.gateway AND h.settle_key = g.gw_key AND h.status = 'SUCCESS') GROUP BY 1""")
def anti_exists(c: Chain):
    hubs = hub_scope(c.hub).withColumnRenamed("settle_key", "gw_key")
    return group(matching.unmatched(c.gateway_txn, hubs, *KEY, repeats=False), "gateway", "count(*) AS n_rows")


@query("anti_filtered_right", """
SELECT g.gateway, COUNT(DISTINCT g.gw_key) AS ids FROM gateway_txn g
LEFT JOIN hub h ON h.gateway = g.gateway AND h.settle_key = g.gw_key
  AND h.status = 'SUCCESS' AND h.source_month = '1996-01'
WHERE g.txn_date >= DATE '1996-01-01' AND g.txn_date < DATE '1996-02-01' AND h.order_id IS NULL GROUP BY 1""")
def anti_filtered_right(c: Chain):
    hubs = hub_scope(c.hub, MONTH).withColumnRenamed("settle_key", "gw_key")
    rows = matching.unmatched(
        c.gateway_txn.where(dates.in_period("txn_date", MONTH)), hubs, *KEY, repeats=False
    )
    return group(rows, "gateway", "count(DISTINCT gw_key) AS ids")


@query("semi_in", """
SELECT refund_status, COUNT(*) AS n_rows, SUM(refund_amount)::DOUBLE AS amount FROM hub_refund
WHERE order_id IN (SELECT order_id FROM hub WHERE status = 'SUCCESS') GROUP BY 1""")
def semi_in(c: Chain):
    rows = matching.matched(c.hub_refund, hub_scope(c.hub), "order_id", repeats=False)
    return group(rows, "refund_status", "count(*) AS n_rows", "sum(refund_amount) AS amount")


@query("semi_in_list", """
WITH pick AS (SELECT order_id FROM hub ORDER BY amount DESC, order_id LIMIT 25)
SELECT ledger_table, order_id, ledger_amount::DOUBLE AS ledger_amount FROM ledger
WHERE order_id IN (SELECT order_id FROM pick)""")
def semi_in_list(c: Chain):
    """Ledger rows of a picked id list; the list stays a frame instead of a literal."""
    pick = inventory.sample_rows(c.hub, ["order_id"], 25, "amount DESC", "order_id")
    return matching.matched(c.ledger, pick, "order_id").select("ledger_table", "order_id", "ledger_amount")


@query("merge_full_months", """
WITH s AS (SELECT date_trunc('month', settled_date)::DATE AS m, SUM(sett_net) AS net FROM settlement
           WHERE is_forward GROUP BY 1),
b AS (SELECT date_trunc('month', bank_date)::DATE AS m, SUM(deposit) AS dep FROM bank GROUP BY 1)
SELECT coalesce(s.m, b.m) AS month, coalesce(net, 0)::DOUBLE AS sett_net, coalesce(dep, 0)::DOUBLE AS deposit
FROM s FULL JOIN b ON b.m = s.m""")
def merge_full_months(c: Chain):
    return matching.monthly_merge(c.settlement, c.bank)


@query("join_case_condition", """
WITH s AS (SELECT gateway, settled_date, SUM(sett_net) AS net FROM settlement WHERE is_forward GROUP BY 1, 2),
b AS (SELECT bank_label, bank_date, SUM(deposit) AS dep FROM bank GROUP BY 1, 2),
x AS (SELECT s.*, b.bank_label, b.dep, CASE s.gateway WHEN 'GW_A' THEN '01 Wallet A' WHEN 'GW_B' THEN '05 Wallet B'
             WHEN 'GW_C' THEN '02 Wallet C' ELSE '06 Wallet D' END AS lbl
      FROM s LEFT JOIN b ON b.bank_date = s.settled_date AND b.bank_label =
        CASE s.gateway WHEN 'GW_A' THEN '01 Wallet A' WHEN 'GW_B' THEN '05 Wallet B'
             WHEN 'GW_C' THEN '02 Wallet C' ELSE '06 Wallet D' END)
SELECT gateway, lbl AS bank_label, COUNT(*) AS sett_days, COUNT(dep) AS bank_days, SUM(net)::DOUBLE AS net,
       coalesce(SUM(dep), 0)::DOUBLE AS deposit FROM x GROUP BY 1, 2""")
def join_case_condition(c: Chain):
    return matching.deposits_by_label(c.settlement, c.bank)


@query("join_chain_3", """
SELECT h.gateway, h.source_month, COUNT(*) AS hub_txns, SUM(h.amount)::DOUBLE AS hub_amount,
       SUM(g.gw_amount)::DOUBLE AS gateway_amount, SUM(s.gross)::DOUBLE AS gross
FROM hub h JOIN gw_by_key g ON g.gateway = h.gateway AND g.gw_key = h.settle_key
JOIN sett_by_key s ON s.gateway = h.gateway AND s.gw_key = h.settle_key
WHERE h.status = 'SUCCESS' GROUP BY 1, 2""")
def join_chain_3(c: Chain):
    return group(
        settlements.chain(c.hub, c.gateway_txn, c.settlement, how="inner"),
        ["gateway", "source_month"],
        "count(*) AS hub_txns",
        "sum(amount) AS hub_amount",
        "sum(gw_amount) AS gateway_amount",
        "sum(gross) AS gross",
    )


@query("join_chain_reverse", """
WITH t AS (SELECT DISTINCT gateway, gw_key FROM gateway_txn)
SELECT s.gateway, COUNT(*) AS sett_rows, COUNT(t.gw_key) AS in_gateway, COUNT(h.order_id) AS in_hub
FROM settlement s LEFT JOIN t ON t.gateway = s.gateway AND t.gw_key = s.settlement_order_id
LEFT JOIN hub h ON h.gateway = s.gateway AND h.settle_key =
  CASE WHEN s.gateway = 'GW_D' THEN s.settlement_order_id ELSE t.gw_key END
WHERE s.gateway <> 'GW_D' GROUP BY 1""")
def join_chain_reverse(c: Chain):
    rows = settlements.traced_back(c.settlement.where("gateway <> 'GW_D'"), c.gateway_txn, c.hub)
    return group(
        rows,
        "gateway",
        "sum(sett_rows) AS sett_rows",
        "sum(CASE WHEN gateway_txn_id IS NOT NULL THEN sett_rows ELSE 0 END) AS in_gateway",
        "sum(CASE WHEN order_id IS NOT NULL THEN sett_rows ELSE 0 END) AS in_hub",
    )


@query("date_level_match", """
WITH s AS (SELECT gateway, settled_date, COUNT(*) AS n, SUM(sett_net) AS net FROM settlement
           WHERE is_forward GROUP BY 1, 2)
SELECT s.gateway, COUNT(*) AS matched_days, SUM(n)::BIGINT AS sett_rows, SUM(net)::DOUBLE AS sett_net,
       SUM(b.bank_daily_deposit)::DOUBLE AS bank_deposit,
       (SUM(b.bank_daily_deposit) - SUM(net))::DOUBLE AS gap,
       (SUM(b.bank_daily_deposit) - SUM(net))::DOUBLE * 100 / SUM(net)::DOUBLE AS gap_pct
FROM s JOIN bank_daily b ON b.gateway = s.gateway AND b.bank_date = s.settled_date GROUP BY 1""")
def date_level_match(c: Chain):
    return matching.date_level_match(c.settlement, c.bank)


# --- aggregates ----------------------------------------------------------------------


@query("agg_global", """
SELECT COUNT(*) AS n_rows, SUM(sett_gross)::DOUBLE AS gross, MIN(settled_date) AS first_date,
       MAX(settled_date) AS last_date, SUM(sett_gross)::DOUBLE / COUNT(*) AS avg_gross
FROM settlement WHERE is_forward""")
def agg_global(c: Chain):
    return group(
        c.settlement.where("is_forward"),
        [],
        "count(*) AS n_rows",
        f"{money.total('sett_gross')} AS gross",
        "min(settled_date) AS first_date",
        "max(settled_date) AS last_date",
    ).selectExpr("*", "CAST(gross AS DOUBLE) / n_rows AS avg_gross")


@query("agg_group", """
SELECT gateway, method, COUNT(*) AS n_rows, SUM(sett_net)::DOUBLE AS net FROM settlement GROUP BY 1, 2""")
def agg_group(c: Chain):
    return group(c.settlement, ["gateway", "method"], "count(*) AS n_rows", "sum(sett_net) AS net")


@query("agg_group_expr", f"""
SELECT {PATTERN.format('order_id')} AS order_pattern, strftime(created_date, '%Y') AS year,
       COUNT(*) AS n_rows, SUM(amount)::DOUBLE AS amount FROM hub GROUP BY 1, 2""")
def agg_group_expr(c: Chain):
    return group(
        c.hub.selectExpr(
            f"{text.order_pattern('order_id')} AS order_pattern", "left(source_month, 4) AS year", "amount"
        ),
        ["order_pattern", "year"],
        "count(*) AS n_rows",
        "sum(amount) AS amount",
    )


@query("agg_count_distinct", """
SELECT gateway, COUNT(DISTINCT settlement_order_id) AS ids FROM settlement GROUP BY 1""")
def agg_count_distinct(c: Chain):
    return group(c.settlement, "gateway", "count(DISTINCT settlement_order_id) AS ids")


@query("agg_multi_distinct", """
SELECT gateway, COUNT(DISTINCT settlement_order_id) AS ids, COUNT(DISTINCT sett_utr) AS batches,
       COUNT(DISTINCT settled_date) AS days, SUM(sett_net)::DOUBLE AS net FROM settlement GROUP BY 1""")
def agg_multi_distinct(c: Chain):
    return group(
        c.settlement,
        "gateway",
        "count(DISTINCT settlement_order_id) AS ids",
        "count(DISTINCT sett_utr) AS batches",
        "count(DISTINCT settled_date) AS days",
        "sum(sett_net) AS net",
    )


def _monthly_states(c: Chain):
    """Stored states of the ids, batches and days that each gateway settles in each month."""
    rows = c.settlement.where("settled_date IS NOT NULL").selectExpr(
        "gateway", f"{month_label('settled_date')} AS month", "settlement_order_id", "sett_utr", "settled_date"
    )
    for column in ("settlement_order_id", "sett_utr"):
        path = shared_dir(c.spark, f"numbers-{column}")
        distincts.number_keys(rows, column).write.parquet(path)
        rows = distincts.with_number(rows, column, c.spark.read.parquet(path), f"{column}_number")
    path = shared_dir(c.spark, "distinct-states")
    counted = {"ids": "settlement_order_id_number", "batches": "sett_utr_number", "days": "unix_date(settled_date)"}
    distincts.distinct_store(distincts.distinct_states(rows, ["gateway", "month"], counted), path, "month")
    return distincts.distinct_load(c.spark, path, "month")


@query("agg_multi_distinct_states", """
SELECT gateway, COUNT(DISTINCT settlement_order_id) AS ids, COUNT(DISTINCT sett_utr) AS batches,
       COUNT(DISTINCT settled_date) AS days FROM settlement WHERE settled_date IS NOT NULL GROUP BY 1""")
def agg_multi_distinct_states(c: Chain):
    """Three distinct counts over all months from monthly bitmaps."""
    return distincts.distinct_counts(_monthly_states(c), ["gateway"], ["ids", "batches", "days"])


@query("agg_distinct_to_month", """
WITH m AS (SELECT DISTINCT gateway, strftime(settled_date, '%Y-%m') AS month, settlement_order_id AS id
           FROM settlement WHERE settled_date IS NOT NULL AND settlement_order_id IS NOT NULL),
f AS (SELECT gateway, id, MIN(month) AS first_month FROM m GROUP BY 1, 2)
SELECT g.gateway, g.month, COUNT(*) FILTER (f.first_month = g.month) AS new_keys, COUNT(*) AS keys_so_far
FROM (SELECT DISTINCT gateway, month FROM m) g JOIN f ON f.gateway = g.gateway AND f.first_month <= g.month
GROUP BY 1, 2""")
def agg_distinct_to_month(c: Chain):
    """Ids that a gateway settles for the first time in each month, and up to its end."""
    return distincts.counts_to_month(_monthly_states(c), ["gateway"], "month", "ids")


@query("agg_conditional", """
SELECT gateway, COUNT(*) FILTER (is_forward) AS forward_rows, COUNT(*) FILTER (is_refund) AS refund_rows,
       SUM(CASE WHEN is_forward THEN sett_gross ELSE 0 END)::DOUBLE AS forward_gross,
       SUM(CASE WHEN is_refund THEN sett_gross ELSE 0 END)::DOUBLE AS refund_gross FROM settlement GROUP BY 1""")
def agg_conditional(c: Chain):
    return group(
        c.settlement,
        "gateway",
        "count_if(is_forward) AS forward_rows",
        "count_if(is_refund) AS refund_rows",
        f"{money.total('sett_gross', 'is_forward')} AS forward_gross",
        f"{money.total('sett_gross', 'is_refund')} AS refund_gross",
    )


@query("agg_presence", """
SELECT gateway, settlement_order_id, MAX(CASE WHEN is_refund THEN 1 ELSE 0 END) AS has_refund,
       MAX(method) AS last_method, bool_or(is_forward) AS has_forward FROM settlement GROUP BY 1, 2""")
def agg_presence(c: Chain):
    return group(
        c.settlement,
        ["gateway", "settlement_order_id"],
        "max(int(is_refund)) AS has_refund",
        "max(method) AS last_method",
        "bool_or(is_forward) AS has_forward",
    )


_DAYS = "SELECT gateway, settled_date, COUNT(*) AS n, SUM(sett_net) AS net FROM settlement GROUP BY 1, 2"


@query("agg_two_level", f"""
WITH d AS ({_DAYS}) SELECT gateway, COUNT(*) AS days, MAX(n) AS busiest, MAX(net)::DOUBLE AS best_day,
       SUM(net)::DOUBLE AS net FROM d GROUP BY 1""")
def agg_two_level(c: Chain):
    days = group(
        c.settlement, ["gateway", "settled_date"], "count(*) AS n", "sum(sett_net) AS net"
    )
    return group(
        days, "gateway", "count(*) AS days", "max(n) AS busiest", "max(net) AS best_day", "sum(net) AS net"
    )


@query("agg_having", """
SELECT settled_date, gateway, COUNT(*) AS n, SUM(sett_net)::DOUBLE AS net FROM settlement
GROUP BY 1, 2 HAVING abs(SUM(sett_net)) > 100000""")
def agg_having(c: Chain):
    days = group(
        c.settlement, ["settled_date", "gateway"], "count(*) AS n", "sum(sett_net) AS net"
    )
    return days.where("abs(net) > 100000")


@query("agg_subtotals", """
SELECT coalesce(s.gateway, 'ALL') AS gateway, coalesce(s.method, 'ALL') AS method, COUNT(*) AS n_rows,
       SUM(sett_net)::DOUBLE AS net FROM settlement s GROUP BY ROLLUP (s.gateway, s.method)""")
def agg_subtotals(c: Chain):
    rows = group(c.settlement, ["gateway", "method"], "count(*) AS n_rows", "sum(sett_net) AS net")
    return with_totals(rows, ["gateway", "method"], "n_rows", "net")


@query("agg_pivot_gateway", """
SELECT method, SUM(sett_gross) FILTER (gateway = 'GW_A')::DOUBLE AS gw_a,
       SUM(sett_gross) FILTER (gateway = 'GW_B')::DOUBLE AS gw_b,
       SUM(sett_gross) FILTER (gateway = 'GW_C')::DOUBLE AS gw_c,
       SUM(sett_gross) FILTER (gateway = 'GW_D')::DOUBLE AS gw_d FROM settlement GROUP BY 1""")
def agg_pivot_gateway(c: Chain):
    wide = c.settlement.groupBy("method").pivot("gateway", ["GW_A", "GW_B", "GW_C", "GW_D"])
    return wide.sum("sett_gross").toDF("method", "gw_a", "gw_b", "gw_c", "gw_d")


@query("value_counts", """
SELECT error_description, COUNT(*) AS n_rows FROM gateway_txn WHERE error_description IS NOT NULL GROUP BY 1""")
def value_counts(c: Chain):
    return inventory.value_counts(c.gateway_txn, "error_description")


@query("share_of_total", """
SELECT method, COUNT(*) AS n_rows, COUNT(*)::DOUBLE * 100 / SUM(COUNT(*)) OVER () AS share_pct
FROM settlement GROUP BY 1""")
def share_total(c: Chain):
    return share_of_total(group(c.settlement, "method", "count(*) AS n_rows"), "n_rows")


# --- windows, sorts, set operations ------------------------------------------------------


@query("window_priority_pick", """
SELECT order_id, ledger_table, ledger_amount::DOUBLE AS ledger_amount FROM lookup""")
def window_priority_pick(c: Chain):
    rows = c.ledger.where("priority IS NOT NULL AND order_id IS NOT NULL")
    return pick_first(rows, ["order_id"], "priority", "ledger_amount").select(
        "order_id", "ledger_table", "ledger_amount"
    )


_LATEST = """
SELECT order_id, refund_unique_id, refund_date, refund_amount::DOUBLE AS refund_amount FROM (
  SELECT DISTINCT ON (order_id) * FROM hub_refund WHERE refund_status = 'SUCCESS'
  ORDER BY order_id, refund_date DESC NULLS LAST, refund_unique_id DESC)"""


@query("window_distinct_on", _LATEST)
def window_distinct_on(c: Chain):
    rows = c.hub_refund.where("refund_status = 'SUCCESS'")
    return pick_first(rows, ["order_id"], "refund_date DESC", "refund_unique_id DESC").select(
        "order_id", "refund_unique_id", "refund_date", "refund_amount"
    )


@query("latest_refund", _LATEST)
def latest(c: Chain):
    return latest_refund(c.hub_refund).select(
        "order_id", "refund_unique_id", "refund_date", "refund_amount"
    )


@query("sort_multi", """
SELECT gateway, sett_txn_type, COUNT(*) AS n_rows FROM settlement GROUP BY 1, 2
ORDER BY gateway, COUNT(*) DESC, sett_txn_type""")
def sort_multi(c: Chain):
    rows = group(c.settlement, ["gateway", "sett_txn_type"], "count(*) AS n_rows")
    return rows.orderBy("gateway", rows["n_rows"].desc(), rows["sett_txn_type"].asc_nulls_last())


@query("union_all", """
SELECT order_id, ledger_table, ledger_amount::DOUBLE AS ledger_amount FROM ledger""")
def union_every_ledger(c: Chain):
    return c.ledger.select("order_id", "ledger_table", "ledger_amount")


@query("union_distinct", """
SELECT order_id FROM ledger UNION SELECT order_id FROM hub""")
def union_distinct(c: Chain):
    return c.ledger.select("order_id").union(c.hub.select("order_id")).distinct()


@query("hub_lookup", """
SELECT gateway, settle_key, order_id, hub_txn_id, amount::DOUBLE AS amount, status, created_date FROM hub""")
def hub_lookup(c: Chain):
    return c.hub.select(
        "gateway", "settle_key", "order_id", "hub_txn_id", "amount", "status", "created_date"
    )
