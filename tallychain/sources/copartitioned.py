"""Settlements and traced orders stored alike, so that a run joins them without an exchange.

Both tables are bucketed by (gateway, key, part). ``part`` is 0 but for a key with more
settlement rows than ``rows_per_part``: its rows are spread over several parts, hence over
several files and tasks, and its order stands in each of them. Which keys are split, and into
how many parts, is stored beside the tables, and rows that come later are filed by the same
list. So the join on all three columns finds every row exactly once, however the keys grow;
a key that grows hot after the list was made is filed right, but not split before a rewrite.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallychain.config import Period
from tallychain.functions.dates import in_period, month_label
from tallychain.operators.base import classified, traced_orders, with_deposits
from tallychain.operators.frames import group

KEY = ["gateway", "gw_key"]
FILED = [*KEY, "part"]
MONTH = "file_month"

#: Settlement rows of one key in a part; a key with more of them is split.
ROWS_PER_PART = 1_000_000
#: Files of each table and month. Both tables need the same number.
BUCKETS = 1024
#: Settlement rows of all months in a bucket, where buckets follow the rows: a task sorts one.
ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class Layout:
    """Two tables laid out alike: where they are, their buckets, and their names in this session."""

    root: str
    buckets: int
    settlement: str
    orders: str


def split_keys(rows: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(gateway, gw_key, parts) of the keys with more than ``rows_per_part`` rows.

    Counted map-side first. There are at most ``rows / rows_per_part`` such keys.
    """
    counts = group(rows.na.drop(subset=KEY), KEY, "count(*) AS n").where(F.col("n") > rows_per_part)
    return counts.select(*KEY, F.ceil(F.col("n") / rows_per_part).cast("int").alias("parts"))


def spread(rows: DataFrame, split: DataFrame, buckets: int, by: str | None = None) -> DataFrame:
    """``rows`` with their ``part``, drawn from a hash of the whole row, or of ``by`` (SQL).

    Equal rows of a key share a part: give ``by`` where many are equal, such as a row number
    that the source has. A row without a key joins nothing and is spread over all buckets.
    """
    drawn = F.xxhash64(F.expr(by)) if by else F.xxhash64(*rows.columns)
    keyed = F.col("gateway").isNotNull() & F.col("gw_key").isNotNull()
    parts = F.when(keyed, F.coalesce("parts", F.lit(1))).otherwise(F.lit(buckets))
    return (
        rows.withColumn("_drawn", drawn)
        .join(split, KEY, "left")
        .withColumn("part", F.pmod("_drawn", parts).cast("int"))
        .drop("_drawn", "parts")
    )


def repeated(orders: DataFrame, split: DataFrame) -> DataFrame:
    """``orders``, one row a key, repeated in every part of their key."""
    return (
        orders.join(split, KEY, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .drop("parts")
    )


def _bucketed(rows: DataFrame, path: str, buckets: int, *months: str) -> None:
    """Write one file a bucket and month; the shuffle deals rows as the buckets do."""
    name = f"writes_{uuid.uuid4().hex}"
    writer = rows.repartition(buckets, *FILED).sortWithinPartitions(*months, *FILED).write
    if months:
        writer = writer.partitionBy(*months)
    writer.bucketBy(buckets, *FILED).sortBy(*FILED).option("path", path).format("parquet").saveAsTable(name)
    # A table without a month has no file to tell its columns.
    rows.limit(0).write.parquet(f"{path}_columns")
    # The table's files stay: it is external. ``opened`` names them anew in any session.
    rows.sparkSession.sql(f"DROP TABLE {name}")


def _named(spark: SparkSession, path: str, buckets: int, *months: str) -> str:
    """An external table over the files at ``path``, for the session's catalog."""
    name = f"alike_{uuid.uuid4().hex}"
    columns = spark.read.parquet(f"{path}_columns").schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in columns]
    filed = f"PARTITIONED BY ({', '.join(months)}) " if months else ""
    keys = ", ".join(FILED)
    # As an option of the table, since a writer's own is not heard by an insert.
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(fields)}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') {filed}"
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    if months:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def store_alike(
    settlement: DataFrame,
    hub: DataFrame,
    ledger: DataFrame,
    root: str,
    buckets: int = BUCKETS,
    rows_per_part: int = ROWS_PER_PART,
    by: str | None = None,
    rows_per_bucket: int | None = None,
) -> Layout:
    """Lay out forward settlements by month, and the orders traced to the ledgers, below ``root``.

    Filing costs one shuffle of each, once; every run after it joins them where they are.
    Given ``rows_per_bucket``, there are as many buckets as the settlements then need, at
    least ``buckets``, so that what a task sorts and joins does not grow with the tables. The
    layout that is returned tells their number.
    """
    spark = settlement.sparkSession
    counted = Observation()
    keys = _forward(settlement).select(KEY)
    split_keys(keys.observe(counted, F.count(F.lit(1)).alias("n")), rows_per_part).write.parquet(f"{root}/split")
    if rows_per_bucket is not None:
        buckets = max(buckets, -(-_observed(counted, keys) // rows_per_bucket))
    split = spark.read.parquet(f"{root}/split")
    _bucketed(_filed(settlement, split, buckets, by), f"{root}/settlement", buckets, MONTH)
    orders = traced_orders(hub, ledger).withColumnsRenamed({"hub_gateway": "gateway", "settle_key": "gw_key"})
    # An order without a gateway key has no settlement.
    _bucketed(repeated(orders.na.drop(subset=KEY), split), f"{root}/orders", buckets)
    return opened(spark, root, buckets)


def _observed(counted: Observation, rows: DataFrame) -> int:
    """The count made while ``rows`` were written; of an empty table Spark may drop it with the plan."""
    try:
        return counted.get["n"]
    except (Py4JJavaError, KeyError):
        return rows.count()


def _forward(settlement: DataFrame) -> DataFrame:
    return settlement.where("is_forward").withColumnRenamed("settlement_order_id", "gw_key")


def _filed(settlement: DataFrame, split: DataFrame, buckets: int, by: str | None) -> DataFrame:
    rows = spread(_forward(settlement), split, buckets, by)
    return rows.withColumn(MONTH, F.expr(month_label("settled_date")))


def replace_months(spark: SparkSession, layout: Layout, settlement: DataFrame, by: str | None = None) -> None:
    """Write the settled months that ``settlement`` holds anew, or for the first time.

    ``settlement`` has all rows of these months; other months and the orders stay as they are.
    """
    split = spark.read.parquet(f"{layout.root}/split")
    table = spark.table(layout.settlement)
    rows = _filed(settlement, split, layout.buckets, by).select(table.columns)
    dealt = rows.repartition(layout.buckets, *FILED).sortWithinPartitions(MONTH, *FILED)
    dealt.write.insertInto(layout.settlement, overwrite=True)


def opened(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Layout:
    """What ``store_alike`` wrote with that many buckets, in this or an earlier session."""
    return Layout(
        root,
        buckets,
        _named(spark, f"{root}/settlement", buckets, MONTH),
        _named(spark, f"{root}/orders", buckets),
    )


def forget(spark: SparkSession, layout: Layout) -> None:
    """Take the tables' names out of the catalog, for one that outlives the session; files stay."""
    for name in (layout.settlement, layout.orders):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def settled_orders(spark: SparkSession, layout: Layout, period: Period | None = None) -> DataFrame:
    """Every settlement row with its traced order, or nulls; neither side is shuffled.

    A period prunes the months. Bucket i of all months read is one task.
    """
    rows = spark.table(layout.settlement)
    if period is not None:
        last = period.end - timedelta(days=1)
        rows = rows.where(in_period("settled_date", period)).where(
            F.col(MONTH).between(str(period.start)[:7], str(last)[:7])
        )
    orders = spark.table(layout.orders).withColumn("hub_gateway", F.col("gateway"))
    return rows.drop(MONTH).join(orders, FILED, "left").drop("part")


def recon_base_alike(
    spark: SparkSession, layout: Layout, bank: DataFrame, period: Period | None = None
) -> DataFrame:
    """``recon_base`` on the stored layout."""
    joined = settled_orders(spark, layout, period).withColumnRenamed("gw_key", "settlement_order_id")
    return classified(with_deposits(joined, bank, period))
