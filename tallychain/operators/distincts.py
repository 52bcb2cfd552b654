"""Exact distinct counts that add up: bitmaps over dense key numbers.

A key gets a number once (``number_keys``, extended by later deliveries); a state is the bitmap
of the numbers a group holds in one bucket of 32,768 of them. States of any months and columns
merge by OR, so several distinct counts over stored months need neither an Expand of the rows nor
a shuffle of keys: they move bitmaps of 4 KB. They pay off for few groups with many keys; a group with a
handful of keys in each bucket is smaller as a list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallychain.operators.frames import group

#: Parts that keys are numbered in; each is sorted in one task, their sizes are summed in one.
LOTS = 4096


def number_keys(rows: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(key, number) of the keys in ``rows`` that ``known`` does not have; nulls get no number.

    Numbers are dense: from 1, or from the one after the largest of ``known``. So keys of a later
    month lie in later buckets, and its states stay few. The same rows give the same numbers
    however they are partitioned. Append the result to the stored ``known``.
    """
    key = F.col(column)
    keys = rows.where(key.isNotNull()).select(key.alias("key")).distinct()
    after = 0
    if known is not None:
        keys = keys.join(known, "key", "left_anti")
        after = known.agg(F.max("number")).first()[0] or 0
    keys = keys.withColumn("_lot", F.pmod(F.xxhash64("key"), F.lit(LOTS)))
    before = F.sum("count").over(Window.orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1))
    starts = keys.groupBy("_lot").count().select("_lot", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_lot").orderBy("key"))
    return (
        keys.withColumn("_place", place)
        .join(starts, "_lot")
        .select("key", (F.lit(after) + F.col("_start") + F.col("_place")).alias("number"))
    )


def with_number(rows: DataFrame, column: str, numbers: DataFrame, name: str) -> DataFrame:
    """``rows`` with the number of ``column`` as ``name``; null stays null.

    ``numbers`` has a row a key, so AQE can split the rows of a hot one.
    """
    return rows.join(numbers.select(F.col("key").alias(column), F.col("number").alias(name)), column, "left")


def distinct_states(rows: DataFrame, by: list[str], counted: dict[str, str]) -> DataFrame:
    """(by..., counted, bucket, bitmap): which numbers each group holds.

    ``counted`` names each count and the integer it counts, as SQL. Rows are read once; a number
    that a group repeats collapses map-side. Then each bucket's numbers are brought to one task,
    which makes a bitmap a group and bucket: made where the rows happen to lie, every task would
    send a bitmap for nearly every bucket, and tasks times buckets grow as the square of the rows.
    A bucket has at most 32,768 numbers a group, so the group that holds most of the rows is spread.
    """
    numbers = ", ".join(f"'{name}', CAST({number} AS BIGINT)" for name, number in counted.items())
    held = (
        rows.selectExpr(*by, f"stack({len(counted)}, {numbers}) AS (counted, _number)")
        .where("_number IS NOT NULL")
        .distinct()
        .selectExpr(
            *by,
            "counted",
            "bitmap_bucket_number(_number) AS bucket",
            "bitmap_bit_position(_number) AS _position",
        )
    )
    return group(
        held.repartition("counted", "bucket"), [*by, "counted", "bucket"], "bitmap_construct_agg(_position) AS bitmap"
    )


def merged(states: DataFrame, by: list[str]) -> DataFrame:
    """States of finer groups as states by ``by`` alone, which can be merged further."""
    return group(states, [*by, "counted", "bucket"], "bitmap_or_agg(bitmap) AS bitmap")


def distinct_counts(states: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """(by..., a count for each name); a group without any key has no state and no row."""
    return group(
        merged(states.where(F.col("counted").isin(names)), by),
        by,
        *[f"sum(CASE WHEN counted = '{n}' THEN bitmap_count(bitmap) ELSE 0 END) AS {n}" for n in names],
    )


def counts_to_month(states: DataFrame, by: list[str], month: str, name: str) -> DataFrame:
    """(by..., month, new_keys, keys_so_far): keys first seen in each month, and seen by its end.

    A bucket's bitmaps are OR-ed month after month; what a month adds to the count is new. Only
    months that hold a key have a row.
    """
    monthly = merged(states.where(F.col("counted") == name), [*by, month])
    months = Window.partitionBy(*by, "bucket").orderBy(month)
    so_far = F.bitmap_count(F.bitmap_or_agg("bitmap").over(months.rowsBetween(Window.unboundedPreceding, 0)))
    grown = monthly.select(*by, "bucket", month, so_far.alias("_so_far"))
    added = F.col("_so_far") - F.coalesce(F.lag("_so_far").over(months), F.lit(0))
    new = group(grown.select(*by, month, added.alias("_new")), [*by, month], "sum(_new) AS new_keys")
    # A row for each group and month reaches this window.
    whole = F.sum("new_keys").over(
        Window.partitionBy(*by).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    )
    return new.select(*by, month, "new_keys", whole.alias("keys_so_far"))


def distinct_store(states: DataFrame, path: str, month: str) -> None:
    """Replace the states of the months that ``states`` covers; other months stay."""
    (
        states.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )


def distinct_load(spark: SparkSession, path: str, month: str) -> DataFrame:
    """Stored states, the month as text such as ``2026-01``."""
    return spark.read.parquet(path).withColumn(month, F.expr(f"left(CAST(`{month}` AS STRING), 7)"))
