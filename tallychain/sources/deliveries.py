"""Deliveries that repeat rows: a key is loaded once, whichever delivery brings it again.

The keys of all deliveries are kept in an index with two parts, both filed by delivery. The
filter is a bit set of fixed size; sets of several deliveries are merged by OR. A row whose
bit is not set is certainly new and is loaded without looking any further; of the others
the exact keys are compared. A delivery never meets itself in the index, so that one that
broke off halfway is simply run again under its name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallychain.operators.frames import pick_first
from tallychain.operators.key_filter import FILTER_BITS, bit_sets, probed
from tallychain.session import shared_dir


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A part of the index; empty before the first delivery."""
    found = T.StructType.fromDDL(f"{schema}, delivery string")
    try:
        return spark.read.schema(found).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], found)


def _key_schema(rows: DataFrame, keys: list[str]) -> str:
    kinds = dict(rows.dtypes)
    return ", ".join(f"`{k}` {kinds[k]}" for k in keys)


def known_filter(spark: SparkSession, index: str, delivery: str) -> DataFrame:
    """(bucket, bits): the filters of all other deliveries in one."""
    parts = _read(spark, f"{index}/filter", "bucket bigint, bits binary").where(F.col("delivery") != delivery)
    return parts.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def new_rows(
    rows: DataFrame, keys: list[str], index: str, delivery: str, *order: str, bits: int = FILTER_BITS
) -> DataFrame:
    """The rows of a delivery whose key no other delivery has brought; one for each key.

    ``order`` picks the row where the delivery itself repeats a key. The exact keys are
    joined with the few rows the filter could not clear.
    """
    spark = rows.sparkSession
    once = pick_first(rows, keys, *(order or keys))
    asked = probed(once, keys, known_filter(spark, index, delivery), bits)
    # Stored, so that the filter is asked once for both branches.
    path = shared_dir(spark, "delivery")
    asked.write.partitionBy("_maybe").parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("_maybe", T.BooleanType())])
    asked = spark.read.schema(schema).parquet(path)
    exact = _read(spark, f"{index}/keys", _key_schema(rows, keys)).where(F.col("delivery") != delivery)
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`")) for k in keys]
    unknown = asked.where("_maybe").alias("l").join(exact.alias("r"), same, "left_anti")
    return asked.where("NOT _maybe").unionByName(unknown).drop("_maybe").select(rows.columns)


def record(rows: DataFrame, keys: list[str], index: str, delivery: str, bits: int = FILTER_BITS) -> None:
    """Enter the keys of a delivery's new rows into the index, in place of what it entered before."""
    tagged = rows.select(*keys, F.lit(delivery).alias("delivery"))
    sets = bit_sets(tagged, keys, "delivery", bits=bits)
    for part, df in (("keys", tagged), ("filter", sets)):
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("delivery")
            .parquet(f"{index}/{part}")
        )


def deliver(
    rows: DataFrame,
    keys: list[str],
    index: str,
    target: str,
    delivery: str,
    *order: str,
    bits: int = FILTER_BITS,
) -> None:
    """Load what a delivery brings that is new into ``target``, filed by delivery.

    The rows are written before the index is: should a run break off between the two, the
    same delivery run again replaces its rows and enters its keys.
    """
    new = new_rows(rows, keys, index, delivery, *order, bits=bits)
    (
        new.withColumn("delivery", F.lit(delivery))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("delivery")
        .parquet(target)
    )
    written = rows.sparkSession.read.schema(
        T.StructType([*rows.schema.fields, T.StructField("delivery", T.StringType())])
    ).parquet(target)
    record(written.where(F.col("delivery") == delivery), keys, index, delivery, bits)
