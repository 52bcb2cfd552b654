"""Writing the base table and the gap reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.operators.base import FILED_BY, dealt
from tallychain.operators.frames import ordering
from tallychain.session import shuffles_freed

#: Ids that single rows of the base table are looked up by.
BASE_IDS = ("settlement_order_id", "hub_order_id", "hub_txn_id")
#: Bytes of a row group of the base table, and the most distinct ids its bloom filters are meant for.
ROW_GROUP_BYTES, ROW_GROUP_IDS = 16 << 20, 400_000
#: Sizes of a bloom filter to choose from, each half the one before.
BLOOM_SIZES = 8
#: A folder of the base table with more files than this below so many bytes is crowded.
SMALL_FILES, SMALL_FILE_BYTES = 8, 8 << 20


def recon_base_write(base: DataFrame, path: str, filed: bool = False) -> None:
    """Replace the months that ``base`` covers; other months stay.

    ``filed`` rows have been ``dealt`` out by month and gateway already. Files are in order
    of the settlement id and have a bloom filter on each id, so that a look-up of one
    order opens the row groups that may hold it. A filter is as large as the ids of its
    row group need.
    """
    out = (
        (base if filed else dealt(base))
        .sortWithinPartitions(*FILED_BY, "settlement_order_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        # Ten bits an id, in the next power of two bytes.
        .option("parquet.bloom.filter.max.bytes", 1 << (ROW_GROUP_IDS * 10 // 8).bit_length())
    )
    for column in BASE_IDS:
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
            f"parquet.bloom.filter.candidates.number#{column}", BLOOM_SIZES
        )
    with shuffles_freed(base.sparkSession):
        out.partitionBy(*FILED_BY).parquet(path)


def read_base(spark: SparkSession, path: str) -> DataFrame:
    """``recon_month`` comes back as text even where partition values are type-guessed."""
    month = F.expr("left(CAST(recon_month AS STRING), 7)")
    return spark.read.parquet(path).withColumn("recon_month", month)


def crowded(base: DataFrame) -> list[tuple[str | None, str | None]]:
    """The (recon_month, gateway) of the stored base that many small files hold. No column is read."""
    files = base.select(*FILED_BY, "_metadata.file_path", "_metadata.file_size").distinct()
    small = files.where(F.col("file_size") < SMALL_FILE_BYTES).groupBy(*FILED_BY).count()
    return [(r.recon_month, r.gateway) for r in small.where(F.col("count") > SMALL_FILES).collect()]


def csv_export(df: DataFrame, path: str, *order: str, compression: str = "none") -> None:
    """CSV with a header, quotes doubled. ``order`` sorts over all files: part 0 holds the first rows.

    A compressed file is read by one task.
    """
    out = df.orderBy(*ordering(order)) if order else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path, compression=compression)
