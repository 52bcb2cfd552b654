"""The stored base table: kept up to date with late rows, and looked up by single ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.operators.base import FILED_BY
from tallychain.operators.frames import pick_first
from tallychain.operators.key_filter import bit_sets
from tallychain.operators.refresh import ID, Late, filed_in, refreshed, touched_ids, touched_months
from tallychain.operators.trace import trace_one
from tallychain.session import settings, shared_dir, shuffles_freed
from tallychain.sources.sinks import BASE_IDS, crowded, read_base, recon_base_write

#: Folders of the id index; a look-up opens one of them.
INDEX_FOLDERS = 256
#: Stored rows that a task of a refresh reads, sorts and writes again: packed, they take a small part of
#: what they take in memory.
_READ_AT_ONCE = {"spark.sql.files.maxPartitionBytes": str(16 << 20), "spark.sql.files.openCostInBytes": str(1 << 20)}
#: Parts in which the rows of all folders, or of one folder at least, are filed.
INDEX_PARTS, FOLDER_PARTS = 256, 4


def refresh(
    spark: SparkSession,
    path: str,
    settlement: DataFrame,
    hub: DataFrame,
    ledger: DataFrame,
    bank: DataFrame,
    late: Late,
    index: str | None = None,
    folders: int = INDEX_FOLDERS,
) -> list[tuple[str | None, str | None]]:
    """Bring the base table at ``path`` up to date; returns the (month, gateway) written again.

    The relations hold the late rows already. Months that no late row touches are neither
    read, but for their ids, nor written. ``index`` is the id index to be kept in step.
    """
    ids, id_filter = touched_ids(late, hub), None
    if ids is not None:
        # Read by all joins on touched ids.
        ids = _stored(ids, "refresh-ids")
        id_filter = _stored(bit_sets(ids, ID), "refresh-filter")
    base = read_base(spark, path)
    months = touched_months(late, base, ids, id_filter)
    if months:
        full = crowded(base.where(filed_in(months)))
        rows = refreshed(base, settlement, hub, ledger, bank, ids, id_filter, months, full)
        # The partitions that are read are the ones to be replaced; they are when all rows are written.
        with settings(spark, _READ_AT_ONCE):
            recon_base_write(rows, path, filed=True)
        if index is not None:
            add_to_index(read_base(spark, path).where(filed_in(months)), index, folders)
    return months


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(any_id: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(any_id), F.lit(folders)).cast("int")


def index_rows(base: DataFrame, folders: int = INDEX_FOLDERS) -> DataFrame:
    """The ids of ``base`` rows with the month and gateway that hold them, as the index files them.

    A row for each id and partition of the base. They are shuffled once, to where they are
    filed, and equal ones meet there; parts tell the partitions of the base apart, so
    that an id with a third of all rows lies in many of them.
    """
    each = F.explode(F.array_distinct(F.array(*[F.col(c) for c in BASE_IDS])))
    ids = base.select(each.alias("any_id"), *FILED_BY).where("any_id IS NOT NULL")
    part = F.pmod(F.hash("any_id", *FILED_BY), F.lit(max(FOLDER_PARTS, INDEX_PARTS // folders)))
    dealt = ids.withColumns({"folder": _folder(F.col("any_id"), folders), "_part": part})
    # One sort serves to find equal rows and to file them.
    once = pick_first(dealt.repartition("folder", "_part"), ["folder", "any_id", *FILED_BY, "_part"], "any_id")
    return once.drop("_part").sortWithinPartitions("folder", "any_id")


def add_to_index(base: DataFrame, index: str, folders: int = INDEX_FOLDERS) -> None:
    """File the ids of ``base`` rows with the month and gateway that hold them.

    Adding what is there already does no harm, and rows that have left a partition cost a
    look-up in it.
    """
    with shuffles_freed(base.sparkSession):
        rows = index_rows(base, folders).write.mode("append")
        rows.partitionBy("folder").parquet(index, compression="zstd")


def look_up(
    spark: SparkSession, path: str, index: str, any_id: str, folders: int = INDEX_FOLDERS
) -> DataFrame:
    """``trace_one`` on the stored base: the index tells the partitions, the ids their row groups.

    ``folders`` is what the index was written with.
    """
    schema = f"any_id string, {FILED_BY[0]} string, {FILED_BY[1]} string, folder int"
    folder = spark.range(1).select(_folder(F.lit(any_id), folders)).first()[0]
    held = (
        spark.read.schema(schema)
        .parquet(index)
        .where((F.col("folder") == folder) & (F.col("any_id") == any_id))
        .select(*FILED_BY)
        .distinct()
    )
    # An id is settled in a few months; at most there are months times gateways.
    months = [(r.recon_month, r.gateway) for r in held.collect()]
    return trace_one(read_base(spark, path).where(filed_in(months)), any_id)

