"""Proportional stratified interleaving: every shard has the mixture of the whole.

Rows are shuffled by a seeded hash within their source and ranked; the fractional
rank (rank - 1 + offset) / rows of the source orders all rows, and that order is cut
into equal counts. The offset, between 0 and 1, is the source's own: with one half for
all, sources of a row each would meet in the middle and crowd out the others there.
Both rankings work on hash or rank ranges: a range is a small group, and what precedes
it is a prefix sum over the counts of ranges. No source, however large, is ever sorted
in one task, and texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallychain.llm.tables import LAST_ID, stored

SHARDS = 8
SEED = 20240229
#: Rows a range is meant to hold.
RANGE_ROWS = 1024
#: Ranges at most, so that their prefix sums stay small.
MAX_RANGES = 1 << 18


def _ranges(rows: int) -> int:
    return max(1, min(MAX_RANGES, -(-rows // RANGE_ROWS)))


def _ranked(df: DataFrame, within: list[str], part: Column, order: list, name: str) -> DataFrame:
    """``df`` with the rank (from 0) of each row in its group, and rows in the group.

    ``part`` numbers ranges that follow ``order``. Ranges of one group are one
    window, rows of one range are another.
    """
    split = stored(df.withColumn("part", part), name)
    counts = split.groupBy(*within, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        *within,
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(*within)).alias("group_rows"),
    )
    inside = Window.partitionBy(*within, "part").orderBy(*order)
    numbered = split.withColumn("in_range", F.row_number().over(inside))
    return numbered.join(base, [*within, "part"]).withColumn(
        "rank", F.col("before") + F.col("in_range") - 1
    ).drop("part", "in_range", "before")


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The law is ``rows``: shard sizes differ by one row at most. size is the UTF-8
    bytes of the text plus 1; a null text counts as empty. Null sources are one
    source of their own. Repeated rows are placed one by one; which of two equal
    rows comes first makes no difference. An empty table gives an empty result;
    other columns are ignored. grown_shard is null, as this law moves rows when
    the number of shards changes.
    """
    slim = docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    ).withColumn(
        "mix", F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(LAST_ID)), "text_crc32", "size")
    )
    total = docs.count()
    ranges = _ranges(total)
    width = (1 << 64) // ranges + 1
    hash_range = F.expr(f"(cast(mix as decimal(20,0)) + {1 << 63}BD) div {width}BD")
    ties = [F.col(c).asc_nulls_last() for c in ("mix", "doc_id", "text_crc32", "size")]
    within = _ranked(slim, ["stratum"], hash_range, ties, "shard-source")
    offset = (F.pmod(F.xxhash64(F.lit(seed), "stratum"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    placed = within.withColumn("fraction", (F.col("rank") + offset) / F.col("group_rows")).drop(
        "rank", "group_rows"
    )
    order = [F.col(c).asc_nulls_last() for c in ("fraction", "stratum", "mix", "doc_id", "text_crc32", "size")]
    everywhere = placed.withColumn("all", F.lit(0))
    ordered = _ranked(everywhere, ["all"], F.floor(F.col("fraction") * ranges).cast("long"), order, "shard-all")
    # Cut in whole numbers: row i of n goes to shard i * shards / n.
    shard = F.expr(f"cast((rank * {shards}L) div {max(1, total)}L as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return ordered.withColumn("shard", shard).select(
        "doc_id",
        F.when(F.col("stratum") != "", F.substring("stratum", 2, 1 << 30)).alias("source"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
