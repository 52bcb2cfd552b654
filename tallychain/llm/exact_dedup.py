"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts of a length that no other text has are unique, and so are texts whose prefix no
other text of their length has. Only what is left is read in full and hashed. The first
two steps work on two numbers a row; the last one asks a bit set of fixed size whether
a row may be left, so no text is shuffled for it, however many lengths and prefixes
repeat. A bit set that fills up only hashes more texts than needed.

DataFrame functions only: there is no Python in the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.llm.tables import row_hash, stored

#: Code points that the second step hashes.
PREFIX_CHARS = 64
#: Bits of the set that says which (length, prefix hash) repeat: 8 MiB, whatever the input.
FILTER_BITS = 1 << 26

_KEY = ["size", "head", "full"]


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _shape() -> dict[str, Column]:
    """The first two things that equal texts have in common."""
    return {"size": F.octet_length(_text()), "head": F.xxhash64(F.substring(_text(), 1, PREFIX_CHARS))}


def _bit() -> Column:
    """The bit of a (length, prefix hash). The ``bitmap_*`` functions count from 1."""
    return F.pmod(F.xxhash64(F.lit(11), "size", "head"), F.lit(FILTER_BITS)) + 1


def _repeated(rows: DataFrame, *key: str) -> DataFrame:
    """The keys of at least two rows. Partial counts collapse a hot key before the shuffle."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)


def repeated_shapes(docs: DataFrame) -> DataFrame:
    """(size, head): lengths in bytes and, of the lengths that repeat, the prefix hashes that do."""
    shapes = stored(docs.withColumns(_shape()).select("size", "head"), "exact-shapes")
    of_length = shapes.join(_repeated(shapes, "size"), "size", "left_semi")
    return _repeated(of_length, "size", "head")


def _bits(shapes: DataFrame) -> DataFrame:
    """(bucket, bits): the set as at most ``FILTER_BITS`` / 32768 rows of 4 KiB."""
    return stored(
        shapes.select(_bit().alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")),
        "exact-bits",
    )


def _marked(docs: DataFrame, full: Column) -> DataFrame:
    """``docs`` (with a text) and size, head and, where a copy is possible, ``full``."""
    known = _bits(repeated_shapes(docs))
    shaped = docs.withColumns(_shape()).withColumn("bit", _bit())
    place = F.bitmap_bit_position("bit")
    byte = F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    mask = F.pow(F.lit(2), place % 8).cast("int")
    hit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(mask) != 0
    # 8 MiB at most, by construction of the set.
    return (
        shaped.withColumn("bucket", F.bitmap_bucket_number("bit"))
        .join(F.broadcast(known), "bucket", "left")
        .withColumn("full", F.when(F.coalesce(hit, F.lit(False)), full))
        .drop("bit", "bucket", "bits")
    )


def exact_copies(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept) for every row; with ``digest`` also text_sha256.

    Texts are equal when their bytes are; a null text is an empty one. Of equal texts
    the row with the largest doc_id stays, a null id counting as the smallest; of
    several rows with that id one stays. keep_id is the id of the row that stays.
    ``digest`` asks for the SHA-256 of every text, and so reads all in full. An empty
    table gives an empty result; other columns are ignored.
    """
    sha = F.sha2(_text(), 256)
    rows = _marked(docs.select("doc_id", "text"), F.unhex(sha))
    report = [sha.alias("text_sha256")] if digest else []
    # Stored, so that the number of a row is the same wherever it is read.
    slim = stored(
        rows.select("doc_id", *_KEY, *report, F.monotonically_increasing_id().alias("row")), "exact-rows"
    )
    groups = (
        slim.where("full IS NOT NULL")
        .groupBy(*_KEY)
        .agg(F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    # A group is one row, so AQE can split the rows of a hot text.
    found = slim.where("full IS NOT NULL").join(groups, _KEY, "left")
    alone = slim.where("full IS NULL")
    return found.unionByName(alone, allowMissingColumns=True).select(
        "doc_id",
        F.when(F.col("top").isNull(), F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("kept"),
        *(["text_sha256"] if digest else []),
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns. Only texts with a possible copy are shuffled.

    Rows with one id and one text are decided by a hash of the whole row.
    """
    whole = docs.select(
        "doc_id", "text", F.struct("*").alias("whole"), row_hash(docs, 11).alias("tie")
    )
    rows = _marked(whole, F.unhex(F.sha2(_text(), 256)))
    alone = rows.where("full IS NULL").select("whole")
    best = (
        rows.where("full IS NOT NULL")
        .groupBy(*_KEY)
        .agg(F.max_by("whole", F.struct("doc_id", "tie")).alias("whole"))
        .select("whole")
    )
    return alone.unionByName(best).select("whole.*")
