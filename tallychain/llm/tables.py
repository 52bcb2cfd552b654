"""Helpers of the text operators: stored intermediate tables and row hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.session import shared_dir

#: What a null id sorts as: after every real one.
LAST_ID = (1 << 63) - 1
#: Bytes of text that one numpy step inside a Python worker handles at a time.
STEP_BYTES = 1 << 21


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back.

    Cuts the lineage: a lost executor afterwards costs a re-read, and both
    passes over the result see the same rows.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame, seed: int) -> Column:
    """A seeded hash over all columns; equal only for rows that are equal (or a 64-bit collision)."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() != "map"]
    return F.xxhash64(F.lit(seed), *plain)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(
    df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions that look at one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(batch)

    return df.mapInArrow(run, schema)


def pieces(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` bytes each; a longer text gets a range of its own.

    A batch holds a fixed number of rows, however long; work that goes by ranges
    copies no more than a range at a time.
    """
    start = size = 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths.tolist()):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def as_bytes(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 of each string."""
    return texts.cast(pa.binary()).to_pylist()


def each_text(texts: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 of each string, one after another."""
    for start, end in pieces(texts):
        yield from as_bytes(texts.slice(start, end - start))
