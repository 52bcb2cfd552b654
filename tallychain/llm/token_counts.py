"""Exact token counts for every context limit from one histogram of lengths.

Each document is encoded once and only its length is kept. The histogram has one
row for each length that occurs; suffix sums over it answer totals, quantiles and
truncated totals for any limit.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from tallychain.llm.tables import each_text, stored

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary splits a text before merging; a fixed value that belongs to it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths of one range; suffix sums run inside a range and over the totals of ranges.
RANGE = 1024


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(path: str = VOCABULARY):
    """The length of a text in tokens; null has none. Texts of special tokens are ordinary text."""

    @arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        encode = encoding(path).encode_ordinary
        counts = (len(encode(t.decode())) if t else 0 for t in each_text(texts))
        return pa.array(list(counts), pa.int64())

    return count


def histogram(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(length, n_docs), one row for each length that occurs."""
    return (
        docs.select(token_count(path)("text").alias("length"))
        .groupBy("length")
        .agg(F.count("*").alias("n_docs"))
    )


def context_limits(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """What every limit keeps: one row for each length that occurs, taken as a limit.

    limit, n_docs (of just that length), docs_longer, total_tokens (of the whole
    table), kept_tokens (sum of min(length, limit)), lost_tokens, and quantile
    (share of documents of at most this length). Between two lengths kept_tokens
    grows by docs_longer of the lower one for each token, so the rows answer every
    limit; see ``kept_at``. Null and empty texts have length 0, repeated rows count
    each time, an empty table gives an empty result; other columns are ignored.
    """
    counts = stored(
        histogram(docs, path)
        .withColumn("part", F.floor(F.col("length") / RANGE))
        .withColumn("tokens", F.col("length") * F.col("n_docs")),
        "lengths",
    )
    # Ranges number at most the longest document over RANGE; documents are long gone here.
    parts = counts.groupBy("part").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("toks"))
    after = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    parts = parts.select(
        "part",
        F.coalesce(F.sum("docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("toks").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(every).alias("all_docs"),
        F.sum("toks").over(every).alias("total_tokens"),
    )
    inside = (
        Window.partitionBy("part")
        .orderBy(F.desc("length"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    suffix = counts.join(parts, "part").select(
        F.col("length").alias("limit"),
        "n_docs",
        (F.col("docs_after") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).alias("docs_longer"),
        (F.col("tokens_after") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("tokens_longer"),
        "all_docs",
        "total_tokens",
    )
    lost = F.col("tokens_longer") - F.col("docs_longer") * F.col("limit")
    return suffix.select(
        "limit",
        "n_docs",
        "docs_longer",
        "total_tokens",
        (F.col("total_tokens") - lost).alias("kept_tokens"),
        lost.alias("lost_tokens"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"),
    )


def kept_at(limits: DataFrame, limit: int) -> DataFrame:
    """One row (limit, kept_tokens, docs_longer) for any limit, from ``context_limits``."""
    below = limits.filter(F.col("limit") <= limit).agg(F.max_by(F.struct("*"), "limit").alias("row"))
    every = limits.agg(F.max("total_tokens").alias("total"), F.sum("n_docs").alias("docs"))
    row = below.first()["row"]
    if row is None:  # every document is longer
        return every.select(
            F.lit(limit).cast("long").alias("limit"),
            (F.coalesce("docs", F.lit(0)) * limit).alias("kept_tokens"),
            F.coalesce("docs", F.lit(0)).alias("docs_longer"),
        )
    return every.select(
        F.lit(limit).cast("long").alias("limit"),
        F.lit(row["kept_tokens"] + row["docs_longer"] * (limit - row["limit"])).alias("kept_tokens"),
        F.lit(row["docs_longer"]).alias("docs_longer"),
    )


def quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of the documents do not exceed."""
    return limits.filter(F.col("quantile") >= share).agg(F.min("limit")).first()[0]
