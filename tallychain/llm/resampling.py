"""Importance resampling of documents towards a target distribution.

Features are runs of one to three words, hashed into buckets by CRC-32; a bucket is worth
the log ratio of its share in the target and in the corpus, a document the sum over its
features, and a Gumbel draw on top makes the highest scores a sample without replacement.

The checksums of all runs of a range of text come from one table. CRC-32 is linear: a
message is a constant of its length, XORed with what each byte contributes at its
distance from the end. The table holds that contribution for each distance below
``BLOCK`` and byte; ``bitwise_xor.reduceat`` folds the looked-up contributions by span. A
longer span is folded block by block: a block's value is carried over the bytes behind
it, neighbouring blocks being joined until one value is left.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallychain.llm.tables import map_rows, pieces, stored

BUCKETS = 10_000
MAX_RUN = 3
MIN_WORDS = 20
PER_CENT = 5
SEED = 42
#: Bytes a position table reaches back from the end of a span.
BLOCK = 256
#: Bytes of spans that are looked up at a time; small enough for a core's cache.
STEP = 1 << 17
#: Bytes of text that are cut into words at a time; a longer text comes in parts.
TEXT_STEP = 1 << 19
#: Rows a range of the ranking is meant to hold.
RANK_ROWS = 1 << 16

#: Reversed polynomial of CRC-32 (fixed value).
_POLYNOMIAL = 0xEDB88320
_ONES = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    """What a byte leaves in the register, eight steps later."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


@lru_cache(maxsize=1)
def position_table() -> np.ndarray:
    """``BLOCK`` x 256 numbers: what a byte contributes at a distance from the end."""
    step = _byte_table()
    rows = [step]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> 8) ^ step[rows[-1] & 0xFF])
    return np.stack(rows).astype(np.uint32)


@lru_cache(maxsize=64)
def _carry(doublings: int) -> np.ndarray:
    """4 x 256 numbers: a register, byte by byte, after 2^doublings zero bytes."""
    values = np.arange(256, dtype=np.uint32)
    lanes = np.stack([values << np.uint32(8 * i) for i in range(4)])
    if doublings == 0:
        return (lanes >> 8) ^ _byte_table()[lanes & 0xFF]
    return _carried(_carried(lanes, doublings - 1), doublings - 1)


def _carried(register: np.ndarray, doublings: int) -> np.ndarray:
    table = _carry(doublings)
    out = table[0][register & 0xFF]
    for i in range(1, 4):
        out = out ^ table[i][(register >> np.uint32(8 * i)) & 0xFF]
    return out


@lru_cache(maxsize=1 << 16)
def length_constant(length: int) -> int:
    """The CRC-32 of ``length`` zero bytes."""
    register = np.array([_ONES], dtype=np.uint32)
    for k in range(length.bit_length()):
        if length >> k & 1:
            register = _carried(register, k)
    return int(register[0]) ^ _ONES


@lru_cache(maxsize=1)
def _short_constants() -> np.ndarray:
    return np.array([length_constant(n) for n in range(BLOCK + 1)], dtype=np.uint32)


def _block_values(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What each block (``size`` bytes from ``start``, 1 to ``BLOCK``) leaves in an empty register."""
    table = position_table().ravel()
    out = np.empty(len(start), dtype=np.uint32)
    ends = np.cumsum(size)
    at = 0
    while at < len(start):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + STEP, "right")))
        n = size[at:upto]
        first = ends[at:upto] - n - done
        total = int(ends[upto - 1] - done)
        place = np.arange(total, dtype=np.int32)
        byte = data[place + np.repeat((start[at:upto] - first).astype(np.int32), n)]
        distance = np.repeat((first + n - 1).astype(np.int32), n) - place
        out[at:upto] = np.bitwise_xor.reduceat(table[(distance << 8) | byte], first)
        at = upto
    return out


def crc_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC-32 of ``data[start:end]`` for every span of at least one byte."""
    length = end - start
    constants = _short_constants()
    long = length > BLOCK
    if not long.any():
        return _block_values(data, start, length) ^ constants[length]
    out = np.empty(len(start), dtype=np.uint32)
    short = ~long
    out[short] = _block_values(data, start[short], length[short]) ^ constants[length[short]]
    # Blocks of a span, the first one taking what is left over; each is a value with the
    # number of blocks behind it.
    spans, last = length[long], end[long]
    blocks = -(-spans // BLOCK)
    span = np.repeat(np.arange(len(spans)), blocks)
    behind = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))
    block_end = last[span] - behind * BLOCK
    block_start = np.maximum(start[long][span], block_end - BLOCK)
    value = _block_values(data, block_start, block_end - block_start)
    doublings = BLOCK.bit_length() - 1
    while len(value) > len(spans):
        value = np.where(behind & 1, _carried(value, doublings), value)
        behind = behind >> 1
        pair = np.flatnonzero(np.r_[True, (np.diff(span) != 0) | (np.diff(behind) != 0)])
        value, span, behind = np.bitwise_xor.reduceat(value, pair), span[pair], behind[pair]
        doublings += 1
    out[long] = value ^ np.array([length_constant(int(n)) for n in spans], dtype=np.uint32)
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words after lower-casing: 0-9, a-z and all of other than ASCII characters.
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def word_runs(texts: pa.Array, carried: int = 0) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """(words of each text, (text, CRC-32) of the runs by run length).

    The first ``carried`` words were counted before: only runs that end behind them are new.
    """
    flat = texts.cast(pa.large_binary()).fill_null(b"")
    border = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    raw = flat.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[border[0] : border[-1]] if raw is not None else np.zeros(0, np.uint8)
    border = border - border[0]
    data = _LOWER[data]
    inside = _WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    # A text that starts with a word starts one, whatever the text before ends with.
    filled = border[:-1] < border[1:]
    heads, tails = border[:-1][filled], border[1:][filled] - 1
    opens[heads] = inside[heads]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[tails] = inside[tails]
    size = np.flatnonzero(closes) + 1 - starts
    text = np.searchsorted(border, starts, "right") - 1
    # Of texts with the same border only the last one has words.
    words = np.bincount(text[carried:], minlength=len(texts))
    place = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), 32, dtype=np.uint8)
    kept = data[inside]
    joined[np.arange(len(kept)) + np.repeat(np.arange(len(size)), size)] = kept

    def runs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for n in range(1, MAX_RUN + 1):
            first = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else text[:0]
            first = first[first + n > carried]
            last = first + n - 1
            if len(first):
                yield text[first], crc_spans(joined, place[first], place[last] + size[last])

    return words, runs()


_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_WORDS = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _windows(text: bytes, step: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a long text, cut between words, each behind the last words of the one before."""
    at, tail = 0, []
    while at < len(text):
        gap = _GAP.search(text, at + step)
        end = gap.start() if gap else len(text)
        yield b" ".join([*tail, text[at:end]]), len(tail)
        tail = [*tail, *_WORDS.findall(text, at, end)][1 - MAX_RUN :]
        at = end


def _text_steps(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, pa.Array, int]]:
    """(rows, their texts, words carried over); a long text comes in several parts."""
    texts = batch.column(column)
    for start, end in pieces(texts, TEXT_STEP):
        part = texts.slice(start, end - start)
        if end - start == 1 and (pc.binary_length(part)[0].as_py() or 0) > 2 * TEXT_STEP:
            whole = part.cast(pa.large_binary())[0].as_py()
            for window, carried in _windows(whole, TEXT_STEP):
                yield slice(start, end), pa.array([window], pa.large_binary()), carried
        else:
            yield slice(start, end), part, 0


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket: ``buckets`` numbers, summed up in Spark."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, texts, carried in _text_steps(batch, 0):
                for _, crc in word_runs(texts, carried)[1]:
                    counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(held, pa.int64()), "n": pa.array(counts[held], pa.int64())})

    parts = docs.select("text").mapInArrow(work, "bucket long, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, for each bucket."""
    n = float(len(corpus))
    s_all, t_all = float(corpus.sum()), float(target.sum())
    ratios = [
        ((t + 1.0) * (s_all + n)) / ((s + 1.0) * (t_all + n))
        for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel draw, rounded down; a null id draws like an empty one."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0).to_pylist()
        n_words, n_features, weight = (np.zeros(len(ids), dtype=np.int64) for _ in range(3))
        for part, texts, carried in _text_steps(batch, 1):
            words, runs = word_runs(texts, carried)
            n_words[part] += words
            for text, crc in runs:
                n_features[part] += np.bincount(text, minlength=len(texts))
                # Doubles hold these sums exactly up to 2^53.
                sums = np.bincount(text, gain[crc % np.uint32(len(gain))], len(texts))
                weight[part] += sums.astype(np.int64)
        score = weight + np.array([gumbel(i, seed) for i in ids], dtype=np.int64)
        yield pa.record_batch(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(n_words),
                "n_features": pa.array(n_features),
                "weight": pa.array(weight),
                "score": pa.array(score),
            }
        )

    slim = docs.select(F.col("doc_id").cast("long"), "text")
    return map_rows(slim, work, "doc_id long, n_words long, n_features long, weight long, score long")


def _ranks(rows: DataFrame, name: str) -> DataFrame:
    """``rank`` from 1 by score down and doc_id up, each range of the order in a task of its own."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    parts = max(1, -(-rows.count() // RANK_ROWS))
    ranged = rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    # Stored, so that a lost executor can't draw other range borders.
    ranged = stored(ranged, name)
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    # One row for each ``RANK_ROWS`` rows.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.withColumn("inside", inside).join(base, "part").withColumn(
        "rank", (F.col("before") + F.col("inside")).cast("long")
    )


_RESULT = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


def resample(
    docs: DataFrame,
    target: DataFrame,
    per_cent: int = PER_CENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for every row of ``docs``.

    Of the rows with at least ``min_words`` words, ``per_cent`` in a hundred (rounded
    down) are drawn: those of the highest scores, ties to the smaller doc_id, null ids
    last. rank counts them from 1 and is null for the others. Rows that are equal in
    all of this are drawn one by one. Null and empty texts have no features and weigh
    nothing. An empty table gives an empty result and an empty target weighs all
    features alike in it; other columns are ignored.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    made = stored(
        scores(docs, gain, seed).withColumn("row", F.monotonically_increasing_id()), "resampling-scores"
    )
    fit = F.col("n_words") >= min_words
    # The score that some more than the wanted rows reach. It only spares the ranking most
    # rows: should the estimate be off, all fit rows are ranked.
    share = max(0.0, 1 - per_cent / 100 - 0.001)
    size = made.where(fit).agg(
        F.count("*").alias("n"), F.percentile_approx("score", share, 10_000).alias("least")
    ).first()
    wanted = size.n * per_cent // 100
    ahead = fit & (F.col("score") >= F.lit(size.least if size.least is not None else 0))
    if made.where(ahead).count() < wanted:
        ahead = fit
    ranked = _ranks(made.where(ahead), "resampling-order").withColumn(
        "rank", F.when(F.col("rank") <= wanted, F.col("rank"))
    )
    rest = made.where(~ahead).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(_RESULT).unionByName(rest.select(_RESULT))
