"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint is cut into three segments of at most 23 bits. The perfect binary
Golay code (23, 12) maps each segment to the codewords around it: the codewords
that its one-bit neighbourhood decodes to, one or six of them. Two segments that
differ in two bits or fewer have a word within one bit of both, hence a codeword
in common.

Pigeonhole over segment errors for fingerprints at most four bits apart: either
one segment is equal and another has at most two errors, or all three have at
least one and so at most two. A key is therefore either (equal segment, codeword
of another), six ordered pairs of 33 or 34 bits, or a codeword of each segment, 36
bits. Every pair within four bits shares a key; the bit distance of those that share
one is checked. Codewords of two segments would do for the last kind and be fewer
keys, but at 24 bits its chance candidates would outgrow everything else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallychain.llm.components import roots
from tallychain.llm.tables import LAST_ID, each_text, fresh, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one key that are compared in one go; larger buckets are cut into blocks.
BLOCK = 8192

#: (first bit, width) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


class Golay:
    """Decoding by syndrome; both tables follow from the generator."""

    def __init__(self) -> None:
        self.high = np.array([_remainder(i << 11) for i in range(1 << 12)], dtype=np.uint32)
        self.error = np.zeros(1 << 11, dtype=np.uint32)
        for weight in (1, 2, 3):
            for bits in combinations(range(23), weight):
                pattern = sum(1 << b for b in bits)
                self.error[_remainder(pattern)] = pattern

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 information bits of the nearest codeword."""
        syndrome = self.high[words >> 11] ^ (words & 0x7FF)
        return (words ^ self.error[syndrome]) >> 11

    def around(self, words: np.ndarray, width: int) -> np.ndarray:
        """Indices that the words within one bit decode to, a row for each word, ascending.

        The bits above ``width`` are always zero and never in error.
        """
        flips = np.array([0] + [1 << i for i in range(width)], dtype=np.uint32)
        return np.sort(self.index(words[:, None] ^ flips[None, :]), axis=1)


@lru_cache(maxsize=1)
def decoder() -> Golay:
    return Golay()


def _first_of_equal(rows: np.ndarray) -> np.ndarray:
    first = np.ones(rows.shape, dtype=bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    return first


def fuzzy_keys(prints: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(key, position in ``prints``) of every key of every fingerprint."""
    cut = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    near = [golay.around(c, n) for c, (_, n) in zip(cut, SEGMENTS)]
    own = [_first_of_equal(a) for a in near]
    keys, rows = [], []
    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        row, col = np.nonzero(own[j])
        exact = cut[i][row].astype(np.int64)
        keys.append(kind << 40 | exact << 12 | near[j][row, col].astype(np.int64))
        rows.append(row)
    # Every combination of one index of each segment.
    row, code = np.arange(len(prints)), np.full(len(prints), 6, dtype=np.int64) << 4
    for index, real in zip(near, own):
        at, col = np.nonzero(real[row])
        row, code = row[at], code[at] << 12 | index[row[at], col].astype(np.int64)
    keys.append(code)
    rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """64 bits: a bit is set if over half of the shingle hashes have it."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        line = b" ".join(parts)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        shingles = [line[a:b] for a, b in zip(starts, ends[words - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):  # a very long text never expands as a whole
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_udf(words: int):
    @arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, words) for t in each_text(texts)], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    return fingerprints


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, print) for every row."""
    return docs.select("doc_id", fingerprint_udf(words)("text").alias("print"))


def spanning(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within ``prints``, one for each member joined.

    A found member leaves the rest at once, so a dense bucket costs little more
    than its size and never yields all of its pairs.
    """
    out, rest = [], prints
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            here = front.pop()
            near = np.bitwise_count(rest ^ here) <= max_bits
            if near.any():
                found = rest[near]
                out += [(int(here), int(x)) for x in found]
                front += list(found)
                rest = rest[~near]
    return out


def _bucket_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links inside runs of equal keys."""
    edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], edge))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    out: list[tuple[int, int]] = []
    pair = starts[sizes == 2]
    near = np.bitwise_count(prints[pair] ^ prints[pair + 1]) <= max_bits
    out += zip(prints[pair[near]].tolist(), prints[pair[near] + 1].tolist())
    small = (sizes > 2) & (sizes <= 64)
    hit = sizes > 64
    if small.any():  # most small runs hold no link: find those that do in one go for each lag
        run_of = np.repeat(np.arange(len(sizes)), sizes)
        for lag in range(1, int(sizes[small].max())):
            same = run_of[lag:] == run_of[:-lag]
            same &= small[run_of[lag:]]
            at = np.flatnonzero(same)
            at = at[np.bitwise_count(prints[at] ^ prints[at + lag]) <= max_bits]
            hit[run_of[at]] = True
    for run in np.flatnonzero(hit):
        out += spanning(prints[starts[run] : starts[run] + sizes[run]], max_bits)
    return out


_LINKS = "kind int, key long, block long, a long, b long"


def _batch(kind: int, key, block, a, b) -> pa.RecordBatch:
    n = len(a)
    return pa.record_batch(
        {
            "kind": pa.array(np.full(n, kind, dtype=np.int32)),
            "key": pa.array(np.broadcast_to(np.asarray(key, dtype=np.int64), n)),
            "block": pa.array(np.broadcast_to(np.asarray(block, dtype=np.int64), n)),
            "a": pa.array(np.asarray(a, dtype=np.uint64).view(np.int64)),
            "b": pa.array(np.asarray(b, dtype=np.uint64).view(np.int64)),
        }
    )


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, dtype=np.uint64).reshape(-1, 2)
    pairs = np.unique(np.sort(pairs, axis=1), axis=0)
    return _batch(0, 0, 0, pairs[:, 0], pairs[:, 1])


def _walk_buckets(max_bits: int, block: int):
    """Reads (key, print) in key order, in bounded memory.

    Kind 0 rows are links. A bucket of more than ``block`` fingerprints is passed
    on as kind 1 rows with a block number each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty(0, np.int64), np.empty(0, np.uint64)
        large, passed = None, 0

        def over(values: np.ndarray) -> pa.RecordBatch:
            nonlocal passed
            numbers = (passed + np.arange(len(values))) // block
            passed += len(values)
            return _batch(1, large, numbers, values, values)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate((held_key, batch.column(0).to_numpy()))
            prints = np.concatenate((held, batch.column(1).to_numpy().view(np.uint64)))
            if large is not None:
                end = np.searchsorted(keys, large, "right")
                if end:
                    yield over(prints[:end])
                keys, prints = keys[end:], prints[end:]
                if not len(keys):
                    held_key, held = keys, prints
                    continue
                large = None
            cut = np.searchsorted(keys, keys[-1], "left")
            if cut and (links := _bucket_links(keys[:cut], prints[:cut], max_bits)):
                yield _link_batch(links)
            held_key, held = keys[cut:], prints[cut:]
            if len(held) > block:
                large, passed = held_key[0], 0
                yield over(held)
                held_key, held = held_key[:0], held[:0]
        if len(held) and (links := _bucket_links(held_key, held, max_bits)):
            yield _link_batch(links)

    return run


def _block_links(max_bits: int):
    def run(group: pa.Table) -> pa.Table:
        prints = np.unique(group.column("a").to_numpy().view(np.uint64))
        links = spanning(prints, max_bits)
        return pa.Table.from_batches([_link_batch(links)]).select(["a", "b"])

    return run


def print_links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b) of distinct fingerprints that connect exactly what is connected.

    ``prints``: one row for each distinct fingerprint, column print. Buckets give
    spanning links only, not all pairs.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the key scheme covers 0 to 4 differing bits")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = decoder()
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), 2048):
                part = values[at : at + 2048]
                keys, rows = fuzzy_keys(part, golay)
                yield pa.record_batch(
                    {"key": pa.array(keys), "print": pa.array(part[rows].view(np.int64))}
                )

    # A fingerprint becomes some 180 keys, so tasks are not left to the size of what is read.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.select("print").repartition(parts, "print").mapInArrow(expand, "key long, print long")
    walked = stored(
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_walk_buckets(max_bits, block), _LINKS),
        "simhash-links",
    )
    links = walked.filter("kind = 0").select("a", "b")
    # Large buckets: every two blocks of a key meet in one group of at most 2 * block rows.
    large = walked.filter("kind = 1")
    blocks = large.groupBy("key").agg((F.max("block") + 1).alias("n"))
    met = (
        large.join(blocks, "key")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .select(
            "key",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "a",
        )
    )
    return links.unionByName(
        met.groupBy("key", "i", "j").applyInArrow(_block_links(max_bits), "a long, b long")
    ).distinct()


def _classes(prints: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(print, root) for every distinct fingerprint; ``prints`` has one row for each."""
    linked = roots(print_links(prints, max_bits, block))
    return prints.join(linked, prints["print"] == linked["node"], "left").withColumn(
        "root", F.coalesce("root", "print")
    ).drop("node")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Words are runs of non-white characters with A-Z lower-cased. Null, empty and
    blank texts have fingerprint zero and link like any other. Repeated rows each
    get a row. component_id is the smallest doc_id reachable over links of at
    most ``max_bits`` bits; null ids never lead, and a component of null ids has
    component_id null. An empty table gives an empty result; other columns are
    ignored.
    """
    own = stored(fingerprints(docs, words), "simhash-prints")
    prints = stored(own.groupBy("print").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    members = stored(_classes(prints, max_bits, block), "simhash-classes")
    lead = members.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(members.join(lead, "root").select("print", "component_id"), "simhash-named")
    return own.join(named, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """One row of each component of ``near_duplicates``, with the columns of ``docs``.

    The row with the smallest doc_id stays; if several rows of the component
    carry that id, one of them.
    """
    name = fresh(docs, "print")
    own = stored(fingerprints(docs, words), "simhash-prints")
    prints = stored(own.select("print").distinct(), "simhash-distinct")
    members = stored(_classes(prints, max_bits, block).select("print", "root"), "simhash-classes")
    # The leader of a component is its least (doc_id, print), null ids last. Copies are
    # reduced to their least id before anything is joined.
    least = (
        own.groupBy("print", F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"))
        .agg(F.count("*").alias("rows"))
        .groupBy("print")
        .agg(F.min(F.struct("id", "rows")).alias("low"))
    )
    leads = stored(
        least.join(members, "print")
        .groupBy("root")
        .agg(F.min(F.struct("low.id", "print", "low.rows")).alias("lead"))
        .select("lead.id", "lead.print", "lead.rows"),
        "simhash-leads",
    )
    leads = leads.select(
        F.col("id").alias(f"{name}_id"), F.col("print").alias(f"{name}_fp"), "rows"
    ).withColumnRenamed("rows", f"{name}_n")
    marked = docs.withColumn(f"{name}_of", F.coalesce("doc_id", F.lit(LAST_ID))).join(
        leads, F.col(f"{name}_of") == F.col(f"{name}_id")
    )
    # Ids may repeat within a table, so a leader is confirmed by its fingerprint.
    marked = marked.withColumn(f"{name}_own", fingerprint_udf(words)("text")).filter(
        F.col(f"{name}_own") == F.col(f"{name}_fp")
    )
    if leads.filter(F.col(f"{name}_n") > 1).isEmpty():
        return marked.select(docs.columns)
    single = marked.filter(F.col(f"{name}_n") == 1)
    several = marked.filter(F.col(f"{name}_n") > 1).dropDuplicates([f"{name}_id", f"{name}_fp"])
    return single.unionByName(several).select(docs.columns)
