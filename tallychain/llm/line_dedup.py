"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

The store is three tables. ``references`` has a row for each line key and
document; ``counts`` has the exact reference count of each key with its first and
last document; ``filters`` has a cuckoo filter for each shard of the keys. A batch
is reduced to one row for each key before it is shuffled, so a line that a third
of all documents hold is one row in its shard. The filter tells which keys are
certainly new: only the others are looked up in the exact table. Deleting
documents takes their references, counts and filter entries back.

Texts are reduced to 128-bit key hashes; equal hashes are taken as equal lines.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallychain.llm.tables import LAST_ID, each_text, map_rows, stored

MIN_CHARS = 10
#: Keys one shard is meant for.
SHARD_KEYS = 1 << 13
SLOTS = 4
WHITE = " \t\n\v\f\r"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def line_key(line: str, min_chars: int = MIN_CHARS) -> tuple[int, int] | None:
    """128 bits of the normalised line as two signed longs, or None if it is too short to count."""
    key = line.strip(WHITE).translate(LOWER)
    if len(key) < min_chars:
        return None
    digest = xxhash.xxh3_128_digest(key.encode())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


class CuckooFilter:
    """A chain of tables of 16-bit fingerprints; a table that is full is followed by a larger one.

    Never denies a key that was inserted and not deleted. Work is done in rounds
    over whole arrays; a round places at most one key in each bucket.
    """

    def __init__(self, tables: list[np.ndarray] | None = None):
        self.tables = tables or []

    @classmethod
    def load(cls, blob: bytes | None) -> CuckooFilter:
        tables, at = [], 0
        while blob and at < len(blob):
            n = 1 << blob[at]
            tables.append(np.frombuffer(blob, "<u2", n * SLOTS, at + 1).reshape(n, SLOTS).copy())
            at += 1 + n * SLOTS * 2
        return cls(tables)

    def dump(self) -> bytes:
        return b"".join(
            bytes([len(t).bit_length() - 1]) + t.astype("<u2").tobytes() for t in self.tables
        )

    @staticmethod
    def _marks(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (low.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        return np.where(mark == 0, 1, mark).astype(np.uint16), low.view(np.uint64) >> np.uint64(16)

    @staticmethod
    def _other(bucket: np.ndarray, mark: np.ndarray, n: int) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995) & (n - 1))

    def contains(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        mark, place = self._marks(high, low)
        found = np.zeros(len(mark), dtype=bool)
        for t in self.tables:
            one = (place & np.uint64(len(t) - 1)).astype(np.int64)
            two = self._other(one, mark, len(t))
            found |= ((t[one] == mark[:, None]) | (t[two] == mark[:, None])).any(axis=1)
        return found

    def _fill(self, t: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place what fits; returns the marks and buckets left over."""
        tries = np.zeros(len(mark), dtype=np.int64)
        for turn in range(500):
            if not len(mark):
                break
            _, take = np.unique(bucket, return_index=True)
            free = t[bucket[take]] == 0
            fits = free.any(axis=1)
            put = take[fits]
            t[bucket[put], free[fits].argmax(axis=1)] = mark[put]
            full = take[~fits]
            again = full[tries[full] == 0]  # first the other bucket, then evict
            evict = full[tries[full] > 0]
            bucket[again] = self._other(bucket[again], mark[again], len(t))
            slot = (evict + turn) % SLOTS
            victim = t[bucket[evict], slot]
            t[bucket[evict], slot] = mark[evict]
            mark[evict] = victim
            bucket[evict] = self._other(bucket[evict], victim, len(t))
            tries[full] += 1
            stay = np.ones(len(mark), dtype=bool)
            stay[put] = False
            mark, bucket, tries = mark[stay], bucket[stay], tries[stay]
        return mark, bucket

    def insert(self, high: np.ndarray, low: np.ndarray) -> None:
        mark, place = self._marks(high, low)
        if not len(mark):
            return
        if not self.tables:
            self.tables.append(self._table(len(mark)))
        # Marks evicted in the last rounds keep their bucket, so a table is given up
        # before it is full: what is certain to fit is tried, the rest goes on.
        for i in range(64):
            if i == len(self.tables):
                self.tables.append(self._table(max(len(mark), len(self.tables[-1]) * SLOTS)))
            t = self.tables[i]
            room = int(len(t) * SLOTS * 0.85) - int(np.count_nonzero(t))
            n = max(0, min(room, len(mark)))
            bucket = (place[:n] & np.uint64(len(t) - 1)).astype(np.int64)
            kept = t.copy()
            left, _ = self._fill(kept, mark[:n].copy(), bucket)
            if not len(left):
                self.tables[i] = kept
                mark, place = mark[n:], place[n:]
            if not len(mark):
                return
        raise RuntimeError("a bucket holds too many equal fingerprints")

    def delete(self, high: np.ndarray, low: np.ndarray) -> None:
        """Take back keys that were inserted, each from the last table that has its mark.

        Tables grow along the chain by powers of two, so keys of one mark that share buckets in
        a table share them in all before it: should the mark be another key's, the one left in
        an earlier table is in that key's buckets too. The first table says nothing of later ones.
        """
        mark, place = self._marks(high, low)
        for m, p in zip(mark, place):
            for t in reversed(self.tables):
                one = int(p) & (len(t) - 1)
                two = int(self._other(np.array([one]), np.array([m]), len(t))[0])
                at = next((b for b in (one, two) if (t[b] == m).any()), None)
                if at is not None:
                    t[at, int((t[at] == m).argmax())] = 0
                    break

    @staticmethod
    def _table(keys: int) -> np.ndarray:
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, keys) / SLOTS / 0.8))))
        return np.zeros((buckets, SLOTS), dtype=np.uint16)


@dataclass(frozen=True)
class LineStore:
    references: DataFrame  # shard, high, low, doc_id
    counts: DataFrame  # shard, high, low, refs, first_doc, last_doc
    filters: DataFrame  # shard, filter
    shards: int
    min_chars: int = MIN_CHARS


_KEY = "shard int, high long, low long"
_COUNT = ["shard", "high", "low", "refs", "first_doc", "last_doc"]


def empty_store(spark: SparkSession, keys: int = SHARD_KEYS, min_chars: int = MIN_CHARS) -> LineStore:
    """A store for about ``keys`` line keys; more only makes its filters longer."""
    shards = 1 << max(0, int(np.ceil(np.log2(max(1, keys / SHARD_KEYS)))))
    return LineStore(
        spark.createDataFrame([], f"{_KEY}, doc_id long"),
        spark.createDataFrame([], f"{_KEY}, refs long, first_doc long, last_doc long"),
        spark.createDataFrame([], "shard int, filter binary"),
        shards,
        min_chars,
    )


def _keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, the last one for a null, and text."""
    return docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).cast("long").alias("doc_id"), "text")


def ids_repeat(docs: DataFrame) -> bool:
    """Whether a document is given in several rows; null ids are one document."""
    return not _keyed_rows(docs).groupBy("doc_id").count().filter("count > 1").isEmpty()


def _keys_of_rows(docs: DataFrame, min_chars: int, *more: Column) -> DataFrame:
    """(high, low, doc_id and the long columns ``more``), one row for each key of a row."""
    slim = _keyed_rows(docs).select("doc_id", "text", *more)
    others = [c for c in slim.columns if c != "text"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        high, low, row = [], [], []
        for i, text in enumerate(each_text(batch.column("text"))):
            lines = (text or b"").decode().split("\n")
            keys = {line_key(line, min_chars) for line in lines} - {None}
            high += [k[0] for k in keys]
            low += [k[1] for k in keys]
            row += [i] * len(keys)
        found = {"high": pa.array(high, pa.int64()), "low": pa.array(low, pa.int64())}
        at = pa.array(row, pa.int64())
        yield pa.record_batch(found | {c: batch.column(c).take(at) for c in others})

    return map_rows(slim, work, ", ".join(f"{c} long" for c in ["high", "low", *others]))


def line_references(
    docs: DataFrame, min_chars: int = MIN_CHARS, repeats: bool | None = None
) -> DataFrame:
    """(high, low, doc_id), one row for each key and document, stored. A null id counts as the last one.

    ``repeats`` is what ``ids_repeat`` says of ``docs``, if known.
    """
    rows = _keys_of_rows(docs, min_chars)
    # A document given in several rows refers to a line once.
    if ids_repeat(docs) if repeats is None else repeats:
        rows = rows.distinct()
    return stored(rows, "lines-references")


def _count(references: DataFrame) -> DataFrame:
    """Exact counts. Partial sums collapse a common line before the shuffle."""
    return references.groupBy("shard", "high", "low").agg(
        F.count("*").alias("refs"),
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
    )


def _by_shard(keys: DataFrame, filters: DataFrame, change: str) -> DataFrame:
    """The filters after ``change`` ("insert" or "delete") of distinct keys."""

    def run(new: pa.Table, old: pa.Table) -> pa.Table:
        blob = old.column("filter").to_pylist()
        shard = (old if len(old) else new).column("shard")[0].as_py()
        table = CuckooFilter.load(blob[0] if blob else None)
        if len(new):
            getattr(table, change)(new.column("high").to_numpy(), new.column("low").to_numpy())
        return pa.table(
            {"shard": pa.array([shard], pa.int32()), "filter": pa.array([table.dump()], pa.binary())}
        )

    return (
        keys.select("shard", "high", "low")
        .groupBy("shard")
        .cogroup(filters.groupBy("shard"))
        .applyInArrow(run, "shard int, filter binary")
    )


def _probed(delta: DataFrame, filters: DataFrame) -> DataFrame:
    """``delta`` with maybe_known: false is certain."""

    def run(new: pa.Table, old: pa.Table) -> pa.Table:
        blob = old.column("filter").to_pylist()
        maybe = CuckooFilter.load(blob[0] if blob else None).contains(
            new.column("high").to_numpy(), new.column("low").to_numpy()
        )
        return new.append_column("maybe_known", pa.array(maybe, pa.bool_()))

    return (
        delta.groupBy("shard")
        .cogroup(filters.groupBy("shard"))
        .applyInArrow(run, f"{_KEY}, refs long, first_doc long, last_doc long, maybe_known boolean")
    )


def insert(store: LineStore, references: DataFrame) -> LineStore:
    """Add ``line_references`` of documents that are not yet in the store."""
    references = references.select(
        F.col("high").bitwiseAND(F.lit(store.shards - 1)).cast("int").alias("shard"),
        "high",
        "low",
        "doc_id",
    )
    delta = stored(_probed(_count(references), store.filters), "lines-delta")
    # The exact table decides only where the filter could not rule the key out.
    key = ["shard", "high", "low"]
    known = delta.filter("maybe_known").join(
        store.counts.select(*key, *(F.col(c).alias(f"old_{c}") for c in _COUNT[3:])), key
    )
    known = stored(
        known.select(
            *key,
            (F.col("refs") + F.col("old_refs")).alias("refs"),
            F.least("first_doc", "old_first_doc").alias("first_doc"),
            F.greatest("last_doc", "old_last_doc").alias("last_doc"),
        ),
        "lines-known",
    )
    false_alarm = delta.filter("maybe_known").select(_COUNT).join(known.select(key), key, "left_anti")
    new = delta.filter("not maybe_known").select(_COUNT).unionByName(false_alarm)
    counts = stored(
        store.counts.join(known.select(key), key, "left_anti").unionByName(known).unionByName(new),
        "lines-counts",
    )
    filters = stored(_by_shard(new, store.filters, "insert"), "lines-filters")
    return LineStore(
        store.references.unionByName(references), counts, filters, store.shards, store.min_chars
    )


def delete(store: LineStore, doc_ids: DataFrame) -> LineStore:
    """Take documents back: the store is then as if they had never been inserted."""
    ids = doc_ids.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id")).distinct()
    key = ["shard", "high", "low"]
    left = stored(store.references.join(ids, "doc_id", "left_anti").select(*key, "doc_id"), "lines-references")
    touched = store.references.join(ids, "doc_id", "left_semi").select(key).distinct()
    recount = stored(
        touched.join(_count(left), key, "left").select(*key, *_COUNT[3:]), "lines-recount"
    )
    counts = stored(
        store.counts.join(recount.select(key), key, "left_anti").unionByName(
            recount.filter("refs is not null")
        ),
        "lines-counts",
    )
    gone = recount.filter("refs is null")
    filters = stored(_by_shard(gone, store.filters, "delete"), "lines-filters")
    return LineStore(left, counts, filters, store.shards, store.min_chars)


def drops(store: LineStore, references: DataFrame | None = None, *by: str) -> DataFrame:
    """(doc_id, keys): keys each document loses, as it is not the first that holds them.

    ``references`` are those of the store unless others are given; ``by`` are columns of
    theirs that part the keys of a document.
    """
    shared = store.counts.filter("first_doc <> last_doc").select("high", "low", "first_doc")
    return (
        (store.references if references is None else references)
        .join(shared, ["high", "low"])
        .filter("doc_id <> first_doc")
        .groupBy("doc_id", *by)
        .agg(F.collect_set(F.struct("high", "low")).alias("keys"))
    )


_RESULT = (
    "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string"
)


def clean(store: LineStore, docs: DataFrame, repeats: bool | None = None) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, kept_text) for every row of ``docs``.

    Where a document has several rows, each is given the keys of its own text alone: a
    third of all rows without an id are one document, whose keys together no row could hold.
    """
    min_chars = store.min_chars

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        n_lines, n_dropped, digests, kept_texts = [], [], [], []
        for text, lost in zip(each_text(batch.column(1)), keys):
            lines = (text or b"").decode().split("\n")
            gone = {(k["high"], k["low"]) for k in lost or ()}
            kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            whole = "\n".join(kept)
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
            digests.append(hashlib.sha256(whole.encode()).hexdigest())
            kept_texts.append(whole)
        yield pa.record_batch(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept_text": pa.array(kept_texts, pa.string()),
            }
        )

    slim = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LAST_ID)).cast("long").alias("key_id"))
    if ids_repeat(docs) if repeats is None else repeats:
        # Texts of equal hash only share keys, and a row loses none that it does not have.
        of_text = F.xxhash64("text").alias("text_id")
        own = stored(_keys_of_rows(docs, min_chars, of_text).distinct(), "lines-of-texts")
        slim, by = slim.select("*", of_text), ["text_id"]
        lost = drops(store, own, *by)
    else:
        lost, by = drops(store), []
    joined = slim.join(lost.withColumnRenamed("doc_id", "key_id"), ["key_id", *by], "left")
    return map_rows(joined.select("doc_id", "text", "keys"), work, _RESULT)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Line dedup of a whole table, inserted in two increments, older ids first.

    A key that at least two documents hold keeps its lines only in the smallest
    doc_id holding it, there all of them. Null and empty texts are one empty line.
    Rows with the same doc_id are one document; null ids count as one document
    that comes last. Short lines stay. Every row gets a row; an empty table gives
    an empty result; other columns are ignored.
    """
    repeats = ids_repeat(docs)
    references = line_references(docs, min_chars, repeats)
    size = references.agg(F.count("*"), F.percentile_approx("doc_id", 0.5)).first()
    store = empty_store(docs.sparkSession, size[0], min_chars)
    middle = F.lit(size[1] if size[1] is not None else 0)
    for increment in (F.col("doc_id") <= middle, F.col("doc_id") > middle):
        store = insert(store, references.filter(increment))
    return clean(store, docs, repeats)
