"""Benchmark decontamination with a distributed positional inverted index.

The training table is indexed in segments: each Arrow batch of a scan becomes one
segment, holding a posting list (document number, word position) for each term.
Searching never leaves a segment, so no text and no posting list of another
segment is shuffled to it:

1. Item windows are made from the benchmark; their terms are the vocabulary. A window is
   named by a hash of its terms; which items have it is a table beside them.
2. Terms are counted over all segments; a window's rarest term is its first.
3. A window goes to the segments that have its rarest term, and there the lists of
   its terms, each shifted by the term's offset, are intersected from the rarest on.
4. Documents that windows were found in are joined with the items of these, so that a
   passage of a million items is one window wherever it is searched.

Only postings of words that the benchmark may have are stored. They are told by a
bit set of fixed size, whatever the size of the benchmark: a false positive costs
an unused posting list, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallychain.llm.tables import each_text, map_rows, pieces, stored

WINDOW_WORDS = 10
#: How far proximity lets a term stand from its place in the window.
SLOP = 1
#: Bits of the vocabulary filter: 1 MiB in each task.
FILTER_BITS = 1 << 23
#: Bytes of text of one segment.
SEGMENT_BYTES = 1 << 23

#: Word bytes: 0-9, a-z, everything beyond ASCII; A-Z become a-z, the rest becomes a space.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def _tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def item_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, window, terms): the distinct windows of each item; item_id as a string.

    ``window`` names the terms: their 128-bit hash. An item of fewer words is one window;
    one of none has no window. An item without id has windows like any other.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, terms = [], []
        for item, text in zip(batch.column(0).to_pylist(), each_text(batch.column(1))):
            words = [w.decode() for w in _tokens(text)]
            for at in range(max(1, len(words) - size + 1) if words else 0):
                ids.append(item)
                terms.append(words[at : at + size])
        yield pa.record_batch(
            {
                "item_id": pa.array(ids, pa.string()),
                "terms": pa.array(terms, pa.list_(pa.string())),
            }
        )

    slim = items.select(F.col("item_id").cast("string"), "text")
    # Words hold no blanks.
    name = F.unhex(F.md5(F.array_join("terms", " "))).alias("window")
    return map_rows(slim, work, "item_id string, terms array<string>").select("item_id", name, "terms").distinct()


def windows(made: DataFrame) -> DataFrame:
    """(window, terms): the distinct windows of ``item_windows``."""
    return made.select("window", "terms").distinct()


def vocabulary_filter(found: DataFrame) -> np.ndarray:
    """Words of 64 bits, ``FILTER_BITS`` in all, with the bit of each window term set."""
    bit = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS))
    rows = (
        found.select(F.explode("terms").alias("term"))
        .distinct()
        .groupBy(F.shiftright(bit, 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(pmod(xxhash64(term), %d), 64) as int))" % FILTER_BITS)).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return bits


def _in_filter(bits: np.ndarray, terms: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(t, 42) for t in terms), dtype=np.uint64, count=len(terms))
    at = hashes.view(np.int64) % FILTER_BITS
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


#: A segment row is a posting list (term, n, data) or, with term null, its documents (data: word counts).
_SEGMENT = "segment long, term string, n long, data binary, doc_ids array<long>, hashes array<binary>"


def build_index(docs: DataFrame, bits: np.ndarray | None = None) -> DataFrame:
    """The stored index over all rows: segment rows of posting lists and of documents.

    With ``bits``, only terms of that vocabulary are stored. A posting is
    document number * 2^32 + word position, lists are stored as differences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, hashes = (batch.column(i) for i in range(3))
            for start, end in pieces(texts, SEGMENT_BYTES):
                number: dict[bytes, int] = {}
                terms, counts = [], []
                for text in each_text(texts.slice(start, end - start)):
                    words = _tokens(text)
                    counts.append(len(words))
                    terms.append(
                        np.fromiter(
                            (number.setdefault(w, len(number)) for w in words), np.int32, len(words)
                        )
                    )
                own = list(number)
                keep = _in_filter(bits, own) if bits is not None else np.ones(len(own), dtype=bool)
                all_terms = np.concatenate(terms)
                lengths = np.array(counts, dtype=np.int64)
                first = np.cumsum(lengths) - lengths
                at = np.flatnonzero(keep[all_terms]) if len(own) else np.empty(0, np.int64)
                doc = np.repeat(np.arange(len(lengths)), lengths)[at]
                posting = (doc << 32) + (at - first[doc])
                order = np.argsort(all_terms[at], kind="stable")
                sorted_terms = all_terms[at][order]
                edges = np.flatnonzero(np.diff(sorted_terms)) + 1
                lists = np.split(posting[order], edges) if len(order) else []
                heads = sorted_terms[np.concatenate(([0], edges))] if len(order) else []
                rows = len(lists)
                yield pa.record_batch(
                    {
                        "segment": pa.array([segment] * (rows + 1), pa.int64()),
                        "term": pa.array([own[t].decode() for t in heads] + [None], pa.string()),
                        "n": pa.array([len(x) for x in lists] + [len(counts)], pa.int64()),
                        "data": pa.array(
                            [np.diff(x, prepend=0).tobytes() for x in lists] + [lengths.tobytes()],
                            pa.binary(),
                        ),
                        "doc_ids": pa.array(
                            [None] * rows + [ids.slice(start, end - start).to_pylist()],
                            pa.list_(pa.int64()),
                        ),
                        "hashes": pa.array(
                            [None] * rows + [hashes.slice(start, end - start).to_pylist()],
                            pa.list_(pa.binary()),
                        ),
                    }
                )
                segment += 1

    return stored(docs.select("doc_id", "text", text_key("text")).mapInArrow(run, _SEGMENT), "index")


def text_key(column: str):
    """What equal texts share; used to find the rows of a text again."""
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit("")))).alias("hash")


def _near(sorted_at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Distance from each wanted value to the closest of ``sorted_at``."""
    right = np.searchsorted(sorted_at, wanted)
    after = sorted_at[np.minimum(right, len(sorted_at) - 1)]
    before = sorted_at[np.maximum(right - 1, 0)]
    return np.minimum(np.abs(after - wanted), np.abs(before - wanted))


def _covered(starts: np.ndarray, ends: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document inside any [start, end); positions are postings."""
    out = np.zeros(n_docs, dtype=np.int64)
    if not len(starts):
        return out
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    begin = starts.copy()
    begin[1:] = np.maximum(starts[1:], ends[:-1])
    np.add.at(out, starts >> 32, np.maximum(ends - begin, 0))
    return out


_FOUND = (
    "segment long, number int, doc_id long, hash binary, n_words long, n_hit long, n_near long, windows array<binary>"
)


def search(index: DataFrame, found: DataFrame, slop: int = SLOP) -> DataFrame:
    """A row for each indexed document: words hit by a window, by proximity, and the windows found.

    ``found``: the ``windows``. ``number`` tells the documents of a segment. A phrase match has every term in its place. A
    proximity match has every term within ``slop`` words of its place around the
    rarest term; n_near counts the words such matches span, phrases included.
    """
    lists = index.filter("term is not null")
    place = found.select("window", F.posexplode("terms").alias("offset", "term"))
    counts = (
        lists.join(place.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    # Terms that no document has make a window impossible: its rarest count is then 0.
    ranked = (
        place.join(counts, "term", "left")
        .groupBy("window")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("ranked"))
        .filter("ranked[0].n > 0")
    )
    asked = stored(
        ranked.select(
            "window",
            F.col("ranked.offset").alias("offsets"),
            F.col("ranked.term").alias("terms"),
        ),
        "index-asked",
    )
    # One row for each segment a window may occur in; the lists stay where they are.
    sent = (
        lists.select(F.col("segment").alias("at"), "term")
        .join(asked.withColumn("rarest", F.col("terms")[0]), F.col("term") == F.col("rarest"))
        .select("at", "window", "offsets", "terms")
    )

    def run(own: pa.Table, queries: pa.Table) -> pa.Table:
        posting, docs = {}, None
        for term, data, doc_ids, hashes in zip(
            *(own.column(c).to_pylist() for c in ("term", "data", "doc_ids", "hashes"))
        ):
            if term is None:
                docs = (doc_ids, hashes, np.frombuffer(data, np.int64))
            else:
                posting[term] = data
        doc_ids, hashes, lengths = docs
        read: dict[str, np.ndarray] = {}
        exact, near = [], []
        hit: list[set] = [set() for _ in doc_ids]
        for window, offsets, terms in zip(
            *(queries.column(c).to_pylist() for c in ("window", "offsets", "terms"))
        ):
            if any(t not in posting for t in terms):
                continue
            starts = drift = None
            for offset, term in zip(offsets, terms):
                if term not in read:
                    read[term] = np.cumsum(np.frombuffer(posting[term], np.int64))
                if starts is None:
                    starts = read[term] - offset
                    # A window may not begin before its document.
                    starts = starts[(starts & 0xFFFFFFFF) < 1 << 31]
                    drift = np.zeros(len(starts), dtype=np.int64)
                else:
                    off = _near(read[term], starts + offset)
                    close = off <= slop
                    starts, drift = starts[close], np.maximum(drift[close], off[close])
                if not len(starts):
                    break
            if len(starts):
                near.append((starts, starts + len(terms)))
                starts = starts[drift == 0]
                exact.append((starts, starts + len(terms)))
                for d in np.unique(starts >> 32):
                    hit[d].add(window)

        def cover(found_at: list) -> np.ndarray:
            if not found_at:
                return np.zeros(len(doc_ids), dtype=np.int64)
            starts = np.concatenate([a for a, _ in found_at])
            ends = np.concatenate([b for _, b in found_at])
            return _covered(starts, np.minimum(ends, (starts >> 32 << 32) + lengths[starts >> 32]), len(doc_ids))

        return pa.table(
            {
                "segment": pa.array([own.column("segment")[0].as_py()] * len(doc_ids), pa.int64()),
                "number": pa.array(range(len(doc_ids)), pa.int32()),
                "doc_id": pa.array(doc_ids, pa.int64()),
                "hash": pa.array(hashes, pa.binary()),
                "n_words": pa.array(lengths),
                "n_hit": pa.array(cover(exact)),
                "n_near": pa.array(cover(near)),
                "windows": pa.array([sorted(x) for x in hit], pa.list_(pa.binary())),
            }
        )

    return (
        index.groupBy("segment")
        .cogroup(sent.groupBy("at"))
        .applyInArrow(run, _FOUND)
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, slop: int = SLOP) -> DataFrame:
    """(doc_id, n_words, n_hit, n_near, n_items, items, contaminated) for every row of ``docs``.

    A null or empty text has no words. Repeated rows get a row each, null ids
    stay null; words of an item without id are hit, but it is neither counted nor
    listed. An empty benchmark contaminates nothing, an empty table gives an empty
    result; other columns are ignored.
    """
    made = stored(item_windows(items, size), "index-items")
    rows, row = stored(_found(docs, made, slop), "index-hits"), ["segment", "number"]
    # A row that hits many windows of an item, and an item that is in many rows, are pairs once.
    pairs = (
        rows.select(*row, F.explode("windows").alias("window"))
        .join(made.filter("item_id is not null").select("window", "item_id"), "window")
        .select(*row, "item_id")
        .distinct()
        .groupBy(*row)
        .agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    )
    measures = ["doc_id", "n_words", "n_hit", "n_near"]
    listed = rows.filter("size(windows) > 0").join(pairs, row, "left").select(*measures, "items")
    clean = rows.filter("size(windows) = 0").select(*measures, F.lit(None).cast("array<string>").alias("items"))
    named = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return listed.unionByName(clean).select(
        *measures,
        F.size(named).cast("long").alias("n_items"),
        named.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _found(docs: DataFrame, made: DataFrame, slop: int) -> DataFrame:
    found = stored(windows(made), "index-found")
    return search(build_index(docs, vocabulary_filter(found)), found, slop)


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit word, all columns kept."""
    hit = stored(
        _found(docs, stored(item_windows(items, size), "index-items"), 0).filter("n_hit > 0").select("hash").distinct(), "index-hit"
    )
    return docs.join(hit, text_key("text") == hit["hash"], "left_anti")
