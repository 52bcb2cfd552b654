"""SimHash near-duplicates and line dedup against brute force."""

import hashlib
import string
import time
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallychain.llm import line_dedup, simhash
from tallychain.llm.components import roots
from tallychain.llm.tables import table
from tests.conftest import SF
from tests.llm.conftest import ROWS

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_print(text, size=4):
    words = [w for w in (text or "").translate(LOWER).replace("\v", " ").replace("\f", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, max_bits=4):
    """Class label (least member) of each distinct fingerprint."""
    left, label = sorted(set(prints)), {}
    while left:
        front = [left.pop(0)]
        lead = front[0]
        while front:
            x = front.pop()
            label[x] = lead
            near = [y for y in left if bin(x ^ y).count("1") <= max_bits]
            left = [y for y in left if y not in set(near)]
            front += near
    return label


def brute_components(rows):
    own = [(i, brute_print(t)) for i, t in rows]
    label = brute_classes([p for _, p in own])
    lead = {}
    for i, p in own:
        if i is not None:
            lead[label[p]] = min(i, lead.get(label[p], i))
    return Counter((i, f"{p:016x}", lead.get(label[p])) for i, p in own)


@pytest.mark.parametrize("source", ["given", "edge", "nothing"])
def test_near_duplicates_match_brute_force(spark, edge, nothing, source):
    docs = {"given": table(spark, SF, "documents"), "edge": edge, "nothing": nothing}[source]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in simhash.near_duplicates(docs).collect())
    assert got == brute_components(rows)


def test_golay_decodes_three_errors():
    golay, rng = simhash.Golay(), np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500).astype(np.uint32)
    centre = golay.index(words)
    same = golay.around(words, 23)
    assert (same == centre[:, None]).any(axis=1).all()
    kinds = {len(set(r)) for r in same.tolist()}
    assert kinds <= {1, 6}


def test_prints_within_four_bits_share_a_key():
    rng, golay = np.random.default_rng(2), simhash.Golay()
    base = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    other = base.copy()
    for i in range(len(base)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            other[i] ^= np.uint64(1 << int(bit))
    keys = [[set() for _ in base] for _ in range(2)]
    for side, prints in enumerate((base, other)):
        for k, r in zip(*(a.tolist() for a in simhash.fuzzy_keys(prints, golay))):
            keys[side][r].add(k)
    assert all(a & b for a, b in zip(*keys))


@pytest.mark.parametrize("block", [4, 100_000])
def test_links_connect_what_is_connected(spark, block):
    """Small blocks send dense buckets the way of large ones."""
    rng = np.random.default_rng(3)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(60):
            x = centre
            for bit in rng.choice(64, rng.integers(0, 7), replace=False).tolist():
                x ^= 1 << bit
            prints.add(x)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    links = simhash.print_links(spark.createDataFrame(signed, "print long"), 4, block).collect()
    unsigned = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links]
    assert all(bin(a ^ b).count("1") <= 4 for a, b in unsigned)
    # Spanning links give the same classes as all links do.
    label = {p: p for p in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in unsigned:
        label[find(a)] = find(b)
    want = brute_classes(prints)
    groups = lambda f: sorted(sorted(p for p in prints if f(p) == r) for r in {f(p) for p in prints})
    assert groups(find) == groups(lambda p: want[p])


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 1 for i in range(2, 41)} | {i: 100 for i in range(101, 160)} | {200: 199}
    assert got == want


@pytest.mark.parametrize("source", ["given", "edge", "nothing"])
def test_one_row_of_each_component_stays(spark, edge, nothing, source):
    docs = {"given": table(spark, SF, "documents"), "edge": edge, "nothing": nothing}[source]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_components(rows)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({fp: str(c) for (_, fp, c) in want}[fp] for fp in
        {c if c is not None else "null": fp for (_, fp, c) in want}.values())


# Line dedup


def brute_lines(rows):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(LOWER)
    last = (1 << 63) - 1
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if min(holders.get(key(x), {0: 0})) == (last if i is None else i) or len(holders.get(key(x), ())) < 2]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("source", ["given", "edge", "nothing"])
def test_lines_match_brute_force(spark, edge, nothing, source):
    docs = {"given": table(spark, SF, "documents"), "edge": edge, "nothing": nothing}[source]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert Counter(tuple(r) for r in got.collect()) == brute_lines(rows)


def _state(store):
    maybe = {r["shard"]: line_dedup.CuckooFilter.load(bytes(r["filter"])) for r in store.filters.collect()}
    return (
        Counter(tuple(r) for r in store.counts.select("high", "low", "refs", "first_doc", "last_doc").collect()),
        {s: sum(int(np.count_nonzero(t)) for t in f.tables) for s, f in maybe.items()},
        maybe,
    )


def test_deleting_documents_reverses_their_insertion(spark):
    docs = table(spark, SF, "documents")
    early, late = docs.filter("doc_id % 3 > 0"), docs.filter("doc_id % 3 = 0")
    empty = line_dedup.empty_store(spark, 1 << 18)
    one = line_dedup.insert(empty, line_dedup.line_references(early))
    both = line_dedup.insert(one, line_dedup.line_references(late))
    back = line_dedup.delete(both, late.select("doc_id"))
    counts, marks, _ = _state(one)
    again, marks_again, filters = _state(back)
    assert counts == again and marks == {k: v for k, v in marks_again.items() if v or k in marks}
    for r in back.counts.collect():
        assert filters[r.shard].contains(np.array([r.high]), np.array([r.low]))[0]
    whole = line_dedup.insert(empty, line_dedup.line_references(docs))
    assert _state(whole)[0] == _state(both)[0]
    assert _state(line_dedup.delete(back, early.select("doc_id")))[0] == Counter()


def test_cuckoo_filter_never_denies_and_forgets():
    rng = np.random.default_rng(4)
    high, low = rng.integers(-(1 << 63), (1 << 63) - 1, (2, 60_000))
    table_ = line_dedup.CuckooFilter()
    for at in range(0, 60_000, 7_000):
        table_.insert(high[at : at + 7_000], low[at : at + 7_000])
    assert table_.contains(high, low).all()
    other = rng.integers(-(1 << 63), (1 << 63) - 1, 20_000)
    assert table_.contains(other, other).mean() < 0.01
    loaded = line_dedup.CuckooFilter.load(table_.dump())
    loaded.delete(high[:5_000], low[:5_000])
    assert loaded.contains(high[5_000:], low[5_000:]).all()
    assert loaded.contains(high[:5_000], low[:5_000]).mean() < 0.01
    loaded.delete(high[5_000:], low[5_000:])
    assert not any(t.any() for t in loaded.tables)


def test_deleting_keys_of_later_tables_denies_no_other():
    # Low bits: a mark of 16, then the place; marks and places from few values, so that they meet.
    rng = np.random.default_rng(5)
    low = np.unique(rng.integers(0, 1 << 12, 3_000) << 16 | rng.integers(1, 60, 3_000)).astype(np.int64)
    rng.shuffle(low)
    high = np.zeros_like(low)
    table_ = line_dedup.CuckooFilter()
    for at in range(0, len(low), 100):
        table_.insert(high[at : at + 100], low[at : at + 100])
    sizes = [len(t) for t in table_.tables]
    assert len(sizes) > 2 and all(a < b for a, b in zip(sizes, sizes[1:]))
    while len(low):
        table_.delete(high[-50:], low[-50:])
        low, high = low[:-50], high[:-50]
        assert table_.contains(high, low).all()
    assert not any(t.any() for t in table_.tables)


def test_edge_rows_are_what_the_tests_say():
    assert len(ROWS) == 12


def test_many_rows_without_an_id_or_with_one_id(spark):
    """4000 rows of 50 lines that are two documents: work grows with the rows, not with their square."""
    def lines(i):
        own = [f"a line of row {i} that is its own, number {j}" for j in range(25)]
        return "\n".join(own + [f"a line that many rows have, number {(i + j) % 400}" for j in range(25)])

    rows = [(None, lines(i)) for i in range(2000)] + [(7, lines(i + 1000)) for i in range(2000)] + [(3, lines(9))]
    rows += [(7, lines(1000)), (None, lines(0))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    start = time.perf_counter()
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    assert time.perf_counter() - start < 60
    assert Counter(tuple(r) for r in got) == brute_lines(rows)
