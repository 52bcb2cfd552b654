"""Exact dedup, importance resampling and fill-in-the-middle."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallychain.llm import exact_dedup, fill_in_middle, queries, resampling
from tallychain.llm.tables import table
from tests.conftest import SF

SF1 = "/root/testdata/sf0.01"


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- exact dedup -------------------------------------------------------------------------


def brute_copies(rows):
    """Verdicts as (doc_id, keep_id, group_size) and how many rows of each group stay."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    first = lambda ids: max((i for i in ids if i is not None), default=None)
    return Counter((i, first(ids), len(ids)) for ids in groups.values() for i in ids), len(groups)


def _check_copies(docs):
    rows = docs.select("doc_id", "text").collect()
    out = exact_dedup.exact_copies(docs, digest=True).collect()
    expected, groups = brute_copies(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in out) == expected
    assert sum(r.kept for r in out) == groups
    assert all(r.doc_id == r.keep_id for r in out if r.kept)
    shas = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    assert Counter((r.doc_id, r.text_sha256) for r in out) == shas
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    tops = {}
    for r in rows:
        best = tops.get(r.text or "")
        tops[r.text or ""] = max(-1 if best is None else best, -1 if r.doc_id is None else r.doc_id)
    kept = [(r.text or "", -1 if r.doc_id is None else r.doc_id) for r in left.collect()]
    assert len(kept) == len(tops) and dict(kept) == tops


@pytest.mark.parametrize("bits", [exact_dedup.FILTER_BITS, 1 << 15])
def test_exact_copies_equal_brute_force(spark, monkeypatch, bits):
    """Copies, equal lengths, equal prefixes and, in a set that is full, false alarms."""
    monkeypatch.setattr(exact_dedup, "FILTER_BITS", bits)
    draw = random.Random(3)
    stem = "a common start that is longer than the sixty-four characters of the prefix hash "
    texts = ["", "x", "y", "same", "Same", "same ", "ünï", "ñ", "ñ"]
    texts += [stem + c for c in "abcab"] + [f"{i % 70:04}" for i in range(200)] + ["hot"] * 300
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "hot"), (None, None), (None, "alone"), (7, "hot")]
    draw.shuffle(rows)
    _check_copies(_docs(spark, rows))


def test_exact_copies_of_edge_rows(edge, nothing):
    _check_copies(edge)
    _check_copies(nothing)


def test_no_collision_of_edge_columns(edge):
    clashing = edge.withColumns({"size": F.lit(1), "head": F.lit(2), "full": F.lit(3), "whole": F.lit(4), "tie": F.lit(5)})
    assert exact_dedup.drop_exact_copies(clashing).count() == exact_dedup.drop_exact_copies(edge).count()


def test_only_possible_copies_are_hashed_in_full(spark):
    docs = _docs(spark, [(1, "one"), (2, "longer"), (3, "two"), (4, "two"), (5, "six")])
    shapes = {(r.size, r.head) for r in exact_dedup.repeated_shapes(docs).collect()}
    assert shapes == {(3, _docs(spark, [(0, "two")]).select(F.xxhash64("text")).first()[0])}
    marked = exact_dedup._marked(docs, F.sha2("text", 256)).collect()
    assert {r.doc_id for r in marked if r.full} == {3, 4}


def test_exact_dedup_has_no_python(spark):
    plan = exact_dedup.exact_copies(table(spark, SF, "documents"), digest=True)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- importance resampling ---------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def brute_resample(docs, items):
    """{row number: (doc_id, n_features, weight, score, rank)}."""
    count = [Counter(), Counter()]
    made = []
    for side, texts in enumerate(([t for _, t in docs], items)):
        for t in texts:
            found = [zlib.crc32(f.encode()) % 10000 for f in features(t)[0]]
            count[side].update(found)
            if side == 0:
                made.append((found, features(t)[1]))
    s_all, t_all = (float(sum(c.values())) for c in count)

    def gain(b):
        return math.floor(1000 * math.log((count[1][b] + 1) * (s_all + 10000) / ((count[0][b] + 1) * (t_all + 10000))))

    out, fit = {}, []
    for i, ((doc_id, _), (found, n)) in enumerate(zip(docs, made)):
        weight = sum(map(gain, found))
        score = weight + resampling.gumbel(doc_id)
        out[i] = [doc_id, len(found), weight, score, None]
        if n >= 20:
            fit.append((-score, doc_id is None, doc_id or 0, i))
    for rank, (*_, i) in enumerate(sorted(fit)[: 5 * len(fit) // 100], 1):
        out[i][4] = rank
    return Counter(map(tuple, out.values()))


def _resampled(docs, items):
    out = resampling.resample(docs, items)
    return Counter(tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("block", [1, 4, 32, 256])
def test_span_checksums_are_crc32(monkeypatch, block):
    """Spans shorter than a block, exactly one, and many, overlapping."""
    monkeypatch.setattr(resampling, "BLOCK", block)
    monkeypatch.setattr(resampling, "STEP", 1000)
    for cached in (resampling.position_table, resampling._short_constants):
        cached.cache_clear()
    try:
        data = np.frombuffer(random.Random(block).randbytes(5000), np.uint8)
        sizes = [1, 2, 3, 4, 5, 31, 32, 33, 255, 256, 257, 511, 512, 513, 1000, 4000, 4999]
        spans = [(s, s + n) for n in sizes for s in (0, 1, 500) if s + n <= 5000]
        random.Random(1).shuffle(spans)
        start, end = (np.array(x) for x in zip(*spans))
        found = resampling.crc_spans(data, start, end)
        assert found.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in spans]
    finally:
        for cached in (resampling.position_table, resampling._short_constants):
            cached.cache_clear()


def test_length_constants():
    for n in (0, 1, 255, 256, 257, 100_003):
        assert resampling.length_constant(n) == zlib.crc32(bytes(n))


def test_runs_keep_to_their_text():
    texts = ["", "One  two-THREE", None, "", "four", "!!", "ÉCOLE é5", "word" * 300 + " end", ""]
    for start in (0, 1, 4):
        sliced = pa.array(texts, pa.string()).slice(start)
        words, runs = resampling.word_runs(sliced)
        assert words.tolist() == [features(t)[1] for t in texts[start:]]
        found = Counter((int(d), int(c)) for text, crc in runs for d, c in zip(text, crc))
        expected = Counter(
            (i, zlib.crc32(f.encode())) for i, t in enumerate(texts[start:]) for f in features(t)[0]
        )
        assert found == expected


@pytest.mark.parametrize("step", [1, 5, 40])
def test_long_texts_come_in_parts(monkeypatch, step):
    monkeypatch.setattr(resampling, "TEXT_STEP", step)
    draw = random.Random(step)
    texts = [" ".join(draw.choices(["a", "Bc", "-", "ünï", "9" * 30], k=60)) for _ in range(20)] + ["x" * 500, "", None]
    batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
    found, words = Counter(), Counter()
    for rows, part, carried in resampling._text_steps(batch, 0):
        n, runs = resampling.word_runs(part, carried)
        words.update({rows.start + i: int(x) for i, x in enumerate(n)})
        found.update((rows.start + int(d), int(c)) for text, crc in runs for d, c in zip(text, crc))
    assert found == Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in features(t)[0])
    assert [words[i] for i in range(len(texts))] == [features(t)[1] for t in texts]


@pytest.mark.parametrize("sf", [SF, SF1])
def test_resampling_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    out = queries.QUERIES["op12_importance_resampling"](spark, sf)
    assert Counter(tuple(r) for r in out.collect()) == brute_resample(docs, items)


def test_resampling_ranks_in_ranges(spark, monkeypatch):
    """Ranges of a few rows, equal scores, and repeated and null ids."""
    monkeypatch.setattr(resampling, "RANK_ROWS", 7)
    monkeypatch.setattr(resampling, "MIN_WORDS", 20)
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(i // 2 if i % 3 else None, text if i % 2 else f"{text} {i}") for i in range(900)]
    rows += [(5, "few words"), (6, None), (None, "")]
    items = _docs(spark, [(1, "w1 w2 w3")]).select("text")
    assert _resampled(_docs(spark, rows), items) == brute_resample(rows, ["w1 w2 w3"])


def test_resampling_of_edge_rows(edge, nothing):
    rows = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    items = edge.select("text")
    assert _resampled(edge, items) == brute_resample(rows, [t for _, t in rows])
    assert _resampled(edge, nothing) == brute_resample(rows, [])
    assert resampling.resample(nothing, items).count() == 0


# --- fill in the middle ------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = UNIT.findall(text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, body, tail = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(head), len(body), f"<S>{tail}<P>{head}<M>{body}"
    return doc_id, n, "psm", len(head), len(body), f"<P>{head}<S>{tail}<M>{body}"


def _check_middles(docs):
    rows = docs.select("doc_id", "text").collect()
    made = fill_in_middle.fill_in_middle(docs)
    out = made.withColumn("back", fill_in_middle.restored()).collect()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter(tuple(r[c] for c in names) for r in out) == Counter(brute_middle(*r) for r in rows)
    assert Counter((r.doc_id, r.back) for r in out) == Counter((r.doc_id, r.text or "") for r in rows)
    return Counter(r.form for r in out)


def test_middles_equal_brute_force(spark):
    """Also texts that hold markers or parts of them at the cuts."""
    draw = random.Random(5)
    bits = ["<", "P>", "<S", "S>", "<M", ">", " ", "\n", "\x0b", "\x1c", " ", "\xa0", "a", "ünï", "😀", "<P", "word "]
    texts = ["".join(draw.choices(bits, k=draw.randrange(12))) for _ in range(600)]
    texts += ["<P> x y z", "a <S>", "<M>", " ", "\t\n", "<<S>>"]
    forms = _check_middles(_docs(spark, list(enumerate(texts))))
    assert forms["plain"] and forms["spm"] > forms["psm"] > 0


def test_middles_of_edge_rows(edge, nothing):
    _check_middles(edge)
    assert fill_in_middle.fill_in_middle(nothing).count() == 0


def test_long_texts_are_matched_in_parts():
    draw = random.Random(9)
    for _ in range(50):
        text = "".join(draw.choices([" ", "  ", "ab", "c", "\n"], k=400))
        ends = [m.end() for m in UNIT.finditer(text)]
        for part in (1, 7, 50):
            assert [e for some in fill_in_middle.unit_ends(text, part) for e in some] == ends
            draws = (draw.randrange(1 << 32), draw.randrange(1 << 32))
            assert fill_in_middle.cuts(text, draws, part) == fill_in_middle.cuts(text, draws, 1 << 30)


def test_rates(spark):
    docs = _docs(spark, [(i, "a b c d") for i in range(400)])
    assert set(fill_in_middle.fill_in_middle(docs, rate=0).toPandas()["form"]) == {"plain"}
    assert set(fill_in_middle.fill_in_middle(docs, rate=100, spm_rate=0).toPandas()["form"]) == {"psm"}
    assert set(fill_in_middle.fill_in_middle(docs, rate=100, spm_rate=100).toPandas()["form"]) == {"spm"}
