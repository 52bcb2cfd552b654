"""Mixing, sharding and the pipeline."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallychain.llm import language_id, mixing, queries, sharding
from tallychain.llm.tables import stored, table
from tests.conftest import SF
from tests.llm.test_dedup import brute_components
from tests.llm.test_text import brute_hits, brute_language, brute_learn

SF1 = "/root/testdata/sf0.01"


def _sources(spark, tokens):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "stratum string, tokens long")


def _weights(tokens, t):
    raw = [(x / sum(tokens)) ** t for x in tokens]
    return [x / sum(raw) for x in raw]


def test_exponent_meets_an_entropy(spark):
    tokens = [5000, 900, 300, 20, 1]
    entropy = lambda t: -sum(w * math.log(w) for w in _weights(tokens, t))
    for target in (1.0, 1.3, 1.5):
        found = mixing.exponent(_sources(spark, tokens), target_entropy=target)
        assert entropy(found) == pytest.approx(target, abs=1e-6)
    assert mixing.exponent(_sources(spark, tokens), target_entropy=99.0) == 0
    assert mixing.exponent(_sources(spark, tokens), target_entropy=0.0) == 1
    assert mixing.exponent(_sources(spark, tokens)) == 1


def test_exponent_limits_repeats(spark):
    tokens = [5000, 900, 300, 20]
    found = mixing.exponent(_sources(spark, tokens), max_repeats=3.0)
    repeats = [w / t for w, t in zip(_weights(tokens, found), tokens)]
    assert max(repeats) / min(repeats) == pytest.approx(3, abs=1e-6)
    assert mixing.exponent(_sources(spark, tokens), max_repeats=1.0) == pytest.approx(1)
    assert mixing.exponent(_sources(spark, [5, 5]), max_repeats=1.0) == 0
    assert mixing.exponent(_sources(spark, tokens), 0.5, 3.0) >= found


@pytest.mark.parametrize("budget", [None, 100_000])
def test_quotas_are_met(spark, budget, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 1000)
    docs = table(spark, SF1, "documents")
    rows = mixing.mix(docs, max_repeats=2.0, budget=budget).select("doc_id", "source", "n_tokens", "epoch", "position").collect()
    tokens, most, taken = Counter(), Counter(), Counter()
    for r in docs.select("source", "text").collect():
        n = len(r.text.split()) + 1
        tokens[r.source] += n
        most[r.source] = max(most[r.source], n)
    for r in rows:
        taken[r.source] += r.n_tokens
    t = mixing.exponent(_sources(spark, list(tokens.values())), max_repeats=2.0)
    weights = dict(zip(tokens, _weights(list(tokens.values()), t)))
    spend = budget or max(tokens[s] / weights[s] for s in tokens)
    for s in tokens:
        quota = spend * weights[s]
        assert quota - most[s] - 1 <= taken[s] <= quota + 1, s
    copies = Counter((r.doc_id, r.epoch) for r in rows)
    assert set(copies.values()) == {1}
    if budget is None:
        assert {r.doc_id for r in rows if r.epoch == 0} == {r.doc_id for r in docs.collect()}
    # Any stretch of the positions has about the target mixture.
    assert all(0 <= r.position <= 1 for r in rows)
    if budget is None:
        half = sum(r.n_tokens for r in rows if r.position < 0.5)
        assert half == pytest.approx(0.5 * sum(taken.values()), rel=0.1)


def _taken(spark, rows, budget):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return mixing.mix(docs, max_repeats=None, budget=budget).collect()


def test_a_budget_is_met_with_equal_rows(spark):
    """2000 equal rows are a source of their own and half of another."""
    hot = [(1, "hot", "one two three four")] * 2000
    rows = hot + [(2, "half", "w " * 9)] * 500 + [(i, "half", "w " * 9) for i in range(500)] + [(3, "tiny", "x")]
    total = 2000 * 5 + 1000 * 10 + 2
    for budget in (0, 4, 3000, 9999, 25_000):
        got = _taken(spark, rows, budget)
        used, quota = Counter(), {"hot": 10_000 / total, "half": 10_000 / total, "tiny": 2 / total}
        for r in got:
            used[r.source] += r.n_tokens
        for s, longest in (("hot", 5), ("half", 10), ("tiny", 2)):
            assert quota[s] * budget - longest - 1 < used[s] <= quota[s] * budget, (s, budget)
        assert sum(used.values()) <= budget


def test_the_cut_is_the_same_as_in_order(spark):
    """Nested ranges find the key that a sort of all rows would."""
    docs = table(spark, SF1, "documents").select("doc_id", "source", "text")
    out = mixing.mix(docs, max_repeats=2.0, budget=150_000).where("source is not null")
    last = {r.source: r.e for r in out.groupBy("source").agg(F.max("epoch").alias("e")).collect()}
    for source, e in last.items():
        places = [(r.position, r.doc_id) for r in out.where((F.col("source") == source) & (F.col("epoch") == e)).collect()]
        assert max(p for p, _ in places) <= 1 and len(set(places)) == len(places)


def test_blocks_are_permuted_in_each_pass(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 50)
    rows = [(i, "a", f"t{i} " * 4) for i in range(400)] + [(i, "b", "long " * 900) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(docs, target_entropy=math.log(2), max_repeats=None).where("source = 'a'").collect()
    orders = defaultdict(list)
    for r in sorted(out, key=lambda r: r.position):
        at = orders[r.epoch]
        if not at or at[-1] != r.block:
            at.append(r.block)
    whole = [o for e, o in orders.items() if e < max(orders)]
    assert len(whole) >= 2 and whole[0] != whole[1]
    for blocks in whole:
        # Each block is a run of its own.
        assert len(blocks) == len(set(blocks)) and len(blocks) > 16
    assert {r.doc_id for r in out if r.epoch == 0} == set(range(400))


def test_mix_of_edge_rows(edge, nothing):
    out = mixing.mix(edge, max_repeats=2.0)
    assert out.columns[: len(edge.columns)] == edge.columns and len(set(out.columns)) == len(edge.columns) + 4
    once = Counter((r.doc_id, r.text) for r in out.filter("epoch_ = 0").collect())
    assert once == Counter((r.doc_id, r.text) for r in edge.collect())
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(edge, budget=0).count() == 0


# Sharding


def _check_shards(rows, docs, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert sum(map(len, by.values())) == len(docs)
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


@pytest.mark.parametrize("range_rows", [7, 4096])
def test_shards_hold_the_mixture(spark, range_rows, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", range_rows)
    docs = table(spark, SF1, "documents").withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    rows = sharding.shard_rows(docs).collect()
    _check_shards(rows, [(r.doc_id, r.text) for r in docs.collect()], 8)
    whole, own = Counter(r.source for r in rows), Counter((r.source, r.shard) for r in rows)
    # A cut moves by at most a row of each source from the same fraction of all.
    slack = {s: 1.5 + whole[s] * len(whole) / len(rows) for s in whole}
    assert all(abs(own[s, k] - whole[s] / 8) <= slack[s] for s in whole for k in range(8))
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    again = sharding.shard_rows(docs.repartition(5, "text")).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in rows)


def test_sources_of_one_row_spread_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGE_ROWS", 50)
    rows = [(i, f"text {i}", "large" if i % 2 else f"own {i}") for i in range(1600)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    _check_shards(got, [r[:2] for r in rows], 8)
    large = Counter(r.shard for r in got if r.source == "large")
    assert all(abs(large[k] - 100) <= 35 for k in range(8))


@pytest.mark.parametrize("shards", [1, 5, 40])
def test_shards_of_edge_rows(edge, nothing, shards):
    rows = sharding.shard_rows(edge, shards).collect()
    _check_shards(rows, [(r.doc_id, r.text) for r in edge.collect()], shards)
    assert sharding.shard_rows(nothing, shards).count() == 0


# Pipeline


def test_pipeline_matches_brute_force(spark):
    """Which rows pass each stage, from plain Python; then what the last stage makes of them."""
    docs = table(spark, SF, "documents")
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "simhash_near_dedup", "decontamination", "source_mixing", "sharding"]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == table(spark, SF, "documents").columns
        kept.append([tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    given = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "source").collect()]
    model = brute_learn([tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "lang").collect()])
    own = [r for r in given if brute_language(model, r[1])[1] >= language_id.LEAST_SHARE]
    assert sorted(kept[0]) == sorted(own)
    leads = {c for _, _, c in brute_components([r[:2] for r in own])}
    assert sorted(kept[1]) == sorted(r for r in own if r[0] in leads)
    clean = {d for d, _, n, _ in brute_hits([r[:2] for r in kept[1]], items) if not n}
    assert sorted(kept[2]) == sorted(r for r in kept[1] if r[0] in clean)
    assert set(kept[3]) == set(kept[2])
    last = corpus_pipeline.run(spark, SF).collect()
    _check_shards(last, [r[:2] for r in kept[3]], 8)


def test_registered_once():
    names = list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(queries.SQL) <= set(names)
