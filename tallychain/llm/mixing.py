"""Mixing sources by temperature, in DataFrame operations.

A source with share p of the tokens gets the weight p^t, normalised. The exponent t
is bisected to meet a target entropy of the weights or a limit on how often a source
is repeated; a pass over the per-source totals tries many exponents at once, which
is several bisection steps in one job. Weights become quotas of a token budget, and
quotas become passes over each source: blocks of its documents in a new permutation
for each pass, the last one cut where the quota ends. What a row needs to know of this is
one line for its source, so texts are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallychain.llm.tables import fresh, row_hash, stored

SEED = 20240301
MAX_REPEATS = 2.0
#: Tokens a block is meant to hold. A source of more than 2^44 tokens has larger ones: nothing
#: is ever held or ordered by block.
BLOCK_TOKENS = 1 << 20
MAX_BLOCK_BITS = 24
#: Exponents tried in a pass (63 inside the bracket: six bisections) and passes.
GRID = 63
PASSES = 7


def token_count():
    """Words (runs of characters that are not white space) and one end mark."""
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def _measures(sources: DataFrame, exponents: list[float]) -> list:
    """(exponent, entropy of the weights, most repeats), ascending by exponent.

    ``sources``: a row for each source, column tokens. Repeats are relative to the
    source that is repeated least.
    """
    total, least, most = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    share = F.log(F.col("tokens") / F.lit(total))
    powers = F.explode(F.array(*[F.lit(float(e)) for e in exponents])).alias("t")
    rows = (
        sources.select(share.alias("p"), powers)
        .groupBy("t")
        .agg(F.sum(F.exp(F.col("t") * F.col("p"))).alias("z"), F.sum(F.exp(F.col("t") * F.col("p")) * F.col("t") * F.col("p")).alias("s"))
        .orderBy("t")
        .collect()
    )
    spread = math.log(most / least)
    return [(r["t"], math.log(r["z"]) - r["s"] / r["z"], math.exp((1 - r["t"]) * spread)) for r in rows]


def _bisect(sources: DataFrame, enough) -> float:
    """The least exponent in [0, 1] for which ``enough`` holds, which it does from there on."""
    low, high = 0.0, 1.0
    if enough(_measures(sources, [0.0])[0]):
        return 0.0
    for _ in range(PASSES):
        step = (high - low) / (GRID + 1)
        for row in _measures(sources, [low + step * i for i in range(1, GRID + 1)]):
            if enough(row):
                high = row[0]
                break
            low = row[0]
    return high


def exponent(
    sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None
) -> float:
    """The exponent for ``sources`` (a row for each, column tokens > 0).

    With ``target_entropy`` (nats): the entropy falls as the exponent grows, and the
    exponent at which it has come down to the target is taken, within 0 and 1. With
    ``max_repeats``: no smaller exponent than one that repeats no source more often
    than that, relative to the one repeated least. Without either: 1.
    """
    found = [1.0] if target_entropy is None and max_repeats is None else [0.0]
    if target_entropy is not None:
        found.append(_bisect(sources, lambda r: r[1] <= target_entropy))
    if max_repeats is not None:
        found.append(_bisect(sources, lambda r: r[2] <= max_repeats))
    return max(found)


#: Bits of the place of a row in a pass, and how many of them a step of the search settles.
KEY_BITS, STEP_BITS = 60, 12


def _key(seed: int) -> str:
    """The place of a row in a pass: the place of its block there, then a hash of its own.

    Takes columns lot, e, mix_s and mix_bits. Blocks are permuted anew for every pass, by a
    permutation of 0 .. 2^bits - 1 that each row can work out for itself.
    """
    size = "shiftleft(1L, mix_bits)"
    draw = [f"pmod(xxhash64({seed + i}L, mix_s, mix_e), {size})" for i in range(3)]
    block = f"pmod(mix_lot, {size})"
    place = f"pmod(({block} ^ {draw[0]}) * ({draw[1]} | 1L) + {draw[2]}, {size})"
    own = f"shiftrightunsigned(xxhash64(mix_lot, mix_e), {64 - KEY_BITS})"
    return f"shiftleft({place}, {KEY_BITS} - mix_bits) + shiftright({own}, mix_bits)"


def mix(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    budget: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` as often as their source's quota asks, all columns kept.

    Added columns (with ``_`` appended if taken): n_tokens, epoch (pass over the
    source, from 0), block, and position (0 to 1: rows sorted by it are mixed in the
    target weights throughout). Tokens are words and one end mark a document. Without
    ``budget`` (tokens) it is the least that uses every document once. No source gets
    more than its quota, and less by no more than the document that did not fit any
    more; of equal rows, as many as fit. Rows that differ in map columns alone are
    equal. Null sources are one source; null and empty texts have one token, the end
    mark. An empty table gives an empty result.
    """
    n = {c: fresh(docs, c) for c in ("n_tokens", "epoch", "block", "position")}
    stratum = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    slim = stored(
        docs.select(stratum.alias("mix_s"), row_hash(docs, seed).alias("mix_lot"), token_count().alias("mix_tokens")),
        "mix-rows",
    )
    plan = _plan(slim, target_entropy, max_repeats, budget, seed)
    # Sources are few rows; a source that holds a third of all rows can be split, as its plan is one row.
    passes = "sequence(0L, CASE WHEN mix_left > 0 THEN mix_full ELSE mix_full - 1 END)"
    rows = (
        docs.select(F.struct("*").alias("mix_row"), stratum.alias("mix_s"), row_hash(docs, seed).alias("mix_lot"),
                    token_count().alias("mix_tokens"))
        .join(plan, "mix_s")
        .select("*", F.explode(F.expr(passes)).alias("mix_e"))
        .withColumn("mix_key", F.expr(_key(seed)))
    )
    taken = rows.where("mix_e < mix_full OR mix_key < mix_cut").withColumn(
        "mix_at",
        F.expr(f"""(mix_e * mix_whole + CASE WHEN mix_e < mix_full THEN mix_key / {1 << KEY_BITS}D * mix_whole
                ELSE mix_key / CAST(mix_cut AS DOUBLE) * mix_left END) / mix_quota"""),
    )
    # Equal rows at the cut: one of them stands for as many as fit.
    equal = (
        rows.where("mix_e = mix_full AND mix_key = mix_cut AND mix_copies > 0")
        .groupBy("mix_s", "mix_e")
        .agg(*[F.any_value(c).alias(c) for c in ("mix_row", "mix_lot", "mix_tokens", "mix_bits", "mix_copies")])
        .withColumn("mix_copy", F.explode(F.expr("sequence(1L, mix_copies)")))
        .withColumn("mix_at", F.lit(1.0))
    )
    columns = ["mix_row", "mix_lot", "mix_tokens", "mix_bits", "mix_e", "mix_at"]
    return taken.select(columns).unionByName(equal.select(columns)).select(
        *[F.col(f"mix_row.`{c}`") for c in docs.columns],
        F.col("mix_tokens").alias(n["n_tokens"]),
        F.col("mix_e").alias(n["epoch"]),
        F.expr("pmod(mix_lot, shiftleft(1L, mix_bits))").alias(n["block"]),
        F.col("mix_at").alias(n["position"]),
    )


def _plan(slim, target_entropy, max_repeats, budget, seed) -> DataFrame:
    """A row for each source that is used, stored: its tokens and quota, bits of its block numbers,
    how many passes are whole, what is left for the last one, the key that one ends before, and how
    many equal rows at that key still fit."""
    sources = stored(slim.groupBy("mix_s").agg(F.sum("mix_tokens").alias("tokens")), "mix-sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    power = 1.0 if sources.isEmpty() else exponent(sources, target_entropy, max_repeats)
    weighed = sources.withColumn("weight", F.pow(F.col("tokens") / F.lit(total), F.lit(power)))
    z, spend = weighed.agg(
        F.sum("weight"), F.max(F.col("tokens") / F.col("weight")) * F.sum("weight")
    ).first()
    quota = F.col("weight") / F.lit(z or 1.0) * F.lit(float(spend or 0 if budget is None else budget))
    # A document more or less is no matter where all are to be used; a budget is not exceeded.
    quota = F.greatest(F.round(quota), F.col("tokens").cast("double")) if budget is None else F.floor(quota)
    bits = F.least(F.lit(MAX_BLOCK_BITS), F.ceil(F.log2(F.greatest(F.col("tokens") / F.lit(BLOCK_TOKENS), F.lit(1.0)))))
    quotas = stored(
        weighed.select(
            "mix_s", F.col("tokens").alias("mix_whole"), quota.cast("long").alias("mix_quota"), bits.cast("int").alias("mix_bits")
        )
        .filter("mix_quota > 0")
        .selectExpr("*", "mix_quota div mix_whole AS mix_full", "mix_quota % mix_whole AS mix_left"),
        "mix-quotas",
    )
    cuts = _cuts(slim, quotas, seed)
    return stored(
        quotas.join(cuts, "mix_s", "left").selectExpr("*", "mix_rest div mix_one AS mix_copies").drop("mix_rest", "mix_one"),
        "mix-plan",
    )


def _cuts(slim: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """(mix_s, mix_cut, mix_rest, mix_one): where the last pass of each source ends.

    The tokens before mix_cut are within the quota, those up to and with it are not;
    mix_rest is what is left there and mix_one the tokens of a row at it. Found by nested
    ranges of keys: a step sums up 2^``STEP_BITS`` ranges of each source and goes on in the
    one the quota ends in, so that no task orders the rows of a source, however many.
    """
    last = quotas.where("mix_left > 0").selectExpr("mix_s", "mix_bits", "mix_full AS mix_e", "mix_left")
    keys = stored(
        slim.join(last, "mix_s").selectExpr("mix_s", f"{_key(seed)} AS key", "mix_tokens"), "mix-keys"
    )
    found = last.selectExpr("mix_s", "0L AS low", "mix_left AS rest")
    for shift in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        ranges = (
            keys.join(found, "mix_s")
            .where(f"key >= low AND key - low < {1 << (shift + STEP_BITS)}L")
            .withColumn("range", F.expr(f"shiftright(key - low, {shift})"))
            .groupBy("mix_s", "low", "rest", "range")
            .agg(F.sum("mix_tokens").alias("tokens"), F.min("mix_tokens").alias("one"))
        )
        # At most 2^STEP_BITS rows of a source reach this window.
        upto = F.sum("tokens").over(Window.partitionBy("mix_s").orderBy("range"))
        ends = ranges.withColumn("upto", upto).where("upto > rest AND upto - tokens <= rest")
        found = stored(
            ends.selectExpr(
                "mix_s", f"low + shiftleft(range, {shift}) AS low", "rest - (upto - tokens) AS rest", "one"
            ),
            "mix-cut",
        )
    return found.selectExpr("mix_s", "low AS mix_cut", "rest AS mix_rest", "one AS mix_one")
