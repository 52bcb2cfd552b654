"""Quality by weak supervision, in DataFrame operations.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over
the counts of vote patterns estimates how accurate each rule is and how many
documents are good; the posterior probability of good replaces a filter that every
rule must pass. There are at most 3^rules patterns, however many documents.

Nothing bounds the estimates. EM runs from several starts side by side and the most
likely outcome is taken. Which of the two classes is the good one is settled by one
assumption: on average over rules and classes, rules are right more often than not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallychain.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: EM ends when no estimate moves by more than this; rounds at most, should it not.
SETTLED, ROUNDS = 1e-4, 500
#: Where EM starts: share of good documents, accuracy of a rule on good and on bad ones.
STARTS = ((0.9, 0.98, 0.5), (0.5, 0.9, 0.6), (0.8, 0.95, 0.9), (0.2, 0.8, 0.8))
#: A rule counts as if it had voted on so many documents of each class, with these accuracies.
WEIGHT, ON_GOOD, ON_BAD = 2.0, 0.9, 0.6

#: (name, measure, good if, bad if); thresholds as in common web-text filters.
RULES = (
    ("length", "n_words", "n_words >= 100", "n_words < 50"),
    ("word_length", "word_chars / n_words", "word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("symbols", "n_symbols / n_words", "100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
    ("symbol_words", "n_symbol_words / n_words", "100 * n_symbol_words <= 5 * n_words", "100 * n_symbol_words > 25 * n_words"),
    ("letters", "n_letters / word_chars", "100 * n_letters >= 85 * word_chars", "100 * n_letters < 75 * word_chars"),
    ("lines", "n_dup_lines / n_lines", "10 * n_dup_lines <= n_lines and n_lines > 1", "10 * n_dup_lines > 3 * n_lines"),
    ("repetition", "n_repeat_words / n_words", "100 * n_repeat_words <= 20 * n_words", "100 * n_repeat_words > 50 * n_words"),
    ("capitals", "n_upper / word_chars", "100 * n_upper <= 15 * word_chars", "100 * n_upper > 40 * word_chars"),
    ("digits", "n_digits / word_chars", "100 * n_digits <= 10 * word_chars", "100 * n_digits > 30 * word_chars"),
)


def _windows(words: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    # get() is 0-based.
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )


def _sorted_places(windows: Column) -> Column:
    """(h, i) of all windows, equal ones side by side."""
    return F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(places: Column) -> Column:
    """Words under windows that have an equal neighbour in ``places``."""
    hit = F.filter(
        places,
        lambda x, k: F.coalesce(x["h"] == F.get(places, k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(places, k + 1)["h"], F.lit(False)),
    )
    return F.aggregate(
        F.sort_array(F.transform(hit, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )


def base_features(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_symbol_words,
    n_letters, n_upper, n_digits)."""
    text = F.coalesce("text", F.lit(""))

    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        lines.alias("lines"),
        F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D#*$%&|<>]*[#*$%&|<>][^\x20\x09-\x0D]*"))
        .cast("long")
        .alias("n_symbol_words"),
        F.char_length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")).cast("long").alias("n_letters"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[0-9]")).cast("long").alias("n_digits"),
    )
    hashed = parts.select(
        "*",
        F.when(F.size("words") >= 3, _windows(F.col("words")))
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # Only a text with a repeated window is sorted. The array of one element holds
    # its sorted windows, so that they are made once.
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    once = F.when(repeated, F.array(_sorted_places(F.col("windows"))))
    n_repeat = F.coalesce(F.get(F.transform(once, _covered), F.lit(0)), F.lit(0)).cast("long")
    return hashed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
        "n_symbol_words",
        "n_letters",
        "n_upper",
        "n_digits",
    )


def votes(features: DataFrame, rules=RULES) -> DataFrame:
    """``features`` with a vote of each rule; a document without words gets bad from the first rule only."""
    return features.withColumns(
        {
            f"vote_{name}": F.when(F.expr(f"({bad}) and (n_words > 0 or {i} = 0)"), F.lit(-1))
            .when(F.expr(f"({good}) and n_words > 0"), F.lit(1))
            .otherwise(F.lit(0))
            for i, (name, _, good, bad) in enumerate(rules)
        }
    )


def posterior(prior: float, accuracy: dict[str, tuple[float, float]]) -> Column:
    """Probability of good given the votes; an abstention says nothing."""
    log_odds = F.lit(math.log(prior / (1 - prior)))
    for name, (good, bad) in accuracy.items():
        log_odds = log_odds + (
            F.when(F.col(name) == 1, math.log(good / (1 - bad)))
            .when(F.col(name) == -1, math.log((1 - good) / bad))
            .otherwise(0.0)
        )
    return 1 / (1 + F.exp(-log_odds))


def _round(patterns: DataFrame, names: list[str], fits: list[tuple]) -> list:
    """The sums of one EM round for every start, by start: documents, good ones, log likelihood,
    and for each rule its right and all its votes on good and on bad documents."""
    rows = [(i, float(prior), [g for g, _ in acc], [b for _, b in acc]) for i, (prior, acc) in enumerate(fits)]
    # A row a start; the same plan in every round.
    given = patterns.sparkSession.createDataFrame(
        rows, "start int, prior double, on_good array<double>, on_bad array<double>"
    )
    good, bad = F.log("prior"), F.log(1 - F.col("prior"))
    for i, c in enumerate(names):
        g, b = F.get("on_good", F.lit(i)), F.get("on_bad", F.lit(i))
        good += F.when(F.col(c) == 1, F.log(g)).when(F.col(c) == -1, F.log(1 - g)).otherwise(0.0)
        bad += F.when(F.col(c) == 1, F.log(1 - b)).when(F.col(c) == -1, F.log(b)).otherwise(0.0)
    n, p = F.col("n"), F.col("p")
    top = F.greatest("good", "bad")
    sums = [F.sum(n), F.sum(p * n), F.sum(n * (top + F.log(F.exp(F.col("good") - top) + F.exp(F.col("bad") - top))))]
    for c in names:
        voted_good, voted = F.col(c) == 1, F.col(c) != 0
        sums += [
            F.sum(F.when(voted_good, p * n).otherwise(0.0)),
            F.sum(F.when(voted, p * n).otherwise(0.0)),
            F.sum(F.when(voted & ~voted_good, (1 - p) * n).otherwise(0.0)),
            F.sum(F.when(voted, (1 - p) * n).otherwise(0.0)),
        ]
    judged = (
        patterns.join(F.broadcast(given), "start")
        .withColumns({"good": good, "bad": bad})
        .withColumn("p", 1 / (1 + F.exp(F.col("bad") - F.col("good"))))
    )
    return judged.groupBy("start").agg(*sums).orderBy("start").collect()


def estimate(voted: DataFrame, rules=RULES) -> tuple[float, dict[str, tuple[float, float]]]:
    """(share of good documents, accuracies of each rule on good and on bad ones) by EM.

    A rule has two accuracies, as one that is nearly always right about good
    documents may miss most bad ones: its few bad votes then weigh much and its many
    good votes little. A round sums over vote patterns, for all ``STARTS`` at once;
    ``WEIGHT`` imagined votes keep a rule that never votes from an accuracy of 0 or 1.
    """
    names = [f"vote_{r[0]}" for r in rules]
    counted = voted.groupBy(*names).agg(F.count("*").alias("n"))
    starts = F.explode(F.array(*[F.lit(i) for i in range(len(STARTS))])).alias("start")
    patterns = stored(counted.select("*", starts), "quality-patterns").coalesce(1)
    fits = [(prior, [(g, b)] * len(names)) for prior, g, b in STARTS]
    likely = [0.0] * len(fits)
    for _ in range(ROUNDS):
        moved = 0.0
        for row in _round(patterns, names, fits):
            old_prior, old = fits[row[0]]
            prior = (row[2] + 1) / (row[1] + 2)
            fit = []
            for i in range(len(names)):
                right_good, good, right_bad, bad = row[4 + 4 * i : 8 + 4 * i]
                fit.append(
                    ((right_good + WEIGHT * ON_GOOD) / (good + WEIGHT), (right_bad + WEIGHT * ON_BAD) / (bad + WEIGHT))
                )
            moved = max(moved, abs(prior - old_prior), *(abs(x - y) for u, v in zip(fit, old) for x, y in zip(u, v)))
            fits[row[0]], likely[row[0]] = (prior, fit), row[3]
        if moved < SETTLED:
            break
    prior, fit = fits[max(range(len(fits)), key=lambda i: likely[i])]
    if sum(g + b for g, b in fit) < len(fit):  # the classes have changed places
        prior, fit = 1 - prior, [(1 - b, 1 - g) for g, b in fit]
    return prior, dict(zip(names, fit))


def judge_quality(docs: DataFrame, rules=RULES, keep_from: float = 0.5) -> DataFrame:
    """Base measures, votes, quality (posterior) and kept for every row of ``docs``.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words as measured;
    base_failed (under 50 words, or over half of the words in repeated three-word
    windows) is never kept, others if the posterior is at least ``keep_from``. A
    null or empty text has no words and fails. Repeated rows get a row each; an
    empty table gives an empty result; other columns are ignored.
    """
    voted = stored(votes(base_features(docs), rules), "quality-votes")
    prior, accuracy = estimate(voted, rules)
    quality = posterior(prior, accuracy)
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words")
    return voted.withColumn("base_failed", failed).withColumn("quality", quality).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep_from)
    )
