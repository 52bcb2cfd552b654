"""Language proportions of a document by expectation-maximisation.

A language is a distribution over hashed byte trigrams of lower-cased words. The
words of a document are taken as drawn from a mixture of languages; EM estimates
the proportions, and the languages that stay are chosen by penalised likelihood
(BIC): another language must raise the log-likelihood by half the log of the
number of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tallychain.llm.tables import STEP_BYTES, each_text, fresh, pieces

UNKNOWN = "und"
#: Trigram buckets of a language.
BUCKETS = 1 << 16
#: Labelled documents to learn from, for each language, at most (in expectation).
SAMPLE_DOCS = 4000
#: Languages learned at most, those with most labelled documents; bounds the model to 32 MiB.
MAX_LANGUAGES = 128
#: A document of which no language holds this share has no language of its own.
LEAST_SHARE = 1 / 3
#: Added to each bucket's count.
SMOOTHING = 0.05
ROUNDS = 12
SEED = 6
#: Numbers (bytes times languages) scored at a time.
STEP = 1 << 22

_WORD = re.compile(r"[^\W\d_]+")


def letters_only(text: str | None) -> bytes:
    """Words of letters, lower-cased, one space around each; empty without letters."""
    words = _WORD.findall(text.lower()) if text else []
    return (" " + " ".join(words) + " ").encode() if words else b""


def trigrams(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram at each byte, whether it lies within a word and its borders)."""
    a, b, c = (buffer[i : len(buffer) - 2 + i].astype(np.uint32) for i in range(3))
    mixed = (a | b << 8 | c << 16) * np.uint32(2654435761)
    return (mixed >> np.uint32(16)).astype(np.int32), b != 32


@dataclass(frozen=True)
class Model:
    """Log-likelihoods: a row for each bucket, a column for each language."""

    languages: list[str]
    scores: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE_DOCS, languages: int = MAX_LANGUAGES) -> Model:
    """Count trigrams of labelled documents that are not held out.

    Documents without id, text or lang teach nothing. Of more than ``languages``
    labels those with most documents are learned, ties by name, so that a column
    full of stray labels can't swell the model: one number for each language and
    bucket, which is all that reaches the driver.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(
        "doc_id is not null and text is not null and lang is not null"
    ).filter(~held_out(F.col("doc_id")))
    largest = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    sizes = {r[0]: r[1] for r in largest.collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), dtype=np.float32))
    share = F.element_at(
        F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))]), F.col("lang")
    )
    # A label that is not learned has no share, and no lot is below it.
    lot = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 40)) / F.lit(1 << 40)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(each_text(batch.column(0)), batch.column(1).to_pylist()):
                buffer = np.frombuffer(letters_only((text or b"").decode()), np.uint8)
                if len(buffer):
                    bucket, inside = trigrams(buffer)
                    found = np.bincount(bucket[inside], minlength=BUCKETS)
                    counts[lang] = counts[lang] + found if lang in counts else found
        for lang, found in counts.items():
            used = np.flatnonzero(found)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(used), pa.string()),
                    "bucket": pa.array(used.astype(np.int32)),
                    "n": pa.array(found[used].astype(np.int64)),
                }
            )

    counted = (
        labelled.filter(lot < share)
        .select("text", "lang")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    labels = counted.column("lang").combine_chunks().dictionary_encode()
    names = sorted(labels.dictionary.to_pylist())
    place = {x: i for i, x in enumerate(names)}
    column = np.array([place[x] for x in labels.dictionary.to_pylist()], dtype=np.int64)[labels.indices.to_numpy()]
    totals = np.full((BUCKETS, len(names)), SMOOTHING)
    np.add.at(totals, (counted.column("bucket").to_numpy(), column), counted.column("n").to_numpy())
    return Model(names, np.log(totals / totals.sum(axis=0)).astype(np.float32))


def _word_scores(buffer: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word in each language; long buffers go in steps."""
    space = buffer == 32
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    out = np.empty((len(starts), scores.shape[1]), dtype=np.float64)
    step = max(1, STEP // max(1, scores.shape[1]))
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
        stop = starts[end] + 2 if end < len(starts) else len(buffer)
        bucket, inside = trigrams(buffer[starts[at] : stop])
        value = np.where(inside[:, None], scores[bucket], np.float32(0))
        out[at:end] = np.add.reduceat(value, starts[at:end] - starts[at], axis=0, dtype=np.float64)
        at = end
    return out


def _mix(like: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents at once: (proportions, log-likelihoods)."""
    sizes = np.diff(np.append(starts, len(like)))
    for _ in range(ROUNDS):
        part = like * np.repeat(weights, sizes, axis=0)
        part /= part.sum(axis=1, keepdims=True)
        weights = np.add.reduceat(part, starts, axis=0) / sizes[:, None]
    total = (like * np.repeat(weights, sizes, axis=0)).sum(axis=1)
    return weights, np.add.reduceat(np.log(total), starts)


def proportions(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Proportions of the chosen languages for each document.

    ``words``: log-likelihoods of all words, ``starts``: the first word of each
    document.
    """
    n_lang = words.shape[1]
    sizes = np.diff(np.append(starts, len(words)))
    single = np.add.reduceat(words, starts, axis=0)
    best = single.argmax(axis=1)
    out = np.zeros((len(starts), n_lang))
    out[np.arange(len(starts)), best] = 1.0
    if n_lang == 1:
        return out
    top = words.max(axis=1)
    like = np.maximum(np.exp(words - top[:, None]), 1e-30)
    price = 0.5 * np.log(sizes)
    reached = single.max(axis=1) - np.add.reduceat(top, starts)
    full, limit = _mix(like, starts, np.full(out.shape, 1 / n_lang))
    # No set does better than all languages together, so most documents end here.
    open_ = limit - reached > price
    score = reached.copy()
    order = np.argsort(-full, axis=1, kind="stable")
    for k in range(2, n_lang + 1):
        docs = np.flatnonzero(open_)
        if not len(docs):
            break
        member = np.zeros((len(docs), n_lang), dtype=bool)
        np.put_along_axis(member, order[docs, :k], True, axis=1)
        weights = np.where(member, np.maximum(full[docs], 1e-9), 0.0)
        rows = np.repeat(open_, sizes)
        part = like[rows]
        begin = np.cumsum(sizes[docs]) - sizes[docs]
        found, value = _mix(part, begin, weights / weights.sum(axis=1, keepdims=True))
        value = value - price[docs] * (k - 1)
        better = value > score[docs]
        score[docs[better]] = value[better]
        out[docs[better]] = found[better]
        open_ = np.zeros(len(starts), dtype=bool)
        open_[docs] = limit[docs] - price[docs] * k > score[docs]
    return out


def language_udf(model: Model):
    """text -> (lang, share, languages): the main language, its share, and all chosen ones."""
    languages, scores = model.languages, model.scores
    # Likelihoods are words times languages.
    limit = STEP_BYTES * 8 // max(8, len(languages))

    @arrow_udf("struct<lang: string, share: double, languages: map<string, double>>")
    def identify(texts: pa.Array) -> pa.Array:
        lang, share, sets = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in range(len(texts))]
        for start, end in pieces(texts, limit) if languages else ():
            buffers = [letters_only(t) for t in texts.slice(start, end - start).to_pylist()]
            used = [i for i, b in enumerate(buffers) if b]
            if not used:
                continue
            whole = np.frombuffer(b"".join(buffers), np.uint8)
            words = _word_scores(whole, scores)
            counts = np.array([buffers[i].count(b" ") - 1 for i in used])
            found = proportions(words, np.cumsum(counts) - counts)
            for i, row in zip((start + i for i in used), found):
                main = int(row.argmax())
                lang[i], share[i] = languages[main], float(min(1.0, row[main]))
                sets[i] = [(languages[j], float(row[j])) for j in np.flatnonzero(row > 0)]
        return pa.StructArray.from_arrays(
            [
                pa.array(lang, pa.string()),
                pa.array(share, pa.float64()),
                pa.array(sets, pa.map_(pa.string(), pa.float64())),
            ],
            ["lang", "share", "languages"],
        )

    return identify


def identify_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) for every row.

    ``model`` is learned from ``docs`` unless given. lang_pred is ``und`` with
    score 0 if the text is null, has no letter, or no language was learned. A tie
    goes to the language first by name. Repeated rows get a row each; an empty
    table gives an empty result; other columns are ignored.
    """
    model = model or learn(docs)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), language_udf(model)("text").alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.share").alias("score"), "found.languages")


def keep_languages(
    docs: DataFrame,
    languages: list[str] | None = None,
    least_share: float = LEAST_SHARE,
    model: Model | None = None,
) -> DataFrame:
    """The rows of ``docs`` that are written in one of ``languages``, all columns kept.

    A row goes if its text is null or has no letter, if no language holds
    ``least_share`` of its words, or if the one that holds most is not among
    ``languages`` (all that were learned, if not given). Where no language was
    learned every row goes. Repeated rows stay as often as they come.
    """
    name = fresh(docs, "found")
    found = docs.withColumn(name, language_udf(model or learn(docs))("text"))
    lang, share = F.col(f"{name}.lang"), F.col(f"{name}.share")
    wanted = lang != UNKNOWN if languages is None else lang.isin(languages) & (lang != UNKNOWN)
    return found.filter(wanted & (share >= least_share)).select(docs.columns)
