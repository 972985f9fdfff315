"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms, letter case, homoglyphs of other
scripts, and digits and signs that stand for letters inside a word. A folded text
is its words with single spaces between. The lexicon's words are matched on
folded text in one pass; a hit inside an exception phrase does not count. The sum
of the hits' weights, and that sum by text length, give the score by a logistic
function.

``fit`` learns the lexicon from labels: the log odds of each folded word, kept
where the evidence is strong. It reads at most ``fit_rows`` labelled rows that are
not held out (in order of a hash of their id: a bounded sample, as documented);
held-out rows, lang, source and doc_id take no part. The model holds at most
``lexicon_size`` words, so broadcasting it is safe at any input size. Scoring
covers all rows and whole texts, without a shuffle.

Defined cases: a null text scores as the empty one, which scores as a text without
hits; labels that are null are left out; an id with differing labels counts as
toxic; without rows of both classes every text scores the same (the smoothed
share of toxic rows, below one half if there are none); repeated rows score alike;
further columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import give_back, in_slices, require, text_or_empty, written

FIT_ROWS = 20_000
LEXICON_SIZE = 5_000
LEAST_HITS = 3
LEAST_WEIGHT = 1.5
LEAST_EVIDENCE = 2.6  # standard errors of the log odds
# Phrases in which a listed word is harmless.
EXCEPTIONS = ("clown fish", "trash can", "trash bin", "class clown", "scum line", "sore loser board")

# Cyrillic and Greek letters that look like Latin ones, and what stands for letters in words.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ɑ": "a",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
_GLYPHS = str.maketrans(HOMOGLYPHS)
# A stand-in between letters, or before one at a word's start; signs at a word's end are punctuation.
_STANDS = regex.compile(r"(?<=[\p{L}\d@$!])[0134578@$!](?=\p{L})|(?<=\p{L})[0134578](?=[\d@$!]*(?:\p{L}|\b))|(?<![\p{L}\d@$!])[0134578@$](?=\p{L})")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_HIDDEN = regex.compile("[­​-‏⁠﻿]+")


def fold(text: str) -> str:
    """Folded words with single spaces between, and one at either end."""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    text = text.casefold().translate(_GLYPHS)
    text = _STANDS.sub(lambda m: SUBSTITUTES.get(m[0], m[0]), text)
    return " " + " ".join(_WORD.findall(text)) + " "


@dataclass(frozen=True)
class Model:
    """Word weights, exception phrases, and the logistic function's coefficients."""

    weights: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = EXCEPTIONS
    coefficients: tuple[float, float] = (0.0, 0.0)
    intercept: float = -1.0


@lru_cache(maxsize=4)
def matcher(weights: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    """The Aho-Corasick automaton of the lexicon and its exceptions (None if empty)."""
    found = ahocorasick.Automaton()
    for word, weight in weights:
        found.add_word(f" {word} ", (len(word) + 2, weight))
    for phrase in exceptions:
        key = fold(phrase)
        if key.strip():
            found.add_word(key, (len(key), None))
    if not len(found):
        return None
    found.make_automaton()
    return found


def features(text: str, model: Model) -> tuple[float, float]:
    """Of the summed hit weights: their size, and their size by text length."""
    automaton, folded = matcher(model.weights, model.exceptions), fold(text)
    if automaton is None:
        return 0.0, 0.0
    hits, excused = [], []
    for end, (length, weight) in automaton.iter(folded):
        if weight is None:
            excused.append((end - length, end))
        else:
            hits.append((end - length, end, weight))
    if excused:
        # The furthest end of the excused spans that start no later than each of them.
        excused.sort()
        starts, reach = [a for a, _ in excused], list(accumulate((b for _, b in excused), max))
        hits = [h for h in hits if not (at := bisect_right(starts, h[0])) or reach[at - 1] < h[1]]
    total, words = sum(h[2] for h in hits), folded.count(" ") - 1
    return math.log1p(total), math.log1p(100.0 * total / (words + 20))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 == 0


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic rows, clean rows), counted per task first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in in_slices(part["text"], part["toxic"]):
                counts[int(toxic)].update(set(fold(text).split()))
            words = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(words, pa.string()), *(pa.array([counts[k][w] for w in words], pa.int64()) for k in (1, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "t", "n"])
        part = counts = words = columns = None
        give_back()

    counted = rows.mapInArrow(count, "word string, t long, n long")
    return counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    lexicon_size: int = LEXICON_SIZE,
    exceptions: Sequence[str] = EXCEPTIONS,
) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    require(docs, ("doc_id", "text"))
    require(labels, ("doc_id", "toxic"))
    listed = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # At most fit_rows pairs of numbers; where an id repeats in docs, one of its texts.
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(listed), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    rows = written(rows.select("text", "toxic"), "toxicity-rows")
    toxic, clean = rows.agg(F.sum(F.col("toxic")), F.sum(1 - F.col("toxic"))).first()
    toxic, clean = toxic or 0, clean or 0
    if not toxic or not clean:
        rate = (toxic + 0.4) / (toxic + clean + 1.0)
        return Model(exceptions=tuple(exceptions), intercept=math.log(rate / (1 - rate)))
    t, n = F.col("t") + 0.5, F.col("n") + 0.5
    weight = F.log(t / (toxic + 1.0)) - F.log(n / (clean + 1.0))
    kept = (
        _word_counts(rows)
        .withColumn("weight", weight)
        .where(
            (F.col("t") >= LEAST_HITS)
            & (F.col("weight") >= LEAST_WEIGHT)
            & (F.col("weight") >= LEAST_EVIDENCE * F.sqrt(1 / t + 1 / n))
        )
        .orderBy(F.desc("weight"), "word")
        .limit(lexicon_size)
        .collect()  # at most lexicon_size words
    )
    lexicon = Model(tuple((r.word, float(r.weight)) for r in kept), tuple(exceptions))
    points = written(
        rows.select(_features(F.col("text"), lexicon).alias("x"), F.col("toxic").cast("double").alias("label")),
        "toxicity-points",
    )
    fitted = LogisticRegression(regParam=0.001, maxIter=50).fit(
        points.select(array_to_vector("x").alias("features"), "label")
    )
    a, b = (float(c) for c in fitted.coefficients)
    return Model(lexicon.weights, lexicon.exceptions, (a, b), float(fitted.intercept))


def _features(text: Column, model: Model) -> Column:
    held = _broadcast(model)

    @F.arrow_udf("array<double>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array([features(t, held.value) for (t,) in in_slices(texts)], pa.list_(pa.float64()))

    return run(F.coalesce(text, F.lit("")))


def _broadcast(model: Model):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(model)


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    held = _broadcast(model)

    @F.arrow_udf("double")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = held.value
        for texts in parts:
            out = []
            for (text,) in in_slices(texts):
                x = features(text, known)
                z = known.intercept + sum(c * v for c, v in zip(known.coefficients, x, strict=True))
                out.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.array(out, pa.float64())
        texts = None
        give_back()

    return run(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, **options)
    out = docs.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        score(F.col("text"), model).alias("score"),
    )
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
