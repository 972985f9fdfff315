"""Token counts by a two-tier lookup in the task that reads the text.

A text is split into pre-tokens; its count is the sum of their lengths in tokens.
Tier one is a table of frequent pre-tokens, compact (sorted 64-bit hashes and one
byte each) and broadcast; it is made from a bounded sample of documents and holds
at most ``TABLE`` entries, so its size is bounded by a parameter. It only saves
work: what it lacks, tier two encodes with the tokenizer and keeps in a bounded
cache of the worker. Pre-tokens of the sample with one hash are left out of it
(that another one has the hash of an entry has a chance of 1e-15 a distinct
pre-token). Pre-tokens are never shuffled, and every text is counted whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings in
a text count as the library counts them; repeated rows give repeated results; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.bpe_automaton import Splitter, default_path
from emporia.llm.common import require, text_or_empty

SAMPLE_DOCS = 1024
# Longer documents are not in the sample, so that it fits the driver (64 MB at most).
SAMPLE_BYTES = 1 << 16
TABLE = 1 << 14
CACHE = 1 << 17
WORD_KEPT = 64


@lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    # A task has one core: the library's own threads would only spin beside it.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Splitter(path)


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


class Counts:
    """Tier one and two of a worker."""

    def __init__(self, path: str, hashes: np.ndarray, lengths: np.ndarray) -> None:
        self.split, self.hashes, self.lengths = splitter(path), hashes, lengths
        self.cache: dict[str, int] = {}

    def frequent(self, words: list[str]) -> list[int]:
        """Lengths by the broadcast table, 0 where it lacks a word."""
        if not len(self.hashes):
            return [0] * len(words)
        h = np.fromiter(map(_hash, words), np.uint64, len(words))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.lengths[at], 0).tolist()

    def words(self, words: list[str]) -> int:
        counted, known = Counter(words), self.cache.get
        total, new = 0, []
        for word, times in counted.items():
            n = known(word)
            if n is None:
                new.append(word)
            else:
                total += n * times
        misses = []
        for word, n in zip(new, self.frequent(new), strict=True):
            # Longer words were not counted for the table.
            if n and len(word) <= WORD_KEPT:
                self._keep(word, n)
                total += n * counted[word]
            else:
                misses.append(word)
        if misses:
            coded = self.split.tokenizer.encode_batch_fast(misses, add_special_tokens=False)
            for word, code in zip(misses, coded, strict=True):
                n = len(code)
                self._keep(word, n)
                total += n * counted[word]
        return total

    def _keep(self, word: str, n: int) -> None:
        if len(word) <= WORD_KEPT:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = n

    def text(self, text: str) -> int:
        n = 0
        for part in self.split.parts(text):
            n += 1 if part in self.split.special else self.words(self.split.words(part))
        return n


def frequent_lengths(docs: DataFrame, path: str, sample_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` most frequent short pre-tokens of ``sample_docs`` documents of at most
    SAMPLE_BYTES: sorted hashes, and lengths in tokens.

    The sample is taken, not dealt: Spark reads partitions until it has that many rows.
    """
    text = text_or_empty()
    sample = docs.select(text.alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES).take(sample_docs)
    split, found = splitter(path), Counter()
    for row in sample:
        for part in split.parts(row.text):
            if part not in split.special:
                found.update(w for w in split.words(part) if len(w) <= WORD_KEPT)
    listed = sorted(found, key=lambda w: (-found[w], w))[:size]
    coded = split.tokenizer.encode_batch(listed, add_special_tokens=False)
    known: dict[int, list[int]] = {}
    for word, code in zip(listed, coded, strict=True):
        known.setdefault(_hash(word), []).append(len(code.ids))
    # Two words with one hash are left out, lengths fit a byte.
    single = {h: n[0] for h, n in known.items() if len(n) == 1 and n[0] < 256}
    hashes = np.array(sorted(single), dtype=np.uint64)
    return hashes, np.array([single[h] for h in hashes.tolist()], dtype=np.uint8)


def token_counts(
    docs: DataFrame,
    limit: int = 512,
    path: str | None = None,
    sample_docs: int = SAMPLE_DOCS,
    table_size: int = TABLE,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit."""
    require(docs, ("doc_id", "text"))
    where = path or default_path()
    known = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, where, sample_docs, table_size))

    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = Counts(where, *known.value)
        for texts in parts:
            yield pd.Series([counts.text(t) for t in texts], dtype="int64")

    text = text_or_empty()
    return docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), run(text).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
