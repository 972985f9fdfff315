"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are the
same) of at least ``max(MIN_WORDS, MIN_REPEATS * q)`` words that neither neighbour
extends. Every word of a run occurs at least MIN_REPEATS times in it, so a word
that occurs less often in a segment lies in no run: it splits the segment. Parts
are split again by their own counts until nothing changes, and only the segments
that survive are scanned by lag.

The scan of one segment of ``m`` words looks, for each lag ``q`` up to
``m / MIN_REPEATS``, at every ``q``-th place only: a run holds two neighbouring
whole blocks of ``q`` places whose words equal those ``q`` further on, so blocks of
the largest power of two within ``q`` are compared by rank there, and words one by
one only around two neighbouring hits. That is about ``m log m`` steps in all.

Documents are independent: one pass over the rows without a shuffle. A task
holds the words of about CHUNK_BYTES of text at a time, or of one longer text.

Defined cases: a null or empty text has no words, no run, and an empty collapsed
text; a null doc_id is kept; repeated rows give repeated results; of an empty
table comes an empty table; columns beyond id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import require

MIN_WORDS = 6
MIN_REPEATS = 4
# Text of which the words are held at once.
CHUNK_BYTES = 8 << 20
# Places around a hit from which it pays to look whether a known run covers them.
WIDE = 4096

WORD = r"[^\x20\x09-\x0D]+"


def _stretched(place: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and size of each stretch of neighbouring places of one segment that can hold a run."""
    edge = np.flatnonzero((np.diff(place) != 1) | (np.diff(segment) != 0)) + 1
    first = np.concatenate(([0], edge)) if len(place) else np.empty(0, np.int64)
    size = np.diff(np.concatenate((first, [len(place)])))
    return first[size >= MIN_WORDS], size[size >= MIN_WORDS]


def surviving_segments(words: np.ndarray, owner: np.ndarray) -> list[tuple[int, int]]:
    """Segments ``(start, end)`` of ``words`` that rare words split no further.

    ``owner`` (not decreasing) says which text a word belongs to; no segment
    spans two. One round counts the words of all open segments at once.
    """
    place = np.arange(len(words))
    segment = owner.astype(np.int64)
    spread = int(words.max(initial=0)) + 1
    stable: list[tuple[int, int]] = []
    while len(place):
        _, which, count = np.unique(segment * spread + words[place], return_inverse=True, return_counts=True)
        rare = count[which] < MIN_REPEATS
        split = np.zeros(int(segment[-1]) + 1, bool)
        split[segment[rare]] = True
        settled = ~split[segment]
        first, size = _stretched(place[settled], segment[settled])
        start = place[settled][first]
        stable += zip(start.tolist(), (start + size).tolist())
        place, segment = place[~settled & ~rare], segment[~settled & ~rare]
        first, size = _stretched(place, segment)
        inside = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum()) if len(first) else first
        place, segment = place[inside], np.repeat(np.arange(len(first)), size)
    return sorted(stable)


def _stretches(equal: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """``(start, end)`` of the stretches of at least ``least`` true places."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    for start, end in zip(edge[::2], edge[1::2]):
        if end - start >= least:
            yield int(start), int(end)


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of one segment, by start, then period."""
    m = len(words)
    runs: dict[tuple[int, int], int] = {}
    known = np.empty((0, 3), np.int64)
    ranks, width = words, 1
    for lag in range(1, m // MIN_REPEATS + 1):
        if 2 * width <= lag:
            pairs = ranks[:-width].astype(np.int64) * (int(ranks.max()) + 1) + ranks[width:]
            ranks, width = np.unique(pairs, return_inverse=True)[1], 2 * width
        sampled = ranks[::lag]
        same = sampled[1:] == sampled[:-1]
        hits = np.flatnonzero(same[1:] & same[:-1])
        if not len(hits):
            continue
        cut = np.flatnonzero(np.diff(hits) > 1) + 1
        firsts, lasts = hits[np.concatenate(([0], cut))], hits[np.concatenate((cut - 1, [len(hits) - 1]))] + 1
        if len(firsts) > 8:
            windows = [(0, m - lag)]
        else:
            windows = [
                (max(0, (a - 1) * lag), min(m - lag, (b + 2) * lag))
                for a, b in zip(firsts.tolist(), lasts.tolist())
                if not ((b - a) * lag > WIDE and _covered(known, a * lag, (b + 1) * lag, lag))
            ]
        least = max(MIN_WORDS - lag, (MIN_REPEATS - 1) * lag)
        for low, high in windows:
            equal = words[low:high] == words[low + lag : high + lag]
            for start, end in _stretches(equal, least):
                span = (low + start, end - start + lag)
                if span not in runs:  # else it has a smaller period
                    runs[span] = lag
                    if span[1] > WIDE:
                        known = np.vstack((known, [[span[0], span[0] + span[1], lag]]))
    return sorted((start, length, period) for (start, length), period in runs.items())


def _covered(known: np.ndarray, low: int, high: int, lag: int) -> bool:
    """Whether a known run whose period divides ``lag`` holds all of ``[low, high)``."""
    return bool(np.any((known[:, 0] <= low) & (known[:, 1] >= high) & (lag % np.maximum(known[:, 2], 1) == 0)))


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of some texts, given as their words."""
    size = np.array([len(words) for words in texts], np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    flat = np.empty(int(size.sum()), object)
    flat[:] = [word for words in texts for word in words]
    ids = pd.factorize(flat)[0].astype(np.int64)
    offset = np.concatenate(([0], np.cumsum(size)))
    owner = np.repeat(np.arange(len(texts)), size)
    for start, end in surviving_segments(ids, owner):
        text = int(owner[start])
        shift = start - int(offset[text])
        found[text] += [(a + shift, length, period) for a, length, period in lag_scan(ids[start:end])]
    return found


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _chunks(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    chunk: list[list[bytes]] = []
    held = 0
    for text in texts:
        if chunk and held + len(text or b"") > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
        # On bytes, split() breaks at space and \x09-\x0D only, and never inside a character.
        chunk.append((text or b"").split())
        held += len(text or b"")
    if chunk:
        yield chunk


def _run_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        done = 0
        ids = batch.iloc[:, 0]
        for chunk in _chunks(batch.iloc[:, 1].tolist()):
            runs = runs_of(chunk)
            yield pd.DataFrame(
                {
                    "doc_id": ids.iloc[done : done + len(chunk)],
                    "runs": [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in runs],
                    "collapsed": [b" ".join(collapsed_words(w, r)) for w, r in zip(chunk, runs)],
                }
            )
            done += len(chunk)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, its ``runs`` (array of start, length, period; by start, then
    period) and its ``collapsed`` text: the words that no run holds after its first period."""
    require(docs, [id_col, text_col])
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = given.mapInPandas(
        _run_rows,
        f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary",
    )
    return found.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, in one document of ten (by a checksum of its id) made periodic from some word on.

    With ``h = crc32(id)`` and ``g = h / 10``, a text of ``n`` words is changed if
    ``h % 10 = 0``: word ``i >= a = g % n`` becomes word ``a + (i - a) % p`` with
    ``p = 1 + (n - a) / (3 + g % 8)``. A document without id or words stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.nullif(F.size("words"), F.lit(0)).cast("long")
    a = F.col("g") % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
    shifted = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
    )
    text = F.when(F.size("words") > 0, F.array_join(shifted, " ")).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def _digest(value: Column, name: str) -> Column:
    return F.sha2(value.cast("binary"), 256).alias(name)


def report(found: DataFrame) -> DataFrame:
    """Counts, the longest run (ties: smallest start, then period) and digests of ``periodic_runs``' rows."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("slow")))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.back")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.slow")).alias("period"),
        F.expr("(1000 * longest.length) div (-longest.slow)").alias("exponent_milli"),
        _digest(F.array_join(lines, ""), "runs_sha256"),
        _digest(F.col("collapsed"), "collapsed_sha256"),
    )


# The same by pairs of equal words of a document: stretches of pairs at one lag.
ORACLE = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT,
             list_transform(range(1, strlen(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::UBIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))::BIGINT AS h
  FROM documents),
sized AS (
  SELECT rid, doc_id, words, h, h // 10 AS g, coalesce(len(words), 0)::BIGINT AS n FROM hashed),
placed AS (
  SELECT rid, doc_id, words, n, g, h % 10 = 0 AND n > 0 AS chosen, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
texts AS (
  SELECT rid, doc_id, n, CASE WHEN chosen THEN
           list_transform(range(0, n), lambda i: words[(CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END) + 1])
           ELSE words END AS words
  FROM placed),
items AS MATERIALIZED (
  SELECT rid, n, unnest(range(0, n)) AS i, unnest(words) AS word FROM texts WHERE n > 0),
pairs AS (
  SELECT x.rid, x.i, y.i - x.i AS q FROM items x JOIN items y
  ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS part FROM pairs)
  GROUP BY rid, q, part HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (
  SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
per_doc AS (
  SELECT rid, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY rid),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length DESC, start, period) = 1),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS collapsed FROM items w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.rid = w.rid AND w.i >= r.start + r.period AND w.i < r.start + r.length)
  GROUP BY rid)
SELECT t.doc_id, coalesce(p.n_runs, 0) AS n_runs, b.start, b.length, b.period,
       (1000 * b.length) // b.period AS exponent_milli,
       sha256(coalesce(p.lines, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN per_doc p ON t.rid = p.rid LEFT JOIN best b ON t.rid = b.rid LEFT JOIN kept k ON t.rid = k.rid
"""
