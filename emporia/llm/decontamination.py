"""Benchmark decontamination by winnowed fingerprints.

A window is WINDOW consecutive words of a benchmark item; an item with fewer
words is one window itself. A document word is hit if it lies in any occurrence
of any window.

Fingerprints: of a window of ``m`` words the smallest hash of its ``k``-word grams
is kept, with ``w = m // 2 + 1`` grams of ``k = m - w + 1`` words in it. Two texts that
share ``m`` words in a row share the windows within, so they keep the same
fingerprint there: no shared span of WINDOW words is missed.

1. The benchmark's fingerprints become a bit table (two bits each) of at most
   MAX_BITS bits, the only thing that is broadcast.
2. One pass over the documents keeps each position whose gram is the smallest of
   a window and meets the bit table, and extends such a hit to the windows that
   kept it. A document without one is done there. A written table holds the result.
3. The windows found are joined with the benchmark's windows on a 128-bit digest
   of their words; chance hits of the bit table end here. A passage that a third
   of the documents hold is one row on the benchmark's side, so AQE can split it.
4. Per document the matched windows are merged to hit words. Documents whose
   windows belong to the same classes of items share one item list, made once.

A full bit table lets more positions pass to the join; results do not change.

Defined cases: a null or empty text has no words, an item without words no
window; rows with one item_id (null ids too, written as empty text) are one item;
repeated documents give repeated rows; an empty table of documents gives an empty
table, an empty benchmark hits nothing; columns beyond id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import require, written

WINDOW = 10
# Bits of the table per fingerprint, and its size in bits (16 MB at most).
BITS_EACH = 64
MIN_BITS = 1 << 20
MAX_BITS = 1 << 27
# Text of which the words are held at once.
CHUNK_BYTES = 8 << 20

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Bytes to themselves in lower case, those outside words to a space.
FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
# Odd multipliers that mix 64-bit hashes.
GRAM_FACTOR = 0x9E3779B97F4A7C15
MIX_A = 0xBF58476D1CE4E5B9
MIX_B = 0x94D049BB133111EB


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash a word; each distinct word is hashed once."""
    flat = np.empty(len(words), object)
    flat[:] = words
    ids, distinct = pd.factorize(flat)
    return np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)[ids]


def fingerprints(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` words: place of the gram it keeps, and that gram's hash.

    Of equal smallest hashes the last place is kept.
    """
    grams_in = length // 2 + 1
    k = length - grams_in + 1
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    gram = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        gram = gram * np.uint64(GRAM_FACTOR) + hashes[j : j + len(gram)]
    gram = _mixed(gram + np.uint64(length))
    best, place = gram[:n].copy(), np.arange(n)
    for j in range(1, grams_in):
        other = gram[j : j + n]
        better = other <= best
        best = np.where(better, other, best)
        place = np.where(better, np.arange(j, j + n), place)
    return place, best


def _bits(prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return (prints & mask).astype(np.int64), ((prints >> np.uint64(32)) & mask).astype(np.int64)


class BitTable:
    """Which fingerprints may be in the benchmark."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def has(self, prints: np.ndarray) -> np.ndarray:
        first, second = (
            self.cells[b >> 3] >> (b & 7).astype(np.uint8) & 1 for b in _bits(prints, 8 * len(self.cells))
        )
        return (first & second).astype(bool)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def _item_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each window of each item: digest, number of words, fingerprint."""
    for batch in batches:
        rows: list[tuple] = []
        for item, text in zip(batch["item_id"], batch["text"]):
            words = words_of(text)
            m = min(WINDOW, len(words))
            if m:
                prints = fingerprints(word_hashes(words), m)[1].view(np.int64).tolist()
                rows += [(item, _digest(words[i : i + m]), m, p) for i, p in enumerate(prints)]
        yield pd.DataFrame(rows, columns=["item_id", "window", "words", "print"])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Written table of each item's windows: ``item_id`` (as text), ``window``, ``words``, ``print``."""
    require(benchmark, [id_col, text_col])
    given = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), F.col(text_col).cast("binary").alias("text")
    )
    made = given.mapInPandas(_item_rows, "item_id string, window binary, words int, print bigint")
    return written(made, "benchmark-windows")


def _bit_table(windows: DataFrame) -> np.ndarray:
    """The benchmark's fingerprints as bits, at most MAX_BITS of them."""
    count = windows.agg(F.count_distinct("print")).first()[0]
    size = MIN_BITS
    while size < min(MAX_BITS, BITS_EACH * count):
        size *= 2
    first = F.col("print").bitwiseAND(F.lit(size - 1))
    second = F.shiftrightunsigned("print", 32).bitwiseAND(F.lit(size - 1))
    bits = windows.select(F.explode(F.array(first, second)).alias("bit"))
    # Public bitmap functions count bits from 1 in buckets of 32,768.
    cells = np.zeros(size // 8, np.uint8)
    parts = bits.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("cells")
    )
    for row in parts.toLocalIterator():
        part = np.frombuffer(row.cells, np.uint8)
        start = (row.bucket - 1) * len(part)
        cells[start : start + len(part)] = part
    return cells


def _chunks(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    chunk: list[list[bytes]] = []
    held = 0
    for text in texts:
        if chunk and held + len(text or b"") > CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
        chunk.append(words_of(text))
        held += len(text or b"")
    if chunk:
        yield chunk


def candidate_windows(texts: list[list[bytes]], lengths: list[int], table: BitTable) -> list[list[tuple[int, int, bytes]]]:
    """Per text the windows ``(start, words, digest)`` whose fingerprint meets the table."""
    found: list[list[tuple[int, int, bytes]]] = [[] for _ in texts]
    flat = [word for words in texts for word in words]
    size = np.array([len(words) for words in texts], np.int64)
    offset = np.concatenate(([0], np.cumsum(size)))
    if not flat:
        return found
    hashes = word_hashes(flat)
    owner = np.repeat(np.arange(len(texts)), size)
    for m in lengths:
        place, prints = fingerprints(hashes, m)
        if not len(place):
            continue
        inside = owner[: len(place)] == owner[m - 1 :]
        # Neighbouring windows keep the same place: look each kept place up once.
        new = np.concatenate(([True], place[1:] != place[:-1]))
        met = table.has(prints[new])[np.cumsum(new) - 1]
        for start in np.flatnonzero(met & inside).tolist():
            text = owner[start]
            found[text].append((start - int(offset[text]), m, _digest(flat[start : start + m])))
    return found


def _document_rows(lengths: list[int], cells) -> callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = BitTable(cells.value)
        for batch in batches:
            done = 0
            for chunk in _chunks(batch["text"].tolist()):
                found = candidate_windows(chunk, lengths, table)
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].iloc[done : done + len(chunk)],
                        "n_words": [len(words) for words in chunk],
                        "windows": [[{"start": a, "words": m, "window": d} for a, m, d in one] for one in found],
                    }
                )
                done += len(chunk)

    return rows


def matched_windows(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table, a row per document: ``row``, ``doc_id``, ``n_words`` and its candidate ``windows``."""
    require(docs, [id_col, text_col])
    spark = docs.sparkSession
    cells = spark.sparkContext.broadcast(_bit_table(windows))
    lengths = sorted(r.words for r in windows.select("words").distinct().collect())  # WINDOW values at most
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = given.mapInPandas(
        _document_rows(lengths, cells),
        f"doc_id {kind}, n_words bigint, windows array<struct<start:bigint,words:int,window:binary>>",
    )
    return written(found.withColumn("row", F.monotonically_increasing_id()), "document-windows")


def _hit_words(spans: str) -> F.Column:
    """Words in the union of ``(start, words)`` spans, by one pass in order of start."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end"))

    def add(seen, span):
        end = span["start"] + span["words"]
        new = F.greatest(F.lit(0).cast("long"), end - F.greatest(span["start"], seen["end"]))
        return F.struct((seen["hit"] + new).alias("hit"), F.greatest(seen["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda seen: seen["hit"])


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` words, the ``items`` (ids as text, sorted) whose windows occur."""
    windows = benchmark_windows(benchmark)
    found = matched_windows(docs, windows)
    # Windows of the same items form one class; a class has its item list once.
    by_window = windows.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    classed = by_window.select("window", "items", F.md5(F.to_json(F.struct("items")).cast("binary")).alias("class"))
    open_ = found.where(F.size("windows") > 0).select("row", F.explode("windows").alias("w")).select("row", "w.*")
    hits = open_.join(classed.select("window", "class"), "window")
    per_doc = hits.groupBy("row").agg(
        _hit_words(F.collect_list(F.struct("start", "words"))).alias("n_hit"),
        F.array_sort(F.collect_set("class")).alias("classes"),
    )
    per_doc = written(per_doc.withColumn("profile", F.md5(F.array_join("classes", ",").cast("binary"))), "document-hits")
    profiles = per_doc.groupBy("profile").agg(F.first("classes").alias("classes"))
    lists = profiles.select("profile", F.explode("classes").alias("class")).join(
        classed.select("class", "items").dropDuplicates(["class"]), "class"
    )
    items = lists.select("profile", F.explode("items").alias("item_id")).groupBy("profile").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )
    hit = per_doc.join(items, "profile").select("row", "n_hit", "items")
    none = F.array().cast("array<string>")
    clean = found.where(F.size("windows") == 0).select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items")
    )
    rest = found.where(F.size("windows") > 0).select("row", "doc_id", "n_words").join(hit, "row", "left")
    return clean.unionByName(
        rest.select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
        )
    )


def report(found: DataFrame) -> DataFrame:
    """Counts and the digest of the item ids of ``contamination``'s rows."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _fold_sql(col: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"regexp_extract_all(translate(coalesce({col}, ''), '{upper}', '{upper.lower()}'), '{WORD}')"


# The same by joining all windows of documents and items, without fingerprints.
ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {_fold_sql('text')} AS words FROM documents),
items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_fold_sql('text')} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(words)) AS m, list_slice(words, i, i + least({WINDOW}, len(words)) - 1) AS span
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least({WINDOW}, len(words)) + 2)) AS i FROM items WHERE len(words) > 0)),
lengths AS (SELECT DISTINCT m FROM item_windows),
doc_windows AS (
  SELECT rid, m, i - 1 AS start, list_slice(words, i, i + m - 1) AS span
  FROM (SELECT rid, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM docs, lengths WHERE len(words) >= m)),
hits AS MATERIALIZED (
  SELECT d.rid, d.start, d.m, w.item_id FROM doc_windows d JOIN item_windows w ON d.m = w.m AND d.span = w.span),
hit_words AS (
  SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(start, start + m)) AS place FROM hits) GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON d.rid = h.rid LEFT JOIN hit_items i ON d.rid = i.rid
"""
