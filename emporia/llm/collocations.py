"""Collocations from weighted acyclic automata of word n-grams.

An automaton here has three layers of arcs; a path of one to three words spells
an n-gram and the weight of its last arc is the n-gram's count. It is built from
n-grams in sorted order: when a prefix ends, the state below it is complete, and
a register turns equal states of a layer into one.

1. Shards: a task cuts its pieces of text into shards of about SHARD_BYTES, counts
   the n-grams of a shard by one sort (three-word windows; shorter n-grams are
   sums over their prefix) and writes them as automata of at most BLOCK n-grams.
2. Prefix ranges: the sorted order of all n-grams is cut into ranges of about
   RANGE_GRAMS by every KEY_GRAMS-th n-gram of a block, of all blocks or a sample of
   about SAMPLE_KEYS. The cuts fall between any two n-grams, so a language, word or
   word pair that begins a third of all n-grams is still cut. They decide the balance
   only, never a count.
3. Union: blocks are cut at the range bounds, sent to their range, and united
   there, weights summed. N-grams below ``least`` go: no candidate and no part of
   one is rarer. A range holds about RANGE_GRAMS n-grams of all shards.
4. Parts: a range asks, by an automaton of the distinct parts of its candidates,
   every range that holds some; there it is composed with the counts, and the
   composed automaton goes back. So a part that millions of candidates share is
   asked for once a range. Asking rows stream past the counts one by one.
5. Scores are exact (integers of any size), longer candidates mark the word pairs
   they replace, and a ranking window keeps the top of each language; Spark cuts
   each task's rows to that number before the shuffle.

Defined cases: a null text is empty; a null language is ``und``; empty texts and
pieces give nothing; repeated rows count again; ties follow the phrase's bytes;
an empty table gives an empty table; columns beyond text and language are not read.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import require, written

LEAST = 10
SHARD_BYTES = 8 << 20
BLOCK = 1 << 16
RANGE_GRAMS = 1_000_000
# A block shows one n-gram in so many: its first alone would say nothing of the rest of it.
KEY_GRAMS = 4096
SAMPLE_KEYS = 100_000

# A to Z folded; a tab is a space; the ends of pieces become MARK, a letter that folding leaves free.
MARK = b"A"
FOLD = bytes(
    MARK[0] if chr(c) in ".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c
    for c in range(256)
)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the narrowest type that holds them."""
    top = int(values.max(initial=0))
    code = next(c for c in "BHIQ" if top < 1 << 8 * np.dtype(c).itemsize)
    return struct.pack("<cI", code.encode(), len(values)) + values.astype(np.dtype(code)).tobytes()


def _unpacked(data: bytes, at: int) -> tuple[np.ndarray, int]:
    code, size = struct.unpack_from("<cI", data, at)
    kind = np.dtype(code.decode())
    return np.frombuffer(data, kind, size, at + 5).astype(np.int64), at + 5 + size * kind.itemsize


# Bits of a rank in a packed n-gram; a list of n-grams with more labels is compared by column.
RANK_BITS = 21
_RANK = (1 << RANK_BITS) - 1


def _fresh(ranks: np.ndarray, columns: int, labels: int) -> np.ndarray:
    """Where a prefix of so many words differs from the one before (sorted n-grams)."""
    if not ranks.shape[1]:
        return np.empty(0, np.int64)
    if labels < 1 << RANK_BITS:
        key = ranks[0]
        for column in range(1, columns):
            key = key << RANK_BITS | ranks[column]
        new = key[1:] != key[:-1]
    else:
        new = np.any(ranks[:columns, 1:] != ranks[:columns, :-1], axis=0)
    return np.flatnonzero(np.concatenate(([True], new)))


@dataclass
class Grams:
    """Sorted n-grams: ``ranks`` (three rows; 0 fills up) into sorted ``labels`` from 1, and weights."""

    labels: list[bytes]
    ranks: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.weights)

    def key(self, i: int) -> tuple[bytes, ...]:
        return tuple(self.labels[r - 1] if r else b"" for r in self.ranks[:, i].tolist())

    def part(self, which: np.ndarray | slice) -> Grams:
        """Some of the n-grams (in order) with the labels they use."""
        ranks = self.ranks[:, which]
        used = np.zeros(len(self.labels) + 1, bool)
        used[ranks.ravel()] = True
        used[0] = False
        new = np.cumsum(used) * used
        return Grams([self.labels[r - 1] for r in np.flatnonzero(used).tolist()], new[ranks], self.weights[which])

    def before(self, key: tuple[bytes, ...]) -> int:
        """How many n-grams come before ``key`` in sorted order."""
        low, high = 0, len(self)
        for column, word in enumerate(key):
            values = self.ranks[column, low:high]
            rank = bisect_left(self.labels, word) + 1 if word else 0
            if word and (rank > len(self.labels) or self.labels[rank - 1] != word):
                return low + int(np.searchsorted(values, rank))
            low, high = low + int(np.searchsorted(values, rank)), low + int(np.searchsorted(values, rank, "right"))
        return low


def _keys(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """N-grams with fewer labels than 2**RANK_BITS as one number each, in the same order."""
    return (one << RANK_BITS | two) << RANK_BITS | three


def _ranks(key: np.ndarray) -> np.ndarray:
    return np.stack((key >> 2 * RANK_BITS, key >> RANK_BITS & _RANK, key & _RANK))


def _starts(key: np.ndarray) -> np.ndarray:
    """Where a sorted number differs from the one before."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))


def _summed(labels: list[bytes], ranks: np.ndarray, weights: np.ndarray) -> Grams:
    """N-grams in any order, sorted, weights of equal ones summed."""
    if not len(weights):
        return Grams(labels, ranks, weights)
    if len(labels) < 1 << RANK_BITS:
        key = _keys(*ranks)
        order = np.argsort(key)
        key = key[order]
        first = _starts(key)
        return Grams(labels, _ranks(key[first]), np.add.reduceat(weights[order], first))
    order = np.lexsort(ranks[::-1])
    ranks, weights = ranks[:, order], weights[order]
    first = _fresh(ranks, 3, len(labels))
    return Grams(labels, ranks[:, first], np.add.reduceat(weights, first))


def united(parts: list[Grams]) -> Grams:
    """All n-grams of some sorted lists, weights of equal ones summed."""
    labels = sorted(set().union(*(p.labels for p in parts)))
    rank = {word: i + 1 for i, word in enumerate(labels)}
    maps = [np.array([0, *(rank[w] for w in p.labels)], np.int64) for p in parts]
    ranks = np.concatenate([np.empty((3, 0), np.int64), *(m[p.ranks] for m, p in zip(maps, parts))], axis=1)
    return _summed(labels, ranks, np.concatenate([np.empty(0, np.int64), *(p.weights for p in parts)]))


class Automaton:
    """Arcs in sorted order of state and label; state 0 has none, ``root`` is the last state."""

    def __init__(self, labels: list[bytes], first: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray):
        self.labels, self.first, self.label, self.weight, self.target = labels, first, label, weight, target
        self.root = len(first) - 2
        self.arcs = np.repeat(np.arange(len(first) - 1), np.diff(first)) * (len(labels) + 1) + label

    @classmethod
    def build(cls, grams: Grams) -> Automaton:
        """The automaton of sorted n-grams, from its last layer up."""
        made = _Register()
        labels, ranks, mass = len(grams.labels), grams.ranks, grams.weights
        below = np.zeros(len(grams), np.int64)
        for column in (2, 1, 0):
            own = ranks[column] > 0
            ranks, mass, below = ranks[: column + 1, own], mass[own], below[own]
            # One arc a prefix of column + 1 words: the n-gram that ends there comes first, the state below is the last's.
            first = _fresh(ranks, column + 1, labels)
            last = np.append(first[1:], len(mass))[: len(first)] - 1
            arcs = np.stack((ranks[column, first], mass[first], below[last]), axis=1)
            heads = _fresh(ranks[:, first], column, labels) if column else first[:1] * 0
            states = made.states(heads, arcs)
            if column:
                # N-grams of the next layer: shorter ones, and one with the state for each prefix.
                ends = first[heads]
                shorter = grams.ranks[column] == 0
                ranks = np.concatenate((grams.ranks[:column, shorter], ranks[:column, ends]), axis=1)
                mass = np.concatenate((grams.weights[shorter], np.zeros(len(ends), np.int64)))
                below = np.concatenate((np.zeros(int(shorter.sum()), np.int64), states))
                order = np.lexsort((below, *ranks[::-1]))
                ranks, mass, below = ranks[:, order], mass[order], below[order]
        return made.automaton(grams.labels)

    def step(self, states: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and target of the arcs of ``labels`` from ``states``; 0 and 0 where there is none."""
        wanted = states * (len(self.labels) + 1) + labels
        at = np.minimum(np.searchsorted(self.arcs, wanted), max(0, len(self.arcs) - 1))
        if not len(self.arcs):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        there = (self.arcs[at] == wanted) & (labels > 0)
        return np.where(there, self.weight[at], 0), np.where(there, self.target[at], 0)

    def grams(self) -> Grams:
        """Every path with a weight, in sorted order."""
        path = np.zeros((3, 1), np.int64)
        state = np.array([self.root])
        ranks, weights = [], []
        for column in range(3):
            size = self.first[state + 1] - self.first[state]
            begin = np.repeat(self.first[state] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            arc = begin + np.arange(len(begin))
            path = np.repeat(path, size, axis=1)
            path[column] = self.label[arc]
            state = self.target[arc]
            weighted = self.weight[arc] > 0
            ranks.append(path[:, weighted])
            weights.append(self.weight[arc][weighted])
        return _summed(self.labels, np.concatenate(ranks, axis=1), np.concatenate(weights))

    def compose(self, asked: Grams) -> Grams:
        """The asked n-grams that are in this automaton, with its weights."""
        rank = {word: i + 1 for i, word in enumerate(self.labels)}
        own = np.array([0, *(rank.get(w, 0) for w in asked.labels)], np.int64)[asked.ranks]
        known = (own > 0) == (asked.ranks > 0)
        state = np.full(len(asked), self.root)
        weight = np.zeros(len(asked), np.int64)
        for column in range(3):
            used = asked.ranks[column] > 0
            mass, target = self.step(state, own[column])
            weight, state = np.where(used, mass, weight), np.where(used, target, state)
        return Grams(asked.labels, asked.ranks, weight).part(known.all(axis=0) & (weight > 0))

    def to_bytes(self) -> bytes:
        text = np.frombuffer(b" ".join(self.labels), np.uint8)
        return b"".join(map(_packed, (text, self.first, self.label, self.weight, self.target)))

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        fields, at = [], 0
        for _ in range(5):
            field, at = _unpacked(data, at)
            fields.append(field)
        return cls(fields[0].astype(np.uint8).tobytes().split(b" ") if len(fields[0]) else [], *fields[1:])


class _Register:
    """States so far, equal ones of a layer kept once."""

    def __init__(self) -> None:
        self.sizes: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.arcs: list[np.ndarray] = []
        self.count = 1

    def states(self, first: np.ndarray, arcs: np.ndarray) -> np.ndarray:
        """State numbers for the groups of arcs (label, weight, target) that start at ``first``."""
        size = np.diff(np.append(first, len(arcs)))
        number = np.zeros(len(first), np.int64)
        single = size == 1
        if single.any():
            rows = arcs[first[single]]
            spans = rows.max(axis=0) + 1
            if float(spans[0]) * float(spans[1]) * float(spans[2]) < 2**62:
                same, distinct = pd.factorize((rows[:, 0] * spans[1] + rows[:, 1]) * spans[2] + rows[:, 2])
                at = np.empty(len(distinct), np.int64)
                at[same[::-1]] = np.arange(len(rows))[::-1]
            else:
                _, at, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            number[single] = self.count + same.ravel()
            self.arcs.append(rows[at])
            self.sizes.append(np.ones(len(at), np.int64))
            self.count += len(at)
        known: dict[bytes, int] = {}
        for i in np.flatnonzero(~single).tolist():
            group = arcs[first[i] : first[i] + size[i]]
            code = group.tobytes()
            state = known.get(code)
            if state is None:
                state = known[code] = self.count
                self.count += 1
                self.arcs.append(group)
                self.sizes.append(size[i : i + 1])
            number[i] = state
        return number

    def automaton(self, labels: list[bytes]) -> Automaton:
        sizes = np.concatenate(self.sizes)
        arcs = np.concatenate(self.arcs) if self.arcs else np.empty((0, 3), np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))
        return Automaton(labels, first, *(np.ascontiguousarray(arcs[:, i]) for i in range(3)))


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and counts of all n-grams, from the keys of three-word windows; sorting numbers is far cheaper than ordering rows."""
    key.sort()
    first = _starts(key)
    key, mass = key[first], np.diff(first, append=len(key))
    keys, weights = [key[key & _RANK > 0]], [mass[key & _RANK > 0]]
    for bits in (RANK_BITS, 2 * RANK_BITS):
        # Windows that begin with the same words, however long, are next to each other.
        prefix = key >> bits
        long_ = prefix & _RANK > 0
        prefix, own = prefix[long_], mass[long_]
        first = _starts(prefix)
        keys.append(prefix[first] << bits)
        weights.append(np.add.reduceat(own, first) if len(first) else own)
    key = np.concatenate(keys)
    order = np.argsort(key)
    return _ranks(key[order]), np.concatenate(weights)[order]


def shard_grams(texts: list[bytes]) -> Grams:
    """Counts of the one- to three-word n-grams of some texts, sorted."""
    marked = (b" " + MARK + b" ").join(t.translate(FOLD).replace(MARK, b" " + MARK + b" ") for t in texts)
    flat = np.array(marked.split() + [MARK] * 2, object)
    ids, distinct = pd.factorize(flat)
    labels = sorted(w for w in distinct if w != MARK)
    rank = {word: i + 1 for i, word in enumerate(labels)}
    word = np.array([rank.get(w, 0) for w in distinct], np.int64)[ids]
    one, two, three = word[:-2], word[1:-1], word[2:]
    two = np.where(one > 0, two, 0)
    three = np.where(two > 0, three, 0)
    if len(labels) < 1 << RANK_BITS:
        return Grams(labels, *_counted(_keys(one, two, three)[one > 0]))
    windows = _summed(labels, np.stack((one, two, three))[:, one > 0], np.ones(int((one > 0).sum()), np.int64))
    ranks, weights = [windows.ranks[:, windows.ranks[2] > 0]], [windows.weights[windows.ranks[2] > 0]]
    for length in (1, 2):
        # Windows that begin with the same words, however long, are next to each other.
        long_ = windows.ranks[length - 1] > 0
        rows, mass = windows.ranks[:, long_], windows.weights[long_]
        first = _fresh(rows, length, len(labels))
        prefix = rows[:, first]
        prefix[length:] = 0
        ranks.append(prefix)
        weights.append(np.add.reduceat(mass, first) if len(first) else mass)
    return _summed(labels, np.concatenate(ranks, axis=1), np.concatenate(weights))


SHARD_ROWS = "lang string, words bigint, grams bigint, keys array<array<binary>>, automaton binary"


def _spread(grams: Grams) -> list[list[bytes]]:
    """Every KEY_GRAMS-th n-gram or so, the first among them, at even distances."""
    count = -(-len(grams) // KEY_GRAMS)
    return [list(grams.key(i * len(grams) // count)) for i in range(count)]


def _shard_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[bytes]] = {}
    size = 0

    def blocks() -> Iterator[pd.DataFrame]:
        for lang, texts in held.items():
            grams = shard_grams(texts)
            for start in range(0, len(grams), BLOCK):
                block = grams.part(slice(start, start + BLOCK))
                words = int(block.weights[block.ranks[1] == 0].sum())
                made = Automaton.build(block).to_bytes()
                yield pd.DataFrame({"lang": [lang], "words": [words], "grams": [len(block)], "keys": [_spread(block)], "automaton": [made]})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= SHARD_BYTES:
                yield from blocks()
                held, size = {}, 0
    yield from blocks()


Bounds = list[tuple[str, tuple[bytes, ...]]]


def _range_bounds(shards: DataFrame) -> Bounds:
    """Sorted n-grams that cut the order of all into ranges of about RANGE_GRAMS."""
    total, shown = shards.agg(F.sum("grams"), F.sum(F.size("keys"))).first()
    ranges = -(-(total or 0) // RANGE_GRAMS)
    keyed = shards.select("lang", "words", "grams", (F.col("grams") / F.size("keys")).alias("mass"), F.posexplode("keys").alias("at", "key"))
    share = min(1.0, SAMPLE_KEYS / max(1, shown or 0))
    # About SAMPLE_KEYS of them, the same in a rerun; nothing is sorted or gathered in one task.
    chance = F.pmod(F.xxhash64("lang", "words", "grams", "at", "key"), F.lit(1 << 30)) / (1 << 30)
    sample = keyed.where(chance < share).select("lang", "key", "mass").collect()
    keys = sorted((r.lang, tuple(bytes(w) for w in r.key), r.mass) for r in sample)
    mass = np.cumsum([m for _, _, m in keys])
    cuts = np.searchsorted(mass, [mass[-1] * i / ranges for i in range(1, ranges)], "right") if keys else []
    return sorted({keys[i][:2] for i in cuts if 0 < i < len(keys)})


def _cut(lang: str, grams: Grams, bounds: Bounds) -> Iterator[tuple[int, Grams]]:
    """The non-empty parts of sorted n-grams by range."""
    low = bisect_left(bounds, (lang, ()))
    high = bisect_left(bounds, (lang + "\0", ()))
    edges = [0, *(grams.before(key) for _, key in bounds[low:high]), len(grams)]
    for i, (start, end) in enumerate(zip(edges, edges[1:])):
        if start < end:
            yield low + i, grams.part(slice(start, end))


def _cut_rows(bounds) -> callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, data in zip(batch["lang"], batch["automaton"]):
                grams = Automaton.from_bytes(data).grams()
                parts = list(_cut(lang, grams, bounds.value))
                made = [data if len(g) == len(grams) else Automaton.build(g).to_bytes() for _, g in parts]
                yield pd.DataFrame({"lang": lang, "range": [i for i, _ in parts], "automaton": made})

    return rows


def _union_rows(least: int) -> callable:
    def rows(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = united([Automaton.from_bytes(data).grams() for data in group["automaton"]])
        total = total.part(total.weights >= least)
        if not len(total):
            return pd.DataFrame()
        return pd.DataFrame({"lang": [key[1]], "range": [key[0]], "automaton": [Automaton.build(total).to_bytes()]})

    return rows


def _parts(grams: Grams) -> Grams:
    """The distinct parts of all cuts of the candidates among ``grams``."""
    rows = grams.ranks[:, grams.ranks[1] > 0]
    longer = rows[:, rows[2] > 0]
    last = np.where(rows[2] > 0, rows[2], rows[1])
    asked = [(rows[0],), (last,), (longer[0], longer[1]), (longer[1], longer[2])]
    ranks = np.concatenate([np.stack((*a, *[np.zeros_like(a[0])] * (3 - len(a)))) for a in asked], axis=1)
    return united([Grams(grams.labels, ranks, np.ones(ranks.shape[1], np.int64))])


def _request_rows(bounds) -> callable:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, source, data in zip(batch["lang"], batch["range"], batch["automaton"]):
                parts = list(_cut(lang, _parts(Automaton.from_bytes(data).grams()), bounds.value))
                if not parts:
                    continue
                made = [Automaton.build(g).to_bytes() for _, g in parts]
                yield pd.DataFrame({"lang": lang, "source": source, "range": [i for i, _ in parts], "asked": made})

    return rows


def _answer_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, counts = None, None
    for batch in batches:
        out = []
        for lang, source, at, asked, data in zip(*(batch[c] for c in ("lang", "source", "range", "asked", "automaton"))):
            if (lang, at) != last:
                last, counts = (lang, at), Automaton.from_bytes(data)
            found = counts.compose(Automaton.from_bytes(asked).grams())
            out.append((lang, source, Automaton.build(found).to_bytes()))
        if out:
            yield pd.DataFrame(out, columns=["lang", "source", "automaton"])


SCORE_ROWS = "lang string, phrase binary, a bigint, l bigint, r bigint, score bigint, replaced boolean"


def _score_rows(key: tuple, own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a range with their lowest-scoring cut, and the pairs that longer ones replace."""
    out: list[tuple] = []
    lang = key[0]
    known = Automaton.build(united([Automaton.from_bytes(data).grams() for data in answers["automaton"]]))
    rank = {w: i + 1 for i, w in enumerate(known.labels)}
    for data in own["automaton"]:
        grams = Automaton.from_bytes(data).grams()
        words = np.array([0, *(rank.get(w, 0) for w in grams.labels)], np.int64)
        rows = np.flatnonzero(grams.ranks[1] > 0)
        one, two, three = words[grams.ranks[:, rows]]
        root = np.full(len(rows), known.root)
        first, after_one = known.step(root, one)
        second, after_two = known.step(root, two)
        pair, tail = known.step(after_one, two)[0], known.step(after_two, three)[0]
        last = known.step(root, three)[0]
        for i, row in enumerate(rows.tolist()):
            phrase = [w for w in grams.key(row) if w]
            a = int(grams.weights[row])
            cuts = [(int(first[i]), int(second[i]))]
            if len(phrase) == 3:
                cuts = [(int(first[i]), int(tail[i])), (int(pair[i]), int(last[i]))]
                out += [
                    (lang, b" ".join(p), None, None, None, None, True)
                    for p, n in ((phrase[:2], int(pair[i])), (phrase[1:], int(tail[i])))
                    if 100 * a >= 50 * n
                ]
            scores = [1_000_000 * a * a // (l * r) for l, r in cuts]
            low = scores.index(min(scores))
            out.append((lang, b" ".join(phrase), a, *cuts[low], scores[low], False))
    if not out:
        return pd.DataFrame()
    names = [f.split()[0] for f in SCORE_ROWS.split(", ")]
    made = pd.DataFrame(out, columns=names)
    return made.astype({c: "Int64" for c in ("a", "l", "r", "score")})


def ngram_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame, Bounds]:
    """The written count automata by language and prefix range, the words of each language, and the bounds."""
    require(docs, [lang_col, text_col])
    given = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    shards = written(given.mapInPandas(_shard_rows, SHARD_ROWS), "ngram-shards")
    bounds = _range_bounds(shards)
    shared = docs.sparkSession.sparkContext.broadcast(bounds)
    parts = shards.select("lang", "automaton").mapInPandas(_cut_rows(shared), "lang string, range int, automaton binary")
    counts = parts.groupBy("range", "lang").applyInPandas(_union_rows(least), "lang string, range int, automaton binary")
    return written(counts, "ngram-counts"), shards.groupBy("lang").agg(F.sum("words").alias("n")), bounds


def scored_candidates(counts: DataFrame, bounds: Bounds) -> DataFrame:
    """Written rows of ``SCORE_ROWS``: each candidate once, and the pairs that longer candidates replace."""
    shared = counts.sparkSession.sparkContext.broadcast(bounds)
    asked = counts.mapInPandas(_request_rows(shared), "lang string, source int, range int, asked binary")
    answers = asked.join(counts, ["lang", "range"]).mapInPandas(_answer_rows, "lang string, source int, automaton binary")
    scored = counts.groupBy("lang", "range").cogroup(answers.groupBy("lang", "source")).applyInPandas(_score_rows, SCORE_ROWS)
    return written(scored.withColumn("phrase", F.col("phrase").cast("string")), "ngram-scores")


def collocations(docs: DataFrame, top: int, least: int = LEAST) -> DataFrame:
    """Each language's best ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts, words, bounds = ngram_counts(docs, least)
    scored = scored_candidates(counts, bounds)
    replaced = scored.where("replaced").select("lang", "phrase").distinct()
    kept = scored.where(~F.col("replaced")).join(replaced, ["lang", "phrase"], "left_anti")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(top: int, least: int = LEAST) -> str:
    """The same by counting all n-grams as rows."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
  SELECT lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS pid,
           unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w)),
counts AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= {least}),
cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(list_slice(w, 1, c), ' ') AS p, array_to_string(list_slice(w, c + 1, k), ' ') AS s
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
  SELECT x.lang, x.k, x.phrase, x.a, c, p.f AS l, s.f AS r,
         ((1000000::HUGEINT * x.a * x.a) // (p.f::HUGEINT * s.f))::BIGINT AS score
  FROM cuts x JOIN counts p ON x.lang = p.lang AND x.p = p.phrase AND p.k = x.c
  JOIN counts s ON x.lang = s.lang AND x.s = s.phrase AND s.k = x.k - x.c),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, c) = 1),
replaced AS (
  SELECT DISTINCT b.lang, b.phrase FROM candidates t JOIN candidates b
  ON t.lang = b.lang AND t.k = 3 AND b.k = 2 AND 100 * t.a >= 50 * b.a
  AND (b.phrase = t.w[1] || ' ' || t.w[2] OR b.phrase = t.w[2] || ' ' || t.w[3])),
kept AS (SELECT * FROM lowest x WHERE NOT EXISTS (SELECT 1 FROM replaced r WHERE x.k = 2 AND r.lang = x.lang AND r.phrase = x.phrase)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS rank FROM kept)
SELECT k.lang, rank, phrase, a, l, r, n, score FROM ranked k JOIN totals t ON k.lang = t.lang WHERE rank <= {top}
"""
