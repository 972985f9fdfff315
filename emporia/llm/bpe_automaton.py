"""BPE encoding and decoding by a tokenization automaton.

Merges are compiled to an automaton over tokens by merge gadgets: it starts with
all arcs between single bytes; each merge ``(u, v)``, in order of rank, takes away
the arc ``u -> v`` and lets the new token be read wherever ``u`` then ``v`` could. So an
arc between two tokens exists at rank ``r`` if

* the pair is not itself merged before ``r``, and
* the arc the later made token inherited existed when that token was made: its
  incoming arcs are those of its left part, its outgoing ones those of its right.

A merge whose own arc is gone when its turn comes adds no token (it can never be
read).

Words are read byte by byte. Each prefix of a word has exactly one encoding, known
by its last token; the token that ends at a byte is the one whose arc from the
encoding before it exists. What the rest of a word can depend on is therefore the
longest end of the bytes read that begins some token, and, for each end that begins
one, the last token of the encoding before it. That is the state of a deterministic
automaton on bytes. Its table (states x bytes) is filled when a transition is first
taken, and bounded: when it is full it is emptied and filled again from the state
at hand. Encoding a word is one table step a byte, then a walk back over the last
tokens; decoding emits the labels (byte strings) of the arcs.

Texts are split into words by the tokenizer's own split; special strings are cut
out first, as the library does. One row in, one row out: no shuffle.

Defined cases: a null or empty text has no tokens and decodes to the empty text;
a word of any length is encoded in one pass; repeated rows give repeated results;
an empty table gives an empty result; further columns pass through unread, except
that output columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.llm.common import give_back, in_slices, require, text_or_empty

# Most states of the table, moves between ends (and arcs looked for), and words (of one age) that a worker keeps; beyond, they are made again.
STATES = 1 << 17
MOVES = 1 << 16
WORDS = 1 << 17
# Longer words are not kept.
WORD_KEPT = 64
NOT_MADE = -2
# In a step's value, a state's number is above the byte, and the last token above both.
BYTE_BITS, TOKEN_AT = 8, 32
# Rows whose ids and decoded texts are held at once.
CODED_ROWS = 256

# The byte-level split. In the characters of COMMON, Python's and the library's classes are
# known to agree, and these are the letters and digits among them; other texts are split by the library.
LETTER, DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^\s{LETTER}{DIGIT}]+|\s+(?!\S)|\s+")
NOT_COMMON = re.compile(r"[^\t\n\r\x20-\x7E¡-¬®-ſ‐-‧]")


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:  # a local file of each worker's own installation
        return json.load(file)


class Splitter:
    """Special strings and words of a text, as the tokenizer file says."""

    def __init__(self, path: str, whole: bool = True) -> None:
        """whole: the tokenizer has its vocabulary, too, which splitting alone does not need."""
        from tokenizers import Tokenizer

        spec = read_spec(path)
        if whole:
            self.tokenizer = Tokenizer.from_file(path)
        else:
            bare = {"model": spec["model"] | {"vocab": {}, "merges": []}, "added_tokens": []}
            self.tokenizer = Tokenizer.from_str(json.dumps(spec | bare))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        listed = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, listed)) + ")") if listed else None
        self.chars = byte_chars()

    def parts(self, text: str) -> list[str]:
        """The text, cut before and after each special string."""
        return [p for p in self.cut.split(text) if p] if self.cut else [text] if text else []

    def words(self, part: str) -> list[str]:
        if not NOT_COMMON.search(part):
            return SPLIT.findall(part)
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
        return [bytes(self.chars[c] for c in w).decode("utf-8") for w, _ in found]


def pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.int32)


class Automaton(Splitter):
    def __init__(self, path: str) -> None:
        super().__init__(path, whole=False)
        model = read_spec(path)["model"]
        vocab = model["vocab"]
        size = 1 + max(chain(vocab.values(), self.special.values()), default=-1)
        self.rank: dict[int, int] = {}  # merged pair (left << 32 | right) -> rank
        # By token: its pair, and the rank of its merge (-1: a byte, NOT_MADE: never read).
        self.left, self.right, self.made = array("i", [0]) * size, array("i", [0]) * size, array("i", [NOT_MADE]) * size
        self.label: dict[int, bytes] = {i: s.encode("utf-8") for s, i in self.special.items()}
        for char, byte in self.chars.items():
            if char in vocab:
                self.made[vocab[char]], self.label[vocab[char]] = -1, bytes([byte])
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            u, v, uv = vocab[left], vocab[right], vocab[left + right]
            # The gadget: only if u then v can still be read.
            both = self.made[u] != NOT_MADE and self.made[v] != NOT_MADE
            if both and self.made[uv] == NOT_MADE and self.arc(u, v, r):
                self.left[uv], self.right[uv], self.made[uv] = u, v, r
                self.label[uv] = self.label[u] + self.label[v]
            self.rank.setdefault(u << 32 | v, r)
        self.all_merges = len(model["merges"])
        self.token = {self.label[t]: t for t in sorted(vocab.values()) if self.made[t] != NOT_MADE}
        # Byte strings that begin a token (and so may go on to one).
        self.begins = {label[:n] for label in self.token for n in range(len(label))}
        self.moves: dict[tuple[bytes, int], tuple] = {}
        self.arcs: dict[int, bool] = {}  # pair (left << 32 | right) -> whether its arc is there after all merges
        self.step = Steps(self)
        self._empty()
        self.cache = Words(self)

    def forget(self) -> None:
        """Give back what encoding has gathered: states, moves and words."""
        self._empty()
        self.moves.clear()
        self.arcs.clear()
        self.cache = Words(self)
        give_back()

    def arc(self, a: int, b: int, limit: int) -> bool:
        """Whether the arc a -> b exists after the first ``limit`` gadgets."""
        while True:
            if self.rank.get(a << 32 | b, limit) < limit:
                return False
            made_a, made_b = self.made[a], self.made[b]
            if made_a > made_b:
                # Outgoing arcs are the right part's, at the time of the merge. Of
                # two equal merges that overlap, the left one is done: not after it.
                a, limit = self.right[a], made_a
            elif made_b >= 0:
                b, limit = self.left[b], made_b + 1
            else:
                return True

    def follows(self, a: int, b: int) -> bool:
        """Whether the arc a -> b exists after all gadgets."""
        pair = a << 32 | b
        found = self.arcs.get(pair)
        if found is None:
            if len(self.arcs) >= MOVES:
                self.arcs.clear()
            found = self.arcs[pair] = self.arc(a, b, self.all_merges + 1)
        return found

    def _empty(self) -> None:
        """The table with the start state alone: nothing read, no token yet."""
        self.step.clear()
        self.states: list[tuple[bytes, tuple[int, ...]]] = []
        self.values: dict[tuple[bytes, tuple[int, ...]], int] = {}
        self._state((b"", (-1,)))

    def _state(self, key: tuple[bytes, tuple[int, ...]]) -> int:
        """The value of a new state, which steps lead to: its number and the last token of the encoding so far. A state is
        the longest end of the bytes read that begins a token, and for all ends
        that begin one, longest first, the last token of the encoding before them (-1: none)."""
        value = self.values[key] = max(key[1][-1], 0) << TOKEN_AT | len(self.states) << BYTE_BITS
        self.states.append(key)
        return value

    def _lengths(self, end: bytes) -> list[int]:
        """Lengths of the ends of ``end`` that begin a token, longest first; 0 is one."""
        return [n for n in range(len(end), -1, -1) if end[len(end) - n :] in self.begins]

    def _move(self, end: bytes, byte: int) -> tuple[bytes, list[int], list[tuple[int, int]]]:
        """What a byte does to an end: the new end, where the encodings before its ends are found in the
        old state, and the tokens that end here with the place of the encoding before them."""
        read, lengths = end + bytes([byte]), self._lengths(end)
        place = {n: i for i, n in enumerate(lengths)}
        tokens = [(place[n], self.token[read[len(end) - n :]]) for n in lengths if read[len(end) - n :] in self.token]
        while read not in self.begins:
            read = read[1:]
        # An end of n bytes now was one of n - 1 bytes a byte ago.
        move = read, [place[n - 1] for n in self._lengths(read) if n], tokens
        if len(self.moves) >= MOVES:
            self.moves.clear()
        self.moves[end, byte] = move
        return move

    def next(self, at: int) -> int:
        """Fill in one transition, of a state's value | byte."""
        byte = at & (1 << BYTE_BITS) - 1
        state = at ^ byte
        end, before = self.states[(state & (1 << TOKEN_AT) - 1) >> BYTE_BITS]
        read, kept, tokens = self.moves.get((end, byte)) or self._move(end, byte)
        for place, token in tokens:
            if before[place] < 0 or self.follows(before[place], token):
                break
        else:
            raise ValueError("the automaton has no path for this text")
        following = read, (*[before[i] for i in kept], token)
        if len(self.states) >= STATES:
            self._empty()
            return self._state(following)
        value = self.step[at] = self.values.get(following) or self._state(following)
        return value

    def encode_word(self, word: bytes) -> list[int]:
        state, step, path = 0, self.step, []
        for byte in word:
            state = step[state | byte]
            path.append(state)
        # Values keep their tokens, also when the table was emptied on the way.
        label, ids, at = self.label, [], len(word)
        while at:
            token = path[at - 1] >> TOKEN_AT
            ids.append(token)
            at -= len(label[token])
        ids.reverse()
        return ids

    def packed(self, text: str) -> bytes:
        """Ids of the text, four bytes each."""
        ids: list[bytes] = []
        for part in self.parts(text):
            if part in self.special:
                ids.append(pack([self.special[part]]))
            else:
                ids.extend(map(self.cache.__getitem__, self.words(part)))
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return unpacked(self.packed(text)).tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.label.__getitem__, ids)).decode("utf-8", errors="replace")


class Steps(dict):
    """The table: value of a state | byte -> value of the next state, filled in when first asked for."""

    def __init__(self, made: Automaton) -> None:
        self.made = made

    def __missing__(self, at: int) -> int:
        return self.made.next(at)


class Words(dict):
    """Packed ids of the words met, none longer than WORD_KEPT. When there are WORDS of them they
    make room, and stay at hand until as many others were met: frequent words are never lost."""

    def __init__(self, made: Automaton) -> None:
        self.made, self.older = made, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word) or pack(self.made.encode_word(word.encode("utf-8")))
        if len(word) <= WORD_KEPT:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


@lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """One automaton per worker process and file."""
    return Automaton(path)


def encode(text: Column, path: str | None = None) -> Column:
    """Token ids of a text."""
    where = path or default_path()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = automaton(where)
        for texts in parts:
            yield pa.array([unpacked(made.packed(t or "")) for (t,) in in_slices(texts)], pa.list_(pa.int32()))
        texts = None
        made.forget()

    return run(F.coalesce(text, F.lit("")))


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of token ids (null: null)."""
    where = path or default_path()

    @F.pandas_udf(T.StringType())
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made = automaton(where)
        for rows in parts:
            yield pd.Series([None if r is None else made.decode(r) for r in rows], dtype=object)

    return run(ids)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` (text, ...) plus ids and n_tokens."""
    require(docs, ("text",))
    with_ids = docs.withColumn("ids", encode(F.col("text"), path))
    return with_ids.withColumn("n_tokens", F.size("ids").cast("long"))


def coded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` (text, ...) plus ids, n_tokens and the text decoded from the ids.

    One worker a task encodes and decodes, CODED_ROWS rows at a time, and gives its words
    and states back after a partition.
    """
    require(docs, ("text",))
    where = path or default_path()
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "n_tokens", "decoded")]
    more = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", T.LongType()).add("decoded", T.StringType())
    at = [f.name for f in kept].index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = automaton(where)
        for batch in batches:
            for start in range(0, batch.num_rows, CODED_ROWS):
                part = batch.slice(start, CODED_ROWS)
                ids = [unpacked(made.packed(text or "")) for text in part.column(at).to_pylist()]
                columns = [
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([made.decode(i.tolist()) for i in ids], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *more.names])
        batch = part = columns = ids = None
        made.forget()

    given = docs.select(*[F.col(f"`{f.name}`") for f in kept])
    return given.mapInArrow(rows, T.StructType([*kept, *more.fields]))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256.

    One pass: ids and decoded texts stay in the worker, only digests leave it.
    """
    require(docs, ("doc_id", "text"))
    where = path or default_path()

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = automaton(where)
        kinds = pa.int64(), pa.string(), pa.string()
        decimal = list(map(str, range(len(made.made))))
        for texts in parts:
            rows = []
            for (text,) in in_slices(texts):
                ids = made.encode(text or "")
                listed = ",".join(map(decimal.__getitem__, ids)).encode("ascii")
                back = made.decode(ids).encode("utf-8")
                rows.append((len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(back).hexdigest()))
            yield pa.StructArray.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True) if rows else ((),) * 3, kinds, strict=True)],
                names=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", run(text_or_empty()).alias("r")).select("doc_id", "r.*")
