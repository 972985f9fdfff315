"""Automaton, round trip and counts against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from emporia.llm import bpe_automaton, token_counts
from emporia.llm.common import in_slices
from tests.conftest import SF_ORACLE

TEXTS = [
    "", " ", "the quick brown fox", "a<|endoftext|>b  <|endoftext|>", "x" * 3000, "ab" * 700, "don't WE'LL i've",
    " \n\n hi there 日本語 \x1c\x85 é ½ ² ​\U0001f600", "=-" * 300, " " * 77, "\t\t\n  \n",
    "hahahaha xxxyyyzzz aaaaaaa", "русский ελ ال",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_automaton.default_path())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra") for i, t in enumerate(TEXTS)] + [(900, None, "extra"), (2, TEXTS[2], "extra")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_automaton_equals_library(library):
    made = bpe_automaton.automaton(bpe_automaton.default_path())
    for text in TEXTS:
        ids = made.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert made.decode(ids) == text


def test_round_trip_rows(spark, docs, library):
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_automaton.round_trip(docs).collect()}
    want = set()
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), row.text or "")]
        want.add((row.doc_id, len(ids), *digest))
    assert got == want
    assert bpe_automaton.round_trip(docs.limit(0)).count() == 0


def test_counts_with_and_without_table(spark, docs, library):
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    for size in (0, 5, 1000):
        rows = token_counts.token_counts(docs, limit=5, table_size=size).collect()
        assert len(rows) == len(TEXTS) + 2
        assert {r.doc_id: r.n_tokens for r in rows} == want
        assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
    by_id = {r.doc_id: r.n_bytes for r in rows}
    assert by_id[900] == 0 and by_id[7] == len(TEXTS[7].encode())
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_all_documents_equal_the_library(spark, library):
    """Ids, texts and counts of every document of a given table."""
    table = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in table.select("doc_id", "text").collect()}
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in bpe_automaton.round_trip(table).collect():
        assert (r.n_tokens, r.ids_sha256) == (len(ids[r.doc_id]), sha(",".join(map(str, ids[r.doc_id]))))
        assert r.decoded_sha256 == sha(library.decode(ids[r.doc_id], skip_special_tokens=False))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(table).collect()}
    assert got == {d: (len(t.encode()), len(ids[d])) for d, t in texts.items()}


def test_a_full_table_and_word_cache_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_automaton, "STATES", 40)
    monkeypatch.setattr(bpe_automaton, "MOVES", 30)
    monkeypatch.setattr(bpe_automaton, "WORDS", 5)
    made = bpe_automaton.Automaton(bpe_automaton.default_path())
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice("abcdeinorst  hTH-=_é日1") for _ in range(rng.randrange(200)))
        assert made.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(made.states) <= 41 and len(made.moves) <= 30 and len(made.cache) <= 5


def test_an_automaton_has_its_vocabulary_once(library):
    """The library's tokenizer only splits there; words keep their ids packed."""
    made = bpe_automaton.Automaton(bpe_automaton.default_path())
    assert made.tokenizer.get_vocab_size() == 0 < library.get_vocab_size()
    text = "日本語 the quick brown fox <|endoftext|>"
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe_automaton.unpacked(made.packed(text)).tolist() == made.encode(text) == ids
    assert made.cache and {type(i) for i in made.cache.values()} == {bytes}
    with pytest.raises(KeyError):
        made.decode([-1])


def test_encoded_rows(spark, docs, library):
    for r in bpe_automaton.encoded(docs).collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_states_are_shared_between_words():
    """The table is an automaton, not a list of words: words with one ending meet in one state."""
    made = bpe_automaton.Automaton(bpe_automaton.default_path())
    made.encode_word(b"zzzzzzzzzzzzzzzzzzzzzzzzzzzz")
    before = len(made.states)
    made.encode_word(b"z" * 5000)
    assert len(made.states) - before <= 64


def test_a_word_takes_one_table_step_a_byte_and_arcs_are_kept(monkeypatch):
    made = bpe_automaton.Automaton(bpe_automaton.default_path())
    word = "unbelievably".encode()
    ids = made.encode_word(word)
    # Every transition and every arc is known now: nothing is filled in or looked for again.
    monkeypatch.setattr(made, "next", None)
    monkeypatch.setattr(made, "arc", None)
    assert made.encode_word(word) == ids and made.decode(ids) == "unbelievably"
    assert len(made.arcs) <= bpe_automaton.MOVES
    made.forget()
    assert not made.arcs and not made.moves and not made.step and not made.cache


def test_workers_read_batches_in_slices():
    import pyarrow as pa

    sizes = []

    class Column:
        def __init__(self, values):
            self.values = values

        def __len__(self):
            return len(self.values)

        def slice(self, at, rows):
            sizes.append(rows)
            return pa.array(self.values[at : at + rows])

    rows = [*zip(["a", None, "c", "", "e"], range(5), strict=True)]
    assert list(in_slices(*map(Column, map(list, zip(*rows, strict=True))), rows=2)) == rows
    assert set(sizes) == {2}
    assert list(in_slices(pa.array([], pa.string()))) == []


def test_a_worker_gives_back_what_its_batches_took(spark):
    """After a partition was encoded, decoded and digested, Arrow keeps none of the batch's memory."""
    import pyarrow as pa

    texts = spark.createDataFrame([(i, "many words of text " * 2000) for i in range(400)], "doc_id long, text string").coalesce(1)
    held = []

    def left(rows):
        for _ in rows:
            pass
        held.append(pa.total_allocated_bytes())
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64())], names=["n"])

    bpe_automaton.coded(texts.select("doc_id", "text")).select("n_tokens").write.format("noop").mode("overwrite").save()
    assert texts.select("doc_id").mapInArrow(left, "n long").first().n < 4_000_000


def test_the_sample_holds_no_long_text(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SAMPLE_BYTES", 100)
    docs = spark.createDataFrame([(1, "word " * 1000), (2, "a b"), (3, None)], "doc_id long, text string")
    hashes, lengths = token_counts.frequent_lengths(docs, bpe_automaton.default_path(), 10, 50)
    assert len(hashes) == len(lengths) == 2
    assert [r.n_tokens for r in token_counts.token_counts(docs).orderBy("doc_id").collect()][1:] == [2, 0]
