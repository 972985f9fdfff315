"""Periodic runs, benchmark decontamination and collocations against brute force and their SQL."""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections import Counter

import pandas as pd
import pytest

from emporia.llm import collocations, decontamination, periodic_runs
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op12_decontamination", "op13_collocations"])
def test_query_equals_sql(spark, name):
    rec = compare(spark, SF_SMALL, [name])[name]
    assert rec["ok"], rec


# Periodic runs


def all_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def random_words(rng):
    words = [rng.choice("abcde"[: rng.randint(1, 5)]) for _ in range(rng.randint(0, 90))]
    if words and rng.random() < 0.6:
        a, p = rng.randrange(len(words)), rng.randint(1, 12)
        words = [w if i < a or a + (i - a) % p >= len(words) else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_runs_equal_all_lags():
    rng = random.Random(11)
    for _ in range(400):
        texts = [[w.encode() for w in random_words(rng)] for _ in range(3)]
        assert periodic_runs.runs_of(texts) == [all_runs(t) for t in texts]


def test_long_periodic_texts_are_whole():
    for n, p in ((60_000, 1), (60_000, 14_999), (60_000, 15_001)):
        words = [b"%d" % (i % p) for i in range(n)]
        assert periodic_runs.runs_of([words])[0] == ([(0, n, p)] if 4 * p <= n else [])


def test_run_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(random_words(rng)) for _ in range(40)]
    texts += [None, "", " \t\n", "é\u0085 " * 9, "x\x0by\fx y x\ry x y", "a " * 30_000, texts[0]]
    rows = [(i if i % 9 else None, t, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    got = sorted((r.doc_id or -1, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect())
    want = []
    for doc_id, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = all_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        gone = {i for a, n, q in runs for i in range(a + q, a + n)}
        want.append((doc_id or -1, runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert periodic_runs.report(periodic_runs.periodic_runs(docs.limit(0))).count() == 0
    report = {r.doc_id: r for r in periodic_runs.report(periodic_runs.periodic_runs(docs)).collect() if r.doc_id}
    assert (report[41].n_runs, report[41].start, report[41].exponent_milli) == (0, None, None)
    assert report[41].runs_sha256 == report[41].collapsed_sha256 == hashlib.sha256(b"").hexdigest()


# Benchmark decontamination


def folded(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def leaks(docs, items):
    windows = {}
    for item, text in items:
        words = folded(text)
        m = min(10, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            windows.setdefault(tuple(words[i : i + m]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        words, hit, found = folded(text), set(), set()
        for m in range(1, 11):
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[tuple(words[i : i + m])]
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return out


def plain(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str)


def test_contamination_equals_all_windows(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünï", "日本"]
    item_texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 7, 9, 10, 11, 14, 30]))) for _ in range(14)]
    items = [(i, t) for i, t in enumerate(item_texts)] + [(3, "other words of item three"), (None, "an item without id"), (90, None), (91, " -- ")]
    docs = []
    for i in range(60):
        words = rng.choices(vocabulary + [f"x{j}" for j in range(40)], k=rng.randint(0, 60))
        if rng.random() < 0.5:
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(item_texts).upper().split()[: rng.randint(8, 40)]
        docs.append((i if i % 7 else None, rng.choice([" ", ", ", "\n"]).join(words)))
    docs += [(700, None), (701, ""), (702, "AN ITEM--without! id"), (703, " ".join(["w1"] * 5000)), docs[1]]
    frame = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, row string").repartition(3)
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, window int")
    assert plain(decontamination.contamination(frame, bench)) == sorted(leaks(docs, items), key=str)
    assert plain(decontamination.contamination(frame, bench.limit(0))) == sorted(leaks(docs, []), key=str)
    assert decontamination.report(decontamination.contamination(frame.limit(0), bench)).count() == 0


def test_full_bit_table_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MIN_BITS", 1 << 15)
    monkeypatch.setattr(decontamination, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(decontamination, "CHUNK_BYTES", 500)
    words = [f"w{i}" for i in range(9000)]
    items = [(i, " ".join(words[i * 30 : i * 30 + 30])) for i in range(300)]
    docs = [(i, " ".join(words[i * 37 : i * 37 + 61]) + " tail of its own") for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert plain(decontamination.contamination(frame, bench)) == sorted(leaks(docs, items), key=str)


@pytest.mark.parametrize("length", range(1, 11))
def test_shared_spans_share_a_fingerprint(length):
    rng = random.Random(length)
    span = [rng.choice([b"a", b"b", b"c"]) for _ in range(length)]
    one = decontamination.word_hashes([b"x", b"a", *span, b"b"])
    two = decontamination.word_hashes([*span, b"c", b"c", b"y"])
    a, b = (set(decontamination.fingerprints(h, length)[1].tolist()) for h in (one, two))
    assert a & b


# Collocations


def counted(texts):
    counts = Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def best_phrases(docs, top, least):
    out = []
    for lang in sorted({lang or "und" for lang, _ in docs}):
        f = counted([t for x, t in docs if (x or "und") == lang])
        n = sum(c for p, c in f.items() if len(p) == 1)
        long_ = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in long_.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in long_.items()):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return out


def random_text(rng, size):
    return "".join(rng.choice(["a", "B", "c ", "Dé", " ", " ", ". ", "\t", ",", "x y", "\x0b", "日 "]) for _ in range(size))


def asdict(grams):
    return {tuple(w.decode() for w in grams.key(i) if w): int(grams.weights[i]) for i in range(len(grams))}


def test_automata_hold_cut_unite_and_compose_counts():
    rng = random.Random(13)
    for _ in range(60):
        one, two = ([random_text(rng, rng.randint(0, 60)) for _ in range(3)] for _ in range(2))
        a, b = (collocations.shard_grams([t.encode() for t in texts]) for texts in (one, two))
        read = collocations.Automaton.from_bytes(collocations.Automaton.build(a).to_bytes())
        assert asdict(read.grams()) == asdict(a) == dict(counted(one))
        both = collocations.united([a, b])
        assert asdict(both) == dict(counted(one) + counted(two))
        keys = [both.key(i) for i in range(len(both))]
        assert keys == sorted(keys)
        bounds = [("de", (b"", b"", b"")), *sorted(("en", k) for k in rng.sample(keys, min(3, len(keys)))), ("fr", (b"x", b"", b""))]
        cut = {}
        for at, part in collocations._cut("en", both, bounds):
            for i in range(len(part)):
                assert bisect_right(bounds, ("en", part.key(i))) == at
            cut |= asdict(part)
        assert cut == asdict(both)
        asked = asdict(collocations.Automaton.build(b).compose(a))
        assert asked == {p: c for p, c in counted(two).items() if p in counted(one)}


def test_equal_states_are_one():
    grams = collocations.shard_grams([b"a x y. b x y. c x y"])
    # Final state; {x y: 1} and {y: 1} below it and below words; root.
    assert len(collocations.Automaton.build(grams).first) - 1 <= 6


def test_collocations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 2_000)
    monkeypatch.setattr(collocations, "BLOCK", 16)
    monkeypatch.setattr(collocations, "RANGE_GRAMS", 60)
    rng = random.Random(4)
    docs = [(rng.choice(["en", "en", "en", "und", None, "日"]), random_text(rng, rng.randint(0, 400))) for _ in range(60)]
    docs += [("en", None), ("en", ""), ("xx", ""), ("en", "all alike " * 300), docs[0], docs[0]]
    frame = spark.createDataFrame([(*d, "c") for d in docs], "lang string, text string, phrase string").repartition(3)
    for top, least in ((2000, 3), (7, 10)):
        got = sorted(tuple(r) for r in collocations.collocations(frame, top, least).collect())
        assert got == sorted(best_phrases(docs, top, least))
    assert collocations.collocations(frame.limit(0), 5).count() == 0


def test_ranges_hold_about_as_many_ngrams_each(spark, monkeypatch):
    # Many shards of one block or little more: their blocks all begin at the same few n-grams.
    for name, value in (("SHARD_BYTES", 3_000), ("BLOCK", 1_000), ("KEY_GRAMS", 50), ("RANGE_GRAMS", 2_000)):
        monkeypatch.setattr(collocations, name, value, raising=False)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(60)) for _ in range(400)]
    batch = pd.DataFrame({"lang": ["en", "en", "de", "en"] * 100, "text": [t.encode() for t in texts]})
    rows = pd.concat(collocations._shard_rows(iter([batch])))
    shards = spark.createDataFrame(rows, collocations.SHARD_ROWS)
    for keys in (100_000, 300):
        monkeypatch.setattr(collocations, "SAMPLE_KEYS", keys, raising=False)
        bounds = collocations._range_bounds(shards)
        held = Counter()
        for lang, data in zip(rows["lang"], rows["automaton"]):
            for at, part in collocations._cut(lang, collocations.Automaton.from_bytes(data).grams(), bounds):
                held[at] += len(part)
        assert sum(held.values()) == rows["grams"].sum() > 20 * 2_000
        assert max(held.values()) < (3_000 if keys > 300 else 6_000)


def test_counts_by_packed_keys_are_those_by_columns(monkeypatch):
    rng = random.Random(77)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd", "."]) for _ in range(rng.randrange(60))).encode() for _ in range(50)]
    for some in (texts, [b""], [b"one"], [b"one two."], [b". ;"]):
        packed = collocations.shard_grams(some)
        with monkeypatch.context() as columns:
            columns.setattr(collocations, "RANK_BITS", 0)
            plain = collocations.shard_grams(some)
        assert packed.labels == plain.labels
        assert (packed.ranks == plain.ranks).all() and (packed.weights == plain.weights).all()
        assert packed.ranks.shape == plain.ranks.shape
