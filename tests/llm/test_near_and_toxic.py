"""Near duplicates against brute force; toxicity on planted words; pipeline stages."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from emporia.llm import minhash, toxicity


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(4), []
    for _ in range(40):
        rows.append((len(rows), " ".join(words(rng, 120)), "e"))
    for base in range(6):  # near copies: one or two words changed
        for _ in range(4):
            copy = rows[base][1].split()
            copy[rng.randrange(120)] = "changed"
            rows.append((len(rows), " ".join(copy), "e"))
    shared = " ".join(words(rng, 60))
    for _ in range(15):  # a shared passage, but not near copies
        rows.append((len(rows), shared + " " + " ".join(words(rng, 80)), "e"))
    for text in (rows[20][1], rows[20][1], "", "", None, None, "two words", "two words", "!!!", "???"):
        rows.append((len(rows), text, "e"))
    return spark.createDataFrame(rows, "doc_id long, text string, class_id string")


def test_links_no_pair_lost(spark, docs):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    idf = minhash.idf_table(docs)
    sets = [minhash.weights(r.text or "", idf) for r in rows]
    parent = {r.doc_id: r.doc_id for r in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in rows:
        for b in rows[: a.doc_id]:
            same = a.text == b.text
            x, y = sets[a.doc_id], sets[b.doc_id]
            if same or (len(x[0]) and len(y[0]) and minhash.jaccard(*x, *y) >= minhash.SIMILARITY):
                i, j = sorted((root(a.doc_id), root(b.doc_id)))
                parent[j] = i
    assert got == {r.doc_id: root(r.doc_id) for r in rows}
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_star_of_copies_is_one_class(spark):
    """Copies near the original (0.82) but not near each other (0.69): one class."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(1000)]
    texts = [" ".join(base)]
    for n in range(400):
        copy = list(base)
        for at in rng.sample(range(1000), 20):
            copy[at] = f"c{n}x{at}"
        texts.append(" ".join(copy))
    star = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    idf = minhash.idf_table(star)
    sets = [minhash.weights(t, idf) for t in texts]
    near = [minhash.jaccard(*sets[0], *s) >= minhash.SIMILARITY for s in sets]
    assert sum(near) > 350
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(star).collect()}
    assert {got[i] for i, is_near in enumerate(near) if is_near} == {0}


def test_null_and_repeated_ids_with_other_texts(spark):
    rng = random.Random(12)
    a, b, c, d = (words(rng, 150) for _ in range(4))
    near = [*a[:75], "changed", *a[76:]]
    rows = [(None, a), (None, near), (None, b), (None, b), (7, c), (7, d), (7, c), (9, d), (None, c)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    texts = {" ".join(t): name for t, name in ((a, "a"), (near, "a"), (b, "b"), (c, "c"), (d, "d"))}
    kept = [(r.doc_id, texts[r.text]) for r in minhash.deduplicated(frame).collect()]
    assert sorted(kept, key=lambda x: x[1]) == [(None, "a"), (None, "b"), (7, "c"), (7, "d")]
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size, r.links) for r in minhash.near_duplicates(frame).collect())
    assert got == sorted([(0, 0, 2, 1)] * 2 + [(0, 0, 2, 0)] * 2 + [(7, 7, 3, 0)] * 2 + [(0, 7, 3, 0)] + [(7, 7, 2, 0), (9, 7, 2, 0)])
    assert len({r.class_key for r in minhash.near_duplicates(frame).collect()}) == 4


def test_whole_rows_are_shuffled_once(spark, tmp_path):
    rows = [(1, "one two", "a"), (None, "one two", "b"), (3, None, "c"), (2, None, "d"), (5, "", "e"), (4, "six", "f")]
    spark.createDataFrame(rows, "doc_id long, text string, more string").write.parquet(str(tmp_path / "docs"))
    kept = minhash.deduplicated(spark.read.parquet(str(tmp_path / "docs")))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    # The rows by text, and the keys of those that stay.
    assert plan.count("Exchange hashpartitioning(") == 2, plan
    assert sorted(r.more for r in kept.collect()) == ["a", "d", "e", "f"]


def test_a_text_is_signed_once(spark, tmp_path):
    rows = [(1, "one two"), (None, "one two"), (3, None), (2, None), (5, ""), (4, "six"), (6, "!!!")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    idf = spark.sparkContext.broadcast(np.zeros(1 << minhash.DF_BITS, np.uint8))
    texts = minhash._distinct_texts(spark.read.parquet(str(tmp_path / "docs")), idf)
    # One evaluation: a second one would double the work and the Python workers of each task.
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1, plan
    got = sorted((r.doc_id, r.copies, r.sig is not None) for r in texts.collect())
    assert got == [(1, 2, True), (2, 2, False), (4, 1, True), (5, 1, False), (6, 1, False)]


def test_pair_that_shares_one_band_alone_in_a_large_bucket(spark):
    rng, draw = random.Random(2), np.random.default_rng(2)
    texts = [" ".join(words(rng, 200)) for _ in range(40)]
    texts.append(texts[0] + " end")
    sigs = draw.integers(0, 2**32, (41, minhash.SAMPLES), dtype=np.uint32)
    sigs[:, -minhash.ROWS :] = 5  # all share the last band
    sigs[40] = sigs[0]
    sigs[40, : -minhash.ROWS : minhash.ROWS] += 1  # and these two no other, though most samples agree
    rows = [(i, t, bytearray(s.tobytes())) for i, (t, s) in enumerate(zip(texts, sigs, strict=True))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, sig binary")
    nodes = minhash.written(frame.select(minhash.text_key(frame.text).alias("node"), "doc_id", "sig"), "test-nodes")
    chosen = {bytes(c) for r in minhash._met(minhash._bands(nodes.select("node", "sig"))).collect() for c in r["all"]}
    pair = {bytes(r.node) for r in nodes.where("doc_id in (0, 40)").collect()}
    assert not pair & chosen
    idf = spark.sparkContext.broadcast(minhash.idf_table(frame))
    edges, _ = minhash.links(frame.select("doc_id", "text"), nodes, idf)
    assert [{bytes(r.u), bytes(r.v)} for r in edges.collect()] == [pair]


def test_best_pairs_of_each_and_whether_there_are_more():
    agree = np.array([[40, 64, 31, 50], [32, 0, 0, 0]], np.uint8)
    assert [list(x) for x in minhash._best(agree, 2)[:2]] == [[0, 0, 1], [1, 3, 0]]
    assert minhash._best(agree, 2)[2] and not minhash._best(agree, 3)[2]


def test_slot_weights_bound_the_similarity():
    """No pair that is similar enough is refused, and most that share only a passage are."""
    rng = random.Random(31)
    level = np.random.default_rng(31).integers(0, minhash.IDF_LEVELS, 1 << minhash.DF_BITS).astype(np.uint8)
    base, texts = words(rng, 300), []
    for kept in (300, 295, 290, 280, 270, 240, 220, 200):
        texts += [" ".join(base[:kept] + words(rng, 300 - kept)) for _ in range(6)]
    texts += ["one", "two words", " ".join(["same"] * 400), " ".join(["same"] * 390)]
    sets = [minhash.weights(t, level) for t in texts]
    _, sums = minhash._profiles([minhash._profile(t, level) for t in texts])
    i, j = np.triu_indices(len(texts), 1)
    similar = np.array([minhash.jaccard(*sets[a], *sets[b]) for a, b in zip(i, j)])
    near, found = similar >= minhash.SIMILARITY, minhash.may_be_similar(sums, sums, i, j, minhash.SIMILARITY)
    assert found[near].all() and near.any() and found[~near].mean() < 0.1
    # A text whose slots would overflow has no bound, and is compared.
    h, n = np.arange(1, 5, dtype=np.uint64), np.full(4, 40_000)
    assert minhash.slot_weights(h, n, np.zeros(4, np.int64)) is None
    open_, other = minhash._profiles([b"\0" * minhash.SAMPLES * 4, minhash._profile("two words", level)])[1]
    assert minhash.may_be_similar(open_[None], other[None], np.zeros(1, int), np.zeros(1, int), 0.8).all()


def test_words_are_those_of_the_pattern():
    for text in ("", "İstanbul ß Ünï_code, wörds\tx 1,2 ²½٣", "a b a", "\x1c\x85", "日本 語 😀 e\u0301"):
        found = re.findall(r"\w+", text.lower())
        h = minhash.word_hashes(text).tolist()
        assert len(h) == len(found) and len(set(h)) == len(set(found)) == len(set(zip(found, h)))


def test_shared_passage_makes_few_rows(spark, monkeypatch):
    """Texts alike by a passage (similarity about 0.65) were compared exactly in nearly all pairs, round by round."""
    rng = random.Random(6)
    shared = " ".join(words(rng, 160))
    rows = [(i, f"{shared} {' '.join(words(rng, 45))}") for i in range(120)]
    rows += [(120, rows[0][1] + " end")]
    compared, run = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda *a: compared.append(a[2].count()) or run(*a))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.class_id) for r in got} == {(i, i % 120) for i in range(121)}
    assert len(compared) <= 3 and sum(compared[1:]) < 121


def test_empty_table(spark, docs):
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_samples_agree_as_weighted_jaccard():
    rng = np.random.default_rng(0)
    agreed, expected = [], []
    for _ in range(60):
        h = np.sort(rng.integers(1, 2**63, 200, dtype=np.uint64))
        n1, n2 = rng.integers(1, 6, 150), rng.integers(1, 6, 150)
        level = rng.integers(0, minhash.IDF_LEVELS, 200)
        a, b = (h[:150], n1, level[:150]), (h[50:], n2, level[50:])
        agreed.append((minhash.samples(*a) == minhash.samples(*b)).mean())
        weighted = [x for i, n, lev in (a, b) for x in (i, minhash._weight(n, lev))]
        expected.append(minhash.jaccard(*weighted))
    assert abs(np.mean(agreed) - np.mean(expected)) < 0.03


def test_fold():
    assert toxicity.fold("You 1d10t, l0ser tr@sh! сlоwn 2020").split() == ["you", "idiot", "loser", "trash", "clown", "2020"]
    assert toxicity.fold("").strip() == ""


@pytest.fixture(scope="module")
def labelled(spark):
    rng, docs, labels = random.Random(9), [], []
    for i in range(600):
        text = words(rng, 40)
        toxic = i % 5 == 0
        if toxic:
            text[5], text[20] = rng.choice(["idiot", "l0ser", "scum"]), rng.choice(["moron", "idi0t"])
        docs.append((i, " ".join(text), None))
        labels.append((i, int(toxic)))
    docs += [(9000, None, None), (9001, "", None), (9002, "a clown fish " * 20000, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int"),
    )


def test_toxicity_finds_planted_words(labelled):
    docs, labels = labelled
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == 603 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in held)
    assert len(held) > 60 and right / len(held) > 0.97
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9000].score == by_id[9001].score < 0.5 and by_id[9002].predicted == 0


def test_exception_phrases_and_no_labels(labelled):
    docs, labels = labelled
    model = toxicity.Model((("clown", 4.0),))
    assert toxicity.features("what a clown", model)[0] > 0
    assert toxicity.features("a clown fish swims", model) == (0.0, 0.0)
    rows = toxicity.scored(docs, labels.limit(0)).collect()
    assert len({r.score for r in rows}) == 1 and all(r.predicted == 0 for r in rows)
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_pipeline_on_small_table(spark):
    import corpus_pipeline as pipeline

    out = pipeline.run(spark, "/root/testdata/sf0.001")
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.columns == [*source.columns, "ids", "n_tokens", "decoded"]
    rows = out.collect()
    assert rows and all(r.decoded == r.text and r.n_tokens == len(r.ids) for r in rows)
    assert {r.doc_id for r in rows} <= {r.doc_id for r in source.select("doc_id").collect()}
