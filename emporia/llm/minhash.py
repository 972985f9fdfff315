"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five lower-cased words (a shorter text is one
shingle). A shingle weighs its count in the text times a damped inverse document
frequency, in [1, 1 + 1/DAMPING] and rounded to one of IDF_LEVELS steps, so that passages many documents share count
less but a group of near copies, however large, still sees itself as similar.
Document frequencies cover all documents: they are counted in 2**DF_BITS hash
slots, less the slots' mean load, summed per task first, so the table has one
bounded size. In a corpus with thousands of shingles a slot, collisions make the levels
of rare shingles uneven, within the damping.

Each of SAMPLES consistent weighted samples of two texts agrees with the
probability of their weighted Jaccard similarity. ROWS samples make a band.
Texts that share a band are candidates: in each bucket up to CHOSEN members, the first by
hashes that are the same in all buckets, are compared with all others (first by their samples, then by a bound,
then exactly, by the weighted Jaccard similarity of their shingles). The bound: each text's weights are summed in
BOUND_SLOTS hash slots, and two texts share at most the sum of the smaller slots. It never refuses a similar pair,
and spares texts that share only a passage the exact comparison. Members similar to one are linked
but stay: in buckets whose other members are not all in one component of the links yet, those outside the
largest component meet all members, in tiles of bounded size. Each emits the pairs across components that the
bound allows and that agree in most samples, OFFERED of them for a member at first and MORE_OFFERED times as many each
round, and they are compared exactly. So a large group does not emit all its pairs, and the rounds end only when every pair of every
bucket has been compared or is in one component. Classes are the connected components of the links.

Exact copies are one text from the start: texts are keyed by their digest, and
copies only counted. A text that is chosen by thousands is joined by salted key.

Two texts at similarity 0.8 share no band with probability 2e-4 (at 0.9: 7e-8), and agree in too few
samples to be compared exactly with probability 1e-8. No other pair is left out.

Defined cases: null and empty texts, and texts without words, are copies only of
equal texts (null equals null); very long texts are read whole; repeated rows
share a class; a class is known by its class_key (the smallest text key in it) and named by its smallest
doc_id, null if it has none, so classes may share a name where ids repeat or are null; of each class one
row stays, whatever its id; an empty table gives an empty result; further columns pass through unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emporia.llm.common import Slots, give_back, in_slices, require, text_or_empty, written
from emporia.llm.components import connected_components

WORDS_PER_SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
# Members of a bucket that are compared with all others in one round.
CHOSEN = 4
# Pairs that a member outside its bucket's largest component offers in the first round, and how many times as many in the next.
OFFERED, MORE_OFFERED = 64, 16
SAMPLES = BANDS * ROWS
DF_BITS = 18
DAMPING = 4.0
IDF_LEVELS = 9
# Counts up to this one have their draws ready in a table.
READY_COUNTS = 3
# Pairs that agree in fewer samples are not compared exactly: at similarity 0.8,
# 64 samples give 31 or fewer agreements with probability 1e-8.
LEAST_AGREEING = 32
SALT_ROWS = 128
TABLE_BITS = 14
SLICE = 1024
# Members of a bucket in a tile, on either side; members of small buckets in one group.
TILE_ROWS = 2048
GROUP_ROWS = 1024
# Weights of a text's shingles are summed in so many slots, for a bound on its similarity to others.
BOUND_SLOTS = 256
NO_BOUND = 0xFFFF
# Units of a weight: n * (1 + level / UNITS) is a whole number of them.
UNITS = round((IDF_LEVELS - 1) * DAMPING)
# Pairs whose bounds are taken at once; texts whose weights are held.
BOUND_PAIRS = 8192
KNOWN_TEXTS = 64
_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**63, SAMPLES + WORDS_PER_SHINGLE, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def _word_letters() -> np.ndarray:
    """Which code points are word characters, as in the pattern ``\\w``."""
    return np.fromiter((chr(c).isalnum() or c == 0x5F for c in range(0x110000)), bool, 0x110000)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased words of a text, in order: sums over their letters, each mixed with its place."""
    letters = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(letters) + 2, bool)
    np.take(_word_letters(), letters, out=inside[1:-1], mode="clip")
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return np.empty(0, np.uint64)
    length = edges[1::2] - edges[::2]
    first = np.cumsum(length) - length
    h = letters[inside[1:-1]].astype(np.uint64)
    h *= _MULTIPLIERS[0]
    place = np.arange(len(h)) - np.repeat(first, length)
    h += place.view(np.uint64) * _MULTIPLIERS[1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = np.add.reduceat(h, first)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of a text's shingles, and their counts."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = max(1, len(h) - WORDS_PER_SHINGLE + 1)
    mixed = h[:n] * _MULTIPLIERS[SAMPLES]
    for i in range(1, min(WORDS_PER_SHINGLE, len(h))):
        mixed += h[i : i + n] * _MULTIPLIERS[SAMPLES + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(mixed[1:], mixed[:-1], out=new[1:])
    if new.all():
        return mixed, np.ones(n, np.int64)
    first = np.flatnonzero(new)
    return mixed[first], np.diff(first, append=n)


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - DF_BITS)).astype(np.int64)


def idf_table(docs: DataFrame) -> np.ndarray:
    """The idf level of each slot, from all rows of ``docs`` (text)."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, rows = np.zeros(1 << DF_BITS, np.int64), 0
        for part in parts:
            rows += len(part)
            for at in range(0, len(part), SLICE):
                found = [_slots(shingles(text)[0]) for (text,) in in_slices(part["text"].slice(at, SLICE))]
                slots += np.bincount(np.concatenate(found), minlength=len(slots))
        part = found = None
        give_back()
        used = np.flatnonzero(slots)
        columns = [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(slots[used], rows), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "n"])

    counted = docs.select(text_or_empty().alias("text")).mapInArrow(count, "slot long, n long")
    found = counted.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # at most 2**DF_BITS + 1 rows
    slots, rows = np.zeros(1 << DF_BITS), max(1, int(found.n[found.slot == -1].sum()))
    inside = found[found.slot >= 0]
    slots[inside.slot.to_numpy(dtype=np.int64)] = inside.n.to_numpy(dtype=np.float64)
    df = np.maximum(1.0, slots - slots.mean())
    return np.rint(np.log1p(rows / df) / np.log1p(rows) * (IDF_LEVELS - 1)).clip(0, IDF_LEVELS - 1).astype(np.uint8)


def _weight(n: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The weight of shingles with these counts and idf levels."""
    return n * (1 + level / ((IDF_LEVELS - 1) * DAMPING))


def weights(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, n = shingles(text)
    return h, _weight(n, idf[_slots(h)])


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of the scheme's random draws: r and log c of Gamma(2, 1), beta uniform."""
    rng = np.random.default_rng(11)
    size = 1 << TABLE_BITS
    r, log_c, beta = rng.gamma(2.0, 1.0, size), np.log(rng.gamma(2.0, 1.0, size)), rng.random(size)
    return r.astype(np.float32), log_c.astype(np.float32), beta.astype(np.float32)


def _drawn(key: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log a, t) of the scheme for draws ``key`` at weights ``w``."""
    r_of, log_c_of, beta_of = _draws()
    r, beta = r_of.take(key), beta_of.take(key)
    t = np.floor(np.log(w).astype(np.float32) / r + beta)
    return log_c_of.take(key) - r * (t - beta + np.float32(1.0)), t.astype(np.int32)


@lru_cache(maxsize=1)
def _ready() -> tuple[np.ndarray, np.ndarray]:
    """(log a, t) of every draw at every idf level, for counts up to READY_COUNTS."""
    n, level = np.divmod(np.arange(READY_COUNTS * IDF_LEVELS), IDF_LEVELS)
    key = np.tile(np.arange(1 << TABLE_BITS), len(n))
    return _drawn(key, np.repeat(_weight(n + 1, level), 1 << TABLE_BITS))


@lru_cache(maxsize=1)
def _room() -> tuple[np.ndarray, np.ndarray]:
    """Memory for the keys and draws of one slice, used again by the next."""
    return np.empty(SAMPLES * SLICE, np.uint64), np.empty(SAMPLES * SLICE, np.float32)


def samples(h: np.ndarray, n: np.ndarray, level: np.ndarray) -> np.ndarray:
    """SAMPLES consistent weighted samples (uint32) of a non-empty set of shingles with
    their counts and idf levels."""
    ready_log_a, ready_t = _ready()
    best = np.full(SAMPLES, np.inf, np.float32)
    out = np.zeros(SAMPLES, np.uint64)
    columns = np.arange(SAMPLES)
    keys, logs = _room()

    def least_of(log_a: np.ndarray, some: np.ndarray, t: np.ndarray, at: np.ndarray | None = None) -> None:
        at_least = log_a.argmin(axis=1)
        least = log_a[columns, at_least]
        step = t[columns, at_least] if at is None else t[at[columns, at_least]]
        drawn = some[at_least] + step.astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        better = least < best
        np.copyto(best, least, where=better)
        np.copyto(out, drawn, where=better)

    def key_of(some: np.ndarray) -> np.ndarray:
        key = keys[: SAMPLES * len(some)].reshape(SAMPLES, len(some))
        np.multiply(_MULTIPLIERS[:SAMPLES, None], some, out=key)
        np.right_shift(key, np.uint64(64 - TABLE_BITS), out=key)
        return key.view(np.int64)

    if n.max() > READY_COUNTS:
        rare = n > READY_COUNTS
        some, weight = h[rare], _weight(n[rare], level[rare])
        for at in range(0, len(some), SLICE):
            log_a, t = _drawn(key_of(some[at : at + SLICE]), weight[at : at + SLICE])
            least_of(log_a, some[at : at + SLICE], t)
        h, n, level = h[~rare], n[~rare], level[~rare]
    place = ((n - 1) * IDF_LEVELS + level) << TABLE_BITS
    for at in range(0, len(h), SLICE):
        some = h[at : at + SLICE]
        key = key_of(some)
        key += place[at : at + SLICE]
        # All keys are inside the table; "clip" only saves the copy that "raise" makes.
        log_a = np.take(ready_log_a, key, out=logs[: key.size].reshape(key.shape), mode="clip")
        least_of(log_a, some, ready_t, key)
    return ((out * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def slot_weights(h: np.ndarray, n: np.ndarray, level: np.ndarray) -> np.ndarray | None:
    """The weights (in units of 1 / UNITS) of shingles summed in BOUND_SLOTS slots, None if one is too large."""
    sums = np.bincount((h & np.uint64(BOUND_SLOTS - 1)).view(np.int64), n * (UNITS + level), BOUND_SLOTS)
    return sums.astype(np.uint16) if sums.max(initial=0) < NO_BOUND else None


def _profile(text: str, table: np.ndarray) -> bytes | None:
    """The samples of a text, then its slot weights; None without words."""
    h, n = shingles(text)
    if not len(h):
        return None
    level = table[_slots(h)].astype(np.int64)
    sums = slot_weights(h, n, level)
    return samples(h, n, level).tobytes() + (b"" if sums is None else sums.tobytes())


def _profiles(sigs) -> tuple[np.ndarray, np.ndarray]:
    """(samples, slot weights) of profiles, a row each; NO_BOUND in all slots where there are none."""
    size = SAMPLES * 4 + BOUND_SLOTS * 2
    rows = np.frombuffer(b"".join([s.ljust(size, b"\xff") for s in sigs]), np.uint8).reshape(-1, size)
    split = SAMPLES * 4
    return np.ascontiguousarray(rows[:, :split]).view(np.uint32), np.ascontiguousarray(rows[:, split:]).view(np.uint16)


def may_be_similar(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether rows ``i`` of ``a`` and ``j`` of ``b`` (slot weights) can reach ``similarity``. What two texts share
    weighs at most the sum of the smaller slots, so no pair that reaches it is ever left out."""
    whole_a, whole_b = (x.sum(axis=1, dtype=np.int64) for x in (a, b))
    open_a, open_b = a[:, 0] == NO_BOUND, b[:, 0] == NO_BOUND
    out = np.empty(len(i), bool)
    for at in range(0, len(i), BOUND_PAIRS):
        x, y = i[at : at + BOUND_PAIRS], j[at : at + BOUND_PAIRS]
        shared = np.minimum(a[x], b[y]).sum(axis=1, dtype=np.int64)
        total = whole_a[x] + whole_b[y] - shared
        out[at : at + BOUND_PAIRS] = (shared >= similarity * total * (1 - 1e-12)) | open_a[x] | open_b[y]
    return out


def text_key(text: Column) -> Column:
    """The key of a text: equal texts, and only they, share it."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit("null").cast("binary"))


def _signatures(docs: DataFrame, idf) -> DataFrame:
    """(node, sig) of each row whose text has words."""

    @F.arrow_udf("binary")
    def sign(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = idf.value
        for texts in parts:
            done: dict[bytes, bytes | None] = {}
            out = []
            for (text,) in in_slices(texts):
                # Known by digest: the texts themselves are not held.
                key = hashlib.sha256(text.encode("utf-8")).digest()
                if key not in done:
                    done[key] = _profile(text, table)
                out.append(done[key])
            yield pa.array(out, pa.binary())
        texts = done = out = None
        give_back()

    return docs.select(text_key(F.col("text")).alias("node"), sign(text_or_empty()).alias("sig"))


def _distinct_texts(docs: DataFrame, idf) -> DataFrame:
    """(node, doc_id, copies, sig): one row for each distinct text of ``docs`` (doc_id, text)."""
    ids = docs.select(text_key(F.col("text")).alias("node"), "doc_id")
    counted = ids.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    # No filter on sig here: Spark would put it below the projection and sign every text twice,
    # in two Python workers of each task. The least sig leaves nulls out anyway.
    signed = _signatures(docs.select("text"), idf).groupBy("node").agg(F.min("sig").alias("sig"))
    return counted.join(signed, "node", "left")


def _bands(signed: DataFrame) -> DataFrame:
    """(node, band, key) for the bands of each node."""
    step = ROWS * 4
    return signed.select(
        "node",
        F.posexplode(F.array(*[F.xxhash64(F.substring("sig", b * step + 1, step)) for b in range(BANDS)])).alias(
            "band", "key"
        ),
    )


def _may_link(a: Column, b: Column, similarity: float) -> Column:
    """Whether two texts agree in LEAST_AGREEING samples, and their slot weights allow the similarity."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        (left, a), (right, b) = _profiles(x), _profiles(y)
        near = (left == right).sum(axis=1) >= LEAST_AGREEING
        at = np.flatnonzero(near)
        near[at] = may_be_similar(a, b, at, at, similarity)
        return pd.Series(near)

    return run(a, b)


def _similarity(text_a: Column, text_b: Column, idf) -> Column:
    """Weighted Jaccard similarity of two texts."""

    @F.arrow_udf("double")
    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        table = idf.value
        for left, right in parts:
            known: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # the last chosen texts
            out = []
            for a, b in in_slices(left, right):
                if b not in known:
                    if len(known) == KNOWN_TEXTS:
                        known.clear()
                    known[b] = weights(b, table)
                out.append(jaccard(*weights(a, table), *known[b]))
            yield pa.array(out, pa.float64())
        left = right = known = None
        give_back()

    return run(text_a, text_b)


def jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    _, i, j = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    shared = float(np.minimum(w1[i], w2[j]).sum())
    total = float(w1.sum() + w2.sum()) - shared
    return shared / total if total else 0.0


def _salted(pairs: DataFrame, chosen: DataFrame, hash_of: str = "node") -> DataFrame:
    """``pairs`` (node, chosen, ...) joined with ``chosen`` (chosen, ...): a row chosen by
    many is repeated once per SALT_ROWS of them, and they are dealt among its copies."""
    uses = pairs.groupBy("chosen").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    copies = chosen.join(uses, "chosen").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    dealt = pairs.join(uses, "chosen").withColumn("salt", F.pmod(F.xxhash64(hash_of), F.col("salts")).cast("int"))
    return dealt.drop("salts").join(copies.drop("salts"), ["chosen", "salt"]).drop("salt")


def _met(members: DataFrame) -> DataFrame:
    """``members`` (node, band, key) of buckets with two or more, with ``all`` the
    bucket's chosen nodes. The order that chooses is the
    same in all buckets, so the buckets of one group choose few different members."""
    least = [F.min(F.struct(F.xxhash64("node", F.lit(c)).alias("o"), "node"))["node"] for c in range(CHOSEN)]
    buckets = (
        members.groupBy("band", "key")
        .agg(F.array_distinct(F.array(*least)).alias("all"), F.max("node").alias("z"), F.min("node").alias("a"))
        .where("a <> z")
        .select("band", "key", "all")
    )
    return members.join(written(buckets, "minhash-buckets"), ["band", "key"])


def _best(agree: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places in ``agree`` (asked, rows) of at least LEAST_AGREEING, of each asked the
    ``limit`` highest, and whether there are more."""
    near = agree >= LEAST_AGREEING
    more = np.flatnonzero(near.sum(axis=1) > limit)
    for i in more:
        at = np.flatnonzero(near[i])
        near[i, at[np.argsort(-agree[i, at].astype(np.int64), kind="stable")[limit:]]] = False
    return *np.nonzero(near), len(more) > 0


def _across(
    rest: DataFrame, parts: DataFrame, signed: DataFrame, limit: int, similarity: float, members: Slots, opened: Slots
) -> DataFrame | None:
    """(node, chosen): pairs of ``rest`` (node, band, key) that share a bucket but no
    component (``parts``), agree in LEAST_AGREEING samples and may be similar by their slot weights; in a tile at most the ``limit`` best for each node
    outside the bucket's largest component. A row of nulls says that there are more. None if no bucket is open."""
    own = rest.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = members.written(own)
    counted = own.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"))
    buckets = counted.groupBy("band", "key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main"))
    buckets = opened.written(
        buckets.where("n > main.n").select(
            "band",
            "key",
            "n",
            F.col("main.component").alias("main"),
            F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("chunks"),
            F.ceil((F.col("n") - F.col("main.n")) / TILE_ROWS).cast("int").alias("blocks"),
        )
    )
    rows = buckets.agg(F.sum("n")).first()[0]
    if not rows:
        return None
    groups = -(-rows // GROUP_ROWS)
    dealt = own.join(buckets, ["band", "key"]).withColumn("late", F.col("component") != F.col("main"))
    dealt = dealt.join(signed, "node").select("node", "component", "sig", "band", "key", "chunks", "blocks", "late")

    def copies(frame: DataFrame, asked: bool, own_place: str, n: str, other: str, m: str) -> DataFrame:
        return (
            frame.withColumn(own_place, F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(m) - 1)))
            .select("node", "component", "sig", "band", "key", "chunks", "blocks", "late", "chunk", "block", F.lit(asked).alias("asked"))
        )

    both = copies(dealt, False, "chunk", "chunks", "block", "blocks").union(
        copies(dealt.where("late"), True, "block", "blocks", "chunk", "chunks")
    )
    bucket = F.xxhash64("band", "key", "chunk", "block")
    small = F.col("chunks") * F.col("blocks") == 1
    both = both.select(
        "node", "component", "sig", "band", "key", "chunk", "block", "late", "asked",
        # Large buckets have groups of their own, small ones share theirs.
        F.when(small, F.pmod(bucket, F.lit(groups))).otherwise(bucket).alias("tile"),
    )

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["band", "key", "chunk", "block", "asked", "node"], kind="stable")
        sig, sums = _profiles(rows["sig"])
        node, names = pd.factorize(rows["node"], sort=True)
        component = pd.factorize(rows["component"])[0]
        late, asked = rows["late"].to_numpy(dtype=bool), rows["asked"].to_numpy(dtype=bool)
        place = rows[["band", "key", "chunk", "block"]].to_numpy(dtype=np.int64)
        starts = np.flatnonzero(np.append(True, (place[1:] != place[:-1]).any(axis=1)))
        out, cut = [], False
        for start, end in zip(starts, np.append(starts[1:], len(rows)), strict=True):
            first = start + int(np.count_nonzero(~asked[start:end]))
            one, two = slice(first, end), slice(start, first)
            agree = np.zeros((end - first, first - start), np.uint8)
            for left, right in zip(sig[one].T, sig[two].T, strict=True):
                agree += left[:, None] == right[None, :]
            # Two that are both outside the largest component meet twice: once is enough.
            twice = late[None, two] & (node[one, None] < node[None, two])
            agree[twice | (component[one, None] == component[None, two])] = 0
            i, j = np.nonzero(agree >= LEAST_AGREEING)
            no = ~may_be_similar(sums[one], sums[two], i, j, similarity)
            agree[i[no], j[no]] = 0
            i, j, more = _best(agree, limit)
            cut |= more
            out.append(np.column_stack([node[one][i], node[two][j]]))
        pairs = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
        found = pd.DataFrame({"node": names[pairs[:, 1]], "chosen": names[pairs[:, 0]]}, dtype=object)
        return pd.concat([found, pd.DataFrame({"node": [None], "chosen": [None]})]) if cut else found

    return both.groupBy("tile").applyInPandas(tile, "node binary, chosen binary")


def _compared(whole: DataFrame, signed: DataFrame, pairs: DataFrame, idf, similarity: float, kept: Slots) -> DataFrame:
    """The pairs (node, chosen) whose texts are similar: by samples and slot weights first, then exactly."""
    both = pairs.join(signed.withColumnRenamed("sig", "sig_a"), "node")
    both = _salted(both, signed.select(F.col("node").alias("chosen"), F.col("sig").alias("sig_b")))
    near = both.where(_may_link(F.col("sig_a"), F.col("sig_b"), similarity))
    near = kept.written(near.select("node", "chosen"))
    needed = near.select("node").union(near.select("chosen")).distinct()
    texts = kept.written(whole.join(needed, "node", "left_semi"))
    compared = near.join(texts.withColumnRenamed("text", "text_a"), "node")
    compared = _salted(compared, texts.select(F.col("node").alias("chosen"), F.col("text").alias("text_b")))
    checked = compared.select("node", "chosen", _similarity(F.col("text_a"), F.col("text_b"), idf).alias("similarity"))
    return written(checked.where(F.col("similarity") >= similarity).select("node", "chosen"), "minhash-links")


def _united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def links(docs: DataFrame, texts: DataFrame, idf, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(u, v): links between text keys, and (node, component) of the linked ones. ``texts``
    (node, doc_id, sig) has one row per distinct text with words, and one of its rows' doc_id."""
    met = written(_met(_bands(texts.select("node", "sig"))), "minhash-met")
    # All later steps read the members of buckets only, in two tables that are written once.
    members = texts.join(met.select("node").distinct(), "node", "left_semi")
    signed = written(members.select("node", "sig"), "minhash-members")
    # Copies go before the shuffle, and the join needs no other: each distinct text moves once.
    whole = docs.select(text_key(F.col("text")).alias("node"), "text").dropDuplicates(["node"])
    whole = written(whole.join(signed.select("node"), "node", "left_semi"), "minhash-texts")
    pairs = met.select("node", F.explode("all").alias("chosen")).where("node <> chosen")
    pairs = pairs.select(F.greatest("node", "chosen").alias("node"), F.least("node", "chosen").alias("chosen")).distinct()
    tried = [written(pairs, "minhash-pairs")]
    spark = docs.sparkSession
    checks = Slots(spark, "minhash-checked", 2)
    found = [_compared(whole, signed, tried[0], idf, similarity, checks)]

    def edges() -> DataFrame:
        return _united(found).select(F.col("node").alias("u"), F.col("chosen").alias("v"))

    parts = written(connected_components(edges()), "minhash-components")
    # The chosen have met all others of their buckets.
    rest = met.where(~F.array_contains("all", F.col("node"))).select("node", "band", "key")
    limit, more = OFFERED, True
    members, opened, crossed, united = (Slots(spark, f"minhash-{n}", 1) for n in ("own", "open", "across", "components"))
    while more:
        across = _across(rest, parts, signed, limit, similarity, members, opened)
        if across is None:
            break
        across = crossed.written(across)
        more = not across.where("node is null").isEmpty()
        pairs = across.where("node is not null").distinct().join(_united(tried), ["node", "chosen"], "left_anti")
        pairs = written(pairs, "minhash-pairs")
        if not pairs.isEmpty():
            tried.append(pairs)
            new = _compared(whole, signed, pairs, idf, similarity, checks)
            if not new.isEmpty():
                found.append(new)
                # The components so far are stars: only what the new links unite is left to do.
                stars = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
                more_edges = stars.union(new.select(F.col("node").alias("u"), F.col("chosen").alias("v")))
                parts = united.written(connected_components(more_edges))
        limit *= MORE_OFFERED
    return edges(), parts


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, doc_id, class_key, class_id, class_size, links, stays): for each distinct text one of its
    rows' doc_id, its class (known by the smallest node, named by the smallest doc_id), the class's
    documents, the text's links to others, and whether it stays of its class."""
    require(docs, ("doc_id", "text"))
    idf = docs.sparkSession.sparkContext.broadcast(idf_table(docs))
    texts = written(_distinct_texts(docs, idf), "minhash-nodes")
    edges, parts = links(docs, texts.where("sig is not null"), idf, similarity)
    edges = written(edges, "minhash-edges")
    degree = edges.select("u").union(edges.select("v")).groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("links"))
    grouped = texts.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(grouped.join(degree, "node", "left").select("node", "doc_id", "copies", "component", "links"), "minhash-grouped")
    # The smallest doc_id, nulls last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node"))
    sizes = named.groupBy("component").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    return written(
        named.join(sizes, "component").select(
            "node",
            "doc_id",
            F.lower(F.hex("component")).alias("class_key"),
            F.col("first.doc_id").alias("class_id"),
            "class_size",
            F.coalesce("links", F.lit(0)).cast("long").alias("links"),
            (F.col("node") == F.col("first.node")).alias("stays"),
        ),
        "minhash-classes",
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, class_id, class_size, links, class_key."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("node"))
    found = classes(docs, similarity).select("node", "class_id", "class_size", "links", "class_key")
    return rows.join(found, "node").select("doc_id", "class_id", "class_size", "links", "class_key")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row with its smallest doc_id."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    keep = classes(docs, similarity).where("stays").select(F.col("node").alias("__key"))
    # One row of each text, with its smallest doc_id. The rows are dealt once, by text: the other
    # copies go before that, and the join finds them in place.
    first = Window.partitionBy("__key").orderBy(F.col("doc_id").asc_nulls_last())
    rows = docs.withColumn("__key", text_key(F.col("text"))).withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return rows.join(keep, "__key", "left_semi").select(*own)
