"""Mixing sources to target weights by capped water-filling.

A mix takes ``share`` times all words. Each source asks for a part of that in
proportion to its weight, but gives at most ``max_epochs`` passes over itself;
what a capped source cannot give is shared among the others by weight, again
and again until no target is above its cap. Because capping only ever raises
the level ``target / weight`` of the others, the state of that loop is one
number, the water level: each round is one aggregate over the source table.

Inside a source, a target of 1.4 passes is one whole pass and 0.4 of a second.
The fractional pass walks the documents in a seeded random order (a hash of
seed and doc_id) until its words are used up. Where it stops is found by a
radix descent: words are summed by the next ten bits of the order key, only
inside the slot that holds the stopping point, so no source is ever sorted or
gathered, however many documents it has. After that, what a document gives is a
function of its own row and its source's few numbers: one map-side lookup.

Defined cases: a null text has size 0; a null source is a source of its own and
the last in order; documents of size 0 give 0; an empty table gives an empty
result; rows with one doc_id (or none) share an order key, and if the pass stops
among them, a second descent orders them by a hash of their place in the table;
further columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from emporia.llm.common import require, written

# A word is a run of anything but space and tab..carriage return.
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 63
DIGIT_BITS = 10
# A stopping slot with at most this many documents is resolved key by key.
SLOT_ROWS = 256


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, doc_id: str = "doc_id") -> Column:
    """A seeded pseudo-random place of each document, in ``[0, 2**63)``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 1)


def tie_key(seed: int, place: str = "place") -> Column:
    """A seeded pseudo-random order of rows that share an order key, in ``[0, 2**63)``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col(place)), 1)


def sizes_of(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size and place (of the row in the table; the same in each scan of it) of ``docs``."""
    return docs.select(
        *more, "doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("place")
    )


def cycled_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources`` with ``weight``: the given weights dealt in turn, sources in
    code-point order, null last."""
    fields = [*sources.schema.fields, T.StructField("weight", T.DoubleType(), False)]
    dealt = [float(w) for w in weights]
    ranked = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    return sources.sparkSession.createDataFrame(
        ranked.map(lambda x: (*x[0], dealt[x[1] % len(dealt)])), T.StructType(fields)
    )


def water_level(sources: DataFrame, total: float, max_epochs: float) -> float:
    """The level L at which ``sum(min(max_epochs * source_size, L * weight)) = total``
    (infinite if even all caps stay below ``total``)."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = 0.0
    while True:
        full = cap <= F.lit(level) * F.col("weight")
        given, open_weight = sources.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not open_weight:
            return float("inf")
        raised = (total - (given or 0.0)) / open_weight
        if raised <= level:
            return level
        level = raised


def source_plan(
    sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: float, seed: int
) -> DataFrame:
    """One row per source: source_size, target, whole passes, and where its
    fractional pass stops (``stop_key``; among rows with that key ``stop_tie``, null
    if there is one row only; ``stop_words`` for the row there out of ``stop_size``).
    ``sizes`` has doc_id, source, size, place."""
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs")
    )
    sources = written(cycled_weights(per_source, weights), "mix-sources")
    total, most = sources.agg(F.sum("source_size"), F.max("docs")).first()
    level = water_level(sources, (total or 0) * share, max_epochs)
    size = F.col("source_size")
    cap = size * F.lit(float(max_epochs))
    target = cap if level == float("inf") else F.least(cap, F.col("weight") * F.lit(level))
    whole = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")
    state = sources.select("source", "source_size", target.alias("target")).withColumn("whole", whole)
    rest = F.round(F.col("target") - F.col("whole") * size).cast("long")
    state = state.withColumn("rest", rest)
    # A rest rounded up to the whole source is one more pass.
    state = state.withColumn("whole", F.col("whole") + F.when((size > 0) & (F.col("rest") >= size), 1).otherwise(0))
    state = state.withColumn("rest", F.when(F.col("rest") >= size, 0).otherwise(F.col("rest")))
    state = written(state.withColumn("prefix", F.lit(0).cast("long")), "mix-state")

    keyed = sizes.select("source", "size", "place", order_key(seed).alias("key"))
    state = written(_stopping(keyed, state, most or 0), "mix-state")
    stop = state.select(
        "source",
        "source_size",
        "target",
        "whole",
        F.col("prefix").alias("stop_key"),
        F.col("rest").alias("stop_words"),
        F.col("slot_size").alias("stop_size"),
    )
    most = state.agg(F.max("slot_rows")).first()[0] or 0
    if most <= 1:
        return stop.withColumn("stop_tie", F.lit(None).cast("long"))
    tied = state.where("slot_rows > 1").withColumnsRenamed({"prefix": "stop_key"}).withColumn("prefix", F.lit(0).cast("long"))
    among = tied.select(F.col("source").alias("s"), "stop_key")
    rows = keyed.join(among, F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("stop_key")))
    ties = _stopping(rows.select("source", "size", tie_key(seed).alias("key")), tied, most)
    found = ties.select(
        F.col("source").alias("t"), F.col("prefix").alias("stop_tie"), F.col("rest").alias("tie_words"), F.col("slot_size").alias("tie_size")
    )
    met = stop.join(found, F.col("source").eqNullSafe(F.col("t")), "left")
    of_tie = F.col("stop_tie").isNotNull()
    return written(
        met.select(
            "source",
            "source_size",
            "target",
            "whole",
            "stop_key",
            "stop_tie",
            F.when(of_tie, F.col("tie_words")).otherwise(F.col("stop_words")).alias("stop_words"),
            F.when(of_tie, F.col("tie_size")).otherwise(F.col("stop_size")).alias("stop_size"),
        ),
        "mix-plan",
    )


def _stopping(keyed: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """The key (``prefix``) at which each source's rest is used up, by a radix descent.
    ``keyed`` has source, size, key; ``most`` is the largest number of rows of a source in it."""
    bits = 0
    while most > SLOT_ROWS and bits + DIGIT_BITS <= KEY_BITS:
        state = written(_descend(keyed, state, bits, bits + DIGIT_BITS), "mix-state")
        bits += DIGIT_BITS
        most = state.agg(F.max("slot_rows")).first()[0] or 0
    return _descend(keyed, state, bits, KEY_BITS)


def _descend(keyed: DataFrame, state: DataFrame, bits: int, to_bits: int) -> DataFrame:
    """Narrow each source's stopping slot from ``bits`` to ``to_bits`` of the key."""
    inside = keyed.join(
        state.select(F.col("source").alias("s"), F.col("prefix").alias("p")),
        F.col("source").eqNullSafe(F.col("s"))
        & (F.shiftright("key", KEY_BITS - bits) == F.col("p") if bits else F.lit(True)),
    )
    slots = inside.groupBy("s", F.shiftright("key", KEY_BITS - to_bits).alias("slot")).agg(
        F.sum("size").alias("slot_size"), F.count(F.lit(1)).alias("slot_rows")
    )
    # Per source at most 2**DIGIT_BITS slots (or SLOT_ROWS keys) meet here.
    upto = F.sum("slot_size").over(
        Window.partitionBy("s").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        slots.withColumn("upto", upto)
        .join(state.select(F.col("source").alias("s2"), F.col("rest").alias("r")), F.col("s").eqNullSafe(F.col("s2")))
        .where(F.col("upto") > F.col("r"))
        .groupBy("s")
        .agg(F.min_by(F.struct("slot", "slot_size", "slot_rows", "upto"), "slot").alias("f"))
    )
    kept = state.select("source", "source_size", "target", "whole", "rest")
    return kept.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source",
        "source_size",
        "target",
        "whole",
        (F.col("rest") - F.coalesce(F.col("f.upto") - F.col("f.slot_size"), F.lit(0))).alias("rest"),
        F.coalesce("f.slot", F.lit(0)).cast("long").alias("prefix"),
        F.coalesce("f.slot_size", F.lit(0)).cast("long").alias("slot_size"),
        F.coalesce("f.slot_rows", F.lit(0)).cast("long").alias("slot_rows"),
    )


def with_taken(sized: DataFrame, plan: DataFrame, seed: int, whole_documents: bool) -> DataFrame:
    """``sized`` (doc_id, source, size, place, ...) plus source_size, target, taken (words)
    and copies (whole repetitions of the document), without place.

    With ``whole_documents`` the document at which the fractional pass stops is
    taken entirely if at least half of it is due, else not at all.
    """
    require(sized, ("doc_id", "source", "size", "place"))
    own = [F.col(f"d.`{c}`") for c in sized.columns if c != "place"]
    joined = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    key, size = order_key(seed, "d.doc_id"), F.col("d.size")
    part = F.when(
        F.col("p.stop_size") > 0,
        F.floor(F.col("p.stop_words").cast("decimal(38,0)") * size / F.col("p.stop_size")).cast("long"),
    ).otherwise(F.lit(0).cast("long"))
    if whole_documents:
        part = F.when(part * 2 >= size, size).otherwise(F.lit(0).cast("long"))
    tie, stop_tie = tie_key(seed, "d.place"), F.coalesce("p.stop_tie", tie_key(seed, "d.place"))
    before = (key < F.col("p.stop_key")) | ((key == F.col("p.stop_key")) & (tie < stop_tie))
    here = (key == F.col("p.stop_key")) & (tie == stop_tie)
    extra = F.when(before, size).when(here, part).otherwise(F.lit(0))
    extra = F.when((F.col("p.stop_size") > 0) & (size > 0), extra).otherwise(F.lit(0)).cast("long")
    return joined.select(
        *own,
        F.col("p.source_size"),
        F.col("p.target"),
        (F.col("p.whole") * size + extra).alias("taken"),
        (F.col("p.whole") + F.when((size > 0) & (extra == size), 1).otherwise(0)).cast("int").alias("copies"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """Per document of ``docs`` (doc_id, text, source): doc_id, size, source_size,
    target, taken, copies."""
    require(docs, ("doc_id", "text", "source"))
    sizes = written(sizes_of(docs), "mix-sizes")
    plan = source_plan(sizes, weights, share, max_epochs, seed)
    return with_taken(sizes, plan, seed, whole_documents=False).drop("source")


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.0,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the mix takes it, whole
    documents only, same columns. A source is off its target by half of one
    document at most, as long as two scans of ``docs`` deal its rows alike. Documents without words are kept once: they cost no share.
    """
    require(docs, ("doc_id", "text", "source"))
    sizes = written(sizes_of(docs), "mix-sizes")
    plan = source_plan(sizes, weights, share, max_epochs, seed)
    own = [F.col(f"row.`{c}`") for c in docs.columns]
    sized = sizes_of(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = with_taken(sized, plan, seed, whole_documents=True)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies"))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), times))).select(*own)
