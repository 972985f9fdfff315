"""Secret scans in built-in expressions only: known key shapes, and strings of high entropy.

Base kinds (``assign``, ``access``, ``hex``) are leftmost, non-overlapping
matches of a pattern; a match whose value is too short is dropped *after*
matching, so it still consumes its text. ``entropy`` adds candidate strings
(runs of token characters) in which a sliding window holds too much Shannon
entropy for its character class. The window is not recounted at each step: the
sum of ``c * log2(c)`` over its characters' counts changes only by the incoming
and the outgoing character, so a step looks at two counts. Known harmless shapes are
allowed: a run that is a UUID, a number, or a path of slugs as a whole gives no
span; placeholder words and alphabets are only cut out of a run, and runs of
letters are judged by their pieces between separators, so that harmless text
beside a secret does not hide it.

Everything stays in one row: positions are running sums over the pieces between
matches, in chunks, so a text with very many matches is not quadratic, and a
very long candidate is scanned in overlapping blocks. No shuffle, no Python.

Defined cases: a null or empty text has no spans; spans count code points, end
exclusive; repeated rows give repeated results; an empty table gives an empty
result; further columns are not read (``scan``) or pass through (``redacted``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import require, text_or_empty

# The base kinds' patterns and least lengths.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LONG_HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")

# Entropy scan: runs of at least WINDOW token characters; bits per character at
# which a window is suspicious, by the run's character class.
WINDOW = 20
TOKEN_RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
MIN_BITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.7}
# Harmless shapes of a whole run, never reported by the entropy scan.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9_=+/-]+$",  # numbers, dates, rules
    r"^(/?[a-z]+[0-9]{0,4})([_/-][a-z]+[0-9]{0,4})+/?$",  # slugs and paths
)
# Harmless parts of a run; what is left beside them is scanned.
CUT = r"(?i)example|placeholder|changeme|dummy|lorem|x{4,}|0123456789|abcdefgh(?:ijklmnopqrstuvwxyz)?"
# Runs of letters (words, snake case, paths of words) are scanned between separators.
LETTERS, SEPARATORS = r"^[A-Za-z_=+/-]+$", r"[_=+/-]"

_CHUNK = 256
_SPANS = "array<struct<start:bigint,end:bigint,hit:string>>"


def _pieces(text: Column, pattern: str) -> Column:
    """Array of chunks of (gap, hit): the text before each match, and the match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        hits,
        lambda g, h: F.struct(F.length(g).cast("long").alias("gap"), h.alias("hit")),
    )
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / _CHUNK).cast("int")),
        lambda k: F.slice(steps, k * _CHUNK + 1, _CHUNK),
    )
    none = F.array().cast("array<array<struct<gap:bigint,hit:string>>>")
    return F.when(text.rlike(pattern), chunks).otherwise(none)


def _located(chunks: Column) -> Column:
    """Spans (start, end, hit) of the chunks' matches, by running sums."""

    def step(x: Column) -> Column:
        return x["gap"] + F.length(x["hit"])

    def in_chunk(chunk: Column, base: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(base.alias("at"), F.array().cast(_SPANS).alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + step(x)).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + step(x)).alias("end"),
                            x["hit"].alias("hit"),
                        )
                    ),
                ).alias("out"),
            ),
            lambda acc: acc["out"],
        )

    zero = F.lit(0).cast("long")
    bases = F.aggregate(
        chunks,
        F.array(zero),
        lambda acc, c: F.concat(
            acc,
            F.array(F.element_at(acc, -1) + F.aggregate(c, zero, lambda a, x: a + step(x))),
        ),
    )
    return F.flatten(F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), in_chunk))


def _gained(n: Column) -> Column:
    """How much ``c * log2(c)`` grows from a count ``c = n`` to ``n + 1``."""
    grown = [(c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)]
    return F.get(F.array(*[F.lit(g) for g in grown]), n)


def _reaches(block: Column, bits: Column) -> Column:
    """Whether some WINDOW-wide window of ``block`` has an entropy of ``bits`` a character or more.

    The sum of ``c * log2(c)`` over a window's counts follows from the one before it
    by the character that comes and the one that goes. Once a window reaches ``bits``
    the rest is not looked at.
    """

    def step(seen: Column, i: Column) -> Column:
        new, old = F.substr(block, i, F.lit(1)), F.substr(block, i - WINDOW, F.lit(1))
        held = F.least(i - 1, F.lit(WINDOW))
        before = F.substr(block, i - held, held)  # the window that ends just before i
        count_in = held - F.length(F.replace(before, new, F.lit("")))
        count_out = F.lit(WINDOW) - F.length(F.replace(before, old, F.lit(""))) + F.when(old == new, 1).otherwise(0)
        s = seen["s"] + _gained(count_in) - F.when(i > WINDOW, _gained(count_out - 1)).otherwise(F.lit(0.0))
        return F.when(seen["hit"], seen).otherwise(F.struct(s.alias("s"), ((i >= WINDOW) & (s <= most)).alias("hit")))

    most = F.lit(WINDOW * math.log2(WINDOW) + 1e-9) - bits * WINDOW
    start = F.struct(F.lit(0.0).alias("s"), F.lit(False).alias("hit"))
    return F.aggregate(F.sequence(F.lit(1), F.length(block)), start, step, lambda seen: seen["hit"])


def high_entropy(run: Column, bits: Column) -> Column:
    """Whether some window of ``run`` reaches ``bits`` (no, if it is shorter than a window).

    Long runs are scanned in overlapping blocks; one with too few different
    characters to reach ``bits`` is passed over.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.length(run) - WINDOW, F.lit(0)) / _CHUNK).cast("int")),
        lambda k: F.substr(run, k * _CHUNK + 1, F.lit(_CHUNK + WINDOW - 1)),
    )
    different = lambda block: F.size(F.array_distinct(F.split(block, "")))
    return F.exists(blocks, lambda b: F.when(F.log2(different(b)) + 1e-9 < bits, F.lit(False)).otherwise(_reaches(b, bits)))


def suspicious(run: Column) -> Column:
    """Whether a run of token characters looks like a secret."""
    allowed = F.lit(False)
    for shape in ALLOWED:
        allowed = allowed | run.rlike(shape)
    left = F.regexp_replace(run, CUT, " ")
    pieces = F.when(run.rlike(LETTERS), F.split(left, f" |{SEPARATORS}")).otherwise(F.split(left, " "))

    def secret(piece: Column) -> Column:
        bits = F.when(piece.rlike("^[0-9a-fA-F]+$"), MIN_BITS["hex"])
        bits = bits.when(piece.rlike("^[A-Za-z0-9]+$"), MIN_BITS["alnum"]).otherwise(MIN_BITS["base64"])
        return F.when(F.length(piece) < WINDOW, F.lit(False)).otherwise(high_entropy(piece, bits))

    return F.when(allowed, F.lit(False)).otherwise(F.exists(pieces, secret))


def _of_kind(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``base_spans`` and ``entropy_spans``: arrays of (start, rank,
    end, kind), sorted by start, then kind in the order of KINDS."""
    require(docs, ("text",))
    text = text_or_empty()
    df = docs.withColumns(
        {
            "__assign": _pieces(text, ASSIGN),
            "__access": _pieces(text, ACCESS),
            # A maximal run of 24 or more is a match of HEX long enough, and no other is.
            "__hex": _pieces(text, LONG_HEX),
            "__run": _pieces(text, TOKEN_RUN),
        }
    )
    found = {k: _located(F.col(f"__{k}")) for k in ("assign", "access", "hex", "run")}
    df = df.withColumns({f"__{k}": v for k, v in found.items()})
    value = lambda s: F.regexp_extract(s["hit"], ASSIGN, 2)
    kept = {
        "assign": F.filter("__assign", lambda s: F.length(value(s)) >= LEAST_ASSIGN),
        "access": F.filter("__access", lambda s: s["end"] - s["start"] >= LEAST_ACCESS),
        "hex": F.filter("__hex", lambda s: s["end"] - s["start"] >= LEAST_HEX),
    }
    base = F.array_sort(F.concat(*[_of_kind(k, v) for k, v in kept.items()]))
    more = F.array_sort(_of_kind("entropy", F.filter("__run", lambda s: suspicious(s["hit"]))))
    return df.withColumns({"base_spans": base, "entropy_spans": more}).drop(
        "__assign", "__access", "__hex", "__run"
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, base_spans, entropy_spans, and
    ``findings``, both in one sorted array."""
    require(docs, ("doc_id", "text"))
    found = with_spans(docs.select("doc_id", "text"))
    return found.select(
        "doc_id",
        "base_spans",
        "entropy_spans",
        F.array_sort(F.concat("base_spans", "entropy_spans")).alias("findings"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlaps merged) of its text replaced by ``mark``.

    Texts without spans, null ones too, stay as they are; ``n_chars``, where
    there is one, follows the new text.
    """
    require(docs, ("text",))
    text = F.col("text")
    found = with_spans(docs).withColumn("__all", F.array_sort(F.concat("base_spans", "entropy_spans")))
    cut = F.aggregate(
        F.col("__all"),
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(
            (s["start"] >= acc["at"]) | (acc["at"] == 0),
            F.struct(
                F.concat(
                    acc["out"],
                    F.substr(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                    F.lit(mark),
                ).alias("out"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)),
    )
    # Columns of one withColumns may see each other's new values: the new text needs a step and a name of its own.
    found = found.withColumn("__new", F.when(F.size("__all") > 0, cut).otherwise(text))
    columns = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.col("__new").alias("text")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("__all") > 0, F.length("__new").cast("long")).otherwise(F.col("n_chars"))
        columns["n_chars"] = n_chars.alias("n_chars")
    return found.select(*columns.values())
