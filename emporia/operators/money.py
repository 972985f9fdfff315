"""Exact, order-independent sums of doubles.

A ``sum`` over doubles depends on the order rows arrive in, so two layouts of the
same data (or a recomputed partition) can differ in the last bits. Here a double is
cut at fixed powers of two into whole numbers of LIMB_BITS bits ("limbs", one a bin
of exponents), each bin is summed as a bigint, and only the finished total is rounded
to a double, once, to the nearest (ties to even). Sums of whole numbers are exact,
so a sum may be split and merged in any grouping (pre-aggregation below a join,
partial aggregates across map tasks) without changing a bit of the result.

NaN and infinities are summed beside the bins and give what a plain sum gives: NaN
if there is a NaN or infinities of both signs, else the infinity.

A bin holds 2**39 (5e11) full limbs of one sign before its bigint overflows, which
raises under ANSI mode (Spark's default, and in ``RECOMMENDED_CONF``).

How many bins there are is a choice of range. MONEY covers every double below 2**96
(7.9e28) that is a multiple of 2**-96; that includes all doubles from 1.2e-13 up and
all differences of such amounts. One outside raises an error on its row, whether or
not ANSI mode is on. ALL covers every double there is, with eleven times the bins;
``emporia.money.allDoubles = true`` makes the gold tables use it. No total is ever
silently wrong.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: session setting; "true" sums over every double's range.
ALL_DOUBLES_CONF = "emporia.money.allDoubles"

# Bits of a limb: a multiple of it is the number of bits a range covers.
LIMB_BITS = 24


# What every double is scaled by where two halves of 48 bits are put together.
_HALF = "281474976710656D"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _double(value: float) -> str:
    return f"{value!r}D"


@dataclass(frozen=True)
class ExactSum:
    """Exact sums of doubles that are multiples of ``2**low`` and below ``2**(low + 24 * limbs)``.

    Amounts and sums are named by SQL text (``"price + freight_value"``, ``"amount_sum"``):
    the expressions are long, and Spark reads a text much faster than Python builds them.
    """

    low: int
    limbs: int

    @property
    def high(self) -> int:
        return self.low + LIMB_BITS * self.limbs

    def _limb(self, amount: str, i: int) -> str:
        """The bits of ``amount`` from ``2**(low + 24 * i)`` on, up to the next limb; remainders by powers of two are exact."""
        unit = _double(2.0 ** (self.low + LIMB_BITS * i))
        upto = amount if i == self.limbs - 1 else f"{amount} % {_double(2.0 ** (self.low + LIMB_BITS * (i + 1)))}"
        return f"cast(({upto} - {amount} % {unit}) / {unit} as bigint)"

    def sum(self, amount: str, times: str = "1L") -> Column:
        """Aggregate: the bins of the sum of a double, each row counted ``times`` times.

        NULL amounts are skipped; the bins are NULL when every amount is.
        """
        odd = f"(isnan({amount}) or abs({amount}) = double('inf'))"
        finite = f"if({odd}, 0D, {amount})"
        if self.high < 1024 or self.low > -1074:
            outside = f"(abs({finite}) >= {_double(2.0**self.high)} or {finite} % {_double(2.0**self.low)} != 0D)"
            error = f"cast(raise_error(concat('amount outside the range of exact sums: ', string({amount}))) as double)"
            finite = f"if({outside}, {error}, {finite})"
        bins = ", ".join(f"sum({self._limb(finite, i)} * {times})" for i in range(self.limbs))
        special = f"sum(case when {odd} then {amount} when {amount} is not null then 0D end)"
        return F.expr(f"named_struct('bins', array({bins}), 'special', {special})")

    def merged(self, part: str) -> Column:
        """Aggregate: the bins of the sum of several sums."""
        bins = ", ".join(f"sum(get({part}.bins, {i}))" for i in range(self.limbs))
        return F.expr(f"named_struct('bins', array({bins}), 'special', sum({part}.special))")

    def value(self, total: str) -> Column:
        """The double nearest to a sum (NULL when nothing was summed)."""
        mask = (1 << LIMB_BITS) - 1

        def digits(bins: str) -> str:
            """Carried over to digits from 0 to 2**24 - 1, lowest first, and the carry that is left."""
            return (
                f"aggregate({bins}, named_struct('digits', cast(array() as array<bigint>), 'carry', 0L), (seen, bin) -> "
                f"named_struct('digits', concat(seen.digits, array((bin + seen.carry) & {mask}L)), "
                f"'carry', shiftright(bin + seen.carry, {LIMB_BITS})))"
            )

        def digit(back: int) -> str:
            return f"coalesce(get(ds, top - {back}), 0L)"

        # A total that is not negative, from its digits: the four highest make a double, a bit stands for the rest.
        lower = "cast(exists(slice(ds, 1, greatest(top - 3, 0)), d -> d > 0) as bigint)"
        # Both halves are exact doubles, so their sum is rounded once.
        lead = (
            f"(cast(shiftleft({digit(0)}, {LIMB_BITS}) + {digit(1)} as double) * {_HALF}"
            f" + cast((shiftleft({digit(2)}, {LIMB_BITS}) + {digit(3)}) | {lower} as double))"
        )
        exponent = f"({LIMB_BITS} * (top - 3) + {self.low})"
        half = f"floor({exponent} / 2)"
        nearest = f"if(top >= 0, {lead} * pow(2D, {half}) * pow(2D, {exponent} - {half}), 0D)"
        rounded = _let("top", "array_max(transform(ds, (d, i) -> if(d > 0, i, -1)))", nearest)

        def size_of(parts: str) -> str:
            rest = f"array({parts}.carry & {mask}L, shiftright({parts}.carry, {LIMB_BITS}))"
            return _let("ds", f"concat({parts}.digits, {rest})", rounded)

        negated = _let("neg", digits(f"transform({total}.bins, bin -> -bin)"), size_of("neg"))
        finite = _let("pos", digits(f"{total}.bins"), f"if(pos.carry < 0, -{negated}, {size_of('pos')})")
        exact = f"if({total}.special = 0D, {finite}, {total}.special)"
        return F.expr(f"case when get({total}.bins, 0) is not null then {exact} end")


MONEY = ExactSum(low=-96, limbs=8)
ALL = ExactSum(low=-1074, limbs=88)


def money_sums(spark: SparkSession) -> ExactSum:
    """The range that the session's sums cover (``emporia.money.allDoubles``)."""
    return ALL if spark.conf.get(ALL_DOUBLES_CONF, "false").lower() == "true" else MONEY


def mean_of(total: Column, count: Column) -> Column:
    """``total / count`` as a double, NULL when nothing was counted.

    Matches ``avg``: NULL inputs are neither summed nor counted.
    """
    return F.when(count > 0, total.cast("double") / count.cast("double"))
