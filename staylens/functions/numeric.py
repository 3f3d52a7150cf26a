"""Numeric and time expressions: Column in, Column out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_guard(col: Column, lo, hi) -> Column:
    """NULL outside [lo, hi]; a bound of None is open."""
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (col >= lo)
    if hi is not None:
        ok = ok & (col <= hi)
    return F.when(ok, col)


def clip(col: Column, lo=None, hi=None) -> Column:
    """Move values onto the nearer bound; NULL stays NULL."""
    out = col
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    return out


def zero_to_null(col: Column) -> Column:
    return F.when(col != 0, col)


def rescale_steps(col: Column, steps: list[tuple]) -> Column:
    """Apply (above, up_to, divisor) steps in order, each on the result of the
    one before. ``up_to`` of None leaves the step open above."""
    out = col
    for above, up_to, divisor in steps:
        hit = out > above
        if up_to is not None:
            hit = hit & (out <= up_to)
        out = F.when(hit, out / divisor).otherwise(out)
    return out


# A double holds less than 10^309, so this many divisions by ten bring every
# finite value below any positive bound.
_MAX_TENFOLD_STEPS = 320


def rescale_until(col: Column, lo: float, hi: float) -> Column:
    """Divide by ten while above ``hi``, then NULL outside [lo, hi].

    Only the rare values above ``hi`` walk the steps.
    """
    value = col.cast("double")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(_MAX_TENFOLD_STEPS)),
        value,
        lambda acc, _: F.when(acc > hi, acc / 10).otherwise(acc),
    )
    return range_guard(F.when(value > hi, walked).otherwise(value), lo, hi)


def to_decimal(col: Column, precision: int, scale: int) -> Column:
    """Fixed-scale rounding, halves away from zero; NULL where it overflows."""
    return col.try_cast(f"decimal({precision},{scale})")


def double_to_decimal(col: Column, precision: int, scale: int) -> Column:
    """As ``to_decimal`` for averages held in double: ten decimals first, so
    that the order of addition cannot tip a half."""
    return to_decimal(to_decimal(col, 28, 10), precision, scale)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for timestamps with and without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def elapsed(start: Column, end: Column, unit_seconds: int) -> Column:
    """Exact decimal number of units between two timestamps."""
    return (micros(end) - micros(start)).cast("decimal(30,0)").cast("decimal(38,12)") / F.lit(
        unit_seconds * 1_000_000
    ).cast("decimal(18,0)")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double where both are present and b is positive."""
    return F.when(b > 0, a.cast("double") / b.cast("double"))


def exact_mean(total: Column, count: Column) -> Column:
    """Mean of an exact decimal total; NULL for an empty group."""
    return F.when(count > 0, total.cast("decimal(38,18)") / count.cast("decimal(20,0)"))


def sum_zero(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])


def completeness(*cols: Column) -> Column:
    """How many of the columns hold a value."""
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def _scaled(col: Column, power: Column) -> Column:
    """|col| * power rounded to a whole number the way a binary float is
    rounded: by its exact value, exact halves to even. ``power`` is a power of
    ten up to 10^6.

    The rounded product settles it unless it lands on a half; then the part
    lost in the product decides. The halves of the split factor multiply
    without loss, so that part is exact.
    """
    x = F.abs(col.cast("double"))
    product = x * power
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    lost = (high * power - product) + (x - high) * power
    return (
        F.when(product - F.floor(product) != 0.5, F.rint(product))
        .when(lost > 0, F.ceil(product).cast("double"))
        .when(lost < 0, F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )


def round_binary(col: Column, digits: int) -> Column:
    """Round a double by its exact binary value (0.125 to 0.12)."""
    power = F.lit(float(10**digits))
    return F.signum(col.cast("double")) * _scaled(col, power) / power


def format_scaled(col: Column, power: Column, digits: Column) -> Column:
    """Fixed-decimals text of a double, rounded by its exact binary value;
    ``power`` is ten to the ``digits``."""
    value = F.signum(col.cast("double")) * _scaled(col, power) / power
    return F.replace(F.call_function("format_number", value, digits), F.lit(","), F.lit(""))


def format_fixed(col: Column, digits: int) -> Column:
    return format_scaled(col, F.lit(float(10**digits)), F.lit(digits))
