"""Rounding, bounding, casting and search expressions."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, functions as F


def round_half_even(c: Column, dp: int) -> Column:
    """Scale, round half to even, scale back: the array-library rounding."""
    scale = float(10**dp)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def _formatted(c: Column, dp: int) -> Column:
    return F.call_function("format_number", c, F.lit("0." + "0" * dp))


def round_report(c: Column, dp: int) -> Column:
    """Correctly rounded to ``dp`` decimals; for small report tables, not hot rows.

    Values below one unit of the last decimal are decided by comparison, since the
    formatter drops a lone digit 5 there.
    """
    unit, half = float(f"1e-{dp}"), float(f"5e-{dp + 1}")
    half_goes_up = Decimal(half) > Decimal(5).scaleb(-(dp + 1))
    size = F.abs(c)
    up = size >= half if half_goes_up else size > half
    small = F.when(up, F.signum(c) * unit).otherwise(0.0)
    return F.when(size < unit, small).otherwise(_formatted(c, dp).cast("double")) + F.lit(0.0)


def fixed(c: Column, dp: int) -> Column:
    """Text with exactly ``dp`` decimals, correctly rounded."""
    return _formatted(round_report(c, dp), dp)


def clip(c: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_number(c: Column, default: float) -> Column:
    """Double, with unparseable, missing and NaN values replaced."""
    return F.coalesce(null_if_nan(c.try_cast("double")), F.lit(float(default)))


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def count_where(conditions: list[Column]) -> Column:
    """How many of the conditions hold in this row; null counts as not holding."""
    hits = [F.when(c, F.lit(1)).otherwise(F.lit(0)) for c in conditions]
    return reduce(lambda a, b: a + b, hits, F.lit(0))


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, for costly expressions used repeatedly."""
    return F.get(F.transform(F.array(value), body), 0)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def count_reached(edges: Column, n_edges: int, value: Column) -> Column:
    """Number of entries of an ascending array that are <= value.

    Binary search as one expression: about log2(n) steps per row. The value travels in
    the accumulator, so it is evaluated once however it was computed.
    """
    steps, top = [], 1
    while top <= n_edges:
        steps.append(top)
        top *= 2

    def advance(acc: Column, step: Column) -> Column:
        at = acc["found"] + step
        reached = (at <= F.size(edges)) & (F.get(edges, at - 1) <= acc["value"])
        return F.struct(acc["value"].alias("value"), F.when(reached, at).otherwise(acc["found"]).alias("found"))

    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.struct(value.cast("double").alias("value"), F.lit(0).alias("found")),
        advance,
        lambda acc: acc["found"],
    )


def bin_index(value: Column, low: Column, step: Column, n_bins: int) -> Column:
    """Equal-width bin, left-closed, last bin closed on the right.

    The bin is settled by comparing with the edges ``low + i*step``; the division
    only proposes a candidate, so values lying on an edge go to the right bin. When
    all edges coincide every value belongs to the last bin.
    """
    guess = F.greatest(
        F.least(F.floor(F.try_divide(value - low, step)), F.lit(n_bins - 1)), F.lit(0)
    )
    fixed_bin = (
        guess
        - F.when((guess > 0) & (value < low + guess * step), 1).otherwise(0)
        + F.when((guess < n_bins - 1) & (value >= low + (guess + 1) * step), 1).otherwise(0)
    )
    return F.when(step == 0, F.lit(n_bins - 1)).otherwise(fixed_bin).cast("int")
