"""Column expressions (E1-E3, E6). All JVM-side, all codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Similarities are rounded to this many decimals before they are ranked,
# filtered for zero or used as weights, so that summation order never decides
# a rank or turns a mathematical zero into a weight.
SIM_DIGITS = 12
#: The least that is not rounded to zero.
HALF_SIM = float(f"5e-{SIM_DIGITS + 1}")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale(x, avg, lo: float = 1.0, hi: float = 5.0) -> Column:
    """User-specific scale: hi - avg above the mean, avg - lo below it, else 1."""
    x, avg = _c(x), _c(avg)
    return (F.when(x > avg, F.lit(float(hi)) - avg)
             .when(x < avg, avg - F.lit(float(lo)))
             .otherwise(F.lit(1.0)))


def normalized_deviation(rating, avg, lo: float = 1.0, hi: float = 5.0) -> Column:
    """(r - avg) / scale(r, avg). Never divides by zero for ratings in [lo, hi]."""
    rating, avg = _c(rating), _c(avg)
    return (rating - avg) / scale(rating, avg, lo, hi)


def combine(avg, dev, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Map a mean and a normalized deviation back to the rating scale."""
    avg, dev = _c(avg), _c(dev)
    return avg + dev * scale(avg + dev, avg, lo, hi)


def absolute_error(pred="pred", rating="rating") -> Column:
    return F.abs(_c(pred) - _c(rating))


def round_sim(x) -> Column:
    return F.round(_c(x), SIM_DIGITS)


def counts_sim(x) -> Column:
    """``round_sim(x) != 0``, without rounding, which is dear and would be done again
    for each condition: a value of half a unit of the last place is rounded up."""
    return F.abs(_c(x)) >= F.lit(HALF_SIM)


def positive_sim(x) -> Column:
    """``round_sim(x) > 0``, without rounding."""
    return _c(x) >= F.lit(HALF_SIM)
