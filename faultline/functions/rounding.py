"""Decimal rounding of the exact binary value, ties to even, with plain double arithmetic.

Spark's ``round`` and ``bround`` work on the printed decimal: 2.675 becomes 2.68 although the double lies
below 2.675. Here x * 10^n is computed with its exact error (Dekker's product), so ties are decided on the
true value and the result is the correctly rounded one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = float(2**27 + 1)


def round_exact(x: Column, digits: int) -> Column:
    scale = float(10**digits)
    x = x.cast("double")
    high = x * _SPLIT - (x * _SPLIT - x)
    low = x - high
    product = x * scale
    error = (high * scale - product) + low * scale
    base = F.floor(product).cast("double")
    rest = product - base
    odd = base % 2 != 0
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & odd)))
    return (base + F.when(up, 1.0).otherwise(0.0)) / scale


def percent_text(rate: Column) -> Column:
    """A rate as text with one decimal, e.g. 12.5%."""
    return F.format_string("%.1f%%", round_exact(rate.cast("double") * 100, 1))


def count_text(n: Column) -> Column:
    """A count with thousands separators."""
    return F.format_number(n.cast("bigint"), 0)
