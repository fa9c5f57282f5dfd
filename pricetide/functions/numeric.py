"""Numbers from text, rounding and averaging.

A value of one row is rounded as the double it is: half up on its shortest decimal
text. A sum of doubles depends on the order in which partitions arrive, so means are
taken over decimals. NaN, infinities and values of ``LARGEST`` or more are no numbers
here: they become null where text is cast, and are counted there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Larger values do not fit the decimals that means are taken over.
LARGEST = 1e20


def finite(value: Column) -> Column:
    """The double, or null for NaN, infinities and values of LARGEST or more."""
    number = value.try_cast("double")
    return F.when(F.abs(number) < LARGEST, number)  # NaN is larger than any number


def exact(value: Column) -> Column:
    return finite(value).cast("decimal(28,6)")


def round_half_up(value: Column, places: int) -> Column:
    """One value to ``places``; NaN and infinities are null."""
    return F.round(finite(value), places)


def avg_exact(value: Column, places: int) -> Column:
    """Mean rounded half up to ``places``; nulls are ignored."""
    return F.round(F.avg(exact(value)), places).cast("double")


def max_exact(value: Column, places: int) -> Column:
    return F.round(F.max(finite(value)), places)


def minor_to_major(value: Column) -> Column:
    """Whole minor units (cents) to major units; null stays null."""
    return F.round(value.cast("decimal(21,2)") / 100, 2).cast("double")
