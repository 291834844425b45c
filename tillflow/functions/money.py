"""Sums of money kept as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Places an amount keeps while it is added. A smaller part of an amount is lost, so
#: raise it where amounts are smaller than that; the rest of 28 digits is for the front.
PLACES = 12


def exact_sum(amount: Column, places: int = PLACES) -> Column:
    """Sum of a double column, independent of the order of its rows.

    Amounts are added as decimals and rounded once, to the double nearest their sum.
    Amounts of 28 digits less ``places`` and more before the point, and NaN, are added
    as doubles, whose last digits depend on the order; none is lost.
    """
    fits = amount.try_cast(f"decimal(28,{places})")
    exact = F.sum(fits).cast("double")
    rest = F.sum(F.when(fits.isNull(), amount))
    return F.coalesce(exact + rest, exact, rest)
