"""Reproducible stand-ins for random draws.

A draw is a 32-bit slice of the MD5 of a record's identity. It is the same after
a retry, a restart or a second read, so every sink holds the same values, and it
stays inside Catalyst. One digest serves four draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CARD, USER, PRODUCT, AMOUNT = range(4)


def draw(digest: Column, slot: int) -> Column:
    """Slot 0..3 of an MD5 hex digest as a number in [0, 2^32)."""
    return F.conv(F.substring(digest, 8 * slot + 1, 8), 16, 10).cast("bigint")


def draw_card(digest: Column, cards: Column) -> Column:
    """One card of the list; NULL for a NULL or an empty list."""
    index = F.pmod(draw(digest, CARD), F.size(cards)) + 1
    return F.when(F.size(cards) > 0, F.element_at(cards, index.cast("int")))


def draw_suffix(text: Column, digest: Column, slot: int, last: int) -> Column:
    """The text followed by a whole number in [0, last]; NULL if the text is."""
    return F.concat(text, F.pmod(draw(digest, slot), F.lit(last + 1)).cast("string"))


def draw_amount(amount: Column, digest: Column) -> Column:
    """A share in [0, 1) of the amount, rounded half up to cents.

    Decimal arithmetic keeps ties exact. An amount too large for it (1e18 and
    beyond, or NaN) takes the double route instead of failing or vanishing.
    """
    steps = F.pmod(draw(digest, AMOUNT), F.lit(10000))
    share = (steps.cast("decimal(9,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(5,4)")
    exact = F.round(amount.try_cast("decimal(24,6)") * share, 2).cast("double")
    return F.coalesce(exact, F.round(amount * steps / 10000, 2))
