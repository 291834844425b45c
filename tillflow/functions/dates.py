"""Epoch seconds to date text and year (session time zone, pinned to UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of every date in the outputs.
DATE_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Years 1 to 9999, the range the text form can hold. An epoch outside it (say,
# milliseconds) has no date, and must not fail the stream either.
FIRST_EPOCH = -62135596800
LAST_EPOCH = 253402300799


def _in_range(epoch: Column) -> Column:
    return F.when(epoch.between(FIRST_EPOCH, LAST_EPOCH), epoch)


def date_text(epoch: Column) -> Column:
    return F.from_unixtime(_in_range(epoch), DATE_PATTERN)


def year_of_epoch(epoch: Column) -> Column:
    """Same value as ``year_of_text(date_text(epoch))`` without the text."""
    return F.year(F.timestamp_seconds(_in_range(epoch)))


def year_of_text(text: Column) -> Column:
    return F.year(F.try_to_timestamp(text, F.lit(DATE_PATTERN)))
