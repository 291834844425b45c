"""Last write wins per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Order of the rows of one micro-batch: source position, then identity. The producer's
# time only tells rows apart that agree in all else.
ARRIVAL = ("partition", "offset", "pos", "record_id", "ingest_ts")

# Order of all writes of a table: a later micro-batch wins, as in a table that
# overwrites by itself.
WRITES = ("batch_id", *ARRIVAL)


def last_write(rows: DataFrame, key: str, order: Iterable[str] = ARRIVAL) -> DataFrame:
    """The last row of each key.

    ``max`` reduces each task's rows before the shuffle, so a key holding a
    third of all rows sends one row per task. The columns after the order break
    its ties, which makes the winner unique. Select only the columns to keep
    beforehand: Catalyst cannot prune inside the struct.
    """
    order = list(order)
    others = [c for c in rows.columns if c != key and c not in order]
    return (
        rows.groupBy(key)
        .agg(F.max(F.struct(*order, *others)).alias("_row"))
        .select(key, "_row.*")
        .select(*rows.columns)
    )
