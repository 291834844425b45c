"""From a raw topic to enriched rows, in one narrow plan (no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.enrich import enrich, with_dates
from tillflow.operators.keyed import ARRIVAL
from tillflow.operators.messages import (
    decode, expand, explode_users, explode_users_outer, fill_defaults, flatten, parse,
    with_reject_reason,
)
from tillflow.schema import ARCHIVE, DERIVED_FROM

ALL = (*ARCHIVE, "tran_year")


def transactions(raw: DataFrame, columns: Iterable[str] = ALL, mode: str = "draw",
                 defaults: bool = False) -> DataFrame:
    """The named columns and the row's arrival, one row per user.

    Only the message fields behind those columns are parsed, so ask for no more
    than the job needs.
    """
    columns = list(dict.fromkeys(columns))
    flat = list(dict.fromkeys(DERIVED_FROM.get(c, c) for c in columns))
    messages = expand(parse(decode(raw), flat))
    if defaults and "tran_detail" in messages.columns:
        messages = fill_defaults(messages)
    rows = enrich(flatten(explode_users(messages), flat), mode=mode)
    if "registered" in flat:
        rows = with_dates(rows)
    return rows.select(*ARRIVAL, *columns)


def audited_transactions(raw: DataFrame, mode: str = "draw", defaults: bool = False) -> DataFrame:
    """All columns, and a row for each message without users.

    ``reject_reason`` is set on the rows of an unfit message, ``value`` holds
    its payload.
    """
    messages = with_reject_reason(expand(parse(decode(raw))))
    if defaults:
        messages = fill_defaults(messages)
    flagged = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
    exploded = explode_users_outer(messages.withColumn("value", flagged))
    return with_dates(enrich(
        flatten(exploded, also=("message_id", "reject_reason", "value")), mode=mode))
